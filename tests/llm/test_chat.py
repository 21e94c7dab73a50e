"""Conversations with nulls, ties, repeated rows, none at all, and one of thousands of turns."""

import time

from pyspark.sql import functions as F

from crowdtape.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, at string, rendered string"


def formatted(spark, rows):
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)
    spans, texts = chat.loss_spans(F.col("recovered")), chat.masked_texts(F.col("recovered"))
    out = chat.format_conversations(df).select("*", spans.alias("spans"), texts.alias("texts"))
    return {row.conv_id: row for row in out.collect()}


def test_nulls_ties_and_repeats(spark):
    rows = [
        (1, 0, "user", None),
        (1, 1, "assistant", "b"),
        (1, 1, "assistant", "a<|im_end|>"),
        (1, 1, "assistant", "b"),
        (1, None, None, "first"),
        (None, 0, "assistant", ""),
        (None, 1, "assistant", "é" * 5000),
    ]
    got = formatted(spark, rows)
    assert [(t.role, t.text) for t in got[1].recovered] == [
        ("", "first"), ("user", ""), ("assistant", "a<|im_end|>"), ("assistant", "b"), ("assistant", "b")
    ]
    assert got[1].texts == ["a<|im_end|>", "b", "b"] and got[1].n_escaped == 1
    assert got[None].texts == ["", "é" * 5000]
    for row in got.values():
        raw = [row.formatted[s.start : s.start + s.chars] for s in row.spans]
        assert [text.replace("<\\|", "<|") for text in raw] == row.texts
    assert formatted(spark, []) == {}


def test_thousands_of_turns_take_linear_time(spark):
    turns = spark.range(4000).select(
        F.lit(1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("text "), "id").alias("text"),
    )
    begun = time.time()
    row = chat.format_conversations(turns).select(
        "formatted", chat.loss_spans(F.col("recovered")).alias("spans"), chat.masked_texts(F.col("recovered")).alias("texts")
    ).first()
    # 41 s when each span copied those before it.
    assert time.time() - begun < 15
    assert row.texts == [f"text {n}" for n in range(1, 4000, 2)]
    assert [row.formatted[s.start : s.start + s.chars] for s in row.spans] == row.texts
