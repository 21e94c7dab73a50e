"""Sentence ends by rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crowdtape import functions as fx

CASES = {
    "It cost 3.5 dollars. Then 4.": ["It cost 3.5 dollars.", "Then 4."],
    "He left the U.S. in May. Why?": ["He left the U.S. in May.", "Why?"],
    "Some, e.g. Dr. Who and Mr. X, stay!": ["Some, e.g. Dr. Who and Mr. X, stay!"],
    'She said "so." Then (this.) End': ['She said "so."', "Then (this.)", "End"],
    "Well... maybe. Wait... What?! ok": ["Well... maybe.", "Wait...", "What?!", "ok"],
    "one\n\ntwo.  three\r\nfour": ["one", "two.", "three", "four"],
    "a\x01b. c": ["ab.", "c"],
    "no end": ["no end"],
    "...": ["..."],
    " \n\t": [],
    "": [],
}


@pytest.mark.parametrize("text", CASES)
def test_rules(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(fx.sentences_by_rules(F.col("text"))).first()[0] == CASES[text]


def test_null_and_a_very_long_text(spark):
    long = "word and more. " * 50_000
    df = spark.createDataFrame([(None,), (long,)], "text string")
    sizes = df.select(F.size(fx.sentences_by_rules(F.col("text"))).alias("n")).collect()
    assert [r.n for r in sizes] in ([None, 50_000], [-1, 50_000])
