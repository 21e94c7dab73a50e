"""Declared schemas, and the cast that brings a DataFrame into one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# The columns of the raw post files, in file order, with the date
# added next to the timestamp it is taken from.
POST = _schema(
    username=T.StringType(),
    timestamp=T.TimestampNTZType(),
    date=T.DateType(),
    retweets=T.IntegerType(),
    favorites=T.IntegerType(),
    text=T.StringType(),
    geo=T.StringType(),
    mentions=T.StringType(),
    hashtags=T.StringType(),
    id=T.StringType(),
    permalink=T.StringType(),
)

# The columns of the daily price files.
PRICE = _schema(
    date=T.DateType(),
    open=T.DoubleType(),
    high=T.DoubleType(),
    low=T.DoubleType(),
    close=T.DoubleType(),
    volume=T.LongType(),
    adjClose=T.DoubleType(),
)

LABELED_POST = _schema(label=T.DoubleType(), text=T.StringType(), id=T.StringType())

SCORED_POST = _schema(
    date=T.DateType(), text=T.StringType(), id=T.StringType(), sentiment=T.DoubleType()
)

LEXICON = _schema(token=T.StringType(), polarity=T.IntegerType())


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Select the columns of ``schema`` in order and cast each to its type.

    A missing column is an error. A value that does not fit its type becomes
    NULL, or stops the job when ``strict`` is set.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found in {df.columns}")
    have = {f.name: f.dataType for f in df.schema}
    columns = []
    for field in schema:
        column = F.col(field.name)
        if have[field.name] != field.dataType:
            cast = column.cast if strict else column.try_cast
            column = cast(field.dataType).alias(field.name)
        columns.append(column)
    return df.select(*columns)
