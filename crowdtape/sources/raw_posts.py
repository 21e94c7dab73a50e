"""Raw posts: ``;``-separated text lines, validated field by field.

Parsing is a chain of projections on each line. Nothing is shuffled and nothing
reaches the driver; good and bad lines come out of the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.fence import fence
from crowdtape.functions.text import unquote, valid_id
from crowdtape.schemas import POST

# The header line that starts every file, and its field order.
HEADER = "username;date;retweets;favorites;text;geo;mentions;hashtags;id;permalink"
FIELDS = HEADER.split(";")
SEPARATOR = ";"

# Time of a post, e.g. 2016/03/04 09:05. One-digit parts are accepted.
STRICT_TIME = r"\A\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}\z"
# The same fields at the start of the value, of any size, with blanks before each.
LENIENT_TIME = (
    r"\A[ \t]*(\d{1,4})/[ \t]*(\d{1,4})/[ \t]*(\d{1,4}) [ \t]*(\d{1,4}):[ \t]*(\d{1,4})"
)
INTEGER = r"\A[+-]?[0-9]+\z"


def read_raw_posts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read lines from a path, a glob or a list of them, as column ``value``."""
    return spark.read.text(path)


def split_fields(pieces: Column) -> Column:
    """Join a line that was split at its quotes and split it at its separators.

    A separator counts when an even number of quotes follows it. Piece ``i`` of
    ``n`` has ``n - 1 - i`` quotes after it, so whole pieces are in or out and
    each line costs time linear in its length. A line holds no line break, which
    makes the line break a safe mark for the separators that count.

    Pass ``pieces`` as a column of its own: an expression would be evaluated
    again for each piece.
    """
    last = F.size(pieces) - 1
    marked = F.transform(
        pieces,
        lambda piece, i: F.when(
            (last - i) % 2 == 0, F.replace(piece, F.lit(SEPARATOR), F.lit("\n"))
        ).otherwise(piece),
    )
    return F.split(F.array_join(marked, '"'), "\n")


def _strict_time(raw: Column) -> Column:
    return F.when(raw.rlike(STRICT_TIME), F.translate(raw, "/", "-").try_cast("timestamp_ntz"))


def _lenient_time(raw: Column) -> Column:
    """Parts beyond their range roll over (month 13 is next January); rest is ignored."""
    year, month, day, hour, minute = (
        F.regexp_extract(raw, LENIENT_TIME, i).try_cast("int") for i in range(1, 6)
    )
    start = F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1)
    midnight = F.date_add(start, day - 1).cast("timestamp_ntz")
    return F.when(
        raw.rlike(LENIENT_TIME) & (year > 0),
        midnight + F.make_dt_interval(F.lit(0), hour, minute, F.lit(0)),
    )


def _integer(raw: Column) -> Column:
    return F.when(raw.rlike(INTEGER), raw.try_cast("int"))


def parse_posts(
    lines: DataFrame,
    lenient_time: bool = False,
    require_permalink: bool = True,
    unquote_text: bool = False,
) -> DataFrame:
    """Parse lines (column ``value``) into the post columns plus a verdict.

    Header lines disappear. All other lines come out once, with
    ``reject_reason`` NULL for a good post, or the first rule the line broke;
    rejected lines keep their text in ``raw``.

    * ``lenient_time``: let month, day, hour and minute roll over and ignore
      what follows the minute, instead of rejecting such a time.
    * ``require_permalink``: reject a line that has nothing from the tenth field
      on. Without it only the separator has to be there.
    * ``unquote_text``: remove the quotes around ``text`` and undo doubled ones.
    """
    pieces = lines.filter((F.col("value") != HEADER) | F.col("value").isNull()).select(
        "value", F.split("value", '"').alias("pieces")
    )
    # Without the fence each test on a field would split the line again.
    split = fence(pieces, "value", split_fields(F.col("pieces")).alias("fields"))

    fields = F.col("fields")
    raw = {name: F.get(fields, F.lit(i)) for i, name in enumerate(FIELDS)}
    parse_time = _lenient_time if lenient_time else _strict_time
    text = raw["text"]
    if unquote_text:
        text = F.regexp_replace(text, r'\A"|"\z', "")
        text = F.replace(text, F.lit('""'), F.lit('"'))
    typed = split.select(
        "value",
        F.size(fields).alias("n_fields"),
        (F.array_join(F.slice(fields, len(FIELDS), F.size(fields)), "") != "").alias("has_tail"),
        raw["username"].alias("username"),
        parse_time(raw["date"]).alias("timestamp"),
        _integer(raw["retweets"]).alias("retweets"),
        _integer(raw["favorites"]).alias("favorites"),
        text.alias("text"),
        raw["geo"].alias("geo"),
        raw["mentions"].alias("mentions"),
        raw["hashtags"].alias("hashtags"),
        unquote(raw["id"]).alias("id"),
        raw["permalink"].alias("permalink"),
    )

    enough = F.col("has_tail") if require_permalink else F.col("n_fields") >= len(FIELDS)
    reason = (
        F.when(F.col("value").isNull(), "no line")
        .when(F.contains("value", F.lit("\n")), "line break")
        .when(~enough, "missing fields")
        .when(~valid_id(F.col("id")), "bad id")
        .when(F.col("timestamp").isNull(), "bad time")
        .when(F.col("retweets").isNull(), "bad retweets")
        .when(F.col("favorites").isNull(), "bad favorites")
    )
    judged = typed.withColumn("date", F.to_date("timestamp")).withColumn("reject_reason", reason)
    return judged.select(
        *POST.fieldNames(),
        "reject_reason",
        F.when(F.col("reject_reason").isNotNull(), F.col("value")).alias("raw"),
    )


def accepted_posts(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).select(*POST.fieldNames())


def rejected_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select("raw", "reject_reason")
