"""Joins by time: the last row before each (as-of), and rows whose intervals meet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _long(df: DataFrame, name: str) -> Column:
    """A number as it is, a date or time as microseconds (one without a zone is read in the session's)."""
    simple = df.schema[name].dataType.simpleString()
    return F.unix_micros(F.col(name).cast("timestamp")) if simple.startswith(("timestamp", "date")) else F.col(name).cast("bigint")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, values: Sequence[str], into: str = "last", bucket: int = 86_400_000_000, within: int | None = None) -> DataFrame:
    """All rows of `left`, with `into`: a struct of `values` and `at` of the last row of `right` of that key not after it.

    Of right rows of one key and time the one of greatest values (in their order) counts. Null where there is none, where the
    key or time is null, or where it is more than `within` before. Left rows that repeat stay.

    Times are cut into buckets (`bucket`, in microseconds or the unit of a number): a bucket of a key is sorted
    apart and starts with the last values of those before it, so a key with many rows is many tasks. Only distinct times go through that;
    the left rows join their answers by key and time, a join that adaptive execution can split.
    """
    if into in left.columns:
        raise ValueError(f"the left table has a column {into}")
    # a row travels as one struct, so helper names can't clash
    rows = left.select(F.struct(*left.columns).alias("row"), F.col(key).alias("key"), _long(left, at).alias("at"))
    found = right.select(F.col(key).alias("key"), _long(right, at).alias("at"), F.struct(*values, F.col(at).alias(at)).alias("value"))
    found = found.where("key is not null and at is not null").groupBy("key", "at").agg(F.max("value").alias("value"))
    asked = rows.where("key is not null and at is not null").select("key", "at").distinct()
    number = F.floor(F.col("at") / bucket).cast("bigint")
    held = F.when(F.col("value").isNotNull(), F.struct("at", "value"))
    both = asked.select("key", "at", number.alias("bucket"), F.lit(1).alias("kind"), F.lit(None).cast(found.schema["value"].dataType).alias("value"))
    both = both.unionByName(found.select("key", "at", number.alias("bucket"), F.lit(0).alias("kind"), "value")).select("key", "at", "bucket", "kind", held.alias("held"))
    # a row a bucket: what it ends with, and so what the next one starts with
    ends = both.groupBy("key", "bucket").agg(F.max("held").alias("end"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("key", F.lit(None).cast("bigint").alias("at"), "bucket", F.lit(-1).alias("kind"), F.last("end", True).over(before).alias("held")).where("held is not null")
    here = Window.partitionBy("key", "bucket").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)  # null times, what is carried, come first
    answers = both.unionByName(carried).withColumn("held", F.last("held", True).over(here)).where("kind = 1 and held is not null")
    if within is not None:
        answers = answers.where(F.col("at") - F.col("held.at") <= within)
    return rows.join(answers.select("key", "at", "held.value"), ["key", "at"], "left").select("row.*", F.col("value").alias(into))


def meeting(left: DataFrame, right: DataFrame, start: str, end: str, key: str | None = None, finest: int = 60_000_000) -> DataFrame:
    """Pairs `one`, `other` (whole rows as structs) of rows whose intervals, both ends included, share a point, and whose key is equal if one is named.

    Rows with a null bound or key, or an end before their start, meet nothing. Rows that repeat make pairs of their own.

    An interval lies in one or two bins of its level, the least width (`finest` times a power of two) that holds its length. A pair is looked for
    at the coarser level of its two, by equal bins, and counts in the bin where the later of the two starts. So a long interval isn't copied to
    many bins, and short ones meet at a coarse level only the long ones there.
    """
    one, other = (_levelled(df, start, end, key, finest) for df in (left, right))
    coarse = _pairs(one, other, finest, strict=False).select(F.col("home").alias("one"), F.col("guest").alias("other"))
    return coarse.unionByName(_pairs(other, one, finest, strict=True).select(F.col("guest").alias("one"), F.col("home").alias("other")))


def _levelled(df: DataFrame, start: str, end: str, key: str | None, finest: int) -> DataFrame:
    bounds = df.select(F.struct(*df.columns).alias("row"), (F.col(key) if key else F.lit(0)).alias("key"), _long(df, start).alias("a"), _long(df, end).alias("b"))
    length = F.col("b").cast("double") - F.col("a").cast("double")
    level = F.when(length > finest, F.ceil(F.log2(length / finest)).cast("int")).otherwise(0)
    return bounds.where("key is not null and a <= b").withColumn("level", F.least(level, F.lit(62 - finest.bit_length())))


def _pairs(home: DataFrame, guest: DataFrame, finest: int, strict: bool) -> DataFrame:
    """Pairs found at the level of `home`; guests are of that level or a finer one, of a finer one alone if `strict`."""
    levels = F.array(*[F.lit(r.level) for r in home.select("level").distinct().collect()]).cast("array<int>")  # some sixty at most
    finer = (lambda x: x > F.col("level")) if strict else (lambda x: x >= F.col("level"))
    width = F.expr(f"shiftleft({finest}L, at)")
    bin_of = lambda x: F.expr(f"({x} - pmod({x}, width)) div width")
    bins = lambda df: df.withColumn("width", width).withColumn("bin", F.explode(F.sequence(bin_of("a"), bin_of("b"))))
    h = bins(home.withColumn("at", F.col("level"))).select("key", "at", "width", "bin", F.col("row").alias("home"), "a", "b")
    g = bins(guest.withColumn("at", F.explode(F.filter(levels, finer)))).select("key", "at", "bin", F.col("row").alias("guest"), F.col("a").alias("c"), F.col("b").alias("d"))
    meet = h.join(g, ["key", "at", "bin"]).where("a <= d and c <= b")
    return meet.where(bin_of("greatest(a, c)") == F.col("bin")).select("home", "guest")
