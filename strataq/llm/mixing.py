"""Mixing sources to target weights, cut at each source's exact token budget.

Documents of a source are ordered by a hash-random key (md5 of the id). The key's range is cut
into buckets; bucket sums (map-side partial sums) and a prefix sum over them find the one bucket
in which a source's budget ends, and only that bucket's keys are summed row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, key_text, md5_int, of_row, with_row, written
from .spans import find_all

WEIGHTS = (5, 2, 1)
_KEY_DIGITS, _BUCKETS = 12, 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = 150, most_epochs: int = 2) -> DataFrame:
    """One row a source (columns source, source_size): its target.

    Sources in order of code points, null last, weigh `weights` in turn and share
    `share_percent` of all sizes. No target is above `most_epochs` times its source's size: what is
    above is shared again by weight. That is filling to one level: with sources ordered by
    size over weight, those before some place are full and the rest get weight times the level;
    two prefix sums over the table of sources give every place at once. Sums are of integers, so
    reruns agree to the last bit.
    """
    n = len(weights)
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("_rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())))
    weighed = ranked.withColumn("_w", F.array(*[F.lit(int(w)) for w in weights])[(F.col("_rank") - 1) % n].cast("bigint"))
    by_ratio = everything.orderBy((F.col("source_size") / F.col("_w")), "_rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        weighed.withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_w_all", F.sum("_w").over(everything))
        .withColumn("_full", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("_w_full", F.coalesce(F.sum("_w").over(before), F.lit(0)))
    )
    # with the sources before this one full, the level, times 100, is _left / _w_left
    left = sums.withColumn("_left", share_percent * F.col("_all") - 100 * most_epochs * F.col("_full")).withColumn("_w_left", F.col("_w_all") - F.col("_w_full"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products of longs
    fits = wide("_left") * wide("_w") <= wide("source_size") * (100 * most_epochs * F.col("_w_left")).cast("decimal(19,0)")
    first = F.min(F.when(fits, F.struct("_ratio_rank", "_left", "_w_left"))).over(everything)
    out = left.withColumn("_ratio_rank", F.row_number().over(by_ratio)).withColumn("_first", first)
    level = F.col("_first._left") * F.col("_w") / (100.0 * F.col("_first._w_left"))
    full = (most_epochs * F.col("source_size")).cast("double")
    target = F.when(F.col("_first").isNull() | (F.col("_ratio_rank") < F.col("_first._ratio_rank")), full).otherwise(level)
    return out.select("source", "source_size", target.alias("target"))


def source_cuts(keyed: DataFrame, targets: DataFrame) -> DataFrame:
    """One row a source: epochs, and where its order is cut for the remaining budget.

    `keyed`: source, doc_key, doc_id, size. Rows before (cut_key, cut_id) are taken once more
    whole, rows equal to it `cut_take` words each, rows after it not. The budget that is left at
    the cut is split evenly among rows of one id, so a repeated id needs no order among its rows.
    """
    bucket = F.shiftrightunsigned(F.col("doc_key"), 4 * _KEY_DIGITS - 12)
    goal = targets.select(F.col("source").alias("_s"), F.col("source_size"), F.col("target"))
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint"))
    goal = goal.withColumn("budget", F.round(F.col("target")).cast("bigint") - F.col("epochs") * F.col("source_size"))
    sums = keyed.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("sum"))
    through = sums.withColumn("through", F.sum("sum").over(Window.partitionBy("source").orderBy("bucket")))
    hit = through.join(goal, F.col("source").eqNullSafe(F.col("_s"))).where((F.col("through") > F.col("budget")) & (F.col("through") - F.col("sum") <= F.col("budget")))
    hit = hit.select(F.col("_s"), F.col("bucket").alias("_b"), (F.col("budget") - F.col("through") + F.col("sum")).alias("_left"))
    ids = keyed.join(hit, F.col("source").eqNullSafe(F.col("_s")) & (bucket == F.col("_b"))).groupBy("_s", "_left", "doc_key", "doc_id").agg(F.sum("size").alias("sum"), F.count(F.lit(1)).alias("n"))
    running = ids.withColumn("through", F.sum("sum").over(Window.partitionBy("_s").orderBy("doc_key", F.col("doc_id").asc_nulls_first())))
    cut = running.where((F.col("through") > F.col("_left")) & (F.col("through") - F.col("sum") <= F.col("_left")))
    # of the rows of one id, each gets the same part of what is left
    cut = cut.select(F.col("_s").alias("_c"), F.col("doc_key").alias("cut_key"), F.col("doc_id").alias("cut_id"), (F.col("_left") - F.col("through") + F.col("sum")).alias("cut_left"), F.col("n").alias("cut_n"))
    return goal.join(cut, F.col("_s").eqNullSafe(F.col("_c")), "left").drop("_c").withColumnRenamed("_s", "_source")


def taken_words() -> Column:
    """Of a row with size, doc_key, doc_id and its source's cut: the words the mix takes."""
    no_cut = F.col("cut_key").isNull()
    same = (F.col("doc_key") == F.col("cut_key")) & F.col("doc_id").eqNullSafe(F.col("cut_id"))
    before = (F.col("doc_key") < F.col("cut_key")) | ((F.col("doc_key") == F.col("cut_key")) & ((F.col("doc_id") < F.col("cut_id")) | (F.col("doc_id").isNull() & F.col("cut_id").isNotNull())))
    more = F.when(no_cut, F.when(F.col("budget") > 0, F.col("size")).otherwise(0)).when(same, F.least(F.col("size"), F.floor(F.col("cut_left") / F.col("cut_n")))).when(before, F.col("size")).otherwise(0)
    return (F.col("epochs") * F.col("size") + more).cast("bigint")


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: Sequence[int] = WEIGHTS, share_percent: int = 150, most_epochs: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row, and the columns in `keep`.

    Sizes are counted once and written with the keys (no text), whatever `keep` has. A null text
    has size 0; null sources form one source, the last; rows of one id are cut alike; a source
    without words has target 0. Empty in, empty out. Other columns don't matter.
    """
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), n_words(F.col(f"`{text}`")).alias("size"), md5_int(key_text(F.col(f"`{doc_id}`")), _KEY_DIGITS).alias("doc_key"))
    keyed = written(narrow, "mix")
    cuts = written(source_cuts(keyed, source_targets(keyed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share_percent, most_epochs)), "cuts")
    rows = keyed if not keep else docs.select(*narrow_columns(docs, keep), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), n_words(F.col(f"`{text}`")).alias("size"), md5_int(key_text(F.col(f"`{doc_id}`")), _KEY_DIGITS).alias("doc_key"))
    placed = rows.join(cuts, F.col("source").eqNullSafe(F.col("_source")))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken_words().alias("taken"), *keep)


def narrow_columns(docs: DataFrame, keep: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in keep if c not in ("doc_id", "source")]


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: Sequence[int] = WEIGHTS, share_percent: int = 150, most_epochs: int = 2) -> DataFrame:
    """The mix itself, with the columns of `docs`: each row as often as it is taken whole, and the row
    at a source's cut up to the last word that its budget has. Rows without words aren't taken.

    Null sources form one source, the last; rows without an id and repeated rows are rows like
    others. Columns may have any names; an empty table stays empty.
    """
    row = with_row(docs, [text], **{n: F.col(f"`{c}`") for c, n in ((text, "text"), (source, "source"), (doc_id, "doc_id"))})
    placed = mix(row, weights=weights, share_percent=share_percent, most_epochs=most_epochs, keep=["row", "text"])
    whole, part = F.floor(F.col("taken") / F.col("size")), F.col("taken") % F.col("size")
    copies = placed.where("taken > 0").withColumns({"_whole": whole, "_part": part}).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_whole") + F.when(F.col("_part") > 0, 1).otherwise(0))))
    end = F.element_at(find_all(F.col("text"), WORD), F.col("_part").cast("int"))["end"]
    cut = F.when(F.col("_copy") > F.col("_whole"), F.substring("text", F.lit(1), end.cast("int"))).otherwise(F.col("text"))
    return copies.select(*of_row(docs, **{text: cut}))
