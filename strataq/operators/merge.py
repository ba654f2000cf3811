"""Two-way synchronisation: a three-way merge, by field, of two sides and the version that both last had."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _met(local: DataFrame, remote: DataFrame, base: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """key, l, r, b: the fields of each side as a struct, null where the side lacks the row. All three are shuffled once, by the key."""
    side = lambda df, name: df.select(F.col(f"`{key}`").alias("key"), F.struct(*[F.col(f"`{f}`").alias(f) for f in fields]).alias(name))
    return side(local, "l").join(side(remote, "r"), "key", "full_outer").join(side(base, "b"), "key", "full_outer")


def _changed(side: str, field: str) -> Column:
    """Whether a side's field isn't the base's; every field of a row that the base lacks is."""
    return F.col("b").isNull() | ~F.col(f"{side}.`{field}`").eqNullSafe(F.col(f"b.`{field}`"))


def _row_changed(side: str) -> Column:
    return ~F.col(side).eqNullSafe(F.col("b"))


def _both(field: str) -> Column:
    """Whether both sides have the row and changed its field, each to another value."""
    return F.col("l").isNotNull() & F.col("r").isNotNull() & _changed("l", field) & _changed("r", field) & ~F.col(f"l.`{field}`").eqNullSafe(F.col(f"r.`{field}`"))


def merged(local: DataFrame, remote: DataFrame, base: DataFrame, key: str, fields: Sequence[str], prefer: str = "remote") -> DataFrame:
    """key and fields after the merge, for both sides to take over, and as their next base.

    A field takes the value of the side that changed it; where both did, each to another value, that of
    `prefer` (local or remote). A row that one side deleted goes if the other left it alone; if
    the other changed it, the change stands. Null is a value like others. Keys are unique on each side and not null.
    Merging the result with either side again changes nothing.
    """
    if prefer not in ("local", "remote"):
        raise ValueError("prefer local or remote")
    met, p, q = _met(local, remote, base, key, fields), *(("l", "r") if prefer == "local" else ("r", "l"))
    gone = (F.col("l").isNull() & ~_row_changed("r")) | (F.col("r").isNull() & ~_row_changed("l"))
    value = lambda f: F.when(F.col(p).isNull(), F.col(f"{q}.`{f}`")).when(F.col(q).isNull() | _changed(p, f), F.col(f"{p}.`{f}`")).otherwise(F.col(f"{q}.`{f}`"))
    return met.where(F.coalesce("l", "r").isNotNull() & ~gone).select(F.col("key").alias(key), *[value(f).alias(f) for f in fields])


def conflicts(local: DataFrame, remote: DataFrame, base: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """key, field, base_value, local_value, remote_value (text) of each field that both sides changed apart, and a
    row of field `*` where one side deleted what the other changed."""
    text = lambda side, f: F.col(f"{side}.`{f}`").cast("string")
    none = F.lit(None).cast("string")
    row = lambda f, *v: F.struct(F.lit(f).alias("field"), *[x.alias(n) for x, n in zip(v, ("base_value", "local_value", "remote_value"), strict=True)])
    met = _met(local, remote, base, key, fields)
    one_gone = F.col("b").isNotNull() & ((F.col("l").isNull() & F.col("r").isNotNull() & _row_changed("r")) | (F.col("r").isNull() & F.col("l").isNotNull() & _row_changed("l")))
    all_ = F.to_json
    whole = F.when(one_gone, row("*", all_("b"), F.when(F.col("l").isNull(), none).otherwise(all_("l")), F.when(F.col("r").isNull(), none).otherwise(all_("r"))))
    found = F.array_compact(F.array(whole, *[F.when(_both(f), row(f, text("b", f), text("l", f), text("r", f))) for f in fields]))
    return met.select(F.col("key").alias(key), F.explode(found).alias("c")).select(key, "c.*")
