"""Normal forms, ids, reproducible samples and word windows as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\n\r]+", " "))


def only_letters(text: Column) -> Column:
    """Lower-case letters and digits of any script, all else as one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def content_id(text: Column) -> Column:
    return F.md5(normalised(text))


def in_sample(key: Column, share_of_65536: int) -> Column:
    """Whether the key is in a sample that no repartitioning or rerun changes."""
    return F.substring(F.md5(key.cast("string")), 1, 4) < F.lit(f"{share_of_65536:04x}")


def words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def window_hashes(tokens: Column, n: int) -> Column:
    """Distinct hashes of the windows of n tokens; none if there are fewer."""
    window = lambda t, i: F.xxhash64(*[t[i + k] for k in range(n)])
    bound = F.transform(F.array(tokens), lambda t: F.when(F.size(t) >= n, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(t) - n), lambda i: window(t, i)))).otherwise(F.array().cast("array<bigint>")))
    return bound[0]
