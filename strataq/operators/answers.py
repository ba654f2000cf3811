"""Answers whose form drifts: bodies as VARIANT, typed fields by the paths where they were seen, what can't be read set apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Fields = Mapping[str, tuple[str, Sequence[str]]]


def typed(df: DataFrame, body: str, fields: Fields) -> DataFrame:
    """`df` with a column a field (name: type and the paths to try, in order) and `failed`.

    `failed` is `$` where the body is null or no JSON, else the first path of the first field that no path gives as its type, else null.
    A field is null where it can't be read; the others of that row are still given. JSON null counts as missing.
    """
    clash = {*fields, "failed"} & {*df.columns}
    if clash:
        raise ValueError(f"the table has columns {sorted(clash)}")
    doc = F.try_parse_json(F.col(body))

    def read(kind: str, paths: Sequence[str]) -> Column:
        return F.coalesce(*[F.try_variant_get(doc, p, kind) for p in paths])

    found = {name: read(kind, paths) for name, (kind, paths) in fields.items()}
    failed = F.when(doc.isNull(), "$")
    for name, (_, paths) in fields.items():
        failed = failed.when(found[name].isNull(), paths[0])
    return df.select("*", *[c.alias(name) for name, c in found.items()], failed.alias("failed"))


def forms(df: DataFrame, body: str) -> DataFrame:
    """form, n: how often each form (schema) of body occurs; null for what is no JSON. The merged one of all is `merged_form`."""
    return df.groupBy(F.schema_of_variant(F.try_parse_json(F.col(body))).alias("form")).agg(F.count(F.lit(1)).alias("n"))


def merged_form(df: DataFrame, body: str) -> DataFrame:
    """form: one schema that all bodies fit, merged by partial aggregates."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(body))).alias("form"))
