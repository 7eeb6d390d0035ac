"""Publication-centred pivots, link tables and cross-references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatella.operators.reconcile import keep_one


def by_publication(tools: DataFrame, pub: str, kind: str, name: str, kinds: list[str], rank: str | None = None, separator: str = "; ") -> DataFrame:
    """One row per publication: per kind its distinct names sorted and joined ('' if none), their number,
    and the smallest rank. Distinct (publication, kind, name) come first, so copies don't grow a list."""
    cols = [F.min(rank).alias("_r")] if rank else []
    once = tools.where(F.col(pub).isNotNull() & F.col(name).isNotNull()).groupBy(pub, kind, name).agg(F.count(F.lit(1)).alias("_c"), *cols)
    lists = [F.array_join(F.array_sort(F.collect_list(F.when(F.col(kind) == k, F.col(name)))), separator).alias(k) for k in kinds]
    return once.groupBy(pub).agg(*lists, F.count(F.lit(1)).alias("n_names"), *([F.min("_r").alias("best_rank")] if rank else []))


def cross_reference(tools: DataFrame, pub: str, kind: str, name: str) -> DataFrame:
    """(pub, xref): `kind: a, b; kind: c`, all in order."""
    once = tools.where(F.col(pub).isNotNull() & F.col(kind).isNotNull() & F.col(name).isNotNull()).select(pub, kind, name).distinct()
    per = once.groupBy(pub, kind).agg(F.concat(F.col(kind), F.lit(": "), F.array_join(F.array_sort(F.collect_list(name)), ", ")).alias("_s"))
    return per.groupBy(pub).agg(F.array_join(F.array_sort(F.collect_list("_s")), "; ").alias("xref"))


def links(rows: DataFrame, resource: str, pub: str, usage: str, development: str = "Development") -> dict[str, DataFrame]:
    """Link tables: development rows, and usage rows, which development rows are too. Rows without a
    publication are left out; each pair comes once."""
    known = rows.where(F.col(pub).isNotNull() & F.col(resource).isNotNull())
    return {"usage": known.select(resource, pub).distinct(), "development": known.where(F.col(usage) == development).select(resource, pub).distinct()}


def indicators(df: DataFrame, key: str, items: str, values: list[str]) -> DataFrame:
    """A boolean column per listed value: whether the row's array holds it; false for null arrays."""
    return df.select(key, *(F.coalesce(F.array_contains(items, v), F.lit(False)).alias(f"has_{v.lower().replace(' ', '_')}") for v in values))


def aligned(a: DataFrame, b: DataFrame, fill: str = "") -> DataFrame:
    """UNION ALL with columns aligned by name, lacking text columns filled."""
    out = a.unionByName(b, allowMissingColumns=True)
    return out.na.fill(fill, [c for c, t in out.dtypes if t == "string" and (c not in a.columns or c not in b.columns)])


def first_per(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in order."""
    return keep_one(df, [key], order)
