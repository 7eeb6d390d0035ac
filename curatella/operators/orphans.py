"""References to records that do not exist when the reference is made.

A broadcast Bloom filter of the parent keys (several, by shards of the keys, where they are many) proves
definite orphans without any shuffle; only the filter-positive references go through an exact join with the parents' periods of validity, whose
intervals are merged first and whose hot keys are salted. Reports aggregate with map-side combine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curatella.functions import blank, bloom, skew

# The bounds that stand for "always" and "still".
ALWAYS, STILL = "0001-01-01 00:00:00", "9999-12-31 23:59:59.999999"


@dataclass(frozen=True)
class Parent:
    """Target of a reference: its table, key, and columns of the period in which a row holds (or None)."""

    df: DataFrame
    key: str
    since: str | None = None
    until: str | None = None


def key_of(col):
    """Ids compare without regard to case and surrounding white space; blank ids are null."""
    return F.when(~blank.is_blank(col), F.lower(blank.strip(col)))


def periods(parent: Parent, kind: str = "timestamp_ntz") -> DataFrame:
    """(_pkey, _from, _to): disjoint periods in which at least one row of the key holds.

    Null since is always, null until is still. Equal starts collapse in the map tasks; rows that never
    hold (until <= since) vanish. The window over a key keeps one running maximum and spills.
    """
    since = F.col(f"`{parent.since}`") if parent.since else F.lit(None)
    until = F.col(f"`{parent.until}`") if parent.until else F.lit(None)
    rows = parent.df.select(
        key_of(F.col(f"`{parent.key}`")).alias("_pkey"),
        F.coalesce(since.cast(kind), F.lit(ALWAYS).cast(kind)).alias("_from"),
        F.coalesce(until.cast(kind), F.lit(STILL).cast(kind)).alias("_to"),
    ).where(F.col("_pkey").isNotNull() & (F.col("_from") < F.col("_to")))
    rows = rows.groupBy("_pkey", "_from").agg(F.max("_to").alias("_to"))
    before = Window.partitionBy("_pkey").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("_pkey").orderBy("_from").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.coalesce(F.max("_to").over(before) < F.col("_from"), F.lit(True))
    rows = rows.withColumn("_first", first.cast("int")).withColumn("_island", F.sum("_first").over(upto))
    return rows.groupBy("_pkey", "_island").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to")).drop("_island")


def references(df: DataFrame, src_table: str, link_id: str, fields: list[str], at: str, kind: str = "timestamp_ntz") -> DataFrame:
    """One row per link and reference field: (src_table, link_id, field_name, _key, _at), _key null if blank."""
    each = F.array(*(F.struct(F.lit(f).alias("field_name"), key_of(F.col(f"`{f}`")).alias("_key")) for f in fields))
    return df.select(F.lit(src_table).alias("src_table"), F.col(f"`{link_id}`").alias("link_id"), F.col(f"`{at}`").cast(kind).alias("_at"), F.explode(each).alias("_r")).select("src_table", "link_id", "_r.field_name", "_r._key", "_at")


def find_orphans(refs: DataFrame, parents: dict[str, Parent], total: int, use_filter: bool = True) -> DataFrame:
    """References that aren't blank and for whose id no parent row holds at ``_at``.

    refs: of ``references``; parents: by field_name; total: an upper bound of the rows of refs.
    Blank references are no orphans. A reference without a date is an orphan only if its id never
    exists. Repeated references stay repeated. A parent table without rows makes every reference an
    orphan. Extra columns of the inputs are ignored.
    """
    refs = refs.where(F.col("_key").isNotNull())
    known = None
    for field, parent in parents.items():
        own = periods(parent).withColumn("_field", F.lit(field))
        known = own if known is None else known.unionByName(own)
    if use_filter:
        keys = None
        for field, parent in parents.items():
            own = parent.df.select(F.lit(field).alias("_field"), key_of(F.col(f"`{parent.key}`")).alias("_k"))
            keys = own if keys is None else keys.unionByName(own)
        refs = bloom.sift(refs, ["field_name", "_key"], keys, ["_field", "_k"], sum(bloom.distinct_keys(p.df, [p.key]) for p in parents.values()))
    else:
        refs = refs.withColumn("_maybe", F.lit(True))
    keep = ["src_table", "link_id", "field_name", "_at"]
    definite = refs.where(~F.col("_maybe")).select(*keep)
    positive = refs.where("_maybe").drop("_maybe").withColumnRenamed("_key", "_pkey").withColumn("_field", F.col("field_name"))
    holds = F.col("_at").isNull() | ((F.col("_from") <= F.col("_at")) & (F.col("_at") < F.col("_to")))
    verified = skew.salted_join(positive, known, ["_pkey", "_field"], "left_anti", total, holds).select(*keep)
    return definite.unionByName(verified)


def orphan_report(refs: DataFrame, orphans: DataFrame) -> DataFrame:
    """Per table, field and month of the link: references that aren't blank, orphans among them, rate.

    Both inputs are combined in the map tasks before the shuffle; a month without orphans has 0.
    """
    month = F.date_format("_at", "yyyy-MM").alias("month")
    part = lambda df, n, o: df.groupBy("src_table", "field_name", month).agg(F.count(F.lit(1)).alias("_c")).select("src_table", "field_name", "month", (F.col("_c") * n).alias("_n"), (F.col("_c") * o).alias("_o"))
    both = part(refs.where(F.col("_key").isNotNull()), 1, 0).unionByName(part(orphans, 0, 1))
    return both.groupBy("src_table", "field_name", "month").agg(F.sum("_n").alias("n_refs"), F.sum("_o").alias("n_orphans")).withColumn("orphan_rate", F.col("n_orphans") / F.col("n_refs"))
