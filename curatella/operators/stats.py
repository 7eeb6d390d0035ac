"""Aggregations, pivots, histograms, top-k and completion reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curatella.functions import skew
from curatella.functions.blank import is_filled


def summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, mean, median, min, max and sample deviation per group; null groups are left out, a group of
    one has a null deviation."""
    v = F.col(value)
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.min(v).alias("min"), F.max(v).alias("max"), F.stddev_samp(v).alias("sd"))


def counts_by(df: DataFrame, group: str, category: str, values: list[str], prefix: str = "n_") -> DataFrame:
    """Group x category counts; the categories are listed, so absent ones are 0 and the schema is fixed."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(*(F.count(F.when(F.col(category) == v, 1)).alias(prefix + v.lower().replace(" ", "_").replace("-", "_")) for v in values))


def row_shares(df: DataFrame, group: str, category: str, values: list[str]) -> DataFrame:
    """counts_by in per cent of the group's rows with a category; null for groups without any."""
    all_ = F.count(F.col(category))
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(*(F.try_divide(F.count(F.when(F.col(category) == v, 1)) * 100.0, all_).alias("pct_" + v.lower().replace(" ", "_")) for v in values))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """(bin from 1, n) of equal-width bins between the extremes; the maximum belongs to the last bin.

    The two extremes are a scalar subquery; nulls are left out; with one distinct value all is in bin 1.
    """
    v = F.col(value)
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    own = F.when(hi > lo, F.least(F.lit(bins), F.floor((v - lo) / ((hi - lo) / bins)).cast("int") + 1)).otherwise(1)
    return df.where(v.isNotNull()).groupBy(own.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def extreme_k(df: DataFrame, value: str, k: int, keys: list[str], largest: bool) -> DataFrame:
    """The k rows of the largest or smallest values, ties in order of the keys; nulls never among them."""
    order = F.col(value).desc() if largest else F.col(value).asc()
    return df.where(F.col(value).isNotNull()).orderBy(order, *keys).limit(k)


def top_values(df: DataFrame, key: str, value: str, k: int = 3) -> DataFrame:
    """(key, top): the k most frequent values of each key as `value(count), ...`, ties in order of value.

    Counts come first, so a key's window holds its distinct values, not its rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("c"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("c"), value))
    best = counts.withColumn("r", rank).where(F.col("r") <= k)
    items = F.sort_array(F.collect_list(F.struct("r", F.concat(F.col(value), F.lit("("), F.col("c").cast("string"), F.lit(")")).alias("s"))))
    return best.groupBy(key).agg(F.array_join(F.transform(items, lambda x: x["s"]), ", ").alias("top"))


def completion(df: DataFrame, group: str, columns: list[str], filled=is_filled) -> DataFrame:
    """(group, field, n, n_filled, pct) for every column, from one aggregation that is unpivoted after."""
    wide = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *(F.count(F.when(filled(F.col(f"`{c}`").cast("string")), 1)).alias(f"_{c}") for c in columns))
    long = wide.select(group, "n", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"`_{c}`").alias("n_filled")) for c in columns))).alias("x"))
    return long.select(group, "x.field", "n", "x.n_filled", F.round(F.col("x.n_filled") * 100 / F.col("n"), 1).alias("pct"))


def facets(df: DataFrame, columns: list[str], least: int = 5, most: int = 100, separator: str = r"\s*,\s*") -> DataFrame:
    """(field, n_values, n_rows) of columns whose comma-separated values have between least and most
    distinct ones: what would serve as a facet."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("cell")) for c in columns))).alias("x")).select("x.*")
    values = long.where(is_filled(F.col("cell"))).select("field", F.explode(F.split("cell", separator)).alias("v")).where(F.trim("v") != "")
    per = values.groupBy("field", F.trim("v").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    return per.groupBy("field").agg(F.count(F.lit(1)).alias("n_values"), F.sum("c").alias("n_rows")).where(F.col("n_values").between(least, most))


def coverage(members: DataFrame, group: str, key: str, linked: DataFrame, linked_key: str) -> DataFrame:
    """Distinct keys of each group, those among the linked keys, the rest, and the linked per cent."""
    have = members.select(group, key).distinct().join(linked.select(F.col(linked_key).alias(key), F.lit(1).alias("_l")).distinct(), key, "left")
    return have.groupBy(group).agg(F.count(F.lit(1)).alias("n_keys"), F.count("_l").alias("n_linked"), (F.count(F.lit(1)) - F.count("_l")).alias("n_unlinked"), F.round(F.count("_l") * 100 / F.count(F.lit(1)), 1).alias("pct_linked"))


def ordered_distinct(value: str, order: list[str], separator: str = " | ") -> Column:
    """Distinct values of a group in order of first occurrence, joined; for use in agg."""
    rows = F.sort_array(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_v")))))
    return F.array_join(F.array_distinct(F.transform(rows, lambda r: r["_v"])), separator)


def listed(df: DataFrame, keys: list[str], value: str, order: list[str], most: int = 5) -> DataFrame:
    """(keys, listed): the first values of each group in order, `... (n more)` for the rest.

    Groups are cut into salts, of each of which only the first values go on, so that no group is brought
    together however large it is.
    """
    salt = F.pmod(F.xxhash64(*order, value), F.lit(skew.partitions(df))).cast("int")
    part = df.select(*keys, F.struct(*order, F.col(value).alias("_v")).alias("_x"), salt.alias("_s")).groupBy(*keys, "_s").agg(F.slice(F.sort_array(F.collect_list("_x")), 1, most).alias("_l"), F.count(F.lit(1)).alias("_n"))
    both = part.groupBy(*keys).agg(F.slice(F.sort_array(F.flatten(F.collect_list("_l"))), 1, most).alias("_l"), F.sum("_n").alias("_n"))
    head = F.array_join(F.transform("_l", lambda r: r["_v"]), ", ")
    return both.select(*keys, F.when(F.col("_n") > most, F.concat(head, F.lit(" ... ("), (F.col("_n") - most).cast("string"), F.lit(" more)"))).otherwise(head).alias("listed"))


def missing_counts(df: DataFrame, group: str, column: str, separator: str = ";") -> DataFrame:
    """(group, field, n): how often each field is named in a separated list of missing ones, blanks aside."""
    names = df.select(group, F.explode(F.split(F.col(column), separator)).alias("field")).select(group, F.trim("field").alias("field"))
    return names.where(F.col("field") != "").groupBy(group, "field").agg(F.count(F.lit(1)).alias("n"))


def first_filled(value: str, order: Column) -> Column:
    """First non-null value of a group in an explicit order; for use in agg."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), order))


def cut_at(df: DataFrame, k: int, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The first k rows in order, and the rest: a work cap and what it defers. The first k come from a
    top-k, the rest from an anti join with them; no global sort of the rest takes place."""
    head = df.orderBy(*order).limit(k)
    return head, df.join(head.select(*order), order, "left_anti")


def eligible_cap(df: DataFrame, eligible: Column, k: int, order: list[str]) -> DataFrame:
    """Rows that aren't eligible, and the first k that are: only eligible rows use up the cap."""
    may = F.coalesce(eligible, F.lit(False))
    return df.where(~may).unionByName(df.where(may).orderBy(*order).limit(k))


def safe_limit(seconds_per_item: float, parallel: int, minutes: int = 360, margins: int = 40) -> int:
    """Items that fit into a run: the minutes without margins over the time of an item."""
    return int((minutes - margins) * 60 / (seconds_per_item / parallel))
