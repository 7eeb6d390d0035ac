"""Joins whose left side may have keys that hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatella.functions import lineage


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Rows of a key up to which one task takes them all.
LEAST = 20_000


def hot_keys(df: DataFrame, keys: list[str], total: int, least: int = LEAST) -> DataFrame:
    """Keys with more than a quarter of a partition's fair share of ``total`` rows.

    At most 4 x shuffle partitions keys can have that share, so the result may be broadcast. Counting
    combines in the map tasks: a hot key shuffles one row per task.
    """
    share = max(least, total // (4 * partitions(df)))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hot_rows")).where(F.col("_hot_rows") > share).select(*keys)


def _plain(left: DataFrame, right: DataFrame, keys: list[str], how: str, condition: Column | None) -> DataFrame:
    on = F.lit(True) if condition is None else condition
    for k in keys:
        right = right.withColumnRenamed(k, f"_r_{k}")
        on = (F.col(k) == F.col(f"_r_{k}")) & on
    return left.join(right, on, how).drop(*(f"_r_{k}" for k in keys))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, total: int, condition: Column | None = None, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join on ``keys``; the left rows of hot keys are spread over as many salts as there are
    shuffle partitions, and the right rows of those keys (only) repeated for each salt.

    how: inner, left, left_semi or left_anti. total: the left side's row count or an upper bound.
    condition: more conditions; it may name any column of both sides, which must not clash beyond
    ``keys``. hot: the hot keys of the left side, where the caller has counted them anyway. No row is dropped or sampled; rows with null keys match nothing, as in SQL.
    """
    salts = partitions(left)
    if hot is None:
        if total <= LEAST:  # no key can be hot
            return _plain(left, right, keys, how, condition)
        # counted once and kept: both sides need the few keys
        hot = lineage.cut(hot_keys(left, keys, total))
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    rest = [F.col(f"`{c}`") for c in left.columns]
    tagged = left.join(hot, keys, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int")).otherwise(0)).drop("_hot")
    spread = right.join(hot, keys, "left").withColumn("_rsalt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    for k in keys:
        spread = spread.withColumnRenamed(k, f"_r_{k}")
    on = F.col("_salt") == F.col("_rsalt")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    if condition is not None:
        on = on & condition
    return tagged.join(spread, on, how).drop("_salt", "_rsalt", *(f"_r_{k}" for k in keys))
