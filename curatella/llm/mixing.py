"""Mixing sources to target weights by systematic sampling.

Every document of a source has an expected number of copies. Running through the source in a fixed
pseudo-random order, the expected copies are summed up, one random offset is added, and the document is
emitted once for each integer boundary that its own part of the sum crosses. The sum is taken in two
levels (buckets of hashed ids, then documents within a bucket), so no task holds a whole source.
"""

from __future__ import annotations

import math
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curatella.functions import lineage, skew

#: Whole-number parts of an expected copy, of which sums are exact in any order: the finest that a sum over
#: all documents of a source can hold.
FINEST, LARGEST_SUM = 1 << 40, 1 << 61
#: Documents of a bucket, on average at most; bounds what a window sorts in one task.
BUCKET = 50_000
#: Sources of the plan that are brought together in the driver; more are planned where they lie.
IN_DRIVER = 10_000


def units(rate: float, docs: int) -> tuple[int, int]:
    """(parts of a document, parts of a copy): their ratio is the rate, never above it by rounding, and
    the parts of all documents of the source stay within LARGEST_SUM. However low the rate, a document
    has a part at least; a rate of whole copies is met exactly."""
    most = max(1, min(FINEST, LARGEST_SUM // max(1, docs)))
    if rate >= 1:
        copy = max(1, most // math.ceil(rate))
        return math.floor(Fraction(rate) * copy), copy
    copy = min(LARGEST_SUM, math.ceil(most / Fraction(rate)))
    return max(1, math.floor(Fraction(rate) * copy)), copy


def plan_mix(sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None, fill: bool = False) -> tuple[dict[str, float], float]:
    """Expected copies of each document by source, and the size planned.

    sizes: tokens at hand; targets: (share, most repeats). Sources that have no tokens, and shares of 0
    or less, are left out and the other shares scaled to 1. total None: the largest size at which every
    source reaches its share within its repeats. A larger total caps sources at their repeats and gives
    what they lack to the others in proportion, as far as their repeats allow. fill: where that largest
    size is less than all tokens at hand, the total is those, so that a scarce source can't shrink the mix.
    """
    open_ = {s: t for s, t in targets.items() if t[0] > 0 and t[1] > 0 and sizes.get(s, 0) > 0}
    if not open_:
        return {}, 0.0
    whole = sum(t[0] for t in open_.values())
    if total is None:
        total = min(t[1] * sizes[s] * whole / t[0] for s, t in open_.items())
        if fill:
            total = max(total, sum(sizes[s] for s in open_))
    copies: dict[str, float] = {}
    left = float(total)
    while open_:
        whole = sum(t[0] for t in open_.values())
        full = {s: t for s, t in open_.items() if left * t[0] / whole > t[1] * sizes[s] * (1 + 1e-12)}
        if not full:
            copies |= {s: left * t[0] / whole / sizes[s] for s, t in open_.items()}
            break
        for s, t in full.items():
            copies[s] = float(t[1])
            left -= t[1] * sizes[s]
            del open_[s]
    return copies, sum(copies[s] * sizes[s] for s in copies)


def clean_targets(targets: DataFrame, source: str = "source", share: str = "target_share", repeats: str = "max_repeats") -> DataFrame:
    """(source, target_share, max_repeats); rows with a null are left out, of a repeated source the first in
    order of share and repeats counts."""
    rows = targets.select(F.col(source).alias("source"), F.col(share).cast("double").alias("target_share"), F.col(repeats).cast("int").alias("max_repeats")).dropna()
    return rows.groupBy("source").agg(F.min(F.struct("target_share", "max_repeats")).alias("_t")).select("source", "_t.*")


def plan_where_it_lies(sized: DataFrame, total: float | None = None, fill: bool = False) -> DataFrame:
    """plan_mix for sources (source, target_share, max_repeats, tokens) too many for the driver: the same
    rates as column ``rate``, 0 for sources that are left out.

    A source stops at its repeats if the level (size over share) at which it would is below that of all
    the others; the level rises until it stays, and each round is one aggregate over the sources.
    """
    open_ = (F.col("target_share") > 0) & (F.col("max_repeats") > 0) & (F.col("tokens") > 0)
    room = F.col("max_repeats") * F.col("tokens").cast("double")
    own = lineage.cut(sized.withColumn("_stop", F.when(open_, room / F.col("target_share"))))
    live = own.where(F.col("_stop").isNotNull())
    whole, least, have = live.agg(F.sum("target_share"), F.min("_stop"), F.sum("tokens")).first()
    if whole is None:
        return own.withColumn("rate", F.lit(0.0)).drop("_stop")
    if total is None:
        total = least * whole
        if fill:
            total = max(total, float(have))
    level, full = total / whole, F.lit(False)
    while True:
        full = F.col("_stop") < level * (1 - 1e-12)
        spent, rest = live.agg(F.coalesce(F.sum(F.when(full, room)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("target_share"))), F.lit(0.0))).first()
        now = (total - spent) / rest if rest > 0 else float("inf")
        if now <= level * (1 + 1e-12):
            break
        level = now
    rate = F.when(F.col("_stop").isNull(), 0.0).when(F.col("_stop") <= level, F.col("max_repeats").cast("double")).otherwise(level * F.col("target_share") / F.col("tokens"))
    return own.withColumn("rate", rate).drop("_stop")


def mix(sized: DataFrame, targets: DataFrame, key: str = "doc_id", total: float | None = None, seed: int = 42, fill: bool = False, in_driver: int = IN_DRIVER) -> tuple[DataFrame, DataFrame]:
    """(emitted, shares) of documents (key, source, n_tokens) by targets (source, target_share, max_repeats).

    emitted: (key, source, n_tokens, copy), one row per copy from 1. shares: one row per source of either
    table, the null source among them: target_share, max_repeats, docs and tokens at hand, copies and
    tokens emitted, actual_share, planned copies per document, shortfall (what actual_share lacks of
    target_share, 0 if nothing). total and fill: as plan_mix has them. Documents of unlisted or null source, and
    those without tokens, are not emitted. Repeated keys are documents of their own. The same seed gives
    the same mix whatever the partitioning. Of more than ``in_driver`` sources the rates are found where
    they lie, and hot sources are joined by salts.
    """
    sized = lineage.cut(sized.select(F.col(key), "source", "n_tokens"))
    spark = sized.sparkSession
    some = F.col("n_tokens") > 0
    have = lineage.cut(sized.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"), F.count(F.when(some, 1)).alias("_n")))
    at_hand = clean_targets(targets).join(have.select("source", "tokens", "_n"), "source", "left").na.fill(0, ["tokens", "_n"])
    at_hand = lineage.cut(at_hand)
    few = at_hand.count() <= in_driver
    if few:
        rows = at_hand.collect()
        rates, _ = plan_mix({r["source"]: r["tokens"] for r in rows}, {r["source"]: (r["target_share"], r["max_repeats"]) for r in rows}, total, fill)
        planned = spark.createDataFrame([(r["source"], r["target_share"], r["max_repeats"], r["_n"], rates.get(r["source"], 0.0)) for r in rows], "source string, target_share double, max_repeats int, _n bigint, rate double")
    else:
        planned = lineage.cut(plan_where_it_lies(at_hand, total, fill).select("source", "target_share", "max_repeats", "_n", "rate"))
    parts = F.pandas_udf(lambda r, n: pd.DataFrame([units(x, int(k)) if x > 0 else (0, 1) for x, k in zip(r, n, strict=True)], columns=["units", "copy"], dtype="int64"), "units bigint, copy bigint")
    # a setting of few rows is worked out here, a long one in the executors
    plan = spark.createDataFrame([(*r, *(units(r["rate"], r["_n"]) if r["rate"] > 0 else (0, 1))) for r in planned.collect()], "source string, target_share double, max_repeats int, _n bigint, rate double, _units bigint, _one bigint") if few else lineage.cut(planned.withColumn("_p", parts("rate", "_n")).select("*", F.col("_p.units").alias("_units"), F.col("_p.copy").alias("_one")).drop("_p"))
    total_docs = at_hand.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    buckets = max(skew.partitions(sized), math.ceil(total_docs / BUCKET))
    live = plan.where(F.col("_units") > 0).select("source", "_units", "_one")
    listed = sized.where(some & F.col("source").isNotNull())
    docs = listed.join(F.broadcast(live), "source") if few else skew.salted_join(listed, live, ["source"], "inner", total_docs)
    docs = docs.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))).withColumn("_b", F.pmod("_h", F.lit(buckets)).cast("int"))
    sums = docs.groupBy("source", "_b").agg(F.sum("_units").alias("_s"))
    ahead = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("_src"), F.col("_b").alias("_bb"), F.coalesce(F.sum("_s").over(ahead), F.lit(0)).alias("_base"))
    within = Window.partitionBy("source", "_b").orderBy("_h", key, "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    docs = docs.withColumn("_end", F.sum("_units").over(within)).join(sums, (F.col("source") == F.col("_src")) & (F.col("_b") == F.col("_bb")))
    offset = F.pmod(F.xxhash64("source", F.lit(seed)), F.col("_one"))
    # whole division of longs: a double could not tell the boundaries apart
    n = (F.expr("(_base + _end + _off) div _one") - F.expr("(_base + _end + _off - _units) div _one")).cast("int")
    copies = docs.withColumn("_off", offset).select(key, "source", "n_tokens", n.alias("_n")).where(F.col("_n") > 0)
    emitted = copies.select(key, "source", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))
    out = copies.groupBy("source").agg(F.sum("_n").alias("copies"), F.sum(F.col("_n") * F.col("n_tokens")).alias("tokens_out"))
    settings = plan.select(F.col("source").alias("_src"), "target_share", "max_repeats", F.col("rate").alias("copies_per_doc"))
    every = have.drop("_n").join(settings, F.col("source").eqNullSafe(F.col("_src")), "full").withColumn("source", F.coalesce("source", "_src")).drop("_src")
    shares = every.join(out.withColumnRenamed("source", "_src"), F.col("source") == F.col("_src"), "left").drop("_src")
    shares = shares.na.fill(0, ["docs", "tokens", "copies", "tokens_out"])
    shares = shares.withColumn("actual_share", F.try_divide("tokens_out", out.agg(F.sum("tokens_out")).scalar()))
    lack = F.col("target_share") - F.coalesce("actual_share", F.lit(0.0))
    shares = shares.withColumn("shortfall", F.when(F.col("target_share").isNotNull(), F.greatest(lack, F.lit(0.0))))
    return emitted, shares
