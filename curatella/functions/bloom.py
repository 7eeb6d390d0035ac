"""Bloom filters in the JVM: built by partial aggregation, tested inside whole-stage code.

Spark has both expressions (its runtime filters use them) but no SQL name for them, so they are
reached through the classic session. A set of any size is sharded by hash into filters of bounded size; a
value is tested against the filter of its own shard only. Where the shards outgrow what one task may hold,
they are tested in passes, each of which reads only the values of its own shards.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatella.functions import lineage

#: Spark caps a filter at 2**26 bits (8 MB).
MAX_BITS = 1 << 26
#: Filters that one pass sends to the executors: 64 MB at most.
SHARDS = 8
#: Tasks that build a large filter; each sends its whole filter to the one that merges them.
BUILDERS = 16


def bits_for(items: int, fpp: float = 0.03) -> int:
    """Bits for a filter of so many items at the false-positive rate."""
    return max(1024, math.ceil(-max(1, items) * math.log(fpp) / math.log(2) ** 2))


def distinct_keys(keys: DataFrame, columns: list[str]) -> int:
    """An estimate of the distinct keys, for the size of a filter.

    The row count (of a Parquet table, its footers') will do while one filter is enough; beyond that copies
    are told apart by HyperLogLog. Too low an estimate raises the false-positive rate, nothing else.
    """
    rows = keys.count()
    if bits_for(rows) <= MAX_BITS:
        return rows
    return math.ceil(1.1 * keys.agg(F.approx_count_distinct(F.xxhash64(*columns), 0.02)).first()[0])


def _classic(spark):
    try:
        from pyspark.sql.classic.column import Column as Classic

        utils = spark._jvm.org.apache.spark.sql.classic.ExpressionUtils
        return Classic, utils, spark._jvm.org.apache.spark.sql.catalyst.expressions
    except (ImportError, AttributeError, TypeError) as e:
        raise RuntimeError("Bloom filters need a classic Spark session") from e


def sift(df: DataFrame, value: list[str], keys: DataFrame, key: list[str], items: int | None = None, fpp: float = 0.03, shard_bits: int = MAX_BITS, shards_a_pass: int = SHARDS) -> DataFrame:
    """df with the boolean ``_maybe``, false only where the value is surely not among the keys.

    value, key: columns of df and of keys, in the same order and of the same types. keys may hold a key
    several times; a null key holds nothing, and a null value is never among the keys. items: distinct
    keys, as distinct_keys tells if not given. No row of df is dropped, whatever the size of the set. The
    set's filters are tested in one pass over df if shards_a_pass of shard_bits bits hold it; otherwise in
    several, cut off by checkpoints, which together read df once and its checkpoint once a pass.
    """
    classic, utils, catalyst = _classic(df.sparkSession)
    expr, column = utils.expression, lambda e: classic(utils.column(e))
    long = lambda n: expr(F.lit(n).cast("long")._jc)
    real = lambda names: functools.reduce(lambda a, b: a & b, (F.col(f"`{c}`").isNotNull() for c in names))
    keys = keys.where(real(key))
    items = distinct_keys(keys, key) if items is None else items
    bits = bits_for(items, fpp)
    shards = math.ceil(bits / shard_bits)
    hashed = keys.select(F.xxhash64(*(F.col(f"`{c}`") for c in key)).alias("_h"))
    shard = lambda h: F.pmod(F.xxhash64(h, F.lit(7)), F.lit(shards)).cast("int")
    each = math.ceil(items / shards * (1.02 if shards > 1 else 1))

    def maybe(i: int) -> Column:
        own = hashed.where(shard(F.col("_h")) == i) if shards > 1 else hashed
        if bits > 1 << 20:
            own = own.repartition(BUILDERS)
        build = catalyst.aggregate.BloomFilterAggregate(expr(F.col("_h")._jc), long(max(1, each)), long(min(shard_bits, bits_for(each, fpp))))
        one = own.agg(column(build.toAggregateExpression()).alias("_bloom"))
        return F.coalesce(column(catalyst.BloomFilterMightContain(expr(one.scalar()._jc), expr(F.col("_vh")._jc))), F.lit(False))

    def tested(rows: DataFrame, which: range) -> DataFrame:
        if shards == 1:
            test = maybe(0)
        else:
            test = F.lit(False)
            for i in which:
                test = F.when(F.col("_shard") == i, maybe(i)).otherwise(test)
        return rows.withColumn("_maybe", F.col("_vh").isNotNull() & test).drop("_vh", "_shard")

    rows = df.withColumn("_vh", F.when(real(value), F.xxhash64(*(F.col(f"`{c}`") for c in value)))).withColumn("_shard", F.coalesce(shard(F.col("_vh")), F.lit(0)))
    if shards <= shards_a_pass:
        return tested(rows, range(shards))
    rows, out = lineage.cut(rows), None
    for start in range(0, shards, shards_a_pass):
        which = range(start, min(shards, start + shards_a_pass))
        own = lineage.cut(tested(rows.where(F.col("_shard").between(which.start, which.stop - 1)), which))
        out = own if out is None else out.unionByName(own)
    return out
