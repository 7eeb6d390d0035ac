"""Best representative of each group of duplicate records.

Groups: records of one entity and one publication number; records without a number join the records
whose text equals or continues their own. Candidate pairs come from an equi-join on text prefixes of
2^k characters; a Bloom filter of the wanted prefixes lets only fitting texts into the shuffle.

Survivor: fields that depend on each other form bundles, and a bundle is taken whole from one record.
The choice maximises trust under functional dependencies between bundles by branch and bound, run for
all groups at once: the root's bound is each bundle's best; where the bundles at the bound agree, they are
the optimum; only the groups where they don't are branched by the determinant, and branches whose bound
is below the best found are cut. All of it aggregates structs with map-side combine, a row per group and
determinant, so no group is ever brought together in a task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatella.functions import blank, bloom, lineage, skew

#: Prefix lengths of the ladder; a text is looked up under the longest that it fills.
LADDER = tuple(1 << k for k in range(13))


@dataclass(frozen=True)
class Shape:
    """Which columns play which part; filled columns count for keeping, bundles for merging."""

    key: str = "sp_id"
    entity: str = "resourceId"
    number: str = "_pmid"
    text: str = "_context"
    modified: str = "_modified"
    source: str = "_source"
    confidence: str = "_confidence"
    filled: tuple[str, ...] = ("_pmid", "_doi", "_publicationTitle", "_year", "_usageType", "_context", "_fundingAgency")
    #: the determining bundle, the one it determines (doi -> title, year), and the free ones
    head: tuple[str, ...] = ("_pmid", "_doi")
    determinant: str = "_doi"
    tail: tuple[str, ...] = ("_publicationTitle", "_year")
    free: tuple[tuple[str, ...], ...] = (("_usageType",), ("_fundingAgency",))


MENTIONS = Shape()

# Trust in records whose confidence is told in words.
TRUST = {"certain": 1.0, "high": 0.9, "medium": 0.6, "moderate": 0.6, "low": 0.3}
#: Trust in records that tell none.
UNTOLD = 0.5


def number_of(col: Column) -> Column:
    """The publication number in a value, however written: its first digits without leading zeros."""
    digits = F.regexp_extract(F.translate(col, "０１２３４５６７８９", "0123456789"), r"(\d+)", 1)
    return F.when(~blank.is_blank(col) & (digits != ""), F.coalesce(F.nullif(F.ltrim(digits, F.lit("0")), F.lit("")), F.lit("0")))


def compact(col: Column) -> Column:
    """Lower case without any white space; null where blank."""
    return F.when(~blank.is_blank(col), F.translate(F.lower(col), blank.SPACE, ""))


def weight(confidence: Column, source: Column, trust: dict[str, float] | None = None, words: dict[str, float] = TRUST) -> Column:
    """Trust in a record in thousandths, from 1 to 1001: its confidence as a number from 0 to 1 or a word of
    ``words``, UNTOLD otherwise, times the trust in its source (``trust``, by name; 1 for others)."""
    table = lambda d, k: F.try_element_at(F.create_map(*(F.lit(x) for kv in d.items() for x in kv)), k)
    number = blank.strip(confidence).try_cast("double")
    told = F.coalesce(F.when(number.between(0, 1), number), table(words, F.lower(blank.strip(confidence))), F.lit(UNTOLD))
    return (1 + F.round(1000 * told * (F.coalesce(table(trust, source), F.lit(1.0)) if trust else F.lit(1.0)))).cast("bigint")


def features(df: DataFrame, shape: Shape = MENTIONS, trust: dict[str, float] | None = None) -> DataFrame:
    """What grouping and choosing look at, of each record: _k, _e (entity), _at, _w (trust), _num, _txt
    (null unless it may be looked at for grouping), _loose, _len (of the text, white space collapsed), _det
    (hash of the determinant), _n_keep, _n_head, _n_tail and _n_free1, ... (filled fields). Other columns of
    df are ignored; fields of these names don't clash."""
    c = lambda name: F.col(f"`{name}`")
    parts = dict.fromkeys((*shape.filled, *shape.head, *shape.tail, *(x for own in shape.free for x in own)))
    every = list(dict.fromkeys((shape.key, shape.entity, shape.number, shape.text, shape.modified, shape.source, shape.confidence, shape.determinant, *parts)))
    have = set(df.columns)
    raw = df.select(*(c(x).alias(f"_f{i}") if x in have else F.lit(None).cast("string").alias(f"_f{i}") for i, x in enumerate(every)))
    f = lambda name: F.col(f"_f{every.index(name)}")
    raw = raw.withColumns({f"_b{every.index(x)}": (~blank.is_blank(f(x))).cast("int") for x in dict.fromkeys((*parts, shape.number, shape.text, shape.determinant))})
    b = lambda name: F.col(f"_b{every.index(name)}")
    filled = lambda cols: sum((b(x) for x in cols), F.lit(0))
    det = F.when(b(shape.determinant) == 1, F.xxhash64(F.lower(blank.strip(f(shape.determinant)))))
    return raw.select(
        f(shape.key).alias("_k"), f(shape.entity).alias("_e"), f(shape.modified).alias("_at"), weight(f(shape.confidence), f(shape.source), trust).alias("_w"),
        number_of(f(shape.number)).alias("_num"), compact(f(shape.text)).alias("_txt"), (b(shape.number) == 0).alias("_no_number"),
        F.when(b(shape.text) == 1, F.length(blank.squeeze(f(shape.text)))).alias("_len"), det.alias("_det"),
        filled(shape.filled).alias("_n_keep"), filled(shape.head).alias("_n_head"), filled(shape.tail).alias("_n_tail"), *(filled(own).alias(f"_n_free{i}") for i, own in enumerate(shape.free, 1)),
    )


def assign(df: DataFrame, shape: Shape = MENTIONS, trust: dict[str, float] | None = None) -> DataFrame:
    """``features`` without texts, with _gkey: equal within an entity for the records of one group, null for
    records that stand alone.

    Records with a number: the number. Records with a blank number: the number of the records of their
    entity whose text equals or starts with theirs (of several numbers, that of the smallest key); without
    such, the longest blank-numbered text that does, themselves included. Stand alone: records without
    entity, with a number that has no digits, or with neither number nor text.
    """
    df = features(df, shape, trust)
    loose_row = F.col("_no_number") & F.col("_txt").isNotNull() & F.col("_e").isNotNull()
    rung = lambda t: F.greatest(*(F.when(F.length(t) >= n, F.lit(n)).otherwise(0) for n in LADDER))
    lone = lineage.cut(df.where(loose_row))
    bound = lone.count()
    loose = lone.groupBy("_e", F.col("_txt").alias("_t")).agg(F.min("_k").alias("_k")).withColumn("_n", rung(F.col("_t")))
    loose = lineage.cut(loose.withColumn("_p", F.xxhash64("_e", "_n", F.expr("substring(_t, 1, _n)"))))
    texts = df.where(F.col("_txt").isNotNull() & F.col("_e").isNotNull() & (F.col("_num").isNotNull() | F.col("_no_number")))
    rungs = texts.select("_e", F.col("_txt").alias("_ct"), F.col("_num").alias("_cn"), F.col("_k").alias("_ck"), F.explode(F.filter(F.array(*(F.lit(n) for n in LADDER)), lambda n: n <= F.length("_txt"))).alias("_n"))
    rungs = rungs.withColumn("_p", F.xxhash64("_e", "_n", F.expr("substring(_ct, 1, _n)")))
    rungs = bloom.sift(rungs, ["_p"], loose, ["_p"], bound).where("_maybe").drop("_maybe")
    rungs = lineage.cut(rungs.groupBy("_e", "_n", "_p", "_ct", "_cn").agg(F.min("_ck").alias("_ck")))
    # many texts of an entity may begin alike
    pairs = skew.salted_join(rungs, loose.select("_e", "_n", "_p", "_t"), ["_p", "_e", "_n"], "inner", rungs.count(), F.expr("startswith(_ct, _t)"))
    # numbered texts first, then the longest text; ties go to the smallest key
    rank = F.struct(F.col("_cn").isNotNull(), F.when(F.col("_cn").isNull(), F.length("_ct")).otherwise(0), -F.col("_ck"))
    found = pairs.groupBy("_e", F.col("_t").alias("_txt")).agg(F.max_by(F.coalesce(F.concat(F.lit("n"), "_cn"), F.concat(F.lit("t"), F.md5(F.col("_ct")))), rank).alias("_gkey"))
    drop = ("_num", "_txt", "_no_number")
    numbered = df.where(~loose_row).withColumn("_gkey", F.when(F.col("_e").isNotNull(), F.concat(F.lit("n"), "_num"))).drop(*drop)
    return numbered.unionByName(skew.salted_join(lone, found, ["_e", "_txt"], "left", bound).drop(*drop))


def settle(assigned: DataFrame, shape: Shape = MENTIONS) -> DataFrame:
    """One row per group of two or more: (_e, _gkey, group_id, n_records, and keep_id, context_id, head_id,
    tail_id, free1_id, ...: the records whose bundles survive, -1 where no record fills the bundle).

    A bundle's trust is its filled fields times its record's weight, of equals the latest's, then that of
    the smallest key; null dates are oldest. Two bundles are bound to other measures: keep_id, the whole
    record, to its filled fields and the date, context_id, the text, to its length. head and tail have to
    agree: the tail's determinant is the head's, or one of them has none. Among the pairs that agree the one
    with the most trust is found by branch and bound on the determinant:

    - bound at the root: the best head and the best tail of any determinant. If they agree, it is reached.
    - branch: one determinant's best head, with the best tail of that determinant or of none. Heads without
      determinant are a branch that all tails agree with.
    - cut: branches whose head, even with the best tail of all, has less trust than the branch of the best
      head.
    """
    free = [f"free{i}" for i in range(1, len(shape.free) + 1)]
    k = (-F.col("_k")).alias("k")
    best = lambda n: F.max(F.when(F.col(n) > 0, F.struct((F.col(n) * F.col("_w")).alias("n"), F.col("_at").alias("at"), k, F.col("_det").alias("det"))))
    branches = assigned.where(F.col("_gkey").isNotNull()).groupBy("_e", "_gkey", "_det").agg(
        F.count(F.lit(1)).alias("_c"), F.min("_k").alias("_first"), F.max(F.struct(F.col("_n_keep").alias("n"), F.col("_at").alias("at"), k)).alias("_keep"),
        F.max(F.when(F.col("_len").isNotNull(), F.struct(F.col("_len").alias("n"), k))).alias("_context"), best("_n_head").alias("_head"), best("_n_tail").alias("_tail"), *(best(f"_n_{x}").alias(f"_{x}") for x in free),
    )
    branches = lineage.cut(branches)
    roles = ["keep", "context", *free]
    root = branches.groupBy("_e", "_gkey").agg(F.sum("_c").alias("n_records"), F.min("_first").alias("group_id"), F.max("_head").alias("_top"), F.max("_tail").alias("_roof"), *(F.max(f"_{x}").alias(f"_{x}") for x in roles)).where(F.col("n_records") > 1)
    root = lineage.cut(root.withColumn("_fits", F.col("_top.det").isNull() | F.col("_roof.det").isNull() | (F.col("_top.det") == F.col("_roof.det"))))
    torn = root.where(~F.col("_fits")).select("_e", "_gkey", "_top", "_roof")
    own = branches.join(torn, ["_e", "_gkey"])
    untied = own.where(F.col("_det").isNull()).select("_e", "_gkey", F.col("_tail").alias("_t0"))
    live = own.where(F.col("_head").isNotNull()).join(untied, ["_e", "_gkey"], "left").withColumn("_t", F.when(F.col("_det").isNull(), F.col("_roof")).otherwise(F.greatest("_tail", "_t0")))
    worth = F.col("_head.n") + F.coalesce(F.col("_t.n"), F.lit(0))
    floor = live.where(F.col("_det") == F.col("_top.det")).select("_e", "_gkey", worth.alias("_floor"))
    live = live.join(floor, ["_e", "_gkey"]).where(F.col("_head.n") + F.col("_roof.n") >= F.col("_floor"))
    pick = live.groupBy("_e", "_gkey").agg(F.max(F.struct(worth.alias("w"), F.col("_head").alias("h"), F.col("_t").alias("t"))).alias("_b"))
    done = root.join(pick, ["_e", "_gkey"], "left").withColumns({"_h": F.when(F.col("_fits"), F.col("_top")).otherwise(F.col("_b.h")), "_l": F.when(F.col("_fits"), F.col("_roof")).otherwise(F.col("_b.t"))})
    chosen = {"keep": "_keep", "context": "_context", "head": "_h", "tail": "_l"} | {x: f"_{x}" for x in free}
    # the whole outcome of the search is one value, of which callers take their parts
    done = done.withColumn("_chosen", F.array(*(F.coalesce(-F.col(f"{c}.k"), F.lit(-1)) for c in chosen.values())))
    return done.select("_e", "_gkey", "group_id", "n_records", *(F.get("_chosen", F.lit(i)).alias(f"{x}_id") for i, x in enumerate(chosen)))


def survivors(df: DataFrame, shape: Shape = MENTIONS, trust: dict[str, float] | None = None) -> DataFrame:
    """settle's ids with the surviving values: one record per group, each bundle from one record.

    A field that no record fills is null. Values are fetched by an equi-join on the chosen keys.
    """
    ids = lineage.cut(settle(assign(df, shape, trust), shape).drop("_e", "_gkey"))
    parts = {"head_id": shape.head, "tail_id": shape.tail, "context_id": (shape.text,)} | {f"free{i}_id": cols for i, cols in enumerate(shape.free, 1)}
    roles = F.array(*(F.struct(F.lit(r).alias("_role"), F.col(r).alias("_id")) for r in parts))
    wanted = ids.select("group_id", F.explode(roles).alias("_r")).select("group_id", "_r.*").where(F.col("_id") >= 0)
    cols = list(dict.fromkeys(c for own in parts.values() for c in own))
    values = df.select(F.col(f"`{shape.key}`").alias("_id"), *(F.when(~blank.is_blank(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) for c in cols))
    role_of = {c: r for r, own in parts.items() for c in own}
    flat = wanted.join(values, "_id").groupBy("group_id").agg(*(F.max(F.when(F.col("_role") == role_of[c], F.col(c))).alias(c) for c in cols))
    return ids.join(flat, "group_id", "left")
