"""Matching names to resources: synonym groups, lookup indexes, exact and fuzzy matches.

Fuzzy comparisons that SQL has no function for run in Arrow batches over candidate pairs that equi-joins
have found; no operator pairs all names with all names.
"""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curatella.functions import lineage, skew
from curatella.operators.reconcile import keep_one


def synonym_groups(df: DataFrame, key: list[str], name: str, order: list[str], most: int = 5) -> DataFrame:
    """(key, canonical, synonyms, n): the first name of each group in order, and up to ``most`` others.

    Distinct names are found before they are listed, so copies don't grow a group's list.
    """
    names = df.where(F.col(name).isNotNull()).groupBy(*key, name).agg(F.min(F.struct(*order)).alias("_o"), F.count(F.lit(1)).alias("_c"))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("_o", name))
    ranked = names.withColumn("_r", rank)
    firsts = F.sort_array(F.collect_list(F.when(F.col("_r") <= most + 1, F.struct("_r", name))))
    out = ranked.groupBy(*key).agg(firsts.alias("_l"), F.sum("_c").alias("n"))
    return out.select(*key, F.col("_l")[0][name].alias("canonical"), F.array_join(F.transform(F.slice("_l", 2, most), lambda x: x[name]), ", ").alias("synonyms"), "n")


def best_of_group(df: DataFrame, key: list[str], confidence: Column, usage_rank: Column, order: list[str]) -> DataFrame:
    """The row of each group with the highest confidence, then the best usage rank, then the first in
    order. Rows with a null or '' key stay apart, each its own group."""
    blank = F.lit(False)
    for k in key:
        blank = blank | F.coalesce(F.col(k) == "", F.lit(True))
    ranked = df.withColumn("_score", -F.coalesce(confidence.try_cast("double"), F.lit(0.0))).withColumn("_usage", usage_rank)
    best = keep_one(ranked.where(~blank), key, ["_score", "_usage", *order])
    return best.unionByName(ranked.where(blank)).drop("_score", "_usage")


def lookup_index(df: DataFrame, id_: str, name: str, synonyms: str | None, key, order: list[str], prefixes: str = r"^(?:human|mouse|rat)\s+") -> DataFrame:
    """(key, id): names, comma-separated synonyms and names without a leading prefix, the first in order
    wins. key: function of a name column to its key."""
    names = [F.col(name), F.regexp_replace(F.col(name), f"(?i){prefixes}", "")]
    rows = F.array(*(F.struct(F.lit(i).alias("_s"), n.alias("_n")) for i, n in enumerate(names)))
    if synonyms:
        rows = F.concat(rows, F.transform(F.coalesce(F.split(F.col(synonyms), r"\s*,\s*"), F.array().cast("array<string>")), lambda s: F.struct(F.lit(9).alias("_s"), s.alias("_n"))))
    each = df.select(F.col(id_).alias("id"), *order, F.explode(rows).alias("_x")).select("id", *order, "_x._s", key(F.col("_x._n")).alias("key"))
    return keep_one(each.where(F.col("key").isNotNull() & (F.col("key") != "")), ["key"], [*order, "_s", "id"]).select("key", "id")


def exact_match(mentions: DataFrame, name: str, kind: str, resources: DataFrame) -> DataFrame:
    """mentions with resource_id by lower-cased name and type, null if there is none; resources:
    (key, kind, id) with one row per key and type."""
    have = resources.select(F.col("key").alias("_k"), F.col("kind").alias("_t"), F.col("id").alias("resource_id"))
    return mentions.join(have, (F.lower(F.trim(name)) == F.col("_k")) & (F.col(kind) == F.col("_t")), "left").drop("_k", "_t")


def token_overlap(a: Column, b: Column) -> Column:
    """Common words over the larger number of words, separators and case aside; 0 for blank names."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.regexp_replace(c, r"[-_/.,;:()\s]+", " ")), " "), lambda w: w != ""))
    x, y = words(a), words(b)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)), F.greatest(F.size(x), F.size(y))), F.lit(0.0))


def _pairwise(a: Column, b: Column, score) -> Column:
    """score of lower-cased texts in Arrow batches; null if either is."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else score(p.lower(), q.lower()) for p, q in zip(x, y, strict=True)], dtype="float64")

    # called non-deterministic so that cheaper conditions are never merged with those on the score
    return run.asNondeterministic()(a, b)


def sequence_ratio(a: Column, b: Column, least: float = 0.0) -> Column:
    """Ratcliff-Obershelp similarity of lower-cased texts; 0 where a cheap upper bound is below ``least``."""

    def score(p: str, q: str) -> float:
        m = SequenceMatcher(None, p, q)
        return m.ratio() if not least or (m.real_quick_ratio() >= least and m.quick_ratio() >= least) else 0.0

    return _pairwise(a, b, score)


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def indel_ratio(a: Column, b: Column, least: float = 0.0) -> Column:
    """Twice the common subsequence over both lengths, of lower-cased texts; 1 for two empty ones."""
    return _pairwise(a, b, lambda p, q: 2 * common_length(p, q) / (len(p) + len(q)) if p or q else 1.0)


def _cuts(n: int, least: float) -> list[int]:
    """Borders of the segments of a text of n letters: one more than letters may be unmatched in it and any
    text as alike as ``least``."""
    longest = math.floor(n * (2 - least) / least + 1e-9)
    k = math.floor((1 - least) * (n + longest) + 1e-9) + 1
    return [n * i // k for i in range(k + 1)]


def _segments(text: str, least: float) -> list[str]:
    """Keys under which a text is found: its segments, with its length and their place."""
    ends = _cuts(len(text), least)
    return [f"{len(text)} {i} {text[s:e]}" for i, (s, e) in enumerate(zip(ends, ends[1:]))]


def _lookups(text: str, least: float) -> list[str]:
    """Keys by which a text finds all texts as alike as ``least``.

    Of la + lb letters at most d = (1 - least) (la + lb) are unmatched, so that one of the other text's
    d + 1 segments stands whole in this one, moved by no more than the unmatched letters before and behind it
    allow.
    """
    n, out = len(text), set()
    for size in range(math.ceil(n * least / (2 - least) - 1e-9), math.floor(n * (2 - least) / least + 1e-9) + 1):
        d = math.floor((1 - least) * (n + size) + 1e-9)
        ends = _cuts(size, least)
        for i, (s, e) in enumerate(zip(ends, ends[1:])):
            for move in range(-((d - (n - size)) // 2), (d + n - size) // 2 + 1):
                if 0 <= s + move and e + move <= n:
                    out.add(f"{size} {i} {text[s + move : e + move]}")
    return sorted(out)


def fuzzy_pairs(left: DataFrame, right: DataFrame, name: str, other: str, least: float = 0.85, score=sequence_ratio) -> DataFrame:
    """(name, other, score) of names at least so alike, over distinct names of both sides.

    Either ratio is 2 m / (len a + len b) with m letters matched in order. A name meets only those that hold
    one of its segments near the same place (see _lookups); pairs with too many edits are dropped in the
    JVM, and only the rest is scored. Nulls and blanks have no partners. ``least`` is more than 0.
    """
    a = left.select(F.col(name)).where(F.col(name).isNotNull() & (F.trim(name) != "")).distinct()
    b = right.select(F.col(other)).where(F.col(other).isNotNull() & (F.trim(other) != "")).distinct()
    a, b = lineage.cut(a), lineage.cut(b)
    n, m = a.count(), b.count()
    keyed = lambda df, c, f: df.repartition(skew.partitions(left)).select(c, F.explode(F.pandas_udf(lambda s: s.map(lambda x: f(x.lower(), least)), "array<string>").asNondeterministic()(c)).alias("_g")).select(c, F.xxhash64("_g").alias("_g"))
    # whoever is looked up has few keys, so the shorter list looks up; the relation is symmetric
    mine, found = keyed(a, name, _lookups if n <= m else _segments), keyed(b, other, _segments if n <= m else _lookups)
    mine = lineage.cut(mine)
    la, lb = F.length(F.lower(name)), F.length(F.lower(other))
    pairs = skew.salted_join(mine, found, ["_g"], "inner", mine.count()).select(name, other)
    # few bytes, but much to compute: a fixed number of partitions, and the edits after the duplicates went
    pairs = pairs.repartition(skew.partitions(left), name, other).groupBy(name, other).agg(F.count(F.lit(1)).alias("_c"))
    pairs = pairs.where(F.levenshtein(F.lower(name), F.lower(other)) <= (1 - F.lit(least)) * (la + lb) * F.least(F.col("_c"), F.lit(1)) + 1e-9).drop("_c")
    return pairs.withColumn("score", score(F.col(name), F.col(other), least)).where(F.col("score") >= least)


def best_match(pairs: DataFrame, name: str, other: str) -> DataFrame:
    """The best partner of each name, ties to the first in order."""
    return pairs.groupBy(name, "score").agg(F.min(other).alias(other)).groupBy(name).agg(F.max_by(other, "score").alias(other), F.max("score").alias("score"))


def categorise(ids: DataFrame, id_: str, names: DataFrame, name: str, synonyms: DataFrame, synonym: str, least_count: int = 2, least: float = 0.85) -> DataFrame:
    """(id_, n, category, match): exact name, exact synonym, fuzzy synonym or new, of ids that occur at
    least ``least_count`` times; stages run only on what the ones before left."""
    counts = ids.where(F.col(id_).isNotNull()).groupBy(id_).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count).withColumn("_k", F.lower(F.trim(id_)))
    exact = names.select(F.lower(F.trim(name)).alias("_k"), F.col(name).alias("_e")).groupBy("_k").agg(F.min("_e").alias("_e"))
    syn = synonyms.select(F.lower(F.trim(synonym)).alias("_k"), F.col(synonym).alias("_y")).groupBy("_k").agg(F.min("_y").alias("_y"))
    staged = counts.join(exact, "_k", "left").join(syn, "_k", "left")
    left = staged.where(F.col("_e").isNull() & F.col("_y").isNull())
    fuzzy = best_match(fuzzy_pairs(left, synonyms, id_, synonym, least), id_, synonym).select(F.col(id_), F.col(synonym).alias("_f"))
    out = staged.join(fuzzy, id_, "left")
    category = F.when(F.col("_e").isNotNull(), "exact").when(F.col("_y").isNotNull(), "synonym").when(F.col("_f").isNotNull(), "fuzzy").otherwise("new")
    return out.select(id_, "n", category.alias("category"), F.coalesce("_e", "_y", "_f").alias("match"))


def alias_rules(text: Column, aliases: list[tuple[str, list[str]]], default: str = "") -> Column:
    """Id of the first entry one of whose aliases stands in the text as whole words, regardless of case."""
    out = None
    for own, names in aliases:
        pattern = "(?i)\\b(?:" + "|".join("\\Q" + n + "\\E" for n in names) + ")\\b"
        out = F.when(text.rlike(pattern), own) if out is None else out.when(text.rlike(pattern), own)
    return F.lit(default) if out is None else F.coalesce(out, F.lit(default))


def containing_lookup(wanted: DataFrame, key: str, index: DataFrame, prefix: str = "human", shortest: int = 3) -> DataFrame:
    """(key, id, how): the id of an index (key, id) entry equal to the wanted key (`direct`), else to the key
    behind ``prefix`` (`prefixed`), else of the shortest entry that contains it (`contains`, ties by key).

    An entry that contains a key holds all its trigrams, so only entries that share the key's rarest one are
    tested. Of keys of one or two characters, the first entry that contains each such text is found once for all
    and joined by equality. Keys of less than ``shortest`` characters (3, with 1 none is) are looked up directly
    and with the prefix only. Keys without entry are left out.
    """
    keys = wanted.select(F.col(key).alias("_q")).where(F.col("_q").isNotNull() & (F.col("_q") != "")).distinct()
    have = index.select(F.col("key").alias("_k"), F.col("id").alias("_id"))
    direct = keys.join(have, F.col("_q") == F.col("_k")).select("_q", "_id", F.lit(0).alias("_r"), F.lit(0).alias("_l"), "_k")
    fronted = keys.join(have, F.concat(F.lit(prefix), F.col("_q")) == F.col("_k")).select("_q", "_id", F.lit(1).alias("_r"), F.lit(0).alias("_l"), "_k")
    grams = lambda c, n=3: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: c.substr(i, F.lit(n))))
    posted = have.where(F.length("_k") > 2).select("_k", "_id", F.explode(grams(F.col("_k"))).alias("_g"))
    weight = posted.groupBy("_g").agg(F.count(F.lit(1)).alias("_w"))
    rarest = keys.where(F.length("_q") >= max(shortest, 3)).select("_q", F.explode(grams(F.col("_q"))).alias("_g")).join(weight, "_g").groupBy("_q").agg(F.min_by("_g", F.struct("_w", "_g")).alias("_g"))
    inside = rarest.join(posted, "_g").where(F.contains("_k", "_q")).select("_q", "_id", F.lit(2).alias("_r"), F.length("_k").alias("_l"), "_k")
    # a letter stands in most entries: their first is an aggregate, so that a short key meets one row
    short = have.where(F.length("_k") > 0).select("_k", "_id", F.explode(F.when(F.length("_k") > 1, F.concat(grams(F.col("_k"), 1), grams(F.col("_k"), 2))).otherwise(F.array("_k"))).alias("_g"))
    firsts = short.groupBy("_g").agg(F.min(F.struct(F.length("_k").alias("_l"), "_k", "_id")).alias("_f"))
    held = keys.where((F.length("_q") < 3) & (F.length("_q") >= shortest)).join(firsts, F.col("_q") == F.col("_g")).select("_q", "_f._id", F.lit(2).alias("_r"), "_f._l", "_f._k")
    best = direct.unionByName(fronted).unionByName(inside).unionByName(held).groupBy("_q").agg(F.min(F.struct("_r", "_l", "_k", "_id")).alias("_b"))
    how = F.element_at(F.array(F.lit("direct"), F.lit("prefixed"), F.lit("contains")), F.col("_b._r") + 1)
    return best.select(F.col("_q").alias(key), F.col("_b._id").alias("id"), how.alias("how"))
