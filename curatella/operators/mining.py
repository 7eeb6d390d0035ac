"""Mining texts for the names of a dictionary, and judging the mentions."""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatella.functions import bloom
from curatella.functions.text import all_matches, contexts, count_words

# Words that tell that a tool was made, or got, in a paper.
MADE = ["generat", "creat", "deriv", "develop", "establish", "engineer", "construct", "novel", "new ", "design", "produc", "synthes", "clone", "isolat", "immortaliz"]
GOT = ["obtained from", "purchased from", "acquired from", "provided by", "bought from", "commercial", "charles river", "jax", "jackson lab", "taconic", "atcc", "sigma", "millipore", "thermo fisher", "invitrogen", "cell signaling", "abcam", "santa cruz"]
# Signs of types of tools in an abstract.
SIGNS = [
    (r"(?i)\b(mice|mouse)\b", "animal_models"),
    (r"(?i)\b(cells|cell\s+lines?|fibroblasts?)\b", "cell_lines"),
    (r"(?i)\bantibod(y|ies)\b", "antibodies"),
    (r"(?i)\b(modeling|models|causal\s+model|statistical\s+analysis|software|algorithm|pipeline|computational|bioinformatics|image\s+processing|data\s+analysis)\b", "computational_tools"),
]
CELL_WORDS = ["cell line", "cells", "cell culture", "cultured", "derived", "generated"]
CELL_CODE = r"\b([A-Z][A-Za-z0-9]*[-_.][A-Z0-9][-A-Za-z0-9_.]{1,20})\b"

#: Words of a text or name, as they are compared: lower case letters and digits.
WORD = r"[^\p{L}\p{N}]+"


def dictionary(names: DataFrame, id_: str, name: str, kind: Column, synonyms: str | None = None) -> DataFrame:
    """(id, kind, pattern): names and their comma-separated synonyms, distinct, blanks left out."""
    every = F.array(F.col(name))
    if synonyms:
        every = F.concat(every, F.coalesce(F.split(F.col(synonyms), r",\s*"), F.array().cast("array<string>")))
    return names.select(F.col(id_).alias("id"), kind.alias("kind"), F.explode(every).alias("pattern")).select("id", "kind", F.trim("pattern").alias("pattern")).where(F.col("pattern") != "").distinct()


def words(text: Column) -> Column:
    """Words of a text in order."""
    return F.filter(F.split(F.lower(text), WORD), lambda w: w != "")


def scan(docs: DataFrame, doc: str, text: str, patterns: DataFrame) -> DataFrame:
    """(doc, id, kind, pattern): patterns that stand in a text as whole words, each once per document.

    Instead of testing every pattern on every text, a pattern is looked up by its first two words (or the
    one it has) among the distinct word pairs of the texts: a Bloom filter and an equi-join without the texts,
    which are fetched for what it finds and tested for the whole pattern. Patterns without letters or digits
    match nothing.
    """
    w = words(F.col("pattern"))
    keyed = patterns.withColumn("_w", w).where(F.size("_w") > 0).withColumn("_key", F.array_join(F.slice("_w", 1, 2), " ")).withColumn("_phrase", F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" "))).drop("_w")
    bare = docs.where(F.col(text).isNotNull()).select(F.col(doc).alias("_doc"), words(F.col(text)).alias("_t")).where(F.size("_t") > 0)
    bare = bare.withColumn("_text", F.concat(F.lit(" "), F.array_join("_t", " "), F.lit(" "))).withColumn("_at", F.xxhash64("_text"))
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.size("_t") - 2, F.lit(0))), lambda i: F.array_join(F.slice("_t", i + 1, 2), " "))
    looked = bare.select("_doc", "_at", F.explode(F.array_distinct(F.concat("_t", pairs))).alias("_key"))
    looked = bloom.sift(looked, ["_key"], keyed, ["_key"]).where("_maybe").drop("_maybe")
    # Spark guesses the sizes of exploded words and of texts from the (packed) table's and would broadcast them through the driver
    near = looked.hint("merge").join(keyed, "_key").withColumnRenamed("_doc", "_d").withColumnRenamed("_at", "_a")
    on = F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_at") == F.col("_a")) & F.contains(F.col("_text"), F.col("_phrase"))
    hits = near.hint("merge").join(bare.select("_doc", "_at", "_text"), on)
    return hits.select(F.col("_doc").alias(doc), "id", "kind", "pattern").distinct()


def signs(text: Column) -> Column:
    """Types of tools that a text shows signs of; [] for null."""
    return F.coalesce(all_matches(text, SIGNS), F.array().cast("array<string>"))


def made_here(text: Column, name: Column, around: int = 300) -> Column:
    """Whether a text tells that the tool was made: words of making around its mentions and none of getting."""
    near = contexts(F.lower(text), F.lower(name), around)
    made = F.aggregate(F.transform(near, lambda c: count_words(c, MADE)), F.lit(0), lambda a, x: a + x)
    got = F.aggregate(F.transform(near, lambda c: count_words(c, GOT)), F.lit(0), lambda a, x: a + 2 * x)
    return F.coalesce((made > 0) & (got == 0), F.lit(False))


def versioned(text: Column, name: Column) -> Column:
    """Whether a version follows a mention of the name: a sign of use."""
    quoted = F.concat(F.lit("(?is).*\\Q"), F.regexp_replace(name, r"\\E", ""), F.lit(r"\E\s+(?:v\d|version\s+\d|\d+\.\d+|\(v\d).*"))
    return F.coalesce(F.regexp_like(text, quoted), F.lit(False))


def nearby(text: Column, name: Column, terms: list[str], around: int = 200) -> Column:
    """Whether any of the (lower-case) terms stands around a mention."""
    return F.coalesce(F.exists(contexts(F.lower(text), F.lower(name), around), lambda c: count_words(c, terms) > 0), F.lit(False))


def cell_codes(text: Column) -> Column:
    """Codes like cell lines' names in a text that speaks of cells, distinct and sorted; [] for null."""
    codes = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(CELL_CODE), F.lit(1))))
    spoken = F.filter(codes, lambda c: F.exists(contexts(text, c, 200), lambda w: count_words(w, CELL_WORDS) > 0))
    return F.coalesce(spoken, F.array().cast("array<string>"))


def sections(docs: DataFrame, doc: str, columns: dict[str, str], least: int = 50) -> DataFrame:
    """(doc, section, text) of a document's text columns; texts of less than ``least`` characters give none."""
    rows = F.array(*(F.struct(F.lit(s).alias("section"), F.col(f"`{c}`").alias("text")) for s, c in columns.items()))
    return docs.select(doc, F.explode(rows).alias("_x")).select(doc, "_x.*").where(F.length("text") >= least)


def merge_sections(hits: DataFrame, keys: list[str], section: str, precedence: list[str]) -> DataFrame:
    """One row per key: its sections in order of precedence, and the first of them."""
    rank = F.coalesce(F.array_position(F.array(*(F.lit(s) for s in precedence)), F.col(section)).cast("int"), F.lit(0))
    rank = F.when(rank == 0, len(precedence) + 1).otherwise(rank)
    own = F.transform(F.sort_array(F.collect_set(F.struct(rank.alias("r"), F.col(section).alias("s")))), lambda x: x["s"])
    return hits.groupBy(*keys).agg(F.array_join(own, ",").alias("sections"), F.get(own, F.lit(0)).alias("main_section"))


def route(found: DataFrame, name: str, kind: str, registry: DataFrame, known: list[str], excluded: list[str], in_title: Column) -> DataFrame:
    """found with status: existing (in the registry, (key, kind)), excluded, known, novel (in the title) or
    review, the first that holds."""
    have = registry.select(F.col("key").alias("_k"), F.col("kind").alias("_t"), F.lit(True).alias("_in")).distinct()
    low = F.lower(F.trim(name))
    status = F.when(F.col("_in"), "existing").when(low.isin(*[x.lower() for x in excluded]) if excluded else F.lit(False), "excluded").when(low.isin(*[x.lower() for x in known]) if known else F.lit(False), "known").when(in_title, "novel").otherwise("review")
    return found.join(have, (low == F.col("_k")) & (F.col(kind) == F.col("_t")), "left").withColumn("status", status).drop("_k", "_t", "_in")


def best_window(text: str, pattern: str, least: float) -> float:
    """Best Ratcliff-Obershelp similarity of a pattern to a window of its length in a text; 0 below least."""
    n, best = len(pattern), 0.0
    if pattern in text:
        return 1.0
    matcher = SequenceMatcher(None, "", pattern, autojunk=False)
    counts, have = Counter(pattern), Counter(text[:n])
    for i in range(len(text) - n + 1):
        if i:
            have[text[i - 1]] -= 1
            have[text[i + n - 1]] += 1
        if sum(min(k, have[c]) for c, k in counts.items()) >= least * n:  # letters in common bound the ratio
            matcher.set_seq1(text[i : i + n])
            best = max(best, matcher.ratio())
    return best if best >= least else 0.0


#: Patterns too short for a common trigram to be sure; they go to every executor.
MOST_SHORT = 10_000


def fuzzy_scan(docs: DataFrame, doc: str, text: str, patterns: DataFrame, least: float = 0.88, shortest: int = 4) -> DataFrame:
    """(doc, pattern, score): patterns (column pattern) of which a text has a window at least so alike,
    regardless of case; each once per document.

    Of a pattern of n letters at least m = ceil(least n) are matched, in at most 2 (n - m) + 1 blocks; where
    that leaves a block of three letters, text and pattern share a trigram, by which an equi-join finds the
    candidates. Shorter patterns, MOST_SHORT at most, are tested on every text; those of less than
    ``shortest`` characters must stand in it as they are.
    """
    low = docs.where(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(doc).alias("_d"), F.lower(text).alias("_t"))
    pats = patterns.where(F.col("pattern") != "").select("pattern", F.lower("pattern").alias("_p")).distinct()
    n = F.length("_p")
    m = F.ceil(F.lit(least) * n)
    sure = (n >= shortest) & (m > 2 * (2 * (n - m) + 1))
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: c.substr(i, F.lit(3))))
    posted = pats.where(sure).select("pattern", "_p", F.explode(grams(F.col("_p"))).alias("_g"))
    pairs = low.select("_d", F.explode(grams(F.col("_t"))).alias("_g")).join(posted, "_g").select("_d", "pattern", "_p").distinct()

    @F.pandas_udf("double")
    def score(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        return pd.Series([best_window(t, p, least) for t, p in zip(texts, wanted, strict=True)], dtype="float64")

    far = pairs.join(low, "_d").withColumn("score", score.asNondeterministic()("_t", "_p")).where("score > 0").select("_d", "pattern", "score")
    short = [(r["pattern"], r["_p"]) for r in pats.where(~sure).limit(MOST_SHORT + 1).collect()]
    if len(short) > MOST_SHORT:
        raise ValueError(f"more than {MOST_SHORT} short patterns")

    @F.pandas_udf("array<struct<pattern:string,score:double>>")
    def each(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            got = ((own, best_window(t, p, least) if len(p) >= shortest else float(p in t)) for own, p in short)
            out.append([{"pattern": own, "score": s} for own, s in got if s > 0])
        return pd.Series(out, dtype=object)

    near = low.select("_d", F.explode(each("_t")).alias("_x")).select("_d", "_x.*")
    return far.unionByName(near).groupBy(F.col("_d").alias(doc), "pattern").agg(F.max("score").alias("score"))
