"""Row predicates and rule chains of the curation pipeline, driven by lists and rules given as arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatella.functions.text import contains_any, count_words


def without_tracking(df: DataFrame, prefixes: tuple[str, ...] = ("_", "ROW_")) -> DataFrame:
    """Columns whose names begin with a tracking prefix are dropped."""
    return df.drop(*(c for c in df.columns if c.startswith(prefixes)))


def excluded_title(title: Column, journal: Column, words: list[str]) -> Column:
    """Titles or journals with any of the words as a substring; blank titles are excluded too."""
    return F.coalesce(F.trim(title) == "", F.lit(True)) | contains_any(title, words) | contains_any(journal, words)


def preprint(journal: Column, doi: Column, journals: list[str], doi_marks: list[str]) -> Column:
    """By words anywhere in the journal or marks anywhere in the DOI; nulls are none."""
    return contains_any(journal, journals) | contains_any(doi, doi_marks)


def confident(confidence: Column, least: float = 0.7) -> Column:
    """At least so confident; what isn't a number is not."""
    return F.coalesce(confidence.try_cast("double") >= least, F.lit(False))


def bucket(confidence: Column, auto: float = 0.9, manual: float = 0.7) -> Column:
    """auto above, manual between both bounds (inclusive), else drop."""
    c = confidence.try_cast("double")
    return F.when(c > auto, "auto").when(c >= manual, "manual").otherwise("drop")


def relevant(title: Column, context: Column, terms: list[str], least: int = 2) -> Column:
    """Any term in the title, else ``least`` distinct terms in the context."""
    return contains_any(title, terms) | (count_words(context, terms) >= least)


def first_reason(rules: list[tuple[str, Column]], keep_first: Column | None = None) -> Column:
    """Name of the first rule that holds, null if none does: one ordered chain, evaluated lazily.

    keep_first: rows that are kept whatever the rules say.
    """
    out = F.when(F.coalesce(keep_first, F.lit(False)), F.lit(None).cast("string")) if keep_first is not None else None
    for name, rule in rules:
        hit = F.coalesce(rule, F.lit(False))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(None).cast("string") if out is None else out


def verdict(recommendation: Column) -> Column:
    """accepted, rejected, else uncertain."""
    return F.when(recommendation == "Keep", "accepted").when(recommendation == "Remove", "rejected").otherwise("uncertain")


def drop_rejected(df: DataFrame, rejected: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that aren't in the rejected set; uncertain and unkeyed rows are kept."""
    return df.join(rejected.select(*keys).distinct(), keys, "left_anti")


def named_in_title(name: Column, title: Column, share: float = 0.75, least: int = 2) -> Column:
    """The name, or the name without its version, is in the title; or of its words of four letters and
    more at least ``share`` and at least ``least`` are. False without a title."""
    t = F.lower(F.coalesce(title, F.lit("")))
    bare = F.trim(F.regexp_replace(F.lower(name), r"\s+v?(?:ersion\s*)?\d[\w.]*$", ""))
    words = F.filter(F.split(F.lower(name), r"\s+"), lambda w: F.length(w) > 3)
    hits = F.size(F.filter(words, lambda w: F.contains(t, w)))
    many = (F.size(words) > 0) & (hits >= least) & (hits >= F.size(words) * share)
    return (t != "") & (F.contains(t, F.lower(name)) | ((bare != "") & F.contains(t, bare)) | many)


def minable(abstract: Column, has_resource: Column, has_sign: Column, least: int = 50) -> Column:
    """Why an abstract is or isn't mined: too_short, resource, sign or none, the first that holds."""
    return F.when(F.length(F.coalesce(abstract, F.lit(""))) < least, "too_short").when(has_resource, "resource").when(has_sign, "sign").otherwise("none")


def stale(kind: Column, name: Column, wanted: str, pattern: str | None = None, names: tuple[str, ...] = ()) -> Column:
    """Rows of one type whose name matches a pattern or is listed."""
    hit = name.rlike(pattern) if pattern else F.lit(False)
    return (kind == wanted) & (hit | (name.isin(*names) if names else F.lit(False)))


def first_column(df: DataFrame, candidates: list[str]) -> str | None:
    """The first of the candidates that the frame has."""
    return next((c for c in candidates if c in df.columns), None)


def ensure_column(df: DataFrame, column: str, kind: str = "string") -> DataFrame:
    """The frame with the column, '' (or null of another type) where it was lacking."""
    return df if column in df.columns else df.withColumn(column, F.lit("") if kind == "string" else F.lit(None).cast(kind))


def worth_upgrading(tools: Column, skip: list[str], confidence: float = 0.8, complete: float = 0.6) -> Column:
    """Whether a publication's full text is worth fetching: an array of tools (verdict, confidence, toolType,
    completeness) has an accepted one of a type not to be skipped, confident enough, and the mean of the
    completeness values that are given is high enough (or none is given)."""
    good = F.filter(tools, lambda t: (t["verdict"] == "Accept") & (t["confidence"] >= confidence) & (~t["toolType"].isin(*skip) if skip else F.lit(True)))
    given = F.filter(F.transform(good, lambda t: t["completeness"]), lambda c: c.isNotNull())
    mean = F.try_divide(F.aggregate(given, F.lit(0.0), lambda a, c: a + c), F.size(given))
    return F.coalesce((F.size(good) > 0) & (F.coalesce(mean, F.lit(1.0)) >= complete), F.lit(False))
