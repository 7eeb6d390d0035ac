"""Extraction from text and markup: rules with priorities, sections of articles, vendors and sources."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatella.operators.reconcile import keep_one

# What a section's title says it is.
SECTION_TITLES = {"methods": ("method", "material", "procedure", "experimental"), "introduction": ("introduction", "background"), "results": ("result", "finding"), "discussion": ("discussion", "conclusion")}


def by_rules(docs: DataFrame, doc: str, text: str, rules: list[tuple[str, str, int, float]]) -> DataFrame:
    """(doc, name, rule, confidence): what each rule (name, pattern, group, confidence) finds, the first
    rule that finds a name (regardless of case) in a document wins."""
    def found_by(i: int, rule: tuple[str, str, int, float]) -> Column:
        name, pattern, group, confidence = rule
        return F.transform(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group)), lambda m: F.struct(F.lit(i).alias("_i"), F.lit(name).alias("rule"), F.lit(float(confidence)).alias("confidence"), F.trim(m).alias("name")))

    found = F.concat(*(found_by(i, r) for i, r in enumerate(rules)))
    each = docs.where(F.col(text).isNotNull()).select(F.col(doc), F.explode(found).alias("_x")).select(doc, "_x.*").where(F.col("name") != "").withColumn("_k", F.lower("name"))
    return keep_one(each, [doc, "_k"], ["_i", "name"]).select(doc, "name", "rule", "confidence")


def ordered_extract(text: Column, patterns: list[tuple[str, int]], reject: str | None = None) -> Column:
    """First acceptable match over patterns in order: matches that ``reject`` matches are passed over.
    Null if none is left."""
    options = []
    for p, g in patterns:
        got = F.regexp_extract_all(text, F.lit(p), F.lit(g))
        fine = F.filter(got, lambda m: (m != "") & (~m.rlike(reject) if reject else F.lit(True)))
        options.append(F.get(fine, F.lit(0)))
    return F.coalesce(*options)


def _sections(text: str | None, longest: bool) -> dict[str, str]:
    out: dict[str, list[str]] = {}
    try:
        root = ET.fromstring(text) if text else None
    except ET.ParseError:
        root = None
    for sec in root.iter("sec") if root is not None else ():
        title = "".join(sec.find("title").itertext()).lower() if sec.find("title") is not None else ""
        for name, marks in SECTION_TITLES.items():
            if any(m in title for m in marks):
                body = " ".join(" ".join(t.split()) for p in sec.iter("p") if (t := "".join(p.itertext())).strip())
                if body:
                    out.setdefault(name, []).append(body)
                break
    return {k: max(v, key=len) if longest else " ".join(v) for k, v in out.items()}


def article_sections(xml: Column, longest: bool = True) -> Column:
    """Map of an article's sections by their titles' words; of several of a name the longest, or all joined.
    Broken and null markup give an empty map."""

    @F.pandas_udf("map<string,string>")
    def parse(texts: pd.Series) -> pd.Series:
        return pd.Series([_sections(t, longest) for t in texts], dtype=object)

    return parse(xml)


def labelled_text(parts: Column, label: str = "label", text: str = "text") -> Column:
    """`LABEL: text` of an array of structs, joined by spaces; parts without label are the text alone."""
    return F.array_join(F.transform(parts, lambda p: F.when(F.coalesce(p[label], F.lit("")) != "", F.concat(F.upper(p[label]), F.lit(": "), p[text])).otherwise(p[text])), " ")


def registry_id(text: Column) -> Column:
    """Research resource identifier in a text, '' if none."""
    return F.coalesce(F.regexp_extract(text, r"RRID:\s*([A-Z]+_[A-Za-z0-9:_-]+)", 1), F.lit(""))


def vendor_item(context: Column, reject: str | None = None) -> Column:
    """struct(vendor, catalog) from brackets such as `(Vendor, cat. no. X1)`, else from running text; of
    several the first whose vendor ``reject`` doesn't match. Nulls if there is none."""
    inside = r"[(\[]\s*([A-Z][\w&.\s-]{2,40}?)\s*[,;]\s*(?:[^()\[\]]*?[,;]\s*)?(?:cat(?:alog(?:ue)?)?\.?\s*(?:no\.?|number|#)?\s*:?\s*|#)([A-Za-z0-9][\w-]+)[^()\[\]]*[)\]]"
    running = r"([A-Z][\w&-]+(?:\s[A-Z][\w&-]+)?)\s+(?:cat(?:alog(?:ue)?)?\.?\s*(?:no\.?|number|#)\s*:?\s*)([A-Za-z0-9][\w-]+)"
    found = lambda p: F.arrays_zip(F.regexp_extract_all(context, F.lit(p), F.lit(1)).alias("vendor"), F.regexp_extract_all(context, F.lit(p), F.lit(2)).alias("catalog"))
    fine = lambda p: F.get(F.filter(found(p), lambda x: (x["vendor"] != "") & (~x["vendor"].rlike(reject) if reject else F.lit(True))), F.lit(0))
    return F.coalesce(fine(inside), fine(running), F.struct(F.lit(None).cast("string").alias("vendor"), F.lit(None).cast("string").alias("catalog")))


def acquisition(context: Column, registries: list[tuple[str, str]]) -> Column:
    """How to get a tool, by priority: a registry (pattern with the id as group 1, name), vendor and catalogue
    number, a source phrase; '' if the context tells nothing."""
    named = [F.when(F.regexp_extract(context, p, 1) != "", F.concat(F.lit(f"Available from {n} ("), F.regexp_extract(context, p, 1), F.lit(")"))) for p, n in registries]
    item = vendor_item(context)
    bought = F.when(item["vendor"].isNotNull() & item["catalog"].isNotNull(), F.concat(F.lit("Available from "), item["vendor"], F.lit(" (Cat# "), item["catalog"], F.lit(")")))
    source = F.regexp_extract(context, r"(?i)\b(?:obtained from|purchased from|(?:a )?(?:kind )?gift (?:of|from)|provided by|deposited (?:at|in))\s+(?:the\s+)?((?:Drs?\.|Prof\.)?[^.;,()]{3,80})", 1)
    given = F.when((source != "") & ~F.lower(source).rlike(r"^(?:generat|creat|deriv)|\b(?:patient|donor|volunteer|subject|individual|biops)"), F.concat(F.lit("Available from "), F.trim(source)))
    return F.coalesce(*named, bought, given, F.lit(""))


def fill_blank(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Columns that exist and are blank get the extracted value; others stay."""
    have = {c: F.when(F.coalesce(F.col(c) == "", F.lit(True)), v).otherwise(F.col(c)) for c, v in values.items() if c in df.columns}
    return df.withColumns(have) if have else df
