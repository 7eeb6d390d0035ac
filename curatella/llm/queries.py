"""Queries over the catalogue for the problems tagged llm, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatella.functions import lineage, skew
from curatella.functions.blank import NO_VALUE, is_blank
from curatella.llm import abuse, canonical, mixing, names, survivors, tokens, truncation
from curatella.sources.tables import table


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    journals, funders = table(spark, d, "journal_reference"), table(spark, d, "funder_reference")
    lists = {"journal": canonical.read_entries(journals, "journal_id", "journal_name", "abbreviation"), "_fundingAgency": canonical.read_entries(funders, "funder_id", "funder_name", "acronym")}
    exact = F.broadcast(spark.createDataFrame([(name,) for own in lists.values() for _, name, _ in own], "value string"))  # of checked size
    publications = table(spark, d, "publications").select(F.lit("journal").alias("field_name"), F.col("pub_row_id").alias("row_id"), F.lit(1).alias("pos"), F.col("journal").alias("value"))
    agencies = table(spark, d, "submission_mentions").select(F.lit("_fundingAgency").alias("field_name"), F.col("sp_id").alias("row_id"), F.posexplode(F.split("_fundingAgency", "; ")).alias("_p", "value"))
    items = publications.unionByName(agencies.select("field_name", "row_id", (F.col("_p") + 1).alias("pos"), "value"))
    cases = items.where(~is_blank(F.col("value"))).join(exact, "value", "left_anti")
    return canonical.map_values(cases, lists)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Free-typed journals and agencies with the entry meant."""
    return _mapped(spark, d).select("field_name", "row_id", "pos", "ref_id")


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that no entry fits, with how often they occur."""
    return _mapped(spark, d).where(F.col("ref_id") == canonical.UNMATCHED).groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return truncation.judge(table(spark, d, "submission_mentions"), "sp_id", "_context", "_source", "resourceId")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Mentions whose context lost its end."""
    return _judged(spark, d).where("is_cut").select(F.col("key").alias("sp_id"))


def p3_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each source cuts, and how that was seen."""
    n = lambda why: F.count(F.when(F.col("why") == why, 1)).alias(f"n_{why}")
    by = _judged(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), F.count(F.when(F.col("is_cut"), 1)).alias("n_cut"), *(n(w) for w in ("copy", "mark", "limit", "sentence", "closing")))
    return by.withColumn("cut_rate", F.col("n_cut") / F.col("n_texts"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups of records of one mention: the record kept and the one whose context survives, from the search
    that settles all bundles."""
    return survivors.settle(survivors.assign(table(spark, d, "submission_mentions"))).select("group_id", "keep_id", "context_id")


def p4_survivors(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each group, bundle by bundle."""
    return survivors.survivors(table(spark, d, "submission_mentions"))


def _entities(spark: SparkSession, d: str) -> DataFrame:
    """(field_name, id, entity) of the records behind both name fields, linked in one run."""
    tools = table(spark, d, "clinical_tools").select(F.col("ct_id").alias("id"), F.col("assessmentName").alias("name"), F.col("assessmentType").alias("more"), F.lit(None).cast("string").alias("same_as"))
    people = table(spark, d, "developer_entries").select(F.col("entry_id").alias("id"), F.col("developerName").alias("name"), F.col("developerAffiliation").alias("more"), names.identifier(F.col("orcid")).alias("same_as"))
    parsed = lambda rows, field, person: names.parse(rows.where(~is_blank(F.col("name"))), person).withColumn("field_name", F.lit(field))
    return names.link(parsed(tools, "assessmentName", False).unionByName(parsed(people, "developerName", True)))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of records of one instrument, person or organisation."""
    return names.entity_pairs(_entities(spark, d)).select("field_name", "id_1", "id_2")


def p7_entities(spark: SparkSession, d: str) -> DataFrame:
    """Each record's entity and its size, without any pairs."""
    linked = lineage.cut(_entities(spark, d))
    sizes = linked.groupBy("entity").agg(F.count(F.lit(1)).alias("n_records"), F.min("id").alias("entity_id"))
    return skew.salted_join(linked, sizes, ["entity"], "inner", linked.count()).select("field_name", "id", "entity_id", "n_records")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k, without special tokens."""
    return tokens.encode_table(table(spark, d, "documents"), "doc_id", "text")


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sized = tokens.encode_table(table(spark, d, "documents"), "doc_id", "text", counts_only=True, keep=("source",))
    return mixing.mix(sized, table(spark, d, "mix_targets"), fill=True)


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the mix, a row per copy."""
    return _mix(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of the mix per source."""
    return _mix(spark, d)[1]


def _scored(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    model = abuse.fit_table(abuse.sample(documents, table(spark, d, "doc_labels")))
    return abuse.score(documents, model, keep=("source",))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with an abusive, hateful or sexually explicit passage."""
    return _scored(spark, d).where("is_toxic").select("doc_id")


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    """A score for every document."""
    return _scored(spark, d).select("doc_id", "source", "score", "is_toxic")


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rate of such documents per source."""
    by = _scored(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count(F.when(F.col("is_toxic"), 1)).alias("n_toxic"))
    return by.withColumn("toxic_rate", F.col("n_toxic") / F.col("n_docs"))


QUERIES = {f.__name__: f for f in (p2_found, p2_unmatched, p3_found, p3_rates, p4_found, p4_survivors, p7_found, p7_entities, p8_ids, p9_mix, p9_shares, p10_found, p10_scores, p10_rates)}

_BLANKS = ", ".join("'" + w.replace("'", "''") + "'" for w in NO_VALUE)

_SPACE = "'[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]+'"


def _blank_sql(c: str) -> str:
    return f"({c} IS NULL OR lower(trim(regexp_replace({c}, {_SPACE}, ' ', 'g'))) IN ({_BLANKS}))"


_COUNT = " + ".join(f"(NOT {_blank_sql(c)})::INT" for c in survivors.MENTIONS.filled)

_GROUPS = f"""
WITH r AS (
  SELECT *, CASE WHEN NOT {_blank_sql("_pmid")} AND regexp_matches(_pmid, '[0-9]') THEN coalesce(nullif(ltrim(regexp_extract(_pmid, '[0-9]+'), '0'), ''), '0') END AS num,
    CASE WHEN NOT {_blank_sql("_context")} THEN regexp_replace(lower(_context), {_SPACE}, '', 'g') END AS txt
  FROM submission_mentions WHERE resourceId IS NOT NULL),
loose AS (SELECT resourceId, txt FROM r WHERE {_blank_sql("_pmid")} AND txt IS NOT NULL GROUP BY ALL),
cand AS (SELECT resourceId, txt, num, min(sp_id) AS k FROM r WHERE txt IS NOT NULL AND (num IS NOT NULL OR {_blank_sql("_pmid")}) GROUP BY ALL),
found AS (
  SELECT l.resourceId, l.txt, coalesce('n' || c.num, 't' || c.txt) AS g,
    row_number() OVER (PARTITION BY l.resourceId, l.txt ORDER BY (c.num IS NULL), CASE WHEN c.num IS NULL THEN -length(c.txt) ELSE 0 END, c.k) AS rn
  FROM loose l JOIN cand c ON c.resourceId = l.resourceId AND starts_with(c.txt, l.txt)),
g AS (
  SELECT r.*, coalesce('n' || r.num, f.g) AS gkey FROM r
  LEFT JOIN found f ON f.rn = 1 AND f.resourceId = r.resourceId AND f.txt = r.txt AND {_blank_sql("r._pmid")}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY resourceId, gkey ORDER BY ({_COUNT}) DESC, _modified DESC NULLS LAST, sp_id) AS keep_rank,
    CASE WHEN txt IS NULL THEN NULL ELSE length(trim(regexp_replace(_context, {_SPACE}, ' ', 'g'))) END AS len
  FROM g WHERE gkey IS NOT NULL),
ctx AS (SELECT resourceId, gkey, sp_id, row_number() OVER (PARTITION BY resourceId, gkey ORDER BY len DESC, sp_id) AS ctx_rank FROM ranked WHERE len IS NOT NULL)"""

_VALUE = lambda a, c: f"CASE WHEN NOT {_blank_sql(f'{a}.{c}')} THEN {a}.{c} END AS {c}"
_ORDER = "ORDER BY s DESC, _modified DESC NULLS LAST, sp_id"
_BUNDLES = {"head": survivors.MENTIONS.head, "tail": survivors.MENTIONS.tail} | {f"free{i}": own for i, own in enumerate(survivors.MENTIONS.free, 1)}
_WORDS = " ".join(f"WHEN '{w}' THEN {t}" for w, t in survivors.TRUST.items())
_N = lambda cols: " + ".join(f"(NOT {_blank_sql(c)})::INT" for c in cols)

ORACLE = {
    "p4_found": _GROUPS
    + """
SELECT min(a.sp_id) AS group_id, max(CASE WHEN keep_rank = 1 THEN a.sp_id END) AS keep_id, coalesce(max(c.sp_id), -1) AS context_id
FROM ranked a LEFT JOIN ctx c ON c.ctx_rank = 1 AND c.resourceId = a.resourceId AND c.gkey = a.gkey
GROUP BY a.resourceId, a.gkey HAVING count(*) > 1""",
    "p4_survivors": _GROUPS
    + f""",
kept AS (
  SELECT a.resourceId, a.gkey, count(*) AS n_records, min(a.sp_id) AS group_id, max(CASE WHEN keep_rank = 1 THEN a.sp_id END) AS keep_id, max(c.sp_id) AS context_id
  FROM ranked a LEFT JOIN ctx c ON c.ctx_rank = 1 AND c.resourceId = a.resourceId AND c.gkey = a.gkey
  GROUP BY a.resourceId, a.gkey HAVING count(*) > 1),
w AS (
  SELECT *, 1 + round(1000 * coalesce(CASE WHEN TRY_CAST(_confidence AS DOUBLE) BETWEEN 0 AND 1 THEN TRY_CAST(_confidence AS DOUBLE) END, CASE lower(trim(_confidence)) {_WORDS} END, {survivors.UNTOLD}))::BIGINT AS w,
    CASE WHEN NOT {_blank_sql("_doi")} THEN lower(trim(_doi)) END AS det
  FROM ranked),
{", ".join(f"{b} AS (SELECT * FROM (SELECT resourceId, gkey, sp_id, _modified, det, s, row_number() OVER (PARTITION BY resourceId, gkey{', det' if b in ('head', 'tail') else ''} {_ORDER}) AS rn FROM (SELECT *, w * ({_N(cols)}) AS s FROM w WHERE {_N(cols)} > 0)) WHERE rn = 1)" for b, cols in _BUNDLES.items())},
fit AS (
  SELECT h.resourceId, h.gkey, h.sp_id AS head_id, t.sp_id AS tail_id,
    row_number() OVER (PARTITION BY h.resourceId, h.gkey ORDER BY h.s + coalesce(t.s, 0) DESC, h.s DESC, h._modified DESC NULLS LAST, h.sp_id, t.s DESC NULLS LAST, t._modified DESC NULLS LAST, t.sp_id) AS rn
  FROM head h LEFT JOIN tail t ON t.resourceId = h.resourceId AND t.gkey = h.gkey AND (h.det IS NULL OR t.det IS NULL OR h.det = t.det)),
only_tail AS (SELECT resourceId, gkey, sp_id AS tail_id, row_number() OVER (PARTITION BY resourceId, gkey {_ORDER}) AS rn FROM tail),
ids AS (
  SELECT k.group_id, k.n_records, k.keep_id, coalesce(k.context_id, -1) AS context_id, coalesce(f.head_id, -1) AS head_id, coalesce(CASE WHEN f.head_id IS NULL THEN o.tail_id ELSE f.tail_id END, -1) AS tail_id,
    coalesce(a.sp_id, -1) AS free1_id, coalesce(b.sp_id, -1) AS free2_id
  FROM kept k
  LEFT JOIN fit f ON f.rn = 1 AND f.resourceId = k.resourceId AND f.gkey = k.gkey
  LEFT JOIN only_tail o ON o.rn = 1 AND o.resourceId = k.resourceId AND o.gkey = k.gkey
  LEFT JOIN free1 a ON a.resourceId = k.resourceId AND a.gkey = k.gkey LEFT JOIN free2 b ON b.resourceId = k.resourceId AND b.gkey = k.gkey)
SELECT i.*, {_VALUE("h", "_pmid")}, {_VALUE("h", "_doi")}, {_VALUE("t", "_publicationTitle")}, {_VALUE("t", "_year")}, {_VALUE("c", "_context")}, {_VALUE("u", "_usageType")}, {_VALUE("g", "_fundingAgency")}
FROM ids i LEFT JOIN submission_mentions h ON h.sp_id = i.head_id LEFT JOIN submission_mentions t ON t.sp_id = i.tail_id LEFT JOIN submission_mentions c ON c.sp_id = i.context_id
LEFT JOIN submission_mentions u ON u.sp_id = i.free1_id LEFT JOIN submission_mentions g ON g.sp_id = i.free2_id""",
}
