"""Queries over the catalogue for the general problems, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatella.functions.blank import NO_VALUE
from curatella.operators import nested, orphans, packed
from curatella.sources.tables import table

LINKS = {"usage_links": "usageId", "development_links": "developmentId"}


def _references(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, orphans.Parent], int]:
    refs, total = None, 0
    for name, link_id in LINKS.items():
        links = table(spark, d, name)
        own = orphans.references(links, name, link_id, ["resourceId", "publicationId"], "linkDate")
        refs = own if refs is None else refs.unionByName(own)
        total += 2 * links.count()
    parents = {
        "resourceId": orphans.Parent(table(spark, d, "tool_resources"), "resourceId", "dateAdded", "dateRemoved"),
        "publicationId": orphans.Parent(table(spark, d, "publications"), "publicationId", "dateAdded", "dateRemoved"),
    }
    return refs, parents, total


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references, each link and field once."""
    refs, parents, total = _references(spark, d)
    return orphans.find_orphans(refs, parents, total).select("src_table", "link_id", "field_name").distinct()


def p1_orphan_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per link table, field and month of linkDate; deliveries of one link count once."""
    refs, parents, total = _references(spark, d)
    once = refs.dropDuplicates(["src_table", "link_id", "field_name", "_key", "_at"])
    return orphans.orphan_report(once, orphans.find_orphans(once, parents, total))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Values of the cells of patient_models that hold two or more."""
    return packed.split_values(table(spark, d, "patient_models"), "patientDerivedModelId", {"molecularCharacterization": False, "developerName": True}).distinct()


def p5_values(spark: SparkSession, d: str) -> DataFrame:
    """Every value of the packed columns, single ones too, except blanks."""
    values = packed.split_values(table(spark, d, "patient_models"), "patientDerivedModelId", {"molecularCharacterization": False, "developerName": True}, least=1)
    return values.where(~F.lower(F.trim("item")).isin(*NO_VALUE)).distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Values within extractedFields of accepted tools, by their paths, from the typed tables of all deliveries."""
    every = nested.routed(nested.nodes(table(spark, d, "review_results"), "review_id", "payload"))
    inside = nested.leaves(every.where((F.col("top") == "acceptedTools") & F.col("path").startswith("extractedFields")))
    path = F.regexp_replace("path", r"^extractedFields(\[1\](?=\.))?\.?", "")
    return inside.select(F.col("record_id").alias("review_id"), F.col("top_pos").alias("tool_pos"), path.alias("leaf_path")).where(F.col("leaf_path") != "").distinct()


def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return nested.tables(table(spark, d, "review_results"), "review_id", "payload", "received_at")


def p6_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews whose payload is complete, by their last delivery."""
    return _tables(spark, d)["review"].select(F.col("record_id").alias("review_id"), "pmid", "doi", "year", "title", "toolsAccepted")


def p6_tools(spark: SparkSession, d: str) -> DataFrame:
    """Accepted tools with the key of their review and their place in it."""
    tools = _tables(spark, d)["tool"].where(F.col("top") == "acceptedTools")
    return tools.select(F.col("record_id").alias("review_id"), F.col("top_pos").alias("tool_pos"), "pmid", "toolName", "toolType", "verdict", "confidence", "recommendation", "contextSnippet", "usageType")


def p6_donors(spark: SparkSession, d: str) -> DataFrame:
    """Donors with node and parent keys: the typed table of one shape."""
    return _tables(spark, d)["donor"].select(F.col("record_id").alias("review_id"), "node_id", "parent_id", "top", "top_pos", "path", "sex", "age", F.element_at("untyped", F.lit("age")).alias("age_text"))


def p6_shapes(spark: SparkSession, d: str) -> DataFrame:
    """How many objects of each shape and structural variant the accepted tools hold."""
    shapes = _tables(spark, d)["nodes"].where((F.col("top") == "acceptedTools") & (F.col("shape") != "."))
    return shapes.groupBy("shape", "variant").agg(F.count(F.lit(1)).alias("n_objects"))


QUERIES = {f.__name__: f for f in (p1_found, p1_orphan_report, p5_found, p5_values, p6_found, p6_tools, p6_reviews, p6_donors, p6_shapes)}

_BLANKS = ", ".join("'" + w.replace("'", "''") + "'" for w in NO_VALUE)
_KEY = "lower(trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)))"


def _refs_sql() -> str:
    each = []
    for name, link_id in LINKS.items():
        for field in ("resourceId", "publicationId"):
            each.append(f"SELECT '{name}' AS src_table, {link_id} AS link_id, '{field}' AS field_name, {_KEY.format(field)} AS k, linkDate FROM {name}")
    return " UNION ALL ".join(each)


_ORPHANS = f"""
WITH refs AS (SELECT * FROM ({_refs_sql()}) WHERE k IS NOT NULL AND k NOT IN ({_BLANKS})),
parents AS (
  SELECT 'resourceId' AS field_name, {_KEY.format("resourceId")} AS k, dateAdded, dateRemoved FROM tool_resources
  UNION ALL SELECT 'publicationId', {_KEY.format("publicationId")}, dateAdded, dateRemoved FROM publications),
judged AS (
  SELECT r.*, NOT EXISTS (SELECT 1 FROM parents p WHERE p.field_name = r.field_name AND p.k = r.k
    AND (p.dateAdded IS NULL OR p.dateAdded <= r.linkDate) AND (p.dateRemoved IS NULL OR p.dateRemoved > r.linkDate)) AS orphan
  FROM refs r)
"""

# last complete delivery of each review; of equal times any, as those have equal payloads
_LATEST = """
whole AS (SELECT review_id, received_at, payload, CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM review_results),
latest AS (SELECT review_id, arg_max(j, received_at) AS j FROM whole WHERE json_type(j) = 'OBJECT' GROUP BY review_id)"""
_ACCEPTED = """
tools AS (
  SELECT review_id, generate_subscripts(l, 1) AS tool_pos, unnest(l) AS t
  FROM (SELECT review_id, CASE json_type(j, '$.acceptedTools') WHEN 'ARRAY' THEN json_extract(j, '$.acceptedTools[*]') WHEN 'OBJECT' THEN [json_extract(j, '$.acceptedTools')] END AS l FROM {0}))"""
_INNER = "CASE WHEN json_type({0}) = 'VARCHAR' AND json_valid({0} ->> '$') AND json_type(({0} ->> '$')::JSON) IN ('OBJECT', 'ARRAY') THEN ({0} ->> '$')::JSON ELSE {0} END"
_ARRAYS = ", ".join(f"'{f}'" for f in sorted({n for own in nested.REVIEW.values() for n, want in own.items() if want[0] == "["}))
_PARTS = ", ".join(f"'{f}'" for f in sorted({n for own in nested.REVIEW.values() for n, want in own.items() if want != "."}))

ORACLE = {
    "p6_reviews": f"""
WITH {_LATEST}
SELECT review_id, j ->> '$.pmid' AS pmid, j ->> '$.doi' AS doi, TRY_CAST(j ->> '$.year' AS INT) AS year, j ->> '$.title' AS title, TRY_CAST(j ->> '$.toolsAccepted' AS INT) AS "toolsAccepted" FROM latest""",
    "p6_tools": f"""
WITH {_LATEST}, {_ACCEPTED.format("latest")}
SELECT review_id, tool_pos::INT AS tool_pos, {", ".join(f"t ->> '$.{c}' AS \"{c}\"" for c in ("pmid", "toolName", "toolType", "verdict", "recommendation", "contextSnippet", "usageType"))}, TRY_CAST(t ->> '$.confidence' AS DOUBLE) AS confidence
FROM tools WHERE json_type(t) = 'OBJECT'""",
    "p6_found": f"""
WITH RECURSIVE {_LATEST}, every AS (SELECT review_id, j FROM whole WHERE json_type(j) = 'OBJECT'), {_ACCEPTED.format("every")},
fields AS (SELECT review_id, tool_pos, {_INNER.format("json_extract(t, '$.extractedFields')")} AS v FROM tools),
walk AS (
  SELECT review_id, tool_pos, '' AS path, v FROM fields WHERE json_type(v) = 'OBJECT'
  UNION ALL
  SELECT review_id, tool_pos, path || CASE WHEN k IS NULL THEN '[' || i || ']' ELSE CASE WHEN path = '' THEN '' ELSE '.' END || k || CASE WHEN k IN ({_ARRAYS}) AND json_type(c) NOT IN ('ARRAY', 'NULL') THEN '[1]' ELSE '' END END, c
  FROM (SELECT review_id, tool_pos, path, k, i, CASE WHEN k IN ({_PARTS}) THEN {_INNER.format("c")} ELSE c END AS c FROM (
    SELECT review_id, tool_pos, path, k, NULL AS i, json_extract(v, '$."' || k || '"') AS c FROM (SELECT review_id, tool_pos, path, v, unnest(json_keys(v)) AS k FROM walk WHERE json_type(v) = 'OBJECT')
    UNION ALL
    SELECT review_id, tool_pos, path, NULL, generate_subscripts(json_extract(v, '$[*]'), 1), unnest(json_extract(v, '$[*]')) FROM walk WHERE json_type(v) = 'ARRAY')))
SELECT DISTINCT review_id, tool_pos::INT AS tool_pos, path AS leaf_path FROM walk WHERE json_type(v) NOT IN ('OBJECT', 'ARRAY', 'NULL') AND v ->> '$' <> ''""",
    "p1_found": _ORPHANS + "SELECT DISTINCT src_table, link_id, field_name FROM judged WHERE orphan",
    "p1_orphan_report": _ORPHANS
    + """
SELECT src_table, field_name, strftime(linkDate, '%Y-%m') AS month, count(*) AS n_refs,
       CAST(sum(CAST(orphan AS INT)) AS BIGINT) AS n_orphans, sum(CAST(orphan AS INT)) / count(*)::DOUBLE AS orphan_rate
FROM (SELECT DISTINCT * FROM judged) GROUP BY ALL""",
}
