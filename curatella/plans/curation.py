"""More queries of the curation pipeline's operators, row by row, with SQL for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatella.functions import lineage, scoring, text
from curatella.operators import compile as comp
from curatella.operators import extract, mining, pivot, predicates, quality, reconcile, resolve, stats
from curatella.plans import problems
from curatella.sources import files
from curatella.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query (and its SQL) under its function's name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def _has(column: str, words: list[str]) -> str:
    return " OR ".join(f"contains(lower(coalesce({column}, '')), '{w}')" for w in words)


def _count(column: str, words: list[str]) -> str:
    return " + ".join(f"contains(lower(coalesce({column}, '')), '{w}')::INT" for w in words)


@query("SELECT sp_id, resourceId FROM submission_mentions")
def s71_without_tracking(spark: SparkSession, d: str) -> DataFrame:
    """Mentions without their tracking columns."""
    return predicates.without_tracking(table(spark, d, "submission_mentions"))


_TERMS = ["neurofibroma", "schwann", "tumor", "nf1", "mpnst"]


@query(f"SELECT pub_row_id, ({_has('publicationTitle', _TERMS)}) OR ({_count('abstract', _TERMS)}) >= 2 AS relevant FROM publications")
def s72_relevant(spark: SparkSession, d: str) -> DataFrame:
    """Publications with a term in the title or two in the abstract."""
    return table(spark, d, "publications").select("pub_row_id", predicates.relevant(F.col("publicationTitle"), F.col("abstract"), _TERMS).alias("relevant"))


@query(f"WITH {problems._LATEST}, {problems._ACCEPTED.format('latest')} SELECT review_id, tool_pos::INT AS tool_pos, CASE t ->> '$.recommendation' WHEN 'Keep' THEN 'accepted' WHEN 'Remove' THEN 'rejected' ELSE 'uncertain' END AS verdict FROM tools WHERE json_type(t) = 'OBJECT'")
def s73_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts of accepted tools by their recommendation."""
    return problems.p6_tools(spark, d).select("review_id", "tool_pos", predicates.verdict(F.col("recommendation")).alias("verdict"))


@query("SELECT usageId, resourceId, linkDate FROM usage_links u WHERE NOT EXISTS (SELECT 1 FROM tool_resources t WHERE t.dateRemoved IS NOT NULL AND t.resourceId = u.resourceId)")
def s74_drop_rejected(spark: SparkSession, d: str) -> DataFrame:
    """Links whose tool was never removed."""
    gone = table(spark, d, "tool_resources").where("dateRemoved IS NOT NULL")
    return predicates.drop_rejected(table(spark, d, "usage_links").select("usageId", "resourceId", "linkDate"), gone, ["resourceId"])


@query(r"""
WITH m AS (SELECT sp_id, lower(_toolName) AS n, lower(coalesce(_publicationTitle, '')) AS t FROM submission_mentions),
w AS (SELECT *, trim(regexp_replace(n, '\s+v?(?:ersion\s*)?\d[\w.]*$', '')) AS bare, list_filter(regexp_split_to_array(n, '\s+'), lambda x: length(x) > 3) AS ws FROM m),
h AS (SELECT *, len(list_filter(ws, lambda x: contains(t, x))) AS hits FROM w)
SELECT sp_id, t <> '' AND (contains(t, n) OR (bare <> '' AND contains(t, bare)) OR (len(ws) > 0 AND hits >= 2 AND hits >= len(ws) * 0.75)) AS in_title FROM h""")
def s75_named_in_title(spark: SparkSession, d: str) -> DataFrame:
    """Mentions whose tool is named in the publication's title."""
    return table(spark, d, "submission_mentions").select("sp_id", predicates.named_in_title(F.col("_toolName"), F.col("_publicationTitle")).alias("in_title"))


@query(f"SELECT pub_row_id, CASE WHEN length(coalesce(abstract, '')) < 400 THEN 'too_short' WHEN {_has('abstract', ['neurofibroma'])} THEN 'resource' WHEN {_has('abstract', ['antibody', 'cell line'])} THEN 'sign' ELSE 'none' END AS why FROM publications")
def s76_minable(spark: SparkSession, d: str) -> DataFrame:
    """Why abstracts are or aren't mined."""
    a = F.col("abstract")
    return table(spark, d, "publications").select("pub_row_id", predicates.minable(a, text.contains_any(a, ["neurofibroma"]), text.contains_any(a, ["antibody", "cell line"]), 400).alias("why"))


@query(r"SELECT resourceId, resourceName, dateAdded FROM tool_resources WHERE resourceType = 'Cell Line' AND (regexp_matches(resourceName, '^[A-M]') OR resourceName IN ('ZD-11221a'))")
def s77_stale(spark: SparkSession, d: str) -> DataFrame:
    """Entries of one type with names of one form."""
    t = table(spark, d, "tool_resources")
    return t.where(predicates.stale(F.col("resourceType"), F.col("resourceName"), "Cell Line", "^[A-M]", ("ZD-11221a",))).select("resourceId", "resourceName", "dateAdded")


@query("SELECT ct_id, assessmentName AS label, '' AS note FROM clinical_tools")
def s78_columns(spark: SparkSession, d: str) -> DataFrame:
    """The first column that a table has of several, and one that it lacks."""
    t = table(spark, d, "clinical_tools")
    name = predicates.first_column(t, ["toolName", "assessmentName", "assessmentType"])
    return predicates.ensure_column(t.select("ct_id", F.col(name).alias("label")), "note")


@query("""
WITH m AS (SELECT sp_id, _toolType = 'cell_line' AND _context IS NOT NULL AS e FROM submission_mentions),
r AS (SELECT sp_id, e, row_number() OVER (PARTITION BY e ORDER BY sp_id) AS rn FROM m)
SELECT sp_id FROM r WHERE NOT coalesce(e, false) OR rn <= 50""")
def s79_eligible_cap(spark: SparkSession, d: str) -> DataFrame:
    """All mentions that aren't eligible, and a work cap of 50 that are."""
    m = table(spark, d, "submission_mentions").select("sp_id", "_toolType", "_context")
    return stats.eligible_cap(m, (F.col("_toolType") == "cell_line") & F.col("_context").isNotNull(), 50, ["sp_id"]).select("sp_id")


_FILL = ["modelSystemType", "patientDiagnosis", "hostStrain", "tumorType", "engraftmentSite"]


@query(f"SELECT patientDerivedModelId, _modified, ({' + '.join(f'({c} IS NOT NULL AND {c} NOT IN ({chr(39) * 2}, {chr(39)}NULL{chr(39)}))::INT' for c in _FILL)}) >= 2 AS enough FROM patient_models")
def s80_enough_filled(spark: SparkSession, d: str) -> DataFrame:
    """Models with half of their fields filled."""
    from curatella.functions.blank import crit_filled

    n = sum((crit_filled(F.col(c)).cast("int") for c in _FILL), F.lit(0))
    return table(spark, d, "patient_models").select("patientDerivedModelId", "_modified", scoring.enough_filled(n, len(_FILL)).alias("enough"))


@query(r"SELECT sp_id, round(least(0.95, 0.7 + CASE WHEN coalesce(length(_context) > 50, false) THEN 0.1 ELSE 0 END + CASE WHEN coalesce(_usageType = 'Development', false) THEN 0.1 ELSE 0 END + CASE WHEN coalesce(regexp_matches(_toolName, '\d'), false) THEN 0.05 ELSE 0 END), 6)::DOUBLE AS confidence FROM submission_mentions")
def s81_mention_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Confidence of mentions by context, use and version."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    c = scoring.mention_confidence(yes(F.length("_context") > 50), yes(F.col("_usageType") == "Development"), yes(F.col("_toolName").rlike(r"\d")))
    return table(spark, d, "submission_mentions").select("sp_id", F.round(c, 6).alias("confidence"))


@query("SELECT publicationId, arg_min(journal, pub_row_id) AS journal FROM publications WHERE journal IS NOT NULL GROUP BY 1 UNION ALL SELECT publicationId, NULL FROM publications GROUP BY 1 HAVING count(journal) = 0")
def s82_first_filled(spark: SparkSession, d: str) -> DataFrame:
    """The first journal told for each publication."""
    return table(spark, d, "publications").groupBy("publicationId").agg(stats.first_filled("journal", F.col("pub_row_id")).alias("journal"))


def _loose_sql() -> str:
    k = "translate(trim(lower(coalesce(resourceName, ''))), '()', '')"
    for e in text.LOOSE_ENDINGS:
        k = f"regexp_replace({k}, '{e}', '')"
    return f"WITH k AS (SELECT resourceId, dateAdded, {k} AS k FROM tool_resources) SELECT resourceId, dateAdded, trim(regexp_replace(CASE WHEN regexp_matches(k, '{text.LOOSE_CODE}') THEN regexp_replace(k, '{text.LOOSE_MARKS}', '', 'g') ELSE k END, '\\s+', ' ', 'g')) AS loose FROM k"


@query(_loose_sql())
def s83_loose_key(spark: SparkSession, d: str) -> DataFrame:
    """The other name key of every tool."""
    return table(spark, d, "tool_resources").select("resourceId", "dateAdded", text.name_key_loose(F.col("resourceName")).alias("loose"))


@query("""
WITH q AS (SELECT DISTINCT q FROM (SELECT lower(split_part(journal_name, ' ', -1)) AS q FROM journal_reference UNION ALL SELECT lower(left(journal_name, 2)) FROM journal_reference UNION ALL SELECT lower(journal_name) FROM journal_reference) WHERE q <> ''),
i AS (SELECT lower(journal_name) AS k, min(journal_id) AS id FROM journal_reference GROUP BY 1),
c AS (SELECT q, id, 0 AS r, 0 AS l, k FROM q JOIN i ON q = k UNION ALL SELECT q, id, 1, 0, k FROM q JOIN i ON 'journal of ' || q = k
  UNION ALL SELECT q, id, 2, length(k), k FROM q JOIN i ON contains(k, q))
SELECT q, id, ['direct', 'prefixed', 'contains'][r + 1] AS how FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY r, l, k, id) AS n FROM c) WHERE n = 1""")
def s84_containing_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Journals by texts that are a name, or stand in one: last words, two letters, whole names."""
    j = table(spark, d, "journal_reference")
    index = j.groupBy(F.lower("journal_name").alias("key")).agg(F.min("journal_id").alias("id"))
    return resolve.containing_lookup(j.select(F.explode(F.array(F.lower(F.element_at(F.split("journal_name", " "), -1)), F.lower(F.substring("journal_name", 1, 2)), F.lower("journal_name"))).alias("q")), "q", index, "journal of ", shortest=1)


_ALIASES = [("cell", ["cell line", "cells"]), ("mouse", ["mouse", "mice"]), ("antibody", ["antibody", "antibodies"])]


@query("SELECT pub_row_id, CASE " + " ".join(f"WHEN regexp_matches(abstract, '(?i)\\b(?:{'|'.join(names)})\\b') THEN '{i}'" for i, names in _ALIASES) + " ELSE '' END AS first_alias FROM publications")
def s85_alias_rules(spark: SparkSession, d: str) -> DataFrame:
    """The first of several things that an abstract names by any alias."""
    return table(spark, d, "publications").select("pub_row_id", resolve.alias_rules(F.col("abstract"), _ALIASES).alias("first_alias"))


@query("""
WITH n AS (SELECT resourceId, count(*) AS n FROM usage_links WHERE resourceId IS NOT NULL GROUP BY 1 HAVING count(*) >= 2),
e AS (SELECT lower(trim(resourceId)) AS k, min(resourceId) AS e FROM tool_resources WHERE dateRemoved IS NULL GROUP BY 1),
y AS (SELECT lower(trim(resourceId)) AS k, min(resourceId) AS y FROM development_links GROUP BY 1)
SELECT n.resourceId, n.n, CASE WHEN e IS NOT NULL THEN 'exact' WHEN y IS NOT NULL THEN 'synonym' ELSE 'new' END AS category, coalesce(e, y) AS match
FROM n LEFT JOIN e ON e.k = lower(trim(n.resourceId)) LEFT JOIN y ON y.k = lower(trim(n.resourceId))""")
def s86_categorise(spark: SparkSession, d: str) -> DataFrame:
    """Linked ids by where they are known (ids only equal, so no fuzzy stage decides)."""
    return resolve.categorise(table(spark, d, "usage_links"), "resourceId", table(spark, d, "tool_resources").where("dateRemoved IS NULL"), "resourceId", table(spark, d, "development_links").select(F.col("resourceId").alias("syn")), "syn", least=1.0)


@query("SELECT entry_id, array_to_string(list_sort(list_filter(['has_orcid', 'has_place', 'manual'], lambda x: CASE x WHEN 'has_orcid' THEN orcid IS NOT NULL AND orcid <> '' WHEN 'has_place' THEN developerAffiliation IS NOT NULL ELSE coalesce(_source = 'manual', false) END)), ', ') AS flags FROM developer_entries")
def s87_boolean_keys(spark: SparkSession, d: str) -> DataFrame:
    """Names of the marks that hold for each entry."""
    flags = F.create_map(F.lit("has_orcid"), F.coalesce(F.col("orcid") != "", F.lit(False)), F.lit("has_place"), F.col("developerAffiliation").isNotNull(), F.lit("manual"), F.coalesce(F.col("_source") == "manual", F.lit(False)))
    return table(spark, d, "developer_entries").select("entry_id", text.boolean_map_keys(flags).alias("flags"))


@query(f"""
WITH m AS (SELECT sp_id, lower(_context) AS t, lower(_toolName) AS n FROM submission_mentions),
s AS (SELECT *, CASE WHEN length(n) > 0 AND contains(t, n) THEN list_filter(range(1, length(t) - length(n) + 2), lambda i: starts_with(substr(t, i), n)) ELSE [] END AS spots FROM m),
c AS (SELECT sp_id, list_transform(spots, lambda p: substr(t, greatest(p - 300, 1), (p + length(n) + 300 - greatest(p - 300, 1))::BIGINT)) AS cs FROM s)
SELECT sp_id, coalesce(list_sum(list_transform(cs, lambda c: {" + ".join(f"contains(c, '{w}')::INT" for w in mining.MADE)})) > 0
  AND list_sum(list_transform(cs, lambda c: {" + ".join(f"contains(c, '{w}')::INT" for w in mining.GOT)})) = 0, false) AS made FROM c""")
def s88_made_here(spark: SparkSession, d: str) -> DataFrame:
    """Mentions whose context tells that the tool was made."""
    return table(spark, d, "submission_mentions").select("sp_id", mining.made_here(F.col("_context"), F.col("_toolName")).alias("made"))


@query(r"""
WITH f AS (SELECT sp_id, _toolName, _toolType, lower(trim(_toolName)) AS low, coalesce(contains(lower(_publicationTitle), lower(_toolName)), false) AS t FROM submission_mentions),
r AS (SELECT DISTINCT lower(resourceName) AS k, resourceType AS y FROM tool_resources WHERE resourceName IS NOT NULL)
SELECT sp_id, CASE WHEN r.k IS NOT NULL THEN 'existing' WHEN low IN ('imagej') THEN 'excluded' WHEN low IN ('graphpad') THEN 'known' WHEN t THEN 'novel' ELSE 'review' END AS status
FROM f LEFT JOIN r ON r.k = low AND r.y = f._toolType""")
def s89_route(spark: SparkSession, d: str) -> DataFrame:
    """Mentioned tools by where they are known."""
    m = table(spark, d, "submission_mentions")
    registry = table(spark, d, "tool_resources").where("resourceName IS NOT NULL").select(F.lower("resourceName").alias("key"), F.col("resourceType").alias("kind"))
    title = F.coalesce(F.contains(F.lower("_publicationTitle"), F.lower("_toolName")), F.lit(False))
    return mining.route(m, "_toolName", "_toolType", registry, ["graphpad"], ["imagej"], title).select("sp_id", "status")


@query(r"""
WITH r AS (
  SELECT pub_row_id, 0 AS i, 'grant' AS rule, 0.9::DOUBLE AS confidence, unnest(regexp_extract_all(abstract, '\b([A-Z]{2,}-\d+)\b', 1)) AS name FROM publications
  UNION ALL SELECT pub_row_id, 1, 'gene', 0.7, unnest(regexp_extract_all(abstract, '\b([A-Z][A-Z0-9]{2,6})\b', 1)) FROM publications),
k AS (SELECT *, row_number() OVER (PARTITION BY pub_row_id, lower(trim(name)) ORDER BY i, trim(name)) AS n FROM r WHERE trim(name) <> '')
SELECT pub_row_id, trim(name) AS name, rule, confidence FROM k WHERE n = 1""")
def s90_by_rules(spark: SparkSession, d: str) -> DataFrame:
    """Codes in abstracts by two rules, the first of which wins."""
    return extract.by_rules(table(spark, d, "publications"), "pub_row_id", "abstract", [("grant", r"\b([A-Z]{2,}-\d+)\b", 1, 0.9), ("gene", r"\b([A-Z][A-Z0-9]{2,6})\b", 1, 0.7)])


@query(r"""
WITH m AS (SELECT pub_row_id, list_filter(regexp_extract_all(abstract, '(\d+) (?:samples|patients)', 1), lambda x: x <> '' AND NOT regexp_matches(x, '^1$')) AS a, list_filter(regexp_extract_all(abstract, '(\d+)%', 1), lambda x: x <> '' AND NOT regexp_matches(x, '^1$')) AS b FROM publications)
SELECT pub_row_id, coalesce(a[1], b[1]) AS found FROM m""")
def s91_ordered_extract(spark: SparkSession, d: str) -> DataFrame:
    """A number of samples, else a percentage, but not 1."""
    return table(spark, d, "publications").select("pub_row_id", extract.ordered_extract(F.col("abstract"), [(r"(\d+) (?:samples|patients)", 1), (r"(\d+)%", 1)], "^1$").alias("found"))


@query("SELECT pub_row_id, CASE WHEN abstract IS NOT NULL THEN 'ABSTRACT: ' || abstract || ' ' || coalesce(methods, '') END AS labelled FROM publications WHERE abstract IS NOT NULL AND methods IS NOT NULL")
def s92_labelled_text(spark: SparkSession, d: str) -> DataFrame:
    """Abstracts with their label and methods without one."""
    parts = F.array(F.struct(F.lit("Abstract").alias("label"), F.col("abstract").alias("text")), F.struct(F.lit("").alias("label"), F.col("methods").alias("text")))
    return table(spark, d, "publications").where("abstract IS NOT NULL AND methods IS NOT NULL").select("pub_row_id", extract.labelled_text(parts).alias("labelled"))


_PATHS = {"kind": ("modelSystemType", "tumorType"), "diagnosis": ("patientDiagnosis",), "none": ("noSuchField",)}


@query("SELECT coalesce(nullif(modelSystemType, ''), nullif(tumorType, ''), '') AS kind, coalesce(nullif(patientDiagnosis, ''), '') AS diagnosis, '' AS none, upper(modelName) AS name FROM patient_models")
def s93_build(spark: SparkSession, d: str) -> DataFrame:
    """Models by a declarative mapping."""
    return comp.build(table(spark, d, "patient_models"), {**_PATHS, "name": F.upper("modelName")})


@query("""
WITH p AS (SELECT resourceId, list({'u': _usageType, 'p': _pmid, 's': sp_id} ORDER BY sp_id) AS l FROM submission_mentions WHERE resourceId IS NOT NULL GROUP BY 1)
SELECT resourceId, coalesce(list_filter(l, lambda x: x.u = 'Development')[1].s, l[1].s) AS lead FROM p""")
def s94_lead_publication(spark: SparkSession, d: str) -> DataFrame:
    """The first development mention of each tool, else the first."""
    m = table(spark, d, "submission_mentions").where("resourceId IS NOT NULL")
    pubs = m.groupBy("resourceId").agg(F.sort_array(F.collect_list(F.struct("sp_id", "_usageType"))).alias("pubs"))
    return pubs.select("resourceId", comp.lead_publication(F.col("pubs"))["sp_id"].alias("lead"))


@query("SELECT sp_id, CASE WHEN coalesce(_toolType, '') <> '' THEN _toolType WHEN coalesce(contains(lower(_context), 'antibody'), false) THEN 'antibody' WHEN coalesce(contains(lower(_toolName), 'cell'), false) THEN 'cell_line' ELSE '' END AS kind FROM submission_mentions")
def s95_detect(spark: SparkSession, d: str) -> DataFrame:
    """Types as told, else by the first probe that holds."""
    return table(spark, d, "submission_mentions").select("sp_id", comp.detect(F.col("_toolType"), [(F.contains(F.lower("_context"), F.lit("antibody")), "antibody"), (F.contains(F.lower("_toolName"), F.lit("cell")), "cell_line")]).alias("kind"))


@query("SELECT publicationId, pub_row_id FROM (SELECT *, row_number() OVER (PARTITION BY publicationId ORDER BY dateAdded NULLS FIRST, pub_row_id) AS n FROM publications) WHERE n = 1")
def s96_first_per(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each publication."""
    return pivot.first_per(table(spark, d, "publications").select("publicationId", "pub_row_id", "dateAdded"), "publicationId", ["dateAdded", "pub_row_id"]).select("publicationId", "pub_row_id")


@query("""
WITH v AS (SELECT unnest([('usage_links', 'resourceId'), ('development_links', 'resourceId'), ('usage_links', 'publicationId'), ('development_links', 'publicationId')]) AS x)
SELECT 'fk_orphan' AS check, 'usage_links' AS table, 'resourceId' AS column, resourceId AS value, count(*) AS n FROM usage_links WHERE resourceId IS NOT NULL AND resourceId NOT IN (SELECT resourceId FROM tool_resources WHERE resourceId IS NOT NULL) GROUP BY resourceId
UNION ALL SELECT 'fk_orphan', 'development_links', 'resourceId', resourceId, count(*) FROM development_links WHERE resourceId IS NOT NULL AND resourceId NOT IN (SELECT resourceId FROM tool_resources WHERE resourceId IS NOT NULL) GROUP BY resourceId
UNION ALL SELECT 'fk_orphan', 'usage_links', 'publicationId', publicationId, count(*) FROM usage_links WHERE publicationId IS NOT NULL AND publicationId NOT IN (SELECT publicationId FROM publications WHERE publicationId IS NOT NULL) GROUP BY publicationId
UNION ALL SELECT 'fk_orphan', 'development_links', 'publicationId', publicationId, count(*) FROM development_links WHERE publicationId IS NOT NULL AND publicationId NOT IN (SELECT publicationId FROM publications WHERE publicationId IS NOT NULL) GROUP BY publicationId""")
def s97_all_fk(spark: SparkSession, d: str) -> DataFrame:
    """Orphans of all foreign keys that the tables' schemas show."""
    names = ("tool_resources", "publications", "usage_links", "development_links")
    return quality.all_fk_orphans({n: table(spark, d, n) for n in names}, {"tool_resources": "resourceId", "publications": "publicationId"})


@query(r"""
WITH m AS (SELECT sp_id, _fundingAgency AS f FROM submission_mentions)
SELECT sp_id, CASE WHEN coalesce(f, '') IN ('', 'NULL') THEN NULL ELSE '[' || array_to_string(list_transform(list_filter(list_transform(regexp_extract_all(f, '(?:[^;(\[]|\([^)]*\)?|\[[^\]]*\]?)+'), lambda x: trim(x, ' ')), lambda x: x <> ''), lambda x: to_json(x)::VARCHAR), ',') || ']' END AS agencies FROM m""")
def s98_json_list(spark: SparkSession, d: str) -> DataFrame:
    """Funding agencies as JSON arrays; applied twice, which changes nothing."""
    return table(spark, d, "submission_mentions").select("sp_id", text.json_list(text.json_list(F.col("_fundingAgency"))).alias("agencies"))


@query("""
WITH i AS (SELECT developmentId, arg_min(_source, (linkDate, usageId)) AS s FROM (SELECT d.developmentId, u._source, u.linkDate, u.usageId FROM development_links d JOIN usage_links u ON u.resourceId = d.resourceId AND u.publicationId = d.publicationId) GROUP BY 1)
SELECT action, count(*) AS n FROM (
  SELECT CASE WHEN s.k IS NULL THEN 'none' WHEN s.v.src IS DISTINCT FROM d._source THEN 'update' ELSE 'same' END AS action
  FROM development_links d LEFT JOIN (SELECT (resourceId, publicationId) AS k, resourceId AS r, publicationId AS p, arg_min({'src': _source}, (linkDate, usageId, _ingestedAt)) AS v FROM usage_links WHERE resourceId IS NOT NULL AND publicationId IS NOT NULL GROUP BY ALL) s ON s.r = d.resourceId AND s.p = d.publicationId
  UNION ALL SELECT 'insert' FROM usage_links u WHERE NOT EXISTS (SELECT 1 FROM development_links d WHERE d.resourceId = u.resourceId AND d.publicationId = u.publicationId)) GROUP BY 1""")
def s99_match_pair(spark: SparkSession, d: str) -> DataFrame:
    """Development links matched by their pair with usage links, all matches updated."""
    got = reconcile.match_by(table(spark, d, "development_links"), table(spark, d, "usage_links"), ["resourceId", "publicationId"], ["_source"], ["linkDate", "usageId", "_ingestedAt"], pair=True)
    return got.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT pub_row_id::VARCHAR AS pub_row_id, coalesce(journal, '') AS journal, '' AS lacking, coalesce(publicationTitle, '') AS publicationTitle FROM publications")
def s100_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Publications written as CSV in the shared folder and read again as text."""
    import uuid

    path = f"{lineage.shared_folder(spark)}/csv-{uuid.uuid4()}"
    columns = ["pub_row_id", "journal", "lacking", "publicationTitle"]
    files.write_csv(table(spark, d, "publications"), path, columns)
    return files.text_csv(spark, path, columns)


@query("""SELECT key, review_id FROM (SELECT coalesce(trim(replace(pmid, 'PMID:', '')), '') AS key, review_id, row_number() OVER (PARTITION BY trim(replace(pmid, 'PMID:', '')) ORDER BY received_at DESC NULLS LAST, review_id) AS n FROM review_results) WHERE key <> '' AND n = 1""")
def s101_merge_cache(spark: SparkSession, d: str) -> DataFrame:
    """The latest review of each publication, of two halves merged as caches."""
    r = table(spark, d, "review_results").select(F.col("pmid").alias("key"), F.lit("x").alias("cache_level"), F.col("received_at").alias("fetch_date"), "review_id")
    r = r.groupBy("key", "cache_level", "fetch_date").agg(F.min("review_id").alias("review_id"))
    return files.merge_cache(r, r.limit(0), ["x"], "key").select("key", "review_id")


@query("""
WITH o AS (SELECT o_custkey, string_agg(DISTINCT CASE o_orderstatus WHEN 'F' THEN 'finished; ' WHEN 'O' THEN 'open;' ELSE ' pending ' END, ';') AS l FROM orders GROUP BY 1)
SELECT c_mktsegment, trim(f) AS field, count(*) AS n FROM (SELECT c_mktsegment, unnest(string_split(l, ';')) AS f FROM o JOIN customer ON c_custkey = o_custkey) WHERE trim(f) <> '' GROUP BY ALL""")
def s102_missing_counts(spark: SparkSession, d: str) -> DataFrame:
    """How often each item of a separated list occurs per segment."""
    o = table(spark, d, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "F", "finished; ").when(F.col("o_orderstatus") == "O", "open;").otherwise(" pending ").alias("s")).distinct()
    lists = o.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list("s")), ";").alias("l"))
    return stats.missing_counts(lists.join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")), "c_mktsegment", "l")


@query("SELECT sp_id, row_number() OVER (ORDER BY regexp_replace(_toolName, '\\d.*$', '') NULLS FIRST, try_cast(nullif(regexp_extract(_toolName, '(\\d+)', 1), '') AS DECIMAL(38, 0)) NULLS FIRST, _toolName NULLS FIRST, sp_id)::INT AS place FROM submission_mentions QUALIFY place <= 500")
def s103_numeric_sort(spark: SparkSession, d: str) -> DataFrame:
    """The first 500 mentions in order of the tools' names, numbers by their value (a top-k report)."""
    first = table(spark, d, "submission_mentions").select("sp_id", "_toolName").orderBy(*text.numeric_order(F.col("_toolName")), "sp_id").limit(500)
    listed = first.groupBy().agg(F.sort_array(F.collect_list(F.struct(*(c.alias(f"k{i}") for i, c in enumerate(text.numeric_order(F.col("_toolName")))), "sp_id"))).alias("l"))
    return listed.select(F.posexplode("l").alias("p", "x")).select("x.sp_id", (F.col("p") + 1).alias("place"))


@query("SELECT sp_id, preprint FROM (SELECT sp_id, coalesce(contains(lower(_doi), '10.1101') OR contains(lower(_doi), '10.999'), false) AS preprint FROM submission_mentions)")
def s104_preprint(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of preprints by marks in the DOI."""
    return table(spark, d, "submission_mentions").select("sp_id", predicates.preprint(F.lit(None).cast("string"), F.col("_doi"), ["biorxiv"], ["10.1101", "10.999"]).alias("preprint"))


@query("""
WITH n AS (SELECT entry_id, lower(split_part(trim(developerName), ' ', 1)) AS f, lower(split_part(trim(developerName), ' ', -1)) AS l FROM developer_entries WHERE developerName IS NOT NULL)
SELECT entry_id, (CASE WHEN l = 'jusford' THEN 2 ELSE 0 END + CASE WHEN f = 'susannah' THEN 1 ELSE 0 END + CASE WHEN f LIKE 's%' THEN 1 ELSE 0 END)::INT AS score FROM n""")
def s105_name_score(spark: SparkSession, d: str) -> DataFrame:
    """How well entries fit one person's name."""
    words = F.split(F.trim("developerName"), " ")
    e = table(spark, d, "developer_entries").where("developerName IS NOT NULL")
    return e.select("entry_id", scoring.name_score(F.get(words, F.lit(0)), F.element_at(words, -1), F.lit("Susannah"), F.lit("Jusford")).alias("score"))


@query(r"SELECT patientDerivedModelId, _modified, trim(a) AS diagnosis, trim(b) AS tumor FROM (SELECT patientDerivedModelId, _modified, unnest(CASE WHEN len(x) > 0 THEN x ELSE [''] END) AS a, y FROM (SELECT patientDerivedModelId, _modified, list_filter(list_transform(string_split(coalesce(patientDiagnosis, ''), ';'), lambda v: trim(v)), lambda v: v <> '') AS x, list_filter(list_transform(string_split(coalesce(tumorType, ''), ';'), lambda v: trim(v)), lambda v: v <> '') AS y FROM patient_models)), unnest(CASE WHEN len(y) > 0 THEN y ELSE [''] END) AS t(b)")
def s106_fan_out(spark: SparkSession, d: str) -> DataFrame:
    """A row per diagnosis and tumour of each model."""
    p = table(spark, d, "patient_models").select("patientDerivedModelId", "_modified", "patientDiagnosis", "tumorType")
    return comp.fan_out(p, {"diagnosis": "patientDiagnosis", "tumor": "tumorType"}).select("patientDerivedModelId", "_modified", "diagnosis", "tumor")
