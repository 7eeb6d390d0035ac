"""Queries of the curation pipeline's operators over the driver's tables, with SQL for each that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatella.functions import blank, ids, scoring, text
from curatella.operators import compile as comp
from curatella.operators import extract, mining, pivot, predicates, quality, reconcile, resolve, stats
from curatella.sources.tables import table
from curatella.streaming import incremental

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


TOOL_TYPES = ["animal_model", "antibody", "biobank", "cell_line", "clinical_assessment_tool", "computational_tool", "genetic_reagent", "organoid_protocol", "patient_derived_model"]
USAGES = ["Development", "Usage", "Experimental Usage", "Citation Only"]
CATEGORY_NAMES = [name for _, name in scoring.CATEGORIES] + [scoring.TOP]
_FILLED = "({0} IS NOT NULL AND {0} NOT IN ('', 'NULL'))"

_SCORES = """
obs AS (SELECT o_custkey, sum((o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT) AS d, sum((o_orderpriority NOT IN ('1-URGENT', '2-HIGH'))::INT) AS w
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
scored AS (SELECT c.*, (CASE WHEN c_acctbal > 0 THEN 15.0 ELSE 0 END + CASE WHEN c_custkey % 5 <> 0 THEN 7.5 ELSE 0 END
    + CASE WHEN o.o_custkey IS NOT NULL THEN 7.5 ELSE 0 END + least(25.0, coalesce(d, 0) * 7.5 + coalesce(w, 0) * 2.5))::DOUBLE AS score
  FROM customer c LEFT JOIN obs o ON o_custkey = c_custkey)
"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """Customers as entities: availability by account and key, observations by finished orders."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    obs = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count(F.when(urgent, 1)).alias("d"), F.count(F.when(~urgent, 1)).alias("w"))
    base = table(spark, d, "customer").join(obs, F.col("o_custkey") == F.col("c_custkey"), "left")
    part = F.when(F.col("c_acctbal") > 0, 15.0).otherwise(0.0) + F.when(F.col("c_custkey") % 5 != 0, 7.5).otherwise(0.0) + F.when(F.col("o_custkey").isNotNull(), 7.5).otherwise(0.0)
    return base.withColumn("score", part + scoring.observation_points(F.col("d"), F.col("w")))


@query(
    f"WITH {_SCORES} SELECT c_mktsegment, count(score) AS n, round(avg(score), 6) AS mean, median(score) AS median, min(score) AS min, max(score) AS max, round(stddev_samp(score), 6) AS sd, "
    "count(*) FILTER (score <= 20) AS n_minimal, count(*) FILTER (score > 20 AND score <= 40) AS n_poor, count(*) FILTER (score > 40 AND score <= 60) AS n_fair, count(*) FILTER (score > 60 AND score <= 80) AS n_good, count(*) FILTER (score > 80) AS n_excellent "
    "FROM scored GROUP BY 1"
)
def s01_score_summary(spark: SparkSession, d: str) -> DataFrame:
    """Scores per segment with the counts of categories."""
    s = _scored(spark, d).withColumn("category", scoring.category(F.col("score")))
    one = stats.summary(s, "c_mktsegment", "score").withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})
    return one.join(stats.counts_by(s, "c_mktsegment", "category", CATEGORY_NAMES), "c_mktsegment")


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS doi FROM orders WHERE o_orderstatus = 'F'),
r AS (SELECT *, coalesce(sum(CASE WHEN doi THEN 7.5 ELSE 2.5 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o)
SELECT o_custkey, count(*) FILTER (doi) || ' with DOI, ' || count(*) FILTER (NOT doi) || ' without DOI' AS status FROM r WHERE before < 25 GROUP BY 1""")
def s02_observation_status(spark: SparkSession, d: str) -> DataFrame:
    """Observations counted before the cap, per entity."""
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").withColumn("doi", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    o = o.where(F.lit(True)).withColumn("_counted", scoring.counted_before_cap(F.col("doi"), ["o_custkey"], ["o_orderkey"])).where("_counted")
    return o.groupBy("o_custkey").agg(F.concat(F.count(F.when(F.col("doi"), 1)).cast("string"), F.lit(" with DOI, "), F.count(F.when(~F.col("doi"), 1)).cast("string"), F.lit(" without DOI")).alias("status"))


_FIELDS = ["rrid", "description", "synonyms", "usageRequirements", "howToAcquire"]


@query(f"SELECT resourceType, concat_ws('; ', {', '.join(f'CASE WHEN NOT {_FILLED.format(c)} THEN {chr(39)}{c}{chr(39)} END' for c in _FIELDS)}) AS missing, count(*) AS n FROM tool_resources GROUP BY ALL")
def s03_missing_fields(spark: SparkSession, d: str) -> DataFrame:
    """Which fields resources lack, by type."""
    t = table(spark, d, "tool_resources")
    return t.select("resourceType", scoring.missing([(c, blank.is_filled(F.col(c))) for c in _FIELDS]).alias("missing")).groupBy("resourceType", "missing").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT _toolType, {', '.join(f'count(*) FILTER (_usageType = {chr(39)}{u}{chr(39)}) * 100.0::DOUBLE / nullif(count(_usageType), 0) AS pct_{u.lower().replace(chr(32), chr(95))}' for u in USAGES)} FROM submission_mentions WHERE _toolType IS NOT NULL GROUP BY 1")
def s04_crosstab_pct(spark: SparkSession, d: str) -> DataFrame:
    """Usage types in per cent of each tool type's mentions."""
    return stats.row_shares(table(spark, d, "submission_mentions"), "_toolType", "_usageType", USAGES)


@query("""
WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT least(20, floor((o_totalprice - lo) / ((hi - lo) / 20))::INT + 1) AS bin, count(*) AS n FROM orders, e WHERE o_totalprice IS NOT NULL GROUP BY 1""")
def s05_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Twenty equal-width bins of order totals."""
    return stats.histogram(table(spark, d, "orders"), "o_totalprice", 20)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice IS NOT NULL ORDER BY o_totalprice, o_orderkey LIMIT 10")
def s06_bottom_k(spark: SparkSession, d: str) -> DataFrame:
    """The ten smallest orders."""
    return stats.extreme_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10, ["o_orderkey"], largest=False)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def s07_top_k_filtered(spark: SparkSession, d: str) -> DataFrame:
    """The twenty largest finished orders."""
    return stats.extreme_k(table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), "o_totalprice", 20, ["o_orderkey"], largest=True)


_COMPLETE = [*_FIELDS, "resourceName", "aiSummary", "animalModelId", "antibodyId", "cellLineId"]


@query(" UNION ALL ".join(f"SELECT resourceType, '{c}' AS field, count(*) AS n, count(*) FILTER {'(WHERE ' + _FILLED.format(c) + ')'} AS n_filled, round(count(*) FILTER (WHERE {_FILLED.format(c)}) * 100::DOUBLE / count(*), 1) AS pct FROM tool_resources GROUP BY 1" for c in _COMPLETE))
def s08_field_completion(spark: SparkSession, d: str) -> DataFrame:
    """Per cent of filled cells by type and column."""
    return stats.completion(table(spark, d, "tool_resources"), "resourceType", _COMPLETE)


@query("""
WITH m AS (SELECT DISTINCT c_nationkey, c_custkey FROM customer), l AS (SELECT DISTINCT o_custkey FROM orders)
SELECT c_nationkey, count(*) AS n_keys, count(o_custkey) AS n_linked, count(*) - count(o_custkey) AS n_unlinked, round(count(o_custkey) * 100::DOUBLE / count(*), 1) AS pct_linked
FROM m LEFT JOIN l ON o_custkey = c_custkey GROUP BY 1""")
def s09_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Customers of each nation with and without orders."""
    return stats.coverage(table(spark, d, "customer"), "c_nationkey", "c_custkey", table(spark, d, "orders"), "o_custkey")


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM c)
SELECT user_id, string_agg(event_type || '(' || n || ')', ', ' ORDER BY rn) AS top FROM r WHERE rn <= 3 GROUP BY 1""")
def s10_top_values(spark: SparkSession, d: str) -> DataFrame:
    """The three most frequent event types of each user."""
    return stats.top_values(table(spark, d, "events"), "user_id", "event_type")


@query("""
SELECT r_name, p_brand, count(*) AS n_lines, sum(l_extendedprice::DECIMAL(15, 2) * (1 - l_discount::DECIMAL(4, 2)))::DOUBLE AS revenue, count(DISTINCT l_suppkey) AS n_suppliers
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def s11_star_join(spark: SparkSession, d: str) -> DataFrame:
    """Left joins from the fact to all its dimensions."""
    t = {n: table(spark, d, n) for n in ("lineitem", "orders", "customer", "nation", "region", "part")}
    j = t["lineitem"].join(t["orders"], F.col("o_orderkey") == F.col("l_orderkey"), "left").join(t["customer"], F.col("c_custkey") == F.col("o_custkey"), "left")
    j = j.join(t["nation"], F.col("n_nationkey") == F.col("c_nationkey"), "left").join(t["region"], F.col("r_regionkey") == F.col("n_regionkey"), "left").join(t["part"], F.col("p_partkey") == F.col("l_partkey"), "left")
    return j.groupBy("r_name", "p_brand").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_extendedprice").cast("decimal(15,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("double").alias("revenue"), F.countDistinct("l_suppkey").alias("n_suppliers"))


@query("""
WITH a AS (SELECT publicationId AS k, 0 AS source_rank FROM usage_links WHERE publicationId IS NOT NULL AND publicationId NOT IN (SELECT publicationId FROM development_links WHERE publicationId IS NOT NULL)),
b AS (SELECT publicationId AS k, 1 AS source_rank FROM publications WHERE publicationId NOT IN (SELECT publicationId FROM usage_links WHERE publicationId IS NOT NULL))
SELECT k AS "publicationId", min(source_rank) AS source_rank FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1""")
def s12_unlinked_union(spark: SparkSession, d: str) -> DataFrame:
    """Publications without development links, then those without usage links; the first source wins."""
    use, dev, pubs = (table(spark, d, n) for n in ("usage_links", "development_links", "publications"))
    return reconcile.unlinked([(use.where("publicationId IS NOT NULL"), dev), (pubs, use)], "publicationId", ["publicationId"])


_PMID = "trim(replace(coalesce({0}, ''), 'PMID:', ''))"


@query(f"""
WITH i AS (SELECT *, {_PMID.format('pmid')} AS k FROM publications WHERE pub_row_id % 2 = 1),
c AS (SELECT {_PMID.format('pmid')} AS k FROM publications WHERE pub_row_id % 2 = 0)
SELECT k, min(pub_row_id) AS pub_row_id FROM i WHERE k NOT IN (SELECT k FROM c) GROUP BY 1""")
def s13_insert_only(spark: SparkSession, d: str) -> DataFrame:
    """Publications to insert: keys normalised before they are compared and before duplicates are found."""
    p = table(spark, d, "publications").select("pub_row_id", "pmid")
    new = reconcile.insert_new(p.where("pub_row_id % 2 = 1"), p.where("pub_row_id % 2 = 0"), {"pmid": ids.pmid_bare(F.col("pmid"))}, {"pmid": ids.pmid_bare(F.col("pmid"))}, ["pub_row_id"])
    return new.select(ids.pmid_bare(F.col("pmid")).alias("k"), "pub_row_id")


@query("""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS seg, c_name FROM customer),
i AS (SELECT c_custkey, c_mktsegment AS seg, CASE WHEN c_custkey % 6 = 0 THEN c_name || '*' ELSE c_name END AS c_name FROM customer WHERE c_custkey % 2 = 0),
j AS (SELECT c.c_custkey, c.seg, c.c_name, i.seg AS ns, i.c_name AS nn, (c.seg IS NULL OR c.seg = '') AND i.seg IS NOT NULL AND i.seg <> '' AS ps, i.c_name IS NOT NULL AND i.c_name <> c.c_name AS pn FROM c LEFT JOIN i ON i.c_custkey = c.c_custkey)
SELECT c_custkey, CASE WHEN ps THEN ns ELSE seg END AS seg, CASE WHEN pn THEN nn ELSE c_name END AS c_name, concat_ws(',', CASE WHEN ps THEN 'seg' END, CASE WHEN pn THEN 'c_name' END) AS _patched FROM j""")
def s14_patch_blank(spark: SparkSession, d: str) -> DataFrame:
    """Blanks filled, and one field overwritten where it differs."""
    c = table(spark, d, "customer")
    key = F.col("c_custkey")
    current = c.select(key, F.when(key % 7 == 0, "").when(key % 11 == 0, None).otherwise(F.col("c_mktsegment")).alias("seg"), "c_name")
    incoming = c.where(key % 2 == 0).select(key, F.col("c_mktsegment").alias("seg"), F.when(key % 6 == 0, F.concat("c_name", F.lit("*"))).otherwise(F.col("c_name")).alias("c_name"))
    return reconcile.patch_blank(current, incoming, "c_custkey", ["seg"], ("c_name",))


@query("""
WITH i AS (SELECT c_custkey, c_acctbal + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS bal FROM customer WHERE c_custkey % 4 <> 0), c AS (SELECT c_custkey, c_acctbal AS bal FROM customer WHERE c_custkey % 3 <> 0)
SELECT coalesce(i.c_custkey, c.c_custkey) AS c_custkey, CASE WHEN c.c_custkey IS NULL THEN 'insert' WHEN i.c_custkey IS NULL THEN 'missing' WHEN i.bal IS NOT DISTINCT FROM c.bal THEN 'same' ELSE 'update' END AS action
FROM i FULL JOIN c ON i.c_custkey = c.c_custkey""")
def s15_sync_actions(spark: SparkSession, d: str) -> DataFrame:
    """What a full sync does to each key."""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("bal"))
    incoming = c.where("c_custkey % 4 <> 0").withColumn("bal", F.col("bal") + F.when(F.col("c_custkey") % 5 == 0, 1).otherwise(0))
    return reconcile.sync(c.where("c_custkey % 3 <> 0"), incoming, "c_custkey", ["bal"])


@query("""
WITH i AS (SELECT * FROM development_links WHERE _source IN ('mining', 'formspark')), c AS (SELECT * FROM development_links WHERE _source NOT IN ('mining', 'formspark')),
ci AS (SELECT DISTINCT developmentId AS id FROM c), cp AS (SELECT resourceId, funderId, bool_or(publicationId IS NOT NULL) AS linked FROM c GROUP BY ALL),
t AS (SELECT i.*, ci.id, cp.linked, row_number() OVER (PARTITION BY i.resourceId, i.funderId, ci.id IS NULL ORDER BY i.developmentId, i._ingestedAt) AS rn
  FROM i LEFT JOIN ci ON ci.id = i.developmentId LEFT JOIN cp ON cp.resourceId = i.resourceId AND cp.funderId = i.funderId)
SELECT action, count(*) AS n FROM (SELECT CASE WHEN id IS NOT NULL THEN 'skip_id' WHEN rn > 1 THEN 'duplicate' WHEN linked THEN 'skip_pair' WHEN linked IS NOT NULL AND publicationId IS NOT NULL THEN 'patch' WHEN linked IS NOT NULL THEN 'skip_pair' ELSE 'insert' END AS action FROM t) GROUP BY 1""")
def s16_route_links(spark: SparkSession, d: str) -> DataFrame:
    """Development links to insert, patch or skip, by id and then by (resource, funder)."""
    t = table(spark, d, "development_links")
    mined = F.col("_source").isin("mining", "formspark")
    routed = reconcile.route_links(t.where(mined), t.where(~mined), ["resourceId", "funderId"], "publicationId", "developmentId", ["developmentId", "_ingestedAt"])
    return routed.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH f AS (SELECT publicationId, min(pub_row_id) AS keep FROM publications WHERE publicationId IS NOT NULL GROUP BY 1)
SELECT pub_row_id FROM publications p LEFT JOIN f ON f.publicationId = p.publicationId WHERE keep IS NULL OR pub_row_id > keep""")
def s17_delete_set(spark: SparkSession, d: str) -> DataFrame:
    """Rows without a key and later duplicates."""
    return reconcile.delete_set(table(spark, d, "publications"), "publicationId", "pub_row_id")


@query("""
WITH v AS (SELECT DISTINCT resourceId FROM tool_resources), a AS (SELECT cellLineId AS k, min(resourceId) AS r FROM tool_resources WHERE cellLineId IS NOT NULL GROUP BY 1),
x AS (SELECT CASE WHEN hash_key % 9 = 0 THEN c.cellLineId ELSE u.resourceId END AS fk FROM (SELECT *, ascii(usageId) AS hash_key FROM usage_links) u LEFT JOIN (SELECT resourceId, min(cellLineId) AS cellLineId FROM tool_resources GROUP BY 1) c ON c.resourceId = u.resourceId)
SELECT CASE WHEN fk IS NULL OR v.resourceId IS NOT NULL THEN 'keep' WHEN a.r IS NOT NULL THEN 'fix' ELSE 'delete' END AS action, count(*) AS n FROM x LEFT JOIN v ON v.resourceId = fk LEFT JOIN a ON a.k = fk GROUP BY 1""")
def s18_repair_fk(spark: SparkSession, d: str) -> DataFrame:
    """Keys that are another table's ids are mapped back; what can't be resolved is deleted."""
    tools = table(spark, d, "tool_resources")
    detail = tools.groupBy("resourceId").agg(F.min("cellLineId").alias("cellLineId"))
    use = table(spark, d, "usage_links").join(detail, "resourceId", "left").select(F.when(F.ascii("usageId") % 9 == 0, F.col("cellLineId")).otherwise(F.col("resourceId")).alias("fk"))
    return reconcile.repair_fk(use, "fk", tools, "resourceId", tools.where("cellLineId IS NOT NULL"), "cellLineId", "resourceId").groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH g AS (SELECT DISTINCT resourceId FROM tool_resources WHERE dateRemoved IS NOT NULL)
SELECT 'usage_links' AS name, count(*) AS n FROM usage_links WHERE resourceId IN (SELECT resourceId FROM g) UNION ALL SELECT 'development_links', count(*) FROM development_links WHERE resourceId IN (SELECT resourceId FROM g)""")
def s19_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Rows that go with the removed resources."""
    gone = reconcile.cascade(table(spark, d, "tool_resources").where("dateRemoved IS NOT NULL"), "resourceId", {n: (table(spark, d, n), "resourceId") for n in ("usage_links", "development_links")})
    out = [g.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n, g in gone.items()]
    return out[0].unionByName(out[1])


@query("SELECT 'fk_orphan' AS check, 'usage_links' AS table, 'resourceId' AS \"column\", resourceId AS value, count(*) AS n FROM usage_links u WHERE resourceId IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tool_resources t WHERE t.resourceId = u.resourceId) GROUP BY resourceId")
def s20_fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Keys, as spelt, that the parent table lacks."""
    return quality.fk_orphans(table(spark, d, "usage_links"), "usage_links", "resourceId", table(spark, d, "tool_resources"), "resourceId")


@query(f"SELECT 'enum' AS check, 'submission_mentions' AS table, '_usageType' AS \"column\", v AS value, count(*) AS n FROM (SELECT trim(unnest(string_split(_usageType, ','))) AS v FROM submission_mentions WHERE _usageType IS NOT NULL) WHERE v <> '' AND v NOT IN ({', '.join(chr(39) + u + chr(39) for u in USAGES)}) GROUP BY v")
def s21_enum_violations(spark: SparkSession, d: str) -> DataFrame:
    """Usage types outside the enumeration."""
    return quality.enum_violations(table(spark, d, "submission_mentions"), "submission_mentions", "_usageType", USAGES)


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT 'required' AS check, 'publications' AS table, '{c}' AS \"column\", NULL::VARCHAR AS value, count(*) FILTER ({c} IS NULL) AS n FROM publications" for c in ("publicationId", "doi", "pmid", "journal", "abstract")) + ") WHERE n > 0")
def s22_required(spark: SparkSession, d: str) -> DataFrame:
    """Nulls in required columns."""
    return quality.required(table(spark, d, "publications"), "publications", ["publicationId", "doi", "pmid", "journal", "abstract"])


_NAME_KEY = r"regexp_replace(lower(regexp_replace({0}, '(?i)\s*\([^)]*(?:RRID|ATCC|cat\.?|catalog|CRL-|CVCL_|lot)[^)]*\)', '', 'g')), '[^\p{{L}}\p{{M}}\p{{N}}_]+', '', 'g')"


@query(f"SELECT {_NAME_KEY.format('resourceName')} AS name_key, resourceType, count(*) AS n_rows, count(DISTINCT resourceName) AS n_names, count(DISTINCT resourceId) AS n_ids FROM tool_resources GROUP BY 1, 2")
def s23_name_keys(spark: SparkSession, d: str) -> DataFrame:
    """Resources whose names meet under one key."""
    t = table(spark, d, "tool_resources").withColumn("name_key", text.name_key(F.col("resourceName"), F.lit("resources")))
    return t.groupBy("name_key", "resourceType").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("resourceName").alias("n_names"), F.countDistinct("resourceId").alias("n_ids"))


@query("""
WITH n AS (SELECT resourceId AS id, dateAdded, 0 AS s, resourceName AS nm FROM tool_resources UNION ALL SELECT resourceId, dateAdded, 1, regexp_replace(resourceName, '(?i)^(?:human|mouse|rat)\\s+', '') FROM tool_resources
  UNION ALL SELECT resourceId, dateAdded, 9, unnest(regexp_split_to_array(synonyms, '\\s*,\\s*')) FROM tool_resources WHERE synonyms IS NOT NULL),
r AS (SELECT lower(trim(nm)) AS key, id, row_number() OVER (PARTITION BY lower(trim(nm)) ORDER BY dateAdded NULLS FIRST, s, id) AS rn FROM n WHERE nm IS NOT NULL AND trim(nm) <> '')
SELECT key, id FROM r WHERE rn = 1""")
def s24_lookup_index(spark: SparkSession, d: str) -> DataFrame:
    """Name or synonym to resource, the first added wins."""
    return resolve.lookup_index(table(spark, d, "tool_resources"), "resourceId", "resourceName", "synonyms", lambda c: F.lower(F.trim(c)), ["dateAdded"])


@query("""
WITH w AS (SELECT p_partkey, list_distinct(list_filter(string_split(lower(regexp_replace(p_name, '[-_/.,;:()\\s]+', ' ', 'g')), ' '), lambda x: x <> '')) AS a, list_distinct(list_filter(string_split(lower(regexp_replace(p_type, '[-_/.,;:()\\s]+', ' ', 'g')), ' '), lambda x: x <> '')) AS b FROM part)
SELECT p_partkey, coalesce(len(list_intersect(a, b)) / nullif(greatest(len(a), len(b)), 0)::DOUBLE, 0) AS overlap FROM w""")
def s25_token_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Common words of names and types."""
    return table(spark, d, "part").select("p_partkey", resolve.token_overlap(F.col("p_name"), F.col("p_type")).alias("overlap"))


_UUID = (
    "WITH h AS (SELECT pub_row_id, sha1(from_hex('" + ids.NAMESPACE.hex + "') || encode('publication:' || trim(publicationTitle))) AS h FROM publications WHERE publicationTitle IS NOT NULL) "
    "SELECT pub_row_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || CASE WHEN strpos('0123456789abcdef', h[17]) - 1 & 3 = 0 THEN '8' WHEN strpos('0123456789abcdef', h[17]) - 1 & 3 = 1 THEN '9' WHEN strpos('0123456789abcdef', h[17]) - 1 & 3 = 2 THEN 'a' ELSE 'b' END || h[18:20] || '-' || h[21:32] AS uuid FROM h"
)


@query(_UUID)
def s26_uuid5(spark: SparkSession, d: str) -> DataFrame:
    """Name-based ids of publications."""
    return table(spark, d, "publications").where("publicationTitle IS NOT NULL").select("pub_row_id", ids.prefixed_uuid5("publication", F.col("publicationTitle")).alias("uuid"))


@query("SELECT patientDerivedModelId, _modified, 'DON' || sha1(modelName)[1:8] AS donor_id FROM patient_models")
def s27_sha1_ids(spark: SparkSession, d: str) -> DataFrame:
    """Digest-prefix ids."""
    return table(spark, d, "patient_models").select("patientDerivedModelId", "_modified", ids.sha1_id("DON", F.col("modelName")).alias("donor_id"))


@query()
def s28_fuzzy_best(spark: SparkSession, d: str) -> DataFrame:
    """Typed journals with their most similar reference name (Ratcliff-Obershelp, at least 0.88)."""
    typed = table(spark, d, "publications").select(F.col("journal").alias("typed"))
    pairs = resolve.fuzzy_pairs(typed, table(spark, d, "journal_reference"), "typed", "journal_name", 0.88)
    return resolve.best_match(pairs, "typed", "journal_name").withColumn("score", F.round("score", 6))


@query(r"""
WITH p AS (SELECT DISTINCT trim(patientDiagnosis) AS pattern FROM patient_models WHERE trim(patientDiagnosis) <> ''),
pw AS (SELECT *, ' ' || array_to_string(list_filter(regexp_split_to_array(lower(pattern), '[^\p{L}\p{N}]+'), lambda x: x <> ''), ' ') || ' ' AS phrase FROM p),
t AS (SELECT pub_row_id, ' ' || array_to_string(list_filter(regexp_split_to_array(lower(abstract), '[^\p{L}\p{N}]+'), lambda x: x <> ''), ' ') || ' ' AS txt FROM publications WHERE abstract IS NOT NULL)
SELECT DISTINCT pub_row_id, pattern FROM t JOIN pw ON contains(txt, phrase) WHERE trim(phrase) <> ''""")
def s29_dictionary_scan(spark: SparkSession, d: str) -> DataFrame:
    """Diagnoses in abstracts, as whole words."""
    patterns = mining.dictionary(table(spark, d, "patient_models"), "patientDiagnosis", "patientDiagnosis", F.lit("diagnosis"))
    return mining.scan(table(spark, d, "publications"), "pub_row_id", "abstract", patterns).select("pub_row_id", "pattern").distinct()


@query("SELECT sign, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{label}' AS sign FROM publications WHERE regexp_matches(abstract, '{p}')" for p, label in mining.SIGNS) + ") GROUP BY 1")
def s30_signs(spark: SparkSession, d: str) -> DataFrame:
    """Signs of tool types in abstracts."""
    return table(spark, d, "publications").select(F.explode(mining.signs(F.col("abstract"))).alias("sign")).groupBy("sign").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH p AS (SELECT pub_row_id, abstract, list_filter(range(1, greatest(length(abstract) - length('tumor') + 2, 1)), lambda i: lower(abstract)[i : i + 4] = 'tumor') AS spots FROM publications WHERE contains(lower(abstract), 'tumor'))
SELECT pub_row_id, len(spots)::INT AS n_mentions, abstract[greatest(spots[1] - 30, 1) : spots[1] + 5 + 30 - 1] AS first_context FROM p""")
def s31_contexts(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of a word, overlapping ones too, with the text around the first."""
    p = table(spark, d, "publications").where(F.contains(F.lower("abstract"), F.lit("tumor")))
    return p.select("pub_row_id", F.size(text.positions(F.col("abstract"), F.lit("tumor"))).alias("n_mentions"), F.get(text.contexts(F.col("abstract"), F.lit("tumor"), 30), F.lit(0)).alias("first_context"))


def _words_sql(column: str, words: list[str]) -> str:
    return " + ".join(f"contains(lower(coalesce({column}, '')), '{w}')::INT" for w in words)


@query(f"SELECT _usageType, sum({_words_sql('_context', mining.MADE)})::BIGINT AS made, sum({_words_sql('_context', mining.GOT)})::BIGINT AS got FROM submission_mentions GROUP BY 1")
def s32_making_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of making and of getting in contexts, by usage type."""
    m = table(spark, d, "submission_mentions")
    return m.groupBy("_usageType").agg(F.sum(text.count_words(F.col("_context"), mining.MADE)).alias("made"), F.sum(text.count_words(F.col("_context"), mining.GOT)).alias("got"))


@query("""
SELECT CASE WHEN _toolName IS NULL OR trim(_toolName) = '' THEN 'blank_name' WHEN _context IS NULL OR length(trim(_context)) < 20 THEN 'short_context'
  WHEN regexp_matches(lower(_context), 'used as control') THEN 'control' WHEN _toolType = 'antibody' AND NOT contains(lower(_context), 'stain') AND NOT contains(lower(_context), 'blot') THEN 'antibody_context' END AS reason, count(*) AS n
FROM submission_mentions GROUP BY 1""")
def s33_filter_reason(spark: SparkSession, d: str) -> DataFrame:
    """First failing rule of a quality gate; null is kept."""
    m, c = table(spark, d, "submission_mentions"), F.lower("_context")
    rules = [
        ("blank_name", F.col("_toolName").isNull() | (F.trim("_toolName") == "")),
        ("short_context", F.col("_context").isNull() | (F.length(F.trim("_context")) < 20)),
        ("control", c.rlike("used as control")),
        ("antibody_context", (F.col("_toolType") == "antibody") & ~F.contains(c, F.lit("stain")) & ~F.contains(c, F.lit("blot"))),
    ]
    return m.groupBy(predicates.first_reason(rules).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT pub_row_id FROM publications WHERE publicationTitle IS NULL OR trim(publicationTitle) = '' OR contains(lower(publicationTitle), 'case') OR contains(lower(publicationTitle), 'imaging of') OR contains(lower(coalesce(journal, '')), 'case') OR contains(lower(coalesce(journal, '')), 'imaging of')")
def s34_title_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """Publications that keywords in title or journal exclude."""
    return table(spark, d, "publications").where(predicates.excluded_title(F.col("publicationTitle"), F.col("journal"), ["case", "imaging of"])).select("pub_row_id")


@query("SELECT CASE WHEN c > 0.9 THEN 'auto' WHEN c >= 0.7 THEN 'manual' ELSE 'drop' END AS bucket, count(*) AS n, count(*) FILTER (c >= 0.7) AS n_confident FROM (SELECT try_cast(_confidence AS DOUBLE) AS c FROM submission_mentions) GROUP BY 1")
def s35_confidence_split(spark: SparkSession, d: str) -> DataFrame:
    """Mentions by confidence; what isn't a number is dropped."""
    m = table(spark, d, "submission_mentions")
    return m.groupBy(predicates.bucket(F.col("_confidence")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(predicates.confident(F.col("_confidence")), 1)).alias("n_confident"))


@query("SELECT user_id, event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY ALL")
def s38_json_fields(spark: SparkSession, d: str) -> DataFrame:
    """Values out of JSON properties."""
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("props", "$.k").try_cast("bigint")).alias("total"))


_GENES = ["NF1", "NF2", "SUZ12", "EED", "TP53", "LZTR1", "SMARCB1"]


@query(
    "WITH s AS (SELECT pub_row_id, 'methods' AS section, 1 AS r, methods AS t FROM publications UNION ALL SELECT pub_row_id, 'abstract', 2, abstract FROM publications UNION ALL SELECT pub_row_id, 'title', 3, publicationTitle FROM publications), "
    "h AS (" + " UNION ALL ".join(f"SELECT DISTINCT pub_row_id, section, r, '{g}' AS pattern FROM s WHERE length(t) >= 20 AND regexp_matches(lower(t), '(^|[^\\p{{L}}\\p{{N}}]){g.lower()}($|[^\\p{{L}}\\p{{N}}])')" for g in _GENES) + ") "
    "SELECT pub_row_id, pattern, string_agg(section, ',' ORDER BY r) AS sections, arg_min(section, r) AS main_section FROM h GROUP BY ALL"
)
def s39_section_merge(spark: SparkSession, d: str) -> DataFrame:
    """Genes by the sections that name them, methods before abstract before title."""
    own = mining.sections(table(spark, d, "publications"), "pub_row_id", {"methods": "methods", "abstract": "abstract", "title": "publicationTitle"}, 20)
    genes = spark.createDataFrame([(g, "gene", g) for g in _GENES], "id string, kind string, pattern string")
    keyed = own.withColumn("k", F.concat_ws("|", F.col("pub_row_id").cast("string"), "section"))
    hits = mining.scan(keyed, "k", "text", genes).select(F.split("k", r"\|")[0].cast("bigint").alias("pub_row_id"), F.split("k", r"\|")[1].alias("section"), "pattern")
    return mining.merge_sections(hits, ["pub_row_id", "pattern"], "section", ["methods", "abstract", "title"])


@query(
    "WITH o AS (SELECT _pmid, _toolType, _toolName FROM submission_mentions WHERE _pmid IS NOT NULL AND _toolName IS NOT NULL GROUP BY ALL) SELECT _pmid, "
    + ", ".join(f"coalesce(string_agg(_toolName, '; ' ORDER BY _toolName) FILTER (_toolType = '{k}'), '') AS {k}" for k in TOOL_TYPES)
    + ", count(*) AS n_names FROM o GROUP BY 1"
)
def s40_pub_pivot(spark: SparkSession, d: str) -> DataFrame:
    """One row per publication with its tools by type."""
    return pivot.by_publication(table(spark, d, "submission_mentions"), "_pmid", "_toolType", "_toolName", TOOL_TYPES)


@query("""
SELECT 'usage' AS link, count(*) AS n FROM (SELECT DISTINCT resourceId, _pmid FROM submission_mentions WHERE _pmid IS NOT NULL AND resourceId IS NOT NULL)
UNION ALL SELECT 'development', count(*) FROM (SELECT DISTINCT resourceId, _pmid FROM submission_mentions WHERE _pmid IS NOT NULL AND resourceId IS NOT NULL AND _usageType = 'Development')""")
def s41_link_tables(spark: SparkSession, d: str) -> DataFrame:
    """Usage and development links out of mentions."""
    out = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("link"), "n") for n, t in pivot.links(table(spark, d, "submission_mentions"), "resourceId", "_pmid", "_usageType").items()]
    return out[0].unionByName(out[1])


@query("""
WITH o AS (SELECT DISTINCT _pmid, _toolType, _toolName FROM submission_mentions WHERE _pmid IS NOT NULL AND _toolType IS NOT NULL AND _toolName IS NOT NULL),
g AS (SELECT _pmid, _toolType || ': ' || string_agg(_toolName, ', ' ORDER BY _toolName) AS s FROM o GROUP BY _pmid, _toolType)
SELECT _pmid, string_agg(s, '; ' ORDER BY s) AS xref FROM g GROUP BY 1""")
def s42_xref(spark: SparkSession, d: str) -> DataFrame:
    """Nested cross-reference strings."""
    return pivot.cross_reference(table(spark, d, "submission_mentions"), "_pmid", "_toolType", "_toolName")


@query("""
SELECT 'both' AS part, count(*) AS n FROM (SELECT publicationId FROM usage_links INTERSECT SELECT publicationId FROM development_links)
UNION ALL SELECT 'usage_only', count(*) FROM (SELECT publicationId FROM usage_links EXCEPT SELECT publicationId FROM development_links)""")
def s43_set_ops(spark: SparkSession, d: str) -> DataFrame:
    """Publications in both link tables, and in one only."""
    a, b = (table(spark, d, n).select("publicationId") for n in ("usage_links", "development_links"))
    n = lambda df, part: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "n")
    return n(a.intersect(b), "both").unionByName(n(a.subtract(b), "usage_only"))


@query("SELECT name, nation, seg FROM (SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS seg FROM customer UNION ALL SELECT s_name, s_nationkey, '' FROM supplier)")
def s44_align_union(spark: SparkSession, d: str) -> DataFrame:
    """UNION ALL with lacking columns filled."""
    c = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("seg"))
    return pivot.aligned(c, table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")))


_PATIENT = ["modelSystemType", "patientDiagnosis", "hostStrain", "tumorType"]
_REVIEW = "({0} IS NOT NULL AND trim({0}) NOT IN ('', 'None', 'Unknown'))"


@query(
    f"WITH c AS (SELECT ({' + '.join(_REVIEW.format(c) + '::INT' for c in _PATIENT)}) / 4.0::DOUBLE AS complete, regexp_matches(lower(coalesce(patientDiagnosis, '')), 'neurofibroma|schwannoma|mpnst') AS spec, coalesce(try_cast(establishmentRate AS DOUBLE), 0.85) AS conf FROM patient_models) "
    "SELECT complete, CASE WHEN spec AND complete >= 0.67 AND conf >= 0.85 THEN 'High' WHEN (spec OR complete >= 0.67) AND conf >= 0.8 THEN 'Medium' ELSE 'Low' END AS priority, count(*) AS n FROM c GROUP BY ALL"
)
def s45_priority(spark: SparkSession, d: str) -> DataFrame:
    """Priorities from completeness, specificity and confidence."""
    p = table(spark, d, "patient_models")
    p = p.select(scoring.completeness([F.col(c) for c in _PATIENT]).alias("complete"), text.contains_any(F.col("patientDiagnosis"), ["neurofibroma", "schwannoma", "mpnst"]).alias("spec"), F.coalesce(F.col("establishmentRate").try_cast("double"), F.lit(0.85)).alias("conf"))
    return p.groupBy("complete", scoring.priority(F.col("spec"), F.col("complete"), F.col("conf")).alias("priority")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH m AS (SELECT *, trim(coalesce(developerName, '')) AS dev, trim(coalesce(developerAffiliation, '')) AS aff FROM patient_models)
SELECT patientDerivedModelId, _modified, CASE WHEN dev <> '' THEN 'Contact developer: ' || dev || CASE WHEN aff <> '' THEN ' (' || aff || ')' ELSE '' END WHEN aff <> '' THEN 'Contact: ' || aff ELSE '' END AS acquire FROM m""")
def s46_acquire(spark: SparkSession, d: str) -> DataFrame:
    """How to acquire models whose submitters say: contact the developer."""
    rules = {"model": [(("developerName", "developerAffiliation"), (), "Contact developer: {developerName} ({developerAffiliation})"), (("developerName",), (), "Contact developer: {developerName}"), (("developerAffiliation",), (), "Contact: {developerAffiliation}")]}
    p = table(spark, d, "patient_models")
    return p.select("patientDerivedModelId", "_modified", comp.by_rules(F.lit("model"), rules, F.col).alias("acquire"))


_SPECIES = [(r"(?i)\b(?:zebrafish|danio)\b", "Danio rerio"), (r"(?i)\b(?:mouse|mice|murine)\b", "Mus musculus"), (r"(?i)\brats?\b", "Rattus norvegicus"), (r"(?i)\b(?:human|patients?|donors?|adults|children)\b", "Homo sapiens"), (r"\b(?:C57BL|BALB|FVB|NOD|NRG|NSG|SCID|129S1)", "Mus musculus")]


@query("SELECT resourceType, species, count(*) AS n FROM (SELECT resourceType, CASE " + " ".join(f"WHEN regexp_matches(resourceName || ' ' || coalesce(description, ''), '{p}') THEN '{s}'" for p, s in _SPECIES) + " ELSE '' END AS species FROM tool_resources) GROUP BY ALL")
def s47_species(spark: SparkSession, d: str) -> DataFrame:
    """Species inferred from names and descriptions by ordered rules."""
    t = table(spark, d, "tool_resources")
    return t.groupBy("resourceType", text.first_match(F.concat("resourceName", F.lit(" "), F.coalesce("description", F.lit(""))), _SPECIES).alias("species")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events f WHERE f.user_id = e.user_id AND f.event_type = e.event_type AND f.event_id < e.event_id AND f.event_id % 2 = 0) ")
def s48_pending(spark: SparkSession, d: str) -> DataFrame:
    """Events before any processed (even) one of their user and type: what a first run leaves pending."""
    e = table(spark, d, "events")
    done = e.where("event_id % 2 = 0").groupBy("user_id", "event_type").agg(F.min("event_id").alias("_done"))
    late = e.join(done, ["user_id", "event_type"]).where(F.col("event_id") > F.col("_done")).select("event_id")
    return incremental.pending(e, late, ["event_id"]).select("event_id")


@query("SELECT usageId, max(_ingestedAt) AS _ingestedAt FROM usage_links GROUP BY 1")
def s49_keep_last(spark: SparkSession, d: str) -> DataFrame:
    """The last delivery of each link."""
    return reconcile.keep_one(table(spark, d, "usage_links").select("usageId", "_ingestedAt"), ["usageId"], ["_ingestedAt"], last=True)


@query("""
WITH m AS (SELECT patientDerivedModelId AS id, list_filter(list_transform(string_split(developerName, ';'), lambda x: trim(x)), lambda x: x <> '') AS n, list_transform(string_split(coalesce(developerAffiliation, ''), ';'), lambda x: trim(x)) AS a FROM patient_models WHERE developerName IS NOT NULL),
e AS (SELECT id, unnest(n) AS name, unnest(range(1, len(n) + 1)) AS p, a FROM m),
f AS (SELECT id, name, nullif(coalesce(a[p], a[len(a)]), '') AS affiliation FROM e)
SELECT name, (arg_min(affiliation, (affiliation IS NULL)::INT || id) FILTER (affiliation IS NOT NULL)) AS affiliation, coalesce(min(id) FILTER (affiliation IS NOT NULL), min(id)) AS id FROM f GROUP BY name""")
def s50_people(spark: SparkSession, d: str) -> DataFrame:
    """People of the models, one row per name."""
    p = table(spark, d, "patient_models").groupBy(F.col("patientDerivedModelId").alias("id"), "developerName", "developerAffiliation").agg(F.count(F.lit(1)).alias("n"))
    return reconcile.people(p, "developerName", "developerAffiliation", "id")


@query(f"SELECT CASE lower(replace(replace(_toolType, '-', '_'), ' ', '_')) {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in text.TYPE_LABELS.items())} ELSE _toolType END AS label, count(*) AS n FROM submission_mentions GROUP BY 1")
def s51_type_labels(spark: SparkSession, d: str) -> DataFrame:
    """Mentions by type label."""
    return table(spark, d, "submission_mentions").groupBy(text.type_label(F.col("_toolType")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT pub_row_id, CASE WHEN trim(coalesce(doi, '')) = '' THEN '' WHEN starts_with(trim(doi), 'http') THEN trim(doi) ELSE 'https://doi.org/' || regexp_replace(trim(doi), '^doi:\\s*', '') END AS url, CASE WHEN {_PMID.format('pmid')} = '' THEN '' ELSE 'PMID:' || {_PMID.format('pmid')} END AS pmid, regexp_replace(coalesce(publicationTitle, ''), '[^\\p{{L}}\\p{{M}}\\p{{N}}_.-]+', '_', 'g') AS file FROM publications")
def s52_id_spellings(spark: SparkSession, d: str) -> DataFrame:
    """Addresses, prefixed ids and file names of publications."""
    return table(spark, d, "publications").select("pub_row_id", ids.doi_url(F.col("doi")).alias("url"), ids.pmid_prefixed(F.col("pmid")).alias("pmid"), ids.file_safe(F.col("publicationTitle")).alias("file"))


@query("SELECT funder_id, count(*) AS n FROM (SELECT unnest(string_split(_fundingAgency, '; ')) AS a FROM submission_mentions) m JOIN funder_reference f ON lower(trim(a)) = lower(funder_name) GROUP BY 1")
def s53_funder_exact(spark: SparkSession, d: str) -> DataFrame:
    """Agencies that are a funder's name but for case and white space."""
    items = table(spark, d, "submission_mentions").select(F.explode(F.split("_fundingAgency", "; ")).alias("a"), F.lit("f").alias("kind"))
    have = table(spark, d, "funder_reference").select(F.lower("funder_name").alias("key"), F.lit("f").alias("kind"), F.col("funder_id").alias("id"))
    return resolve.exact_match(items, "a", "kind", have).where("resource_id IS NOT NULL").groupBy(F.col("resource_id").alias("funder_id")).agg(F.count(F.lit(1)).alias("n"))


_FACETS = ["modelSystemType", "hostStrain", "tumorType", "engraftmentSite", "humanizationMethod", "patientDiagnosis"]


@query("SELECT field, count(DISTINCT v) AS n_values, count(*) AS n_rows FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, trim(unnest(regexp_split_to_array({c}, '\\s*,\\s*'))) AS v FROM patient_models WHERE {_FILLED.format(c)}" for c in _FACETS) + ") WHERE v <> '' GROUP BY 1 HAVING count(DISTINCT v) BETWEEN 5 AND 100")
def s54_facets(spark: SparkSession, d: str) -> DataFrame:
    """Columns that would serve as facets."""
    return stats.facets(table(spark, d, "patient_models"), _FACETS)


@query("""
WITH a AS (SELECT lower(resourceName) AS k, resourceType, min(resourceId) AS id FROM tool_resources WHERE dateRemoved IS NULL GROUP BY ALL), b AS (SELECT lower(resourceName) AS k, resourceType, min(resourceId) AS id FROM tool_resources GROUP BY ALL)
SELECT k, resourceType, coalesce(a.id, b.id) AS "resourceId" FROM b LEFT JOIN a USING (k, resourceType)""")
def s55_key_map(spark: SparkSession, d: str) -> DataFrame:
    """(name, type) to id; resources that still hold come first, removed ones supplement."""
    t = table(spark, d, "tool_resources").withColumn("k", F.lower("resourceName")).withColumn("o", F.col("resourceId"))
    return reconcile.key_map([t.where("dateRemoved IS NULL"), t], ["k", "resourceType"], "resourceId", ["o"])


_BY_PMID = f"WITH a AS (SELECT {_PMID.format('pmid')} AS k, min(publicationId) AS v FROM publications WHERE {_PMID.format('pmid')} <> '' GROUP BY 1), b AS (SELECT doi AS k, min(publicationId) AS v FROM publications WHERE doi <> '' GROUP BY 1), r AS (SELECT coalesce(a.v, b.v) AS v FROM submission_mentions m LEFT JOIN a ON a.k = {_PMID.format('m._pmid')} LEFT JOIN b ON b.k = m._doi) "


@query(_BY_PMID + "SELECT CASE WHEN v IS NULL THEN 'no publication' END AS _reject, count(*) AS n, count(DISTINCT v) AS n_pubs FROM r GROUP BY 1")
def s56_resolve_links(spark: SparkSession, d: str) -> DataFrame:
    """Publications of mentions by number, else by DOI, with a reason where neither is known."""
    p = table(spark, d, "publications")
    by_pmid = p.select(ids.pmid_bare(F.col("pmid")).alias("k"), "publicationId").where("k <> ''").groupBy("k").agg(F.min("publicationId").alias("v"))
    by_doi = p.where("doi <> ''").groupBy(F.col("doi").alias("k")).agg(F.min("publicationId").alias("v"))
    m = table(spark, d, "submission_mentions").select("_pmid", "_doi")
    out = reconcile.resolve(m, [(ids.pmid_bare(F.col("_pmid")), by_pmid, "k", "v"), (F.col("_doi"), by_doi, "k", "v")], "pub", "no publication")
    return out.groupBy("_reject").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("pub").alias("n_pubs"))


@query("""
WITH a AS (SELECT pmid, max(abstract) AS abstract FROM publications WHERE cache_level = 'minimal' AND pmid IS NOT NULL GROUP BY 1), b AS (SELECT pmid, max(methods) AS abstract FROM publications WHERE pmid IS NOT NULL GROUP BY 1)
SELECT CASE WHEN p.abstract <> '' THEN 0 WHEN a.abstract <> '' THEN 1 WHEN b.abstract <> '' THEN 2 END AS _filled_from, count(*) AS n, sum(length(coalesce(nullif(p.abstract, ''), nullif(a.abstract, ''), nullif(b.abstract, ''))))::BIGINT AS chars
FROM publications p LEFT JOIN a ON a.pmid = p.pmid LEFT JOIN b ON b.pmid = p.pmid GROUP BY 1""")
def s57_fill_from(spark: SparkSession, d: str) -> DataFrame:
    """Blank abstracts filled from one cache, then another."""
    p = table(spark, d, "publications").where(F.lit(True))
    keyed = p.where("pmid IS NOT NULL")
    a = keyed.where("cache_level = 'minimal'").groupBy("pmid").agg(F.max("abstract").alias("abstract"))
    b = keyed.groupBy("pmid").agg(F.max("methods").alias("abstract"))
    out = reconcile.fill_from(p.select("pmid", "abstract"), "abstract", "pmid", [a, b])
    return out.groupBy("_filled_from").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("abstract")).alias("chars"))


_RICH = ["modelSystemType", "patientDiagnosis", "hostStrain", "tumorType", "engraftmentSite"]


@query(f"WITH r AS (SELECT *, row_number() OVER (PARTITION BY patientDerivedModelId ORDER BY {' + '.join(f'(coalesce({c}, {chr(39)}{chr(39)}) <> {chr(39)}{chr(39)})::INT' for c in _RICH)} DESC, _modified) AS rn FROM patient_models) SELECT patientDerivedModelId, _modified FROM r WHERE rn = 1")
def s58_richest(spark: SparkSession, d: str) -> DataFrame:
    """The richest delivery of each model."""
    return comp.richest(table(spark, d, "patient_models"), ["patientDerivedModelId"], _RICH, ["_modified"]).select("patientDerivedModelId", "_modified")


@query("""
WITH d AS (SELECT resourceId, _source, min(linkDate) AS f FROM usage_links WHERE _source IS NOT NULL GROUP BY ALL)
SELECT resourceId, string_agg(_source, ' | ' ORDER BY f, _source) AS sources FROM d GROUP BY 1""")
def s59_ordered_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Sources of each tool's links in order of first appearance."""
    once = table(spark, d, "usage_links").groupBy("resourceId", "_source").agg(F.min("linkDate").alias("f"))
    return once.where("_source IS NOT NULL").groupBy("resourceId").agg(stats.ordered_distinct("_source", ["f"]).alias("sources"))


@query("""
WITH d AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders), g AS (SELECT o_custkey, list(o_orderkey::VARCHAR ORDER BY o_orderkey) AS l FROM d GROUP BY 1)
SELECT o_custkey, array_to_string(l[1:5], ', ') || CASE WHEN len(l) > 5 THEN ' ... (' || (len(l) - 5) || ' more)' ELSE '' END AS listed FROM g""")
def s60_listed(spark: SparkSession, d: str) -> DataFrame:
    """The first five orders of each customer and how many more there are."""
    o = table(spark, d, "orders").withColumn("s", F.col("o_orderkey").cast("string"))
    return stats.listed(o, ["o_custkey"], "s", ["o_orderkey"])


@query("SELECT ct_id, coalesce(list_contains(validatedLanguages, 'English'), false) AS has_english, coalesce(list_contains(validatedLanguages, 'German'), false) AS has_german, coalesce(list_contains(validatedLanguages, 'Spanish'), false) AS has_spanish FROM clinical_tools")
def s61_indicators(spark: SparkSession, d: str) -> DataFrame:
    """A column per language."""
    return pivot.indicators(table(spark, d, "clinical_tools"), "ct_id", "validatedLanguages", ["English", "German", "Spanish"])


@query("""
SELECT 'head' AS part, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 100)
UNION ALL SELECT 'rest', count(*), min(o_orderkey), max(o_orderkey) FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey OFFSET 100)""")
def s62_work_cap(spark: SparkSession, d: str) -> DataFrame:
    """What a capped run takes, and what it defers."""
    head, rest = stats.cut_at(table(spark, d, "orders").select("o_orderkey"), 100, ["o_orderkey"])
    part = lambda df, n: df.agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).withColumn("part", F.lit(n))
    return part(head, "head").unionByName(part(rest, "rest"))


@query("""
WITH o AS (SELECT DISTINCT _toolType, _usageType FROM submission_mentions WHERE year(_modified) < 2020), n AS (SELECT DISTINCT _toolType, _usageType FROM submission_mentions WHERE year(_modified) >= 2020)
SELECT *, 'added' AS change FROM (SELECT * FROM n EXCEPT SELECT * FROM o) UNION ALL SELECT *, 'removed' FROM (SELECT * FROM o EXCEPT SELECT * FROM n)""")
def s63_enum_changes(spark: SparkSession, d: str) -> DataFrame:
    """Usage types that came or went per tool type (nulls don't match, so they are dropped first)."""
    m = table(spark, d, "submission_mentions").select("_toolType", F.coalesce("_usageType", F.lit("\0")).alias("_usageType"), "_modified")
    out = quality.enum_changes(m.where(F.year("_modified") < 2020), m.where(F.year("_modified") >= 2020), "_toolType", "_usageType")
    return out.withColumn("_usageType", F.nullif(F.col("_usageType"), F.lit("\0")))


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT 'size' AS check, 'tool_resources' AS table, '{c}' AS \"column\", max(length({c}))::VARCHAR AS value, count(*) FILTER (length({c}) > {n}) AS n FROM tool_resources" for c, n in (("description", 60), ("synonyms", 20), ("resourceName", 200))) + ") WHERE n > 0")
def s64_oversize(spark: SparkSession, d: str) -> DataFrame:
    """Columns with values over their size caps."""
    return quality.oversize(table(spark, d, "tool_resources"), "tool_resources", {"description": 60, "synonyms": 20, "resourceName": 200})


_ALL_SQL = f"""
WITH p AS (SELECT resourceId, min(publicationId) FILTER {'(' + _FILLED.format('publicationId') + ')'} AS pub FROM usage_links GROUP BY 1),
o AS (SELECT resourceId, count(*) FILTER {'(' + _FILLED.format('_doi') + ')'} AS d, count(*) FILTER (NOT {_FILLED.format('_doi')}) AS w FROM submission_mentions GROUP BY 1),
s AS (SELECT t.resourceType, (CASE WHEN t.resourceType = 'Biobank' THEN 0 ELSE CASE WHEN {_FILLED.format('howToAcquire')} THEN 15 ELSE 0 END + CASE WHEN {_FILLED.format('rrid')} THEN 7.5 ELSE 0 END + CASE WHEN pub IS NOT NULL THEN 7.5 ELSE 0 END END)::DOUBLE AS availability,
  (CASE t.resourceType WHEN 'Animal Model' THEN {_FILLED.format('description')}::INT * 7.5 WHEN 'Cell Line' THEN {_FILLED.format('synonyms')}::INT * 7.5 ELSE 0 END)::DOUBLE AS critical,
  (CASE t.resourceType WHEN 'Animal Model' THEN {_FILLED.format('synonyms')}::INT * 5.0 WHEN 'Genetic Reagent' THEN {_FILLED.format('synonyms')}::INT * 7.5 ELSE 0 END)::DOUBLE AS other, least(25, coalesce(d, 0) * 7.5 + coalesce(w, 0) * 2.5)::DOUBLE AS observations
  FROM tool_resources t LEFT JOIN p ON p.resourceId = t.resourceId LEFT JOIN o ON o.resourceId = t.resourceId)
SELECT resourceType, count(*) AS n, round(avg(availability), 6) AS availability, round(avg(critical), 6) AS critical, round(avg(other), 6) AS other, round(avg(observations), 6) AS observations, median(availability + critical + other + observations) AS median,
  count(*) FILTER (availability >= 30) AS n_all, count(*) FILTER (availability <= 0) AS n_no FROM s GROUP BY 1"""


@query(_ALL_SQL)
def s65_score_all(spark: SparkSession, d: str) -> DataFrame:
    """Scores of all resources by component: children are aggregated first, then joined once."""
    t = table(spark, d, "tool_resources")
    pubs = table(spark, d, "usage_links").groupBy("resourceId").agg(F.min(F.when(blank.is_filled(F.col("publicationId")), F.col("publicationId"))).alias("pub"))
    doi = blank.is_filled(F.col("_doi"))
    obs = table(spark, d, "submission_mentions").groupBy("resourceId").agg(F.count(F.when(doi, 1)).alias("_d"), F.count(F.when(~doi, 1)).alias("_w"))
    kind, none = F.col("resourceType"), F.lit(None).cast("string")
    s = t.join(pubs, "resourceId", "left").join(obs, "resourceId", "left").select(
        "resourceType",
        scoring.availability(kind, none, F.col("howToAcquire"), F.col("rrid"), F.col("pub")).alias("a"),
        scoring.field_points(kind, scoring.CRITICAL, t.columns, 30).alias("c"),
        scoring.field_points(kind, scoring.OTHER, t.columns, 15).alias("o"),
        scoring.observation_points(F.col("_d"), F.col("_w")).alias("b"),
    )
    some = scoring.all_some_none(F.col("a"), 30)
    return s.groupBy("resourceType").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("a"), 6).alias("availability"), F.round(F.avg("c"), 6).alias("critical"), F.round(F.avg("o"), 6).alias("other"), F.round(F.avg("b"), 6).alias("observations"), F.median(F.col("a") + F.col("c") + F.col("o") + F.col("b")).alias("median"), F.count(F.when(some == "All", 1)).alias("n_all"), F.count(F.when(some == "No", 1)).alias("n_no"))


@query("SELECT _toolType AS kind, _toolName AS name, count(*) AS n, min(sp_id) AS first_id FROM submission_mentions WHERE _toolName IS NOT NULL GROUP BY ALL")
def s66_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """Names per type with their counts."""
    return table(spark, d, "submission_mentions").where("_toolName IS NOT NULL").groupBy(F.col("_toolType").alias("kind"), F.col("_toolName").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.min("sp_id").alias("first_id"))


@query("""
WITH n AS (SELECT resourceType, lower(resourceName) AS k, resourceName, min(dateAdded) AS f, count(*) AS c FROM tool_resources WHERE resourceName IS NOT NULL GROUP BY ALL)
SELECT resourceType, k, arg_min(resourceName, (coalesce(f::VARCHAR, ''), resourceName)) AS canonical, sum(c)::BIGINT AS n FROM n GROUP BY resourceType, k""")
def s67_synonym_groups(spark: SparkSession, d: str) -> DataFrame:
    """Canonical names of groups by (type, lower name), first added first."""
    t = table(spark, d, "tool_resources").withColumn("k", F.lower("resourceName"))
    return resolve.synonym_groups(t, ["resourceType", "k"], "resourceName", ["dateAdded"]).select("resourceType", "k", "canonical", "n")


@query("SELECT sp_id, coalesce(regexp_extract(_context, 'RRID:\\s*([A-Z]+_[A-Za-z0-9:_-]+)', 1), '') AS rrid, CASE WHEN length(_context) > 50 THEN _context[1:50] || '...' ELSE _context END AS preview FROM submission_mentions")
def s68_previews(spark: SparkSession, d: str) -> DataFrame:
    """Registry ids and previews of contexts."""
    return table(spark, d, "submission_mentions").select("sp_id", extract.registry_id(F.col("_context")).alias("rrid"), text.shorten(F.col("_context"), 50).alias("preview"))


@query("SELECT patientDerivedModelId, _modified, trim(item) AS item FROM (SELECT patientDerivedModelId, _modified, unnest(CASE WHEN len(l) > 0 THEN l ELSE [''] END) AS item FROM (SELECT *, list_filter(list_transform(string_split(coalesce(molecularCharacterization, ''), ';'), lambda x: trim(x)), lambda x: x <> '') AS l FROM patient_models))")
def s69_per_item(spark: SparkSession, d: str) -> DataFrame:
    """One row per item of a plain list, blank lists once."""
    return comp.per_item(table(spark, d, "patient_models"), "molecularCharacterization").select("patientDerivedModelId", "_modified", "item")


@query("""
WITH x AS (SELECT resourceId AS id, resourceType, lower(resourceName) AS k, 0 AS pass, coalesce(dateAdded::VARCHAR, '') AS o FROM tool_resources WHERE rrid IS NOT NULL UNION ALL SELECT resourceId, resourceType, lower(resourceName), 1, coalesce(dateAdded::VARCHAR, '') FROM tool_resources),
a AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pass, o, resourceType, k) AS r1 FROM x), b AS (SELECT *, row_number() OVER (PARTITION BY resourceType, k ORDER BY pass, o, id) AS r2 FROM a WHERE r1 = 1)
SELECT id, resourceType, k FROM b WHERE r2 = 1""")
def s70_two_pass(spark: SparkSession, d: str) -> DataFrame:
    """Resources generated in two passes, without repeated ids and without repeated (type, name)."""
    t = table(spark, d, "tool_resources").select(F.col("resourceId").alias("id"), "resourceType", F.lower("resourceName").alias("k"), F.coalesce(F.col("dateAdded").cast("string"), F.lit("")).alias("o"), "rrid")
    return comp.two_pass([t.where("rrid IS NOT NULL").drop("rrid"), t.drop("rrid")], "id", ["resourceType", "k"], ["o"]).select("id", "resourceType", "k")
