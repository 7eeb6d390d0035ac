"""The general problems against brute force and small cases, edge cases among them."""

import json
import re
from datetime import datetime

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatella.functions import bloom, skew
from curatella.operators import nested, orphans, packed
from curatella.plans import problems

SF = "/root/testdata/sf0.001"


def at(text):
    return datetime.fromisoformat(text)


LINK = "usageId string, resourceId string, publicationId string, linkDate timestamp_ntz, resource_name string"
TOOL = "resourceId string, dateAdded timestamp_ntz, dateRemoved timestamp_ntz, usageId string"


def run_orphans(spark, links, tools, use_filter=True):
    refs = orphans.references(spark.createDataFrame(links, LINK), "usage_links", "usageId", ["resourceId"], "linkDate")
    parents = {"resourceId": orphans.Parent(spark.createDataFrame(tools, TOOL), "resourceId", "dateAdded", "dateRemoved")}
    return sorted(r["link_id"] for r in orphans.find_orphans(refs, parents, len(links), use_filter).collect())


LINKS = [
    ("before", "A", None, at("2020-01-01"), "x"),
    ("start", "A", None, at("2020-02-01"), "x"),
    ("held", " a\t", None, at("2020-03-01"), "x"),
    ("end", "A", None, at("2020-06-01"), "x"),
    ("gap", "A", None, at("2020-07-01"), "x"),
    ("again", "A", None, at("2021-02-01"), "x"),
    ("unknown_id", "Z", None, at("2020-03-01"), "x"),
    ("blank", "N/A", None, at("2020-03-01"), "x"),
    ("null", None, None, at("2020-03-01"), "x"),
    ("no_date", "A", None, None, "x"),
    ("no_date_no_id", "Z", None, None, "x"),
    ("always", "B", None, at("1999-01-01"), "x"),
    ("null_link", None, None, None, None),
]
TOOLS = [("A", at("2020-02-01"), at("2020-05-01"), "clash"), ("a", at("2020-04-01"), at("2020-06-01"), "clash"), ("A", at("2021-01-01"), None, None), ("B", None, None, None), (None, None, None, None), ("C", at("2020-01-01"), at("2019-01-01"), None)]
WANT = ["before", "end", "gap", "no_date_no_id", "unknown_id"]


@pytest.mark.parametrize("use_filter", [True, False])
def test_orphans_by_period(spark, use_filter):
    assert run_orphans(spark, LINKS, TOOLS, use_filter) == WANT


def test_orphans_repeat_with_repeated_links(spark):
    assert run_orphans(spark, LINKS * 2, TOOLS * 3) == sorted(WANT * 2)


def test_orphans_of_empty_tables(spark):
    assert run_orphans(spark, [], TOOLS) == []
    assert run_orphans(spark, LINKS, []) == sorted(["before", "start", "held", "end", "gap", "again", "unknown_id", "no_date", "no_date_no_id", "always"])


def test_hot_key_is_salted_and_loses_nothing(spark):
    from curatella.functions import skew

    left = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k1", 3), (None, 4)], "k string, v int")
    hot = [r[0] for r in skew.hot_keys(left, ["k"], 50_000, 1000).collect()]
    assert hot == ["hot"]
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = skew.salted_join(left, right, ["k"], how, 50_000)
        want = left.join(right, "k", how)
        assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0


def test_salted_join_of_many_rows_and_odd_names(spark):
    """More rows than one task takes, keys of the names that counting might use."""
    left = spark.range(60_000).select(F.when(F.col("id") < 30_000, 1).otherwise(F.col("id") % 100).cast("int").alias("_n"), F.col("id").alias("m"))
    right = spark.createDataFrame([(1, "a"), (2, "b")], "_n int, v string")
    got = skew.salted_join(left, right, ["_n"], "inner", 60_000)
    assert got.count() == 30_600 and got.columns == ["_n", "m", "v"]


def test_orphan_report_counts_months(spark):
    refs = orphans.references(spark.createDataFrame(LINKS, LINK), "usage_links", "usageId", ["resourceId"], "linkDate")
    parents = {"resourceId": orphans.Parent(spark.createDataFrame(TOOLS, TOOL), "resourceId", "dateAdded", "dateRemoved")}
    got = {r["month"]: (r["n_refs"], r["n_orphans"]) for r in orphans.orphan_report(refs, orphans.find_orphans(refs, parents, 13)).collect()}
    assert got["2020-03"] == (2, 1) and got["2020-01"] == (1, 1) and got["2021-02"] == (1, 0) and got[None] == (2, 1)


CELLS = [
    ("NF1 loss; TP53 p.R1*", ["NF1 loss", "TP53 p.R1*"]),
    ("CDKN2A/B deletion / PI3K/AKT activation", ["CDKN2A/B deletion", "PI3K/AKT activation"]),
    ("IHC (S100, SOX10) positive, ploidy 2.0", ["IHC (S100, SOX10) positive", "ploidy 2.0"]),
    ('a,"so-called ""hot"" site, exon 5",b', ["a", 'so-called "hot" site, exon 5', "b"]),
    ('["x", "so-called \\"hot\\" site"]', ["x", 'so-called "hot" site']),
    ("['5\\' UTR', \"it's\"]", ["5' UTR", "it's"]),
    ("5' UTR deletion of NF1;5' UTR deletion of KIT", ["5' UTR deletion of NF1", "5' UTR deletion of KIT"]),
    ("1. ploidy 2.0 2. TMB 1.5; 3. x", ["ploidy 2.0", "TMB 1.5", "x"]),
    ("(1) a\n(2) b", ["a", "b"]),
    ("- a\n- b", ["a", "b"]),
    ("a|| |b|", ["a", "b"]),
    ("a\tb, c and d", ["a", "b", "c", "d"]),
    ("a, b, and c", ["a", "b", "c"]),
    ("panel [A, B", ["panel A", "B"]),
    ('"open, x', ['"open', "x"]),
    ("one value", ["one value"]),
    ("", []),
    ("   ", []),
    (";;|", []),
]
PEOPLE = [
    ("Jusford, Susannah; Dinkin, Joseph", ["Jusford, Susannah", "Dinkin, Joseph"]),
    ("A B. Cee, Dora Eff, and Gus Haa", ["A B. Cee", "Dora Eff", "Gus Haa"]),
    ("Nicholas Grosfurd, PhD", ["Nicholas Grosfurd, PhD"]),
    ("Ann Bee, MD, Cid Dee", ["Ann Bee, MD", "Cid Dee"]),
    ("Centre for Nerve and Skin Research, Town", ["Centre for Nerve and Skin Research, Town"]),
    ("Ann Bee and Cid Dee & Eve Fox", ["Ann Bee", "Cid Dee", "Eve Fox"]),
    ('"Bee, Ann","Dee, Cid"', ["Bee, Ann", "Dee, Cid"]),
    ("Nuldek, Victoria", ["Nuldek, Victoria"]),
    ("Bee, Ann, Dee, Cid", ["Bee, Ann", "Dee, Cid"]),
]


@pytest.mark.parametrize(("cell", "want"), CELLS)
def test_packed_values(cell, want):
    assert packed.tokenize(cell) == want


@pytest.mark.parametrize(("cell", "want"), PEOPLE)
def test_packed_people(cell, want):
    assert packed.tokenize(cell, people=True) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from('ab "\'\\,;|[]().\n'), min_size=1, max_size=12), min_size=1, max_size=5))
def test_quoted_values_come_back(values):
    """Any values (without quotes or marks around, which are no part of a value), quoted as CSV does, are
    split into themselves."""
    values = [f"a{v}b" for v in values]
    cell = ";".join('"' + v.replace("\\", "\\\\").replace('"', '""') + '"' for v in values)
    assert packed.tokenize(cell) == values


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80), st.booleans())
def test_tokenizer_never_fails_and_leaves_no_blank(text, people):
    assert all(v.strip() for v in packed.tokenize(text, people))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "and", " ", "\xa0", "\x1c", "\x85", "\u2003", "\u3000", ";", ",", "1.", "\u0661.", "2)", "“", '"', "[", "]", "x", "•", "-", "/", "&"]), max_size=9), st.booleans())
def test_cells_of_several_values_pass_the_prefilter(parts, people):
    """What the JVM's pattern leaves out never holds two values; Python's own Unicode classes stand in for it."""
    cell = "".join(parts)
    if len(packed.tokenize(cell, people)) > 1:
        assert re.search(packed.MAYBE.removeprefix("(?U)"), cell)


def test_odd_white_space_around_and(spark):
    cells = [f"TP53 loss{s}and{s}NF1 loss" for s in (" ", "\xa0", "\x85", "\u2003", "\u3000", "\x1c", "\x1f")]
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(cells)], "k string, c string")
    assert packed.split_values(df, "k", {"c": False}).count() == 2 * len(cells)


def test_split_values_edges(spark):
    long = "; ".join(["x" * 1000] * 300)
    rows = [("a", "p;q", "Ann Bee; Cid Dee", 1), ("a", "p;q", "Ann Bee; Cid Dee", 1), ("b", None, "", 2), (None, "r;r", None, 3), ("c", long, "x", 4)]
    df = spark.createDataFrame(rows, "row_key string, field_name string, item string, pos int")
    got = packed.split_values(df, "row_key", {"field_name": False, "item": True})
    assert got.columns == ["field_name", "row_key", "pos", "item"] and dict(got.dtypes)["pos"] == "int"
    assert got.where("row_key = 'a'").count() == 8 and got.where("row_key = 'c'").count() == 300
    assert [tuple(r) for r in got.where("row_key IS NULL").orderBy("pos").collect()] == [("field_name", None, 1, "r"), ("field_name", None, 2, "r")]
    assert packed.split_values(df.limit(0), "row_key", {"item": True}).count() == 0


PAYLOAD = """{"pmid": "1", "acceptedTools": [{"toolName": "t", "extractedFields": {"species": "", "synonyms": "X", "mutations": [null, {"gene": "NF1", "alleles": {"allele": "a", "zygosity": null}}],
 "vendors": {"vendorName": "V", "items": [{"catalogNumber": "c", "price": {"amount": 1.5, "currency": null}}]}, "isCommercial": false}},
 {"toolName": "u", "extractedFields": "{\\"species\\": \\"Human\\"}"}, null, {"toolName": "w", "extractedFields": {}}], "rejectedTools": [{"extractedFields": {"species": "no"}}]}"""


def leaves(spark, rows, schema="rid long, payload string, record_id int"):
    every = nested.routed(nested.nodes(spark.createDataFrame(rows, schema), "rid", "payload"))
    return sorted(((r["record_id"], r["top"], r["top_pos"], r["path"]) for r in nested.leaves(every).collect()), key=repr)


def test_nested_values(spark):
    rows = [(1, PAYLOAD, 9), (2, PAYLOAD[:-1], 9), (3, None, 9), (4, "", 9), (5, "[]", 9), (6, '"x"', 9), (7, '{"acceptedTools": {"extractedFields": {"species": NaN}}}', 9), (8, '{"acceptedTools": {"extractedFields": {"extra": {"deep": [1, [2]]}}}}', 9)]
    one = lambda k, path: (1, "acceptedTools", k, path)
    e = "extractedFields."
    assert leaves(spark, rows) == sorted([
        (1, None, None, "pmid"), one(1, "toolName"), one(2, "toolName"), one(4, "toolName"),
        *(one(1, e + p) for p in ("isCommercial", "mutations[2].alleles[1].allele", "mutations[2].gene", "synonyms[1]", "vendors[1].items[1].catalogNumber", "vendors[1].items[1].price.amount", "vendors[1].vendorName")),
        one(2, e + "species"), (1, "rejectedTools", 1, e + "species"),
        (8, "acceptedTools", 1, e + "extra.deep[1]"), (8, "acceptedTools", 1, e + "extra.deep[2][1]"),
    ], key=repr)


def test_nested_typed_tables(spark):
    rows = [(1, PAYLOAD, 9), (1, PAYLOAD, 9), (2, None, 9)]
    t = nested.tables(spark.createDataFrame(rows, "rid long, payload string, record_id int"), "rid", "payload")
    assert {s: t[s].count() for s in t if s != "nodes"} == {"review": 1, "tool": 4, "fields": 4, "donor": 0, "diagnosis": 0, "mutation": 1, "allele": 1, "vendor": 1, "item": 1, "price": 1, "validation": 0, "other": 0, "values": 3}
    price, item, vendor, fields = (t[s].where("top = 'acceptedTools' AND top_pos = 1").collect()[0] for s in ("price", "item", "vendor", "fields"))
    assert price["amount"] == 1.5 and price["currency"] is None and dict(t["price"].dtypes)["amount"] == "double"
    assert (price["parent_id"], item["parent_id"], vendor["parent_id"]) == (item["node_id"], vendor["node_id"], fields["node_id"])
    assert fields["isCommercial"] is False and [r["toolName"] for r in t["tool"].where("top = 'acceptedTools'").orderBy("top_pos").collect()] == ["t", "u", "w"]
    assert [(r["field"], r["ordinal"], r["value"], r["parent_id"] == fields["node_id"]) for r in t["values"].where("value IS NOT NULL AND top_pos = 1").collect()] == [("synonyms", 1, "X", True)]


def test_states_come_from_the_children():
    run = lambda text: nested.Automaton(nested.REVIEW).run(json.loads(text))[3][0]
    assert run('{"amount": 1}') == {"price"}
    assert run('{"price": {"currency": "EUR"}}') == {"item"}
    assert run('{"pmid": {"gene": "x"}, "sex": "f"}') == {"donor"}  # a child that is no value makes no review
    assert run('{"price": {"gene": "x"}}') == {"item"} and run('{"cost": 1}') == frozenset()
    assert run('{"items": [{"price": {"amount": 1}}]}') == {"vendor"} and run('{"items": {"price": {"amount": 1}}}') == {"vendor"}
    assert run('{"items": [{"gene": "x"}], "gene": "y"}') == {"mutation"} and run('{"items": []}') == {"vendor"}
    assert run('{"alleles": null}') == {"mutation"} and run("{}") == set(nested.REVIEW)
    assert run('{"pmid": "1"}') == {"review", "tool"}  # the run from the root tells which


def test_nested_keeps_what_the_type_cannot_hold(spark):
    rows = [(1, '{"acceptedTools": [{"toolName": "t", "confidence": "high", "extractedFields": {"donor": {"age": "12 y", "sex": "f", "hue": "x"}, "validation": "passed", "methods": {"allele": "a"}}}]}')]
    t = nested.tables(spark.createDataFrame(rows, "rid long, payload string"), "rid", "payload")
    donor, tool = t["donor"].collect()[0], t["tool"].collect()[0]
    assert donor["age"] is None and donor["untyped"] == {"age": "12 y", "hue": "x"} and tool["confidence"] is None and tool["untyped"] == {"confidence": "high"}
    assert t["fields"].collect()[0]["untyped"] == {"validation": "passed"} and t["allele"].collect()[0]["path"] == "extractedFields.methods"
    assert [x[3] for x in leaves(spark, [(1, rows[0][1], 0)])] == ["confidence", "extractedFields.donor.age", "extractedFields.donor.hue", "extractedFields.donor.sex", "extractedFields.methods.allele", "extractedFields.validation", "toolName"]


def test_one_delivery_is_taken_whole(spark):
    rows = [(1, '{"doi": "z", "year": 2001, "title": "B"}', "2020-01-02"), (1, '{"doi": "a", "year": 2009, "title": "A"}', "2020-01-03"), (1, '{"doi": "b", "ye', "2020-01-04"), (1, '{"doi": "y", "title": "Z"}', None)]
    t = nested.tables(spark.createDataFrame(rows, "rid long, payload string, got string"), "rid", "payload", "got")
    assert [(r["doi"], r["year"], r["title"]) for r in t["review"].collect()] == [("a", 2009, "A")]


def test_nested_empty_and_deep(spark):
    deep = '{"acceptedTools": [{"extractedFields": {"donor": ' + '{"x": ' * 200 + "1" + "}" * 200 + "}}]}"
    assert len(leaves(spark, [(1, deep, 0)])) == 1
    df = spark.createDataFrame([(1, deep)], "rid long, payload string")
    assert all(t.count() == 0 for t in nested.tables(df.limit(0), "rid", "payload").values())


def test_sieve_keeps_its_method_beyond_one_filter(spark):
    """20 million parents need more than one filter of 2^26 bits: all references to them stay, and nearly
    all others are proved orphans without the exact join."""
    parents = spark.range(20_000_000).select(F.concat(F.lit("p"), "id").alias("k"))
    refs = spark.range(400_000).select(F.when(F.col("id") % 2 == 0, F.concat(F.lit("p"), F.col("id") * 49)).otherwise(F.concat(F.lit("q"), "id")).alias("v"), (F.col("id") % 2 == 0).alias("there"))
    got = {(r["there"], r["_maybe"]): r["n"] for r in bloom.sift(refs, ["v"], parents, ["k"], 20_000_000).groupBy("there", "_maybe").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got[(True, True)] == 200_000 and (True, False) not in got and got[(False, True)] < 0.06 * 200_000


def test_sieve_in_passes(spark):
    keys = spark.range(4000).select(F.col("id").cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    refs = spark.createDataFrame([(str(i),) for i in range(0, 8000, 7)] + [(None,), ("x",)], "v string")
    got = bloom.sift(refs, ["v"], keys, ["k"], shard_bits=4096, shards_a_pass=2).collect()
    assert len(got) == refs.count() and all(r["_maybe"] for r in got if r["v"] and r["v"].isdigit() and int(r["v"]) < 4000)
    assert not any(r["_maybe"] for r in got if r["v"] is None) and sum(not r["_maybe"] for r in got) > 500


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    import os

    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(problems.ORACLE))
def test_queries_equal_sql(spark, duck, name):
    got = problems.QUERIES[name](spark, SF)
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    want = duck.sql(problems.ORACLE[name])
    order = [want.columns.index(c) for c in got.columns]
    assert rows == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
