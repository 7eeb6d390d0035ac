"""Operators of the curation pipeline: hand-computed fixtures, and every query against SQL."""

import json
import os
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from curatella.functions import blank, ids, scoring, text
from curatella.operators import compile as comp
from curatella.operators import extract, mining, pivot, predicates, quality, reconcile, resolve, stats
from curatella.plans import curation, reference

SF = "/root/testdata/sf0.001"


def one(spark, value, build, kind="string"):
    """build's result for one value of a column v."""
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v")).alias("r")).first()["r"]


BLANKS = [None, "", "NULL", "None", "Unknown", " ", "n/a", "x"]


def test_five_notions_of_blank(spark):
    df = spark.createDataFrame([(v,) for v in BLANKS], "v string")
    got = df.select(blank.is_filled("v" and F.col("v")).alias("f"), blank.review_filled(F.col("v")).alias("r"), blank.str_blank(F.col("v")).alias("s"), blank.trivial_acquisition(F.col("v")).alias("t"), blank.is_blank(F.col("v")).alias("b")).collect()
    assert [r["f"] for r in got] == [False, False, False, True, True, True, True, True]
    assert [r["r"] for r in got] == [False, False, True, False, False, False, True, True]
    assert [r["s"] for r in got] == [True, True, False, False, False, False, False, False]
    assert [r["t"] for r in got] == [True, True, False, False, True, True, True, False]
    assert [r["b"] for r in got] == [True] * 7 + [False]
    assert [one(spark, v, blank.is_filled_list, "array<string>") for v in (None, [], ["", "x"], ["x", ""])] == [False, False, False, True]


def test_score_edges(spark):
    assert [one(spark, s, scoring.category, "double") for s in (20.0, 20.1, 40.0, 60.0, 80.0, 80.1, None)] == ["Minimal", "Poor", "Poor", "Fair", "Good", "Excellent", None]
    assert [one(spark, s, lambda c: scoring.all_some_none(c, 30), "double") for s in (None, 0.0, 7.5, 30.0)] == ["No", "No", "Some", "All"]
    rows = [("Cell Line", "a", "", None), ("Alien", "a", "b", "c"), (None, "a", "b", "c")]
    df = spark.createDataFrame(rows, "kind string, cellLineCategory string, synonyms string, tissue string")
    got = df.select(scoring.field_points(F.col("kind"), scoring.CRITICAL, df.columns, 30).alias("p"), scoring.missing_fields(F.col("kind"), scoring.CRITICAL, df.columns).alias("m")).collect()
    assert [r["p"] for r in got] == [7.5, 0.0, 0.0] and got[0]["m"] == "cellLineGeneticDisorder; cellLineManifestation; synonyms" and got[2]["m"] == ""
    obs = spark.createDataFrame([(1, i, i <= 4) for i in range(1, 6)], "p int, o int, doi boolean")
    counted = obs.withColumn("c", scoring.counted_before_cap(F.col("doi"), ["p"], ["o"]))
    assert [r["c"] for r in counted.orderBy("o").collect()] == [True, True, True, True, False]
    assert one(spark, 3, lambda c: scoring.observation_points(c, F.lit(None)), "int") == 22.5 and one(spark, 9, lambda c: scoring.observation_points(c, c), "int") == 25.0
    assert one(spark, None, lambda c: scoring.completeness([c, F.lit("x")])) == 0.5
    assert one(spark, True, lambda c: scoring.mention_confidence(c, c, c), "boolean") == 0.95
    assert stats.safe_limit(3.6, 1) == 5333


def test_ids_equal_python(spark):
    for name in ("plain", "Ünïcode 名", "", "a" * 5000):
        assert one(spark, name, ids.uuid5) == str(uuid.uuid5(ids.NAMESPACE, name))
    assert one(spark, None, ids.uuid5) is None
    assert [one(spark, v, ids.pmid_prefixed) for v in (None, "1", "PMID:1", " PMID: 1")] == ["", "PMID:1", "PMID:1", "PMID:1"]
    assert [one(spark, v, ids.doi_url) for v in (None, "10.1/x", "https://doi.org/10.1/x", "doi:10.1/x")] == ["", "https://doi.org/10.1/x", "https://doi.org/10.1/x", "https://doi.org/10.1/x"]


def test_names(spark):
    key = lambda n, k: one(spark, n, lambda c: text.name_key(c, F.lit(k)))
    assert key("Nf1 fl/fl mice", "animal_models") == key("Nf1 flox/flox", "animal_models") == "nf1floxflox"
    assert key("JH-2-002 cell line", "cell_lines") == key("JH 2–002 (RRID:CVCL_1)", "cell_lines") == "jh2002"
    assert key("PDX JH-2", "patient_derived_models") == key("JH-2 PDX", "patient_derived_models")
    assert one(spark, "JH-2-002 (pNF) cells", text.name_key_loose) == "jh2002pnf" and one(spark, None, text.name_key_loose) == ""
    assert one(spark, "x2y-tool o'neil", text.title_case) == "X2Y-Tool O'Neil"
    assert one(spark, "https://github.com/a/my_nice-tool.git", text.url_tool_name) == "My Nice Tool" and one(spark, "https://zenodo.org/record/123", text.url_tool_name) is None
    assert [one(spark, v, text.python_list) for v in (None, "", "['a', \"b c\"]", "x")] == [[], [], ["a", "b c"], ["x"]]
    assert one(spark, {"b": True, "a": True, "c": False}, text.boolean_map_keys, "map<string,boolean>") == "a, b"


def test_contexts(spark):
    assert one(spark, "aXaaXa", lambda c: text.positions(c, F.lit("a"))) == [1, 3, 4, 6]
    assert one(spark, "aaaa", lambda c: text.positions(c, F.lit("aa"))) == [1, 2, 3]
    assert one(spark, "nothing", lambda c: text.positions(c, F.lit("zz"))) == [] and one(spark, "", lambda c: text.positions(c, F.lit("z"))) == []
    assert one(spark, "TOOL in the middle and tool", lambda c: text.contexts(c, F.lit("tool"), 3)) == ["TOOL in", "nd tool"]


def test_keep_and_insert(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (None, "c", 1), (None, "d", 0), (2, None, 5)], "k int, v string, o int")
    assert sorted((r["k"] or 0, r["v"]) for r in reconcile.keep_one(df, ["k"], ["o"]).collect() if r["v"]) == [(0, "d"), (1, "b")]
    assert {r["v"] for r in reconcile.keep_one(df, ["k"], ["o"], last=True).collect()} == {"a", "c", None}
    new = spark.createDataFrame([("PMID:1", 1), ("1", 2), ("3", 3), (None, 4), (None, 5)], "pmid string, o int")
    cur = spark.createDataFrame([("PMID: 3", 0), (None, 0)], "pmid string, o int")
    key = F.when(F.col("pmid").isNotNull(), ids.pmid_bare(F.col("pmid")))
    assert sorted(r["o"] for r in reconcile.insert_new(new, cur, {"k": key}, {"k": key}, ["o"]).collect()) == [1, 4, 5]


def test_patch_sync_route(spark):
    cur = spark.createDataFrame([(1, "", "x"), (2, None, "x"), (3, "v", "x"), (None, "", "x")], "k int, a string, b string")
    inc = spark.createDataFrame([(1, "n", "y"), (1, "m", "z"), (2, "", "x"), (3, "w", None), (None, "q", "q")], "k int, a string, b string")
    got = {r["k"]: (r["a"], r["b"], r["_patched"]) for r in reconcile.patch_blank(cur, inc, "k", ["a"], ("b",)).collect()}
    assert got == {1: ("m", "z", "a,b"), 2: (None, "x", ""), 3: ("v", "x", ""), None: ("", "x", "")}
    acts = {r["k"]: r["action"] for r in reconcile.sync(cur.where("k IS NOT NULL"), inc.where("k = 3").union(spark.createDataFrame([(9, "", "")], inc.schema)), "k", ["a"]).collect()}
    assert acts == {1: "missing", 2: "missing", 3: "update", 9: "insert"}
    have = spark.createDataFrame([("d1", "r", "f", None), ("d2", "s", "f", "p")], "id string, r string, f string, p string")
    new = spark.createDataFrame([("d1", "r", "f", "p"), ("n1", "r", "f", "p"), ("n2", "r", "f", "q"), ("n3", "s", "f", "q"), ("n4", "t", "f", None), ("n5", "t", "f", "p")], have.schema)
    routed = {r["id"]: r["action"] for r in reconcile.route_links(new, have, ["r", "f"], "p", "id", ["id"]).collect()}
    assert routed == {"d1": "skip_id", "n1": "patch", "n2": "duplicate", "n3": "skip_pair", "n4": "insert", "n5": "duplicate"}


def test_people_and_repair(spark):
    df = spark.createDataFrame([("A; B", "X", 1), ("B", "Y", 2), ("A", "", 0), (None, "Z", 3), (";", "Z", 4)], "n string, a string, i int")
    assert sorted(tuple(r) for r in reconcile.people(df, "n", "a", "i").collect()) == [("A", "X", 1), ("B", "X", 1)]
    links = spark.createDataFrame([("ok",), ("detail",), ("gone",), (None,)], "fk string")
    valid, alt = spark.createDataFrame([("ok",)], "k string"), spark.createDataFrame([("detail", "ok")], "d string, r string")
    assert sorted((str(r["fk"]), r["action"], str(r["fixed_key"])) for r in reconcile.repair_fk(links, "fk", valid, "k", alt, "d", "r").collect()) == [("None", "keep", "None"), ("detail", "fix", "ok"), ("gone", "delete", "gone"), ("ok", "keep", "ok")]
    dup = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "i int, k string")
    assert sorted(r["i"] for r in reconcile.delete_set(dup, "k", "i").collect()) == [2, 3]
    filled = reconcile.fill_from(spark.createDataFrame([("1", ""), ("2", "own"), ("3", None)], "k string, t string"), "t", "k", [spark.createDataFrame([("1", "first")], "k string, t string"), spark.createDataFrame([("1", "second"), ("3", "")], "k string, t string")])
    assert {r["k"]: (r["t"], r["_filled_from"]) for r in filled.collect()} == {"1": ("first", 1), "2": ("own", 0), "3": (None, None)}


def test_quality(spark):
    child, parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string"), spark.createDataFrame([("a",), (None,)], "k string")
    assert [(r["value"], r["n"]) for r in quality.fk_orphans(child, "c", "k", parent, "k").collect()] == [("b", 2)]
    enum = spark.createDataFrame([("a, b,c",), (None,), ("",)], "e string")
    assert [(r["value"], r["n"]) for r in quality.enum_violations(enum, "t", "e", ["a", "b"]).collect()] == [("c", 1)]
    assert {(r["check"], r["column"], r["n"]) for r in quality.required(child, "c", ["k", "missing"]).collect()} == {("required", "k", 1), ("missing_column", "missing", 1)}
    assert quality.empty_rows(child, "c").first()["n"] == 1 and quality.oversize(enum, "t", {"e": 3}).first()["value"] == "6"
    assert quality.frame_problems(child, "datasets", ("pmid",)) == ["no column datasets", "none of the columns pmid"]
    schema = {"properties": {"a": {"$ref": "#/$defs/A"}, "b": {"anyOf": [{"type": "string"}, {"type": "null"}]}}, "type": "object"}
    flat = quality.inline_schema(schema, {"A": {"type": ["integer", "null"]}})
    assert flat["properties"] == {"a": {"type": "integer"}, "b": {"type": "string"}} and quality.struct_type(json.dumps(flat)).simpleString() == "struct<a:bigint,b:string>"


def test_resolve(spark):
    pairs = spark.createDataFrame([("abcd", "bcde"), ("", ""), (None, "x")], "a string, b string")
    assert [r[0] for r in pairs.select(resolve.sequence_ratio(F.col("a"), F.col("b"))).collect()] == [0.75, 1.0, None]
    assert [r[0] for r in pairs.select(resolve.indel_ratio(F.col("a"), F.col("b"))).collect()] == [0.75, 1.0, None]
    from difflib import SequenceMatcher
    from itertools import product

    left = ["Neurofibroma cell", "neurofibrma cells", "abc", "kitten", "", None, "Alpha Beta Gamma Delta"]
    right = ["neurofibroma cells", "abd", "sitting", "alpha beta gama delta", None]
    want = {(x, y) for x, y in product(left, right) if x and y and SequenceMatcher(None, x.lower(), y.lower()).ratio() >= 0.85}
    got = resolve.fuzzy_pairs(spark.createDataFrame([(x,) for x in left], "l string"), spark.createDataFrame([(y,) for y in right], "r string"), "l", "r", 0.85)
    assert {(r["l"], r["r"]) for r in got.collect()} == want
    ids_ = spark.createDataFrame([(x,) for x in ["Abc", "Abc", "Neurofibrma", "Neurofibrma", "syn", "syn", "once", "zzz", "zzz", None]], "i string")
    cat = resolve.categorise(ids_, "i", spark.createDataFrame([("abc",)], "n string"), "n", spark.createDataFrame([("neurofibroma",), ("SYN",)], "s string"), "s")
    assert {r["i"]: r["category"] for r in cat.collect()} == {"Abc": "exact", "Neurofibrma": "fuzzy", "syn": "synonym", "zzz": "new"}
    rules = [("f1", ["NIH", "National Institute"]), ("f2", ["CTF"])]
    assert [one(spark, v, lambda c: resolve.alias_rules(c, rules)) for v in ("CTF and NIH", "UNIHEALTH", "ctf", None)] == ["f1", "", "f2", ""]
    best = resolve.best_of_group(spark.createDataFrame([("a", "0.9", 2, 1), ("a", "0.9", 1, 2), ("", "x", 1, 3), (None, None, 1, 4)], "k string, c string, u int, o int"), ["k"], F.col("c"), F.col("u"), ["o"])
    assert sorted(r["o"] for r in best.collect()) == [2, 3, 4]


def test_mining(spark):
    docs = spark.createDataFrame([(1, "We used ImageJ and the NF1-flox mouse."), (2, "imagejs"), (3, None), (4, "")], "doc int, body string")
    pats = spark.createDataFrame([("i", "tool", "ImageJ"), ("m", "model", "NF1 flox mouse"), ("x", "tool", "--")], "id string, kind string, pattern string")
    assert sorted((r["doc"], r["id"]) for r in mining.scan(docs, "doc", "body", pats).collect()) == [(1, "i"), (1, "m")]
    assert mining.scan(docs.limit(0), "doc", "body", pats).count() == 0
    made = lambda t: one(spark, t, lambda c: mining.made_here(c, F.lit("Tool")))
    assert [made("We developed TOOL here"), made("We developed tool; tool obtained from ATCC"), made("nothing"), made(None)] == [True, False, False, False]
    assert [one(spark, t, lambda c: mining.versioned(c, F.lit("ImageJ"))) for t in ("ImageJ v1.5", "imagej 2.0", "ImageJ was", None)] == [True, True, False, False]
    assert one(spark, "the ST88-14 cell line and X-Y", mining.cell_codes) == ["ST88-14"] and one(spark, None, mining.cell_codes) == []
    hits = spark.createDataFrame([(1, "intro"), (1, "methods"), (1, "intro"), (2, "other")], "d int, s string")
    assert {r["d"]: (r["sections"], r["main_section"]) for r in mining.merge_sections(hits, ["d"], "s", ["methods", "intro"]).collect()} == {1: ("methods,intro", "methods"), 2: ("other", "other")}
    found = spark.createDataFrame([("ImageJ", "t", False), ("New", "t", True), ("bad", "t", True), ("k", "t", True), ("y", "t", False)], "n string, t string, title boolean")
    routed = mining.route(found, "n", "t", spark.createDataFrame([("imagej", "t")], "key string, kind string"), ["K"], ["bad"], F.col("title"))
    assert {r["n"]: r["status"] for r in routed.collect()} == {"ImageJ": "existing", "New": "novel", "bad": "excluded", "k": "known", "y": "review"}


def test_extract(spark):
    xml = "<article><body><sec><title>Materials and Methods</title><p>short</p></sec><sec><title>Methods</title><p>a longer body</p></sec><sec><title>Results</title><p>r</p></sec></body></article>"
    assert one(spark, xml, extract.article_sections) == {"methods": "a longer body", "results": "r"}
    assert one(spark, xml, lambda c: extract.article_sections(c, longest=False))["methods"] == "short a longer body"
    assert one(spark, "<broken", extract.article_sections) == {} and one(spark, None, extract.article_sections) == {}
    docs = spark.createDataFrame([(1, "see github.com/x/Tool1 and TOOL1 v2"), (2, None)], "d int, t string")
    got = extract.by_rules(docs, "d", "t", [("url", r"github\.com/\w+/(\w+)", 1, 0.9), ("version", r"(\w+) v\d", 1, 0.8)])
    assert [(r["name"], r["rule"], r["confidence"]) for r in got.collect()] == [("Tool1", "url", 0.9)]
    assert one(spark, "anti-X (Abcam, cat. no. AB123)", lambda c: extract.vendor_item(c)["catalog"]) == "AB123"
    acquire = lambda t: one(spark, t, lambda c: extract.acquisition(c, [(r"ATCC[ #-]*(CRL-\d+)", "ATCC")]))
    assert [acquire("from ATCC CRL-123"), acquire("a kind gift from Dr. Bee, London"), acquire("obtained from patients"), acquire(None)] == ["Available from ATCC (CRL-123)", "Available from Dr. Bee", "", ""]
    assert one(spark, "see RRID:CVCL_1234.", extract.registry_id) == "CVCL_1234" and one(spark, None, extract.registry_id) == ""


def test_compile_and_pivot(spark):
    df = spark.createDataFrame([(("in",), "", [("Usage", "p1"), ("Development", "p2")])], "basicInfo struct<name:string>, name string, pubs array<struct<_usageType:string,pmid:string>>")
    row = comp.build(df, {"name": ("basicInfo.name", "name"), "none": ("nope.x",), "pmid": comp.lead_publication(F.col("pubs"))["pmid"]}).first()
    assert tuple(row) == ("in", "", "p2")
    get = lambda **kw: (lambda f: F.lit(kw.get(f)).cast("string"))
    quiet = ("unknown", "n/a")
    rules = {"tool": [(("url",), (), "At: {url}"), (("how",), quiet, "{how}"), (("who",), (), "Contact {who}")], "model": [(("who", "where"), (), "Contact {who} ({where})"), (("who",), (), "Contact {who}")]}
    acq = lambda kind, **kw: one(spark, kind, lambda c: comp.by_rules(c, rules, get(**kw)))
    assert acq("tool", url="", how="N/A", who=" D ") == "Contact D" and acq("tool", url="u", how="h") == "At: u"
    assert acq("model", who="D", where="A") == "Contact D (A)" and acq("model", who="D") == "Contact D"
    assert acq("tool", how="unknown") == "" and acq("other", who="D") == "" and acq(None) == ""
    assert [tuple(r) for r in comp.fan_out(spark.createDataFrame([("a; b", "x;;y"), (None, "")], "p string, f string"), {"i": "p", "j": "f"}).select("i", "j").collect()] == [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("", "")]
    assert one(spark, '{"t": {"n": "1"}}', comp.nested_map)[0].asDict() == {"outer": "t", "inner": "n", "value": "1"} and one(spark, "broken", comp.nested_map) == []
    tools = spark.createDataFrame([("1", "a", "x"), ("1", "a", "x"), ("1", "b", "y"), ("1", "a", "w"), (None, "a", "z")], "p string, k string, n string")
    got = pivot.by_publication(tools, "p", "k", "n", ["a", "b", "c"]).first()
    assert (got["a"], got["b"], got["c"], got["n_names"]) == ("w; x", "y", "", 3)
    assert pivot.cross_reference(tools, "p", "k", "n").first()["xref"] == "a: w, x; b: y"
    assert pivot.by_publication(tools.limit(0), "p", "k", "n", ["a"]).count() == 0


def test_predicates(spark):
    assert [one(spark, v, lambda c: predicates.excluded_title(c, F.lit(None), ["case"])) for v in (None, " ", "A Showcase", "fine")] == [True, True, True, False]
    assert [one(spark, v, predicates.bucket) for v in ("0.9", "0.91", "0.7", "high", None)] == ["manual", "auto", "manual", "drop", "drop"]
    assert one(spark, "x", lambda c: predicates.first_reason([("null", F.lit(None).cast("boolean")), ("hit", c == "x"), ("later", F.lit(True))])) == "hit"
    assert [one(spark, t, lambda c: predicates.named_in_title(F.lit("GraphTool Suite v2.1"), c)) for t in ("the graphtool suite", "graphtool only", None)] == [True, False, False]
    df = spark.createDataFrame([(1, True), (2, True), (3, False), (4, None)], "i int, e boolean")
    assert sorted(r["i"] for r in stats.eligible_cap(df, F.col("e"), 1, ["i"]).collect()) == [1, 3, 4]
    assert predicates.without_tracking(spark.createDataFrame([(1, 2, 3)], "_a int, b int, ROW_ID int")).columns == ["b"]


def test_files(spark, tmp_path):
    from curatella.sources import files

    df = spark.createDataFrame([("a", "x, \"y\"\nz", 1), ("b", None, 2)], "k string, v string, n int")
    files.write_csv(df, str(tmp_path / "csv"), ["k", "v", "extra"])
    back = files.text_csv(spark, str(tmp_path / "csv"))
    assert sorted(tuple(r) for r in back.collect()) == [("a", 'x, "y"\nz', ""), ("b", "", "")]
    files.write_version(df, str(tmp_path / "t"), 1)
    files.write_version(df.limit(1), str(tmp_path / "t"), 2)
    assert files.latest_version(spark, str(tmp_path / "t")).count() == 1
    (tmp_path / "c1").mkdir(), (tmp_path / "c2").mkdir()
    for folder, name, body in (("c1", "1_text.json", '{"pmid": "PMID:1", "abstract": "old"}'), ("c1", "x.json", "{broken"), ("c2", "1_text.json", '{"pmid": "1", "abstract": "new"}')):
        (tmp_path / folder / name).write_text(body)
    cache = files.text_cache(spark, [str(tmp_path / "c1"), str(tmp_path / "c2")], "pmid string, abstract string")
    assert [tuple(r) for r in cache.collect()] == [("1", "new")]
    assert [r["key"] for r in files.file_keys(spark, str(tmp_path / "c1/*.json"), r"(\d+)_text\.json$").collect()] == ["1"]
    (tmp_path / "30_review.yaml").write_text("pmid: 30\ntools:\n  - name: 'A'\n    verdict: Keep\n  - name: B\n")
    review = files.review_yaml(spark, str(tmp_path / "*.yaml")).first()
    assert review["key"] == "30_review" and review["review"]["tools.1.verdict"] == "Keep" and review["review"]["tools.2.name"] == "B" and review["review"]["pmid"] == "30"
    export = spark.createDataFrame([([(("s", "p"), "x", [("e", 1)], ("n",))],)], "submissions array<struct<user:struct<name:string,email:string>,_publications:string,more:array<struct<email:string,k:int>>,only:struct<email:string>>>")
    assert files.export_records(export, ("email",)).first().asDict(True) == {"user": {"name": "s"}, "_publications": "x", "more": [{"k": 1}], "only": None}
    assert files.export_records(export.limit(0), ("email",)).count() == 0


def test_yaml_of_all_forms():
    from curatella.sources import files

    got = files.flat_yaml("pmid: 30\nnote: |\n  two\n  lines\nwords: [a, 'b c']\nplain:\n  - x\n  - y\nok: true\nnone: null\ntools:\n  - {name: A, uses: [1, 2]}\n")
    assert got == {"pmid": "30", "note": "two\nlines\n", "words.1": "a", "words.2": "b c", "plain.1": "x", "plain.2": "y", "ok": "true", "tools.1.name": "A", "tools.1.uses.1": "1", "tools.1.uses.2": "2"}
    assert files.flat_yaml("a: [") == {} and files.flat_yaml(None) == {} and files.flat_yaml("") == {} and files.flat_yaml("just text") == {}


def test_schema_and_rejects(spark):
    schema = {"properties": {"kind": {"$ref": "#/$defs/Kind", "description": "own"}, "bare": {"$ref": "#/$defs/Kind"}, "deep": {"$ref": "#/$defs/Deep"}}}
    flat = quality.inline_schema(schema, {"Kind": {"title": "T", "description": "its", "enum": ["a"]}, "Deep": {"title": "D", "type": ["object", "null"], "properties": {"again": {"$ref": "#/$defs/Deep"}}}})["properties"]
    assert flat["kind"] == {"type": "string", "enum": ["a"], "description": "own"} and flat["bare"] == {"type": "string", "enum": ["a"]}
    assert flat["deep"] == {"title": "D", "type": "object", "properties": {"again": {"type": "object"}}}
    item = lambda t: tuple(one(spark, t, lambda c: extract.vendor_item(c, r"^(?:Figure|Table)")))
    assert item("(Figure, cat. 12) and (Abcam, cat. no. AB1)") == ("Abcam", "AB1") and item("(Table, cat. 12)") == (None, None) and item(None) == (None, None)
    score = lambda a, b: spark.range(1).select(scoring.name_score(F.lit(a), F.lit(b), F.lit("Ann"), F.lit("Lee"))).first()[0]
    assert [score(" ann", "LEE"), score("Alice", "Leeds Smith"), score(None, "lee"), score("", None)] == [4, 1, 2, 0]
    keys = quality.foreign_keys({"a": spark.createDataFrame([], "x string, b_id string").schema, "b": spark.createDataFrame([], "b_id string").schema}, {"b": "b_id"})
    assert keys == [("a", "b_id", "b", "b_id")]


def test_positions_and_lists(spark):
    at = lambda t, n: spark.range(1).select(text.positions(F.lit(t), F.lit(n))).first()[0]
    assert [at("aaa", "aa"), at("xAbab", "ab"), at("ab", "ab"), at("x", "ab"), at("a.b+a.b", "A.B"), at("", "a"), at("a", "")] == [[1, 2], [2, 4], [1], [], [1, 5], [], []]
    assert at("x\\Ey x\\E", "x\\e") == [1, 6] and at(None, "a") in ([], None)
    rows = [(v,) for v in ("a; b (x; y)", '["a","b"]', "", None, "NULL", "one", "[not json")]
    once = [r[0] for r in spark.createDataFrame(rows, "v string").select(text.json_list(F.col("v"))).collect()]
    assert once == ['["a","b (x; y)"]', '["a","b"]', None, None, None, '["one"]', '["[not json"]']
    df = spark.createDataFrame([("t 10",), ("t 9",), ("t",), ("a 2",)], "v string")
    assert [r["v"] for r in df.orderBy(*text.numeric_order(F.col("v"))).collect()] == ["a 2", "t", "t 9", "t 10"]
    wide = spark.range(5000).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("v"), "id")
    assert stats.listed(wide, ["g"], "v", ["id"], 3).first()["listed"] == "0, 1, 2 ... (4997 more)"


def test_match_by(spark):
    now = spark.createDataFrame([("a", "1", "x"), ("a", "2", "y"), (None, "3", "z"), ("b", None, "w")], "k string, j string, v string")
    new = spark.createDataFrame([("a", "9", "n", 1), ("a", "9", "later", 2), ("q", "3", "m", 3), (None, None, "o", 4)], "k string, j string, v string, t int")
    got = lambda pair: sorted((r["k"] or "", r["j"] or "", r["v"], r["action"]) for r in reconcile.match_by(now, new, ["k", "j"], ["v"], ["t"], pair).collect())
    assert got(False) == sorted([("a", "1", "n", "update"), ("a", "2", "n", "update"), ("", "3", "m", "update"), ("b", "", "w", "none"), ("", "", "o", "insert")])
    assert [x[3] for x in got(True)].count("insert") == 4 and [x[3] for x in got(True)].count("none") == 4


def test_incremental(spark, tmp_path):
    from curatella.streaming import incremental

    src, seen = tmp_path / "in", []
    src.mkdir()
    (src / "a.json").write_text('{"k": 1}\n{"k": 2}\n')
    run = lambda: incremental.run_new_files(spark, str(src), "k int", str(tmp_path / "cp"), lambda b, i: seen.extend(r["k"] for r in b.collect()))
    run()
    (src / "b.json").write_text('{"k": 3}\n')
    run()
    run()
    assert sorted(seen) == [1, 2, 3]
    assert [r[0] for r in incremental.pending(spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1,), (None,)], "k int"), ["k"]).orderBy("k").collect()] == [None, 2]

def test_lookup_by_containment(spark):
    index = spark.createDataFrame([("abcdef", 1), ("xabcdefx", 2), ("humannerve", 3), ("ab", 4)], "key string, id int")
    wanted = spark.createDataFrame([("abcdef",), ("bcde",), ("nerve",), ("ab",), ("a",), ("zzz",), ("",), (None,)], "q string")
    got = {r["q"]: (r["id"], r["how"]) for r in resolve.containing_lookup(wanted, "q", index).collect()}
    assert got == {"abcdef": (1, "direct"), "bcde": (1, "contains"), "nerve": (3, "prefixed"), "ab": (4, "direct")}
    assert resolve.containing_lookup(wanted, "q", index.limit(0)).count() == 0



def test_containing_lookup_of_short_keys(spark):
    index = spark.createDataFrame([("snf96.2", 1), ("hek293", 2), ("st88", 3), ("x", 4), ("ab", 5), ("humanq", 6), ("", 7)], "key string, id long")
    wanted = spark.createDataFrame([("st",), ("8",), ("ek",), ("x",), ("b",), ("q",), ("zz",), ("é",), ("h",)], "q string")
    got = {r["q"]: (r["id"], r["how"]) for r in resolve.containing_lookup(wanted, "q", index, shortest=1).collect()}
    assert got == {"st": (3, "contains"), "8": (3, "contains"), "ek": (2, "contains"), "x": (4, "direct"), "b": (5, "contains"), "q": (6, "prefixed"), "h": (2, "contains")}

def test_scan_broadcasts_no_exploded_words(spark):
    """Words by the thousand of a table that is guessed to be small went to the driver, each with its whole text."""
    docs = spark.range(40).selectExpr("CASE WHEN id < 2 THEN NULL ELSE id DIV 2 END AS doc", "CASE id WHEN 0 THEN 'nf1' WHEN 1 THEN 'nf2' ELSE concat('the nf1 flox ', CASE id % 2 WHEN 0 THEN 'mouse' ELSE 'rat ' END, repeat(' x y', 500)) END AS body")
    pats = spark.createDataFrame([("a", "g", "NF1"), ("m", "t", "NF1 flox mouse"), ("a", "g", "NF1"), ("n", "g", "NF2"), ("o", "t", "nf1 flox rat mouse")], "id string, kind string, pattern string")
    got = mining.scan(docs, "doc", "body", pats)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString().replace("autoBroadcast", "")
    want = [(d, i) for d in range(1, 20) for i in "am"]
    assert sorted((r["doc"], r["id"]) for r in got.where("doc IS NOT NULL").collect()) == want
    assert sorted(r["id"] for r in got.where("doc IS NULL").collect()) == ["a", "n"]


def test_fuzzy_scan_equals_brute_force(spark):
    from difflib import SequenceMatcher

    texts = {1: "We used the ImageJay software and GraphPad Prisn 9.", 2: "grahpad prism", 3: "ab", 4: None, 5: "", 6: "nothing of the kind " * 20}
    pats = ["GraphPad Prism", "ImageJ", "of", "neurofibroma model system", "used"]
    want = set()
    for d, t in texts.items():
        for p in pats:
            low, q = (t or "").lower(), p.lower()
            wins = [low[i : i + len(q)] for i in range(len(low) - len(q) + 1)]
            if q in low or (len(q) >= 4 and any(SequenceMatcher(None, w, q, autojunk=False).ratio() >= 0.88 for w in wins)):
                want.add((d, p))
    docs = spark.createDataFrame(list(texts.items()), "d int, t string")
    got = mining.fuzzy_scan(docs, "d", "t", spark.createDataFrame([(p,) for p in [*pats, pats[0]]], "pattern string"))
    assert {(r["d"], r["pattern"]) for r in got.collect()} == want and got.count() == len(want)


def test_caches_and_upgrades(spark):
    from curatella.sources import files

    schema = "pmid string, cache_level string, fetch_date string, text string"
    old = spark.createDataFrame([("PMID:1", "full", "2020", "a"), ("2", "minimal", "2020", "b"), ("3", "minimal", None, "c")], schema)
    new = spark.createDataFrame([("1", "minimal", "2022", "d"), ("2", "minimal", "2021", "e"), ("", "full", "2022", "f"), (None, "full", "2022", "g")], schema)
    got = {r["pmid"]: r["text"] for r in files.merge_cache(old, new, ["abstract_only", "minimal", "full"]).collect()}
    assert got == {"1": "a", "2": "e", "3": "c"}
    kind = "tools array<struct<verdict:string,confidence:double,toolType:string,completeness:double>>"
    rows = [([("Accept", 0.9, "a", 0.7)],), ([("Accept", 0.9, "a", 0.5)],), ([("Accept", 0.9, "skip", 0.9)],), ([("Accept", 0.8, "a", None)],), ([],), (None,)]
    flags = spark.createDataFrame(rows, kind).select(predicates.worth_upgrading(F.col("tools"), ["skip"]).alias("u")).collect()
    assert [r["u"] for r in flags] == [True, False, False, True, False, False]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(reference.ORACLE | curation.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = (reference.QUERIES | curation.QUERIES)[name](spark, SF)
    rows = sorted((tuple(plain(v) for v in r) for r in got.collect()), key=repr)
    want = duck.sql((reference.ORACLE | curation.ORACLE)[name])
    assert sorted(want.columns) == sorted(got.columns)
    order = [want.columns.index(c) for c in got.columns]
    assert rows == sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=repr)


def test_fuzzy_query_equals_brute_force(spark, duck):
    from difflib import SequenceMatcher

    assert set(reference.QUERIES | curation.QUERIES) - set(reference.ORACLE | curation.ORACLE) == {"s28_fuzzy_best"}
    typed = {r[0] for r in duck.sql("SELECT DISTINCT journal FROM publications WHERE trim(journal) <> ''").fetchall()}
    names = sorted(r[0] for r in duck.sql("SELECT DISTINCT journal_name FROM journal_reference").fetchall())
    want = {}
    for t in typed:
        score, name = max(((SequenceMatcher(None, t.lower(), n.lower()).ratio(), n) for n in reversed(names)), key=lambda x: x[0])
        if score >= 0.88:
            want[t] = (min(n for n in names if SequenceMatcher(None, t.lower(), n.lower()).ratio() == score), round(score, 6))
    assert {r["typed"]: (r["journal_name"], r["score"]) for r in reference.s28_fuzzy_best(spark, SF).collect()} == want and want
