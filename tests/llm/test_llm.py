"""The llm operators: small cases with edges, brute force, round trips and held-out accuracy."""

import random
from datetime import datetime
from itertools import combinations

import duckdb
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatella.llm import abuse, canonical, mixing, names, queries, survivors, tokens, truncation

SF = "/root/testdata/sf0.001"

# ---- canonical values

JOURNALS = [("J1", "Annals of Nerve Repair", "Ann Nerve Rep"), ("J2", "Nerve Repair Letters", None), ("J3", "Archives of Rare Disease", None), ("J4", "Pain and Quality of Life Reports", None)]
FUNDERS = [("F1", "Temma Trust for Hearing and Balance", "TTHB"), ("F2", "Drirtird Trust for Nerve Research", None), ("F3", "Ministry for Pain Relief of Town", None)]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("ANNALS OF NERVE REPAIR", "J1"),
        ("Annals_of_Nerve_Repair.", "J1"),
        ("Nerve Repair, Annals of", "J1"),
        ("Ann. Nerv. Repa.", "J1"),
        ("ann nerve rep", "J1"),
        ("Annlas of Nevre Repair", "J1"),
        ("Nerve Repair Letters (Online)", "J2"),
        ("Nerve Repair Letters, Suppl. 3", "J2"),
        ("In: Archives of Rare Disease 2021", "J3"),
        ("Pain &amp; Quality of Life Reports", "J4"),
        ("Annals of Nerve Economics", "UNMATCHED"),
        ("Nerve Gas Letters", "UNMATCHED"),
        ("Nerve Repair", "UNMATCHED"),
        ("x" * 100_000, "UNMATCHED"),
        ("(", "UNMATCHED"),
        ("中文", "UNMATCHED"),
    ],
)
def test_journals(value, want):
    assert canonical.Matcher(JOURNALS)(value) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [("T.T.H.B.", "F1"), ("TTHB grant 12-3456", "F1"), ("DTNR # 1", "F2"), ("Temma Hearing and Balance Trust", "F1"), ("supported by the Temma Trust for Hearing and Balance - TTHB", "F1"), ("Temma Trust", "F1"), ("Temma Tr. for Hearing & Balance", "F1"), ("Min. Pain Reli. Town", "F3"), ("Estate of the Temma Family", "UNMATCHED"), ("Temma Council for Hearing and Balance", "UNMATCHED")],
)
def test_funders(value, want):
    assert canonical.Matcher(FUNDERS)(value) == want


def test_matcher_of_empty_list_and_any_text():
    assert canonical.Matcher([])("x") == canonical.UNMATCHED
    m = canonical.Matcher(JOURNALS + [("J9", "", None), (None, "x", None)] + JOURNALS)
    assert m("") == canonical.UNMATCHED and m(" . ") == canonical.UNMATCHED


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_matcher_never_fails(text):
    assert canonical.Matcher(JOURNALS)(text) in {"J1", "J2", "J3", "J4", "UNMATCHED"}


def test_map_values(spark):
    items = spark.createDataFrame([("journal", 1, 1, "nerve repair letters", "x"), ("journal", 1, 1, "nerve repair letters", "x"), ("journal", 2, 1, None, "x"), ("other", 3, 1, "nerve repair letters", "x")], "field_name string, row_id int, pos int, value string, ref_id string")
    got = canonical.map_values(items, {"journal": JOURNALS})
    assert sorted((r["row_id"], r["ref_id"]) for r in got.collect()) == [(1, "J2"), (1, "J2"), (2, "UNMATCHED"), (3, "UNMATCHED")]
    assert canonical.map_values(items.limit(0), {"journal": JOURNALS}).count() == 0


def test_edits_equal_brute_force():
    def slow(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    words = ["nerve", "nevre", "nreve", "never", "", "n", "nerves", "verne"]
    for a, b in combinations(words, 2):
        assert min(slow(a, b), 4) == min(canonical.near(a, b, 3), 4)


# ---- truncated texts

FULL = "Loss of NF1 was confirmed by flow cytometry in 39 of 240 samples. Tumor take was 21% in NSG hosts and reached 68 mm by day 38."
NOTES = ["used as control", "kept at 4 C", "passage 3 to 9"]


def test_ends_early():
    b = truncation.bare(FULL)
    assert truncation.ends_early(b[:-20], b) in (1, 2) and truncation.ends_early(b[: b.index("flow") + 2], b) == 2
    assert truncation.ends_early(b, b) == 0 and truncation.ends_early(b, b[:-20]) == 0 and truncation.ends_early("", b) == 0
    assert truncation.ends_early("quite another text than that one", b) == 0


def test_judge(spark):
    rows = [(i, "src", f"R{i % 7}", f"{FULL} Sample {i} was kept.") for i in range(40)] + [(100 + i, "notes", f"N{i}", "; ".join([f"tool {i} {NOTES[0]}", *(NOTES[1:] if i % 2 else NOTES[:0:-1])])) for i in range(30)]
    rows += [
        (200, "src", "R1", f"{FULL} Sample 1 was ke"),
        (201, "src", "Y", "Loss of NF1 was confirmed by flow cytometry in 39 of"),
        (202, "src", "X", "Tumor take was 21% in NSG hosts and rea..."),
        (203, "notes", "X", "tool 3 used as control; kept at"),
        (204, "notes", None, "tool 3 used as control; kept at 4 C"),
        (205, None, None, f"{FULL} Sample 7 was kept."),
        (206, "src", "X", None),
        (207, "src", "X", "N/A"),
        (208, "src", "X", "Loss of NF1 was confirmed by flow cytometry in 39 of 240 samples. Tumor take was 76%"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "sp_id long, _source string, resourceId string, _context string, why string")
    got = {r["key"]: r["why"] for r in truncation.judge(df, "sp_id", "_context", "_source", "resourceId").collect()}
    assert {k: v for k, v in got.items() if v} == {200: "copy", 201: "sentence", 202: "mark", 203: "closing", 208: "sentence"}
    assert 206 not in got and 207 not in got
    assert truncation.judge(df.limit(0), "sp_id", "_context", "_source", "resourceId").count() == 0


def test_field_limits(spark):
    texts = [(("word%d " % (i * 7919)) * 60)[: 120 + (i % 60)] for i in range(180)] + [("w%d x%d " % (i, i * 31) * 40)[:200] for i in range(40)] + ["the very same phrase"] * 90
    df = spark.createDataFrame([("s", t) for t in texts], "src string, t string")
    assert {(r["measure"], r["limit"]) for r in truncation.field_limits(df, "t", "src").collect()} == {("chars", 200), ("bytes", 200)}


def test_signatures_find_near_copies():
    words = [f"w{i}" for i in range(64)]
    other = [*words[:40], "changed", *words[41:]]
    sign = lambda ws, r, salt="x": set(truncation.signatures([ws], [[r]], [salt])[0])
    assert sign(words, 32) == sign(other, 32) and sign(words, 64) & sign(other, 64) and not sign(words, 64) & sign(words, 64, "y")
    assert set(truncation.signatures([["z"] * 9, words], [[8], [8, 16]], ["x", "x"], 10)[1]) == sign(words, 8) | sign(words, 16) and len(sign(words, 8)) == truncation.BANDS
    assert truncation.signatures([[]], [[]], [""]) == [[]] and truncation.similar(words, other)


# ---- survivors

AT = datetime(2020, 1, 1)
SCHEMA = "sp_id long, resourceId string, _pmid string, _doi string, _publicationTitle string, _year string, _usageType string, _context string, _fundingAgency string, _modified timestamp_ntz, _source string, _confidence string, _gkey string, _num int"


def mention(i, res="R", pmid=None, doi=None, title=None, year=None, use=None, ctx=None, fund=None, at=AT, conf=None):
    return (i, res, pmid, doi, title, year, use, ctx, fund, at, "s", conf, "clash", 0)


def test_groups(spark):
    long = "the whole context of this mention " * 300
    rows = [
        mention(1, pmid="PMID:0030", ctx=long),
        mention(2, pmid="30.0", doi="d", title="t", ctx="short"),
        mention(3, pmid=None, ctx=" THE whole context of this "),
        mention(4, pmid="n/a", ctx="the whole context of another"),
        mention(5, pmid="31"),
        mention(6, pmid="31;", at=None),
        mention(7, res="S", pmid="30"),
        mention(8, res=None, pmid="30"),
        mention(9, res=None, pmid="30"),
        mention(10, res="T", ctx="alone one"),
        mention(11, res="T", ctx="Alone  one and more"),
        mention(12, res="T", ctx=None),
        mention(13, res="T", pmid="none known"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r["group_id"], r["n_records"], r["keep_id"], r["context_id"]) for r in survivors.settle(survivors.assign(df)).collect())
    assert got == [(1, 3, 2, 1), (5, 2, 5, -1), (10, 2, 10, 11)]
    assert survivors.settle(survivors.assign(df.limit(0))).count() == 0
    twice = survivors.settle(survivors.assign(df.union(df)))
    assert twice.where("group_id = 4").first()["n_records"] == 2


def test_bundles_agree(spark):
    rows = [
        mention(1, pmid="1", doi="a", use="U", at=datetime(2021, 1, 1)),
        mention(2, pmid="1", doi="b", title="title b", year="2001"),
        mention(3, pmid="1", title="title none"),
        mention(4, pmid="2", doi="a", title="x", year="1"),
        mention(5, pmid="2", fund="F"),
    ]
    got = {r["group_id"]: r for r in survivors.survivors(spark.createDataFrame(rows, SCHEMA)).collect()}
    # the newest head names doi a, the fullest tail doi b: together b is worth more than a with title none
    assert (got[1]["head_id"], got[1]["tail_id"], got[1]["_doi"], got[1]["_publicationTitle"], got[1]["_usageType"]) == (2, 2, "b", "title b", "U")
    assert (got[4]["_doi"], got[4]["_fundingAgency"], got[4]["_context"]) == ("a", "F", None)


def weight_of(r):
    return 1 + round(1000 * (float(r[11]) if r[11] and r[11][0].isdigit() else {"high": 0.9, "low": 0.3}.get(r[11], 0.5)))


def brute_force(rows, head=(2, 3), tail=(4, 5)):
    """Trust of the best agreeing (head, tail) of one group, by trying all."""
    fill = lambda r, cols: weight_of(r) * sum(r[c] is not None for c in cols)
    best = None
    for h in rows:
        for t in [*rows, None]:
            if fill(h, head) == 0 or (t is not None and (fill(t, tail) == 0 or (h[3] and t[3] and h[3] != t[3]))):
                continue
            worth = fill(h, head) + (fill(t, tail) if t else 0)
            best = max(best or 0, worth)
    return best


def test_bundles_reach_the_optimum(spark):
    import random

    rnd, rows, groups = random.Random(5), [], {}
    for i in range(1, 400):
        g = str(i % 60 + 1)
        r = mention(i, pmid=g, doi=rnd.choice([None, "a", "b", "c"]), title=rnd.choice([None, "t"]), year=rnd.choice([None, "y"]), at=datetime(2020, 1, rnd.randint(1, 28)), conf=rnd.choice([None, "high", "low", "0.8", "1.0", "", "0"]))
        rows.append(r)
        groups.setdefault(g, []).append(r)
    by_id = {r[0]: r for r in rows}
    for r in survivors.survivors(spark.createDataFrame(rows, SCHEMA)).collect():
        own = groups[str(int(by_id[r["group_id"]][2]))]
        h, t = by_id[r["head_id"]], by_id.get(r["tail_id"])
        assert t is None or not h[3] or not t[3] or h[3] == t[3]
        assert weight_of(h) * sum(x is not None for x in h[2:4]) + (weight_of(t) * sum(x is not None for x in t[4:6]) if t else 0) == brute_force(own)


def test_trust_decides(spark):
    rows = [mention(1, pmid="1", doi="a", title="t", conf="0.1"), mention(2, pmid="1", doi="b", conf="high"), mention(3, pmid="1", title="u", conf="0.2", at=None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = survivors.survivors(df).first()
    assert (got["head_id"], got["tail_id"], got["_doi"], got["_publicationTitle"]) == (2, 3, "b", "u")
    # a distrusted source loses its say
    rows.append((*mention(4, pmid="1", doi="c", conf="1.0")[:10], "bad", "1.0", None, 0))
    df = spark.createDataFrame(rows, SCHEMA)
    assert survivors.survivors(df).first()["head_id"] == 4 and survivors.survivors(df, trust={"bad": 0.1}).first()["head_id"] == 2


def test_survivors_plan_stays_small(spark):
    """Uncut, the plan repeated the groups' own for each use and outgrew the driver."""
    cols = ("resourceId", "_pmid", "_doi", "_publicationTitle", "_year", "_usageType", "_context", "_fundingAgency", "_source")
    rows = [(i, "r", "12", f"10.1/{i}", "t", "2020", "u", "some text", "f", "s", datetime(2024, 1, 1 + i)) for i in range(3)]
    out = survivors.survivors(spark.createDataFrame(rows, "sp_id long, " + ", ".join(f"{c} string" for c in cols) + ", _modified timestamp"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 2
    assert [(r["group_id"], r["n_records"], r["head_id"]) for r in out.collect()] == [(0, 3, 2)]


# ---- names


def linked(spark, rows, person=True):
    df = spark.createDataFrame([(i, n, m, s, "clash") for i, (n, m, s) in enumerate(rows)], "id long, name string, more string, same_as string, entity string")
    out: dict = {}
    for r in names.link(names.parse(df, person)).collect():
        out.setdefault(r["entity"], []).append(r["id"])
    return sorted(sorted(v) for v in out.values())


def test_people(spark):
    rows = [
        ("Richard Fonri", "University of Zagrolkozi", None),
        ("Fonri, Rick", "Zagrolkozi Univ (Dept. of Genetics)", None),
        ("Dr Richrad Fonri, PhD", "UNIV. OF ZAGROLKOZI", None),
        ("R. Fonri", "U. Zagrolkozi", None),
        ("Christopher Fonri", "University of Zagrolkozi", None),
        ("Fonri CB", "University of Zagrolkozi", None),
        ("Richard Fonri", "Trepempelu Children's Hospital", None),
        ("The Zagrolkozi Rare Disease Biobank (RDB)", "University of Zagrolkozi", None),
        ("Zagrolkozi Rare Dise. Bioba.", "Zagrolkozi University", None),
        ("Zagrolkozi Xenograft Shared Resource", "Zagrolkozi University", None),
        ("", "x", None),
        (None, None, None),
    ]
    assert linked(spark, rows) == [[0, 1, 2, 3], [4, 5], [6], [7, 8], [9]]


def test_ambiguous_initials_stay_apart(spark):
    rows = [("Robert Vilrak", "University of Vodoskuvi", None), ("Richard Vilrak", "University of Vodoskuvi", None), ("R. Vilrak", "University of Vodoskuvi", None)]
    assert linked(spark, rows) == [[0], [1], [2]]


def test_identifiers_link_and_part(spark):
    rows = [("Anders Rargok", "University of Wodelzopra", "1"), ("Anders Rargk", "Somewhere Hospital", "1"), ("Anders Rargok", "University of Wodelzopra", "2")]
    assert linked(spark, rows) == [[0, 1], [2]]


def test_instruments(spark):
    rows = [
        ("Didemgrime Itch Severity Questionnaire – Adult Form", None, None),
        ("didemgrime_itch_severity_questionnaire (Adult)", None, None),
        ("Itch Severity Questionnaire of Didemgrime, adult version", None, None),
        ("Didemgrime's Itch Seve. Quest., adult version", "Questionnaire", None),
        ("Didemgrime ISQ Adult Form", None, None),
        ("Didemgrime Itch Severity Questionnaire – Child Form", None, None),
        ("Didemgrime Hearing Handicap Inventory", None, None),
        ("Didemgrime HHI", None, None),
        ("Didemgrime Itch Severity Scale – Adult Form", None, None),
        ("Stunesreste Itch Severity Questionnaire – Adult Form", None, None),
        (" ", None, None),
    ]
    assert linked(spark, rows, person=False) == [[0, 1, 2, 3, 4], [5], [6, 7], [8], [9]]


def test_instruments_with_slips_inside_the_author(spark):
    """Exchanged, dropped and changed letters in the middle of an author's name, and of the words' initials."""
    pairs = [("Lanuneze", "Lanunveze"), ("Pagrmmuka", "Pagummuka"), ("Bopembruno", "Bopemruno"), ("Kluranwiha", "Klutanwiha"), ("Sejollarpu", "Seollapru")]
    rows = [(f"{author} Pain Interference Battery", None, None) for pair in pairs for author in pair]
    rows += [("Didemgrime Itch Severity Questionnaire", None, None), ("Didemgrime Itch Eseverity Questionnaire", None, None), ("Didemgrime Sleep Interference Battery", None, None)]
    assert linked(spark, rows, person=False) == [[0, 1], [2, 3], [4, 5], [6, 7], [8, 9], [10, 11], [12]]
    people = [("Michael Osva", "University of Sotan", None), ("Michael Osva", "University of Soptan", None), ("Michael Osva", "University of Vitrel", None)]
    assert linked(spark, people) == [[0, 1], [2]]


def test_blocks_hold_all_that_agrees(spark):
    """Every pair that agree accepts among names with random slips is a candidate."""
    rng = random.Random(5)

    def slip(w):
        i, kind = rng.randrange(1, len(w) - 1), rng.randrange(4)
        return w[:i] + {0: "", 1: "q" + w[i], 2: "z", 3: w[i + 1] + w[i]}[kind] + w[i + (2 if kind == 3 else 1) :]

    authors = [a for a in ("lanuneze", "bopem", "sejollarpu", "wimo", "a" * 9 + "bcdefghijklmn", "kra" * 8) for a in (a, *(slip(a) for _ in range(6)), *(slip(slip(a)) for _ in range(6)))]
    instruments = [("instrument", a, [slip(w) if rng.random() < 0.3 else w for w in ("pain", "interference", "battery")], "", "", False) for a in authors] + [("instrument", a, ["pib"], "", "", True) for a in authors[:40]]
    people = [("person", rng.choice((a, f"{a}-fonri")), [rng.choice(("richard", "r"))], "", slip("zagrolkozi"), False) for a in authors]
    people = [(*p[:5], len(p[2][0]) == 1) for p in people] + [("organisation", "", [slip(w) for w in ("disease", "biobank")], "", slip("zagrol"), False) for _ in range(20)]
    for parsed in (instruments, people):
        each = spark.createDataFrame([(f"{i:03}", *k) for i, p in enumerate(parsed) for k in names.blocks(p)], "nid string, tag string, word string, also string")
        got = {(int(r[0]), int(r[1])) for r in names.candidates(each).collect()}
        want = {(i, j) for i in range(len(parsed)) for j in range(i + 1, len(parsed)) if names.agree(parsed[i], parsed[j]) or names.agree(parsed[j], parsed[i])}
        assert len(want) > 100 and want <= got


def test_no_guess_of_sizes_broadcasts_names(spark, monkeypatch):
    """Exploded keys were guessed to be as small as the table and went through the driver."""
    from curatella.functions import lineage

    plans, own = [], lineage.cut

    def cut(df, *args, **how):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return own(df, *args, **how)

    monkeypatch.setattr(lineage, "cut", cut)
    if hasattr(names, "cut"):
        monkeypatch.setattr(names, "cut", lambda df: cut(df, guess=False))
    rows = spark.range(6).selectExpr("id", "element_at(array('Ann Beewax', 'Beewax, Ann', 'Ann Beewaxx'), 1 + CAST(id % 3 AS int)) AS name", "'University of Zagrolkozi' AS more", "CAST(NULL AS string) AS same_as")
    pairs = names.entity_pairs(names.link(names.parse(rows, True)))
    plans.append(pairs._jdf.queryExecution().sparkPlan().toString())
    assert len(plans) > 10 and not [p for p in plans if "BroadcastHashJoin" in p]
    assert pairs.count() == 15


def test_guessed_size_of_components_stays_small(spark, monkeypatch):
    """Each round's joins raised the guess to its fourth power: after some ten rounds a number of megabytes."""
    from curatella.functions import skew
    from curatella.functions.components import components

    monkeypatch.setattr(skew, "LEAST", 2)
    got = components(spark.range(60).selectExpr("id AS a", "id + 1 AS b"), "a", "b")
    guess = got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(guess)).bit_length() <= 80
    assert got.select("component").distinct().count() == 1 and got.count() == 61


def test_cut_keeps_rows_with_and_without_the_guess(spark):
    from curatella.functions import lineage

    df = spark.range(10).selectExpr("id", "CASE WHEN id > 3 THEN array(id) END AS a")
    for guess in (True, False):
        got = lineage.cut(df, guess=guess)
        assert got.schema == df.schema and sorted(got.collect()) == sorted(df.collect())
        assert got.join(got.withColumnRenamed("a", "b"), "id").count() == 10


def test_link_of_nothing_and_of_copies(spark):
    assert linked(spark, []) == []
    assert linked(spark, [("Ann Beewax", "University of Zagrolkozi", None)] * 50) == [list(range(50))]
    many = [("Ann " + "Beewax" * 2000, "x" * 5000, None), ("Ann Beewax", "University of Zagrolkozi", None)]
    assert linked(spark, many) == [[0], [1]]


def test_every_beginning_is_looked_up_where_it_is_offered():
    rnd = random.Random(3)
    for _ in range(300):
        b = " ".join(rnd.choice(["ab", "c", "defg", "hi,", "j"]) for _ in range(rnd.randint(2, 40)))
        a = b[: rnd.randint(1, len(b) - 1)].rstrip()
        if len(a.split()) > 1 and truncation.ends_early(a, b):
            assert set(truncation.seek([a.split()], ["x"])[0]) & set(truncation.offer([b.split()], ["x"])[0])
            assert not set(truncation.seek([a.split()], ["x"])[0]) & set(truncation.offer([b.split()], ["y"])[0])


def test_hot_note_is_not_paired_with_all(spark):
    """A third of all texts are one note, another third begin with its words: each is judged."""
    rows = [(i, "the same short note; in use" if i % 3 == 0 else f"the same short note; in use since {i}" if i % 3 == 1 else f"other {i} text.", "s", "R") for i in range(900)]
    df = spark.createDataFrame(rows, "sp_id long, _context string, _source string, resourceId string")
    got = truncation.judge(df, "sp_id", "_context", "_source", "resourceId")
    assert got.count() == 900 and got.where("why = 'copy' AND key % 3 = 0").count() == 300


def test_pairs_and_components(spark):
    from curatella.functions.components import components

    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("a % 50 != 49")
    got = {r["node"]: r["component"] for r in components(chain).collect()}
    assert all(got[i] == i // 50 * 50 for i in range(200))
    assert components(chain.limit(0)).count() == 0
    loops = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (None, 3)], "a int, b int")
    assert {r["node"]: r["component"] for r in components(loops).collect()} == {1: 1, 2: 1}
    pairs = names.entity_pairs(spark.createDataFrame([(3, "x"), (1, "x"), (2, "x"), (9, "y")], "id long, entity string"))
    assert sorted(tuple(r) for r in pairs.collect()) == [(1, 2), (1, 3), (2, 3)]


def test_jaro_winkler():
    assert names.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4) and names.jaro_winkler("dwayne", "duane") == pytest.approx(0.84, abs=1e-4)
    assert names.jaro_winkler("", "a") == 0.0 and names.jaro_winkler("", "") == 1.0 and names.jaro_winkler("abc", "xyz") == 0.0


# ---- tokens


def plain(text):
    return tokens.load()[0].encode_ordinary(text)


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=200) | st.text(st.sampled_from(" \t\n\r'’`\"!?.,;-_()<|>/@#abcdefgstvxqzAZ0189éüß中日字한😩\u0085\xa0　 ​́"), max_size=200))
def test_forced_boundaries_change_nothing(text):
    _, inside = tokens.load()
    parts = tokens.fragments(text, inside, 1)
    assert "".join(parts) == text and [i for p in parts for i in plain(p)] == plain(text)
    ids = next(tokens.encode([text])).tolist()
    assert ids == plain(text) and tokens.decode_bytes(ids) == text


def test_long_texts_and_special_strings():
    for text in ("a" * 200_000, " " * 100_000, "中文 text, " * 30_000, "<|endoftext|> is text", "x1y2 " * 50_000):
        assert next(tokens.encode([text])).tolist() == plain(text)


def test_other_library_agrees():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokens.VOCABULARIES}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = [x for x in pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist() if x]
    assert [e.ids for e in t.encode_batch(texts, add_special_tokens=False)] == [x.tolist() for x in tokens.encode(texts)]


def test_encode_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, ""), (3, None), (None, "x")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = tokens.encode_table(df, "doc_id", "text")
    assert dict(got.dtypes) == {"doc_id": "bigint", "ids": "array<int>"}
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in got.collect()) == [(0, plain("x")), (1, plain("a b")), (1, plain("a b")), (2, []), (3, [])]
    assert tokens.encode_table(df.limit(0), "doc_id", "text").count() == 0
    assert tokens.encode_table(df, "doc_id", "text", counts_only=True, keep=("ids",)).columns == ["doc_id", "ids", "n_tokens"]


# ---- mixing


def test_plan_mix():
    rates, total = mixing.plan_mix({"a": 100, "b": 50, "c": 0}, {"a": (0.5, 1), "b": (0.3, 3), "c": (0.2, 9), "d": (0.1, 1)})
    assert rates["a"] == pytest.approx(1.0) and rates["b"] * 50 / total == pytest.approx(0.375) and set(rates) == {"a", "b"}
    rates, total = mixing.plan_mix({"a": 100, "b": 50}, {"a": (0.5, 1), "b": (0.5, 3)}, total=240)
    assert rates == pytest.approx({"a": 1.0, "b": 2.8}) and total == pytest.approx(240)
    assert mixing.plan_mix({}, {"a": (1.0, 1)}) == ({}, 0.0)


def as_table(spark, targets):
    return spark.createDataFrame([(k, *v) for k, v in targets.items()], "source string, target_share double, max_repeats int")


@settings(max_examples=300, deadline=None)
@given(st.floats(1e-30, 1e6), st.integers(1, 10**13))
def test_units_keep_the_rate(rate, docs):
    part, copy = mixing.units(rate, docs)
    if rate * docs > 1e15:  # copies that no mix holds
        return
    assert part >= 1 and part * docs <= 2 * mixing.LARGEST_SUM and copy <= mixing.LARGEST_SUM and (part / copy <= rate * (1 + 1e-9) or part == 1)
    if rate * docs > 0.01:
        assert part / copy == pytest.approx(rate, rel=1e-4)
    assert mixing.units(3.0, docs)[0] == 3 * mixing.units(3.0, docs)[1]


def test_source_of_a_tiny_rate_contributes(spark):
    """5 million documents of which two are wanted: a rate of 4e-7."""
    docs = spark.range(5_000_020).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20, "small").otherwise("huge").alias("source"), F.when(F.col("id") < 20, 1000).otherwise(10_000).alias("n_tokens"))
    s = {r["source"]: r for r in mixing.mix(docs, as_table(spark, {"small": (0.5, 1), "huge": (0.5, 1)}))[1].collect()}
    assert s["small"]["copies"] == 20 and s["huge"]["copies"] == 2 and s["huge"]["actual_share"] == 0.5


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1000), st.sampled_from([0.0, 0.1, 0.3, 0.5]), st.integers(0, 4)), min_size=1, max_size=6), st.sampled_from([None, 10.0, 5000.0]), st.booleans())
def test_rates_are_the_same_where_they_lie(spark, rows, total, fill):
    want, _ = mixing.plan_mix({str(i): r[0] for i, r in enumerate(rows)}, {str(i): r[1:] for i, r in enumerate(rows)}, total, fill)
    df = spark.createDataFrame([(str(i), s, r, t) for i, (t, s, r) in enumerate(rows)], "source string, target_share double, max_repeats int, tokens long")
    got = {r["source"]: r["rate"] for r in mixing.plan_where_it_lies(df, total, fill).collect()}
    assert got == pytest.approx({k: want.get(k, 0.0) for k in got}, rel=1e-9)


def test_many_sources(spark):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("source"), F.lit(10).alias("n_tokens"))
    targets = as_table(spark, {"hot": (0.3, 2), **{str(i): (0.014, 2) for i in range(50)}})
    a, b = (mixing.mix(docs, targets, fill=True, in_driver=n) for n in (10_000, 5))
    assert a[0].exceptAll(b[0]).count() == 0 and a[0].count() == b[0].count() > 0 and a[1].exceptAll(b[1]).count() == 0


def test_mix_shares_and_caps(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "small").when(F.col("id") % 50 == 2, None).otherwise("rest").alias("source"), (F.col("id") % 17).alias("n_tokens"), F.lit("x").alias("_units"))
    targets = {"hot": (0.2, 2), "small": (0.3, 4), "rest": (0.5, 2), "absent": (0.1, 3)}
    emitted, shares = mixing.mix(docs, as_table(spark, targets))
    s = {r["source"]: r for r in shares.collect()}
    assert s["absent"]["docs"] == 0 and s[None]["copies"] == 0 and s[None]["docs"] > 0
    for name in ("hot", "small", "rest"):
        assert s[name]["actual_share"] == pytest.approx(targets[name][0], abs=0.02)
    most = emitted.groupBy("source").agg(F.max("copy").alias("m")).collect()
    assert all(r["m"] <= targets[r["source"]][1] for r in most)
    again, _ = mixing.mix(docs.repartition(7), as_table(spark, targets))
    assert emitted.exceptAll(again).count() == 0 and emitted.count() == again.count()


def test_scarce_source_does_not_shrink_the_mix(spark):
    sizes, targets = {"a": 60_000, "b": 40_000, "letter": 50}, {"a": (0.57, 2), "b": (0.4, 2), "letter": (0.03, 3)}
    rates, total = mixing.plan_mix(sizes, targets, fill=True)
    assert total == pytest.approx(100_050) and rates["letter"] == 3.0 and rates["a"] * 60_000 / (rates["b"] * 40_000) == pytest.approx(0.57 / 0.4)
    # where every share can be met with all tokens or more, nothing changes
    assert mixing.plan_mix({"a": 100, "b": 100}, {"a": (0.5, 2), "b": (0.5, 3)}, fill=True) == mixing.plan_mix({"a": 100, "b": 100}, {"a": (0.5, 2), "b": (0.5, 3)})
    docs = spark.range(10_001).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 10_000, "letter").when(F.col("id") < 6000, "a").otherwise("b").alias("source"), F.when(F.col("id") == 10_000, 50).otherwise(10).alias("n_tokens"))
    emitted, shares = mixing.mix(docs, as_table(spark, targets | {"none": (0.01, 2)}), fill=True)
    s = {r["source"]: r for r in shares.collect()}
    assert sum(r["tokens_out"] for r in s.values()) == pytest.approx(100_050, abs=50) and s["letter"]["copies"] == 3
    assert s["letter"]["shortfall"] == pytest.approx(0.03 - 150 / 100_050, abs=1e-4) and s["a"]["shortfall"] == 0.0 and s["none"]["shortfall"] == pytest.approx(0.01)
    assert emitted.where("source = 'letter'").count() == 3


def test_mix_emits_once_per_boundary(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(10).alias("n_tokens"))
    emitted, _ = mixing.mix(docs, as_table(spark, {"a": (1.0, 7)}), total=27_770)
    per = emitted.groupBy("doc_id").count().groupBy("count").count().collect()
    assert {r[0] for r in per} <= {2, 3} and abs(emitted.count() - 2777) <= 1


def test_mix_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, source string, n_tokens long")
    emitted, shares = mixing.mix(none, as_table(spark, {"a": (1.0, 2)}))
    assert emitted.count() == 0 and [r["source"] for r in shares.collect()] == ["a"]
    emitted, shares = mixing.mix(none, as_table(spark, {}))
    assert emitted.count() == 0 and shares.count() == 0
    bad = spark.createDataFrame([("a", 0.5, 2), ("a", 0.4, 1), (None, 0.1, 1), ("b", None, 1)], "source string, target_share double, max_repeats int")
    assert [tuple(r) for r in mixing.clean_targets(bad).collect()] == [("a", 0.4, 1)]


# ---- abuse


def test_fold_undoes_disguise():
    assert abuse.fold("u$3l3$$") == "useless" and abuse.fold("b-a-s-t-a-r-d") == "bastard" and abuse.fold("i d i o t") == "idiot"
    assert abuse.fold("jackaaaass") == "jackass" and abuse.fold("sсumbаg") == "scumbag" and abuse.fold("ÍDIOT") == "idiot"
    assert "#" in abuse.fold("HM-52/327T at 33 °C") and abuse.fold("") == "" and abuse.fold("12.5 34") == "0 0"


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=300))
def test_windows_never_fail(text):
    assert all(isinstance(w, str) and w for w in abuse.windows(text))


def test_held_out_accuracy():
    """Two thirds of the labelled documents fit, a third judges."""
    d = "/root/testdata/sf0.1"
    texts = dict(zip(*(pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"])[c].to_pylist() for c in ("doc_id", "text")), strict=True))
    labels = pq.read_table(f"{d}/doc_labels.parquet").to_pylist()
    rows = [(texts[r["doc_id"]], r["toxic"]) for r in sorted(labels, key=lambda r: r["doc_id"] * 2654435761 % 1000) if texts.get(r["doc_id"])]
    model = abuse.fit([r for i, r in enumerate(rows) if i % 3])
    scorer = model.scorer()
    judged = [(scorer.document(t) > model.margin, y) for i, (t, y) in enumerate(rows) if not i % 3]
    hits, alarms = sum(a and y for a, y in judged), sum(a and not y for a, y in judged)
    # 31 toxic documents to learn from; test_held_out_accuracy_of_many_labels has more
    assert hits >= 0.7 * sum(y for _, y in judged) and alarms <= 0.02 * len(judged)


def test_held_out_accuracy_of_many_labels():
    import os

    import pyarrow.dataset as ds

    d = "/root/testdata/check_l"
    if not os.path.isdir(d):
        pytest.skip("no larger tables here")
    labels = {r["doc_id"]: r["toxic"] for r in ds.dataset(f"{d}/doc_labels.parquet").to_table().to_pylist()}
    t = ds.dataset(f"{d}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pydict()
    rows = sorted((k * 2654435761 % 1000, x, labels[k]) for k, x in zip(t["doc_id"], t["text"], strict=True) if k in labels and x)
    model = abuse.fit([r[1:] for i, r in enumerate(rows) if i % 3])
    scorer = model.scorer()
    judged = [(scorer.document(x) > model.margin, y) for i, (_, x, y) in enumerate(rows) if not i % 3]
    assert sum(a and y for a, y in judged) >= 0.9 * sum(y for _, y in judged) and sum(a and not y for a, y in judged) <= 0.01 * len(judged)


def test_score_edges(spark):
    model = abuse.fit([("You are a stupid idiot and I hate you.", 1), ("The samples were kept at 4 C.", 0)] * 5)
    df = spark.createDataFrame([(1, "You are a stupid idiot and I hate you."), (2, None), (3, ""), (4, "The samples were kept at 4 C."), (4, "The samples were kept at 4 C."), (5, "The samples were kept. " * 5000 + "You are a stupid idiot and I hate you.")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = sorted((r["doc_id"], r["is_toxic"]) for r in abuse.score(df, model).collect())
    assert got == [(1, True), (2, False), (3, False), (4, False), (4, False), (5, True)]
    assert abuse.score(df.limit(0), model).count() == 0
    none = abuse.fit([])
    assert none == abuse.Model(b"", b"", 0.0) and [(r["score"], r["is_toxic"]) for r in abuse.score(df.limit(2), none).collect()] == [(-1.0, False)] * 2
    for n in (1, 2, 3, 7):  # few labels still train
        few = abuse.fit([("You are a stupid idiot and I hate you.", 1)] * n + [("The samples were kept at 4 C.", 0)] * n)
        assert few.toxic and few.ordinary


def test_long_pieces_are_cut_and_covered():
    text = "x" * 10_000 + " " + "word " * 3000
    got = abuse.pieces(text)
    assert max(map(len, got)) <= abuse.LONGEST and "".join(got).replace(" ", "") == abuse.fold(text).replace(" ", "")


def test_sample(spark):
    docs = spark.createDataFrame([(1, "a. b"), (2, None), (3, "c"), (None, "d"), (4, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (None, 1), (9, 1), (3, None), (4, 0)], "doc_id long, toxic long")
    assert sorted((r["piece"], r["y"]) for r in abuse.sample(docs, labels).collect()) == [("a.", 1), ("b", 1), ("c", 0)]
    assert abuse.sample(docs, labels.limit(0)).count() == 0 and abuse.fit_table(abuse.sample(docs, labels.limit(0))) == abuse.Model(b"", b"", 0.0)


def test_model_is_kept_and_the_same_in_executors(spark, tmp_path):
    rows = [(i, f"You are a stupid idiot and I hate you {i}. Samples were kept.", 1) for i in range(12)] + [(100 + i, f"The samples {i} were kept at 4 C. Then stained.", 0) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic long")
    model = abuse.fit_table(abuse.sample(df.select("doc_id", "text"), df.select("doc_id", "toxic")))
    model.save(spark, f"file://{tmp_path}/model")
    assert abuse.Model.load(spark, f"file://{tmp_path}/model") == model
    assert {r["doc_id"] for r in abuse.score(df, model).where("is_toxic").collect()} == set(range(12))


# ---- queries


@pytest.fixture(scope="module")
def duck():
    import os

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    want = duck.sql(queries.ORACLE[name])
    order = [want.columns.index(c) for c in got.columns]
    assert rows == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    # the smallest tables have no labels to find anything by
    assert queries.QUERIES[name](spark, SF).count() > 0 or name == "p10_found"
