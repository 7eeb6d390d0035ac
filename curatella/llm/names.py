"""Variant spellings of the names of persons, organisations and instruments, linked.

Names are parsed into parts; equal parses are merged before anything is compared. Words that are the same
but for slips are found first, by an equi-join on what is left when letters are dropped, so that blocks
(author, or place and surname, with what must be equal) hold every pair that the comparison can accept.
Pairs within a block are compared by Jaro-Winkler, edits, abbreviations and a nickname table. Accepted pairs of full
names make components; shortened names (initials, acronyms) then join a component only if it is the
only one that fits, so that they can't tie two persons together.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatella.functions import blank, lineage, skew
from curatella.functions.components import components
from curatella.llm.canonical import fold, likeness, near

# Nicknames and the given names they stand for.
NICKNAMES = {
    "al": "albert", "alex": "alexander", "sasha": "alexander", "sandy": "sandra", "andy": "andrew", "drew": "andrew", "tony": "anthony", "ant": "anthony",
    "ben": "benjamin", "benny": "benjamin", "bea": "beatriz", "trixie": "beatriz", "charlie": "charlotte", "lottie": "charlotte", "chris": "christopher", "topher": "christopher",
    "kit": "christopher", "dan": "daniel", "danny": "daniel", "dave": "david", "deb": "deborah", "debbie": "deborah", "debby": "deborah", "ed": "edward", "eddie": "edward",
    "ted": "edward", "ned": "edward", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "lizzie": "elizabeth", "eliza": "elizabeth", "fred": "frederick", "freddie": "frederick",
    "gabi": "gabriela", "gaby": "gabriela", "gabby": "gabriela", "greg": "gregory", "bella": "isabella", "izzy": "isabella", "isa": "isabella", "jen": "jennifer", "jenny": "jennifer",
    "jenn": "jennifer", "joe": "joseph", "joey": "joseph", "jo": "joseph", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kat": "katherine", "kitty": "katherine",
    "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "peg": "margaret", "marge": "margaret", "matt": "matthew", "mike": "michael", "mick": "michael", "mikey": "michael",
    "nick": "nicholas", "nicky": "nicholas", "pat": "patricia", "patty": "patricia", "trish": "patricia", "tricia": "patricia", "phil": "philippa", "pippa": "philippa", "pip": "philippa",
    "becky": "rebecca", "becca": "rebecca", "rick": "richard", "dick": "richard", "rich": "richard", "ricky": "richard", "bob": "robert", "rob": "robert", "bobby": "robert",
    "robbie": "robert", "bert": "robert", "sam": "samantha", "sammy": "samantha", "steve": "stephen", "steven": "stephen", "sue": "susannah", "susie": "susannah", "suzy": "susannah",
    "susan": "susannah", "tess": "tessa", "theo": "theodora", "dora": "theodora", "thea": "theodora", "tom": "thomas", "tommy": "thomas", "vicky": "victoria", "vicki": "victoria",
    "tori": "victoria", "bill": "william", "will": "william", "billy": "william", "liam": "william", "jim": "james", "jimmy": "james", "jack": "john", "johnny": "john",
    "larry": "lawrence", "len": "leonard", "ron": "ronald", "don": "donald", "ken": "kenneth", "sally": "sarah", "nancy": "anne", "annie": "anne", "molly": "mary", "polly": "mary",
}

# Titles and degrees around a person's name.
TITLES = frozenset("dr prof professor mr mrs ms miss sir dame pi md phd mph msc ms ma ba bs bsc mba dphil dvm do rn jr sr ii iii iv facs frcp pharmd psyd mbbs".split())
# Words of organisations' names, and words of affiliations that aren't the place.
ORG_WORDS = tuple("biobank repository registry facility resource core center centre institute laboratory consortium foundation network initiative unit bank library collection platform program service association society trust".split())
AFFILIATION_WORDS = tuple(
    "university univ uni hospital hosp children childrens institute inst institution medical med research res imr department dept division div school college center centre clinic medicine "
    "neurology genetics oncology pediatrics paediatrics surgery pathology biology chemistry radiology dermatology usa the of for and faculty laboratory lab health sciences science national".split()
)
# Kinds of instruments, and words that tell the form.
KINDS = ("scale", "index", "inventory", "questionnaire", "checklist", "battery", "interview", "survey", "test", "measure", "profile", "schedule", "assessment", "diary", "rating")
FORMS = {"adult": "adult", "adults": "adult", "child": "child", "children": "child", "paediatric": "child", "pediatric": "child", "kids": "child", "youth": "child", "adolescent": "adolescent", "parent": "parent", "proxy": "proxy"}
FORM_WORDS = frozenset(("form", "version", "edition", "vers", "ver"))

#: Words are exploded to some forty keys each, which no guess of sizes knows.
cut = functools.partial(lineage.cut, guess=False)


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity with the common beginning (up to 4) counted once more by a tenth."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken = [False] * len(b)
    first: list[str] = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                first.append(c)
                break
    if not first:
        return 0.0
    second = [c for j, c in enumerate(b) if taken[j]]
    half = sum(x != y for x, y in zip(first, second, strict=True)) / 2
    m = len(first)
    jaro = (m / len(a) + m / len(b) + (m - half) / m) / 3
    same = 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return jaro + 0.1 * same * (1 - jaro)


def same_word(a: str, b: str) -> bool:
    """One word, misspelt: few edits for its length, and alike by Jaro-Winkler."""
    if a == b:
        return True
    n = min(len(a), len(b))
    most = 0 if n < 4 else 1 if n < 7 else 2
    return bool(most) and abs(len(a) - len(b)) <= most and near(a, b, most) <= most and jaro_winkler(a, b) >= 0.82


def _letters(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", text)


@functools.lru_cache(maxsize=50_000)
def _beside_place(word: str) -> bool:
    """Whether a long word of an affiliation is one of the usual ones, misspelt."""
    return any(abs(len(v) - len(word)) < 3 and near(word, v, 2) <= 2 for v in AFFILIATION_WORDS if len(v) > 4)


def place_of(affiliation: str | None) -> str:
    """The word of an affiliation that names the place; '' if there is none."""
    if affiliation is None:
        return ""
    text = re.sub(r"\([^)]*\)", " ", fold(affiliation).replace("'s", "").replace("’s", ""))
    best = ""
    for w in _letters(text):
        if len(w) > 5 and len(w) > len(best) and not _beside_place(w):
            best = w
    return best or max((w for w in _letters(text) if w not in AFFILIATION_WORDS), key=len, default="")


@functools.lru_cache(maxsize=50_000)
def _of_organisation(word: str) -> bool:
    """Whether a word is one of organisations' names, abbreviated or misspelt."""
    return len(word) > 3 and any(o.startswith(word[:4]) and len(word) <= len(o) + 2 or (abs(len(o) - len(word)) < 2 and near(word, o, 1) <= 1) for o in ORG_WORDS)


def _organisation(tokens: list[str]) -> bool:
    return len(tokens) > 2 and any(_of_organisation(w) for w in tokens)


def parse_person(name: str | None, affiliation: str | None = None) -> tuple[str, str, list[str], str, str, bool] | None:
    """(kind, main, rest, extra, place, reduced) of a person or organisation, None if nothing is there.

    Persons: kind `person`, main the surname (its parts joined by hyphens), rest [given], extra the middle initials; reduced if the
    given name is an initial. Organisations: kind `organisation`, main '', rest the words but the place,
    reduced if they are given as one acronym.
    """
    if name is None or not name.strip():
        return None
    place = place_of(affiliation)
    raw = re.sub(r"\([^)]*\)", " ", name.strip()).strip(" .,;*#")
    raw = re.sub(r"(?i)\b(?:m\.\s?d\.?|ph\.\s?d\.?|m\.\s?sc\.?|d\.\s?phil\.?)", " ", raw)
    if not re.search(r"[\s,.]", raw):
        raw = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", raw, count=1)
    plain = [w for w in _letters(fold(raw)) if w != "the" and w not in TITLES]
    if _organisation(plain):
        own = place or max(plain, key=len)
        hit = max(plain, key=lambda w: jaro_winkler(w, own))
        rest = [w for w in plain if not (w == hit and jaro_winkler(w, own) > 0.8) and w not in ("of", "the", "and", "for")]
        return "organisation", "", rest, "", place or hit, False
    if len(plain) == 2 and place and len(plain[1]) < 6 and jaro_winkler(plain[0], place) > 0.85:
        return "organisation", "", [plain[1]], "", place, True
    head, comma, tail = raw.partition(",")
    tail_words = [w for w in _letters(fold(tail)) if w not in TITLES]
    if comma and tail_words:
        surname = [w for w in re.findall(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*", fold(head)) if w not in TITLES]
        given = tail_words
        initials_only = _initials(tail)
    else:
        words = [w for w in re.findall(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*\.?", head) if fold(w).strip(".") not in TITLES or (len(w) <= 2 and w.isupper() and fold(w).strip(".") not in ("dr", "md", "pi"))]
        words = [w.strip(".") for w in words]
        if not words:
            return None
        if len(words) == 2 and words[1].isupper() and len(words[0]) > 3 and (len(words[1]) < 3 or (len(words[1]) == 3 and fold(words[1]) not in NICKNAMES)):
            surname, given, initials_only = [fold(words[0])], list(fold(words[1])), True
        else:
            first = next((i for i in range(1, len(words)) if len(words[i]) > 2), len(words) - 1)
            surname = [fold(w) for w in words[first:]]  # `Junvok Jillosk` is one surname, as with a hyphen
            given = [fold(w) for w in words[:first]]
            initials_only = bool(given) and len(given[0]) == 1
    main = "-".join(p for w in surname for p in _letters(w))
    if not main:
        return None
    if initials_only:
        letters = "".join(g if len(g) <= 3 else g[0] for g in given)
        return "person", main, [letters[:1]], letters[1:2], place, True
    first = given[0] if given else ""
    return "person", main, [NICKNAMES.get(first, first)], "".join(g[0] for g in given[1:2]), place, first == ""


def _initials(text: str) -> bool:
    tokens = [t for t in re.findall(r"[^\W\d_]+", text) if fold(t) not in TITLES or len(t) == 1]
    return bool(tokens) and (len(tokens[0]) == 1 or (len(tokens) == 1 and len(tokens[0]) <= 3 and tokens[0].isupper() and fold(tokens[0]) not in NICKNAMES))


def parse_instrument(name: str | None, kind: str | None = None) -> tuple[str, str, list[str], str, str, bool] | None:
    """(kind, main, rest, extra, place, reduced): kind `instrument`, main the author, rest the words of
    what it measures and its kind, extra the form ('' if none is told), place the kind of instrument (''
    if unknown), reduced if the words are given as one acronym."""
    if name is None or not name.strip():
        return None
    text = fold(re.sub(r"(?<=[a-z])'s\b|(?<=[a-z])’s\b", " ", re.sub(r"\(([A-Z]{3,6})\)", " ", name)).replace("_", " "))
    known = fold(kind).strip() if kind else ""
    known = known if known in KINDS else ""
    brackets = [w for b in re.findall(r"\(([^)]*)\)", text) for w in _letters(b)]
    author = next((w for w in brackets if w not in FORMS and w not in FORM_WORDS and len(w) > 4), "")
    body = re.sub(r"\([^)]*\)", " ", text)
    form = ""
    tokens = []
    for w in [*_letters(body), *(w for w in brackets if w != author)]:
        hit = FORMS.get(w) or next((f for x, f in FORMS.items() if len(w) > 4 and x in ("adult", "child", "pediatric") and near(w, x, 1) <= 1), None)
        if hit:
            form = hit
        elif w not in FORM_WORDS:
            tokens.extend(["quality", "life"] if w == "qol" else [w])
    tokens = [w for i, w in enumerate(tokens) if not (w == "the" and i == 0)]
    if not author and len(tokens) > 3 and tokens[-2] == "of" and _kind(tokens[-3]) and len(tokens[-1]) > 4:
        author = tokens[-1]
        tokens = tokens[:-2]
    rest = [w for w in tokens if w not in ("of", "for", "and", "the", "in", "s")]
    if not author:
        if not rest:
            return None
        author, rest = rest[0], rest[1:]
    if len(rest) == 1 and len(rest[0]) <= 4:
        letter = {k for k in KINDS if k[0] == rest[0][-1]}
        return "instrument", author, [rest[0]], form, known or (next(iter(letter)) if len(letter) == 1 else ""), True
    if rest:
        own = _kind(rest[-1])
        if own:
            rest = [*rest[:-1], own]
            known = own
    return "instrument", author, rest, form, known, False


@functools.lru_cache(maxsize=50_000)
def _kind(word: str) -> str:
    """The kind of instrument that a word, abbreviated or misspelt, means; '' if none."""
    best = max(KINDS, key=lambda k: likeness(word, k))
    return best if likeness(word, best) >= 0.55 else ""


#: Letters up to which a word is looked up by what is left when letters are dropped; longer ones by their fifths.
LONGEST = 22


def slips(word: str) -> list[str]:
    """Look-up keys of a word: any two words that same_word accepts share one.

    A slip costs each of two words one letter at most, so words with m slips (as many as same_word allows
    them) have in common what is left when up to m letters are dropped. In long words two slips spoil at most
    four fifths (an exchange may lie across a border), and the fifth that is whole moves by two places at most.
    """
    n = len(word)
    most = 0 if n < 4 else 1 if n < 7 else 2
    out = set()
    if n <= LONGEST:
        out = now = {word}
        for _ in range(most):
            now = {w[:i] + w[i + 1 :] for w in now for i in range(len(w))}
            out = out | now
    if n >= LONGEST - 1:
        for size in range(n, n + 3):  # of the longer word of a pair
            ends = [size * i // 5 for i in range(6)]
            for i, (start, end) in enumerate(zip(ends, ends[1:])):
                for at in range(max(0, start - 2), min(n - (end - start), start + 2) + 1):
                    out.add(hashlib.md5(f"{size} {i} {word[at : at + end - start]}".encode()).hexdigest())
    return sorted(out)


def blocks(parsed: tuple[str, str, list[str], str, str, bool]) -> list[tuple[str, str, str]]:
    """Block keys (tag, word, also) of a parsed name: names that agree have keys of equal tags whose words are
    the same by same_word, and whose second words are.

    The tag holds what agree compares exactly: the form of instruments, the number of words of two full names,
    the initials where one is shortened.
    """
    kind, main, rest, extra, place, reduced = parsed
    if kind == "person":
        parts = main.split("-")
        return [("p", place, w) for w in dict.fromkeys(("".join(parts), *(parts if not reduced else ())))]
    letters = rest[0] if reduced else "".join(w[0] for w in rest)
    if kind == "instrument":
        return [(f"i|{extra}|{t}", main, "") for t in ([letters] if reduced else [str(len(rest)), letters])]
    letters = "".join(sorted(letters))
    return [(f"o|{t}", place, "") for t in ([letters] if reduced else [str(len(rest)), letters])]


def _keys(c: str):
    """slips of a column's words."""
    return F.pandas_udf(lambda words: words.map(slips), "array<string>").asNondeterministic()(c)


def _near(a: str, b: str):
    """same_word's conditions as far as the JVM has them; neighbours exchanged are two edits there."""
    short = F.least(F.length(a), F.length(b))
    most = F.when(short < 4, 0).when(short < 7, 1).otherwise(2)
    return (F.abs(F.length(a) - F.length(b)) <= most) & F.levenshtein(a, b, 4).between(0, 2 * most)


def fellows(words: DataFrame) -> DataFrame:
    """(word, fellow) of distinct words (column word), both ways: other words that same_word takes for the same."""

    @F.pandas_udf("boolean")
    def same(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_word(x, y) or same_word(y, x) for x, y in zip(a, b, strict=True)], dtype="bool")

    posted = cut(words.where(F.length("word") > 3).select("word", F.explode(_keys("word")).alias("_s")).select("word", F.xxhash64("_s").alias("_s")))
    # what is left of many words may be the same few letters
    pairs = skew.salted_join(posted, posted.select(F.col("word").alias("fellow"), "_s"), ["_s"], "inner", posted.count())
    pairs = pairs.where((F.col("word") < F.col("fellow")) & _near("word", "fellow")).select("word", "fellow").distinct()
    pairs = cut(pairs.where(same.asNondeterministic()("word", "fellow")))
    return pairs.unionByName(pairs.select(F.col("fellow").alias("word"), F.col("word").alias("fellow")))


def candidates(each: DataFrame) -> DataFrame:
    """(nid, nid_2), the smaller first: distinct pairs of nodes with fitting block keys (nid, tag, word, also).

    Fellows of the first words (authors, places) are found among all of them; second words (surnames) meet
    only beside fitting first ones, by what is left of them. Keys of many nodes, such as a name without a
    place, are salted.
    """
    near = cut(fellows(each.select("word").distinct()))
    other = each.where(F.length("word") > 3).join(near, "word")
    looked = each.unionByName(other.withColumn("word", F.col("fellow")).drop("fellow"))

    def posted(df: DataFrame) -> DataFrame:
        left = F.when(F.col("also") == "", F.array(F.lit(""))).otherwise(_keys("also"))
        return df.withColumn("_s", F.explode(left)).select("nid", "also", F.xxhash64("tag", "word", "_s").alias("_s"))

    mine = cut(posted(looked))
    pairs = skew.salted_join(mine, posted(each).select(F.col("nid").alias("nid_2"), F.col("also").alias("also_2"), "_s"), ["_s"], "inner", mine.count())
    return pairs.where((F.col("nid") < F.col("nid_2")) & _near("also", "also_2")).select("nid", "nid_2").distinct()


def agree(a: tuple, b: tuple) -> int:
    """How well two parsed names fit one entity: 0 not, 1 without contradiction, 2 with all parts.

    Where one is shortened, the answer only says that it can be short for the other.
    """
    if a[0] != b[0]:
        return 0
    if a[0] == "instrument":
        return _agree_instruments(a, b)
    if not same_word(a[4], b[4]):
        return 0
    if a[0] == "organisation":
        if a[5] or b[5]:
            letters = [sorted(x[2][0]) if x[5] else sorted(w[0] for w in x[2]) for x in (a, b)]
            return 2 if letters[0] == letters[1] else 0
        return 2 if len(a[2]) == len(b[2]) and _aligned(sorted(a[2]), sorted(b[2])) else 0
    if not same_word(a[1].replace("-", ""), b[1].replace("-", "")):
        # half of a compound surname will do beside a whole given name
        parts = (a[1].split("-"), b[1].split("-"))
        if a[5] or b[5] or min(map(len, parts)) > 1 or not any(same_word(p, q) for p in parts[0] for q in parts[1]):
            return 0
    if a[3] and b[3] and a[3] != b[3]:
        return 0
    x, y = a[2][0], b[2][0]
    level = 2 if a[3] and a[3] == b[3] else 1
    if a[5] or b[5]:
        return level if x[:1] == y[:1] or not x or not y else 0
    return level if x == y or same_word(x, y) else 0


def _agree_instruments(a: tuple, b: tuple) -> int:
    if a[3] != b[3] or not same_word(a[1], b[1]):
        return 0
    if a[4] and b[4] and a[4] != b[4]:
        return 0
    if a[5] and b[5]:
        return 1 if a[2] == b[2] else 0
    if a[5] or b[5]:
        short, full = (a, b) if a[5] else (b, a)
        if "".join(w[0] for w in full[2]) != short[2][0]:
            return 0
        return 2 if short[4] else 1
    return 2 if len(a[2]) == len(b[2]) and _aligned(a[2], b[2]) else 0


def _aligned(a: list[str], b: list[str]) -> bool:
    """Every word has its own fellow, abbreviated or misspelt."""
    left = list(b)
    for w in a:
        score, hit = max(((max(likeness(w, x), likeness(x, w)), x) for x in left), default=(0.0, ""))
        if score < 0.5:
            return False
        left.remove(hit)
    return True


PARSED = "struct<kind: string, main: string, rest: array<string>, extra: string, place: string, reduced: boolean>"


def parse(records: DataFrame, person: bool) -> DataFrame:
    """records (id, name, more, same_as) with nid, parsed and keys; names without parts are left out.

    person: name of a person or organisation, more its affiliation; else of an instrument, more its kind.
    nid is a digest of all that comparison looks at: equal parses are one node.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.to_pylist()
            out = []
            for r in t:
                parsed = parse_person(r["name"], r["more"]) if person else parse_instrument(r["name"], r["more"])
                if parsed is not None:
                    keys = blocks(parsed) + ([(f"s|{r['same_as']}", "", "")] if r["same_as"] else [])
                    out.append({"id": r["id"], "same_as": r["same_as"], "parsed": dict(zip(("kind", "main", "rest", "extra", "place", "reduced"), parsed, strict=True)), "keys": [dict(zip(("tag", "word", "also"), k, strict=True)) for k in sorted(set(keys))]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("id", pa.int64()), ("same_as", pa.string()), ("parsed", pa.struct([("kind", pa.string()), ("main", pa.string()), ("rest", pa.list_(pa.string())), ("extra", pa.string()), ("place", pa.string()), ("reduced", pa.bool_())])), ("keys", pa.list_(pa.struct([("tag", pa.string()), ("word", pa.string()), ("also", pa.string())])))])
    got = records.select("id", "name", "more", "same_as").mapInArrow(run, f"id bigint, same_as string, parsed {PARSED}, keys array<struct<tag: string, word: string, also: string>>")
    return got.withColumn("nid", F.unhex(F.md5(F.to_json(F.struct("parsed", F.coalesce("same_as", F.lit("")).alias("s"))))))


def link(parsed: DataFrame) -> DataFrame:
    """entity of each record of parse's output, beside its id and whatever other columns it has; entity is
    shared by the records of one entity. Names of different kinds may be linked in one run.

    Equal parses are compared once. Names that share an identifier (same_as) and a main word are linked;
    different identifiers forbid a direct link. Every record of ``parsed`` gets an entity, alone if need be.
    """
    own = [c for c in parsed.columns if c not in ("nid", "parsed", "keys", "same_as")]
    parsed = cut(parsed)
    nodes = cut(parsed.groupBy("nid").agg(F.first("parsed").alias("parsed"), F.first("keys").alias("keys"), F.first("same_as").alias("same_as")))
    # only ids meet in the blocks; what is compared is fetched for distinct pairs
    pairs = candidates(nodes.select("nid", F.inline("keys")))
    side = nodes.select("nid", "parsed", "same_as")
    pairs = pairs.join(side, "nid").join(side.select(*(F.col(c).alias(f"{c}_2") for c in side.columns)), "nid_2")

    @F.pandas_udf("int")
    def fit(a: pd.DataFrame, b: pd.DataFrame, s: pd.Series, t: pd.Series) -> pd.Series:
        out = []
        for x, y, i, j in zip(a.itertuples(index=False, name=None), b.itertuples(index=False, name=None), s, t, strict=True):
            x, y = (*x[:2], list(x[2]), *x[3:]), (*y[:2], list(y[2]), *y[3:])
            if i and j:
                out.append(0 if i != j or not same_word(x[1], y[1]) else 3)
            else:
                out.append(agree(x, y))
        return pd.Series(out, dtype="int32")

    a, b = (lambda f: F.col(f"parsed.{f}")), (lambda f: F.col(f"parsed_2.{f}"))
    ids = F.col("same_as").isNotNull() & F.col("same_as_2").isNotNull()
    full = ~a("reduced") & ~b("reduced")
    fits = a("kind") == b("kind")
    fits = fits & ((a("kind") != "person") | (a("extra") == "") | (b("extra") == "") | (a("extra") == b("extra")))
    fits = fits & ((a("kind") != "instrument") | ((a("extra") == b("extra")) & ((a("place") == "") | (b("place") == "") | (a("place") == b("place")))))
    fits = fits & ((a("kind") == "person") | ~full | (F.size(a("rest")) == F.size(b("rest"))))
    # agree's exact conditions as far as the JVM has them; identifiers decide alone
    pairs = pairs.where(F.when(ids, F.col("same_as") == F.col("same_as_2")).otherwise(fits))
    # called non-deterministic so that filtering on its result doesn't run it a second time
    judged = pairs.withColumn("level", fit.asNondeterministic()("parsed", "parsed_2", "same_as", "same_as_2")).where(F.col("level") > 0)
    judged = cut(judged.select("nid", "nid_2", "level", F.col("parsed.reduced").alias("r"), F.col("parsed_2.reduced").alias("r_2")))
    full = components(judged.where((~F.col("r") & ~F.col("r_2")) | (F.col("level") == 3)), "nid", "nid_2")
    label = nodes.join(full.withColumnRenamed("node", "nid"), "nid", "left").select("nid", F.col("parsed.reduced").alias("r"), F.coalesce("component", "nid").alias("entity"), F.col("component").isNotNull().alias("_in"))
    short = judged.where((F.col("r") != F.col("r_2")) & (F.col("level") < 3)).select(F.when(F.col("r"), F.col("nid")).otherwise(F.col("nid_2")).alias("s"), F.when(F.col("r"), F.col("nid_2")).otherwise(F.col("nid")).alias("f"), "level")
    homes = short.join(label.select(F.col("nid").alias("f"), F.col("entity").alias("home")), "f").groupBy("s", "home").agg(F.max("level").alias("level"))
    best = homes.groupBy("s").agg(F.max("level").alias("top"), F.count(F.lit(1)).alias("n"))
    sole = homes.join(best, "s").where(F.col("level") == F.col("top")).groupBy("s").agg(F.min("home").alias("home"), F.count(F.lit(1)).alias("k"))
    sole = cut(sole)
    # shortened names that fit no full name are linked with each other
    lone = judged.where(F.col("r") & F.col("r_2") & (F.col("level") < 3)).join(sole.select(F.col("s").alias("nid")), "nid", "left_anti").join(sole.select(F.col("s").alias("nid_2")), "nid_2", "left_anti")
    alone = components(lone, "nid", "nid_2").select(F.col("node").alias("nid"), F.col("component").alias("_alone"))
    final = label.join(sole.where("k = 1").select(F.col("s").alias("nid"), F.col("home").alias("_home")), "nid", "left").join(alone, "nid", "left")
    final = final.select("nid", F.when(F.col("_in"), F.col("entity")).otherwise(F.coalesce("_home", "_alone", "entity")).alias("entity"))
    # copies of one name may be a third of all rows
    return skew.salted_join(parsed.select(*own, "nid"), final, ["nid"], "inner", parsed.count()).select(*own, "entity")


def entity_pairs(linked: DataFrame) -> DataFrame:
    """(id_1, id_2, and linked's other columns, of the first): all pairs of records of one entity, the
    smaller id first.

    Its size is the sum of squared entity sizes by definition; ``link`` itself expands no entity.
    """
    linked = cut(linked)
    many = linked.groupBy("entity").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("entity")
    rows = linked.join(many, "entity", "left_semi")
    pairs = skew.salted_join(rows.withColumnRenamed("id", "id_1"), rows.select("entity", F.col("id").alias("id_2")), ["entity"], "inner", linked.count())
    return pairs.where(F.col("id_1") < F.col("id_2")).drop("entity")


def identifier(col):
    """An identifier's digits and letters, null where blank."""
    return F.when(~blank.is_blank(col), F.upper(F.regexp_replace(F.regexp_replace(col, r"^.*orcid\.org/", ""), r"[^0-9A-Za-z]", "")))
