"""Texts cut off by field limits or in transfer.

Near-copies: min-hash signatures of five-word shingles are taken at a ladder of lengths, since a cut
copy equals only the beginning of its fellow; bands of a signature are the join keys. Pairs are verified
by Jaccard similarity at that length and aligned word by word; the copy whose alignment ends while the
other goes on is cut. Records without such a fellow are scored by closing-word terminality: how often,
in all texts, the closing words ended a sentence or note rather than going on. Lengths at which a
source's texts pile up are its field limits and lower the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curatella.functions import blank, bloom, lineage, skew

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 8, 3
#: Words below which a text and its fellow must agree word by word.
SLIPLESS = 12
#: Word counts at which signatures are taken; a text looks for longer ones at the last rung that its
#: whole words reach, so that it shares at least half of its words with what is looked up.
RUNGS = tuple(1 << k for k in range(3, 24))
#: A length is a field limit of a source if so many times more texts have it than its neighbours on average.
PILE, PILE_LEAST, AROUND = 6.0, 5, 8
#: ... and if it has at least this share of the source's unfinished texts.
PILE_SHARE = 0.001

_PRIME = np.uint64((1 << 61) - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(7)
_A = _rng.integers(1, 1 << 30, BANDS * ROWS, dtype=np.uint64)
_B = _rng.integers(0, 1 << 60, BANDS * ROWS, dtype=np.uint64)

MARK = re.compile(r"(?:\s*(?:\.{2,}|…)|(?<=[^\W\d_])%[0-9a-fA-F]?|&#?\w{0,6}|\\u?[0-9a-fA-F]{0,3}|<(?:/?[a-z]{1,6})?|�)+\s*$")
FULL = re.compile(r"[.!?。！？]['\"”’)\]]*$")
TOKEN = re.compile(r"[^\s;,.()]+|[;,.()]")
NUMBER = re.compile(r"\d+(?:[.,]\d+)*")


def _may_be_marked(text: str) -> bool:
    """Whether the last signs of a text are any that a mark has; spares most texts the pattern."""
    tail = text.rstrip()[-9:]
    return ".." in tail or any(c in tail for c in "%&\\<…�")


def unmarked(text: str) -> str:
    """Without a mark of a break at the end."""
    return MARK.sub("", text) if _may_be_marked(text) else text


def bare(text: str) -> str:
    """Lower case, white space squeezed, marks of a break at the end removed."""
    return unmarked(" ".join(text.lower().split()))


def marked(text: str) -> bool:
    """Ends in dots of omission, a broken escape or an undecodable character."""
    m = MARK.search(text) if _may_be_marked(text) else None
    return bool(m and m[0].strip())


def _fold(parts: np.ndarray) -> np.ndarray:
    """One number for the values along the last axis, in their order."""
    out = np.zeros(parts.shape[:-1], np.uint64)
    for i in range(parts.shape[-1]):
        out = (out ^ parts[..., i]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def signatures(texts: list[list[str]], rungs: list[list[int]], salts: list[str], words_at_once: int = 50_000) -> list[list[int]]:
    """Band keys of min-hash signatures of the first so many words of each text, at each of its rungs (in
    order, five words or more, no more than there are). Keys of different rungs, bands and salts never meet
    but by chance. Many texts are hashed at once."""
    out: list[list[int]] = [[] for _ in texts]
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size < words_at_once):
            size += rungs[end][-1] if rungs[end] else 0
            end += 1
        _sign(texts, rungs, salts, [i for i in range(start, end) if rungs[i]], out)
        start = end
    return out


def _sign(texts: list[list[str]], rungs: list[list[int]], salts: list[str], which: list[int], out: list[list[int]]) -> None:
    if not which:
        return
    lengths = np.array([rungs[i][-1] for i in which])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for i in which for w in texts[i][: rungs[i][-1]]), np.uint64, int(starts[-1]))
    # shingles that reach into the next text are never looked at
    hashes = _fold(np.lib.stride_tricks.sliding_window_view(np.concatenate([own, np.zeros(SHINGLE, np.uint64)]), SHINGLE)) >> np.uint64(3)
    each = (hashes[None, :] * _A[:, None] + _B[:, None]) & _PRIME
    seeds = np.array([xxhash.xxh3_64_intdigest(salts[i]) for i in which], np.uint64)
    low = np.full((BANDS * ROWS, len(which)), np.iinfo(np.uint64).max, np.uint64)
    upto = np.zeros(len(which), np.int64)
    for r in sorted({r for i in which for r in rungs[i]}):
        at = np.array([k for k, i in enumerate(which) if r in rungs[i]])
        slices = np.stack([starts[at] + upto[at], starts[at] + r - SHINGLE + 1], axis=1).ravel()
        low[:, at] = np.minimum(low[:, at], np.minimum.reduceat(each, slices, axis=1)[:, ::2])
        upto[at] = r - SHINGLE + 1
        place = seeds[at, None] + np.uint64(r) * np.uint64(1 << 20) + np.arange(BANDS, dtype=np.uint64)[None, :]
        keys = _fold(np.concatenate([low[:, at].T.reshape(len(at), BANDS, ROWS), place[:, :, None]], axis=2)) >> np.uint64(1)
        for k, own_keys in zip(at.tolist(), keys.astype(np.int64).tolist(), strict=True):
            out[which[k]].extend(own_keys)


def beginnings(words: list[str], salt: str, upto: int) -> list[int]:
    """Keys of the beginnings of a text that may end at its 1st, ..., ``upto``-th word: the words before it
    and its first one or two letters."""
    out, before = [], salt
    for i, w in enumerate(words[:upto]):
        out.append(xxhash.xxh3_64_intdigest(f"{before}\x01{w[:1]}", i) >> 1)
        if len(w) > 1:
            out.append(xxhash.xxh3_64_intdigest(f"{before}\x01{w[:2]}", i) >> 1)
        before = f"{before}\x00{w}"
    return out


def seek(texts: list[list[str]], salts: list[str]) -> list[list[int]]:
    """Keys by which each text finds those that go on where it ends. From SLIPLESS words on, the bands of
    the last rung that its whole words reach; below, where neither alignment nor similarity allows a slip,
    its beginning up to its last word."""
    rungs = [[max(r for r in RUNGS if r < len(words))] if len(words) >= SLIPLESS else [] for words in texts]
    return [keys if own else beginnings(words, salt, len(words))[-1:] for words, salt, own, keys in zip(texts, salts, rungs, signatures(texts, rungs, salts), strict=True)]


def offer(texts: list[list[str]], salts: list[str]) -> list[list[int]]:
    """Keys under which each text is found."""
    signed = signatures(texts, [[r for r in RUNGS if r <= len(words)] for words in texts], salts)
    return [beginnings(words, salt, SLIPLESS - 1) + keys for words, salt, keys in zip(texts, salts, signed, strict=True)]


def similar(a: list[str], b: list[str]) -> bool:
    """Jaccard similarity of the five-word shingles at the length of a rung; shorter texts must be equal."""
    if len(a) < SHINGLE or len(b) < SHINGLE:
        return a == b
    x = {tuple(a[i : i + SHINGLE]) for i in range(len(a) - SHINGLE + 1)}
    y = {tuple(b[i : i + SHINGLE]) for i in range(len(b) - SHINGLE + 1)}
    return len(x & y) >= SIMILARITY * len(x | y)


def ends_early(a: str, b: str) -> int:
    """Aligns two bare texts from their beginnings: 2 if b goes on within a's last word, 1 if b goes on
    after it, 0 if a doesn't end first. Single words may differ, be lacking or be put in."""
    x, y = a.split(), b.split()
    if not x:
        return 0
    i = j = slips = 0
    most = len(x) // SLIPLESS
    while i < len(x) - 1:
        if j < len(y) and x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        slips += 1
        if slips > most or j >= len(y):
            return 0
        if i + 1 < len(x) and j + 1 < len(y) and x[i + 1] == y[j + 1]:
            i, j = i + 1, j + 1
        elif j + 1 < len(y) and x[i] == y[j + 1]:
            j += 1
        elif i + 1 < len(x) and x[i + 1] == y[j]:
            i += 1
        else:
            return 0
    if j >= len(y):
        return 0
    last, fellow = x[-1], y[j]
    if last == fellow:
        return 1 if j + 1 < len(y) else 0
    return 2 if fellow.startswith(last) and len(fellow) > len(last) and (len(fellow) - len(last) > 1 or fellow[-1] not in ".,;:!?)") else (1 if fellow[: len(last)] == last and j + 1 < len(y) else 0)


def tokens(text: str) -> list[str]:
    """Words and marks in lower case, numbers as 0; words that hold a digit keep their shape only."""
    out = []
    for t in TOKEN.findall(NUMBER.sub("0", text.lower())):
        out.append("#" if "0" in t and len(t) > 3 and any(c.isalpha() for c in t) else t)
    return out


def kind_of(parts: list[str]) -> str:
    """`n` for notes (items between semicolons), `s` for sentences, `` if a single piece doesn't tell."""
    if ";" in parts:
        return "n"
    return "s" if "." in parts[:-1] else ""


def pieces(text: str) -> list[str]:
    """What a text shows: its pieces that are followed by another or by their full stop, as kind and words."""
    parts = tokens(text)
    kind, start, out = kind_of(parts), 0, []
    for i, t in enumerate(parts):
        if t in (";", "."):
            if i > start:
                out.append(f"{kind or ('s' if t == '.' else 'n')} {' '.join(parts[start:i])}")
            start = i + 1
    return out


def statistics(df: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(key, yes, no) of the wanted keys over all texts: for closing words how often they ended (yes) or
    went on (no) inside complete pieces, for openings (`o|`) how often of sentences (yes) or notes (no).

    Equal pieces are counted first, batch by batch and before the shuffle; the words of each distinct piece
    then count as often as it occurs, and only wanted keys, as a Bloom filter knows them, are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts.update(pieces(value))
            if len(counts) > 200_000:
                yield flush(counts)
        if counts:
            yield flush(counts)

    def flush(counts: Counter) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["piece", "n"])
        counts.clear()
        return out

    each = df.select(text).mapInArrow(count, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    words, kind = F.split(F.substring("piece", 3, 1 << 30), " "), F.substring("piece", 1, 1)
    runs = lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(4), i)), lambda m: F.struct(F.concat_ws("|", "_kind", m, F.array_join(F.slice("_w", i - m + 1, m), " ")).alias("key"), (i == F.size("_w")).alias("yes")))
    closing = F.flatten(F.transform(F.sequence(F.lit(1), F.size("_w")), runs))
    opening = F.transform(F.filter(F.array(F.lit(1), F.lit(2)), lambda m: m <= F.size("_w")), lambda m: F.struct(F.concat(F.lit("o|"), F.array_join(F.slice("_w", 1, m), " ")).alias("key"), (F.col("_kind") == "s").alias("yes")))
    shown = each.select("n", words.alias("_w"), kind.alias("_kind")).select("n", F.inline(F.concat(closing, opening)))
    shown = bloom.sift(shown, ["key"], wanted, ["key"]).where("_maybe")
    return shown.groupBy("key").agg(F.sum(F.when(F.col("yes"), F.col("n")).otherwise(0)).alias("yes"), F.sum(F.when(F.col("yes"), 0).otherwise(F.col("n"))).alias("no")).join(wanted, "key", "left_semi")


def field_limits(df: DataFrame, text: str, source: str) -> DataFrame:
    """(_src, measure, limit): lengths, in characters or UTF-8 bytes, at which a source's texts pile up.

    A length piles up if it has PILE times the average of the AROUND lengths on each side or more, those
    of no text counted as 0, and at least PILE_LEAST texts and PILE_SHARE of the source's. Texts that end alike count once, so that a
    phrase sent again and again is no pile; texts with a full stop don't count.
    """
    sizes = F.array(F.struct(F.lit("chars").alias("measure"), F.length(text).alias("n")), F.struct(F.lit("bytes").alias("measure"), F.octet_length(text).alias("n")))
    ends = df.where(~F.rtrim(text).rlike(r"[.!?]$")).select(F.coalesce(F.col(source), F.lit("")).alias("_src"), F.explode(sizes).alias("_s"), F.lower(F.expr(f"right({text}, 16)")).alias("_end"))
    counts = ends.select("_src", "_s.measure", "_s.n", "_end").distinct().groupBy("_src", "measure", "n").agg(F.count(F.lit(1)).alias("c"))
    near = Window.partitionBy("_src", "measure").orderBy("n").rangeBetween(-AROUND, AROUND)
    around = (F.sum("c").over(near) - F.col("c")) / (2 * AROUND)
    whole = F.sum("c").over(Window.partitionBy("_src", "measure"))
    enough = (F.col("c") >= PILE_LEAST) & (F.col("c") >= PILE_SHARE * F.col("_whole")) & (F.col("c") >= PILE * F.col("_around"))
    return counts.withColumn("_around", around).withColumn("_whole", whole).where(enough).select("_src", "measure", F.col("n").alias("limit"))


def cut_copies(rows: DataFrame, seeking: DataFrame) -> DataFrame:
    """(nid, how) of texts that end before a near-copy of the same ``within`` does; how is ends_early's
    answer, the largest.

    rows: (nid, within, text), nid a digest of the other two; seeking: (nid, seek), the keys by which texts
    that may be cut look for others. Only ids and keys are shuffled; the texts of candidate pairs are
    fetched by id, behind a Bloom filter. Copies of one text are one node. Keys of many texts are salted.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = offer([bare(text).split() for text in batch.column(2).to_pylist()], batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], ["nid", "offer"])

    rows = rows.where(F.col("within").isNotNull()).select("nid", "within", "text")
    wanted = lineage.cut(seeking.select(F.col("nid").alias("a"), F.explode("seek").alias("h")).distinct())
    n = wanted.count()
    found = rows.mapInArrow(sign, "nid binary, offer array<bigint>").select(F.col("nid").alias("b"), F.explode("offer").alias("h"))
    found = bloom.sift(found, ["h"], wanted, ["h"], n).where("_maybe").select("b", "h").distinct()
    pairs = lineage.cut(skew.salted_join(wanted, found, ["h"], "inner", n).where(F.col("a") != F.col("b")).select("a", "b").distinct())
    m = pairs.count()
    ids = pairs.select(F.explode(F.array("a", "b")).alias("nid"))
    texts = bloom.sift(rows.select("nid", "text"), ["nid"], ids, ["nid"], 2 * m).where("_maybe").select("nid", "text").distinct()
    side = lambda c: texts.select(F.col("nid").alias(c), F.col("text").alias(f"t{c}"))
    pairs = skew.salted_join(pairs, side("b"), ["b"], "inner", m)
    pairs = skew.salted_join(pairs, side("a"), ["a"], "inner", m)

    @F.pandas_udf("int")
    def how(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a.map(bare), b.map(bare), strict=True):
            if len(y) <= len(x):
                out.append(0)
                continue
            p, q = x.split(), y.split()
            r = max((r for r in RUNGS if r < len(p)), default=0) if len(p) >= SLIPLESS else 0
            out.append(ends_early(x, y) if len(p) > 1 and (not r or similar(p[:r], q[:r])) else 0)
        return pd.Series(out, dtype="int32")

    # called non-deterministic so that filtering on its result doesn't run it a second time
    return pairs.withColumn("how", how.asNondeterministic()("ta", "tb")).where("how > 0").groupBy(F.col("a").alias("nid")).agg(F.max("how").alias("how"))


ASKED = "key {key}, source string, nid binary, chars int, bytes int, kind string, full boolean, mark boolean, tail string, seek array<bigint>"


def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ASKED of (key, source, nid, chars, bytes, within, text): how a text ends, and whether it looks for
    others. Texts that end in a full stop look only where it follows a digit, as one may have been cut within
    a number."""
    for batch in batches:
        kinds, full, mark, tails, words = [], [], [], [], []
        for within, value in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True):
            stripped = value.strip()
            parts = tokens(unmarked(stripped))
            own = kind_of(parts)
            cut = marked(stripped)
            done = bool(FULL.search(stripped)) and not cut
            while parts and parts[-1] == "." and done:
                parts.pop()
            last = max((i for i, t in enumerate(parts) if t in (";", ".")), default=-1)
            piece = parts[last + 1 :]
            kinds.append(own)
            full.append(done)
            mark.append(cut or (not piece and not done))
            tails.append(" ".join(piece))
            plain = bare(value)
            words.append(plain.split() if within is not None and (not FULL.search(plain) or plain[-2:-1].isdigit()) else [])
        keys = [k if len(w) > 1 else [] for k, w in zip(seek(words, [w or "" for w in batch.column(5).to_pylist()]), words, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(kinds, pa.string()), pa.array(full, pa.bool_()), pa.array(mark, pa.bool_()), pa.array(tails, pa.string()), pa.array(keys, pa.list_(pa.int64()))], ["key", "source", "nid", "chars", "bytes", "kind", "full", "mark", "tail", "seek"])


def judge(df: DataFrame, key: str, text: str, source: str, within: str, certain: float = 0.15) -> DataFrame:
    """(key, source, is_cut, why, terminality) of every record whose text isn't blank.

    why: `copy` (a near-copy goes on), `mark` (dots of omission, broken escape), `limit` (as long as its
    source allows, without a full stop), `sentence` (sentences without a full stop), `closing` (closing
    words that hardly ever end a note); null for whole texts. Texts that end in a full stop are whole
    unless a copy goes on within the word, or their closing words never end a sentence. terminality is
    the share of endings among the occurrences of the longest closing words seen in complete pieces; null
    where none was seen. Sources and ``within`` may be null. Every row gets a row, repeated ones and those of
    repeated keys too; equal texts are judged alike.
    """
    c = lambda name: F.col(f"`{name}`")
    rows = df.where(~blank.is_blank(c(text))).select(c(key).alias("key"), c(source).alias("source"), c(within).cast("string").alias("within"), c(text).alias("text"))
    rows = rows.withColumn("nid", F.unhex(F.md5(F.concat_ws("\x00", F.coalesce("within", F.lit("\x01")), "text"))))
    kind_type = dict(rows.dtypes)["key"]
    asked = lineage.cut(rows.select("key", "source", "nid", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), "within", "text").mapInArrow(ask, ASKED.format(key=kind_type)))
    # what is asked is the same for equal tails
    tails = asked.select("kind", "tail").distinct()
    w = F.split("tail", " ")
    kinds = F.when(F.col("kind") == "", F.array(F.lit("n"), F.lit("s"))).otherwise(F.array("kind"))
    questions = F.concat(
        F.transform(F.array(F.lit(2), F.lit(1)), lambda m: F.concat(F.lit("o|"), F.array_join(F.slice(w, 1, m), " "))),
        F.flatten(F.transform(kinds, lambda k: F.transform(F.filter(F.array(*(F.lit(m) for m in (4, 3, 2, 1))), lambda m: m <= F.size(w)), lambda m: F.concat_ws("|", k, m, F.array_join(F.slice(w, F.size(w) - m + 1, m), " "))))),
    )
    put = lineage.cut(tails.select("kind", "tail", F.posexplode(F.when(F.col("tail") != "", questions)).alias("_p", "key")))
    known = statistics(rows, "text", put.select("key").distinct())
    # a common closing word is asked for by many tails
    answers = skew.salted_join(put, known, ["key"], "inner", put.count()).groupBy("kind", "tail").agg(F.sort_array(F.collect_list(F.struct("_p", F.col("key").alias("_q"), "yes", "no"))).alias("seen"))
    opening = F.get(F.filter("seen", lambda x: x["_q"].startswith("o|")), F.lit(0))
    own = F.when(F.col("kind") != "", F.col("kind")).otherwise(F.when(F.coalesce(opening["yes"] > opening["no"], F.lit(False)), F.lit("s")).otherwise(F.lit("n")))
    answers = answers.withColumn("kind2", own)
    closing = F.get(F.filter("seen", lambda x: x["_q"].startswith(F.concat("kind2", F.lit("|"))) & (x["yes"] + x["no"] > 1)), F.lit(0))
    answers = answers.withColumn("_c", closing).select("kind", "tail", "kind2", "_c.yes", (F.col("_c.yes") + F.col("_c.no")).alias("_seen"), F.coalesce(F.split("_c._q", r"\|")[1].cast("int"), F.lit(0)).alias("_deep"))
    n = asked.count()
    told = skew.salted_join(asked.drop("seek"), answers, ["kind", "tail"], "left", n)
    told = told.withColumn("kind2", F.coalesce("kind2", F.when(F.col("kind") != "", F.col("kind")).otherwise(F.lit("n")))).withColumn("terminality", F.col("yes") / F.col("_seen"))
    limits = lineage.cut(field_limits(rows, "text", "source"))
    at = lambda m: limits.where(F.col("measure") == m).select("_src", F.col("limit").alias(m), F.lit(True).alias(f"_l{m}"))
    told = told.withColumn("_src", F.coalesce("source", F.lit(""))).join(at("chars"), ["_src", "chars"], "left").join(at("bytes"), ["_src", "bytes"], "left")
    copies = cut_copies(rows, asked.where(F.size("seek") > 0).select("nid", "seek"))
    # copies of one text may be a third of all rows
    every = skew.salted_join(told, copies, ["nid"], "left", n, hot=lineage.cut(skew.hot_keys(asked, ["nid"], n)))
    low = F.coalesce(F.col("terminality"), F.lit(0.0))
    never = (F.col("yes") == 0) & (F.col("_seen") >= 3) & (F.coalesce("_deep", F.lit(0)) >= 2)
    why = (
        F.when(F.col("full"), F.when(F.coalesce(F.col("how"), F.lit(0)) == 2, F.lit("copy")).when(never, F.lit("closing")))
        .when(F.col("how") > 0, F.lit("copy"))
        .when(F.col("mark"), F.lit("mark"))
        .when(F.col("_lchars").isNotNull() | F.col("_lbytes").isNotNull(), F.lit("limit"))
        .when(F.col("kind2") == "s", F.lit("sentence"))
        .when(low < certain, F.lit("closing"))
    )
    return every.select("key", "source", why.isNotNull().alias("is_cut"), why.alias("why"), "terminality")
