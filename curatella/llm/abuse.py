"""Abusive, hateful or sexual passages, by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary passages of labelled documents. A
window of a few words that compresses better with the toxic one, by more than a calibrated margin a byte,
marks the document. Texts are folded first (look-alike letters, digits typed for letters, letters spaced out
or drawn out), so that a disguised word compresses like the plain one. No word list is part of the model: it
knows what the labels show. Fitting uses a bounded sample of labelled passages, the calibration folds side by
side in the executors; scoring reads every document whole and moves nothing but ids and scores.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatella.functions import lineage

#: Labelled documents of each class that fitting reads at most, those of the smallest hashed ids, and
#: pieces of all of them together, again those of the smallest hashes; scoring has no such bound.
MOST_TOXIC, MOST_ORDINARY, MOST_PIECES = 4_000, 8_000, 300_000
#: Characters of a piece at most; longer ones are cut between words.
LONGEST = 4_000
#: Bytes of a dictionary at most, and bytes of samples for each byte of it.
DICTIONARY, SAMPLES = 220_000, 2
WORDS, STEP, LEVEL = 8, 4, 3
#: F1 values that differ by less are held to be equal.
NEARLY = 0.005
FOLDS = 4

# Signs typed for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "+": "t"})
# Letters of other scripts that look like Latin ones.
ALIKE = str.maketrans({"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ո": "n", "ս": "u", "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x"})
INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿️]")
CUT = re.compile(r"(?<=[.!?;:])\s+|[。！？\n\r]+|(?<=[.!?])(?=[A-Z])")

def fold(text: str) -> str:
    """Lower case Latin letters as far as the text has them, white space squeezed, numbers as 0."""
    if text.isascii():
        text = text.lower()
    else:
        text = INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower().translate(ALIKE).replace("’", "'")
        text = "".join(c for c in unicodedata.normalize("NFD", text) if not ("̀" <= c <= "ͯ"))
    words = [_word(w) for w in text.split()]
    return " ".join(_joined(words) if sum(len(w) == 1 for w in words) > 2 else filter(None, words))


@functools.lru_cache(maxsize=200_000)
def _word(w: str) -> str:
    core = w.strip(".,;:!?\"'()[]{}…*_~")
    if core and not core.isalpha():
        letters = sum(c.isalpha() for c in core)
        if letters and _spelled(core):
            w = re.sub(r"[^\w$@!]|_", "", core).translate(LEET)
        elif letters and any(c in "013457$@!|€8" for c in core) and _disguised(core):
            w = core.translate(LEET)
        elif letters and any(c.isdigit() for c in core):
            w = "#"
        elif not letters:
            w = "0" if any(c.isdigit() for c in core) else w
        elif "*" in core:
            w = re.sub(r"\*+", "*", core)
    return re.sub(r"(\w)\1{2,}", r"\1", w)


def _spelled(core: str) -> bool:
    """Letters one by one with a mark between each: `i-d-i-o-t`, `i.d.i.o.t`."""
    parts = re.split(r"[-._*/~+]", core)
    return len(parts) > 2 and all(len(p) == 1 for p in parts if p) and sum(len(p) for p in parts) > 2


def _disguised(core: str) -> bool:
    """Digits or signs stand between letters as if they were letters, in no code or measure."""
    if core.isupper() or "-" in core or "/" in core or re.search(r"\d{2,}", core) and not re.search(r"[$@!]", core):
        return False
    return bool(re.fullmatch(r"[a-z013457$@!|€8*]+", core)) and sum(c.isalpha() for c in core) >= 2 and not re.fullmatch(r"[a-z]{1,3}\d+[a-z]?|\d+[a-z]+", core) or bool(re.fullmatch(r"\d?[a-z]+\d[a-z]+[a-z013457$@!]*", core) and len(core) > 4)


def _joined(words: list[str]) -> list[str]:
    """Runs of three or more single letters become one word."""
    out: list[str] = []
    run: list[str] = []
    for w in [*words, ""]:
        if len(w) == 1 and w.isalpha() and w.isascii():
            run.append(w)
            continue
        out.extend(["".join(run)] if len(run) > 2 else run)
        run = []
        if w:
            out.append(w)
    return out


def pieces(text: str) -> list[str]:
    """Folded sentences and lines of a text, cut where they are longer than LONGEST; together they cover it."""
    return [x for f in (fold(p) for p in CUT.split(text)) if f for x in (_cut(f) if len(f) > LONGEST else (f,))]


def _cut(piece: str) -> Iterator[str]:
    """Runs of words of at most LONGEST characters, a longer word by characters."""
    start = 0
    while start < len(piece):
        end = start + LONGEST
        if end < len(piece):
            end = max(piece.rfind(" ", start, end), start) or end
            end = end if end > start else start + LONGEST
        if piece[start:end].strip():
            yield piece[start:end].strip()
        start = end


def parts(piece: str) -> list[str]:
    """Windows of a piece: itself, or overlapping runs of WORDS words where it has more. Scripts without
    spaces are parted by characters."""
    words = piece.split(" ")
    if len(words) > WORDS:
        return [" ".join(words[i : i + WORDS]) for i in range(0, len(words) - WORDS + STEP, STEP)]
    if len(words) < 4 and len(piece) > 60:
        return [piece[i : i + 40] for i in range(0, len(piece), 20)]
    return [piece]


def windows(text: str) -> list[str]:
    """Distinct windows of a whole text in order."""
    return list(dict.fromkeys(w for p in pieces(text) for w in parts(p)))


@dataclass(frozen=True)
class Model:
    """What scoring needs, some 450 KB at most: two dictionaries and the margin. Empty dictionaries (no
    labels of both classes) mark nothing."""

    toxic: bytes
    ordinary: bytes
    margin: float

    def scorer(self) -> Scorer:
        return Scorer(self)

    def save(self, spark: SparkSession, path: str) -> None:
        """Keeps the model of a snapshot of the labels for later runs."""
        spark.createDataFrame([(bytearray(self.toxic), bytearray(self.ordinary), self.margin)], "toxic binary, ordinary binary, margin double").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        row = spark.read.parquet(path).first()
        return Model(bytes(row["toxic"]), bytes(row["ordinary"]), row["margin"])


class Scorer:
    """Scores windows: bytes that the toxic dictionary saves over the ordinary one, a byte of the window."""

    def __init__(self, model: Model) -> None:
        self.margin = model.margin
        self.sides = []
        for content in (model.toxic, model.ordinary):
            d = zstandard.ZstdCompressionDict(content) if content else None
            params = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False, min_match=3, window_log=18, hash_log=15, chain_log=16)
            if d is not None:
                d.precompute_compress(compression_params=params)
            self.sides.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params) if d is not None else zstandard.ZstdCompressor(compression_params=params))
        self.blind = not model.toxic or not model.ordinary
        self.memo: dict[str, float] = {}

    def window(self, text: str) -> float:
        got = self.memo.get(text)
        if got is None:
            raw = text.encode("utf-8", "replace")
            a, b = (len(c.compress(raw)) for c in self.sides)
            got = (b - a) / (len(raw) + 8)
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[text] = got
        return got

    def cost(self, text: str) -> float:
        """Bytes that the ordinary dictionary leaves, a byte of the window."""
        raw = text.encode("utf-8", "replace")
        return len(self.sides[1].compress(raw)) / (len(raw) + 8)

    def document(self, text: str) -> float:
        return -1.0 if self.blind else max((self.window(w) for w in windows(text)), default=-1.0)


def _dictionary(passages: list[str]) -> bytes:
    """A dictionary trained on all passages, a byte for SAMPLES bytes of them. zstandard trains on no fewer
    than a handful of samples: those few are given to it again and again until it does."""
    samples = [(p + "\n").encode("utf-8", "replace") for p in passages]
    size = min(DICTIONARY, max(256, sum(map(len, samples)) // SAMPLES))
    for often in (1, 8, 64, 512):
        try:
            return zstandard.train_dictionary(size, samples * often).as_bytes() if samples else b""
        except zstandard.ZstdError:
            continue
    return b""


def _runs(piece: str) -> list[str]:
    """Pairs of neighbouring words; a lone word is one."""
    words = piece.split(" ")
    return [" ".join(words[i : i + 2]) for i in range(max(1, len(words) - 1))]


def _trim(window: str, runs: set[str]) -> str:
    """Without the words at either end whose pairs stand in ordinary documents."""
    words = window.split(" ")
    lo, hi = 0, len(words)
    while hi - lo > 2 and f"{words[lo]} {words[lo + 1]}" in runs:
        lo += 1
    while hi - lo > 2 and f"{words[hi - 2]} {words[hi - 1]}" in runs:
        hi -= 1
    return " ".join(words[lo:hi])


def train(toxic: list[list[str]], ordinary: list[list[str]]) -> tuple[bytes, bytes]:
    """Dictionaries of documents given as pieces; both empty without documents of both classes.

    Words of few ordinary documents (names, codes) don't count in a piece's shape; of the pieces and windows
    of one shape the ordinary dictionary is trained on the first. A toxic document is mostly ordinary: its
    toxic windows are those of no ordinary shape, most of whose pairs of words stand in no ordinary document,
    and that a dictionary of half of the ordinary documents explains worse than nearly all windows of the
    other half; a document with any such window has one at least. Of a window the ordinary words at either
    end are cut off.
    """
    if not toxic or not ordinary:
        return b"", b""
    seen = Counter(w for doc in ordinary for w in {w for p in doc for w in p.split(" ")})
    rare = max(2, len(ordinary) // 300)
    shape = lambda p: " ".join(w if seen[w] > rare else "~" for w in p.split(" "))

    def shapes(docs: list[list[str]]) -> dict[str, str]:
        out: dict[str, str] = {}
        for doc in docs:
            for p in doc:
                for x in dict.fromkeys((p, *parts(p))):
                    out.setdefault(shape(x), x)
        return out

    known = shapes(ordinary)
    probe = Scorer(Model(b"", _dictionary(list(shapes(ordinary[::2]).values())), 0.0))
    usual = sorted(probe.cost(w) for doc in ordinary[1::2] for p in doc for w in parts(p)) or [0.0]
    bar = usual[int(0.95 * (len(usual) - 1))]
    runs = {g for doc in ordinary for p in doc for g in _runs(p)}
    strange = lambda w: 2 * sum(g not in runs for g in _runs(w)) > len(_runs(w))
    picked: list[str] = []
    for doc in toxic:
        own = sorted(((probe.cost(w), w) for p in doc if shape(p) not in known for w in parts(p) if shape(w) not in known and strange(w)), reverse=True)
        picked += [_trim(w, runs) for w in ([w for c, w in own if c >= bar] or [w for _, w in own[:1]])]
    return _dictionary(picked), _dictionary(list(known.values()))


def fold_of(docs: list[tuple[list[str], int]], k: int, folds: int = FOLDS) -> tuple[bytes, bytes, list[tuple[float, int]]]:
    """Dictionaries without the k-th part of the documents of either class, and that part's scores and
    labels; k = folds: of all documents, without scores."""
    sides = [[d for d, y in docs if y == label] for label in (1, 0)]
    if k == folds:
        return *train(*sides), []
    if min(map(len, sides)) < folds:
        return b"", b"", []
    toxic, ordinary = ([d for i, d in enumerate(own) if i % folds != k] for own in sides)
    pair = train(toxic, ordinary)
    s = Scorer(Model(*pair, 0.0))
    return *pair, [(max((s.window(w) for p in d for w in parts(p)), default=-1.0), y) for own, y in zip(sides, (1, 0), strict=True) for i, d in enumerate(own) if i % folds == k]


def margin(scored: list[tuple[float, int]], otherwise: float = 0.0) -> float:
    """The middle of the margins whose F1 is at most NEARLY below the best."""
    total = sum(y for _, y in scored)
    if not total or total == len(scored):
        return otherwise
    scored = sorted(scored, reverse=True)
    good, tried = 0, []
    for i, (score_, y) in enumerate(scored):
        good += y
        below = scored[i + 1][0] if i + 1 < len(scored) else score_ - 0.05
        if below < score_:
            tried.append((2 * good / (i + 1 + total), (score_ + below) / 2))
    best = max(f1 for f1, _ in tried)
    fine = [m for f1, m in tried if f1 >= best - NEARLY]
    return (min(fine) + max(fine)) / 2


def fit(labelled: list[tuple[str, int]], folds: int = FOLDS) -> Model:
    """A model of labelled texts (text, 1 or 0), here and now. The margin is calibrated on documents that
    the dictionaries they are scored with have not seen; 0 if there are fewer than ``folds`` of a class."""
    docs = [(pieces(t), y) for t, y in labelled if t]
    scored = [x for k in range(folds) for x in fold_of(docs, k, folds)[2]]
    return Model(*fold_of(docs, folds, folds)[:2], margin(scored))


def sample(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(doc, y, piece): the distinct pieces of the labelled documents that fitting reads, within the bounds
    above; whole texts are cut into pieces where they lie.

    Rows without text or label are left out; of a key labelled twice the larger label holds.
    """
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).alias("_y"))
    few = None
    for y, most in ((1, MOST_TOXIC), (0, MOST_ORDINARY)):
        own = marks.where((F.col("_y") > 0) == F.lit(y == 1)).orderBy(F.xxhash64(key), key).limit(most)
        few = own if few is None else few.unionByName(own)
    cut = F.pandas_udf(lambda t: t.map(lambda x: list(dict.fromkeys(pieces(x)))), "array<string>").asNondeterministic()
    rows = documents.select(key, text).where(F.col(text).isNotNull()).join(F.broadcast(few), key)
    each = rows.select(F.xxhash64(key).alias("doc"), (F.col("_y") > 0).cast("int").alias("y"), F.explode(cut(text)).alias("piece"))
    return each.orderBy(F.xxhash64("doc", "piece"), "doc", "piece").limit(MOST_PIECES)


def fit_table(sampled: DataFrame, folds: int = FOLDS) -> Model:
    """fit over ``sample``'s pieces: each fold is trained and scored in a task of its own, whose input the
    sample's bounds limit; the driver gets scores and the two dictionaries of all."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["k"].iloc[0])
        by: dict[tuple[int, int], list[str]] = {}
        for doc, y, piece in sorted(zip(pdf["doc"], pdf["y"], pdf["piece"], strict=True)):
            by.setdefault((doc, y), []).append(piece)
        a, b, scored = fold_of([(own, y) for (_, y), own in by.items()], k, folds)
        return pd.DataFrame({"k": [k], "toxic": [a if k == folds else b""], "ordinary": [b if k == folds else b""], "scores": [[s for s, _ in scored]], "labels": [[y for _, y in scored]]})

    spread = lineage.cut(sampled).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(folds)))).repartition(folds + 1, "k")
    rows = spread.groupBy("k").applyInPandas(one, "k int, toxic binary, ordinary binary, scores array<double>, labels array<int>").collect()
    full = next((r for r in rows if r["k"] == folds), None)
    scored = [x for r in sorted(rows) for x in zip(r["scores"], r["labels"], strict=True)]
    return Model(bytes(full["toxic"]), bytes(full["ordinary"]), margin(scored)) if full else Model(b"", b"", 0.0)


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, score, is_toxic) of every document; no shuffle.

    Null and empty texts score -1 and aren't toxic; without a model all texts do. Repeated keys are scored each; other columns are
    ignored. The score is the largest over the windows of the whole text.
    """
    names = [key, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            got = [scorer.document(t) if t else -1.0 for t in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(got, pa.float64()), pa.array([g > model.margin and not scorer.blind for g in got], pa.bool_())], [*names, "score", "is_toxic"])

    kinds = dict(documents.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", score double, is_toxic boolean"
    return documents.select(*(F.col(f"`{c}`") for c in names), F.col(f"`{text}`").alias("_text")).mapInArrow(run, schema)
