"""Encoding of a corpus with a public tokenizer.

Forced-boundary splitting: two bytes that stand side by side in no token of the vocabulary can't end up
in one token, so the text may be cut between them and the fragments encoded independently. The cuts
are found by one table lookup per byte, in texts of any length; fragments are encoded in bounded batches, so
that memory and time grow in proportion to the text however long it is.
"""

from __future__ import annotations

import base64
import functools
import importlib.util
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files lie; a parameter of every function here, never copied.
VOCABULARIES = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")

# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes of a fragment at least, but for the last of a text.
LEAST = 48


def _folder(folder: str) -> str:
    if os.path.isdir(folder):
        return folder
    spec = importlib.util.find_spec("public_tokenizers")
    if spec is None or spec.origin is None:
        raise FileNotFoundError(f"no tokenizer files in {folder}")
    return os.path.dirname(spec.origin)


@functools.lru_cache(maxsize=2)
def load(name: str = "byte_bpe_50k", folder: str = VOCABULARIES):
    """(encoding, 256 x 256 table of byte pairs that stand inside some token) of a rank file."""
    import tiktoken

    with open(os.path.join(_folder(folder), f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    inside = np.zeros(65536, dtype=bool)
    for token in ranks:
        if len(token) > 1:
            b = np.frombuffer(token, np.uint8).astype(np.uint32)
            inside[b[:-1] * 256 + b[1:]] = True
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), inside


def _barred() -> tuple[np.ndarray, np.ndarray]:
    """Bytes after which, and before which, no cut may stand although the pair is in no token: the
    splitting pattern looks across white space and the apostrophe, also where it is no ASCII."""
    before, after = np.zeros(256, bool), np.zeros(256, bool)
    for b in (*range(0x09, 0x0E), *range(0x1C, 0x21)):
        before[b] = after[b] = True
    after[0x27] = True
    # the last bytes and first bytes of non-ASCII white space (U+0085, U+00A0, U+1680, U+2000.., U+3000)
    for b in (0x85, 0xA0, 0x80, *range(0x81, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F):
        before[b] = True
    for b in (0xC2, 0xE1, 0xE2, 0xE3):
        after[b] = True
    return before, after


_NO_CUT_AFTER, _NO_CUT_BEFORE = _barred()


def cuts(data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Offsets at which a UTF-8 text (as bytes) may be cut without changing its tokens."""
    if len(data) < 2:
        return np.zeros(0, np.int64)
    a, b = data[:-1].astype(np.uint32), data[1:]
    free = ~inside[a * 256 + b] & ((b & 0xC0) != 0x80) & ~_NO_CUT_AFTER[data[:-1]] & ~_NO_CUT_BEFORE[b]
    return np.flatnonzero(free) + 1


def fragments(text: str, inside: np.ndarray, least: int = LEAST) -> list[str]:
    """The text cut at forced boundaries into pieces of at least ``least`` bytes (the last may be shorter)."""
    raw = text.encode("utf-8", "surrogatepass")
    places = cuts(np.frombuffer(raw, np.uint8), inside)
    if not len(places):
        return [text]
    out, start = [], 0
    # of each run of `least` bytes only the first boundary is used
    step = places // least
    for p in places[np.r_[True, step[1:] != step[:-1]]].tolist():
        if p - start >= least:
            out.append(raw[start:p].decode("utf-8", "surrogatepass"))
            start = p
    out.append(raw[start:].decode("utf-8", "surrogatepass"))
    return out


def encode(texts: list[str | None], name: str = "byte_bpe_50k", folder: str = VOCABULARIES, batch_bytes: int = 1 << 22) -> Iterator[np.ndarray]:
    """Token ids of each text in order; [] for null and empty. Special tokens' strings are ordinary text."""
    encoding, inside = load(name, folder)
    for text in texts:
        if not text:
            yield np.zeros(0, np.int32)
            continue
        parts, batch, size = [], [], 0
        for f in fragments(text, inside):
            batch.append(f)
            size += len(f)
            if size > batch_bytes:
                parts.extend(encoding._core_bpe.encode_ordinary(x) for x in batch)
                batch, size = [], 0
        parts.extend(encoding._core_bpe.encode_ordinary(x) for x in batch)
        yield np.fromiter((i for p in parts for i in p), np.int32)


def encode_table(df: DataFrame, key: str, text: str, name: str = "byte_bpe_50k", folder: str = VOCABULARIES, counts_only: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, ids array<int>) of every row, or n_tokens in place of ids with counts_only; no shuffle.

    Null and empty texts give [] (0). Repeated keys give a row each. Whole texts are encoded; columns
    other than those named are ignored. Output batches are bounded by ids, not rows, so long texts
    can't fill memory.
    """
    names = [key, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, got, size = 0, [], 0
            for i, value in enumerate(batch.column(len(names))):
                ids = next(encode([value.as_py()], name, folder))
                got.append(len(ids) if counts_only else ids)
                size += 1 if counts_only else len(ids)
                if size > 2_000_000:
                    yield pack(batch.slice(start, len(got)), got)
                    start, got, size = i + 1, [], 0
            if got:
                yield pack(batch.slice(start, len(got)), got)

    def pack(rows: pa.RecordBatch, got: list) -> pa.RecordBatch:
        if counts_only:
            out = pa.array(got, pa.int64())
        else:
            offsets = np.zeros(len(got) + 1, np.int32)
            np.cumsum([len(g) for g in got], out=offsets[1:])
            out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(got), pa.int32()))
        return pa.RecordBatch.from_arrays([*rows.columns[: len(names)], out], [*names, "n_tokens" if counts_only else "ids"])

    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + (", n_tokens bigint" if counts_only else ", ids array<int>")
    return df.select(*(F.col(f"`{c}`") for c in names), F.col(f"`{text}`").alias("_text")).mapInArrow(run, schema)


def decode_bytes(ids: list[int], name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> str:
    """The text of token ids."""
    return load(name, folder)[0].decode_bytes(ids).decode("utf-8", "surrogatepass")
