"""Several values packed in one field: one row per value, with its position.

A finite-state tokenizer walks each cell once. Its states are outside, in a quoted value, after an
escape and in brackets (with depth); delimiters count only outside quotes at depth 0. The cells that
can't hold two values are settled by one regular expression in the JVM and never reach Python.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Brackets, bullets and the delimiters of one character.
OPEN, CLOSE = "([{", ")]}"
BULLETS = ("- ", "* ", "• ", "– ", "· ", "‣ ", "-\t", "•\t")
HARD = ";|\n\t\r；¦"
#: Delimiters only where white space surrounds them: `CDKN2A/B` and `R&D` are one value.
SPACED = "/&+"

# Academic degrees and suffixes that belong to the person before them.
DEGREES = frozenset("phd dphil md mph msc ms ma mba bsc ba bs dr dvm dds jr sr ii iii iv prof rn frcp facs do pharmd dsc scd mbbs mbchb psyd edd jd llm".split())
# Words that mark an organisation.
ORGANISATION = re.compile(r"\b(?:cent(?:re|er)|institut\w*|universit\w*|univ|hospital|clinic|college|school|department|dept|division|laborator\w*|lab|foundation|trust|charity|society|council|ministry|research|consortium|network|company|corporation|inc|ltd|llc|gmbh|group|biobank|repository|core|facility|program(?:me)?|agency|academy|association)\b", re.I)

# the JVM's white space and digits here are those of Python, which has the four separators besides
MAYBE = r"(?U)[;,|/&+；¦、\n\t\r]|[\s\x1c-\x1f]and[\s\x1c-\x1f]|\d[.)]|^[\s\x1c-\x1f]*[\[\"'“•*–·‣-]"
ENUMERATOR = re.compile(r"(?:(?<=^)|(?<=[\s;,|]))\(?(\d{1,3})[.)](?=\s)")


def _scan(text: str, delimiters: str, in_list: bool = False, words: bool = False) -> list[str]:
    """Raw pieces between delimiters that stand outside quotes and brackets, quotes resolved.

    in_list: single quotes delimit values too, and backslash escapes in them. words: so does the word
    `and`. A quote opens only where a value begins; one that never closes is an ordinary character.
    """
    out: list[str] = []
    buf: list[str] = []
    depth, i, n = 0, 0, len(text)
    fresh, quoted = True, False
    while i < n:
        c = text[i]
        if fresh and c in ('"', "'", "“") and (c != "'" or in_list):
            value, end = _quoted(text, i, "”" if c == "“" else c)
            if end >= 0:
                rest = end
                while rest < n and text[rest] in " \xa0":
                    rest += 1
                if rest >= n or text[rest] in delimiters or text[rest] in HARD or text[rest] in SPACED or text.startswith("and ", rest):
                    buf, quoted, fresh, i = [value], True, False, rest
                    continue
        if c in OPEN:
            depth += 1
        elif c in CLOSE:
            depth = max(0, depth - 1)
        if words and depth == 0 and c == "a" and i and text[i - 1].isspace() and text.startswith("and", i) and text[i + 3 : i + 4].isspace():
            out.append("".join(buf) if quoted else "".join(buf).strip())
            buf, fresh, quoted, i = [], True, False, i + 3
            continue
        split = depth == 0 and (c in delimiters or (c in SPACED and delimiters != "," and i and i + 1 < n and text[i - 1].isspace() and text[i + 1].isspace()))
        if split:
            out.append("".join(buf) if quoted else "".join(buf).strip())
            buf, fresh, quoted = [], True, False
        else:
            buf.append(c)
            fresh = fresh and c.isspace()
        i += 1
    if depth:  # a bracket that never closes hides no delimiter
        return _scan(text.translate({ord(x): None for x in OPEN + CLOSE}), delimiters, in_list, words) if any(x in text for x in delimiters) else [text.strip()]
    out.append("".join(buf) if quoted else "".join(buf).strip())
    return out


def _quoted(text: str, start: int, quote: str) -> tuple[str, int]:
    """The value of the quote that opens at start, and the place after its close, or -1."""
    buf, i, n = [], start + 1, len(text)
    while i < n:
        c = text[i]
        if c == "\\" and i + 1 < n:
            buf.append({"n": "\n", "t": "\t"}.get(text[i + 1], text[i + 1]))
            i += 2
        elif c == quote:
            if i + 1 < n and text[i + 1] == quote:
                buf.append(quote)
                i += 2
                continue
            return "".join(buf).strip(), i + 1
        else:
            buf.append(c)
            i += 1
    return "", -1


def _numbered(text: str) -> list[str] | None:
    """Pieces of an enumeration 1., 2., ... (or `1)`, `(1)`), or None if the cell isn't one."""
    marks, expected = [], 1
    for m in ENUMERATOR.finditer(text):
        if int(m[1]) == expected:
            if expected == 1 and text[: m.start()].strip():
                return None
            marks.append(m)
            expected += 1
    if not marks:
        return None
    ends = [m.start() for m in marks[1:]] + [len(text)]
    return [text[m.end() : e].strip().rstrip(";,|").strip() for m, e in zip(marks, ends, strict=True)]


def _unmark(piece: str) -> str:
    """Without a list mark in front and an escape or quotes around."""
    piece = piece.strip()
    for b in BULLETS:
        if piece.startswith(b):
            piece = piece[len(b) :].strip()
            break
    if len(piece) > 1 and piece[0] == piece[-1] == '"':
        value, end = _quoted(piece, 0, '"')
        if end == len(piece):
            return value
    return piece


def _degree(part: str) -> bool:
    words = [w.replace(".", "").lower() for w in part.split()]
    return bool(words) and all(w in DEGREES for w in words)


def _people(piece: str, quoted: bool = False) -> list[str]:
    """Persons of a piece without hard delimiters: commas between whole names split, those between
    surname and given name, before degrees and within an organisation don't."""
    if quoted or ORGANISATION.search(piece):
        return [piece]
    out: list[str] = []
    parts = [p for p in re.split(r"\s*,\s*(?:and\s+)?|\s+and\s+", piece) if p]
    words = [len([w for w in p.split() if w.replace(".", "").lower() not in DEGREES]) for p in parts]
    i = 0
    while i < len(parts):
        value = parts[i]
        if words[i] == 1 and i + 1 < len(parts) and not _degree(parts[i + 1]) and words[i + 1] <= 3 and (words[i + 1] == 1 or re.search(r"(?:^|\s)\w\.?(?:\s|$)", parts[i + 1]) or len(parts) == 2):
            value = f"{value}, {parts[i + 1]}"
            i += 1
        while i + 1 < len(parts) and _degree(parts[i + 1]):
            value = f"{value}, {parts[i + 1]}"
            i += 1
        out.append(value)
        i += 1
    return out


def tokenize(text: str | None, people: bool = False) -> list[str]:
    """Values of a cell in order, empty places left out.

    people: values are persons or organisations; a comma may then belong to a value. Null, empty and
    blank cells give []; a cell of one value gives that value alone.
    """
    if text is None:
        return []
    text = text.strip()
    if text[-1:] in SPACED:  # a delimiter left behind the last value
        text = text.rstrip(SPACED + " ")
    if not text:
        return []
    if text[0] == "[" and text[-1] == "]":
        inner, depth = text[1:-1], 0
        for c in inner:
            depth += (c == "[") - (c == "]")
            if depth < 0:
                break
        if depth == 0:
            return [p for p in (_unmark(x) for x in _scan(inner, ",;", in_list=True)) if p]
    numbered = _numbered(text)
    if numbered is not None:
        return [p for p in (_unmark(x) for x in numbered) if p]
    if not people:
        return [p for p in (_unmark(x) for x in _scan(text, HARD + ",", words=True)) if p]
    if re.match(r'\s*["“]', text):  # quoted values may hold commas; outside quotes they delimit
        return [p for p in (_unmark(x) for x in _scan(text, HARD + ",", words=True)) if p]
    out: list[str] = []
    for piece in _scan(text, HARD):
        piece = _unmark(piece)
        if piece:
            out.extend(p for p in _people(piece) if p)
    return out


def split_values(df: DataFrame, row_key: str, columns: dict[str, bool], least: int = 2) -> DataFrame:
    """(field_name, row_key, pos, item): a row per value of the cells with ``least`` values or more.

    columns: column -> whether it holds people. pos is an int from 1 and counts values, not empty
    places. Repeated values keep their own positions, repeated rows of the table give repeated rows
    here; null, empty and blank cells give none. No shuffle takes place.
    """
    cells = F.array(*(F.struct(F.lit(c).alias("field_name"), F.lit(p).alias("_people"), F.col(f"`{c}`").alias("_cell")) for c, p in columns.items()))

    @F.pandas_udf("array<string>")
    def values(cell: pd.Series, people: pd.Series) -> pd.Series:
        return pd.Series([tokenize(c, p) for c, p in zip(cell, people, strict=True)], dtype=object)

    rows = df.select(F.col(f"`{row_key}`").alias("row_key"), F.explode(cells).alias("_c")).select("row_key", "_c.*")
    if least > 1:
        rows = rows.where(F.col("_cell").rlike(MAYBE))
    # called non-deterministic so that filtering on its result doesn't run it a second time
    rows = rows.withColumn("_values", values.asNondeterministic()("_cell", "_people")).where(F.size("_values") >= least)
    return rows.select("field_name", "row_key", F.posexplode("_values").alias("_p", "item")).select("field_name", "row_key", (F.col("_p") + 1).alias("pos"), "item")
