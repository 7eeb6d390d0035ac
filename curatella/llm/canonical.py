"""Mapping freely typed values to the entries of a reference list.

A multi-pattern automaton over canonical names and aliases finds embedded mentions; of overlapping
mentions the longest wins. What it leaves goes to token-set similarity: a value is an entry if every
word of the entry has a word of its own in the value (equal, abbreviated or misspelt) and nothing but
filling words is left over. The lists are settings of checked size; values stream past them, so no
shuffle and no pairing of rows takes place.
"""

from __future__ import annotations

import functools
import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of a reference list at most; the automaton goes to every executor.
MOST_ENTRIES = 50_000
#: Decided values that a worker remembers.
MEMO = 100_000
UNMATCHED = "UNMATCHED"

# Words without weight, and words around a name that say nothing about which it is.
STOP = frozenset("a an and at by de del der des die du et for from fur für in la le of on the to und with y".split())
FILL = frozenset(
    "suppl supplement supp print online internet electronic epub issn vol volume no nr num number issue part series ed edition "
    "award awards grant grants contract project programme program funded funding support supported sponsor sponsored under via ref id".split()
)
TAILS = re.compile(r"\s+[:–—]\s+.*$|\s+-\s+[a-z][a-z ]{12,}$")
BRACKETS = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}")
# Contractions that are no beginnings of the word.
CONTRACTIONS = {"fdn": "foundation", "fndn": "foundation", "found": "foundation", "intl": "international", "natl": "national", "govt": "government", "dept": "department", "qtrly": "quarterly", "qtly": "quarterly", "jnl": "journal", "jrnl": "journal", "mtg": "meeting", "assn": "association", "assoc": "association", "bros": "brothers", "ctr": "centre", "cncl": "council", "mgmt": "management", "rsch": "research", "trst": "trust", "chty": "charity"}
# Letters of other scripts and signs that are typed for Latin letters.
FOLD = str.maketrans({"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "ı": "i", "&": " and ", "+": " and ", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "к": "k", "м": "m", "н": "h", "т": "t", "в": "b"})


def fold(text: str) -> str:
    """Lower case without accents; letters of look-alike scripts become Latin."""
    text = unicodedata.normalize("NFKD", html.unescape(text).lower().translate(FOLD))
    return "".join(c for c in text if not unicodedata.combining(c))


def words(text: str) -> list[str]:
    """Words of a folded text; letters with dots between (`k.f.g.m.`) are one word."""
    text = re.sub(r"(?<![^\W_])((?:[^\W\d_]\.){2,}[^\W\d_]?)(?![^\W_])", lambda m: m[1].replace(".", "") + " ", text)
    return re.findall(r"[^\W_]+", text.replace("'s ", " ").replace("’s ", " "))


def near(a: str, b: str, most: int) -> int:
    """Edits between two words, transpositions of neighbours as one; most + 1 if more than most."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], before[j - 2] + 1)
        if min(row) > most:
            return most + 1
        before = last
    return row[-1]


def likeness(typed: str, word: str) -> float:
    """How well a typed word stands for a word of an entry: 1 equal, 0 not at all."""
    if typed == word:
        return 1.0
    if word.startswith(typed):
        return 0.9 if len(typed) > 2 else 0.8
    if CONTRACTIONS.get(typed) == word:
        return 0.9
    n = len(word)
    most = 0 if n < 4 else 1 if n < 6 else 2 if n < 12 else 3
    if most and len(typed) > 2 and abs(len(typed) - n) <= most:
        d = near(typed, word, most)
        if d <= most:
            return 0.95 - 0.1 * d
    if 3 <= len(typed) <= 6 and typed[0] == word[0] and n > 4 and _within(typed, word):
        return 0.6
    if 3 <= len(typed) < n and typed[0] == word[0] and near(typed, word[: len(typed)], 1) <= 1:
        return 0.55
    return 0.0


def _within(typed: str, word: str) -> bool:
    letters = iter(word)
    return all(c in letters for c in typed)


@dataclass
class Matcher:
    """A reference list, ready to look values up: entries (id, name, alias or None)."""

    entries: list[tuple[str, str, str | None]]
    memo: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        import ahocorasick

        if len(self.entries) > MOST_ENTRIES:
            raise ValueError(f"more than {MOST_ENTRIES} entries")
        entries = sorted({e for e in self.entries if e[0] is not None and e[1]}, key=lambda e: (e[0], e[1], e[2] or ""))
        self.ids = [e[0] for e in entries]
        self.names = [[w for w in words(fold(e[1])) if w not in STOP] for e in entries]
        self.initials = ["".join(w[0] for w in n) for n in self.names]
        owners: dict[str, dict[str, None]] = {}
        for k, (own, name, alias) in enumerate(entries):
            for p in (name, alias):
                if p and p.strip():
                    owners.setdefault(" ".join(words(fold(p))), {})[own] = None
            self.initials[k] = "".join(words(fold(alias))) if alias and " " not in alias.strip() else self.initials[k]
        derived: dict[str, dict[str, None]] = {}
        for own, name, _ in entries:
            full = words(fold(name))
            for letters in {"".join(w[0] for w in full if w not in STOP), "".join(w[0] for w in full)}:
                if len(letters) > 2:
                    derived.setdefault(letters, {})[own] = None
        for letters, own in derived.items():  # initials stand for an entry where no listed alias takes them
            owners.setdefault(letters, own)
        short: dict[str, dict[int, None]] = {}
        for k, (_, name, _) in enumerate(entries):  # `Temma Trust` of `Temma Trust for Hearing and Balance`
            head = re.split(r"\b(?:for|of|in|on)\b", fold(name))[0]
            if len(words(head)) > 1 and words(head) != words(fold(name)):
                short.setdefault(" ".join(words(head)), {})[k] = None
        for head, ks in short.items():
            if len({self.ids[k] for k in ks}) == 1 and head not in owners:
                k = next(iter(ks))
                owners[head] = {self.ids[k]: None}
                self.ids.append(self.ids[k])
                self.names.append([w for w in head.split() if w not in STOP])
                self.initials.append(self.initials[k])
        self.owners = {p: list(o) for p, o in owners.items() if p}
        self.automaton = ahocorasick.Automaton()
        for p in self.owners:
            self.automaton.add_word(f" {p} ", p)
        if self.owners:
            self.automaton.make_automaton()
        self.vocabulary: dict[str, list[int]] = {}
        for k, n in enumerate(self.names):
            for w in set(n):
                self.vocabulary.setdefault(w, []).append(k)
        self.meanings = functools.lru_cache(maxsize=MEMO)(self._meanings)

    def __call__(self, value: str) -> str:
        """The id of the entry meant, or UNMATCHED."""
        got = self.memo.get(value)
        if got is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            got = self.memo[value] = self._decide(value)
        return got

    def _decide(self, value: str) -> str:
        folded = fold(value).replace("_", " ")
        bare = BRACKETS.sub(" ", folded)
        bare = TAILS.sub("", bare) if words(TAILS.sub("", bare)) else bare
        for text in dict.fromkeys((folded, bare, TAILS.sub("", folded), *(self._turned(bare)))):
            got = self._mention(words(text))
            if got is not None:
                return got
        typed = words(bare)
        best = self._similar(typed) if typed else None
        return best if best is not None else UNMATCHED

    @staticmethod
    def _turned(text: str) -> list[str]:
        """`Optic Glioma Care, Annals of` the other way round."""
        head, comma, tail = text.partition(",")
        return [f"{tail} {head}"] if comma and tail.strip() else []

    def _mention(self, typed: list[str]) -> str | None:
        """The one entry that mentions name, if the words beside them say nothing; else None."""
        if not typed or not self.owners:
            return None
        text = f" {' '.join(typed)} "
        found = sorted((end - len(p) - 1, end, p) for end, p in self.automaton.iter(text))
        chosen: list[tuple[int, int, str]] = []
        for start, end, p in sorted(found, key=lambda m: (m[0] - m[1], m[0])):  # longest first
            if all(end <= s or start >= e for s, e, _ in chosen):
                chosen.append((start, end, p))
        if not chosen:
            return None
        rest = text
        for start, end, _ in sorted(chosen, reverse=True):
            rest = rest[: start + 1] + rest[end:]
        if any(w not in STOP and w not in FILL and not w[:1].isdigit() and len(w) > 1 for w in rest.split()):
            return None
        sets = [self.owners[p] for _, _, p in sorted(chosen, key=lambda m: -len(m[2]))]
        own = [o for o in sets[0] if all(o in s for s in sets[1:])] or sets[0]
        return own[0]

    def _meanings(self, typed: str) -> tuple[tuple[str, float], ...]:
        """Words of entries that a typed word can stand for."""
        out = []
        for w in self.vocabulary:
            if w[0] == typed[0] or w[1:3] == typed[1:3] or w[:1] == typed[1:2] or w[-3:] == typed[-3:] or w[1:2] == typed[:1] or w[2:5] == typed[2:5]:
                s = likeness(typed, w)
                if s:
                    out.append((w, s))
        return tuple(out)

    def _similar(self, typed: list[str]) -> str | None:
        """The entry all of whose words the value has, with nothing but filling words left over."""
        content = [w for w in typed if w not in STOP]
        seen: dict[int, int] = {}
        likes: list[dict[str, float]] = []
        for w in content:
            own = dict(self.meanings(w))
            likes.append(own)
            for k in {k for m in own for k in self.vocabulary[m]}:
                seen[k] = seen.get(k, 0) + 1
        best: tuple[float, int] | None = None
        for k, n in seen.items():
            name = self.names[k]
            if n < len(name):
                continue
            score = self._score(content, likes, k)
            if score is not None and (best is None or (score, -k) > (best[0], -best[1])):
                best = (score, k)
        return self.ids[best[1]] if best else None

    def _score(self, content: list[str], likes: list[dict[str, float]], k: int) -> float | None:
        name = self.names[k]
        pairs = sorted(((own.get(w, 0.0), -abs(i - j), i, j) for j, own in enumerate(likes) for i, w in enumerate(name) if own.get(w)), reverse=True)
        took: dict[int, int] = {}
        used: set[int] = set()
        total = 0.0
        for s, _, i, j in pairs:
            if i not in took and j not in used:
                took[i] = j
                used.add(j)
                total += s
        if len(took) < len(name):
            return None
        for j, w in enumerate(content):
            if j in used or w in FILL or w[0].isdigit() or len(w) == 1 or w == self.initials[k]:
                continue
            if len(w) <= 5 and any(near(w, x, 1) <= 1 for x in ("for", "and", "the", "of", "in", "from")):
                continue
            return None
        order = sum(took[i] < took[i + 1] for i in range(len(name) - 1)) / max(1, len(name) - 1)
        return total / len(name) + 0.05 * order


def read_entries(df: DataFrame, key: str, name: str, alias: str | None) -> list[tuple[str, str, str | None]]:
    """A reference list for Matcher; its size is checked before it is brought to the driver."""
    rows = df.select(F.col(key), F.col(name), F.col(alias) if alias else F.lit(None).cast("string")).where(F.col(key).isNotNull() & F.col(name).isNotNull()).limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"more than {MOST_ENTRIES} entries")
    return [tuple(r) for r in rows]


def map_values(items: DataFrame, lists: dict[str, list[tuple[str, str, str | None]]]) -> DataFrame:
    """(field_name, row_id, pos, value, ref_id) of items (field_name, row_id, pos, value).

    lists: entries by field_name. Values that are null, blank or, character for character, a name of any
    list are no cases; the caller leaves them out. Every other value gets an id or UNMATCHED; an empty
    list leaves all UNMATCHED. Repeated rows stay repeated; columns of other names are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = _matchers(tuple((f, tuple(sorted(e, key=repr))) for f, e in sorted(lists.items())))
        for batch in batches:
            fields, values = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            ids = [matchers[f](v) if f in matchers and v is not None else UNMATCHED for f, v in zip(fields, values, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.string())], ["field_name", "row_id", "pos", "value", "ref_id"])

    return items.select("field_name", F.col("row_id").cast("bigint").alias("row_id"), F.col("pos").cast("int").alias("pos"), "value").mapInArrow(run, "field_name string, row_id bigint, pos int, value string, ref_id string")


@functools.lru_cache(maxsize=4)
def _matchers(lists: tuple) -> dict[str, Matcher]:
    """One set of automata per worker process, kept from task to task."""
    return {f: Matcher(list(e)) for f, e in lists}
