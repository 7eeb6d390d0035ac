"""Deeply nested records, shredded into related flat tables.

A bottom-up tree automaton gives every node of a payload its states: the shapes that it can be by the
states of its children. A run from the root then picks one state for each node, and every object is routed
to the typed table of its shape; the rows of all tables share the supertype's keys (record, node, parent
node, place in the record). Payloads are parsed once, in one pass over the column, without any shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Productions of the automaton: shape -> child field -> state; "[x]" is an array of x, "." a value.
Grammar = dict[str, dict[str, str]]

# The shape of a review payload.
REVIEW: Grammar = {
    "review": {"pmid": ".", "doi": ".", "year": ".", "title": ".", "toolsAccepted": ".", "acceptedTools": "[tool]", "rejectedTools": "[tool]", "uncertainTools": "[tool]"},
    "tool": {"pmid": ".", "toolName": ".", "toolType": ".", "verdict": ".", "confidence": ".", "recommendation": ".", "contextSnippet": ".", "usageType": ".", "extractedFields": "fields"},
    "fields": {"species": ".", "synonyms": "[.]", "donor": "donor", "mutations": "[mutation]", "vendors": "[vendor]", "validation": "validation", "applications": "[.]", "isCommercial": "."},
    "donor": {"sex": ".", "age": ".", "diagnosis": "diagnosis"},
    "diagnosis": {"name": ".", "grade": "."},
    "mutation": {"gene": ".", "mutationType": ".", "verified": ".", "alleles": "[allele]"},
    "allele": {"allele": ".", "zygosity": "."},
    "vendor": {"vendorName": ".", "items": "[item]"},
    "item": {"catalogNumber": ".", "price": "price"},
    "price": {"amount": ".", "currency": "."},
    "validation": {"methods": "[.]", "result": "."},
}
# Types of fields that aren't texts.
REVIEW_TYPES = {"year": "int", "toolsAccepted": "int", "confidence": "double", "age": "double", "verified": "boolean", "isCommercial": "boolean", "amount": "double"}

NODE = "node_id int, parent_id int, shape string, variant string, field string, ordinal int, top string, top_pos int, path string, own map<string,string>, value string, value_type string"
KEYS = ("record_id", "node_id", "parent_id", "top", "top_pos", "field", "ordinal", "path", "variant")


def _reject(name: str):
    raise ValueError(f"{name} is no JSON")


_decode = json.JSONDecoder(parse_constant=_reject).decode


def parse(text: str | None, levels: int = 3):
    """The object of a payload, or None if it isn't complete JSON or no object. JSON text inside a JSON
    string is parsed again, up to ``levels`` times; a lone object in an array counts as the object."""
    value = text
    for _ in range(levels):
        if not isinstance(value, str):
            break
        try:
            value = _decode(value.strip().lstrip("﻿"))
        except (ValueError, RecursionError):
            return None
    if isinstance(value, list) and len(value) == 1:
        value = value[0]
    return value if isinstance(value, dict) else None


def _inner(value: str):
    """The object or array in a string that holds JSON, else None."""
    inner = value
    for _ in range(3):
        if not (isinstance(inner, str) and inner.strip()[:1] in ("{", "[", '"')):
            break
        try:
            inner = _decode(inner.strip())
        except (ValueError, RecursionError):
            break
    return inner if isinstance(inner, (dict, list)) else None


def _form(value) -> str:
    return "null" if value is None else "object" if isinstance(value, dict) else "array" if isinstance(value, list) else "text" if isinstance(value, str) else "bool" if isinstance(value, bool) else "number"


class Automaton:
    """Runs a grammar's productions over payloads."""

    #: State of nulls and empty arrays: they fit any shape.
    ANY = frozenset("*")

    def __init__(self, grammar: Grammar) -> None:
        self.grammar = grammar
        self.users: dict[str, list[tuple[str, str]]] = {}
        for shape, fields in grammar.items():
            for name, want in fields.items():
                self.users.setdefault(name, []).append((shape, want))
        self.every = frozenset(grammar)

    @staticmethod
    def fits(states: frozenset[str], want: str) -> bool:
        """Whether a child of these states will do where ``want`` is wanted: a lone value does for an array
        of one, an array for a lone value."""
        return "*" in states or want in states or (want[1:-1] if want[0] == "[" else f"[{want}]") in states

    def of_object(self, children: dict[str, frozenset[str]]) -> frozenset[str]:
        """Shapes of an object: those with a field that its child fits, where there is none those that know a
        field at least; all of them if it is empty."""
        if not children:
            return self.every
        fit = frozenset(shape for name, states in children.items() for shape, want in self.users.get(name, ()) if self.fits(states, want))
        return fit or frozenset(shape for name in children for shape, _ in self.users.get(name, ()))

    def run(self, root: dict) -> tuple[list, list, list, list]:
        """Nodes, parents before children: values (JSON in strings parsed), texts of parsed strings, places
        of the children and states, which are computed from the last node to the first."""
        values, texts, children = [root], [None], [None]
        at = 0
        while at < len(values):
            value = values[at]
            if isinstance(value, str) and value[:1] in ("{", "[", '"', " ", "\n", "\t"):
                inner = _inner(value)
                if inner is not None:
                    values[at], texts[at], value = inner, value, inner
            if isinstance(value, (dict, list)):
                start = len(values)
                values.extend(value.values() if isinstance(value, dict) else value)
                grown = len(values) - start
                texts.extend([None] * grown)
                children.extend([None] * grown)
                children[at] = range(start, start + grown)
            at += 1
        states: list[frozenset[str]] = [self.ANY] * len(values)
        value_state = frozenset(".")
        for at in range(len(values) - 1, -1, -1):
            value, own = values[at], children[at]
            if isinstance(value, dict):
                got = self.of_object(dict(zip(value, (states[c] for c in own), strict=True)))
            elif isinstance(value, list):
                got = frozenset(f"[{s}]" for c in own for s in states[c] if s != "*") or self.ANY
            else:
                got = self.ANY if value is None else value_state
            states[at] = got | value_state if texts[at] is not None else got
        return values, texts, children, states

    def shape(self, value: dict, states: frozenset[str], want: str) -> str:
        """The state picked for an object: the one its parent wants if it has it, else the one that knows
        most of its fields, else `other`."""
        if want in states and want in self.grammar:
            return want
        own = [s for s in states if s in self.grammar]
        return max(sorted(own), key=lambda s: sum(n in self.grammar[s] for n in value)) if own and value else "other"

    def shred(self, root: dict, start: str) -> list[tuple]:
        """Rows of NODE: one for each object, and one for each value in an array. ``own`` of an object are
        its fields that hold values; nulls are told by the variant only."""
        values, texts, children, states = self.run(root)
        rows: list[tuple] = []
        # place, wanted state, parent's node, field, ordinal, top field, top ordinal, path
        stack = [(0, start, -1, "", 0, None, None, "")]
        while stack:
            at, want, parent, field, ordinal, top, top_pos, path = stack.pop()
            value, own = values[at], children[at]
            if isinstance(value, list) and not (want == "." and texts[at] is not None):
                item = want[1:-1] if want[0] == "[" else want
                for i, c in reversed(list(enumerate(own, 1))):
                    stack.append((c, item, parent, field, i, top, i if path == "" and parent == 0 and top_pos is None else top_pos, "" if parent == 0 and path == "" else f"{path}[{i}]"))
                continue
            if want[0] == "[":  # a lone value where the grammar has an array
                if value is not None:
                    stack.append((at, want[1:-1], parent, field, 1, top, 1 if path == "" and parent == 0 else top_pos, "" if parent == 0 and path == "" else f"{path}[1]"))
                continue
            node = len(rows)
            if isinstance(value, dict) and not (want == "." and texts[at] is not None):
                shape = self.shape(value, states[at], want)
                known = self.grammar.get(shape, {})
                mine: list[tuple[str, str]] = []
                forms = []
                below = []
                for (name, child), c in zip(value.items(), own, strict=True):
                    forms.append(f"{name if name in known else '+' + name}:{_form(child)}")
                    wanted = known.get(name, ".")
                    inner = values[c]
                    if wanted[0] != "[" and (not isinstance(inner, (dict, list)) or (wanted == "." and texts[c] is not None)):
                        if child is not None:
                            mine.append((name, child if isinstance(child, str) else json.dumps(child)))
                    else:
                        below.append((c, wanted, node, name, 0, name if node == 0 else top, top_pos, "" if node == 0 else f"{path}.{name}" if path else name))
                rows.append((node, parent, shape, ",".join(sorted(forms)), field, ordinal, top, top_pos, path, mine, None, None))
                stack.extend(reversed(below))
            else:
                text = texts[at] if texts[at] is not None else value
                rows.append((node, parent, ".", "", field, ordinal, top, top_pos, path, None, None if text is None else text if isinstance(text, str) else json.dumps(text), _form(text)))
        return rows


def nodes(df: DataFrame, record: str, payload: str, shape: str = "review", grammar: Grammar = REVIEW) -> DataFrame:
    """All nodes of all payloads: (record_id, NODE). Payloads that are null or broken give no rows.

    top and top_pos: the root's field that a node stands below, and the place in it (null where it is no
    array); path: the way from there. Repeated deliveries of a record give repeated rows. Columns of df
    other than the two are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(grammar)
        for batch in batches:
            ids, out = [], []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                root = parse(text)
                if root is not None:
                    got = automaton.shred(root, shape)
                    out.extend(got)
                    ids.extend([rid] * len(got))
                if len(out) > 50_000:
                    yield _batch(ids, out, batch.schema.field(0).type)
                    ids, out = [], []
            if out:
                yield _batch(ids, out, batch.schema.field(0).type)

    kind = dict(df.dtypes)[record]
    return df.select(F.col(f"`{record}`").alias("record_id"), F.col(f"`{payload}`").alias("_payload")).where(F.col("_payload").isNotNull()).mapInArrow(run, f"record_id {kind}, {NODE}")


def _batch(ids: list, rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    text, small = pa.string(), pa.int32()
    types = [small, small, text, text, text, small, text, small, text, pa.map_(text, text), text, text]
    names = [c.split()[0] for c in NODE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["record_id", *names])


def _scalars(shape: str, grammar: Grammar) -> list[str]:
    return [n for n, want in grammar.get(shape, {}).items() if want == "."]


def _typed(shape: str, grammar: Grammar, types: dict[str, str]) -> str:
    """SQL of a shape's struct: its values by their types, and ``untyped``, the values of other fields and
    those that the type can't hold."""
    names = _scalars(shape, grammar)
    raw = lambda n: f"try_element_at(own, '{n}')"
    value = lambda n: f"try_cast({raw(n)} AS {types[n]})" if n in types else raw(n)
    texts = ", ".join(f"'{n}'" for n in names if n not in types) or "''"
    held = " OR ".join([f"k IN ({texts})", *(f"(k = '{n}' AND {value(n)} IS NOT NULL)" for n in names if n in types)])
    return f"named_struct({''.join(f"'{n}', {value(n)}, " for n in names)}'untyped', map_filter(own, (k, v) -> NOT ({held})))"


def routed(every: DataFrame, grammar: Grammar = REVIEW, types: dict[str, str] = REVIEW_TYPES) -> DataFrame:
    """nodes' rows, each routed to one typed subtype: a struct column per shape (and `other`), null for
    the objects of other shapes; values of arrays keep value and value_type."""
    kept = [c for c in every.columns if c != "own"]
    return every.select(*kept, *(F.expr(f"CASE WHEN shape = '{s}' THEN {_typed(s, grammar, types)} END AS as_{s}") for s in (*grammar, "other")))


def latest(df: DataFrame, record: str, payload: str, at: str | None = None) -> DataFrame:
    """(record, payload): of each record the whole of one complete delivery, the last one by ``at`` (null is
    oldest), of equals the one whose text has the largest hash. Records without a complete payload are left
    out. Equal deliveries are combined before anything is compared; no delivery is blended with another."""
    whole = F.pandas_udf(lambda s: s.map(lambda t: parse(t) is not None), "boolean").asNondeterministic()
    when = F.col(f"`{at}`") if at else F.lit(None).cast("timestamp")
    each = df.select(F.col(f"`{record}`").alias("_r"), F.col(f"`{payload}`").alias("_p"), when.alias("_at")).where(F.col("_p").isNotNull() & F.col("_r").isNotNull())
    each = each.where(whole("_p")).withColumn("_h", F.xxhash64("_p"))
    # a record's largest (time, hash) is combined in the map tasks; its text is fetched by the same aggregate
    best = each.groupBy("_r").agg(F.max_by("_p", F.struct("_at", "_h")).alias("_p"))
    return best.select(F.col("_r").alias(record), F.col("_p").alias(payload))


def tables(df: DataFrame, record: str, payload: str, at: str | None = None, grammar: Grammar = REVIEW, types: dict[str, str] = REVIEW_TYPES, root: str = "review") -> dict[str, DataFrame]:
    """Related flat tables of payloads, one per shape, of the last complete delivery of each record.

    Each has the common keys (KEYS), its typed values and ``untyped``; parent_id is the node_id of the row
    that it belongs to in the parent's table. `other` has objects of no shape, `values` the values that
    stand in arrays (value, value_type), `nodes` all rows with their shape.
    """
    every = routed(nodes(latest(df, record, payload, at), record, payload, root, grammar), grammar, types)
    out = {s: every.where(F.col("shape") == s).select(*KEYS, f"as_{s}.*") for s in (*grammar, "other")}
    out["values"] = every.where(F.col("shape") == ".").select(*KEYS, "value", "value_type")
    out["nodes"] = every.select(*KEYS, "shape")
    return out


def leaves(every: DataFrame, grammar: Grammar = REVIEW, types: dict[str, str] = REVIEW_TYPES) -> DataFrame:
    """(record_id, top, top_pos, path): a row per value, other than null and '', of ``routed``: those of the
    typed tables' columns, of their untyped rest and of arrays, in one pass over the rows."""
    names = ["WHEN shape = '.' THEN CASE WHEN value <> '' THEN array('') ELSE array() END"]
    for s in (*grammar, "other"):
        own = ", ".join(f"CASE WHEN CAST(as_{s}.{n} AS STRING) <> '' THEN '{n}' END" for n in _scalars(s, grammar))
        names.append(f"WHEN shape = '{s}' THEN concat(array_compact(array({own})), map_keys(map_filter(as_{s}.untyped, (k, v) -> v <> '')))")
    found = f"transform(CASE {' '.join(names)} END, n -> concat_ws('.', nullif(path, ''), nullif(n, '')))"
    return every.select("record_id", "top", "top_pos", F.explode(F.expr(found)).alias("path"))
