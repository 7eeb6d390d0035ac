"""Compiling nested submissions into flat, keyed rows by declarative mappings."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatella.operators.reconcile import keep_one


def has(schema: T.StructType, path: str) -> bool:
    """Whether a dotted path exists in a schema."""
    at: T.DataType = schema
    for part in path.split("."):
        if not isinstance(at, T.StructType) or part not in at.names:
            return False
        at = at[part].dataType
    return True


def pick(df: DataFrame, *paths: str) -> Column:
    """First non-blank value of dotted paths, as text; paths that the schema lacks count as blank."""
    options = [F.nullif(F.col(".".join(f"`{p}`" for p in path.split("."))).cast("string"), F.lit("")) for path in paths if has(df.schema, path)]
    return F.coalesce(*options, F.lit("")) if options else F.lit("")


def build(df: DataFrame, mapping: Mapping[str, tuple[str, ...] | Column]) -> DataFrame:
    """Rows of a mapping: column -> paths of which the first filled one counts, or an expression."""
    return df.select(*((v if isinstance(v, Column) else pick(df, *v)).alias(k) for k, v in mapping.items()))


def lead_publication(pubs: Column, usage: str = "_usageType", wanted: str = "Development") -> Column:
    """The first development entry of an array of publications, else the first entry; null if empty."""
    dev = F.filter(pubs, lambda p: p[usage] == wanted)
    return F.coalesce(F.get(dev, F.lit(0)), F.get(pubs, F.lit(0)))


def detect(explicit: Column, probes: list[tuple[Column, str]]) -> Column:
    """The explicit type, else that of the first probe that holds, else ''."""
    out = F.when(F.coalesce(explicit, F.lit("")) != "", explicit)
    for probe, kind in probes:
        out = out.when(F.coalesce(probe, F.lit(False)), kind)
    return out.otherwise("")


def per_item(df: DataFrame, column: str, separator: str = ";", alias: str = "item") -> DataFrame:
    """One row per trimmed item of a separated list; a blank list gives one row with ''."""
    items = F.filter(F.transform(F.split(F.coalesce(F.col(column), F.lit("")), separator), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumn(alias, F.explode(F.when(F.size(items) > 0, items).otherwise(F.array(F.lit("")))))


def richest(df: DataFrame, keys: list[str], fields: list[str], order: list[str]) -> DataFrame:
    """The row of each key with most filled fields, of equals the first in order."""
    n = sum((F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) != "", 1).otherwise(0) for f in fields), F.lit(0))
    return keep_one(df.withColumn("_n", -n), keys, ["_n", *order]).drop("_n")


def two_pass(passes: list[DataFrame], id_: str, pair: list[str], order: list[str]) -> DataFrame:
    """Union of passes, without rows whose id, or whose pair, came earlier (in pass and order)."""
    out = None
    for rank, p in enumerate(passes):
        own = p.withColumn("_pass", F.lit(rank))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    once = keep_one(out, [id_], ["_pass", *order])
    return keep_one(once, pair, ["_pass", *order]).drop("_pass")


#: A rule: the fields that must tell something, the texts (lower case) that tell nothing in them, and a
#: template with the fields in braces. The first rule of a kind that holds counts.
Rule = tuple[tuple[str, ...], tuple[str, ...], str]


def by_rules(kind: Column, rules: Mapping[str, list[Rule]], get) -> Column:
    """The text of the first rule of the row's kind whose fields all tell something; '' if none does, for
    other kinds and null.

    get: function of a field name to its column. Values are trimmed; blanks tell nothing.
    """
    out = F.lit("")
    for own, each in rules.items():
        made = []
        for fields, silent, template in each:
            value = {f: F.trim(get(f)) for f in fields}
            told = F.lit(True)
            for v in value.values():
                told = told & F.coalesce(~F.lower(v).isin("", *silent), F.lit(False))
            parts = [value[p] if i % 2 else F.lit(p) for i, p in enumerate(re.split(r"\{(\w+)\}", template)) if p]
            made.append(F.when(told, F.concat(*parts)))
        out = F.when(kind == own, F.coalesce(*made, F.lit(""))).otherwise(out)
    return out


def fan_out(df: DataFrame, lists: dict[str, str], separator: str = ";") -> DataFrame:
    """A row per combination of the trimmed items of several separated columns (name of the item -> column);
    a blank list counts as one ''. The result's size is the product of a row's own lists, never of rows."""
    for alias, column in lists.items():
        df = per_item(df, column, separator, alias)
    return df


def nested_map(column: Column, schema: str = "map<string,map<string,string>>") -> Column:
    """Entries of a JSON map of maps as an array of struct(outer, inner, value); [] if broken or null."""
    parsed = F.map_entries(F.from_json(column, schema))
    inner = F.transform(parsed, lambda e: F.transform(F.map_entries(e["value"]), lambda x: F.struct(e["key"].alias("outer"), x["key"].alias("inner"), x["value"].alias("value"))))
    return F.coalesce(F.flatten(inner), F.array().cast("array<struct<outer:string,inner:string,value:string>>"))


def submission_json(df: DataFrame, fields: dict[str, str]) -> Column:
    """The reverse: a row as a JSON document, blanks left out."""
    return F.to_json(F.struct(*(F.nullif(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in fields.items())))
