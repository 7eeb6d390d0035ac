"""Data quality: foreign keys, enumerations, required fields, sizes. Findings share one shape:
(check, table, column, value, n)."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _finding(df: DataFrame, check: str, table: str, column: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"), F.col("value").cast("string").alias("value"), F.col("n").cast("bigint").alias("n"))


def fk_orphans(child: DataFrame, table: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys of the child that the parent lacks, with their rows. A null in the parent
    changes nothing, as the test is an anti join. Keys are counted before they are joined."""
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    have = parent.select(F.col(key).alias("_k")).distinct()
    return _finding(keys.join(have, F.col("value") == F.col("_k"), "left_anti"), "fk_orphan", table, column)


def enum_violations(df: DataFrame, table: str, column: str, allowed: list[str], separator: str = ",") -> DataFrame:
    """Values, after splitting and trimming, that aren't allowed; blank parts don't count."""
    parts = df.where(F.col(column).isNotNull()).select(F.explode(F.split(F.col(column), separator)).alias("v"))
    bad = parts.select(F.trim("v").alias("value")).where((F.col("value") != "") & ~F.col("value").isin(*allowed))
    return _finding(bad.groupBy("value").agg(F.count(F.lit(1)).alias("n")), "enum", table, column)


def required(df: DataFrame, table: str, columns: list[str], blank: Mapping[str, Column] | None = None) -> DataFrame:
    """How many rows have each required column null (or blank as told), from one aggregation; a missing
    column is a finding of its own. Columns without a finding are left out."""
    have = [c for c in columns if c in df.columns]
    blank = blank or {}
    one = df.agg(*(F.count(F.when(blank.get(c, F.col(f"`{c}`").isNull()), 1)).alias(c) for c in have), F.lit(None).cast("bigint").alias("_"))
    rows = [F.struct(F.lit("required").alias("check"), F.lit(c).alias("column"), F.col(f"`{c}`").alias("n")) for c in have]
    rows += [F.struct(F.lit("missing_column").alias("check"), F.lit(c).alias("column"), F.lit(1).cast("bigint").alias("n")) for c in columns if c not in have]
    if not rows:
        return one.select(F.lit("").alias("check"), F.lit(table).alias("table"), F.lit("").alias("column"), F.lit(None).cast("string").alias("value"), F.col("_").alias("n")).limit(0)
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.check", F.lit(table).alias("table"), "x.column", F.lit(None).cast("string").alias("value"), "x.n").where(F.col("n") > 0)


def empty_rows(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """How many rows have nothing in any column."""
    columns = columns or df.columns
    none = F.lit(True)
    for c in columns:
        none = none & F.col(f"`{c}`").isNull()
    return df.where(none).agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.lit("empty_row").alias("check"), F.lit(table).alias("table"), F.lit("").alias("column"), F.lit(None).cast("string").alias("value"), "n")


def oversize(df: DataFrame, table: str, caps: dict[str, int]) -> DataFrame:
    """Columns with values longer than their cap: how many, and the longest length as value."""
    one = df.agg(*(F.struct(F.count(F.when(F.length(f"`{c}`") > n, 1)).alias("n"), F.max(F.length(f"`{c}`")).alias("m")).alias(c) for c, n in caps.items()))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.n").alias("n"), F.col(f"`{c}`.m").cast("string").alias("value")) for c in caps))
    return one.select(F.explode(rows).alias("x")).select(F.lit("size").alias("check"), F.lit(table).alias("table"), "x.column", "x.value", "x.n").where(F.col("n") > 0)


def frame_problems(df: DataFrame, payload: str, ids: tuple[str, ...]) -> list[str]:
    """Plan-time check of an incoming frame: payload column, at least one id column, not empty."""
    out = [] if payload in df.columns else [f"no column {payload}"]
    out += [] if any(i in df.columns for i in ids) else [f"none of the columns {', '.join(ids)}"]
    return out + (["no rows"] if df.isEmpty() else [])


def enum_changes(old: DataFrame, new: DataFrame, kind: str, value: str) -> DataFrame:
    """(kind, value, change): values added to or removed from each type's enumeration."""
    a, b = old.select(kind, value).distinct(), new.select(kind, value).distinct()
    return b.join(a, [kind, value], "left_anti").withColumn("change", F.lit("added")).unionByName(a.join(b, [kind, value], "left_anti").withColumn("change", F.lit("removed")))


def inline_schema(node, definitions: dict, path: tuple[str, ...] = ()):
    """A JSON schema without references: each is replaced by its definition, nullable unions by their other
    member. A definition within itself is an open object."""
    if isinstance(node, list):
        return [inline_schema(n, definitions, path) for n in node]
    if not isinstance(node, dict):
        return node
    if "$ref" in node:
        name = node["$ref"].rsplit("/", 1)[-1]
        if name in path:
            return {"type": "object"}
        rest = {k: v for k, v in node.items() if k != "$ref"}
        target = definitions.get(name, {})
        if "enum" in target:  # of an enumeration only its type and values; the property's own keywords win
            target = {"type": target.get("type", "string"), "enum": target["enum"]}
        return inline_schema({**target, **rest}, definitions, (*path, name))
    out = {k: inline_schema(v, definitions, path) for k, v in node.items() if k not in ("$defs", "definitions")}
    if isinstance(out.get("type"), list) and "null" in out["type"]:
        kinds = [t for t in out["type"] if t != "null"]
        out["type"] = kinds[0] if len(kinds) == 1 else kinds
    for union in ("anyOf", "oneOf"):
        members = [m for m in out.get(union, []) if m != {"type": "null"}]
        if union in out and len(members) == 1:
            out = {**{k: v for k, v in out.items() if k != union}, **members[0]}
    return out


def struct_type(schema: dict | str) -> T.DataType:
    """Spark type of a (self-contained) JSON schema; what it doesn't know is a string."""
    schema = json.loads(schema) if isinstance(schema, str) else schema
    kind = schema.get("type")
    if kind == "object" and schema.get("properties"):
        need = set(schema.get("required", []))
        return T.StructType([T.StructField(k, struct_type(v), k not in need) for k, v in schema["properties"].items()])
    if kind == "array":
        return T.ArrayType(struct_type(schema.get("items") or {}))
    return {"integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}.get(kind, T.StringType())


def foreign_keys(schemas: dict[str, T.StructType], keys: dict[str, str], aliases: dict[str, str] | None = None) -> list[tuple[str, str, str, str]]:
    """(child table, column, parent table, key) for every column that bears the name of another table's key.

    schemas: table -> schema; keys: parent table -> its key; aliases: column -> key name, where they differ.
    In order of tables and columns.
    """
    owner = {k: t for t, k in keys.items()}
    out = []
    for child, schema in sorted(schemas.items()):
        for column in schema.names:
            key = (aliases or {}).get(column, column)
            if key in owner and owner[key] != child:
                out.append((child, column, owner[key], key))
    return out


def all_fk_orphans(tables: dict[str, DataFrame], keys: dict[str, str], aliases: dict[str, str] | None = None) -> DataFrame | None:
    """fk_orphans over all foreign keys that the tables' schemas show; None if there is none."""
    out = None
    for child, column, parent, key in foreign_keys({t: df.schema for t, df in tables.items()}, keys, aliases):
        own = fk_orphans(tables[child], child, column, tables[parent], key)
        out = own if out is None else out.unionByName(own)
    return out
