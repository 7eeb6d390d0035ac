"""Files in and out: CSV as text, JSON documents, text caches, YAML reviews, versioned tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatella.operators.reconcile import keep_one


def text_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with every column a string; empty cells are '', none is null."""
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", "").option("nullValue", "\0")
    if columns:
        read = read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = read.csv(path)
    return df.na.fill("")


def file_counts(spark: SparkSession, glob: str) -> DataFrame:
    """(stem, n): rows of each CSV file of a glob, by the name without folder and ending."""
    df = spark.read.option("header", True).csv(glob)
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]+)?$", 1)
    return df.select(stem.alias("stem")).groupBy("stem").agg(F.count(F.lit(1)).alias("n"))


def file_keys(spark: SparkSession, glob: str, pattern: str) -> DataFrame:
    """(key): what a pattern's group finds in the files' names, e.g. those already processed."""
    names = spark.read.format("binaryFile").load(glob).select("path")
    return names.select(F.regexp_extract("path", pattern, 1).alias("key")).where(F.col("key") != "").distinct()


def json_documents(spark: SparkSession, glob: str, schema: str | None = None) -> DataFrame:
    """One row per JSON document; unreadable ones are left out."""
    read = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    if schema:
        read = read.schema(f"{schema}, _corrupt_record string")
    df = read.json(glob)
    return df.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record") if "_corrupt_record" in df.columns else df


def text_cache(spark: SparkSession, folders: list[str], schema: str, key: str = "pmid") -> DataFrame:
    """Cached documents of several folders, by bare key; later folders override earlier ones."""
    out = None
    for rank, folder in enumerate(folders):
        own = json_documents(spark, f"{folder}/*.json", schema).withColumn("_rank", F.lit(-rank))
        out = own if out is None else out.unionByName(own)
    bare = out.withColumn(key, F.trim(F.regexp_replace(F.coalesce(F.col(key), F.lit("")), "PMID:", "")))
    return keep_one(bare.where(F.col(key) != ""), [key], ["_rank"]).drop("_rank")


def _without(column, kind: T.DataType, private: frozenset[str]):
    """A column without private fields at any depth, and its type."""
    if isinstance(kind, T.StructType):
        kept = [(f.name, *_without(column.getField(f.name), f.dataType, private)) for f in kind.fields if f.name not in private]
        if not kept:
            return F.lit(None).cast("string"), T.StringType()
        return F.when(column.isNotNull(), F.struct(*(c.alias(n) for n, c, _ in kept))), T.StructType([T.StructField(n, t) for n, _, t in kept])
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(column, lambda x: _without(x, kind.elementType, private)[0]), kind
    return column, kind


def export_records(df: DataFrame, private: tuple[str, ...], lists: tuple[str, ...] = ("submissions", "data")) -> DataFrame:
    """Records of a form export: an array under one of the names, or rows as they are, without the private
    fields (names such as those of e-mail addresses) at any depth; other fields stay, those with a leading
    underscore too. An object of private fields only becomes null."""
    have = [c for c in lists if c in df.columns]
    rows = df.select(F.explode(F.coalesce(*have)).alias("r")).select("r.*") if have else df
    names = frozenset(private)
    return rows.select(*(_without(F.col(f"`{f.name}`"), f.dataType, names)[0].alias(f.name) for f in rows.schema.fields if f.name not in names))


def flat_yaml(text: str | None) -> dict[str, str]:
    """Scalars of a YAML document by their paths, items of lists numbered from 1: `tools.1.name`; nulls are
    left out, broken and empty documents give {}."""
    import yaml

    try:
        root = yaml.safe_load(text) if text else None
    except yaml.YAMLError:
        return {}
    out: dict[str, str] = {}
    stack = [("", root)]
    while stack:
        path, value = stack.pop()
        if isinstance(value, dict):
            stack.extend((f"{path}.{k}".lstrip("."), v) for k, v in reversed(value.items()))
        elif isinstance(value, list):
            stack.extend((f"{path}.{i}".lstrip("."), v) for i, v in reversed(list(enumerate(value, 1))))
        elif value is not None and path:
            out[path] = str(value).lower() if isinstance(value, bool) else str(value)
    return out


def review_yaml(spark: SparkSession, glob: str) -> DataFrame:
    """(key, review): flat_yaml of each file of a glob; key is the file's stem. Needs the yaml library."""
    try:
        import yaml  # noqa: F401
    except ImportError as e:
        raise RuntimeError("reviews in YAML need the yaml library") from e

    @F.pandas_udf("map<string,string>")
    def read(texts: pd.Series) -> pd.Series:
        return pd.Series([flat_yaml(t) for t in texts], dtype=object)

    files = spark.read.text(glob, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]+)?$", 1).alias("key"), "value")
    return files.select("key", read("value").alias("review"))


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV in a fixed column order; other columns are left out, lacking ones are ''."""
    df.select(*(F.col(f"`{c}`").cast("string").alias(c) if c in df.columns else F.lit("").alias(c) for c in columns)).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def append_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows, then new, with the columns of both; lacking text is ''."""
    out = old.unionByName(new, allowMissingColumns=True)
    return out.na.fill("", [c for c, t in out.dtypes if t == "string"])


def write_version(df: DataFrame, folder: str, version: int) -> str:
    """The table's next version beside the others; readers switch by path. An existing one is an error."""
    path = f"{folder}/v={version:06d}"
    df.write.mode("errorifexists").parquet(path)
    return path


def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    """The newest version of a table written by write_version; the partition filter reads that one only."""
    df = spark.read.parquet(folder)
    newest = df.agg(F.max("v")).first()[0]
    return df.where(F.col("v") == newest).drop("v")


def merge_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Distinct keys of both, blanks left out: a checkpoint of what is done."""
    return old.select(key).unionByName(new.select(key)).where(F.trim(key) != "").distinct()


def merge_cache(old: DataFrame, new: DataFrame, levels: list[str], key: str = "pmid", level: str = "cache_level", at: str = "fetch_date") -> DataFrame:
    """One document per bare key of two caches: the highest level (in order of ``levels``) wins, of equals the
    latest; unknown levels are lowest, blank keys are left out."""
    both = old.unionByName(new, allowMissingColumns=True).withColumn(key, F.trim(F.regexp_replace(F.coalesce(F.col(key), F.lit("")), "PMID:", "")))
    rank = -F.coalesce(F.array_position(F.array(*(F.lit(x) for x in levels)), F.col(level)), F.lit(0))
    ranked = both.where(F.col(key) != "").withColumn("_rank", rank).withColumn("_late", F.col(at).isNotNull())
    newest = ranked.groupBy(key, "_rank").agg(F.max(at).alias("_at"))
    top = newest.groupBy(key).agg(F.min(F.struct("_rank", "_at")).alias("_t")).select(key, "_t.*")
    hits = ranked.join(top, key).where((ranked["_rank"] == top["_rank"]) & F.col(at).eqNullSafe(F.col("_at"))).select(*both.columns)
    return keep_one(hits, [key], [at])
