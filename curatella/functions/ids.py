"""Identifiers: deterministic keys and the spellings of publication ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Namespace of the engine's own name-based ids; a parameter of uuid5.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:research-catalogue")


def uuid5(name: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """Name-based UUID (version 5), the same as Python's; null for null."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    part = lambda start, n: F.substring(h, start, n)
    variant = F.lower(F.hex(F.conv(part(17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def prefixed_uuid5(prefix: str, name: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """UUID of `prefix:name`, surrounding white space of the name left out."""
    return uuid5(F.concat(F.lit(f"{prefix}:"), F.trim(name)), namespace)


def sha1_id(prefix: str, key: Column, length: int = 8) -> Column:
    """Prefix and the first digits of the key's SHA-1."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(key.cast("string")), 1, length))


def pmid_bare(pmid: Column) -> Column:
    """Without the prefix `PMID:` and white space; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(pmid, F.lit("")), "PMID:", ""))


def pmid_prefixed(pmid: Column) -> Column:
    """With the prefix `PMID:`; '' stays ''."""
    bare = pmid_bare(pmid)
    return F.when(bare == "", "").otherwise(F.concat(F.lit("PMID:"), bare))


def doi_url(doi: Column) -> Column:
    """As a resolver address; what already is one stays, null and '' become ''."""
    d = F.trim(F.coalesce(doi, F.lit("")))
    return F.when(d == "", "").when(d.startswith("http"), d).otherwise(F.concat(F.lit("https://doi.org/"), F.regexp_replace(d, "^doi:\\s*", "")))


def file_safe(name: Column) -> Column:
    """Word characters, dots and hyphens stay, runs of others become one underscore."""
    return F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)[^\w.-]+", "_")
