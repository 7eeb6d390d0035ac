"""Completeness scores as pure column expressions, driven by a profile per type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curatella.functions.blank import is_filled, review_filled

# The fields that count, by resource type.
CRITICAL = {
    "Animal Model": ("animalModelGeneticDisorder", "backgroundStrain", "animalState", "description"),
    "Cell Line": ("cellLineCategory", "cellLineGeneticDisorder", "cellLineManifestation", "synonyms"),
    "Antibody": ("targetAntigen", "reactiveSpecies", "hostOrganism", "clonality", "conjugate"),
    "Genetic Reagent": ("insertName", "insertSpecies", "vectorType", "insertEntrezId", "vectorBackbone"),
    "Biobank": ("specimenTissueType", "diseaseType", "tumorType", "specimenFormat", "specimenType"),
    "Patient-Derived Model": ("modelSystemType", "patientDiagnosis", "hostStrain", "tumorType"),
    "Computational Tool": ("softwareName", "softwareType", "sourceRepository", "licenseType"),
    "Organoid Protocol": ("modelType", "derivationSource", "organoidType", "cultureSystem"),
    "Clinical Assessment Tool": ("assessmentName", "assessmentType", "targetPopulation", "diseaseSpecific"),
}
OTHER = {
    "Animal Model": ("backgroundSubstrain", "synonyms", "animalModelOfManifestation"),
    "Cell Line": ("tissue",),
    "Antibody": ("cloneId",),
    "Genetic Reagent": ("synonyms", "promoter"),
    "Biobank": ("specimenPreparationMethod",),
    "Patient-Derived Model": ("engraftmentSite", "clinicalData"),
    "Computational Tool": ("programmingLanguage", "documentation"),
    "Organoid Protocol": ("cellTypes", "matrixType"),
    "Clinical Assessment Tool": ("scoringMethod", "availabilityStatus"),
}
# Right-closed bounds of the categories of a total score.
CATEGORIES = ((20, "Minimal"), (40, "Poor"), (60, "Fair"), (80, "Good"))
TOP = "Excellent"
# Points of an observation with and without a DOI, and their cap.
WITH_DOI, WITHOUT_DOI, CAP = 7.5, 2.5, 25.0


def points(fields: list[Column], most: float) -> Column:
    """``most`` points spread evenly over the fields that are filled; 0 without fields."""
    if not fields:
        return F.lit(0.0)
    n = sum((f.cast("int") for f in fields), F.lit(0))
    return n / F.lit(float(len(fields))) * F.lit(float(most))


def by_type(kind: Column, profile: dict[str, tuple[str, ...]], columns: list[str], build: Callable[[list[str]], Column], default: Column) -> Column:
    """build(fields) of the row's type; fields that the table lacks count as unfilled (given as ``""``)."""
    out = None
    for name, fields in profile.items():
        value = build([f if f in columns else "" for f in fields])
        out = F.when(kind == name, value) if out is None else out.when(kind == name, value)
    return default if out is None else out.otherwise(default)


def field_points(kind: Column, profile: dict[str, tuple[str, ...]], columns: list[str], most: float) -> Column:
    """Points of a profile; unknown and null types have 0."""
    filled = lambda f: is_filled(F.col(f)) if f else F.lit(False)
    return by_type(kind, profile, columns, lambda fs: points([filled(f) for f in fs], most), F.lit(0.0))


def missing(named: list[tuple[str, Column]]) -> Column:
    """Names of unfilled fields joined by `; ` in order."""
    return F.concat_ws("; ", *(F.when(~ok, F.lit(name)) for name, ok in named))


def missing_fields(kind: Column, profile: dict[str, tuple[str, ...]], columns: list[str]) -> Column:
    """missing of a profile; '' for unknown and null types."""
    out = None
    for name, fields in profile.items():
        value = missing([(f, is_filled(F.col(f)) if f in columns else F.lit(False)) for f in fields])
        out = F.when(kind == name, value) if out is None else out.when(kind == name, value)
    return F.lit("") if out is None else out.otherwise("")


def availability(kind: Column, url: Column, acquire: Column, rrid: Column, publication: Column, default_texts: tuple[str, ...] = ()) -> Column:
    """30 points: a biobank's address alone; else acquisition 15 (not for default texts), id 7.5, publication 7.5."""
    known = is_filled(acquire) & (~acquire.isin(*default_texts) if default_texts else F.lit(True))
    rest = F.when(known, 15.0).otherwise(0.0) + F.when(is_filled(rrid), 7.5).otherwise(0.0) + F.when(is_filled(publication), 7.5).otherwise(0.0)
    return F.when(F.coalesce(kind == "Biobank", F.lit(False)), F.when(is_filled(url), 30.0).otherwise(0.0)).otherwise(rest)


def observation_points(with_doi: Column, without: Column) -> Column:
    """Capped sum of observation points; the order of observations doesn't matter for it."""
    return F.least(F.lit(CAP), F.coalesce(with_doi, F.lit(0)) * WITH_DOI + F.coalesce(without, F.lit(0)) * WITHOUT_DOI)


def counted_before_cap(has_doi: Column, parent: list[str], order: list[str]) -> Column:
    """Whether an observation was counted: the points of those before it, in order, are below the cap."""
    worth = F.when(has_doi, WITH_DOI).otherwise(WITHOUT_DOI)
    before = Window.partitionBy(*parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(worth).over(before), F.lit(0.0)) < CAP


def category(score: Column) -> Column:
    """Right-closed category: 80.0 is Good; null for null."""
    out = F.when(score.isNull(), F.lit(None))
    for most, name in CATEGORIES:
        out = out.when(score <= most, name)
    return out.otherwise(TOP)


def all_some_none(part: Column, whole: float) -> Column:
    """`All` if a component has all its points, `No` if none or null, else `Some`."""
    return F.when(part.isNull() | (part <= 0), "No").when(part >= whole, "All").otherwise("Some")


def completeness(fields: list[Column], bonus: Column | None = None) -> Column:
    """Share of filled critical fields, a bonus field counting as one more; 1 without fields."""
    if not fields and bonus is None:
        return F.lit(1.0)
    every = [review_filled(f).cast("int") for f in fields] + ([bonus.cast("int")] if bonus is not None else [])
    return sum(every, F.lit(0)) / F.lit(float(len(every)))


def enough_filled(n_filled: Column, n_fields: int) -> Column:
    """The minimum rule: half of the fields, rounded down, at least one."""
    return n_filled >= max(1, n_fields // 2)


def priority(specific: Column, complete: Column, confidence: Column) -> Column:
    """High, Medium or Low."""
    return F.when(specific & (complete >= 0.67) & (confidence >= 0.85), "High").when((specific | (complete >= 0.67)) & (confidence >= 0.8), "Medium").otherwise("Low")


def mention_confidence(context: Column, established: Column, version: Column) -> Column:
    """0.7 and a tenth each for context and an established name, a twentieth for a version; at most 0.95."""
    return F.least(F.lit(0.95), F.lit(0.7) + F.when(context, 0.1).otherwise(0.0) + F.when(established, 0.1).otherwise(0.0) + F.when(version, 0.05).otherwise(0.0))


def name_score(candidate_first: Column, candidate_last: Column, first: Column, last: Column) -> Column:
    """2 for an equal last name, 1 for an equal first name, 1 more for its initial; case and surrounding
    space aside. What is null or '' earns nothing."""
    tidy = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    f, n = F.nullif(F.lower(first), F.lit("")), F.nullif(F.lower(last), F.lit(""))
    point = lambda hit, p: F.when(F.coalesce(hit, F.lit(False)), p).otherwise(0)
    return point(tidy(candidate_last) == n, 2) + point(tidy(candidate_first) == f, 1) + point(tidy(candidate_first).startswith(F.substring(f, 1, 1)), 1)
