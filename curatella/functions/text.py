"""Text functions of the catalogue as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of resource types by their plain spelling.
TYPE_LABELS = {
    "animal_model": "Animal Model",
    "cell_line": "Cell Line",
    "antibody": "Antibody",
    "genetic_reagent": "Genetic Reagent",
    "computational_tool": "Computational Tool",
    "patient_derived_model": "Patient-Derived Model",
    "organoid_protocol": "Organoid Protocol",
    "clinical_assessment_tool": "Clinical Assessment Tool",
}


def type_label(kind: Column) -> Column:
    """A type's label, whatever hyphens, spaces and case it is typed with; unknown types stay."""
    plain = F.translate(F.lower(kind), "- ", "__")
    labels = F.create_map(*(F.lit(x) for kv in TYPE_LABELS.items() for x in kv))
    return F.coalesce(F.try_element_at(labels, plain), kind)


# What doesn't count in a resource's name, in order, by the plural name of its type (None: all
# types): pattern, regardless of case, and what takes its place.
KEY_PATTERNS: tuple[tuple[str | None, str, str], ...] = (
    (None, r"\s*\([^)]*(?:RRID|ATCC|cat\.?|catalog|CRL-|CVCL_|lot)[^)]*\)", ""),
    ("cell_lines", r"[\s,]+(?:cell(?:s)?(?:[\s-]?line(?:s)?)?|cell[\s-]?line(?:s)?)$", ""),
    ("animal_models", r"[\s,]+(?:mice?|rats?|animals?|mouse)$", ""),
    ("animal_models", r"flox2", "flox"),
    ("animal_models", r"\bfl\b", "flox"),
    ("patient_derived_models", r"^(?:PDX|PDOX)\s+", ""),
    ("patient_derived_models", r"\s+(?:PDX|PDOX)$", ""),
)
# Marks that vanish from the lower-cased rest, and all that is no letter or digit.
KEY_MARKS = (r"[-\s/.,;:+‐–—]+", r"(?U)[^\w\d]")
# Endings that don't count in the other key, and the marks that vanish from codes.
LOOSE_ENDINGS = (r"\s+cl$", r"\s+cells?$", r"\s+cell\s*lines?$", r"\s+pdx$", r"\s+mice?$", r"\s+rats?$", r"\s+antibody$", r"\s+ab$", r"\s+v?\d+(\.\d+)*$", r"\s+version\s+\d+(\.\d+)*$")
LOOSE_CODE, LOOSE_MARKS = r"[a-z].*\d|\d.*[a-z]", r"[-–—−_\s]+"
# Addresses that tell a tool's name, its endings that don't, and the marks between words.
REPOSITORY, REPOSITORY_ENDINGS, REPOSITORY_MARKS = r"(?i)(?:github|gitlab|bitbucket)\.(?:com|org)/[^/]+/([^/\s?#]+)", r"(?i)(-analysis|-analyzer|-tool|-pipeline|\.git)$", "-_"
ARCHIVE, ARCHIVE_MARKS = r"(?i)(?:zenodo\.org/records?|doi\.org)/[^/]+/([^/\s?#]+)", ".-"


def strike(value: Column, patterns: tuple[str, ...]) -> Column:
    """The text without what each pattern finds, one after the other."""
    for p in patterns:
        value = F.regexp_replace(value, p, "")
    return value


def by_kind(value: Column, kind: Column, rules: tuple[tuple[str | None, str, str], ...]) -> Column:
    """The text after the replacements (kind or None, pattern, replacement) that concern its kind, in order."""
    for own, pattern, new in rules:
        done = F.regexp_replace(value, f"(?i){pattern}", new)
        value = done if own is None else F.when(kind == own, done).otherwise(value)
    return value


def name_key(name: Column, kind: Column, rules: tuple[tuple[str | None, str, str], ...] = KEY_PATTERNS, marks: tuple[str, ...] = KEY_MARKS) -> Column:
    """Key under which spellings of a resource's name meet: what the rules of its kind strike, and marks,
    don't count. kind is a plural type name such as `cell_lines`. Null for null."""
    return strike(F.lower(by_kind(name, kind, rules)), marks)


def name_key_loose(name: Column, endings: tuple[str, ...] = LOOSE_ENDINGS) -> Column:
    """The other key in use: brackets go but what they hold stays, endings go one after the other, separators
    go only in names of letters and digits. '' for null."""
    bare = strike(F.translate(F.trim(F.lower(F.coalesce(name, F.lit("")))), "()", ""), endings)
    return F.trim(F.regexp_replace(F.when(bare.rlike(LOOSE_CODE), strike(bare, (LOOSE_MARKS,))).otherwise(bare), r"\s+", " "))


def title_case(text: Column) -> Column:
    """Each letter after a non-letter in upper case, all others in lower case."""
    parts = F.split(F.lower(text), r"(?<=\P{L})(?=\p{L})")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))), "")


def url_tool_name(url: Column) -> Column:
    """Tool name from the address of a repository, else of an archive's record that isn't a mere number;
    null if it tells none."""
    spoken = lambda c, marks: title_case(F.translate(c, marks, " " * len(marks)))
    repo, record = strike(F.regexp_extract(url, REPOSITORY, 1), (REPOSITORY_ENDINGS,)), F.regexp_extract(url, ARCHIVE, 1)
    return F.when(repo != "", spoken(repo, REPOSITORY_MARKS)).when(record.rlike(r"[^0-9]"), spoken(record, ARCHIVE_MARKS))


def shorten(text: Column, most: int = 50) -> Column:
    """Longer texts end in three dots after ``most`` characters."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def first_match(text: Column, rules: list[tuple[str, str]], default: str | None = "") -> Column:
    """Label of the first rule (pattern, label) that the text matches; rules in order, short-circuit."""
    out = None
    for pattern, label in rules:
        out = F.when(text.rlike(pattern), label) if out is None else out.when(text.rlike(pattern), label)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def all_matches(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Labels of all rules that the text matches, in order."""
    return F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(label)) for p, label in rules)))


def contains_any(text: Column, words: list[str]) -> Column:
    """Whether a lower-cased text holds any of the (lower-case) words as a substring; false for null."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.exists(F.array(*(F.lit(w) for w in words)), lambda w: F.contains(low, w)) if words else F.lit(False)


def count_words(text: Column, words: list[str]) -> Column:
    """How many of the (lower-case) words a text holds as substrings."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.size(F.filter(F.array(*(F.lit(w) for w in words)), lambda w: F.contains(low, w)))


def positions(text: Column, needle: Column) -> Column:
    """All places (from 1, overlapping too) of a needle in a text, regardless of case; [] if none.

    The text is split in front of each mention, in one pass; the lengths of the parts add up to the places.
    """
    low, n = F.lower(text), F.lower(needle)
    mark = F.concat(F.lit("(?=\\Q"), F.regexp_replace(n, r"\\E", r"\\\\E\\\\\\\\E\\\\Q"), F.lit("\\E)"))
    sizes = F.transform(F.split(low, mark), F.length)
    ends = F.transform(F.sequence(F.lit(0), F.size(sizes) - 1), lambda i: F.aggregate(F.slice(sizes, 1, i), F.lit(1), lambda a, x: a + x))
    every = F.when(low.startswith(n), ends).otherwise(F.slice(ends, 2, F.size(ends)))
    return F.when(F.contains(low, n) & (F.length(n) > 0), every).otherwise(F.array().cast("array<int>"))


def contexts(text: Column, needle: Column, around: int = 300) -> Column:
    """The texts around all mentions, ``around`` characters to either side, cut at the text's ends."""
    n = F.length(needle)

    def window(p: Column) -> Column:
        start = F.greatest(p - around, F.lit(1))
        return text.substr(start, p + n + around - start)

    return F.transform(positions(text, needle), window)


def json_list(text: Column, separator: str = ";") -> Column:
    """A JSON array of a list typed with separators outside brackets; one that is a JSON array already stays
    as it is, so that the function may be applied again. Null for null, '' and `NULL`."""
    listed = F.from_json(text, "array<string>")
    parts = F.regexp_extract_all(text, F.lit(rf"(?:[^{separator}(\[]|\([^)]*\)?|\[[^\]]*\]?)+"), F.lit(0))
    items = F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.coalesce(text.isin("", "NULL"), F.lit(True)), F.lit(None)).when(text.rlike(r"^\s*\[.*\]\s*$") & listed.isNotNull(), text).otherwise(F.to_json(items))


def numeric_order(text: Column) -> list[Column]:
    """Sort keys under which `tool 9` stands before `tool 10`: the text before its first number, the
    number, the text. Texts without a number come by their text, null first."""
    return [F.regexp_replace(text, r"\d.*$", ""), F.try_element_at(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), F.lit(1)).try_cast("decimal(38,0)"), text]


def python_list(text: Column) -> Column:
    """Items of a list literal such as `['a', "b"]`; a text that is no list is one item, blank is []."""
    t = F.trim(text)
    quoted = F.regexp_extract_all(t, F.lit("'((?:[^'\\\\]|\\\\.)*)'|\"((?:[^\"\\\\]|\\\\.)*)\""), F.lit(0))
    items = F.transform(quoted, lambda q: q.substr(F.lit(2), F.length(q) - 2))
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).when(t.rlike(r"^\[.*\]$"), items).otherwise(F.array(t))


def boolean_map_keys(m: Column) -> Column:
    """`a, b` of a map whose true keys are meant, in key order."""
    return F.array_join(F.array_sort(F.map_keys(F.map_filter(m, lambda _, v: v))), ", ")
