"""Notions of a missing value, each a named column function.

The catalogue's feeds disagree on what "no value" is; every operator names the notion it uses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and marks that stand for "no value" (compared in lower case, trimmed).
NO_VALUE = (
    "", "-", "--", "---", ".", "?", "*", "/", "_", "–", "—",
    "n/a", "na", "n.a.", "n.a", "#n/a", "nan", "nil", "none", "null", "<na>", "(null)", "(none)", "[]", "{}",
    "unknown", "unk", "tbd", "tba", "tbc", "not available", "not applicable", "not known", "not provided",
    "not reported", "not specified", "unspecified", "undefined", "missing", "no value", "no data", "empty",
)

# White space as text readers know it, beyond what SQL's trim removes.
SPACE = " \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85\xa0            ​    　﻿"
SPACE_CLASS = "[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]+"


def strip(col: Column) -> Column:
    """Without surrounding white space of any kind."""
    return F.btrim(col, F.lit(SPACE))


def squeeze(col: Column) -> Column:
    """White space runs become one space; none surrounds the text."""
    plain = F.btrim(F.translate(col, SPACE, " " * len(SPACE)))
    # a regular expression takes far longer than both looks at the text
    return F.when(F.contains(plain, F.lit("  ")), F.regexp_replace(plain, " {2,}", " ")).otherwise(plain)


def is_blank(col: Column) -> Column:
    """Null, empty, only white space, or a word or mark of NO_VALUE. Never null."""
    return F.coalesce(F.lower(strip(col)).isin(*NO_VALUE), F.lit(True))


def is_filled(col: Column) -> Column:
    """Scoring's notion: not null, not '' and not 'NULL'. White space counts as filled."""
    return F.coalesce(~col.isin("", "NULL"), F.lit(False))


def is_filled_list(col: Column) -> Column:
    """Scoring's notion for lists: not empty, and the first element is filled."""
    return F.coalesce(F.size(col) > 0, F.lit(False)) & is_filled(F.get(col, F.lit(0)))


def crit_filled(col: Column) -> Column:
    """Validation's notion: as is_filled, kept apart because its field lists differ."""
    return is_filled(col)


def review_filled(col: Column) -> Column:
    """Review's notion: the trimmed value isn't '', 'None' or 'Unknown'."""
    return F.coalesce(~strip(col).isin("", "None", "Unknown"), F.lit(False))


def str_blank(col: Column) -> Column:
    """Loading's notion: null or exactly ''."""
    return F.coalesce(col == "", F.lit(True))


def trivial_acquisition(col: Column) -> Column:
    """Acquisition texts that say nothing."""
    return F.coalesce(F.lower(strip(col)).isin("", "n/a", "unknown", "other", "na"), F.lit(True))
