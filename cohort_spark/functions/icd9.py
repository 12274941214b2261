"""ICD-9 diagnosis grouping as native Column expressions (no Python UDF).

Two mappers exist on purpose: the pipeline mapper (feature stage) and the
profiling mapper differ on ``2500``, blanks, ``?`` and lower-case E/V codes.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C

# A plain decimal number (what a float parse of an ICD code accepts in practice).
NUMERIC_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _as_number(s: Column) -> Column:
    """Parsed double of a trimmed code, null when it is not a plain number."""
    return F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))


def _in_ranges(n: Column, ranges) -> Column:
    cond = None
    for lo, hi in ranges:
        c = n.between(lo, hi) if lo != hi else (n == lo)
        cond = c if cond is None else (cond | c)
    return cond


def bucket_icd9(code: Column | str) -> Column:
    """Pipeline mapper: null→Missing; prefix 250→Diabetes; E/V→Other; else by range."""
    code = F.col(code) if isinstance(code, str) else code
    s = F.trim(code)
    n = _as_number(s).try_cast("bigint")  # truncates toward zero like int()
    out = (F.when(code.isNull(), F.lit("Missing"))
           .when(s.startswith("250"), F.lit("Diabetes"))
           .when(F.substring(s, 1, 1).isin("E", "V"), F.lit("Other"))
           .when(n.isNull(), F.lit("Other")))
    for name, ranges in C.ICD9_PIPELINE_RANGES:
        out = out.when(_in_ranges(n, ranges), F.lit(name))
    return out.otherwise(F.lit("Other"))


def icd9_chapter(code: Column | str) -> Column:
    """Profiling mapper: also blank/nan/?/none→Missing, lower-case e/v→Other,
    Diabetes iff 250 <= x < 251."""
    code = F.col(code) if isinstance(code, str) else code
    s = F.trim(code)
    num = _as_number(s)
    n = num.try_cast("bigint")
    out = (F.when(code.isNull(), F.lit("Missing"))
           .when((s == "") | F.lower(s).isin("nan", "?", "none"), F.lit("Missing"))
           .when(F.substring(s, 1, 1).isin("V", "v", "E", "e"), F.lit("Other"))
           .when(num.isNull(), F.lit("Other"))
           .when((num >= 250.0) & (num < 251.0), F.lit("Diabetes")))
    for lo, hi, name in C.ICD9_EDA_RANGES:
        out = out.when(n.between(lo, hi), F.lit(name))
    return out.otherwise(F.lit("Other"))
