"""Scalar column functions.

Every function maps ``Column -> Column`` and is a built-in Spark expression, so
it stays inside whole-stage codegen; none of them is a Python UDF.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Concept ids and labels used by the rules below.
MALE, FEMALE = 8507, 8532
SEX_LABEL_TO_GENDER = {"남": MALE, "여": FEMALE}
GENDER_TO_LABEL = {MALE: "Male", FEMALE: "Female"}
INPATIENT_VISIT = 9202
EMERGENCY_VISIT = 9203
ADMITTING_SOURCE_DEFAULT = 38004515
LAB_OP_LESS, LAB_OP_GREATER = 4171756, 4172704
LAB_NEGATIVE, LAB_POSITIVE = 9189, 9191
MEAS_LABEL_CONCEPTS = {"MCV": 3023599, "Clostridium difficile cytotoxin A/B": 3032068}
EXCLUSION_MARKER = "삭제"

# A plain decimal number as Python's float() would accept it (without nan/inf).
_NUMBER_RE = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def before_pipe(c: Column | str) -> Column:
    """Text before the first ``|`` (whole text when there is none)."""
    return F.split(col_(c), r"\|", 2).getItem(0)


def split_pipe(c: Column | str) -> Column:
    """Part before the first pipe, trimmed."""
    return F.trim(before_pipe(c))


def kcd_normalise(c: Column | str) -> Column:
    """``A020|x`` -> ``A02.0``; codes of three characters or with a dot stay."""
    code = F.upper(F.trim(before_pipe(c)))
    return (F.when((F.length(code) > 3) & ~code.contains("."),
                   F.concat(code.substr(1, 3), F.lit("."), code.substr(F.lit(4), F.length(code))))
            .otherwise(code))


# Named code transforms selectable from a domain rule.
TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "kcd7": kcd_normalise,
    "split_pipe": split_pipe,
}


def integral_long(c: Column | str) -> Column:
    """Integer value of a number-like column, null when not integral (T9).  Decimal
    arithmetic: ``8507.0`` is 8507 and no digit of a long id is lost."""
    d = col_(c).cast("string").try_cast("decimal(38,9)")
    return F.when(d == F.floor(d), d.cast("decimal(38,0)").cast("string").try_cast("bigint"))


def lenient(c: Column | str, sql_type: str) -> Column:
    """Read a value as ``sql_type``, null when it cannot be read.  Integers may
    be written with a zero fraction, dates as timestamps and timestamps as dates."""
    c = col_(c)
    if sql_type in ("int", "bigint"):
        return integral_long(c).try_cast(sql_type)
    if sql_type in ("date", "timestamp_ntz"):
        return c.try_cast("timestamp_ntz").cast(sql_type)
    return c.try_cast(sql_type)


def pad_widening(n: Column | str, width: int) -> Column:
    """Zero pad to ``width`` digits, widening (never truncating) longer numbers."""
    return F.format_string(f"%0{width}d", col_(n).cast("bigint"))


def id_length(c: Column | str) -> Column:
    """Number of characters of the integer key (a minus sign counts, T10)."""
    return F.length(col_(c).cast("bigint").cast("string"))


def yymmdd(d: Column | str) -> Column:
    """Date part of an occurrence id.  Ids need a year in 2000-2099."""
    d = col_(d)
    return (F.when((F.year(d) >= 2000) & (F.year(d) <= 2099), F.date_format(d, "yyMMdd"))
            .otherwise(F.raise_error(F.concat(F.lit("occurrence id needs a year in 2000-2099, got "),
                                              d.cast("string")))))


def build_id(*parts: Column) -> Column:
    """C11: concatenate text parts and read them as one ``bigint``."""
    return F.concat(*parts).cast("bigint")


def sex_to_gender(c: Column | str) -> Column:
    """Sex label -> gender concept, else null."""
    c = col_(c)
    out = F.lit(None).cast("bigint")
    for label, concept in SEX_LABEL_TO_GENDER.items():
        out = F.when(c == label, F.lit(concept).cast("bigint")).otherwise(out)
    return out


def gender_to_label(c: Column | str) -> Column:
    """Gender concept -> ``Male`` / ``Female``, else empty text."""
    c = col_(c)
    return (F.when(c == MALE, F.lit(GENDER_TO_LABEL[MALE]))
            .when(c == FEMALE, F.lit(GENDER_TO_LABEL[FEMALE])).otherwise(F.lit("")))


def admitting_source(visit_concept: Column | str) -> Column:
    """0 for an inpatient visit, otherwise the default concept (null too)."""
    c = col_(visit_concept)
    return F.when(F.coalesce(c == INPATIENT_VISIT, F.lit(False)), F.lit(0)).otherwise(
        F.lit(ADMITTING_SOURCE_DEFAULT)).cast("bigint")


def zero_if_null(c: Column | str) -> Column:
    """P10."""
    return F.coalesce(col_(c).cast("bigint"), F.lit(0).cast("bigint"))


def measurement_label_fix(concept: Column | str, source_value: Column | str) -> Column:
    """Concept 0 plus a known label before the first pipe -> fixed concept."""
    concept, label = col_(concept), before_pipe(source_value)
    out = concept
    for text, cid in MEAS_LABEL_CONCEPTS.items():
        out = F.when((concept == 0) & (label == text), F.lit(cid).cast("bigint")).otherwise(out)
    return out


def clean_note_text(c: Column | str) -> Column:
    """Non-empty text loses ``$$$$`` and ``\"\"`` and is wrapped in quotes."""
    c = col_(c)
    cleaned = F.replace(F.replace(c, F.lit("$$$$"), F.lit("")), F.lit('""'), F.lit(""))
    return F.when(c.isNotNull() & (c != ""), F.concat(F.lit('"'), cleaned, F.lit('"'))).otherwise(c)


def lab_number(c: Column | str) -> Column:
    """C14: drop ``()`` and ``<>``, read a float, null when it is not a number."""
    t = F.trim(F.regexp_replace(col_(c), r"[()<>]", ""))
    return F.when(t.rlike(_NUMBER_RE), t.try_cast("double"))


def lab_operator(c: Column | str) -> Column:
    """``<`` -> less-than concept, else ``>`` -> greater-than concept."""
    c = col_(c)
    return (F.when(c.contains("<"), F.lit(LAB_OP_LESS))
            .when(c.contains(">"), F.lit(LAB_OP_GREATER))).cast("bigint")


def lab_qualitative(c: Column | str) -> Column:
    """``-`` or Negative -> negative concept; Positive -> positive concept."""
    c = col_(c)
    return (F.when((c == "-") | c.contains("Negative"), F.lit(LAB_NEGATIVE))
            .when(c.contains("Positive"), F.lit(LAB_POSITIVE))).cast("bigint")


def lab_value_as_number(c: Column | str) -> Column:
    """C17: comparator and plain rows get the number, qualitative rows null, ``No WBC`` 0."""
    c = col_(c)
    no_parens = F.regexp_replace(c, r"[()]", "")
    text = F.when(no_parens == "No WBC", F.lit("0")).otherwise(no_parens)
    qualitative = (c == "-") | c.contains("Negative") | c.contains("Positive")
    comparator = c.contains("<") | c.contains(">")
    return F.when(comparator | ~qualitative, lab_number(text))


def strip_whitespace(c: Column | str) -> Column:
    """C18."""
    return F.regexp_replace(col_(c), r"\s+", "")


def hosp_from_department(dept: Column | str, site1_keyword: str = "") -> Column:
    """Department containing the keyword (literal text, T18) -> 1, else 2."""
    if not site1_keyword:
        return F.lit(2).cast("int")
    return F.when(F.coalesce(col_(dept).contains(site1_keyword), F.lit(False)), 1).otherwise(2).cast("int")


def born_after(yob: Column | str, mob: Column | str, event_date: Column | str) -> Column:
    """C20: birth (year, month) later than the event's (year, month)."""
    yob, mob, d = col_(yob), col_(mob), col_(event_date)
    return (yob > F.year(d)) | ((yob == F.year(d)) & (mob > F.month(d)))
