"""Scalar functions of the reports as SQL functions, bound to the run time.

SQL users get the functions that Spark's own dialect lacks or defines otherwise:

=========================  ====================================================================
``getdate()``              the run time, never a clock
``year_difference(a, b)``  1-January boundaries from a to b (Spark's ``datediff(YEAR, ...)``
                           counts completed years)
``isnull_int / _number / _text(value, other)``  ``other`` where ``value`` is NULL, in the type of
                           ``value`` (Spark's ``isnull`` takes one argument and tests)
``charindex(needle, text)``  the place of a literal text, 0 if it is not there
``parse_date(format, text)``  a date by a ``%Y%m%d`` format
``monday_week(day)``       the Monday on or before a day
``day_text(instant)``      ``dd/MM/yyyy``
``age_band_scv(birth)``, ``age_band_perks(birth)``, ``age_segment(birth)``, ``gender_norm(g)``,
``insert_user_norm(u)``, ``country_bucket(c)``  the classifications of :mod:`shopscope.config`
=========================  ====================================================================

``dateadd``, ``ifnull``, ``coalesce``, ``nullif`` and ``replace`` are Spark's own.
All are temporary SQL functions: one expression each, put in the place of its call before the
plan is optimised, so they run as generated code and filters pass through them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from .. import config as C


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(_text(v) for v in values)


def _by_age(rules: list[tuple[str, int, str]], otherwise: str, year: int) -> str:
    """A cascade over the age in ``year``; the first rule that fits wins."""
    arms = " ".join(f"WHEN {year} - year(birth) {op} {bound} THEN {_text(label)}" for op, bound, label in rules)
    return f"CASE WHEN birth IS NULL THEN {_text(C.MISSING)} {arms} ELSE {_text(otherwise)} END"


def definitions(as_of: datetime) -> dict[str, tuple[str, str, str]]:
    """``{name: (parameters, type, expression)}`` of every function."""
    year = as_of.year
    pattern = "replace(replace(replace(format, '%Y', 'yyyy'), '%m', 'MM'), '%d', 'dd')"
    named = f"CASE WHEN country NOT IN ({_listed(C.NAMED_COUNTRIES)}) THEN {_text(C.OTHER_COUNTRY)} ELSE country END"
    kept = f"insert_user IN ({_listed(C.KEPT_INSERT_USERS)}) OR insert_user IS NULL"
    gender = f"CASE WHEN gender IN ({_listed(C.GENDER_MALE)}) THEN 'M' WHEN gender IN ({_listed(C.GENDER_FEMALE)}) THEN 'F' ELSE {_text(C.MISSING)} END"
    return {
        "getdate": ("", "TIMESTAMP_NTZ", f"TIMESTAMP_NTZ'{as_of.isoformat(sep=' ')}'"),
        "year_difference": ("a DATE, b DATE", "INT", "year(b) - year(a)"),
        "isnull_int": ("value BIGINT, other BIGINT", "BIGINT", "coalesce(value, other)"),
        "isnull_number": ("value DOUBLE, other DOUBLE", "DOUBLE", "coalesce(value, other)"),
        "isnull_text": ("value STRING, other STRING", "STRING", "coalesce(value, other)"),
        "charindex": ("needle STRING, text STRING", "INT", "instr(text, needle)"),
        "parse_date": ("format STRING, text STRING", "DATE", f"to_date(text, {pattern})"),
        "monday_week": ("day DATE", "DATE", "trunc(day, 'WEEK')"),
        "day_text": ("instant TIMESTAMP_NTZ", "STRING", "date_format(instant, 'dd/MM/yyyy')"),
        "age_band_scv": ("birth DATE", "STRING", _by_age(C.AGE_BAND_SCV, C.AGE_BAND_SCV_ELSE, year)),
        "age_band_perks": ("birth DATE", "STRING", _by_age(C.AGE_BAND_PERKS, C.AGE_BAND_PERKS_ELSE, year)),
        "age_segment": ("birth DATE", "STRING", _by_age(C.AGE_SEGMENT, C.AGE_SEGMENT_ELSE, year)),
        "gender_norm": ("gender STRING", "STRING", gender),
        "insert_user_norm": ("insert_user STRING", "STRING", f"CASE WHEN {kept} THEN insert_user ELSE {_text(C.OTHER_INSERT_USER)} END"),
        "country_bucket": ("country STRING", "STRING", f"regexp_replace({named}, ' ', '')"),
    }


def register_functions(spark: SparkSession, as_of: datetime) -> list[str]:
    """Define the functions in the session, bound to ``as_of``; returns their names.

    Calling it again binds them to another run time; plans made before keep theirs.
    """
    made = definitions(as_of)
    for name, (parameters, kind, expression) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {expression}")
    return list(made)
