"""Column-level business rules (classification cascades and flags).

Each function returns a :class:`~pyspark.sql.Column` built from built-in
expressions only, so the rules run inside whole-stage codegen.  CASE-style
cascades are evaluated in order and the first match wins; a NULL test value
falls through to the ELSE branch exactly as in SQL.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

_CMP = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def _cascade(value: Column, rules: list[tuple[str, int, str]], otherwise: str, missing: Column | None) -> Column:
    expr = F.when(missing, F.lit(C.MISSING)) if missing is not None else None
    for op, bound, label in rules:
        cond = _CMP[op](value, F.lit(bound))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def age_band_scv(age: Column, birth_date: Column) -> Column:
    """Age band of the customer view (labels do not match their bounds; 50-59 is ``xx``)."""
    return _cascade(age, C.AGE_BAND_SCV, C.AGE_BAND_SCV_ELSE, birth_date.isNull())


def age_band_perks(age: Column, birth_date: Column) -> Column:
    """Age band of the loyalty snapshot (exactly 51 is ``xx``)."""
    return _cascade(age, C.AGE_BAND_PERKS, C.AGE_BAND_PERKS_ELSE, birth_date.isNull())


def age_segment(age: Column, birth_date: Column) -> Column:
    """Marketing age segment; missing, over 80 and under 10 are ``Missing``."""
    return _cascade(age, C.AGE_SEGMENT, C.AGE_SEGMENT_ELSE, birth_date.isNull())


def gender_norm(gender: Column) -> Column:
    return (
        F.when(gender.isin(*C.GENDER_MALE), F.lit("M"))
        .when(gender.isin(*C.GENDER_FEMALE), F.lit("F"))
        .otherwise(F.lit(C.MISSING))
    )


def insert_user_norm(insert_user: Column) -> Column:
    """Keep WEB, RD Script and NULL; anything else becomes OTHER."""
    keep = insert_user.isin(*C.KEPT_INSERT_USERS) | insert_user.isNull()
    return F.when(keep, insert_user).otherwise(F.lit(C.OTHER_INSERT_USER))


def customer_postcode(store_type: Column, store_postcode: Column, billing_post_code: Column) -> Column:
    """Sign-up store postcode for in-store sign-ups, billing postcode otherwise."""
    return F.when(store_type == C.INSTORE_STORE_TYPE, store_postcode).otherwise(billing_post_code)


def flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN 1 ELSE 0 END`` (NULL condition gives 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def contains_text(text: Column, needle: str) -> Column:
    """Literal substring test (no wildcards; ``_`` is an ordinary character)."""
    return F.instr(text, needle) > 0


# -- item rules ----------------------------------------------------------------
def is_mens(division: Column, department: Column) -> Column:
    words = [contains_text(department, w) for w in C.MENS_DEPARTMENT_WORDS]
    return division.isin(*C.MENS_DIVISIONS) & (words[0] | words[1] | words[2])


def is_petite(division: Column, department: Column, category: Column, size: Column) -> Column:
    """AND binds before OR: the size test applies to the BODY branch only."""
    ladies = (department == C.DEPT_LADIESWEAR) & (category != C.CAT_CURVE)
    body = (
        (division == C.DIV_BODY)
        & ~category.isin(*C.PETITE_BODY_EXCLUDED_CATEGORIES)
        & size.isin(*C.PETITE_SIZES)
    )
    return ladies | body


def is_sports(division: Column, description: Column, text: str) -> Column:
    return contains_text(description, text) & (division == C.DIV_COMMUNITY)


def is_bottoms(category: Column) -> Column:
    lowered = F.lower(category)
    result = None
    for word in C.BOTTOMS_WORDS:
        cond = lowered.like(f"%{word}%")
        result = cond if result is None else result | cond
    return result


# -- customer view rules -------------------------------------------------------
def pure_multi(flag_col: Column, other_col: Column) -> Column:
    """Pure when only this category was bought, Multi when others too, else NULL."""
    other = F.coalesce(other_col, F.lit(0))
    return (
        F.when((flag_col == 1) & (other == 0), F.lit(C.PURE))
        .when((flag_col == 1) & (other == 1), F.lit(C.MULTI))
    )


def sports_affinity(
    afl: Column,
    nrl: Column,
    clicked_afl_nrl: Column,
    clicked_afl: Column,
    clicked_nrl: Column,
    opened_afl_nrl: Column,
    opened_afl: Column,
    opened_nrl: Column,
) -> Column:
    """Purchase beats click beats open; NULL when nothing applies."""
    labels = C.SPORTS_LABELS
    return (
        F.when((afl == 1) & (F.coalesce(nrl, F.lit(0)) == 0), F.lit(labels[0]))
        .when((nrl == 1) & (F.coalesce(afl, F.lit(0)) == 0), F.lit(labels[1]))
        .when((afl == 1) & (nrl == 1), F.lit(labels[2]))
        .when(clicked_afl_nrl == 1, F.lit(labels[3]))
        .when(clicked_afl == 1, F.lit(labels[4]))
        .when(clicked_nrl == 1, F.lit(labels[5]))
        .when(opened_afl_nrl == 1, F.lit(labels[6]))
        .when(opened_afl == 1, F.lit(labels[7]))
        .when(opened_nrl == 1, F.lit(labels[8]))
    )


def lifestage(kids_sales: Column, sales: Column, age: Column) -> Column:
    """Life stage from the kids share of sales (DOUBLE) and age (9999 = unknown).

    The share is NULL when sales are 0, and then only the age tests apply.
    """
    r = kids_sales / F.nullif(sales, F.lit(0.0))
    unknown = age == F.lit(C.UNKNOWN_AGE)
    return (
        F.when((r >= 0.05) | ((r >= 0.01) & unknown), F.lit(C.LIFESTAGE_PARENT))
        .when(age < 25, F.lit(C.LIFESTAGE_EDIT))
        .otherwise(F.lit(C.LIFESTAGE_GENERIC))
    )


# -- mobile rules ----------------------------------------------------------------
def country_bucket(country: Column) -> Column:
    """Named countries kept, others ``Other``, spaces removed; NULL stays NULL."""
    named = F.when(~country.isin(*C.NAMED_COUNTRIES), F.lit(C.OTHER_COUNTRY)).otherwise(country)
    return F.regexp_replace(named, " ", "")
