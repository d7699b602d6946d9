"""Rule tables at every boundary (FIXTURES.md section 3), NULL included."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shopscope.functions import dates, rules


def _apply(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("out")).collect()]


AGES_A = [None, 14, 15, 19, 20, 24, 25, 29, 30, 34, 35, 39, 40, 44, 45, 49, 50, 59, 60]
BANDS_A = [
    "Missing", "<=15", "16-18", "16-18", "19-21", "19-21", "22-24", "22-24", "25-29", "25-29",
    "30-34", "30-34", "35-44", "35-44", "45-60", "45-60", "xx", "xx", "60+",
]
AGES_B = [None, 14, 15, 20, 21, 25, 26, 30, 31, 35, 36, 40, 41, 45, 46, 50, 51, 52]
BANDS_B = [
    "Missing", "<=15", "16-20", "16-20", "21-25", "21-25", "26-30", "26-30", "31-35", "31-35",
    "36-40", "36-40", "41-45", "41-45", "46-50", "46-50", "xx", "51+",
]
AGES_S = [None, 9, 10, 18, 19, 24, 25, 39, 40, 80, 81]
SEGMENTS = [
    "Missing", "Missing", "Young Reach (<19)", "Young Reach (<19)", "Edit (19-24)", "Edit (19-24)",
    "Older Reach (25-39)", "Older Reach (25-39)", "Older Reach (40+)", "Older Reach (40+)", "Missing",
]


def _age_rows(ages):
    # birth date NULL exactly when the age is NULL
    return [(a, None if a is None else date(2000, 1, 1)) for a in ages]


@pytest.mark.parametrize(
    "rule, ages, expected",
    [
        (rules.age_band_scv, AGES_A, BANDS_A),
        (rules.age_band_perks, AGES_B, BANDS_B),
        (rules.age_segment, AGES_S, SEGMENTS),
    ],
)
def test_age_cascades(spark, rule, ages, expected):
    out = _apply(spark, _age_rows(ages), "age int, birth date", rule(F.col("age"), F.col("birth")))
    assert out == expected


def test_year_difference_counts_boundaries(spark):
    out = _apply(
        spark,
        [(date(2000, 12, 31),), (date(2001, 1, 1),), (date(1990, 6, 30),)],
        "b date",
        dates.year_boundaries(datetime(2001, 1, 1, 9, 0), F.col("b")),
    )
    assert out == [1, 0, 11]


def test_gender_and_insert_user(spark):
    g = _apply(spark, [("m",), ("M",), ("f",), ("F",), ("x",), (None,)], "g string", rules.gender_norm(F.col("g")))
    assert g == ["M", "M", "F", "F", "Missing", "Missing"]
    u = _apply(
        spark, [("WEB",), ("RD Script",), (None,), ("STAFF",)], "u string", rules.insert_user_norm(F.col("u"))
    )
    assert u == ["WEB", "RD Script", None, "OTHER"]


def test_postcode_rule(spark):
    out = _apply(
        spark,
        [("INSTORE", "3001", "1000"), ("ONLINE", "3001", "1000"), (None, None, "1000")],
        "t string, p string, b string",
        rules.customer_postcode(F.col("t"), F.col("p"), F.col("b")),
    )
    assert out == ["3001", "1000", "1000"]


LIFESTAGE_CASES = [
    # (kids share r, age) -> stage; r given as kids sales over sales 1.0, NULL as sales 0
    ((0.05, 30), "PARENT"),
    ((0.02, 9999), "PARENT"),
    ((0.02, 24), "EDIT"),
    ((0.02, 25), "GENERIC"),
    ((0.0, 9999), "GENERIC"),
    ((0.005, 9999), "GENERIC"),
    ((None, 24), "EDIT"),
    ((None, 30), "GENERIC"),
    ((None, 9999), "GENERIC"),
    ((2.5, 20), "PARENT"),
]


def test_lifestage(spark):
    rows = [(0.0 if r is None else r, 0.0 if r is None else 1.0, age) for (r, age), _ in LIFESTAGE_CASES]
    out = _apply(spark, rows, "k double, s double, age int", rules.lifestage(F.col("k"), F.col("s"), F.col("age")))
    assert out == [stage for _, stage in LIFESTAGE_CASES]


def test_pure_multi(spark):
    out = _apply(
        spark,
        [(1, 0), (1, 1), (0, 1), (None, None), (1, None)],
        "f int, o int",
        rules.pure_multi(F.col("f"), F.col("o")),
    )
    assert out == ["Pure", "Multi", None, None, "Pure"]


def test_self_compared_flags_are_never_pure(spark):
    out = _apply(spark, [(1,), (0,), (None,)], "f int", rules.pure_multi(F.col("f"), F.col("f")))
    assert out == ["Multi", None, None]


def test_petite_precedence(spark):
    rows = [
        ("1 - COTTONON", "12 - LADIESWEAR", "104 - TOPS", "16"),
        ("1 - COTTONON", "12 - LADIESWEAR", "165 - CURVE", "6"),
        ("3 - BODY", "31 - BODY SLEEPWEAR", "104 - TOPS", "6"),
        ("3 - BODY", "31 - BODY SLEEPWEAR", "104 - TOPS", "16"),
        ("3 - BODY", "31 - BODY SLEEPWEAR", "300 - SOLUTIONS", "6"),
    ]
    expr = rules.flag(rules.is_petite(F.col("d"), F.col("p"), F.col("c"), F.col("s")))
    assert _apply(spark, rows, "d string, p string, c string, s string", expr) == [1, 0, 1, 0, 0]


def test_mens_is_a_substring_test(spark):
    rows = [("1 - COTTONON", "WOMENSWEAR"), ("5 - FACTORIE", "51 - GUYS"), ("2 - KIDS", "BOYS"), ("1 - COTTONON", None)]
    expr = rules.flag(rules.is_mens(F.col("d"), F.col("p")))
    assert _apply(spark, rows, "d string, p string", expr) == [1, 1, 0, 0]


SPORTS_CASES = [
    ((1, 0, None, None, None, None, None, None), "AFL"),
    ((1, None, None, None, None, None, None, None), "AFL"),
    ((0, 1, 1, 1, 1, 1, 1, 1), "NRL"),
    ((1, 1, 0, 0, 0, 0, 0, 0), "Multi"),
    ((0, 0, 1, 1, 1, 1, 1, 1), "Multi_em_c"),
    ((None, None, 0, 1, 1, 1, 1, 1), "AFL_em_c"),
    ((0, 0, 0, 0, 1, 1, 1, 1), "NRL_em_c"),
    ((0, 0, None, None, None, 1, 1, 1), "Multi_em_o"),
    ((0, 0, 0, 0, 0, 0, 1, 0), "AFL_em_o"),
    ((0, 0, 0, 0, 0, 0, 0, 1), "NRL_em_o"),
    ((0, 0, 0, 0, 0, 0, 0, 0), None),
    ((None,) * 8, None),
]


def test_sports_cascade(spark):
    names = ["afl", "nrl", "cb", "ca", "cn", "ob", "oa", "on"]
    expr = rules.sports_affinity(*[F.col(n) for n in names])
    out = _apply(spark, [row for row, _ in SPORTS_CASES], ", ".join(f"{n} int" for n in names), expr)
    assert out == [label for _, label in SPORTS_CASES]


def test_country_bucket(spark):
    rows = [(None,), ("Japan",), ("New Zealand",), ("Australia",), ("United States",)]
    assert _apply(spark, rows, "c string", rules.country_bucket(F.col("c"))) == [
        None, "Other", "NewZealand", "Australia", "UnitedStates",
    ]


def test_bottoms_and_plus_size_patterns(spark):
    rows = [("101 - BOTTOMS",), ("102 - Skirts",), ("Cargo PANTS",), ("104 - TOPS",)]
    assert _apply(spark, rows, "c string", rules.is_bottoms(F.col("c"))) == [True, True, True, False]
    sizes = [("XXL",), ("L",), ("M",), ("16",)]
    expr = F.col("s").like("%L%") | F.col("s").isin("14", "16")
    assert _apply(spark, sizes, "s string", expr) == [True, True, False, True]


def test_window_bounds_exclude_the_boundary_day():
    as_of = datetime(2001, 6, 30, 10, 46)
    assert dates.days_back_bound(as_of, 365) == date(2000, 7, 1)
    assert dates.days_back_bound(as_of, 1) == date(2001, 6, 30)
    # a run exactly at midnight includes the boundary day
    assert dates.days_back_bound(datetime(2001, 6, 30), 1) == date(2001, 6, 29)


def test_kids_text_maximum_matches_string_maximum(spark):
    import random

    rng = random.Random(7)
    rows = []
    for g in range(40):
        for _ in range(rng.randint(1, 6)):
            d = datetime(rng.randint(1999, 2024), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23))
            rows.append((g, d, rng.random() < 0.7))
    rows += [(100, datetime(2023, 1, 31), True), (100, datetime(2023, 12, 2), True), (101, datetime(2023, 1, 1), False)]
    df = spark.createDataFrame(rows, "g int, ts timestamp_ntz, k boolean")
    fast = df.groupBy("g").agg(dates.max_ddmmyyyy_text(F.col("k"), F.col("ts")).alias("v"))
    slow = df.groupBy("g").agg(F.max(F.when(F.col("k"), F.date_format("ts", "dd/MM/yyyy"))).alias("v"))
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    assert dict(map(tuple, fast.collect()))[100] == "31/01/2023"
    assert dict(map(tuple, fast.collect()))[101] is None
