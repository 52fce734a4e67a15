import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

import caremart.functions as fn


def apply(spark, expr, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


D = dt.datetime

LENIENT = {
    "2026-05-31 08:55:00": D(2026, 5, 31, 8, 55),
    "2026-05-31 08:55": D(2026, 5, 31, 8, 55),
    "2026-05-31": D(2026, 5, 31),
    "2026-5-3": D(2026, 5, 3),
    "31/05/2026 08:55:10": D(2026, 5, 31, 8, 55, 10),
    "31/05/2026 08:55": D(2026, 5, 31, 8, 55),
    "31/05/2026   08:55": D(2026, 5, 31, 8, 55),
    "5/3/2026": D(2026, 3, 5),
    "31-05-2026 08:55": D(2026, 5, 31, 8, 55),
    "05/31/2026": D(2026, 5, 31),
    "05/31/2026 7:05:09": D(2026, 5, 31, 7, 5, 9),
    "05-31-2026": D(2026, 5, 31),
    "20260531": D(2026, 5, 31),
    "2026531": D(2026, 5, 31),
    "31052026": D(2026, 5, 31),
    "2026-05-31T08:55:00": D(2026, 5, 31, 8, 55),
    "2026/05/31": D(2026, 5, 31),
    "May 31, 2026": D(2026, 5, 31),
    "31 september 2026": None,
    "30 september 2026": D(2026, 9, 30),
    "31/5/26": D(2026, 5, 31),
    " 2026-05-31 ": D(2026, 5, 31),
    "31/02/2026": None,
    "2050-01-01": None,
    "2019-12-31": None,
    "garbage": None,
    "20260531 08": None,
    "08:55": None,
    "": None,
    "   ": None,
    None: None,
}


def test_lenient_dates(spark):
    assert apply(spark, fn.parse_date, list(LENIENT)) == list(LENIENT.values())


def test_window_is_a_parameter(spark):
    assert apply(spark, lambda c: fn.parse_date(c, (1990, 2000)), ["31/05/1998", "2026-05-31"]) == [D(1998, 5, 31), None]
    assert apply(spark, lambda c: fn.parse_date(c, None), ["2050-01-01"]) == [D(2050, 1, 1)]


def test_reading_outside_the_window_does_not_end_the_search(spark):
    # Year first this is the year 1011; day first it is 2023.
    assert apply(spark, fn.parse_date, ["10112023"]) == [D(2023, 11, 10)]


def test_date_with_stand_in(spark):
    assert apply(spark, fn.parse_date_or, ["garbage", None, "2026-05-31"]) == [D(2025, 1, 1), D(2025, 1, 1), D(2026, 5, 31)]


def test_strict_dates(spark):
    cases = {
        "2026-05-31 08:55:00": D(2026, 5, 31, 8, 55),
        "2026-05-31 08:55": None,
        "1999-05-31": D(1999, 5, 31),
        "31/05/2026 08:55": D(2026, 5, 31, 8, 55),
        "31/05/2026 08:55:00": None,
        "05/31/2026": None,
        "31-05-2026": D(2026, 5, 31),
        "20260531": None,
        None: None,
    }
    assert apply(spark, fn.parse_date_strict, list(cases)) == list(cases.values())


def test_extract_number(spark):
    cases = {"75 kg": 75.0, "1,75 m": 1.0, "-.5x": -0.5, "3.": 3.0, "abc": None, "": None, None: None}
    assert apply(spark, fn.extract_number, list(cases)) == list(cases.values())


def test_to_number_takes_plain_decimals_only(spark):
    cases = {"12": 12.0, " 1.5 ": 1.5, "1e3": 1000.0, "1d": None, "0x1p3": None, "abc": None, "": None, None: None}
    assert apply(spark, fn.to_number, list(cases)) == list(cases.values())


def test_age_band(spark):
    ages = [None, -1.0, 5.0, 5.9, 6.0, 15.0, 16.0, 30.0, 31.0, 60.0, 61.0, 1e12, float("inf"), float("nan")]
    bands = ["Inconnu", "0-5 ans", "0-5 ans", "0-5 ans", "6-15 ans", "6-15 ans", "16-30 ans", "16-30 ans",
             "31-60 ans", "31-60 ans", "60 ans et +", "60 ans et +", "Inconnu", "Inconnu"]
    assert apply(spark, fn.age_band, ages, "double") == bands


def test_pseudonym(spark):
    first, padded, blank, empty, missing = apply(spark, fn.pseudonymise, ["P1", " P1\t", "  ", "", None])
    assert first == padded == hashlib.sha256(b"P1").hexdigest()
    assert blank is empty is missing is None


@pytest.mark.parametrize("text", ["jean-paul d'arc", "ÉLISE  mbuyi2b", "o'neil-2x ÀB", "", "  a b "])
def test_title_case_equals_python(spark, text):
    assert apply(spark, fn.title_case, [text]) == [text.title()]


def test_missing_tokens_are_exact(spark):
    assert apply(spark, fn.as_missing, ["NA", "", "null", "Aucun", " NA", None]) == [None, None, None, "Aucun", " NA", None]


def test_codes_are_padded_and_never_cut(spark):
    assert apply(spark, lambda c: fn.prefixed_code("SRV", c, 3), [1, 999, 1000], "long") == ["SRV001", "SRV999", "SRV1000"]


def test_flags(spark):
    assert apply(spark, fn.complication_flag, ["Aucune", "aucune", None, "Infection"]) == [0, 0, 1, 1]
    assert apply(spark, fn.caesarean_flag, ["Césarienne", "CÉSARIENNE", None, "Normal"]) == [1, 1, 0, 0]


def test_weight_clamp(spark):
    assert apply(spark, fn.clamp_weight, [3200.0, 9999.9, 10000.0, None], "double") == [3200.0, 9999.9, 0.0, 0.0]


def test_severity(spark):
    assert apply(spark, fn.severity_class, [1, 2, 3, 4, 5], "int") == ["Faible", "Faible", "Modérée", "Critique", "Critique"]


def test_truncation_and_rounding(spark):
    assert apply(spark, fn.truncate_int, [2.9, -2.9, None, 1e20], "double") == [2, -2, None, None]
    assert apply(spark, fn.round_half_even, [0.125, 0.375], "double") == [0.12, 0.38]
    assert apply(spark, lambda c: fn.guarded_ratio(F.lit(3), c), [2, 0, None], "int") == [1.5, None, None]


def test_mean_of_valid(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (float("nan"), 4.0, None)], "a double, b double, c double")
    mean = fn.mean_of_valid(F.col("a"), F.col("b"), F.col("c"), default=0.5)
    assert [r[0] for r in df.select(mean).collect()] == [2.0, 0.5, 4.0]
    assert apply(spark, fn.clamp_unit, [-1.0, 0.3, 2.0, None], "double") == [0.0, 0.3, 1.0, None]


def test_seeded_attributes_repeat(spark):
    df = spark.range(5000).select("id", F.col("id").cast("string").alias("k"))
    made = df.select(
        "id", fn.seeded_uniform(1, 20, F.col("k")).alias("u"), fn.seeded_integer(10, 60, F.col("k")).alias("n"),
        fn.seeded_choice(("M", "F"), F.col("k")).alias("s"),
    )
    again = df.repartition(7).select("id", fn.seeded_integer(10, 60, F.col("k")).alias("n"))
    assert made.join(again, ["id", "n"]).count() == 5000
    low, high, n_low, n_high = made.agg(F.min("u"), F.max("u"), F.min("n"), F.max("n")).first()
    assert (1 <= low < 1.1) and (19.9 < high <= 20) and (n_low, n_high) == (10, 59)
    assert {r[0] for r in made.select("s").distinct().collect()} == {"M", "F"}


def test_tolerant_dates_keep_the_local_time(spark):
    said = {
        "2026.05.31": "2026-05-31 00:00", "2026-05-31 08:55 PM": "2026-05-31 20:55", "31/05/2026 08:55 PM": "2026-05-31 20:55",
        "05/31/2026 8:55 AM": "2026-05-31 08:55", "May 31, 2026 10:00": "2026-05-31 10:00", "31 May 2026 08:55": "2026-05-31 08:55",
        "05/2026": "2026-05-01 00:00", "May 2026": "2026-05-01 00:00", "20260531 0855": "2026-05-31 08:55",
        "20260531085500": "2026-05-31 08:55", "2026-05-31 08h55": "2026-05-31 08:55", "31-May-26": "2026-05-31 00:00",
        "31/05/2026T08:55:00": "2026-05-31 08:55", "Sunday, May 31, 2026": "2026-05-31 00:00",
        "2026-05-31T01:55:00+02:00": "2026-05-31 01:55", "2026-05-31 23:55:00-0500": "2026-05-31 23:55",
        "2026-05-31T00:55:00.250Z": "2026-05-31 00:55", "2026-05-31 12:05 am": "2026-05-31 00:05", "2026-05-31 12:05 PM": "2026-05-31 12:05",
        "31 Program": None, "2026-13-40 08:55 PM": None,
        "31/05/2026 08:55:00.123": "2026-05-31 08:55", "31/05/2026 08:55+02:00": "2026-05-31 08:55", "31 05 2026": "2026-05-31 00:00",
        "2026 05 31": "2026-05-31 00:00", "May-31-2026": "2026-05-31 00:00", "2026-May-31": "2026-05-31 00:00",
        "31st May 2026": "2026-05-31 00:00", "May 31st, 2026": "2026-05-31 00:00", "31/05/2026 8h55": "2026-05-31 08:55",
        "08:55 31/05/2026": "2026-05-31 08:55", "2026-05-31 8": None, "2026-05-31 08:55:00.5": "2026-05-31 08:55", "3152026": "2026-05-31 00:00", "1052026": "2026-05-10 00:00",
        # Day first only where the form is a plain one; otherwise the month comes first unless it cannot.
        "05/03/2026": "2026-03-05 00:00", "05/03/2026 08:55": "2026-03-05 08:55", "05/03/2026 08:55 AM": "2026-05-03 08:55",
        "05/03/2026T08:55": "2026-05-03 08:55", "05.03.2026": "2026-05-03 00:00", "05 03 2026": "2026-05-03 00:00",
        "2026-5-3 8:5:9": "2026-05-03 08:05", "2026": "2026-01-01 00:00", "th" * 40 + "x": None, "31/05/2026 25:00": None,
    }
    df = spark.createDataFrame([(k,) for k in said], "t string")
    rows = df.select("t", F.date_format(fn.parse_date(F.col("t")), "yyyy-MM-dd HH:mm").alias("d")).collect()
    assert {r.t: r.d for r in rows} == said


def test_a_date_column_is_read_as_the_expression_reads_it(spark):
    texts = [*LENIENT, "31/13/2026", "13/13/2026 08:55", "May 3, 2026\t10:00", "3rd of May 2026", "8h55 31/05/2026", "12/31/2026 12:10 am", "Wed 7", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    staged = fn.with_parsed_date(df, "v").orderBy("i").collect()
    assert staged == df.withColumn("v", fn.parse_date(F.col("v"))).orderBy("i").collect()
    assert {t: r.v for t, r in zip(texts, staged) if t in LENIENT} == LENIENT


def test_date_forms_of_a_source_stay_out_of_whole_stage_code(spark, tmp_path):
    from caremart.registry import fixtures

    rows = [(k, k * 3, k % 31, k % 7 + 1, D(1997, 1 + k % 12, 1 + k % 28)) for k in range(200)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp")
    lines.selectExpr("*", "'A' AS l_returnflag", "'O' AS l_linestatus", "2.0D AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    f = fixtures.Fixtures(spark, str(tmp_path))
    source = f.source("hospitalisation")
    assert "lambdafunction" in source._jdf.queryExecution().optimizedPlan().toString()
    assert source.orderBy("src_row").collect() == f.select(fixtures.STAYS).orderBy("src_row").collect()


def test_a_plain_column_is_stripped_like_any_text(spark):
    texts = ["", None, "a", " a", "a ", " a", "a　", "é", " é ", "\x7f", "a\x85", "a b", "\t", "~a!", "é\x1f", " \n", "a\x7f"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    found = df.select(fn.stripped(F.col("v")).alias("fast"), fn.strip(F.col("v")).alias("slow")).collect()
    assert [r.fast for r in found] == [r.slow for r in found] == [t.strip(" \t\n\x1f\x85\xa0　") if t is not None else None for t in texts]
