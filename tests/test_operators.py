import datetime as dt
import random

import numpy as np
import pytest
import reference_models as models
from pyspark.sql import functions as F

from caremart.functions import linear
from caremart.operators import keys, lookup, quality, series, versions
from caremart.plans import forecast


def test_dense_key_equals_global_order(spark):
    rows = [(i * 7919 % 10007, f"v{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "p long, v string").repartition(13)
    numbered = keys.dense_key(df, ["p"], "sk", start=2).collect()
    assert [r.sk for r in sorted(numbered, key=lambda r: r.p)] == list(range(2, 5002))


@pytest.mark.parametrize("order", [["p"], ["v", "p"], ["d", "v"]])
def test_dense_key_over_many_ranges(spark, monkeypatch, order):
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 300)
    monkeypatch.setattr(keys, "BOUND_SAMPLE", 200)
    day = dt.date(2024, 1, 1)
    rows = [(i * 7919 % 10007, f"v{i % 50}-{i}" if i % 9 else f"w{i}", day + dt.timedelta(days=i % 17) if i % 5 else None) for i in range(5000)]
    df = spark.createDataFrame(rows, "p long, v string, d date").repartition(13)
    numbered = keys.dense_key(df, order, "sk").collect()
    least = lambda x: (x is not None, x if x is not None else day)
    place = {"p": lambda r: r.p, "v": lambda r: r.v, "d": lambda r: least(r.d)}
    assert [r.sk for r in sorted(numbered, key=lambda r: [place[o](r) for o in order])] == list(range(1, 5001))


def test_dense_key_computes_its_input_once(spark, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_RANGE", 700)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(5000).mapInArrow(counted, "id long")
    written = []
    store = keys.materialise
    monkeypatch.setattr(keys, "materialise", lambda df, name: written.append(name) or store(df, name))
    assert keys.dense_key(df, ["id"], "sk").where("sk <> id + 1").count() == 0
    assert seen.value == 5000 and written == ["sk"]


def test_dense_key_of_nothing(spark):
    empty = spark.createDataFrame([], "p long, v string")
    assert keys.dense_key(empty, ["p"], "sk").count() == 0


def test_members_keep_first_seen_order_under_any_partitioning(spark):
    values = ["b", "a", None, "c", "a", "b", "d", None, "c"] * 50
    df = spark.createDataFrame(list(enumerate(values)), "src_row long, v string")
    want = None
    for parts in (1, 3, 16):
        members = keys.number_members(df.repartition(parts), ["v"], "sk").collect()
        got = [(r.sk, r.v, r.src_row) for r in sorted(members)]
        want = want or got
        assert got == want == [(1, "b", 0), (2, "a", 1), (3, None, 2), (4, "c", 3), (5, "d", 6)]


def test_keep_first_takes_the_first_row_of_each_key(spark):
    rows = [(3, "x", None), (1, "y", 1.0), (2, "x", 5.0), (0, None, 9.0), (4, None, 1.0)]
    df = spark.createDataFrame(rows, "src_row long, k string, a double")
    kept = {(r.k, r.src_row, r.a) for r in keys.keep_first(df, "k").collect()}
    assert kept == {("x", 2, 5.0), ("y", 1, 1.0), (None, 0, 9.0)}


@pytest.mark.parametrize("small", [True, False, None])
def test_lookup_with_hot_missing_duplicate_and_unknown_keys(spark, small):
    """A third of the rows share one key, another third have none."""
    rng = random.Random(1)
    names = [f"k{i}" for i in range(200)]
    rows = []
    for i in range(9000):
        kind = i % 3
        rows.append((i, "Hot" if kind == 0 else None if kind == 1 else rng.choice([*names, "lost", "k1 "])))
    members = [(1, "hot"), (7, " HOT "), *[(10 + i, n) for i, n in enumerate(names)], (5, None)]
    fact = spark.createDataFrame(rows, "i int, name string")
    dim = spark.createDataFrame(members, "sk int, label string")
    found = lookup.resolve(
        fact, dim, "sk", [F.lower("name")], [F.lower(F.trim("label"))], small=small
    ).select("i", "sk").collect()
    table = {"hot": 7, **{n: 10 + i for i, n in enumerate(names)}}
    want = {i: table.get(n.lower(), 1) if n else 1 for i, n in rows}
    assert len(found) == 9000 and {r.i: r.sk for r in found} == want


def test_salted_join_spreads_hot_and_missing_keys(spark):
    fact = spark.range(20000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k")
    )
    table = spark.createDataFrame([("hot", 5)], "k string, v int")
    joined = lookup.salted_left_join(fact, table, ["k"])
    counted = joined.groupBy("v").count().collect()
    assert {r.v: r["count"] for r in counted} == {5: 6667, None: 13333}


def test_a_key_of_half_the_rows_fills_no_task(spark):
    rows = 40_000
    fact = spark.range(rows).select("id", F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(
        F.col("id").cast("string")).alias("k"))
    table = spark.range(rows).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", -1)], "k string, v long"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "40", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = lookup.salted_left_join(fact, table, ["k"])
        dealt = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        assert dealt[1] == rows and dealt[0] <= 1.5 * rows / 40
        assert joined.where("k = 'hot' AND v = -1").count() == rows // 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_lookup_of_long_texts_is_not_broadcast(spark, monkeypatch):
    from caremart import session

    dim = spark.createDataFrame([(1, "x" * 50), (2, "y" * 50)], "sk int, name string")
    assert session.fits_broadcast(dim)
    monkeypatch.setattr(session, "BROADCAST_BYTE_LIMIT", 99)
    assert not session.fits_broadcast(dim)


def test_lookup_without_default_keeps_null(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "i int, k string")
    dim = spark.createDataFrame([(4, "a")], "sk int, k string")
    found = lookup.resolve(fact, dim, "sk", [F.col("k")], [F.col("k")], default=None)
    assert {r.i: r.sk for r in found.collect()} == {1: 4, 2: None, 3: None}


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "M"), (1, "X"), (2, None)], "id int, sexe string")
    assert [(r.id, r.n_rows) for r in quality.duplicates(df, ["id"]).collect()] == [(1, 2)]
    rules = {"sexe in (M, F)": F.col("sexe").isin("M", "F"), **quality.not_null_rules(["sexe"])}
    broken = {(r.id, r.rule) for r in quality.violations(df, rules).collect()}
    assert broken == {(1, "sexe in (M, F)"), (2, "sexe not null")}
    assert {r.rule: r.violations for r in quality.violation_counts(df, rules).collect()} == {
        "sexe in (M, F)": 1, "sexe not null": 1}
    tables = {"child": df, "other": spark.createDataFrame([(3, 9), (None, 1)], "id long, up long"), "up": spark.createDataFrame([(1,), (9,)], "pk int")}
    keys_ = [quality.ForeignKey("child", "id", "up", "pk"), quality.ForeignKey("other", "id", "up", "pk"), quality.ForeignKey("other", "up", "up", "pk")]
    assert {(r.child, r.column): r.violations for r in quality.stacked_orphans(tables, keys_).collect()} == {
        ("child", "id"): 1, ("other", "id"): 1, ("other", "up"): 0}
    assert {(r.table_name, r.column): r.violations for r in quality.stacked_duplicates(tables, [("child", "id"), ("up", "pk")]).collect()} == {
        ("child", "id"): 2, ("up", "pk"): 0}
    parent = spark.createDataFrame([(1,)], "pk int")
    assert [(r.value, r.n_rows) for r in quality.orphans(df, "id", parent, "pk").collect()] == [(2, 1)]
    filled = quality.fill_declared_defaults(df, {"sexe": "F", "est_actif": True}).collect()
    assert [r.sexe for r in filled] == ["M", "X", "F"] and all(r.est_actif for r in filled)


def test_densify_equals_pandas_resample(spark):
    pd = pytest.importorskip("pandas")
    days = ["2024-02-26", "2024-03-01", "2024-03-02", "2024-03-07"]
    values = [None, 2.0, None, 4.0]
    rows = [("a", dt.date.fromisoformat(d), v) for d, v in zip(days, values)]
    rows.append(("b", dt.date(2024, 1, 1), 1.0))
    df = spark.createDataFrame(rows, "g string, d date, y double")
    dense = series.densify(df, ["g"], "d", ["y"])
    got = [(r.d, r.y) for r in dense.where("g = 'a'").orderBy("d").collect()]
    frame = pd.Series(values, index=pd.to_datetime(days)).resample("D").mean().ffill()
    want = [(d.date(), None if np.isnan(v) else v) for d, v in frame.items()]
    assert got == want
    assert {r.g for r in series.densify(df, ["g"], "d", ["y"], min_days=11).select("g").distinct().collect()} == {"a"}
    assert series.densify(df, ["g"], "d", ["y"], min_days=12).count() == 0


def _series_frame(spark, y, start=dt.date(2024, 1, 1), sk=2, capacity=50.0):
    rows = [(sk, start + dt.timedelta(days=i), float(v), float(v) * capacity, capacity) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "service_sk int, d date, rate double, beds double, capacity double")


def test_autoregression_equals_least_squares(spark):
    rng = np.random.default_rng(3)
    y = 0.5 + 0.1 * np.cumsum(rng.normal(size=60)) / 5
    z = np.diff(y)
    lags = np.column_stack([z[5 - k : len(z) - k] for k in range(1, 6)])
    weights = np.linalg.lstsq(lags, z[5:], rcond=None)[0]
    history, level, want = list(z), y[-1], []
    for _ in range(30):
        step = float(sum(w * history[-k] for k, w in enumerate(weights, 1)))
        history.append(step)
        level += step
        want.append(level)
    got = forecast.ar_forecast(_series_frame(spark, y)).orderBy("k").collect()
    assert [r.ar for r in got] == pytest.approx(want, abs=1e-9)


def test_linear_equals_polyfit(spark):
    y = np.linspace(0.2, 0.9, 40) + 0.01 * np.sin(np.arange(40))
    slope, intercept = np.polyfit(np.arange(40), y, 1)
    got = forecast.linear_forecast(_series_frame(spark, y)).orderBy("k").collect()
    assert [r.linear for r in got] == pytest.approx(intercept + slope * np.arange(40, 70), abs=1e-9)


def test_solving_equals_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 6))
    x[:, 4] = 0
    gram, target = x.T @ x, x.T @ rng.normal(size=40)
    df = spark.createDataFrame([(gram.tolist(), target.tolist())], "g array<array<double>>, t array<double>")
    got = np.array(df.select(linear.solve(F.col("g"), F.col("t"))).first()[0])
    keep = [0, 1, 2, 3, 5]
    assert got[4] == 0 and got[keep] == pytest.approx(np.linalg.solve(gram[np.ix_(keep, keep)], target[keep]), abs=1e-10)


@pytest.mark.parametrize("n", [45, 400])
def test_seasonal_equals_ridge_regression(spark, n):
    rng = np.random.default_rng(n)
    start = dt.date(2024, 1, 1)
    days = np.arange(n) + (start - dt.date(1970, 1, 1)).days
    y = 0.5 + 0.2 * np.sin(2 * np.pi * days / 7) + 0.0005 * np.arange(n) + 0.03 * rng.normal(size=n)
    ahead, lower, upper = models.fit_seasonal(days, y, 30)
    got = forecast.seasonal_forecast(_series_frame(spark, y, start)).orderBy("k").collect()
    assert [r.seasonal for r in got] == pytest.approx(ahead, abs=1e-7)
    assert [r.lower for r in got] == pytest.approx(lower, abs=1e-7) and [r.upper for r in got] == pytest.approx(upper, abs=1e-7)


def test_autoregression_equals_the_reference_fit(spark):
    rng = np.random.default_rng(9)
    y = 0.5 + 0.05 * rng.normal(size=90)
    got = forecast.ar_forecast(_series_frame(spark, y)).orderBy("k").collect()
    assert [r.ar for r in got] == pytest.approx(models.fit_autoregressive(y, 30), abs=1e-9)


def test_models_without_data_give_nothing(spark):
    short = _series_frame(spark, [0.5, 0.6, 0.5, 0.4, 0.5, 0.6])
    assert [r.ar for r in forecast.ar_forecast(short, 3).collect()] == [None] * 3
    one = _series_frame(spark, [0.5])
    assert [tuple(r) for r in forecast.seasonal_forecast(one, 2).orderBy("k").collect()] == [(2, 1, None, None, None), (2, 2, None, None, None)]
    gap = _series_frame(spark, [0.5] * 40).withColumn("rate", F.when(F.dayofmonth("d") != 3, F.col("rate")))
    assert gap.count() == 40 and [r.ar for r in forecast.ar_forecast(gap, 2).collect()] == [None] * 2


def test_constant_series_stays_level(spark):
    rows = forecast.forecast_rows(forecast.combined_forecast(_series_frame(spark, [0.3] * 40))).collect()
    assert len(rows) == 30
    assert [r.occupation_predite for r in rows] == pytest.approx([30.0] * 30, abs=0.5)
    assert {r.modele for r in rows} == {"Ensemble"}


def test_combine_clips_and_falls_back(spark):
    models_frame = spark.createDataFrame(
        [(2, 1, 50.0, 0.8, 0.9, 1.0, 0.1, 0.2), (2, 2, 50.0, None, None, None, None, None), (2, 3, 50.0, 5.0, None, None, None, None)],
        "service_sk int, k int, capacity double, ar double, seasonal double, linear double, lower double, upper double",
    ).withColumn("d", F.lit(dt.date(2024, 1, 1)))
    rows = {r.k: r for r in forecast.combine(models_frame).collect()}
    assert rows[1].rate == pytest.approx(0.9) and (rows[1].lower, rows[1].upper) == (0.1, 0.2)
    assert rows[2].rate == 0.5 and rows[2].lower == pytest.approx(0.425) and rows[2].upper == pytest.approx(0.575)
    assert rows[3].rate == 1.0
    assert {r.horizon_jours: r.nb_lits_occupes_predits for r in forecast.forecast_rows(forecast.combine(models_frame)).collect()} == {
        1: 45, 2: 25, 3: 50}


def test_alert_levels(spark):
    df = spark.createDataFrame([(0.85,), (0.8499,), (0.75,), (0.7499,), (None,)], "r double")
    assert [x[0] for x in df.select(forecast.alert_class(F.col("r"))).collect()] == [
        "Critique", "Avertissement", "Avertissement", None, None]


def test_versions(spark):
    current = spark.createDataFrame(
        [(1, "a", "x", dt.date(2024, 1, 1), dt.date(2024, 2, 1), False, 1), (2, "a", "y", dt.date(2024, 2, 1), None, True, 2),
         (3, "b", None, dt.date(2024, 1, 1), None, True, 1), (4, None, "z", dt.date(2024, 1, 1), None, True, 1)],
        "sk int, nk string, attr string, date_debut_validite date, date_fin_validite date, est_actif boolean, version_ligne int",
    )
    incoming = spark.createDataFrame([("a", "w"), ("b", None), ("n", "q"), (None, "z")], "nk string, attr string")
    today = dt.date(2024, 6, 30)
    rows = {r.sk: r for r in versions.merge_versions(current, incoming, "sk", "nk", ["attr"], today).collect()}
    assert len(rows) == 6
    assert not rows[1].est_actif and rows[1].date_fin_validite == dt.date(2024, 2, 1)
    assert not rows[2].est_actif and rows[2].date_fin_validite == today
    assert rows[3].est_actif and rows[3].version_ligne == 1 and rows[4].est_actif
    assert (rows[5].nk, rows[5].attr, rows[5].version_ligne, rows[5].date_debut_validite) == ("a", "w", 3, today)
    assert (rows[6].nk, rows[6].version_ligne, rows[6].est_actif) == ("n", 1, True)


def test_one_active_row_per_member(spark):
    rows = [(1, "a", None, True), (2, "a", None, True), (3, None, None, True), (4, "b", dt.date(2024, 1, 1), False), (5, "b", None, True)]
    current = spark.createDataFrame(rows, "sk int, nk string, date_fin_validite date, est_actif boolean")
    got = {r.sk: (r.date_fin_validite, r.est_actif) for r in versions.one_active(current, "sk", "nk", dt.date(2024, 6, 30)).collect()}
    assert got == {1: (dt.date(2024, 6, 30), False), 2: (None, True), 3: (None, True), 4: (dt.date(2024, 1, 1), False), 5: (None, True)}


def test_a_salted_lookup_reads_no_column_only_to_spread_rows(spark, tmp_path):
    spark.range(3000).selectExpr("id AS src_row", "if(id % 2 = 0, 'hot', string(id)) AS k", "string(id) AS unused").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    table = spark.createDataFrame([("hot", -1), ("7", 7)], "k string, v long")
    found = lookup.salted_left_join(rows, table, ["k"]).select("src_row", "v")
    assert "unused" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.src_row: r.v for r in found.collect()} == {i: -1 if i % 2 == 0 else 7 if i == 7 else None for i in range(3000)}


@pytest.mark.parametrize("parts", [1, 4, 1 << 16])
def test_hot_keys_are_counted_in_crowded_parts_only(spark, monkeypatch, parts):
    monkeypatch.setattr(lookup, "COUNTED_PARTS", parts)
    key = F.when(F.col("id") % 10 < 3, F.lit("hot")).when(F.col("id") % 10 == 3, F.lit(None)).when(
        F.col("id") % 500 == 4, F.lit("warm")).otherwise(F.col("id").cast("string"))
    rows = spark.range(10_000).select(key.alias("k"))
    # 3,000 and 20 of 10,000 rows; a thousandth is 10. Missing keys are no key, but count among the rows.
    assert {(r.k, r._salts) for r in lookup.hot_keys(rows, ["k"]).collect()} == {("hot", 300), ("warm", 2)}
    assert lookup.hot_keys(rows.limit(0), ["k"]).count() == 0
