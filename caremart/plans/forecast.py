"""Occupancy history, three forecasts per service, their ensemble, and alerts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart.functions import clamp_unit, guarded_ratio, mean_of_valid, round_half_even
from caremart.functions.linear import add_to_diagonal, cross_products, dot, gram_matrix, quadratic, recursion, solve
from caremart.operators.series import densify, lagged, with_index

# Horizon and minimum history in days, alert levels, fallbacks.
HORIZON = 30
MIN_HISTORY = 30
CRITICAL_LEVEL = 0.85
WARNING_LEVEL = 0.75
CRITICAL = "Critique"
WARNING = "Avertissement"
MODEL_NAME = "Ensemble"
NO_MODEL_RATE = 0.5
LOWER_SHARE = 0.85
UPPER_SHARE = 1.15

# Autoregressive order after one difference, period in days and number of waves of the seasons, seasonal prior scale, interval.
AR_ORDER = 5
YEARLY = (365.25, 10)
WEEKLY = (7.0, 3)
SEASONAL_PRIOR = 10.0
INTERVAL_Z = 1.2815515655446004  # 80 % of a normal distribution lies within +- z
# Share of the series' scale below which noise is not resolved; keeps short series solvable.
NOISE_FLOOR = 1e-3

SERIES = ["service_sk", "d", "rate", "beds", "capacity"]


def occupancy_history(stays: DataFrame, calendar: DataFrame, services: DataFrame) -> DataFrame:
    """One row per stay: date, service, occupied beds, capacity and occupancy rate.

    The calendar is generated (bounded by its dates) and is broadcast; the service table is left
    to Catalyst, which knows its size. The capacity filter runs below the join.
    """
    days = calendar.select("temps_sk", "date_complete")
    beds = services.where(F.col("capacite_lits") > 0).select("service_sk", "nom_service", "capacite_lits")
    return (
        stays.select("temps_sk", "service_sk", "nb_lits_occupes")
        .join(F.broadcast(days), "temps_sk")
        .join(beds, "service_sk")
        .select(
            "date_complete", "nom_service", "service_sk", "nb_lits_occupes", "capacite_lits",
            guarded_ratio(F.col("nb_lits_occupes"), F.col("capacite_lits")).alias("taux_occupation"),
        )
    )


def daily_occupancy(history: DataFrame, how: str = "mean") -> DataFrame:
    """Observed days per service.

    ``mean`` averages the stays of a day; as each stay holds one bed, its rate is 1/capacity.
    ``sum`` adds them up, which is the occupancy an alert can act on.
    """
    combine = {"mean": F.avg, "sum": F.sum}[how]
    measured = history.groupBy("service_sk", "date_complete").agg(
        combine("taux_occupation").alias("rate"),
        combine("nb_lits_occupes").cast("double").alias("beds"),
        F.avg("capacite_lits").alias("capacity"),
    )
    return measured.withColumnRenamed("date_complete", "d").select(*SERIES)


def observed_occupancy(stays: DataFrame, calendar: DataFrame, services: DataFrame, how: str = "mean") -> DataFrame:
    """``daily_occupancy(occupancy_history(...))`` with the stays aggregated before the joins.

    The capacity is one number per service, so beds can be combined per service and date key first:
    the joins then see days instead of stays, and a service with most of the stays is no hot key.
    """
    combine = {"mean": F.avg, "sum": F.sum}[how]
    per_day = stays.groupBy("service_sk", "temps_sk").agg(combine("nb_lits_occupes").alias("nb_lits_occupes"))
    return occupancy_history(per_day, calendar, services).select(
        "service_sk",
        F.col("date_complete").alias("d"),
        F.col("taux_occupation").alias("rate"),
        F.col("nb_lits_occupes").cast("double").alias("beds"),
        F.col("capacite_lits").cast("double").alias("capacity"),
    )


def service_series(observed: DataFrame, min_days: int = MIN_HISTORY) -> DataFrame:
    """Gap-free daily series of services with enough history."""
    return densify(observed, ["service_sk"], "d", ["rate", "beds", "capacity"], min_days)


def horizon_frame(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Per service: capacity at the first day, and the days ahead."""
    ends = series.groupBy("service_sk").agg(
        F.max("d").alias("last_d"),
        F.min_by("capacity", "d").alias("capacity"),
    )
    return ends.select(
        "service_sk", "capacity", "last_d", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k")
    ).select("service_sk", "capacity", "k", F.date_add("last_d", F.col("k")).alias("d"))


def linear_forecast(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Least-squares trend on the day index, extended ``horizon`` days: one native aggregate.

    A series with a missing value gets no trend; a one-day series stays level.
    """
    indexed = with_index(series, ["service_sk"], "d")
    fit = indexed.groupBy("service_sk").agg(
        F.regr_slope("rate", "i").alias("slope"),
        F.regr_intercept("rate", "i").alias("intercept"),
        F.count(F.lit(1)).alias("n"),
        F.count("rate").alias("n_known"),
    )
    x = F.col("n") - 1 + F.col("k")
    value = F.when(F.col("n") == F.col("n_known"), F.col("intercept") + F.col("slope") * x)
    return fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k")).select(
        "service_sk", "k", value.alias("linear")
    )


def ar_forecast(series: DataFrame, horizon: int = HORIZON, order: int = AR_ORDER) -> DataFrame:
    """Autoregression of the first difference on its ``order`` predecessors, without constant, by conditional least squares.

    The sums of products are one aggregate per service; the weights are solved and the differences carried ``horizon`` days on as
    array expressions, so a service costs one row. A series with a missing rate, or with no more than ``order`` differences, has no
    forecast; a predecessor that the others explain has weight 0.
    """
    names = ["dz", *[f"dz_{k}" for k in range(1, order + 1)]]
    steps = lagged(series.select("service_sk", "d", "rate"), ["service_sk"], "d", "rate", order)
    # Days whose predecessors are all known.
    product = f"sum({{a}} * {{b}}) FILTER (WHERE {names[-1]} IS NOT NULL)"
    fit = steps.groupBy("service_sk").agg(
        gram_matrix(names[1:], product).alias("gram"),
        cross_products("dz", names[1:], product).alias("target"),
        # The newest differences first, as the recursion wants them.
        F.max_by(F.array(*names[:-1]), "d").alias("recent"),
        F.max_by("rate", "d").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.count("rate").alias("n_known"),
    )
    solved = fit.where((F.col("n") == F.col("n_known")) & (F.col("n") > order + 1)).withColumn("weights", solve(F.col("gram"), F.col("target")))
    ahead = recursion(F.col("weights"), F.col("recent"), horizon)
    days = fit.select("service_sk", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k"))
    # The steps stand newest first: those of the first k days are the last k of the horizon's.
    summed = F.aggregate(F.slice("ahead", horizon - F.col("k") + 1, F.col("k")), F.lit(0.0), lambda total, x: total + x)
    return days.join(solved.select("service_sk", "last", ahead.alias("ahead")), "service_sk", "left").select(
        "service_sk", "k", (F.col("last") + summed).alias("ar"))


def _seasonal_terms(day: Column, origin: Column, span: Column) -> list[Column]:
    """Level, trend, and sine and cosine of the yearly and weekly waves on a day number."""
    terms = [F.lit(1.0), (day - origin) / span]
    for period, order in (YEARLY, WEEKLY):
        for k in range(1, order + 1):
            angle = day * (2 * math.pi * k / period)
            terms += [F.sin(angle), F.cos(angle)]
    return terms


def seasonal_forecast(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Trend plus yearly and weekly waves by ridge regression, with an 80 % interval.

    One aggregate per service gives the normal equations; they are solved as array expressions. Only the waves are held back by their
    prior, by as much as the noise around the straight trend tells; the trend is free. The interval is the spread of the residuals,
    which also follows from the sums. Fewer than two known days give no forecast.
    """
    days = series.where(F.col("rate").isNotNull()).select("service_sk", "rate", F.unix_date("d").cast("double").alias("day"))
    ends = days.groupBy("service_sk").agg(
        F.min("day").alias("origin"), F.max("day").alias("newest"), F.max(F.abs("rate")).alias("scale"), F.count(F.lit(1)).alias("n")
    ).select("service_sk", "origin", F.greatest(F.col("newest") - F.col("origin"), F.lit(1.0)).alias("span"),
             F.when(F.col("scale") > 0, F.col("scale")).otherwise(F.lit(1.0)).alias("scale"), "n")
    last = series.groupBy("service_sk").agg(F.max(F.unix_date("d")).cast("double").alias("last"))
    ends = ends.where("n >= 2").join(last, "service_sk")
    terms = _seasonal_terms(F.col("day"), F.col("origin"), F.col("span"))
    names = [f"x{i}" for i in range(len(terms))]
    # One row per service on the right.
    design = days.join(ends, "service_sk").select(
        "service_sk", (F.col("rate") / F.col("scale")).alias("y"), *[t.alias(n) for t, n in zip(terms, names)])
    product = "sum({a} * {b})"
    sums = design.groupBy("service_sk").agg(
        gram_matrix(names, product).alias("gram"),
        cross_products("y", names, product).alias("target"),
        F.expr(product.format(a="y", b="y")).alias("yy"),
        F.regr_syy("y", names[1]).alias("syy"),
        F.regr_sxy("y", names[1]).alias("sxy"),
        F.regr_sxx("y", names[1]).alias("sxx"),
    ).join(ends, "service_sk")
    # Spread around the straight trend.
    unexplained = F.greatest(F.col("syy") - F.coalesce(F.col("sxy") * F.col("sxy") / F.nullif("sxx", F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    noise = F.greatest(F.sqrt(unexplained / F.col("n")), F.lit(NOISE_FLOOR)) / SEASONAL_PRIOR
    solved = sums.withColumn("penalty", noise * noise).withColumn(
        "weights", solve(add_to_diagonal(F.col("gram"), F.col("penalty"), start=2), F.col("target")))
    fitted = dot(F.col("weights"), F.col("target"))
    squares = F.col("yy") - 2 * fitted + quadratic(F.col("gram"), F.col("weights"))
    mean = (F.get(F.col("target"), 0) - dot(F.get(F.col("gram"), 0), F.col("weights"))) / F.col("n")
    spread = F.sqrt(F.greatest(squares / F.col("n") - mean * mean, F.lit(0.0))) * INTERVAL_Z * F.col("scale")
    ahead = solved.select("service_sk", "weights", "scale", "origin", "span", "last", spread.alias("spread"),
                          F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k"))
    value = dot(F.col("weights"), F.array(*_seasonal_terms(F.col("last") + F.col("k"), F.col("origin"), F.col("span")))) * F.col("scale")
    found = ahead.select("service_sk", "k", value.alias("seasonal"), "spread").select(
        "service_sk", "k", "seasonal", (F.col("seasonal") - F.col("spread")).alias("lower"), (F.col("seasonal") + F.col("spread")).alias("upper"))
    every = series.select("service_sk").distinct().select("service_sk", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k"))
    return every.join(found, ["service_sk", "k"], "left")


def combine(forecasts: DataFrame) -> DataFrame:
    """Forecast rows from (service_sk, d, k, capacity, ar, seasonal, linear, lower, upper).

    ``rate`` is the clipped mean of the models that gave a value; the interval is the seasonal
    model's, else a fixed share of the rate.
    """
    mean = mean_of_valid(F.col("ar"), F.col("seasonal"), F.col("linear"), default=NO_MODEL_RATE)
    rated = forecasts.withColumn("rate", clamp_unit(mean))
    return rated.withColumns(
        {
            "lower": F.coalesce("lower", F.col("rate") * LOWER_SHARE),
            "upper": F.coalesce("upper", F.col("rate") * UPPER_SHARE),
        }
    )


def forecast_rows(combined: DataFrame) -> DataFrame:
    """The forecast table, rates in percent."""
    return combined.select(
        F.col("d").alias("date_prevision"),
        "service_sk",
        (F.col("rate") * 100).alias("occupation_predite"),
        (F.col("rate") * F.col("capacity")).cast("int").alias("nb_lits_occupes_predits"),
        (F.col("lower") * 100).alias("intervalle_inf"),
        (F.col("upper") * 100).alias("intervalle_sup"),
        F.lit(MODEL_NAME).alias("modele"),
        F.col("k").alias("horizon_jours"),
    )


def alert_class(rate: Column) -> Column:
    """Alert level of a rate, NULL below the warning level."""
    return F.when(rate >= CRITICAL_LEVEL, CRITICAL).when(rate >= WARNING_LEVEL, WARNING)


def alert_rows(combined: DataFrame) -> DataFrame:
    """The alert table: forecast days at or above the warning level."""
    return combined.where(F.col("rate") >= WARNING_LEVEL).select(
        "service_sk",
        F.col("d").alias("date_alerte"),
        (F.col("rate") * 100).alias("seuil_atteint"),
        alert_class(F.col("rate")).alias("type_alerte"),
        F.lit(0).alias("resolu"),
    )


def summary(forecasts: DataFrame) -> DataFrame:
    """Mean forecast and interval per service."""
    columns = ["occupation_predite", "intervalle_inf", "intervalle_sup"]
    return forecasts.groupBy("service_sk").agg(*[round_half_even(F.avg(c)).alias(c) for c in columns])


def combined_forecast(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """All models of all services, joined per forecast day (``horizon`` rows per service) and combined.

    The series is read by each model: pass a written one, so that the stays are aggregated once.
    """
    keys = ["service_sk", "k"]
    frame = horizon_frame(series, horizon).join(ar_forecast(series, horizon), keys).join(seasonal_forecast(series, horizon), keys)
    return combine(frame.join(linear_forecast(series, horizon), keys))
