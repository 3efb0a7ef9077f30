"""Derived columns: per-connection target, trend interactions, calendar lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattmill.functions.numeric import amperage, safe_ratio, share_of
from wattmill.operators.cleaning import below_quantile, fill_lags, per_connection
from wattmill.operators.lookup import lookup
from wattmill.operators.quantiles import quantile_value
from wattmill.session import pin

TARGET = "consume_per_conn"
LAG_COLUMNS = ["city_lag1_mean", "city_lag2_mean", "city_rolling_mean3"]


def base_features(df: DataFrame) -> DataFrame:
    """The layered-load features; the target must be there already."""
    have = set(df.columns)
    if "type_of_connection" in have:
        df = df.withColumn("amperage", amperage(F.col("type_of_connection")))
        df = df.withColumn("total_capacity", F.col("amperage") * F.col("num_connections"))
    if "annual_consume_lowtarif_perc" in have:
        df = df.withColumn("hightarif_perc", F.lit(100.0) - F.col("annual_consume_lowtarif_perc"))
    return df.withColumn("log_target", F.log1p(F.col(TARGET)))


def silver_features(df: DataFrame) -> DataFrame:
    """Target, its own outlier rule, then :func:`base_features`."""
    return base_features(below_quantile(per_connection(df), TARGET))


def exploration_target(df: DataFrame) -> DataFrame:
    """The target as the exploration scripts build it: from zero up to its quantile."""
    ratio = safe_ratio(F.col("annual_consume"), F.col("num_connections"))
    return below_quantile(df.withColumn(TARGET, ratio), TARGET, low=0.0)


def trend_features(df: DataFrame) -> DataFrame:
    """Counts behind percentages, the scaled year, and its interactions."""
    have = set(df.columns)
    df = df.withColumn("log_num_connections", F.log1p("num_connections"))
    if "perc_of_active_connections" in have:
        df = df.withColumn("active_connections", share_of(F.col("num_connections"), F.col("perc_of_active_connections")))
    if "smartmeter_perc" in have:
        df = df.withColumn("smartmeter_connections", share_of(F.col("num_connections"), F.col("smartmeter_perc")))
    if "year" in have:
        lo, hi = df.agg(F.min("year"), F.max("year")).first()  # two numbers, so that the plan holds the input once
        span = F.lit(None if lo is None else hi - lo).cast("double")
        df = df.withColumn("year_trend", safe_ratio((F.col("year") - F.lit(lo)).cast("double"), span))
        if "smartmeter_perc" in have:
            df = df.withColumn("smart_x_trend", F.col("smartmeter_perc") * F.col("year_trend"))
        if "total_capacity" in have:
            df = df.withColumn("capacity_x_trend", F.col("total_capacity") * F.col("year_trend"))
    return df


def group_means(df: DataFrame, by: Sequence[str], value: str = TARGET, name: str = "mean") -> DataFrame:
    """Mean of ``value`` per group; rows with a null key take no part."""
    for key in by:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(*by).agg(F.avg(value).alias(name), F.count(value).alias("n_rows"))


def city_year_history(df: DataFrame, city: str = "city", year: str = "year", value: str = TARGET) -> DataFrame:
    """Per city and year: the means of the two calendar years before, of up to three earlier
    *observed* years, and the mean over all cities of the same year.

    All of it is computed on the small city-year grain. A range frame over the
    year finds a calendar lag (a gap gives null) without a self-join, a row
    frame finds the previous observed years, and both share one sort.
    """
    grain = pin(
        df.groupBy(city, year).agg(
            F.sum(value).alias("total"), F.count(value).alias("filled"), F.count(F.lit(1)).alias("n_rows")
        )
    )
    national = grain.groupBy(year).agg((F.sum("total") / F.nullif(F.sum("filled"), F.lit(0))).alias("national_year_mean"))
    by_city = W.partitionBy(city).orderBy(year)
    mean = F.col("total") / F.nullif(F.col("filled"), F.lit(0))
    history = (
        grain.where(F.col(city).isNotNull() & F.col(year).isNotNull())
        .withColumn("city_mean", mean)
        .select(
            city,
            year,
            "n_rows",
            F.avg("city_mean").over(by_city.rangeBetween(-1, -1)).alias("city_lag1_mean"),
            F.avg("city_mean").over(by_city.rangeBetween(-2, -2)).alias("city_lag2_mean"),
            F.avg("city_mean").over(by_city.rowsBetween(-3, -1)).alias("city_rolling_mean3"),
        )
    )
    years = lookup(history, national, [year])
    return years.withColumn("city_vs_national", F.col("city_lag1_mean") - F.col("national_year_mean"))


def lag_features(df: DataFrame, fit: DataFrame | None = None, fill: bool = True) -> DataFrame:
    """Attach the history to every row; gaps take the median target (of ``fit`` when given)."""
    out = lookup(df, city_year_history(df), ["city", "year"], weight="n_rows")
    if not fill:
        return out
    median = quantile_value(fit if fit is not None else df, F.col(TARGET), 0.5)
    return fill_lags(out, LAG_COLUMNS, median, ["city_vs_national"])
