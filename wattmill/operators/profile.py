"""Profiles of a table: cardinality, missing share, distribution, correlation, audits."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.operators.cleaning import as_long
from wattmill.operators.quantiles import grouped_quantiles, quantile_value, quantiles

# The two percentile lists in use, and the histogram sizes.
SUMMARY_PERCENTILES = [0.25, 0.5, 0.75, 0.95, 0.99]
AUDIT_PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.995]
TARGET_BINS = 60
RESIDUAL_BINS = 50
MATCH_TOLERANCE = 1e-3


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """``(item, value)``: distinct non-null values per column.

    The exact form counts each column's values after partial de-duplication;
    the sketch form needs no shuffle of values at all.
    """
    if approximate:
        return as_long(df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]))
    cells = F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).cast("string").alias("v")) for c in columns])
    seen = df.select(F.explode(cells).alias("c")).select("c.item", "c.v").distinct()
    return seen.groupBy("item").agg(F.count("v").cast("double").alias("value"))


def years_per_city(df: DataFrame) -> DataFrame:
    """Distinct years each city appears in."""
    return (
        df.where(F.col("city").isNotNull())
        .select("city", "year")
        .distinct()
        .groupBy("city")
        .agg(F.count("year").alias("n_years"))
    )


def multi_year_cities(df: DataFrame) -> DataFrame:
    """Cities, cities in more than one year, and quantiles of the number of years."""
    per_city = years_per_city(df)
    cut = quantiles(per_city, {"median_years": (F.col("n_years"), 0.5), "p95_years": (F.col("n_years"), 0.95)})
    marks = cut.select(F.struct("median_years", "p95_years")).scalar()
    return per_city.agg(
        F.count(F.lit(1)).alias("cities"), F.count_if(F.col("n_years") > 1).alias("multi_year_cities")
    ).select("cities", "multi_year_cities", marks["median_years"].alias("median_years"), marks["p95_years"].alias("p95_years"))


def median_by(df: DataFrame, by: str, value: str) -> DataFrame:
    """Median of ``value`` per group, largest first."""
    medians = grouped_quantiles(df.where(F.col(by).isNotNull()), [by], {"median": (F.col(value), 0.5)})
    return medians.orderBy(F.desc("median"), by)


def rows_per_year(df: DataFrame) -> DataFrame:
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def missing_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(item, value)``: percentage of nulls per column, largest first."""
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in columns])
    return as_long(shares).orderBy(F.desc("value"), "item")


def describe(df: DataFrame, columns: dict[str, Column], percentiles: Sequence[float]) -> DataFrame:
    """``(item, metric, value)``: count, mean, sample deviation, extremes, exact percentiles."""
    slim = df.select(*[e.cast("double").alias(n) for n, e in columns.items()])
    moments = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    plain = slim.agg(*[f(n).cast("double").alias(f"{i}_{m}") for i, n in enumerate(columns) for m, f in moments.items()])
    whole = {n: F.col(n) for n in columns}
    ranked = quantiles(slim, {f"{i}_q{j}": (whole[n], p) for i, n in enumerate(columns) for j, p in enumerate(percentiles)})
    pairs = as_long(plain).unionByName(as_long(ranked))
    names = F.array(*[F.lit(n) for n in columns])
    labels = F.create_map(*[F.lit(x) for j, p in enumerate(percentiles) for x in (f"q{j}", f"{p * 100:g}%")])
    metric = F.substring_index("item", "_", -1)
    return pairs.select(
        F.get(names, F.substring_index("item", "_", 1).cast("int")).alias("item"),
        F.coalesce(F.try_element_at(labels, metric), metric).alias("metric"),
        "value",
    )


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, minimum, median, maximum per column."""
    found = describe(df, {c: F.col(c) for c in columns if c in df.columns}, [0.5])
    renamed = found.withColumn("metric", F.when(F.col("metric") == "50%", "median").otherwise(F.col("metric")))
    return renamed.where(F.col("metric") != "count")


def coverage(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        (F.max("year") - F.min("year") + 1).alias("span"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations as ``(a, b, value)`` with ``a <= b`` in list order.

    One pass holds all pairs, so the work is one scan whatever the number of columns.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("value")) for i, (a, b) in enumerate(pairs)]
    )
    return row.select(F.explode(cells).alias("p")).select("p.a", "p.b", "p.value")


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width histogram between the extremes, the last bin closed on both ends."""
    slim = df.select(value.cast("double").alias("x")).where(F.col("x").isNotNull())
    ends = slim.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("e")).scalar()
    width = F.nullif(ends["hi"] - ends["lo"], F.lit(0.0))
    bin_no = F.least(F.floor((F.col("x") - ends["lo"]) / width * bins), F.lit(bins - 1))
    return slim.groupBy(F.coalesce(bin_no, F.lit(0)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def repeated_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of rows that repeat an earlier row on ``columns``."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(((F.sum("n") - F.count(F.lit(1))) / F.nullif(F.sum("n"), F.lit(0))).alias("share"))


def agreement(df: DataFrame, given: Column, recomputed: Column) -> DataFrame:
    """Share of filled rows, and share of them where a stored column equals its recomputation."""
    gap = F.abs(given - recomputed)
    return df.agg(
        F.avg(given.isNotNull().cast("double")).alias("filled_share"),
        F.avg(F.when(gap.isNotNull(), (gap < MATCH_TOLERANCE).cast("double"))).alias("match_share"),
    )


def target_summary(train: DataFrame, column: str = "log_target") -> DataFrame:
    """Training-target statistics in log space, and mean and median back in kWh."""
    y = F.col(column)
    half = quantile_value(train, y, 0.5)
    return train.agg(
        F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.min(y).alias("min"), F.max(y).alias("max"),
        F.expm1(F.avg(y)).alias("mean_kwh"),
    ).select("*", half.alias("median"), F.expm1(half).alias("median_kwh"))
