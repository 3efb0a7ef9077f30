"""Target encoding and scaling: fits are small tables, applying them is a lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.operators.lookup import lookup
from wattmill.operators.splits import FOLDS
from wattmill.session import pin

# The categories that are encoded.
ENCODED = ["city", "purchase_area", "net_manager"]


def fit_target_means(
    train: DataFrame, columns: Sequence[str], target: str = "log_target", fold: str | None = None
) -> DataFrame:
    """``(feature, category, [fold,] total, n)`` of the target over the training rows.

    All columns share one scan: each row is read once and contributes one cell
    per column, which partial aggregation folds before anything is shuffled.
    Null categories take no part.
    """
    keys = [fold] if fold else []
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns])
    long = train.select(*keys, F.col(target).alias("y"), F.explode(cells).alias("c")).select(*keys, "y", "c.*")
    return (
        long.where(F.col("category").isNotNull())
        .groupBy("feature", "category", *keys)
        .agg(F.sum("y").alias("total"), F.count("y").alias("n"))
    )


def global_mean(train: DataFrame, target: str = "log_target") -> Column:
    """The mean as a literal: one number is read back, so that what uses it does not scan the rows again."""
    return F.lit(train.agg(F.avg(target)).first()[0]).cast("double")


def encode(df: DataFrame, sums: DataFrame, default: Column, columns: Sequence[str] = ENCODED) -> DataFrame:
    """Add ``<column>_te``: the fitted mean of the row's category, ``default`` where there is none."""
    sums = pin(sums)
    for column in columns:
        means = sums.where(F.col("feature") == column).select(
            F.col("category").alias(column), (F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias("_mean"), "n"
        )
        df = lookup(df, means, [column], weight="n")
        df = df.withColumn(f"{column}_te", F.coalesce(F.col("_mean"), default)).drop("_mean")
    return df


def target_encode(
    df: DataFrame, columns: Sequence[str] = ENCODED, target: str = "log_target", split: str = "split"
) -> DataFrame:
    """Fit on the training rows only, apply to all rows."""
    train = df.where(F.col(split) == "train")
    return encode(df, fit_target_means(train, columns, target), global_mean(train, target), columns)


def fold_encode(
    df: DataFrame,
    columns: Sequence[str] = ENCODED,
    target: str = "log_target",
    split: str = "split",
    fold: str = "fold",
    folds: int = FOLDS,
) -> DataFrame:
    """Out-of-fold means on the training rows, full training means elsewhere.

    The mean over the other folds is ``(S - S_f) / (N - N_f)``, so one pass of
    sums per category and fold replaces a pass per fold. It is worked out per category,
    so a row only picks one of them. ``df`` needs ``fold``.
    """
    train = df.where(F.col(split) == "train")
    sums = fit_target_means(train, columns, target, fold)
    default = global_mean(train, target)
    mean = lambda total, n: F.coalesce(total.cast("double") / F.nullif(n, F.lit(0)), default)
    per_fold = pin(sums.groupBy("feature", "category").agg(
        F.sum("total").alias("total"),
        F.sum("n").alias("n"),
        F.map_from_entries(F.collect_list(F.struct(F.col(fold), F.struct("total", "n")))).alias("by_fold"),
    ).select(
        "feature", "category", "n", mean(F.col("total"), F.col("n")).alias("mean"),
        F.transform_values("by_fold", lambda _, own: mean(F.col("total") - own["total"], F.col("n") - own["n"])).alias("others"),
    ))
    for column in columns:
        part = per_fold.where(F.col("feature") == column).select(
            F.col("category").alias(column), F.col("mean").alias("_mean"), F.col("others").alias("_others"), F.col("n").alias("_w")
        )
        df = lookup(df, part, [column], weight="_w")
        held = F.when(F.col(split) == "train", F.try_element_at(F.col("_others"), F.col(fold)))
        df = df.withColumn(f"{column}_te", F.coalesce(held, F.col("_mean"), default)).drop("_mean", "_others")
    return df


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, mean, scale)``; the scale is the population deviation, 1 where that is 0."""
    row = train.agg(
        *[F.avg(c).cast("double").alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"m{i}").alias("mean"),
                F.coalesce(F.nullif(F.col(f"s{i}"), F.lit(0.0)), F.lit(1.0)).alias("scale"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return row.select(F.explode(cells).alias("p")).select("p.*")


def scale(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardise ``columns`` in place with a fitted scaler table (one row per column), read back as two numbers a column."""
    fitted = scaler.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "scale")))).alias("m")
    ).first()["m"]
    number = lambda c, part: F.lit(fitted[c][part] if c in fitted else None).cast("double")
    return df.withColumns({c: (F.col(c) - number(c, "mean")) / number(c, "scale") for c in columns})
