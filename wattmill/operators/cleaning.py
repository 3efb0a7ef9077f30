"""Cleaning rules over consumption rows, and the counts each rule leaves behind."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.functions.numeric import safe_ratio, to_number
from wattmill.operators.quantiles import quantile_value, quantiles
from wattmill.session import stage

# Column roles and the outlier quantile.
CATEGORIES = ["net_manager", "purchase_area", "city", "type_of_connection"]
NUMBERS = [
    "num_connections", "delivery_perc", "perc_of_active_connections", "type_conn_perc",
    "annual_consume", "annual_consume_lowtarif_perc", "smartmeter_perc",
]
PERCENTS = [c for c in NUMBERS if "perc" in c]
RAW_COLUMNS = CATEGORIES[:3] + NUMBERS[:3] + CATEGORIES[3:] + NUMBERS[3:]
OUTLIER_QUANTILE = 0.995
NOT_FEATURES = [
    "consume_per_conn", "annual_consume", "city", "net_manager", "purchase_area", "type_of_connection", "log_target",
]


@dataclass(frozen=True)
class CleaningPreset:
    """Which rules run. The layered load runs all; the exploration scripts only two."""

    drop_copies: bool = True
    check_connections: bool = True
    check_percents: bool = True


LAYERED = CleaningPreset()
FOLDED = CleaningPreset(drop_copies=False)
EXPLORATION = CleaningPreset(drop_copies=False, check_connections=False, check_percents=False)


def coerce_numbers(df: DataFrame, columns: Sequence[str] = NUMBERS, kind: str = "double") -> DataFrame:
    """Turn text columns into numbers; what does not parse becomes null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_number(F.col(c).cast("string"), kind) for c in present})


def drop_copies(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep one of each set of identical rows. Copies collapse before the shuffle."""
    return df.dropDuplicates(list(columns) if columns else None)


def valid_target(column: str = "annual_consume") -> Column:
    return F.col(column).isNotNull() & (F.col(column) > 0)


def valid_count(column: str = "num_connections") -> Column:
    return F.col(column).isNotNull() & (F.col(column) > 0)


def percents_in_range(columns: Iterable[str]) -> Column:
    """True when every column is null or within 0 to 100."""
    return reduce(lambda a, b: a & b, [F.col(c).isNull() | F.col(c).between(0, 100) for c in columns], F.lit(True))


def below_quantile(
    df: DataFrame, column: str, prob: float = OUTLIER_QUANTILE, fit: DataFrame | None = None, low: float | None = None
) -> DataFrame:
    """Keep rows up to the exact quantile (``<=``), optionally from ``low`` on.

    ``fit`` gives the rows the quantile is taken from, for instance the training rows only.
    """
    limit = quantile_value(fit if fit is not None else df, F.col(column), prob)
    keep = F.col(column) <= limit
    return df.where(keep if low is None else keep & (F.col(column) >= F.lit(low)))


def rule_passes(df: DataFrame, preset: CleaningPreset = LAYERED) -> list[tuple[str, Column]]:
    """The row rules of a preset in the order they apply, limited to columns that exist."""
    rules = [("invalid_consume", valid_target())]
    if preset.check_connections and "num_connections" in df.columns:
        rules.append(("invalid_connections", valid_count()))
    if preset.check_percents:
        rules += [(f"{c}_out_of_range", percents_in_range([c])) for c in PERCENTS if c in df.columns]
    return rules


def apply_rules(df: DataFrame, preset: CleaningPreset = LAYERED, copies_by: Sequence[str] | None = None) -> DataFrame:
    """Copies and row rules, without the outlier rule."""
    if preset.drop_copies:
        df = drop_copies(df, copies_by)
    for _, passes in rule_passes(df, preset):
        df = df.where(passes)
    return df


def clean(df: DataFrame, preset: CleaningPreset = LAYERED, copies_by: Sequence[str] | None = None) -> DataFrame:
    """All rules of a preset, then the upper outlier rule on what they leave.

    What the row rules leave is written once: the quantile reads one column of it twice and the filter the rest, instead of
    evaluating ``df`` for each.
    """
    return below_quantile(stage(apply_rules(df, preset, copies_by), "ruled-rows"), "annual_consume")


def per_connection(df: DataFrame) -> DataFrame:
    """Add the target ``consume_per_conn``; rows without a positive one go."""
    ratio = safe_ratio(F.col("annual_consume"), F.col("num_connections"))
    return df.withColumn("consume_per_conn", ratio).where(valid_target("consume_per_conn"))


def first_failed_rule(df: DataFrame, preset: CleaningPreset = LAYERED) -> Column:
    """Name of the first rule a row breaks, null when it passes all."""
    verdict = F.lit(None).cast("string")
    for name, passes in reversed(rule_passes(df, preset)):
        verdict = F.when(~passes, F.lit(name)).otherwise(verdict)
    return verdict


def fold_copies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of each set of identical rows with the number of its ``copies``, written once."""
    return stage(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")), "folded-rows")


def cascade_counts(df: DataFrame, columns: Sequence[str], folded: DataFrame | None = None) -> DataFrame:
    """One row of cleaning statistics, the counts in the order the rules apply.

    Copies are folded to one row with a multiplicity first (``folded``, where :func:`fold_copies` did so already), so the copy count
    and every rule count come from one more scan. The two thresholds are
    single numbers and are read back, which lets the last scan filter on literals.
    """
    folded = fold_copies(df, columns) if folded is None else folded
    marked = folded.withColumn("rule", first_failed_rule(folded))
    survivors = marked.where(F.col("rule").isNull())
    cut = quantiles(survivors, {"q": (F.col("annual_consume"), OUTLIER_QUANTILE)}).first()["q"]
    target = per_connection(survivors.where(F.col("annual_consume") <= F.lit(cut)))
    cut2 = quantiles(target, {"q": (F.col("consume_per_conn"), OUTLIER_QUANTILE)}).first()["q"]
    low = F.col("rule").isNull() & (F.col("annual_consume") <= F.lit(cut))
    ratio = safe_ratio(F.col("annual_consume"), F.col("num_connections"))
    return marked.agg(
        F.sum("copies").alias("initial_rows"),
        (F.sum("copies") - F.count(F.lit(1))).alias("removed_duplicates"),
        *[F.count_if(F.col("rule") == name).alias(f"removed_{name}") for name, _ in rule_passes(df)],
        F.count_if(F.col("rule").isNull() & ~low).alias("removed_outliers_annual_consume"),
        F.round(F.lit(cut), 2).alias("outlier_threshold_annual_consume_kwh"),
        F.count_if(low).alias("rows_after_cleaning"),
        F.count_if(low & (ratio > F.lit(cut2))).alias("removed_outliers_consume_per_conn"),
        F.round(F.lit(cut2), 2).alias("outlier_threshold_consume_per_conn"),
        F.count_if(low & (ratio <= F.lit(cut2))).alias("final_rows"),
    )


def as_long(one_row: DataFrame, item: str = "item", value: str = "value") -> DataFrame:
    """Turn a one-row frame into ``(item, value)`` rows, values as doubles."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias(item), F.col(c).cast("double").alias(value)) for c in one_row.columns]
    )
    return one_row.select(F.explode(pairs).alias("p")).select(f"p.{item}", f"p.{value}")


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, and missing values per column, as ``(item, missing, total)``; only columns with any."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in columns]
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("item"), F.col(f"m_{c}").alias("missing")) for c in columns])
    return (
        counts.select("total", F.explode(pairs).alias("p"))
        .select("p.item", "p.missing", "total")
        .where(F.col("missing") > 0)
    )


def spread_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(item, varies)``: whether a column holds more than one distinct non-null value.

    Minimum against maximum answers that without a distinct count.
    """
    flags = df.agg(*[(F.min(c) < F.max(c)).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("item"), F.coalesce(F.col(c), F.lit(False)).alias("varies")) for c in columns]
    )
    return flags.select(F.explode(pairs).alias("p")).select("p.item", "p.varies")


def select_features(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> list[str]:
    """Numeric columns that are not excluded and vary, in column order."""
    numeric = [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)
    ]
    varying = {r["item"] for r in spread_of(df, numeric).where("varies").collect()}
    return [c for c in numeric if c in varying]


def fill_lags(df: DataFrame, columns: Sequence[str], median: Column, deviations: Sequence[str]) -> DataFrame:
    """Missing lag means become the global median, missing deviations zero."""
    return df.withColumns(
        {
            **{c: F.coalesce(F.col(c), median) for c in columns},
            **{c: F.coalesce(F.col(c), F.lit(0.0)) for c in deviations},
        }
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rename nothing, drop strangers, add missing columns as typed nulls."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
