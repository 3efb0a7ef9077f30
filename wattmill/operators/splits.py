"""Train / validation / test splits, folds and exact samples that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.functions.hashing import hash_number, row_key
from wattmill.operators.quantiles import order_statistics
from wattmill.session import stage

# Shares, seed, folds, and the years a temporal split needs.
SEED = 42
TRAIN, VAL, TEST = 0.70, 0.15, 0.15
FOLDS = 5
TEST_YEARS = 2
VAL_YEARS = 2
MIN_YEARS = 6
BUCKETS = 10_000


def bucket(key: Sequence[str], seed: int = SEED, buckets: int = BUCKETS) -> Column:
    """Stable bucket number of a row."""
    return F.pmod(hash_number(row_key(key), seed), F.lit(buckets)).cast("int")


def random_split(df: DataFrame, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """Add ``split`` by hash bucket: 70 / 15 / 15 in expectation, no shuffle."""
    place = bucket(key, seed)
    train_end, val_end = int(BUCKETS * TRAIN), int(BUCKETS * (TRAIN + VAL))
    return df.withColumn(
        "split", F.when(place < train_end, F.lit("train")).when(place < val_end, F.lit("val")).otherwise(F.lit("test"))
    )


def exact_sizes(rows: int) -> tuple[int, int]:
    """Sizes of the test and validation parts of ``rows`` rows (both rounded up)."""
    test = ceil(rows * TEST)
    return test, ceil((rows - test) * (VAL / (TRAIN + VAL)))


def _with_place(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    return df.withColumn("_place", hash_number(row_key(key), seed, 13))


def _order_cut(placed: DataFrame, ranks: dict[str, int], rows: int) -> dict[str, int]:
    """Hash values at the given 1-based ranks; -1 for rank 0."""
    wanted = {name: (F.col("_place"), rank - 1) for name, rank in ranks.items() if rank > 0}
    found = order_statistics(placed, wanted, rows).first().asDict() if wanted else {}
    return {name: int(found[name]) if name in found else -1 for name in ranks}


def exact_split(df: DataFrame, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """Like :func:`random_split` but with exact part sizes.

    Rows are ranked by a 52-bit hash. Only the hash values at the two cut ranks
    are looked up; assigning the rows is then a comparison, not a sort.
    ``key`` must identify a row. The hashes are written once: four scans look ranks up in them.
    """
    placed = _with_place(df, key, seed)
    places = stage(placed.select("_place"), "places")
    rows = places.count()
    test, val = exact_sizes(rows)
    cut = _order_cut(places, {"test": test, "val": test + val}, rows)
    named = F.when(F.col("_place") <= cut["test"], F.lit("test")).when(F.col("_place") <= cut["val"], F.lit("val"))
    return placed.withColumn("split", named.otherwise(F.lit("train"))).drop("_place")


def sample_rows(df: DataFrame, key: Sequence[str], most: int, seed: int = SEED) -> DataFrame:
    """At most ``most`` rows without replacement, all rows when there are no more than that.

    Rows whose hash ties at the cut are taken in order of ``key``, so the number is exact even where keys repeat.
    The hashes are written once: five scans look ranks up in them.
    """
    placed = _with_place(df, key, seed)
    places = stage(placed.select("_place"), "places")
    rows = places.count()
    if rows <= most:
        return df
    cut = _order_cut(places, {"last": most}, rows)
    counts = places.agg(F.count_if(F.col("_place") < cut["last"]).alias("below"), F.count_if(F.col("_place") == cut["last"]).alias("tied")).first()
    if counts["below"] + counts["tied"] <= most:
        return placed.where(F.col("_place") <= cut["last"]).drop("_place")
    last = placed.where(F.col("_place") == cut["last"]).orderBy(*key).limit(most - counts["below"])
    return placed.where(F.col("_place") < cut["last"]).unionByName(last).drop("_place")


def year_list(df: DataFrame, year: str = "year") -> Column:
    """Distinct years, newest first, as a scalar subquery (years are few by nature)."""
    return df.agg(F.sort_array(F.collect_set(F.col(year).cast("int")), asc=False)).scalar()


def temporal_split(df: DataFrame, year: str = "year") -> DataFrame:
    """Add ``split``: newest two years test, the two before validation, the rest training."""
    years = df.select(F.sort_array(F.collect_set(F.col(year).cast("int")), asc=False)).first()[0]
    test, val = years[:TEST_YEARS], years[TEST_YEARS : TEST_YEARS + VAL_YEARS]
    at = F.col(year).cast("int")
    return df.withColumn("split", F.when(at.isin(test), F.lit("test")).when(at.isin(val), F.lit("val")).otherwise(F.lit("train")))


def split_rows(df: DataFrame, key: Sequence[str], mode: str = "temporal", year: str = "year") -> DataFrame:
    """Temporal split when there are enough years, else the random one."""
    if mode == "temporal" and year in df.columns:
        if df.select(year).distinct().count() >= MIN_YEARS:
            return temporal_split(df, year)
    return random_split(df, key)


def train_years(df: DataFrame, year: str = "year") -> DataFrame:
    """Years that belong to neither the test nor the validation part."""
    seen = df.select(year).distinct()
    held = F.slice(year_list(df, year), 1, TEST_YEARS + VAL_YEARS)
    return seen.exceptAll(seen.where(F.array_contains(held, F.col(year).cast("int"))))


def with_fold(df: DataFrame, key: Sequence[str], folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Add ``fold`` in ``0 .. folds-1``."""
    return df.withColumn("fold", F.pmod(bucket(key, seed + 1), F.lit(folds)).cast("int"))


def split_summary(df: DataFrame, year: str = "year") -> DataFrame:
    """Rows, share and sorted years per split."""
    total = df.agg(F.count(F.lit(1))).scalar()
    parts = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array_join(F.array_sort(F.collect_set(F.col(year).cast("int"))).cast("array<string>"), ", ").alias("years"),
    )
    return parts.withColumn("share_pct", F.col("n_rows") * 100.0 / total)
