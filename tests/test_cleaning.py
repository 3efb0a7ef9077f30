"""Cleaning and features on small literal tables with hand-computed results."""

import math

import pytest
from pyspark.sql import functions as F

from wattmill.functions.numeric import amperage, from_log, to_number
from wattmill.operators import cleaning as C
from wattmill.operators import features as X

COLUMNS = [*C.RAW_COLUMNS, "year"]


def thirty_rows(spark):
    rows = []
    for i in range(30):
        low = i < 15
        rows.append(
            (
                "Manager A" if low else "Manager B", "Area A" if low else "Area B", f"City_{i}", 20.0 if low else 30.0, 90.5, 95.0,
                "3x25" if low else "1x35", 80.0, 4000.0 if low else 6000.0, 50.0 if low else 70.0, 10.0 if low else 20.0, 2018,
            )
        )
    return spark.createDataFrame(rows, ", ".join(f"{c} {'string' if c in C.CATEGORIES else 'int' if c == 'year' else 'double'}" for c in COLUMNS))


def test_layered_features(spark):
    out = X.silver_features(C.clean(thirty_rows(spark))).collect()
    assert len(out) == 30
    assert {r["amperage"] for r in out} == {75.0, 35.0}
    assert {r["consume_per_conn"] for r in out} == {200.0}
    assert {r["total_capacity"] for r in out} == {1500.0, 1050.0}
    assert {r["hightarif_perc"] for r in out} == {50.0, 30.0}
    assert all(math.isclose(r["log_target"], math.log1p(200.0)) for r in out)


def test_copies_and_bad_targets(spark):
    rows = thirty_rows(spark).limit(1)
    copies = rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5)))).drop("n")
    assert C.drop_copies(copies).count() == 1
    bad = rows.withColumn("annual_consume", F.explode(F.array(F.lit(0.0), F.lit(-100.0), F.lit(2000.0))))
    assert C.clean(bad).count() == 1
    no_count = rows.withColumn("num_connections", F.explode(F.array(F.lit(0.0), F.lit(None), F.lit(3.0))))
    assert C.clean(no_count).count() == 1
    assert C.clean(no_count, C.EXPLORATION).count() == 3


def test_percent_rule_keeps_nulls_and_bounds(spark):
    rows = spark.createDataFrame([(0.0,), (100.0,), (None,), (100.1,), (-0.1,)], "smartmeter_perc double")
    assert rows.where(C.percents_in_range(["smartmeter_perc"])).count() == 3


def test_numbers_and_amperage(spark):
    rows = spark.createDataFrame([("1.5",), (" 1.5 ",), ("abc",), ("NaN",), ("",), (None,)], "s string")
    assert [r[0] for r in rows.select(to_number(F.col("s"))).collect()] == [1.5, 1.5, None, None, None, None]
    labels = spark.createDataFrame([("3x25",), (" 3x25A",), ("x25",), ("a3x25",), ("nan",), (None,)], "s string")
    assert [r[0] for r in labels.select(amperage(F.col("s"))).collect()] == [75.0, 75.0, None, None, None, None]


def test_missing_and_feature_choice(spark):
    rows = spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, 5.0), (1.0, None, 5.0)], "a double, b double, c double")
    found = {r["item"]: r["missing"] for r in C.missing_counts(rows, ["a", "b", "c"]).collect()}
    assert found == {"b": 1, "c": 1}
    assert C.select_features(rows) == ["b"]
    assert C.drop_missing(rows, ["b", "c"]).count() == 1


def test_lag_is_by_calendar_and_rolling_by_row(spark):
    rows = spark.createDataFrame(
        [("a", 2010, 10.0), ("a", 2010, 20.0), ("a", 2011, 30.0), ("a", 2014, 50.0), ("b", 2014, 70.0), (None, 2014, 90.0)],
        "city string, year int, consume_per_conn double",
    )
    got = {(r["city"], r["year"]): r for r in X.lag_features(rows, fill=False).distinct().collect()}
    assert got[("a", 2011)]["city_lag1_mean"] == 15.0
    assert got[("a", 2014)]["city_lag1_mean"] is None
    assert got[("a", 2014)]["city_rolling_mean3"] == pytest.approx((15.0 + 30.0) / 2)
    assert got[("a", 2010)]["city_rolling_mean3"] is None
    assert got[("b", 2014)]["national_year_mean"] == pytest.approx(70.0)
    assert got[(None, 2014)]["city_lag1_mean"] is None
    filled = X.lag_features(rows).where("city = 'a' and year = 2010").first()
    assert filled["city_lag1_mean"] == pytest.approx(40.0) and filled["city_vs_national"] == 0.0


def test_single_year_trend_is_null(spark):
    out = X.trend_features(C.per_connection(thirty_rows(spark))).first()
    assert out["year_trend"] is None and out["active_connections"] == 19.0


def test_from_log_clips(spark):
    row = spark.range(1).select(from_log(F.lit(-3.0)).alias("a"), from_log(F.lit(25.0), (-10.0, 20.0)).alias("b")).first()
    assert row["a"] == 0.0 and row["b"] == pytest.approx(math.expm1(20.0))
