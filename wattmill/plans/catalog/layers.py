"""Queries over sources, sinks, streams, the text index and the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattmill.operators import cleaning as K
from wattmill.operators import encoding as N
from wattmill.operators import features as X
from wattmill.operators import models as L
from wattmill.operators import reports as P
from wattmill.operators import runs as R
from wattmill.operators import splits as S
from wattmill.plans import indexing
from wattmill.plans import medallion as M
from wattmill.plans.catalog.cleaning import ALL, CASCADE_SQL, SILVER_SQL
from wattmill.plans.catalog.learning import ENCODED_SQL, TEMPORAL_SQL, temporal
from wattmill.plans.catalog.text import CHUNK_SQL, CHUNKS_SQL, _LOW
from wattmill.plans.registry import query
from wattmill.plans.rounding import rounded
from wattmill.plans.text_views import EXPERIMENT, PROJECT, RUNS_SQL, markdown_docs, runs_wide, sql_cut_at_word
from wattmill.plans.views import KEY, PLAIN, USAGE_SQL, texts, usage, usage_dirty
from wattmill.session import scratch_path, stage
from wattmill.sources import files as D
from wattmill.sources import layers as W
from wattmill.streaming import jobs as J

DRIFT_YEAR = 1998


def yearly_files(spark, sf):
    """Usage written as one CSV folder per year; early years lack a column and order the others differently."""
    folder = scratch_path(spark, "yearly")
    rows = usage(spark, sf).withColumn("file", F.concat(F.lit("electricity_20"), F.right((F.col("year") + 100).cast("string"), F.lit(2))))
    early = [c for c in reversed(PLAIN) if c not in ("smartmeter_perc", "year")]
    late = [c for c in PLAIN if c != "year"] + ["order_key"]
    writer = lambda df: df.write.mode("append").partitionBy("file").option("header", "true")
    writer(rows.where(F.col("year") <= DRIFT_YEAR).select(*early, "file")).csv(folder)
    writer(rows.where(F.col("year") > DRIFT_YEAR).select(*late, "file")).csv(folder)
    return folder


# years 1995-2001 appear in file names as 20xx with their last two digits
_FILE_YEAR = "2000 + year % 100"
YEARLY_SQL = f"""WITH {USAGE_SQL} SELECT CAST({_FILE_YEAR} AS INTEGER) AS year, count(*) AS n,
  round(sum(annual_consume) + 1e-8, 2) AS kwh, count(smartmeter_perc) FILTER (WHERE year > 1998) AS with_meter,
  count(DISTINCT city) AS cities FROM usage GROUP BY year"""


def _per_year(rows):
    typed = K.coerce_numbers(rows)
    return typed.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("annual_consume") + 1e-8, 2).alias("kwh"),
        F.count("smartmeter_perc").alias("with_meter"), F.countDistinct("city").alias("cities"),
    )


@query("csv_header_drift", YEARLY_SQL)
def csv_header_drift(spark, sf):
    return _per_year(D.read_yearly(spark, D.discover(spark, yearly_files(spark, sf))))


@query("ledger_ingest", YEARLY_SQL)
def ledger_ingest(spark, sf):
    """Files land once: the second run of the stream finds nothing new."""
    folder, landing = yearly_files(spark, sf), scratch_path(spark, "landing")
    for _ in range(2):
        J.ingest_files(spark, folder, landing, f"{landing}/state")
    return _per_year(J.landed(spark, landing))


@query(
    "ingest_manifest",
    f"WITH {USAGE_SQL} SELECT count(DISTINCT year) AS years, CAST(0 AS BIGINT) AS new_files, TRUE AS all_skipped FROM usage",
)
def ingest_manifest(spark, sf):
    folder, landing = yearly_files(spark, sf), scratch_path(spark, "landing")
    J.ingest_files(spark, folder, landing, f"{landing}/state")
    listed, noted = D.list_files(spark, folder), J.ledger(spark, landing)
    years = J.manifest_rows(listed, noted).agg(F.countDistinct(D.year_of(F.col("path"))).alias("years"))
    found = J.manifest(listed, noted).withColumn("years", years.scalar())
    return found.select("years", "new_files", (F.col("skipped_files") == F.col("total_files")).alias("all_skipped"))


@query(
    "stream_tokens",
    """WITH w AS (SELECT conv_id, role, len(string_split(text, ' ')) AS words FROM conversations)
SELECT conv_id, CAST(coalesce(sum(words) FILTER (WHERE role = 'user'), 0) AS BIGINT) AS input_tokens,
  CAST(coalesce(sum(words) FILTER (WHERE role <> 'user'), 0) AS BIGINT) AS output_tokens,
  CAST(sum(words) AS BIGINT) AS total_tokens, count(*) AS message_count FROM w GROUP BY conv_id""",
)
def stream_tokens(spark, sf):
    """Running token totals kept by a stream over the conversation file."""
    target = scratch_path(spark, "totals")
    schema = spark.read.parquet(f"{sf}/conversations.parquet").schema
    # a pattern, so that a single file and a folder of part files are read alike
    turns = spark.readStream.schema(schema).parquet(f"{sf}/conversations.parque[t]")
    words = F.size(F.split("text", " ")).cast("long")
    user = F.col("role") == "user"
    used = turns.select(
        "conv_id", F.when(user, words).alias("input_tokens"), F.when(~user, words).alias("output_tokens"), words.alias("total_tokens")
    )
    J.token_totals(used, f"{target}/rows", f"{target}/state", key="conv_id")
    found = J.latest_totals(spark, f"{target}/rows")
    if found is None:
        return spark.createDataFrame([], "conv_id long, input_tokens long, output_tokens long, total_tokens long, message_count long")
    return found


@query("layer_roundtrip", f"WITH {SILVER_SQL} SELECT year, count(*) AS n, round(sum(log_target) + 1e-8, 4) AS logs FROM silver GROUP BY year")
def layer_roundtrip(spark, sf):
    """Cleaned rows through the layered sink: written by year, marked complete, not rebuilt the second time."""
    root = scratch_path(spark, "layers")

    def build():
        valid = stage(K.apply_rules(usage_dirty(spark, sf).select(*ALL)), "valid-rows")
        return X.silver_features(K.below_quantile(valid, "annual_consume"))

    def rebuilt():
        raise AssertionError("a finished stage was built again")

    W.run_stage(spark, root, "silver", build, by=["year"])
    rows = W.run_stage(spark, root, "silver", rebuilt, by=["year"])
    return rounded(rows.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("log_target").alias("logs")), ["logs"], 4)


@query(
    "gold_roundtrip",
    f"WITH {ENCODED_SQL} SELECT split, count(*) AS n, round(avg(city_te) + 1e-8, 4) AS city_te, round(avg(log_target) + 1e-8, 4) AS log_target FROM enc GROUP BY split",
)
def gold_roundtrip(spark, sf):
    """Encoded rows, encoder and scaler through the gold sink and back."""
    path = scratch_path(spark, "gold")
    rows = temporal(spark, sf)
    train = rows.where(F.col("split") == "train")
    sums = N.fit_target_means(train, N.ENCODED)
    coded = N.encode(rows, sums, N.global_mean(train))
    names = ["num_connections", "city_te"]
    scaler = N.fit_scaler(train.withColumn("city_te", F.lit(0.0)), names)
    W.save_gold(path, coded.select(*KEY, *names, "log_target", "split"), sums, scaler, names, S.SEED)
    back, features = W.load_gold(spark, path)
    means = back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg(features[1]).alias("city_te"), F.avg("log_target").alias("log_target"))
    return rounded(means, ["city_te", "log_target"], 4)


@query("result_table", f"WITH {USAGE_SQL} SELECT CAST(year AS VARCHAR) AS year, CAST(count(*) AS VARCHAR) AS n FROM usage GROUP BY year")
def result_table(spark, sf):
    path = scratch_path(spark, "table")
    W.write_result_table(usage(spark, sf).groupBy("year").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.option("header", "true").csv(path)


@query("text_lines", "SELECT count(*) AS n, CAST(sum(length(url)) AS BIGINT) AS chars FROM pages")
def text_lines(spark, sf):
    path = scratch_path(spark, "lines")
    W.write_lines(spark.read.parquet(f"{sf}/pages.parquet"), path, "url")
    back = spark.read.text(path)
    return back.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars"))


@query("model_roundtrip", f"WITH {TEMPORAL_SQL} SELECT count(*) AS n, TRUE AS same FROM parts WHERE split = 'test'")
def model_roundtrip(spark, sf):
    """A saved and loaded model predicts what the original predicts."""
    from pyspark.ml.regression import LinearRegressionModel

    rows = L.assemble(temporal(spark, sf), ["num_connections", "year"])
    model = L.fit(rows.where(F.col("split") == "train"), L.LINEAR)
    path = scratch_path(spark, "model")
    L.save_model(model, path)
    held = rows.where(F.col("split") == "test")
    both = L.predict(L.load_model(LinearRegressionModel, path), L.predict(model, held, "a"), "b")
    return both.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("a") == F.col("b")).alias("same"))


# --- the text index ---------------------------------------------------------------------------------
INDEX_SQL = f"""WITH {CHUNK_SQL}, {CHUNKS_SQL}
SELECT doc_id || ':' || section_no || ':' || piece_no AS id, text, source, 384 AS dim FROM rich WHERE NOT {_LOW}
UNION ALL SELECT 'mlflow:' || run_id || ':' || section, {sql_cut_at_word('text')}, 'mlflow_metadata', 384 FROM parts"""


@query("index_build", INDEX_SQL)
def index_build(spark, sf):
    """All runs, then documents and all runs, to embedded chunks, each written replace-all; readers see the last.

    The chunks of the runs are embedded once: the second version takes them from the first.
    """
    root = scratch_path(spark, "index")
    docs, history = markdown_docs(spark, sf), R.from_wide(runs_wide(spark, sf))
    W.replace_all(indexing.build_index(None, history, PROJECT, EXPERIMENT), root)
    W.replace_all(indexing.build_index(docs, None, PROJECT, EXPERIMENT).unionByName(W.read_current(spark, root)), root)
    return W.read_current(spark, root).select("id", "text", "source", F.size("text_vector").alias("dim"))


@query(
    "reindex_changes",
    f"""WITH {RUNS_SQL}, best AS (SELECT run_id FROM runs ORDER BY run_id LIMIT 1)
SELECT 'doc' AS kind, 'added' AS change, count(*) AS n FROM documents WHERE doc_id % 7 = 3
UNION ALL SELECT 'doc', 'changed', count(*) FROM documents WHERE doc_id % 7 = 1
UNION ALL SELECT 'doc', 'removed', count(*) FROM documents WHERE doc_id % 7 = 2
UNION ALL SELECT 'run', 'changed', count(*) FROM best
UNION ALL SELECT 'kept', 'unchanged', (SELECT count(*) FROM documents WHERE doc_id % 7 NOT IN (1, 2, 3)) + (SELECT count(*) FROM runs) - 1""",
)
def reindex_changes(spark, sf):
    """An index refreshed after documents came, changed and went and one run changed: what each refresh touched."""
    root = scratch_path(spark, "refreshed")
    docs, history = stage(markdown_docs(spark, sf), "documents"), stage(R.from_wide(runs_wide(spark, sf)), "runs")
    turn = F.col("doc_id") % 7
    indexing.refresh(spark, root, 0, docs.where(turn != 3), history, PROJECT, EXPERIMENT)
    edited = docs.where(turn != 2).withColumn("text", F.when(turn == 1, F.concat("text", F.lit("\n## Nachtrag\nein Satz mehr"))).otherwise(F.col("text")))
    first = history.agg(F.min("run_id")).first()[0]
    later = history.withColumn("status", F.when(F.col("run_id") == first, F.concat("status", F.lit("_AGAIN"))).otherwise(F.col("status")))
    changes = indexing.refresh(spark, root, 1, edited, later, PROJECT, EXPERIMENT)
    told = changes.groupBy(F.substring_index("key", ":", 1).alias("kind"), "change").agg(F.count(F.lit(1)).alias("n"))
    marks = indexing.fingerprints(spark, root)
    kept = marks.join(changes.where("change <> 'removed'"), "key", "left_anti")
    return told.unionByName(kept.agg(F.lit("kept").alias("kind"), F.lit("unchanged").alias("change"), F.count(F.lit(1)).alias("n")))


@query("table_append", "SELECT count(*) * 2 AS n, count(DISTINCT page_id) AS pages FROM pages")
def table_append(spark, sf):
    root = scratch_path(spark, "appended")
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    W.append_rows(pages, root)
    W.append_rows(pages, root)
    return W.read_current(spark, root).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("page_id").alias("pages"))


@query(
    "append_run_history",
    f"WITH {RUNS_SQL} SELECT count(*) AS n, count(DISTINCT run_id) AS runs FROM runs",
)
def append_run_history(spark, sf):
    path = scratch_path(spark, "runs")
    R.from_wide(runs_wide(spark, sf)).write.mode("append").parquet(path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("run_id").alias("runs"))


@query(
    "change_detection",
    "SELECT doc_id FROM documents WHERE lang = 'fr'",
)
def change_detection(spark, sf):
    """Documents whose fingerprint differs from the last one stored; the others are skipped."""
    stored = texts(spark, sf).select("doc_id", F.sha2("text", 256).alias("fingerprint"))
    edited = F.when(F.col("lang") == "fr", F.concat("text", F.lit("."))).otherwise(F.col("text"))
    now = texts(spark, sf).select("doc_id", F.sha2(edited, 256).alias("fingerprint"))
    return now.join(stored, ["doc_id", "fingerprint"], "left_anti").select("doc_id")


# --- reports ----------------------------------------------------------------------------------------
_CASCADE_ITEMS = [
    "initial_rows", "removed_duplicates", "removed_invalid_consume", "removed_invalid_connections",
    *[f"removed_{c}_out_of_range" for c in K.PERCENTS], "removed_outliers_annual_consume", "outlier_threshold_annual_consume_kwh",
    "rows_after_cleaning", "removed_outliers_consume_per_conn", "outlier_threshold_consume_per_conn", "final_rows",
]
_GAP_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS item, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS total FROM silver" for c in P.REPORTED_GAPS
)
SILVER_REPORT_SQL = (
    CASCADE_SQL.replace("SELECT (SELECT count(*) FROM dirty) AS initial_rows", ", cas AS (SELECT (SELECT count(*) FROM dirty) AS initial_rows", 1)
    + f"), gaps AS ({_GAP_SQL}), rep AS ("
    + " UNION ALL ".join(
        [f"SELECT 'coverage' AS section, '{n}' AS item, '' AS metric, CAST({e} AS DOUBLE) AS value FROM silver"
         for n, e in [("first_year", "min(year)"), ("last_year", "max(year)"), ("span", "max(year) - min(year) + 1")]]
        + [f"SELECT 'cardinality', '{c}', '', count(DISTINCT {c}) FROM silver" for c in P.REPORTED_KEYS]
        + [f"SELECT 'cleaning', '{c}', '', {c} FROM cas" for c in _CASCADE_ITEMS]
        + ["SELECT 'missing', item, 'missing', missing FROM gaps WHERE missing > 0",
           "SELECT 'missing', item, 'share_pct', 100.0 * missing / total FROM gaps WHERE missing > 0"]
        + [f"SELECT 'profile', '{c}', '{m}', {f}({c}{x}) FROM silver" for c in P.REPORTED
           for m, f, x in [("mean", "avg", ""), ("std", "stddev_samp", ""), ("min", "min", ""), ("median", "quantile_cont", ", 0.5"), ("max", "max", "")]]
    )
    + ") SELECT section, item, metric, round(value + 1e-8, 4) AS value FROM rep"
)


@query("report_silver", SILVER_REPORT_SQL)
def report_silver(spark, sf):
    raw = usage_dirty(spark, sf).select(*ALL)
    folded = K.fold_copies(raw, ALL)
    valid = K.apply_rules(folded.drop("copies"), K.FOLDED)
    silver = stage(X.silver_features(K.below_quantile(valid, "annual_consume")), "silver-rows")
    return rounded(P.silver_report(silver, K.cascade_counts(raw, ALL, folded)), ["value"], 4)


_GOLD_FEATURES = ["num_connections", "delivery_perc", "amperage", "year"]
_WHOLE = " AND ".join(f"{c} IS NOT NULL" for c in [*_GOLD_FEATURES, "log_target"])
GOLD_REPORT_SQL = (
    f"WITH {SILVER_SQL}, yr AS (SELECT year, row_number() OVER (ORDER BY year DESC) AS k FROM (SELECT DISTINCT year FROM silver WHERE {_WHOLE})), "
    f"gold AS (SELECT silver.*, CASE WHEN k <= 2 THEN 'test' WHEN k <= 4 THEN 'val' ELSE 'train' END AS split FROM silver JOIN yr USING (year) WHERE {_WHOLE}), "
    "gaps AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS item, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS total FROM silver" for c in [*_GOLD_FEATURES, "log_target"]
    ) + "), rep AS ("
    + f"SELECT 'lineage' AS section, 'received' AS item, '' AS metric, CAST(count(*) AS DOUBLE) AS value FROM silver UNION ALL "
    + f"SELECT 'lineage', 'dropped', '', count(*) FILTER (WHERE NOT ({_WHOLE})) FROM silver UNION ALL SELECT 'lineage', 'used', '', count(*) FROM gold UNION ALL "
    + "SELECT 'missing', item, 'missing', missing FROM gaps WHERE missing > 0 UNION ALL SELECT 'missing', item, 'share_pct', 100.0 * missing / total FROM gaps WHERE missing > 0 UNION ALL "
    + "SELECT 'split', split, 'rows', count(*) FROM gold GROUP BY split UNION ALL SELECT 'split', split, 'share_pct', 100.0 * count(*) / (SELECT count(*) FROM gold) FROM gold GROUP BY split UNION ALL "
    + " UNION ALL ".join(f"SELECT 'feature', '{f}', '', {i}" for i, f in enumerate(_GOLD_FEATURES)) + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT 'target', '{n}', '', {e} FROM gold WHERE split = 'train'"
        for n, e in [("mean", "avg(log_target)"), ("std", "stddev_samp(log_target)"), ("min", "min(log_target)"), ("max", "max(log_target)"),
                     ("mean_kwh", "exp(avg(log_target)) - 1"), ("median", "quantile_cont(log_target, 0.5)"), ("median_kwh", "exp(quantile_cont(log_target, 0.5)) - 1")]
    )
    + ") SELECT section, item, metric, round(value + 1e-8, 4) AS value FROM rep"
)


@query("report_gold", GOLD_REPORT_SQL)
def report_gold(spark, sf):
    valid = stage(K.apply_rules(usage_dirty(spark, sf).select(*ALL)), "valid-rows")
    silver = stage(X.silver_features(K.below_quantile(valid, "annual_consume")), "silver-rows")
    gold = stage(S.temporal_split(K.drop_missing(silver, [*_GOLD_FEATURES, "log_target"])), "gold-rows")
    return rounded(P.gold_report(silver, gold, _GOLD_FEATURES), ["value"], 4)


@query("report_training")
def report_training(spark, sf):
    """Report rows of a small boosted fit over all rows: metrics, parameters, importance shares."""
    names = ["num_connections", "delivery_perc", "smartmeter_perc", "year"]
    model, record = L.run_record(temporal(spark, sf), L.TRAINING_GBT.but(trees=5), names, "run-1", library=True)
    return P.training_report(stage(record, "record"), L.importances(model, names, spark)).where(F.col("item") != "train_duration_sec")


@query("medallion")
def medallion(spark, sf):
    """The whole layered load over yearly files derived from the order tables."""
    root = scratch_path(spark, "medallion")
    report = M.run(spark, yearly_files(spark, sf), root, settings=L.TRAINING_GBT)
    return report.where(F.col("item") != "train_duration_sec")
