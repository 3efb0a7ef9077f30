"""Text expressions against plain statements of their rules, on fixed and random strings."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from wattmill.functions import text as T
from wattmill.operators import answers as A
from wattmill.operators import chunking as K
from wattmill.operators import runs as R
from wattmill.operators import vectors as V
from wattmill.plans.catalog.text import whole_run_chunks


def apply(spark, expr, values, name="t"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, {name} string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col(name))).collect()]


def random_texts(n, seed, alphabet="ab c \n\t\xa0é"):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 120))) for _ in range(n)]


def pieces_by_hand(text, limit):
    """Walk the text: at most ``limit`` characters, back to the last blank when there is one."""
    out, rest, fresh = [], text, True
    while rest or fresh:
        if len(rest) <= limit:
            return out + [rest]
        blank = max((i for i in range(limit) if rest[i] == " "), default=None)
        here = limit if blank is None else blank
        out, rest, fresh = out + [rest[:here].strip()], rest[here:].strip(), False
    return out


@pytest.mark.parametrize("limit", [5, 12])
def test_bounded_pieces(spark, limit):
    texts = random_texts(300, limit) + ["", " ", "   lead", "a" * 40, "word " * 9 + "\n\n", " " * 30]
    assert apply(spark, lambda c: T.bounded_pieces(c, limit), texts) == [pieces_by_hand(t, limit) for t in texts]


def test_strip_lines_cut(spark):
    texts = random_texts(200, 3, "ab \n\r\x0b\x85 　") + ["\x1c a  "]
    assert apply(spark, T.strip, texts) == [t.strip() for t in texts]
    assert apply(spark, T.lines, texts) == [t.splitlines() for t in texts]

    def cut(t, n):
        t = t.strip()
        if len(t) <= n:
            return t
        at = t[:n].rfind(" ")
        return t[: n if at < 0 else at].strip()

    assert apply(spark, lambda c: T.cut_at_word(c, 20), texts) == [cut(t, 20) for t in texts]


def test_line_chunks(spark):
    rng = random.Random(9)
    texts = ["\n".join("x" * rng.randrange(0, 9) for _ in range(rng.randrange(0, 30))) for _ in range(80)]

    def by_hand(text, size, overlap):
        done, now = [], []
        for line in [s for s in text.split("\n") if s]:
            if now and len("\n".join(now)) + 1 + len(line) > size:
                done.append("\n".join(now))
                tails = [now[j:] for j in range(len(now) + 1)]
                now = next(
                    t for t in tails
                    if len("\n".join(t)) <= overlap and (not t or len("\n".join(t)) + 1 + len(line) <= size)
                )
            now = now + [line]
        return [c for c in done + ["\n".join(now)] if c.strip()]

    assert apply(spark, lambda c: K.line_chunks(c, 20, 6), texts) == [by_hand(t, 20, 6) for t in texts]


def test_sections_and_titles(spark):
    doc = "# Título\n## Processado em: 2024-05-01\n\nintro\n### Limpeza de dados\ntexto\n#### não\n##\nfim"
    parts = apply(spark, T.markdown_sections, [doc, "", "\n## a"])
    assert parts[0] == ["# Título", "## Processado em: 2024-05-01\n\nintro", "### Limpeza de dados\ntexto\n#### não\n##\nfim"]
    assert parts[1] == [] and parts[2] == ["", "## a"]
    assert apply(spark, T.document_title, [doc, "x"]) == ["Título", ""]
    assert apply(spark, T.section_title, parts[0]) == ["", "Processado em: 2024-05-01", "Limpeza de dados"]
    assert apply(spark, T.processed_at, [doc]) == ["2024-05-01"]


def test_low_value(spark):
    long = "palavra " * 20
    cases = {
        "curto": True, long: False, long + "[Aguardando treinamento MLflow]": True, "## " + long.strip(): True,
        "## Processado em: 2024-05-01T10:00:00 " + " " * 80: True, long + "\nProcessado em: 2024 - " + long: False,
        "Processado em: 2024" + " palavra" * 10: True,
        "Processado em: 2024-05" + " palavra" * 10: False,
    }
    assert apply(spark, T.is_low_value, list(cases)) == list(cases.values())


def test_markdown_chunks(spark):
    doc = "# Doc\n## Limpeza de dados\n" + "linha de texto " * 80 + "\n## Vazia\nx"
    df = spark.createDataFrame([("d", "silver_governance", doc)], "doc_id string, source string, text string")
    rows = K.markdown_chunks(df, ["doc_id"]).collect()
    assert len(rows) == 2
    assert all(r["text"].startswith("Limpeza de dados na camada Silver") and len(r["text"]) <= T.MAX_TEXT for r in rows)


def test_redaction(spark):
    h = "0123456789abcdef" * 2
    cases = {
        f"Run ID MLflow: {h}. RMSE: 0.34": "RMSE: 0.34",
        f"run id : {h.upper()} fim": "fim",
        f"antes {h}, depois   x": "antes , depois x",
        f"é{h} fica": f"é{h} fica",
        f"{h}0 fica": f"{h}0 fica",
        f"{h} {h}": "",
    }
    assert apply(spark, T.redact, list(cases)) == list(cases.values())


def test_artifacts_and_thinking(spark):
    raw = "<think>um\ndois</think>Resposta [gold_governance] .<tool_call>{}</tool_call><think>aberto"
    assert apply(spark, T.sanitize, [raw]) == ["Resposta."]
    assert apply(spark, T.thinking_blocks, [raw, "<|channel>thought\nx\n\ny", "nada"]) == [["um\ndois"], ["x"], []]
    assert apply(spark, T.is_bogus, ["", " search", "<think>x", "boa resposta", "A query será esta"]) == [True, True, True, False, True]


def test_metric_mentions_keep_first(spark):
    hits = spark.createDataFrame(
        [(1, 1, "- RMSE na validação: 1.5\nDuração MAE: 3"), (1, 2, "rmse na validação: 1.5\nMAPE teste: 7")],
        "response long, hit_no long, text string",
    )
    rows = A.metric_mentions(hits, "response").orderBy("hit_no", "turn", "place").collect()
    assert [r["entry"] for r in rows] == ["RMSE na validação: 1.5", "MAE: 3", "MAPE teste: 7"]


def test_bulleted_lines_repeat_plain_ones_do_not(spark):
    hits = spark.createDataFrame([(1, 1, "- limpeza\n- limpeza\nlimpeza\noutlier\noutlier")], "response long, hit_no long, text string")
    rows = A.keyword_lines(hits, "response").orderBy("place").collect()
    assert [r["snippet"] for r in rows] == ["limpeza", "limpeza", "outlier"]


def test_fallback_without_hits(spark):
    asked = spark.createDataFrame([(1, "oi")], "response long, question string")
    none = spark.createDataFrame([], "response long, hit_no long, text string")
    assert A.fallback_answers(asked, none, "response").first()["answer"] == T.EMPTY_ANSWER


def test_runs(spark):
    wide = spark.createDataFrame(
        [(f"run-id-{i}", "FINISHED", f"2024-01-0{i + 1}", 89.1 - 5 * i, 39.5 - 2 * i, None, "500") for i in range(3)],
        "run_id string, status string, start_time string, `metrics.rmse` double, `metrics.mae` double, `metrics.r2` double, `params.n_estimators` string",
    )
    runs = R.from_wide(wide)
    assert R.best_run(runs).first()["run_id"] == "run-id-2"
    assert runs.first()["metrics"] == {"rmse": 89.1, "mae": 39.5}
    chunks = R.run_chunks(R.with_best(runs)).collect()
    ids = [c["id"] for c in chunks]
    assert len(ids) == len(set(ids)) and "mlflow:run-id-2:metric_rmse" in ids
    best = next(c for c in chunks if c["id"] == "mlflow:run-id-2:overview")
    assert "Melhor run" in best["text"]
    changed = runs.withColumn("start_time", F.lit("2025"))
    hashed = lambda d: sorted(r["content_hash"] for r in R.run_chunks(R.with_best(d)).select("content_hash").distinct().collect())
    assert hashed(runs) == hashed(changed)
    assert R.fingerprint(runs).first()[0] != R.fingerprint(changed).first()[0]
    assert R.best_run_text(runs.limit(0)).first()["text"] == R.NO_RUNS
    assert R.best_run_text(runs).first()["text"].startswith("Melhor run de treinamento (ID: run-id-2):")


def test_tool_content_shapes(spark):
    cases = [
        '{"id": 1, "distance": 0.5, "text": "a"}', '[{"id": "2", "entity": {"text": "b", "source": "s"}}]',
        '[[{"id": 3, "text": ""}], [{"id": 4, "text": "d"}]]', "não é json", "[]",
    ]
    got = apply(spark, lambda c: V.flat_hits(V.parse_hits(c)), cases)
    assert [[(h["id"], h["text"], h["source"]) for h in hits] if hits else hits for hits in got] == [
        [("1", "a", None)], [("2", "b", "s")], [("4", "d", None)], None, [],
    ]


def test_timestamp_body_costs_no_square_of_a_line(spark):
    """A line of 60,000 characters behind a timestamp; before, every start in it was tried to its end. Short texts against the plain rule."""
    stamp, rng = "## Processado em: 2024", random.Random(3)
    bits = [stamp, "PROCESSADO EM: 2023", "processado em:", "\n", "-", "wort ", "## ", "x" * 30, " "]
    short = ["".join(rng.choice(bits) for _ in range(rng.randrange(4, 14))) for _ in range(300)]

    def plainly(text):
        bare = text.strip()
        body = re.sub(r"(?i).*processado em:[^\n-]*", "", bare).strip(" -")
        stamped = re.search(r"(?i)processado em:\s*\d{4}", bare)
        return len(bare) < 80 or bool(re.fullmatch(r"#+ [^\n]+", bare)) or (bool(stamped) and len(body) < 50)

    assert apply(spark, T.is_low_value, short) == [plainly(t) for t in short]
    began = time.time()
    assert apply(spark, T.is_low_value, [f"{stamp}\n" + "a" * 60_000]) == [False]
    assert time.time() - began < 6


def test_whole_run_chunks_shuffles_runs_not_texts(spark, tmp_path):
    """Texts are grouped where they are made; runs that share an id, and runs without one, still meet."""
    rows = [(k, 7 + (k or 0) % 3, "FOP"[i % 3], 1000.5 + i, "1996-01-02", "1-URGENT") for i, k in enumerate([1, 1, 2, 3, None, None])]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/orders.parquet")
    made = whole_run_chunks(spark, str(tmp_path))
    moved = [line for line in made._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert moved and all("section" not in line for line in moved)
    keys = [(r["run_id"], r["section"]) for r in made.collect()]
    assert len(keys) == len(set(keys)) and len({k for k, _ in keys}) == 4
