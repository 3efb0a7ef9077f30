"""Numbered pieces that keep every word, with their heading in front."""

import re

import pytest
from pyspark.sql import functions as F

from wattmill.functions import text as T
from wattmill.operators import chunking as K
from wattmill.operators import runs as R


def bare(text):
    return re.sub(f"[{re.escape(T.WHITESPACE)}]", "", text)


@pytest.mark.parametrize("width", [1, 7, 20])
def test_filled_pieces(spark, width):
    texts = ["eins zwei drei vier", "", "   ", "x" * 45, "kurz " + "y" * 30 + "\n\nende", "a b\tc\n d", "wort " * 50, "🙂🙂 🙂 " * 9]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "id int, t string")
    got = {r["id"]: r["p"] for r in rows.select("id", T.filled_pieces(F.col("t"), F.lit(width)).alias("p")).collect()}
    for i, text in enumerate(texts):
        assert "".join(bare(p) for p in got[i]) == bare(text)
        assert all(0 < len(p) <= width and p == p.strip() for p in got[i])
        words = text.split()
        if all(len(w) <= width for w in words):
            assert " ".join(got[i]).split() == words
    assert got[99] is None


def test_whole_chunks_repeat_the_title_and_keep_short_ends(spark):
    title = "Divisão dos Dados " + "lang " * 30
    body = " ".join(f"w{i}" for i in range(900))
    text = f"# Kopf\n\n## {title}\n{body}\n### kurz\nnur das"
    huge = "## " + "t" * 900 + "\n" + "b " * 800
    rows = spark.createDataFrame([(1, "gold", text, "c"), (2, "gold", None, "c"), (3, "gold", "", "c"), (4, "gold", huge, "c")], "doc_id int, source string, text string, title string")
    got = K.whole_chunks(rows.select("doc_id", "source", "text"), ["doc_id"]).orderBy("section_no", "piece_no").collect()
    assert {r["doc_id"] for r in got} == {1, 4}
    assert all(len(r["text"]) <= T.MAX_TEXT for r in got)
    for doc, whole in ((1, text), (4, huge)):
        assert bare("".join(r["body"] for r in got if r["doc_id"] == doc)) == bare(whole)
    long = [r for r in got if r["doc_id"] == 1 and r["section_no"] == 1]
    lead = K.SECTION_SENTENCES["divisão dos dados"] + "\n" + title.strip() + "."
    assert len(long) > 3 and all(r["text"] == lead + "\n" + r["body"] and not r["low_value"] for r in long)
    assert [r["low_value"] for r in got if r["doc_id"] == 1 and r["section_no"] == 2] == [True]


def test_runs_with_many_parameters_lose_nothing(spark):
    metrics = {f"m{i}": float(i) for i in range(200)}
    params = {f"p{i}": "v" * 20 + str(i) for i in range(200)}
    runs = spark.createDataFrame(
        [("r1", "FINISHED", metrics, params, True)], "run_id string, status string, metrics map<string,double>, params map<string,string>, is_best boolean"
    ).withColumn("start_time", F.lit("2024-01-01"))
    got = R.whole_run_chunks(runs, "p", "e").orderBy("section", "piece_no").collect()
    header = R.HEADER.format(project="p")
    assert all(r["text"] == header + "\n" + r["body"] and len(r["text"]) <= T.MAX_TEXT for r in got)
    assert len({r["id"] for r in got}) == len(got)
    listed = "\n".join(r["body"] for r in got if r["section"] == "params")
    assert {f"p{i}:" for i in range(200)} | {"v" * 20 + str(i) for i in range(200)} <= set(listed.split())
    told = "\n".join(r["body"] for r in got if r["section"] == "metrics_summary")
    assert {f"m{i}:" for i in range(200)} <= set(told.split())
