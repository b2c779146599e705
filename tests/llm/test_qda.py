import random
import zlib

import numpy as np
import pyarrow as pa

from tabml.llm import qda


def test_statistics_of_one_text_do_not_depend_on_its_batch():
    rng = random.Random(1)
    texts = ["", None, "a", " ", "\n", "É!", "THE!! END!!\nof   it.", "x" * 300] + [
        "".join(rng.choice("abc DE.\n!#é1 ") for _ in range(rng.randint(0, 200))) for _ in range(60)]
    together = qda.statistics(pa.array(texts))
    for t, row in zip(texts, together):
        assert np.allclose(qda.statistics(pa.array([t], pa.string()))[0], row)
    assert np.isfinite(together).all()


def test_plain_statistics():
    x = dict(zip(qda.NAMES, qda.statistics(pa.array(["Éab CD ef# ef# g.\nhij."]))[0]))
    lengths = [len(w.encode()) for w in "Éab CD ef# ef# g. hij.".split()]
    assert np.isclose(x["words"], np.log1p(6)) and np.isclose(x["word_length"], np.log1p(np.mean(lengths)))
    assert np.isclose(x["word_spread"], np.log1p(np.std(lengths)))
    assert np.isclose(x["upper"] ** 2, 3 / 22) and np.isclose(x["capital_words"] ** 2, 2 / 6)
    assert np.isclose(x["symbol_words"] ** 2, 2 / 6) and np.isclose(x["doubled_words"] ** 2, 1 / 6)
    assert np.isclose(x["line_stops"], 1.0) and np.isclose(x["distinct_lines"], 1.0)
    assert np.isclose(x["distinct_words"], np.log(6 / 7))


def test_fit_equals_plain_densities():
    rng = np.random.default_rng(2)
    data = [rng.standard_normal((200, 3)) @ rng.standard_normal((3, 3)) + k for k in (0, 2)]
    model = qda.fit([len(d) for d in data], [d.sum(0) for d in data], [d.T @ d for d in data], 0.3, 0.2)
    within = sum(np.cov(d.T, bias=True) * len(d) for d in data) / 400
    x = rng.standard_normal((50, 3))
    z = []
    for d in data:
        cov = 0.7 * np.cov(d.T, bias=True) + 0.3 * within
        cov = 0.8 * cov + 0.2 * np.diag(np.diag(cov)) + 1e-6 * np.eye(3)
        diff = x - d.mean(0)
        z.append(-0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(z[0] - z[1])))


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy(spark, sf_tiny):
    sf = sf_tiny.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in qda.score_quality(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == held(i) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for i, r in rows.items())
    out = [(rows[r.doc_id].predicted, r.quality) for r in labels.collect() if held(r.doc_id) and r.doc_id in rows]
    for k in (0, 1):
        own = [p == q for p, q in out if q == k]
        assert sum(own) >= 0.95 * len(own), k


def test_labels_and_metadata_of_held_out_rows_do_not_matter(spark, sf_tiny):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{sf_tiny}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda r: r.doc_id
    a = sorted(qda.score_quality(docs, labels).collect(), key=key)
    b = sorted(qda.score_quality(docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")}), turned).collect(), key=key)
    assert [r.doc_id for r in a] == [r.doc_id for r in b]
    assert np.allclose([r.score for r in a], [r.score for r in b], atol=1e-9)


def test_odd_rows(spark, make_docs):
    data = [(i, "Good plain words in order here.\nAnd more of them.") for i in range(30)] + [(100 + i, "BAD!! ###") for i in range(30)]
    data += [(None, "x"), (500, None), (501, ""), (502, "w " * 200_000), (0, "again with id zero")]
    labels = [(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)] + [(None, 1), (3, None), (500, 7), (1, 0), (2, 1), (2, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = qda.score_quality(make_docs(data), frame).collect()
    assert len(rows) == len(data) and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[7].predicted == 1 and by[107].predicted == 0 and not by[None].held_out
    # one class or none
    assert {r.score for r in qda.score_quality(make_docs(data), frame.where("quality = 1")).collect()} == {1.0}
    assert {r.score for r in qda.score_quality(make_docs(data), frame.where("false")).collect()} == {0.5}
    assert qda.score_quality(make_docs(data).where("false"), frame).count() == 0
