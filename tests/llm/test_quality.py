import zlib

import numpy as np

from tablespan.llm import quality as Q
from tablespan.llm.words import blocks
from tests.llm.frames import documents, given, written

FOLDER = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, good string")


def test_held_out_accuracy(spark):
    marks = {x["doc_id"]: x["quality"] for x in given("labels", FOLDER)}
    result = Q.op4_quality(spark, FOLDER).collect()
    assert len(result) == len(given("documents", FOLDER))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in result)
    assert all(r.predicted == int(r.score >= 0.3) for r in result)
    held = [r for r in result if r.held_out and r.doc_id in marks]
    assert sum(r.predicted == marks[r.doc_id] for r in held) >= 0.93 * len(held)


def test_vectors_equal_brute_force(spark):
    texts = ["a b c, d!! e f", "b c", "", None, "one", "a b a b a b"]
    table = np.zeros((Q.ROWS, Q.SIZE))
    own = Q.random_vectors()
    for block in blocks([(t or "").encode() for t in texts], lower=False):
        rows, bounds = Q.tokens(block)
        for i in range(len(texts)):
            part = rows[bounds[i] : bounds[i + 1]]
            for j in range(len(part)):
                for k in (-2, -1, 1, 2):
                    if 0 <= j + k < len(part):
                        table[part[j]] += own[part[j + k]]
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    got = Q.word_vectors(documents(spark, list(enumerate(texts))).repartition(3))
    assert np.allclose(got, table / np.maximum(norm, 1e-6), atol=1e-5)


def test_temperature_calibrates():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(4000, 5))
    y = (draw.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = Q.fitted(x[:2000], y[:2000])
    scores = net.scores(x[2000:])
    for low in (0.1, 0.4, 0.7):
        some = (scores >= low) & (scores < low + 0.2)
        assert abs(scores[some].mean() - y[2000:][some].mean()) < 0.08
    assert net.temperature > 0.4


def test_odd_rows(spark, tmp_path):
    texts = [None, "", " ", "x", "é" * 9, "word " * 60_000, "!!"]
    rows = [*enumerate(texts), (1, ""), (None, "n")]
    marks = labels(spark, [(0, 1, 0, "x"), (1, 0, 0, "x"), (1, 1, 0, "x"), (2, None, 0, "x"), (None, 1, 0, "x"), (77, 1, 1, "x")])
    result = Q.op4_quality(spark, written(tmp_path / "a", documents=documents(spark, rows), labels=marks)).collect()
    assert len(result) == len(rows) and all(0 <= r.score <= 1 for r in result)
    unlabelled = Q.op4_quality(spark, written(tmp_path / "b", documents=documents(spark, rows), labels=labels(spark, []))).collect()
    assert {r.score for r in unlabelled} == {0.5}
    assert Q.op4_quality(spark, written(tmp_path / "c", documents=documents(spark, []), labels=marks)).count() == 0
