"""A quality classifier on random-indexing vectors.

Every token has a fixed sparse random vector; a token's context vector is the sum of those of its
neighbours, over the whole corpus. Tokens are hashed to a fixed number of rows, so the table of context
vectors has a fixed size and no token is left out. A document is pooled from the vectors of its tokens (mean and
spread), and a two-layer network gives a probability that is calibrated with a temperature.

Tokens are runs of letters and digits, and runs of other signs, in their case. The network is fitted on
a documented number of labelled documents, chosen by a hash of their ids, and calibrated on a fifth of
them. Labels of a document that has several are averaged. NULL labels and NULL ids are left out of the fit.
Without labels of both kinds every score is the share of good labels, or one half. A NULL or empty text is pooled
to zeros and scored like any other. Equal rows are documents of their own. Other columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm.registry import query, read
from tablespan.llm.tables import added_up
from tablespan.llm.words import Block, as_bytes, blocks, class_table
from tablespan.sources.shared import kept

ROWS = 1 << 14  # of the table of vectors
SIZE = 32  # of a vector
NONZERO = 6  # entries of a token's own random vector
REACH = 2  # neighbours on each side

TRAIN_DOCS = 20_000
HIDDEN = 32
EPOCHS = 60
THRESHOLD = 0.3
HELD_OUT = 5

#: Token classes of bytes: blank, letters and digits, other signs.
KIND = np.where(class_table(rb"[A-Za-z0-9\x80-\xFF]"), 1, np.where(class_table(rb"[\x20\x09-\x0D]"), 0, 2)).astype(np.int8)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def random_vectors() -> np.ndarray:
    """The fixed sparse vectors, one for each row of the table."""
    draw = np.random.default_rng(7)
    places = draw.random((ROWS, SIZE)).argsort(axis=1)[:, :NONZERO]
    out = np.zeros((ROWS, SIZE), dtype=np.float32)
    np.put_along_axis(out, places, draw.choice(np.array([-1, 1], dtype=np.float32), (ROWS, NONZERO)), axis=1)
    return out


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The table row of each token, and for each text the number of tokens before it."""
    kind = np.concatenate([[0], KIND[block.buffer], [0]])
    edges = np.flatnonzero(np.diff(kind))
    starts = edges[kind[edges + 1] > 0]
    ends = edges[kind[edges] > 0]
    bounds = np.append(np.searchsorted(starts, block.begins), len(starts))
    return (block.hashes().of(starts, ends) & np.uint64(ROWS - 1)).astype(np.int64), bounds


def _added(table: np.ndarray, rows: np.ndarray, bounds: np.ndarray, own: np.ndarray) -> None:
    """Add each token's neighbours' random vectors to its row."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pairs = []
    for k in range(1, REACH + 1):
        same = text[k:] == text[:-k]
        pairs.append(rows[:-k][same] * ROWS + rows[k:][same])
    both = np.concatenate(pairs)
    pair, n = np.unique(np.concatenate([both, (both % ROWS) * ROWS + both // ROWS]), return_counts=True)
    left, right = pair // ROWS, pair % ROWS
    for a in range(0, len(pair), 1 << 16):
        to, part = left[a : a + (1 << 16)], own[right[a : a + (1 << 16)]] * n[a : a + (1 << 16), None].astype(np.float32)
        firsts = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        table[to[firsts]] += np.add.reduceat(part, firsts, axis=0)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The context vectors of all table rows over all documents, each of length one.

    Each task fills a table of the fixed size, and Spark adds the tables up.
    """

    def fill(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> None:
        own, sums = random_vectors(), table.reshape(ROWS, SIZE)
        for given in batches:
            for block in blocks(as_bytes(given.column("text")), lower=False):
                rows, bounds = tokens(block)
                if len(rows) > 1:
                    _added(sums, rows, bounds, own)

    table = added_up(docs.select("text"), fill, ROWS * SIZE, "float32").reshape(ROWS, SIZE)
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-6)


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, pooled): mean and spread of the tokens' vectors, their number and their variety."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for given in batches:
            ids = given.column("doc_id")
            for block in blocks(as_bytes(given.column("text")), lower=False):
                rows, bounds = tokens(block)
                n = np.diff(bounds)
                out = np.zeros((len(n), 2 * SIZE + 3), dtype=np.float32)
                some = np.flatnonzero(n)
                if len(some):
                    own, at = table[rows], bounds[some]
                    mean = np.add.reduceat(own, at, axis=0) / n[some, None]
                    square = np.add.reduceat(own * own, at, axis=0) / n[some, None]
                    text = np.repeat(np.arange(len(n)), n)
                    distinct = np.bincount(np.unique(text * ROWS + rows) // ROWS, minlength=len(n))[some]
                    again = np.bincount(text[1:][(text[1:] == text[:-1]) & (rows[1:] == rows[:-1])], minlength=len(n))[some]
                    out[some, :SIZE] = mean
                    out[some, SIZE : 2 * SIZE] = np.sqrt(np.maximum(square - mean * mean, 0))
                    out[some, 2 * SIZE] = np.log1p(n[some])
                    out[some, 2 * SIZE + 1] = distinct / n[some]
                    out[some, 2 * SIZE + 2] = again / n[some]
                yield pa.RecordBatch.from_arrays([ids.slice(block.first, len(n)), pa.array([row.tobytes() for row in out], pa.binary())], names=["doc_id", "pooled"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pool, "doc_id long, pooled binary")


@dataclass
class Network:
    """Two layers on scaled inputs; the output's logit is divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fitted(x: np.ndarray, y: np.ndarray) -> Network:
    """A network for the rows; a fifth of them is left for the temperature."""
    n = x.shape[1]
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return Network(np.zeros(n), np.ones(n), np.zeros((n, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    draw = np.random.default_rng(11)
    order = draw.permutation(len(y))
    x, y = x[order].astype(np.float64), y[order].astype(np.float64)
    later = max(1, len(y) // 5)
    fit_x, fit_y = x[later:], y[later:]
    if fit_y.size == 0:
        fit_x, fit_y = x, y
    net = Network(fit_x.mean(axis=0), fit_x.std(axis=0) + 1e-3, draw.normal(0, (2 / n) ** 0.5, (n, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    weights = [net.first, net.first_bias, net.second, np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    scaled, step = (fit_x - net.mean) / net.scale, 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(fit_y))
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            inputs = scaled[rows]
            before = inputs @ weights[0] + weights[1]
            hidden = np.maximum(before, 0)
            error = 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3][0], -40, 40))) - fit_y[rows]
            back = np.outer(error, weights[2]) * (before > 0)
            slopes = [inputs.T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for i, slope in enumerate(slopes):
                slope = slope / len(rows) + 1e-4 * weights[i]
                m, v = moments[i]
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                weights[i] -= 2e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.second_bias = float(weights[3][0])
    logits = net.logits(x[:later])
    net.temperature = min(np.geomspace(0.5, 20, 60), key=lambda t: _loss(logits / t, y[:later]))
    return net


def scored(rows: DataFrame, net: Network) -> DataFrame:
    """(doc_id, score) of pooled rows."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            x = np.frombuffer(b"".join(given.column("pooled").to_pylist()), dtype=np.float32).reshape(given.num_rows, -1)
            yield pa.RecordBatch.from_arrays([given.column("doc_id"), pa.array(shared.value.scores(x))], names=["doc_id", "score"])

    return rows.select("doc_id", "pooled").mapInArrow(score, "doc_id long, score double")


def training_rows(rows: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Pooled vectors and labels of at most `most` documents that are not held out."""
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    got = rows.join(marks, "doc_id").groupBy("doc_id", "good").agg(F.min("pooled").alias("pooled")).orderBy("doc_id").select("pooled", "good").collect()
    width = 2 * SIZE + 3
    x = np.frombuffer(b"".join(bytes(r.pooled) for r in got), dtype=np.float32).reshape(len(got), width)
    return x, np.array([r.good for r in got], dtype=np.float64)


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = kept(spark, pooled(docs, word_vectors(docs)))
    net = fitted(*training_rows(rows, read(spark, sf_dir, "labels")))
    return scored(rows, net).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
