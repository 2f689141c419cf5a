"""Secrets in texts, judged by who owns them across the corpus.

Candidates are assignments to telling names, access keys, long hexadecimal runs and, beyond those base
kinds, long tokens of mixed signs. A candidate's value is hashed, and hashes are counted over the whole
corpus by distinct repositories and distinct owners. A value that many owners have is an example that was
copied; one that a single owner has and that looks random is taken as live. Base spans always stay; the
mixed tokens are reported only where they are live.

A NULL text is empty. A NULL repository or owner counts as one more of its kind. Equal rows are
documents of their own. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm.registry import query, read
from tablespan.llm.words import Block, as_bytes, blocks, class_table
from tablespan.sources.shared import kept

#: The base kinds and their patterns, over UTF-8 bytes.
KINDS = ("assign", "access", "hex", "owned")
NAMES = re.compile(rb"password|passwd|secret|token|api_?key")
ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = class_table(rb"[0-9a-f]")
LEAST = {"assign": 6, "access": 20, "hex": 24, "owned": 20}

MIXED = class_table(rb"[A-Za-z0-9+/_=-]")
LEAST_BITS = 3.5  # of entropy per character, from which a value looks random
EXAMPLE_OWNERS = 3  # as many distinct owners make a value an example

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("value", pa.string()), ("random", pa.bool_())])
_FOUND = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("repository", pa.string()), ("owner", pa.string()), ("found", pa.list_(_SPAN))])
FOUND = "row long, doc_id long, repository string, owner string, found array<struct<kind: string, start: long, stop: long, value: string, random: boolean>>"


def looks_random(value: bytes) -> bool:
    """Whether the characters of a value are spread as in a generated key."""
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= LEAST_BITS


def _mixed(value: bytes) -> bool:
    return bool(re.search(rb"[a-z]", value) and re.search(rb"[A-Z]", value) and re.search(rb"[0-9]", value)) and looks_random(value)


def _runs(block: Block, table: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Text number, start and end in its text of each maximal run of a class that is long enough."""
    starts, ends, _ = block.words(table)
    long = ends - starts >= least
    texts = np.searchsorted(block.begins, starts[long], side="right") - 1
    begins = block.begins[texts]
    yield from zip(texts.tolist(), (starts[long] - begins).tolist(), (ends[long] - begins).tolist(), strict=True)


def _spans(block: Block) -> list[list[tuple[int, str, int, bytes]]]:
    """For each text: (start, kind, end, value) in bytes, sorted by start and kind."""
    whole = block.buffer.tobytes()
    texts = [whole[a:b] for a, b in zip(block.begins, block.stops, strict=True)]
    found: list[list] = [[] for _ in texts]
    owners = lambda pattern, data: np.unique(np.searchsorted(block.begins, [m.start() for m in pattern.finditer(data)], side="right") - 1).tolist()
    for i in owners(NAMES, whole.lower()):
        found[i] += [(m.start(), 0, m.end(), m[1]) for m in ASSIGN.finditer(texts[i]) if len(m[1]) >= LEAST["assign"]]
    for i in owners(ACCESS, whole):
        found[i] += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(texts[i]) if len(m[0]) >= LEAST["access"]]
    for i, a, b in _runs(block, HEX, LEAST["hex"]):
        found[i].append((a, 2, b, texts[i][a:b]))
    covered: dict[int, tuple[list[int], list[int]]] = {}
    for i, a, b in _runs(block, MIXED, LEAST["owned"]):
        if not _mixed(texts[i][a:b]):
            continue
        if i not in covered:  # starts in order, and the furthest end of the spans up to each
            base = sorted((x, y) for x, _, y, _ in found[i])
            covered[i] = [x for x, _ in base], list(accumulate((y for _, y in base), max))
        starts, ends = covered[i]
        before = bisect_left(starts, b)
        if not before or ends[before - 1] <= a:
            found[i].append((a, 3, b, texts[i][a:b]))
    return [sorted(x) for x in found]


def _points(text: bytes, spans: list[tuple[int, str, int, bytes]]) -> list[tuple[int, int]]:
    """The spans' bounds counted in code points."""
    if text.isascii():
        return [(a, b) for a, _, b, _ in spans]
    before = np.append(0, np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80))
    return [(int(before[a]), int(before[b])) for a, _, b, _ in spans]


def candidates(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """One row per document with everything found in it; `row` numbers the rows."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for given in batches:
            texts = as_bytes(given.column("text"))
            for block in blocks(texts, lower=False):
                rows = []
                for i, spans in enumerate(_spans(block)):
                    text = texts[block.first + i] or b""
                    rows.append(
                        [
                            {"kind": KINDS[kind], "start": a, "stop": b, "value": hashlib.sha256(value).hexdigest(), "random": looks_random(value)}
                            for (_, kind, _, value), (a, b) in zip(spans, _points(text, spans) if spans else (), strict=True)
                        ]
                    )
                part = given.slice(block.first, len(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + len(rows)), pa.int64()), part.column("doc_id"), part.column("repository"), part.column("owner"), pa.array(rows, pa.list_(_SPAN))],
                    schema=_FOUND,
                )
                row += len(rows)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", repository.cast("string").alias("repository"), owner.cast("string").alias("owner"))
    return rows.mapInArrow(find, FOUND)


def ownership(found: DataFrame) -> DataFrame:
    """(value, repositories, owners): distinct ones, counted over all documents."""
    marks = found.select(F.explode("found.value").alias("value"), "repository", "owner").distinct()
    none = F.lit("\x00")
    return marks.groupBy("value").agg(
        F.countDistinct(F.coalesce("repository", none)).alias("repositories"), F.countDistinct(F.coalesce("owner", none)).alias("owners")
    )


def judged(found: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """(row, kind, start, stop, value, repositories, owners, verdict): `example`, `live` or `unclear`."""
    spans = found.select("row", F.inline("found"))
    counts = ownership(found).withColumnRenamed("value", "counted")
    verdict = (
        F.when(F.col("owners") >= example_owners, "example").when((F.col("owners") == 1) & F.col("random"), "live").otherwise("unclear")
    )
    return spans.join(counts, spans.value == counts.counted).select(
        "row", "kind", "start", "stop", "value", "repositories", "owners", verdict.alias("verdict")
    )


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))


@query()
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document stands for a repository, its source for the owner."""
    docs = read(spark, sf_dir, "documents")
    found = kept(spark, candidates(docs, F.col("doc_id"), F.col("source")))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "kind", "stop")
    spans = judged(found).groupBy("row").agg(
        F.sort_array(F.collect_list(F.when((F.col("kind") != "owned") | (F.col("verdict") == "live"), span))).alias("spans"),
        F.count_if(F.col("verdict") == "live").alias("n_live"),
        F.count_if(F.col("verdict") == "example").alias("n_example"),
    )
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"] != "owned")
    none = F.lit(0).cast("long")
    return found.join(spans, "row", "left").select(
        "doc_id",
        *map(count, KINDS[:3]),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        F.coalesce(_joined(F.col("spans")), F.lit("")).alias("spans"),
        F.coalesce("n_live", none).alias("n_live"),
        F.coalesce("n_example", none).alias("n_example"),
    )
