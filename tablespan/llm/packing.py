"""Packing by concatenating and cutting.

Pass one turns every document into token ids, ended by a terminator, and stores them with the number
of ids that precede them in their part. Pass two sums the parts' totals, so that each document gets its
place in one endless row of ids, and cuts that row into windows of a fixed length: only the last one
has padding. A document that crosses a window's border gives a piece on each side of it.

Parts are those of the stored table, so repeated tasks cannot shift the places. What all tasks share is
one row for each part. A NULL text is empty and gives the terminator alone; rows with equal or NULL ids
are documents of their own; other columns are ignored; an empty table has no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablespan.llm.pretokens import encoder
from tablespan.llm.registry import query, read
from tablespan.llm.words import batch, give_back
from tablespan.sources.shared import kept

SEQUENCE_TOKENS = 2048
TERMINATOR = 1
VOCABULARY = "byte_bpe_50k.tiktoken"  # the same ids as byte_bpe_50k.json
BLOCK_CHARACTERS = 1 << 18

TOKENS = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])


def tokenized(docs: DataFrame, vocabulary: str = VOCABULARY, terminator: int = TERMINATOR) -> DataFrame:
    """(part, doc_id, before, doc_tokens, ids): ids are little-endian unsigned 32-bit values."""
    path, pattern = public_tokenizers.path(vocabulary), public_tokenizers.PATTERN

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        words = encoder(path, pattern)
        for given in batches:
            names, texts = given.column("doc_id").to_pylist(), given.column("text").to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= BLOCK_CHARACTERS):
                    size += len(texts[end] or "")
                    end += 1
                ids, bounds = words.encode([x or "" for x in texts[at:end]])
                ended = np.insert(ids, bounds[1:], terminator).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                yield batch(
                    TOKENS,
                    part=[part] * (end - at),
                    doc_id=names[at:end],
                    before=bounds[:-1] + total,
                    doc_tokens=np.diff(bounds),
                    ids=[ended[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
                )
                total += int(bounds[-1])
                at = end
            give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encode, "part int, doc_id long, before long, doc_tokens long, ids binary"
    )


def cut(tokens: DataFrame, length: int = SEQUENCE_TOKENS) -> DataFrame:
    """The pieces of stored documents: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("doc_tokens")).alias("tokens"))
    # One row for each part of the table: the number of parts bounds this window and the broadcast.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    placed = tokens.join(F.broadcast(offsets), "part").withColumn("place", F.col("base") + F.col("before"))
    n = F.lit(length)
    pieces = placed.select(
        "doc_id",
        "doc_tokens",
        "place",
        "ids",
        F.explode(F.expr(f"sequence(place div {length}, (place + doc_tokens - 1) div {length})")).alias("sequence_id"),
    )
    first = F.greatest(F.col("sequence_id") * n, F.col("place"))
    last = F.least((F.col("sequence_id") + 1) * n, F.col("place") + F.col("doc_tokens"))
    pieces = pieces.select(
        "doc_id",
        (first - F.col("place")).alias("start"),
        (last - first).alias("length"),
        "ids",
        "doc_tokens",
        "sequence_id",
        (first - F.col("sequence_id") * n).alias("offset"),
    )
    ids = F.substring("ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    return pieces.select("doc_id", "start", "length", F.crc32(ids).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", ids.alias("ids"))


def packed(spark: SparkSession, docs: DataFrame, length: int = SEQUENCE_TOKENS) -> DataFrame:
    """All documents as pieces of sequences, with their ids."""
    return cut(kept(spark, tokenized(docs)), length)


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, read(spark, sf_dir, "documents")).drop("ids")
