"""Test passages in training texts, found with a positional inverted index.

The index is a stored table of segments. A segment holds whole documents (about 256 KB of text) and,
for each of its terms, the sorted positions of that term: positions run on from document to document
with a gap between them, so a phrase never crosses two. Segments are made and searched where the
documents are; nothing is shuffled, and a very frequent term is only a longer list in each segment.

A search takes the windows of the test items. The index gives each term's frequency in the training
corpus; a window's terms are intersected from the rarest on: every list is shifted by the term's offset
in the window, and the places that all lists share are exact phrase matches. With `slop`, a term may
stand so many words from its place: proximity matches. Items are searched in blocks of a
bounded size, each of which is sent to all segments; where there are several, each one's matches are stored before the next
block is made, so that the driver and the tasks hold the windows of one.

Words are runs of letters and digits, A-Z lower-cased. A term is known by a 64-bit hash of its bytes. A
NULL text has no words; an item with fewer words than a window is one window, one without words is none.
Equal rows, equal or NULL ids are documents of their own; items with equal ids are one item. Items whose id is
NULL are searched like all others and their words count as hit, but lists and numbers of items leave them out. Other
columns are ignored. Empty tables give no matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm.registry import query, read
from tablespan.llm.words import ALPHANUMERIC, as_bytes, blocks, give_back
from tablespan.sources.shared import kept

WINDOW_WORDS = 13
CONTAMINATED_SHARE = 20  # contaminated if n_hit is at least a 20th of n_words
ITEM_WORDS = 200_000  # of the items searched at once: about 30 MB for all their windows
SEGMENT_BYTES = 1 << 18  # of text; a longer one is a segment of its own
SEGMENT_GROUP = 8 << 20  # bytes of segments that a task reads or writes at once
CANDIDATES = 1 << 20  # places examined at once
BROADCAST_ROWS = 200_000  # contaminated documents that are sent to all tasks; more are joined by a shuffle

INDEX = (
    "segment long, doc_ids array<long>, text_hashes array<long>, begins array<long>, n_words array<long>, terms array<long>, "
    "ends array<int>, positions binary"
)


def positional_index(docs: DataFrame, gap: int = WINDOW_WORDS) -> DataFrame:
    """Segments of `docs`: term t of `terms` has positions[ends[t - 1]:ends[t]], as 32-bit steps.

    Document i's words have the positions from begins[i] on. Searches need a gap of at least the
    window's words and slop together.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 33
        for given in batches:
            ids, marks = given.column("doc_id"), given.column("text_hash")
            for block in blocks(as_bytes(given.column("text")), size=SEGMENT_BYTES):
                starts, ends, bounds = block.words(ALPHANUMERIC)
                hashes = block.hashes().of(starts, ends).view(np.int64)
                n = np.diff(bounds)
                begins = bounds[:-1] + gap * np.arange(1, len(bounds))
                places = np.arange(len(starts)) + np.repeat(begins - bounds[:-1], n)
                order = np.argsort(hashes, kind="stable")
                terms = hashes[order]
                last = np.flatnonzero(np.append(terms[1:] != terms[:-1], True)) if len(terms) else np.zeros(0, np.int64)
                steps = np.diff(places[order], prepend=0)
                firsts = np.append(0, last[:-1] + 1) if len(last) else last
                steps[firsts] = places[order][firsts]  # each list starts anew
                row = {
                    "segment": segment,
                    "doc_ids": ids.slice(block.first, len(n)).to_pylist(),
                    "text_hashes": marks.slice(block.first, len(n)).to_pylist(),
                    "begins": begins,
                    "n_words": n,
                    "terms": terms[last],
                    "ends": last + 1,
                    "positions": steps.astype("<u4").tobytes(),
                }
                yield pa.RecordBatch.from_pylist([row], schema=_INDEX)
                segment += 1
            give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(build, INDEX)


_INDEX = pa.schema(
    [
        ("segment", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("text_hashes", pa.list_(pa.int64())),
        ("begins", pa.list_(pa.int64())),
        ("n_words", pa.list_(pa.int64())),
        ("terms", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int32())),
        ("positions", pa.binary()),
    ]
)
_MATCHES = pa.schema([("segment", pa.int64()), ("document", pa.int32()), ("item_id", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
MATCHES = "segment long, document int, item_id string, start long, stop long"


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the terms of each item with a word, in order."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            ids = given.column("item_id")
            for block in blocks(as_bytes(given.column("text"))):
                starts, ends, bounds = block.words(ALPHANUMERIC)
                hashes = block.hashes().of(starts, ends).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(block.first, len(bounds) - 1).cast(pa.string()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes)),
                    ],
                    names=["item_id", "terms"],
                )

    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return rows.mapInArrow(terms, "item_id string, terms array<long>").filter(F.size("terms") > 0)


def term_frequencies(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, n): how often each wanted term occurs in the indexed documents; each once."""
    lengths = F.transform("ends", lambda e, i: e - F.when(i > 0, F.element_at("ends", i)).otherwise(0))
    counts = index.select(F.explode(F.arrays_zip("terms", lengths.alias("n"))).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.n").cast("long").alias("n"))
    return counts.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))


class Windows:
    """The windows of some items, with the terms of each ordered from the rarest on."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], frequency: dict[int, int], words: int):
        numbers: dict[str | None, int] = {}
        spans, sizes, owners = [np.zeros((0, words), np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for name, terms in items:
            size = min(words, len(terms))
            own = sliding_window_view(terms, size)
            spans.append(np.pad(own, ((0, 0), (0, words - size))))
            sizes.append(np.full(len(own), size))
            owners.append(np.full(len(own), numbers.setdefault(name, len(numbers))))
        self.names = list(numbers)
        self.items = np.concatenate(owners)
        self.lengths = np.concatenate(sizes)
        terms = np.concatenate(spans)
        known = np.array(list(frequency), dtype=np.int64)
        counts = np.array(list(frequency.values()), dtype=np.int64)[np.argsort(known)]
        known.sort()
        at = np.clip(np.searchsorted(known, terms), 0, max(0, len(known) - 1))
        often = np.where(known[at] == terms, counts[at], 0) if len(known) else np.zeros_like(terms)
        often[np.arange(words) >= self.lengths[:, None]] = np.iinfo(np.int64).max
        order = np.argsort(often, axis=1, kind="stable")
        self.offsets = order.astype(np.int32)
        self.terms = np.take_along_axis(terms, order, axis=1)


class Segment:
    """A segment's lists, each position under one number: the term's rank, then the position."""

    def __init__(self, terms: np.ndarray, ends: np.ndarray, positions: np.ndarray):
        self.terms = terms
        self.begins = np.append(0, ends[:-1]) if len(ends) else ends
        self.counts = ends - self.begins
        steps = positions.astype(np.int64)
        ranks = np.repeat(np.arange(len(terms)), self.counts)
        sums = np.cumsum(steps)
        if len(sums):
            sums -= np.repeat(sums[self.begins] - steps[self.begins], self.counts)
        self.places = sums
        self.span = int(sums.max(initial=0)) + 1
        self.keys = ranks * self.span + sums

    def rank(self, terms: np.ndarray) -> np.ndarray:
        """The numbers of terms, -1 for those that the segment lacks."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.clip(np.searchsorted(self.terms, terms), 0, len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def has(self, ranks: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a list has a position from low to high."""
        low, high = np.maximum(low, 0), np.minimum(high, self.span - 1)
        at = np.searchsorted(self.keys, ranks * self.span + low)
        found = np.append(self.keys, np.iinfo(np.int64).max)[at]
        return (high >= 0) & (low < self.span) & (found <= ranks * self.span + high)

    def find(self, windows: Windows, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows and start positions of all matches."""
        there = np.flatnonzero(self.rank(windows.terms[:, 0]) >= 0)  # most lack the rarest term
        ranks = self.rank(windows.terms[there])
        whole = ((ranks >= 0) | (np.arange(ranks.shape[1]) >= windows.lengths[there, None])).all(axis=1)
        there, ranks = there[whole], ranks[whole]
        counts = self.counts[ranks[:, 0]] if len(there) else np.zeros(0, np.int64)
        kept_windows, kept_places = [], []
        at = 0
        while at < len(there):
            upto = at + max(1, int(np.searchsorted(np.cumsum(counts[at:]), CANDIDATES, side="right")))
            n = counts[at:upto]
            own = np.repeat(np.arange(at, at + len(n)), n)  # numbers among the windows that are there
            window = there[own]
            at = upto
            within = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
            start = self.places[self.begins[ranks[own, 0]] + within] - windows.offsets[window, 0]
            for k in range(1, ranks.shape[1]):
                last = k >= windows.lengths[window]
                place = start + windows.offsets[window, k]
                good = last | self.has(ranks[own, k], place - slop, place + slop)
                window, own, start = window[good], own[good], start[good]
            kept_windows.append(window)
            kept_places.append(start)
        if not kept_windows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(kept_windows), np.concatenate(kept_places)


def matches(index: DataFrame, shared: Broadcast[Windows], slop: int = 0) -> DataFrame:
    """(segment, document, item_id, start, stop): maximal stretches of words that an item's windows cover.

    Start and stop count words of the document; adjoining and overlapping windows of an item make one
    stretch. With `slop` the stretch is the place that the anchor, the window's rarest term, gives it.
    Items without an id share stretches only where they are searched together.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for given in batches:
            for i in range(given.num_rows):
                numbers = {n: given.column(n)[i].values.to_numpy(zero_copy_only=False) for n in ("begins", "n_words", "terms", "ends")}
                steps = np.frombuffer(given.column("positions")[i].as_py(), dtype="<u4")
                segment = Segment(numbers["terms"], numbers["ends"].astype(np.int64), steps)
                window, start = segment.find(own, slop)
                if not len(window):
                    continue
                item, stop = own.items[window], start + own.lengths[window]
                order = np.lexsort((start, item))
                item, start, stop = item[order], start[order], stop[order]
                # Windows of an item in order of start: a stretch ends where the next one starts beyond it.
                limit = np.maximum.accumulate(item * segment.span * 4 + stop)
                new = np.append(True, (item[1:] * segment.span * 4 + start[1:]) > limit[:-1])
                firsts = np.flatnonzero(new)
                item, start, stop = item[firsts], start[firsts], np.maximum.reduceat(stop, firsts)
                document = np.searchsorted(numbers["begins"], np.maximum(start, numbers["begins"][0]), side="right") - 1
                base = numbers["begins"][document]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([given.column("segment")[i].as_py()] * len(item), pa.int64()),
                        pa.array(document, pa.int32()),
                        pa.array(own.names, pa.string()).take(pa.array(item)),
                        pa.array(np.maximum(start - base, 0)),
                        pa.array(np.minimum(stop - base, numbers["n_words"][document])),
                    ],
                    schema=_MATCHES,
                )
            give_back()

    return index.select("segment", "begins", "n_words", "terms", "ends", "positions").mapInArrow(search, MATCHES)


def searched(spark: SparkSession, index: DataFrame, items: DataFrame, words: int = WINDOW_WORDS, slop: int = 0, at_once: int = ITEM_WORDS) -> DataFrame:
    """The matches of all items, in blocks of about `at_once` words of items."""
    terms = kept(spark, item_terms(items))
    total = terms.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = -(-total // at_once) or 1
    wanted = terms.select(F.explode("terms").alias("term"))
    frequencies = kept(spark, term_frequencies(index, wanted))
    found = []
    for k in range(n):
        block = terms.filter(F.pmod(F.when(F.col("item_id").isNull(), F.xxhash64("terms")).otherwise(F.xxhash64("item_id")), F.lit(n)) == k)
        own = frequencies.join(block.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi")
        frequency = {row.term: row.n for row in own.toLocalIterator()}
        named = [(row.item_id, np.array(row.terms, dtype=np.int64)) for row in block.toLocalIterator()]
        shared = spark.sparkContext.broadcast(Windows(named, frequency, words))
        if n == 1:
            return matches(index, shared, slop)
        found.append(kept(spark, matches(index, shared, slop)))
        shared.destroy()
    while len(found) > 1:
        found = [a.unionAll(b[0]) if b else a for a, *b in (found[i : i + 2] for i in range(0, len(found), 2))]
    return found[0]


def _covered(spans: Column) -> Column:
    """The number of words in any of the spans, which are sorted by start."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        spans,
        start,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["stop"] - F.greatest(x["start"], s["end"]), F.lit(0))).alias("n"),
            F.greatest(s["end"], x["stop"]).alias("end"),
        ),
        lambda s: s["n"],
    )


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, share: int = CONTAMINATED_SHARE) -> DataFrame:
    """One row per document: text_hash, n_words, n_hit, its items' ids in order, and whether it is contaminated."""
    index = kept(spark, positional_index(docs), SEGMENT_GROUP)
    found = searched(spark, index, items)
    hits = found.groupBy("segment", "document").agg(
        _covered(F.array_sort(F.collect_list(F.struct("start", "stop")))).alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    documents = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "text_hashes", "n_words")).alias("document", "d"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return documents.join(hits, ["segment", "document"], "left").select(
        F.col("d.doc_ids").alias("doc_id"),
        F.col("d.text_hashes").alias("text_hash"),
        F.col("d.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((hit > 0) & (hit * share >= F.col("d.n_words"))).alias("contaminated"),
    )


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = contamination(spark, docs, items).filter("contaminated").select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash"))
    found = kept(spark, found.distinct())
    found = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    same = docs.doc_id.cast("long").eqNullSafe(F.col("h_id")) & (F.xxhash64(docs.text) == F.col("h_hash"))
    return docs.join(found, same, "left_anti")


@query(
    r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item,
                 regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM benchmark WHERE text IS NOT NULL),
    starts AS (SELECT item, w, least(13, len(w)) AS size, unnest(range(len(w) - least(13, len(w)) + 1)) AS i
               FROM b WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item, size, array_to_string(w[i + 1 : i + size], ' ') AS phrase FROM starts),
    sizes AS (SELECT DISTINCT size FROM windows),
    places AS (SELECT r, w, size, unnest(range(len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size),
    found AS (SELECT r, i, p.size, item FROM places p
              JOIN windows v ON v.size = p.size AND v.phrase = array_to_string(w[i + 1 : i + p.size], ' ')),
    hit AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + size)) AS k FROM found) GROUP BY r),
    items AS (SELECT r, count(item) AS n, string_agg(item, ',' ORDER BY item) AS names
              FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
           sha256(coalesce(items.names, '')) AS items_sha256,
           coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
    """
)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = contamination(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return result.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
