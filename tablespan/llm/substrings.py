"""Repeated byte strings across a corpus, by prefix-free parsing.

A byte is removed if a string of `DEPTH` bytes covers it that also starts earlier: in a document with a
smaller id, or before in the same one. Strings are judged on the input and never cross documents.

Rolling hashes of `TRIGGER` bytes choose triggers: each window of `SPREAD` places has its smallest hash as
one, so what chooses a string's trigger lies inside the string. A phrase is a run of string starts with
one trigger, together with the bytes their strings reach. Equal strings have equal triggers, so they
lie in phrases that share the bytes after the trigger (the phrase's key). The parse is the sequence of a document's
phrases, the dictionary has the distinct ones.

Order is needed among equal strings only, to the depth of a string:
1. Phrase occurrences meet by key. All but the first occurrence of a phrase are repeats as a whole;
   a phrase whose key no other phrase has is done.
2. What is left of the dictionary, phrases that share a key with others, is sorted by suffix: the
   suffixes of a part of the dictionary that holds whole keys, in byte order to DEPTH bytes, are cut into
   classes, and the parse's order of first occurrences decides within a class. Keys with very many phrases
   are split by suffix instead, in aggregates.
3. Marks go back to the documents, which are cut once.
Text is shuffled to its marks once, and once more for documents with a part of step 2.

A NULL text is empty. A NULL id comes after all others; documents with equal ids are ordered by a hash
of their texts, and of equal rows the first is kept. Other columns are ignored. An empty table gives an
empty result. Phrases are compared by 64-bit hashes, suffixes by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablespan.llm.registry import query, read
from tablespan.llm.words import Block, as_bytes, blocks, mixed
from tablespan.sources.shared import kept

DEPTH = 100
TRIGGER = 16
SPREAD = 64  # a phrase's marks are the bits of one number
KEY = DEPTH - SPREAD + 1
HEAVY_KEY = 20_000  # phrases of one key, beyond which the key is split by suffix
SUFFIXES = 100_000  # sorted at once
BROADCAST_ROWS = 200_000

LAST = (1 << 63) - 1


class Phrases:
    """The phrases of a block's texts in order; text i has those from bounds[i] to bounds[i + 1]."""

    def __init__(self, block: Block):
        n = len(block.buffer)
        self.hashes = block.hashes()
        places = np.arange(max(0, n - TRIGGER + 1))
        # The hash's upper bits, then the place: minima come with their place, the left one of equals.
        bits = np.uint64(max(1, n.bit_length()))
        low = (np.uint64(1) << bits) - np.uint64(1)
        least = (self.hashes.of(places, places + TRIGGER) & ~low) | places.astype(np.uint64)
        step = 1
        while step < SPREAD:
            least[:-step] = np.minimum(least[:-step], least[step:])
            step *= 2
        starts_here = np.zeros(len(least), dtype=bool)
        for a, b in zip(block.begins.tolist(), block.stops.tolist(), strict=True):
            if b - a >= DEPTH:
                starts_here[a : b - DEPTH + 1] = True
        start = np.flatnonzero(starts_here)
        trigger = (least[start] & low).astype(np.int64)
        new = np.flatnonzero(np.append(True, (trigger[1:] != trigger[:-1]) | (start[1:] != start[:-1] + 1))) if len(start) else start
        self.starts = start[new]
        self.ends = start[np.append(new[1:], len(start)) - 1] if len(start) else start  # the last start
        self.triggers = trigger[new]
        self.bounds = np.append(np.searchsorted(self.starts, block.begins), len(self.starts))

    def keys(self) -> np.ndarray:
        return self.hashes.of(self.triggers, self.triggers + KEY).view(np.int64)

    def contents(self) -> np.ndarray:
        shift = (self.triggers - self.starts).astype(np.uint64)
        return mixed(self.hashes.of(self.starts, self.ends + DEPTH) + shift).view(np.int64)


def _ids(rows: list[int] | np.ndarray) -> bytes:
    return np.asarray(rows, dtype="<i4").tobytes()


def identified(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, bool]:
    """(doc_id, doc, twin, text), and whether ids repeat: (doc, twin) is a document's place in the order.

    `twin` tells documents with equal ids apart by a hash of their text; it is 0 where an id is alone.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc.alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    again = kept(spark, rows.groupBy("doc").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc").alias("again")))
    n = again.count()
    if not n:
        return rows.select("doc_id", "doc", F.lit(0).cast("long").alias("twin"), "text"), False
    again = F.broadcast(again) if n <= BROADCAST_ROWS else again
    rows = rows.join(again, rows.doc == again.again, "left")
    return rows.select("doc_id", "doc", F.when(F.col("again").isNotNull(), F.xxhash64("text")).otherwise(0).alias("twin"), "text"), True


def occurrences(rows: DataFrame) -> DataFrame:
    """(key, content, doc, twin, phrase, known) of phrases, each once for a block of texts.

    What a block has in several places is known to repeat, but for the first; those numbers go
    with one row of their document, so a phrase that a third of all documents share costs a row per block.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            docs, twins = given.column("doc").to_numpy(), given.column("twin").to_numpy()
            for block in blocks(as_bytes(given.column("text")), lower=False):
                phrases = Phrases(block)
                n = len(phrases.starts)
                if not n:
                    continue
                text = np.repeat(np.arange(len(phrases.bounds) - 1), np.diff(phrases.bounds))
                number = np.arange(n) - phrases.bounds[text]
                doc, twin = docs[block.first + text], twins[block.first + text]
                content, key = phrases.contents(), phrases.keys()
                order = np.lexsort((number, twin, doc, content))
                new = np.append(True, content[order][1:] != content[order][:-1])
                first = order[np.maximum.accumulate(np.where(new, np.arange(n), 0))]
                repeats = order[(doc[order] != doc[first]) | (twin[order] != twin[first]) | (number[order] != number[first])]
                sent = order[new]
                known: dict[int, bytes] = {}
                repeats = repeats[np.argsort(text[repeats], kind="stable")]
                at = np.flatnonzero(np.append(True, text[repeats][1:] != text[repeats][:-1])) if len(repeats) else repeats
                for part in np.split(repeats, at[1:]):
                    if len(part):
                        known[int(text[part[0]])] = _ids(number[part])
                carrier: list[bytes | None] = [None] * len(sent)
                for i, owner in enumerate(text[sent].tolist()):
                    if owner in known:
                        carrier[i] = known.pop(owner)
                rest = np.array(sorted(known), dtype=np.int64)  # documents with no phrase of their own here
                spare = mixed((docs[block.first + rest] ^ twins[block.first + rest]).astype(np.uint64)).view(np.int64)
                join = lambda a, b: pa.array(np.concatenate([a, b]))
                yield pa.RecordBatch.from_arrays(
                    [
                        join(key[sent], spare),
                        join(content[sent], spare),
                        join(doc[sent], docs[block.first + rest]),
                        join(twin[sent], twins[block.first + rest]),
                        pa.array(np.concatenate([number[sent], np.full(len(rest), -1)]).astype(np.int32)),
                        pa.array([*carrier, *(known[i] for i in rest.tolist())], pa.binary()),
                    ],
                    names=["key", "content", "doc", "twin", "phrase", "known"],
                )

    return rows.select("doc", "twin", "text").mapInArrow(find, "key long, content long, doc long, twin long, phrase int, known binary")


def marks(found: DataFrame, heavy_key: int = HEAVY_KEY) -> DataFrame:
    """(doc, twin, known, repeats, open, heavy): for each document, lists of phrase numbers.

    `repeats` occur earlier as a whole, `open` are first occurrences whose key other phrases have;
    those of keys with very many occurrences are `heavy`. One shuffle; groups are sorted with spilling.
    """
    by_key = Window.partitionBy("key").orderBy("content", "doc", "twin", "phrase")
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_content = Window.partitionBy("key", "content").orderBy("doc", "twin", "phrase")
    place = F.struct("doc", "twin", "phrase")
    several = F.first("content").over(whole) != F.last("content").over(whole)
    rows = found.select("*", several.alias("several"), F.count("*").over(whole).alias("n"))
    rows = rows.select("*", F.first(place).over(by_content).alias("first"))
    repeat = (F.col("phrase") >= 0) & (place != F.col("first"))
    is_open = (F.col("phrase") >= 0) & ~repeat & F.col("several")
    rows = rows.select("doc", "twin", "phrase", "known", repeat.alias("repeat"), is_open.alias("open"), (F.col("n") > heavy_key).alias("heavy"))
    rows = rows.filter(F.col("repeat") | F.col("open") | F.col("known").isNotNull())
    pick = lambda condition: F.collect_list(F.when(condition, F.col("phrase")))
    return rows.groupBy("doc", "twin").agg(
        F.collect_list("known").alias("known"),
        pick(F.col("repeat")).alias("repeats"),
        pick(F.col("open") & ~F.col("heavy")).alias("open"),
        pick(F.col("open") & F.col("heavy")).alias("heavy"),
    )


def _cut(text: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[int, int, str]:
    """Bytes removed, runs removed and the hash of the rest, for strings that start from begins to ends."""
    if not len(begins):
        return 0, 0, hashlib.sha256(text.tobytes()).hexdigest()
    cover = np.zeros(len(text) + 1, dtype=np.int32)
    np.add.at(cover, begins, 1)
    np.add.at(cover, ends + DEPTH, -1)
    gone = np.cumsum(cover[:-1]) > 0
    edges = np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1
    return int(gone.sum()), int(edges.sum()), hashlib.sha256(text[~gone].tobytes()).hexdigest()


CUT = "doc_id long, doc long, twin long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_CUT = [("doc_id", pa.int64()), ("doc", pa.int64()), ("twin", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
_OPEN = pa.schema([*_CUT, ("text", pa.string()), ("repeats", pa.binary()), ("open", pa.binary()), ("heavy", pa.binary())])


def first_cut(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Documents without open phrases, cut; the others with their text and lists, for the next step."""
    keys = [F.col("doc").alias("m_doc"), F.col("twin").alias("m_twin")]
    marked = lists.select(*keys, "known", "repeats", "open", "heavy")
    joined = rows.join(marked, (rows.doc == marked.m_doc) & (rows.twin == marked.m_twin), "left").drop("m_doc", "m_twin")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            texts = as_bytes(given.column("text"))
            for block in blocks(texts, lower=False):
                phrases = Phrases(block)
                out: dict[str, list] = {name: [] for name in _OPEN.names[3:]}
                part = given.slice(block.first, len(block.begins))
                lists = zip(*(part.column(c).to_pylist() for c in ("known", "repeats", "open", "heavy")), strict=True)
                for i, (known, repeats, is_open, heavy) in enumerate(lists):
                    text = texts[block.first + i] or b""
                    every = np.concatenate([np.frombuffer(b"".join(known or []), dtype="<i4"), np.array(repeats or [], dtype="<i4")])
                    row = {"n_bytes": len(text), "text": None, "repeats": None, "open": None, "heavy": None}
                    if is_open or heavy:
                        row |= {"n_removed": None, "n_spans": None, "kept_sha256": None, "text": text, "repeats": _ids(every), "open": _ids(is_open), "heavy": _ids(heavy)}
                    else:
                        at = phrases.bounds[i] + every
                        begin = block.begins[i]
                        row["n_removed"], row["n_spans"], row["kept_sha256"] = _cut(
                            np.frombuffer(text, dtype=np.uint8), phrases.starts[at] - begin, phrases.ends[at] - begin
                        )
                    for name, value in row.items():
                        out[name].append(value)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "doc", "twin")), *(pa.array(out[f.name], f.type) for f in list(_OPEN)[3:])], schema=_OPEN
                )

    return joined.select("doc_id", "doc", "twin", "text", "known", "repeats", "open", "heavy").mapInArrow(cut, f"{CUT}, text string, repeats binary, open binary, heavy binary")


def dictionary(left: DataFrame, which: str) -> DataFrame:
    """(key, doc, twin, phrase, content): the bytes of the phrases in the list `which` of each document."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for block in blocks(as_bytes(given.column("text")), lower=False):
                phrases = Phrases(block)
                keys, whole = phrases.keys(), block.buffer.tobytes()
                part = given.slice(block.first, len(block.begins))
                numbers = [np.frombuffer(x or b"", dtype="<i4") for x in part.column(which).to_pylist()]
                text = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
                number = np.concatenate(numbers)
                at = phrases.bounds[text] + number
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[at]),
                        part.column("doc").take(pa.array(text)),
                        part.column("twin").take(pa.array(text)),
                        pa.array(number.astype(np.int32)),
                        pa.array([whole[a:b] for a, b in zip(phrases.starts[at].tolist(), (phrases.ends[at] + DEPTH).tolist(), strict=True)], pa.binary()),
                    ],
                    names=["key", "doc", "twin", "phrase", "content"],
                )

    return left.select("doc", "twin", "text", which).mapInArrow(find, "key long, doc long, twin long, phrase int, content binary")


def _suffix_marks(doc: np.ndarray, twin: np.ndarray, phrase: np.ndarray, contents: list[bytes]) -> np.ndarray:
    """For each phrase the bits of its strings that an earlier phrase among these has as well."""
    sizes = np.array([len(c) for c in contents], dtype=np.int64)
    counts = sizes - DEPTH + 1
    owner = np.repeat(np.arange(len(contents)), counts)
    shift = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    buffer = np.frombuffer(b"".join(contents), dtype=np.uint8)
    starts = (np.cumsum(sizes) - sizes)[owner] + shift
    suffixes = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buffer, DEPTH)[starts]).view(f"S{DEPTH}").ravel()
    place = np.lexsort((phrase, twin, doc))
    later = [x[place][1:] != x[place][:-1] for x in (doc, twin, phrase)]
    rank = np.empty(len(contents), dtype=np.int64)
    rank[place] = np.append(0, np.cumsum(later[0] | later[1] | later[2]))  # equal rows have equal places
    order = np.lexsort((rank[owner], suffixes))  # the suffix array; the parse's order among equals
    ordered, ranks = suffixes[order], rank[owner][order]
    first = np.maximum.accumulate(np.where(np.append(True, ordered[1:] != ordered[:-1]), np.arange(len(order)), 0))
    repeated = order[ranks != ranks[first]]
    bits = np.zeros(len(contents), dtype=np.uint64)
    np.bitwise_or.at(bits, owner[repeated], np.uint64(1) << shift[repeated].astype(np.uint64))
    return bits


def light_marks(phrases: DataFrame) -> DataFrame:
    """(doc, twin, phrase, bits): repeats inside phrases, by suffix arrays over whole keys."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def marked(rows: pa.Table) -> pa.RecordBatch:
            doc, twin, phrase = (rows.column(c).to_numpy() for c in ("doc", "twin", "phrase"))
            bits = _suffix_marks(doc, twin, phrase, rows.column("content").to_pylist())
            some = bits > 0
            return pa.RecordBatch.from_arrays(
                [pa.array(doc[some]), pa.array(twin[some]), pa.array(phrase[some]), pa.array(bits[some].view(np.int64))], names=["doc", "twin", "phrase", "bits"]
            )

        for given in batches:
            for at in range(0, given.num_rows, 2000):
                held.append(given.slice(at, 2000))
                size += 2000 * SPREAD // 2
                if size >= SUFFIXES:  # all but the last key, which may go on
                    rows = pa.Table.from_batches(held).combine_chunks()
                    keys = rows.column("key").to_numpy()
                    done = int(np.searchsorted(keys, keys[-1], side="left"))
                    if done:
                        yield marked(rows.slice(0, done))
                    held = rows.slice(done).to_batches()
                    size = (rows.num_rows - done) * SPREAD // 2
        if held and sum(x.num_rows for x in held):
            yield marked(pa.Table.from_batches(held).combine_chunks())

    by_key = phrases.repartition("key").sortWithinPartitions("key")
    return by_key.mapInArrow(sort, "doc long, twin long, phrase int, bits long")


def heavy_marks(phrases: DataFrame) -> DataFrame:
    """The same for keys with very many phrases: suffixes are grouped one by one, with a first sum in each task."""
    place = F.struct("doc", "twin", "phrase")
    shifts = F.sequence(F.lit(0), F.length("content") - DEPTH)
    strings = phrases.select("doc", "twin", "phrase", "content", F.explode(shifts).alias("shift"))
    strings = strings.select("doc", "twin", "phrase", "shift", F.expr(f"substring(content, shift + 1, {DEPTH})").alias("string"))
    first = strings.groupBy("string").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    repeated = strings.join(first, "string").filter(place != F.col("first"))
    return repeated.groupBy("doc", "twin", "phrase").agg(F.bit_or(F.expr("shiftleft(1L, shift)")).alias("bits"))


def second_cut(left: DataFrame, bits: DataFrame) -> DataFrame:
    """The documents with open phrases, cut by their lists and the bits of their phrases."""
    lists = bits.groupBy(F.col("doc").alias("m_doc"), F.col("twin").alias("m_twin")).agg(
        F.collect_list("phrase").alias("phrases"), F.collect_list("bits").alias("bits")
    )
    joined = left.join(lists, (left.doc == lists.m_doc) & (left.twin == lists.m_twin), "left").select("doc_id", "doc", "twin", "text", "repeats", "phrases", "bits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            texts = as_bytes(given.column("text"))
            for block in blocks(texts, lower=False):
                phrases = Phrases(block)
                part = given.slice(block.first, len(block.begins))
                rows = []
                for i, (repeats, numbers, bits) in enumerate(zip(*(part.column(c).to_pylist() for c in ("repeats", "phrases", "bits")), strict=True)):
                    at = phrases.bounds[i] + np.frombuffer(repeats, dtype="<i4")
                    begins, ends = [phrases.starts[at]], [phrases.ends[at]]
                    if numbers:
                        own = np.array(bits, dtype=np.int64).view(np.uint64)
                        which, shift = np.nonzero((own[:, None] >> np.arange(SPREAD, dtype=np.uint64)) & np.uint64(1))
                        single = phrases.starts[phrases.bounds[i] + np.array(numbers)[which]] + shift
                        begins.append(single)
                        ends.append(single)
                    text = np.frombuffer(texts[block.first + i], dtype=np.uint8)
                    rows.append((len(text), *_cut(text, np.concatenate(begins) - block.begins[i], np.concatenate(ends) - block.begins[i])))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "doc", "twin")), *(pa.array(list(x)) for x in zip(*rows, strict=True))], schema=pa.schema(_CUT)
                )

    return joined.mapInArrow(cut, CUT)


def without_repeats(spark: SparkSession, docs: DataFrame, heavy_key: int = HEAVY_KEY) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    rows, twins = identified(spark, docs)
    cut = kept(spark, first_cut(rows, marks(occurrences(rows), heavy_key)))
    left = cut.filter("text IS NOT NULL")
    bits = light_marks(dictionary(left, "open")).unionAll(heavy_marks(dictionary(left, "heavy")))
    columns = [c.split()[0] for c in CUT.split(", ")]
    result = cut.filter("text IS NULL").select(*columns).unionAll(second_cut(left, bits))
    if twins:  # of equal rows the first stays as it is; in the others every string starts earlier
        nth = F.row_number().over(Window.partitionBy("doc", "twin").orderBy(F.col("doc_id").asc_nulls_last()))
        gone = (nth > 1) & (F.col("n_bytes") >= DEPTH)

        def instead(value: Column, name: str) -> Column:
            return F.when(F.col("gone"), value).otherwise(F.col(name)).alias(name)

        result = result.select("*", gone.alias("gone")).select(
            "doc_id", "n_bytes",
            instead(F.col("n_bytes"), "n_removed"), instead(F.lit(1), "n_spans"), instead(F.lit(hashlib.sha256(b"").hexdigest()), "kept_sha256"),
        )
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op5_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(spark, read(spark, sf_dir, "documents"))
