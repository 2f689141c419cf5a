"""Near-duplicate documents: an exact Jaccard join on sets of word shingles, and its components.

Equal sets are one node, so copies cost nothing. Nodes are joined as the size-aware heavy-light method
does. Tokens have one global order, rarest first by a fixed-size sketch of all sets; a set's first
quarter is its prefix, and similar sets share prefix tokens. Small sets enumerate the two-element subsets of a prefix
that is one longer, of which similar ones share one; large sets are found by scanning inverted lists of single tokens. The
boundary is where the estimated cost of both is least.

Lists are not expanded into pairs. In rounds, one set of each list is paired with the others, first the most central
one and then by a hash; what shares enough tokens is verified on whole sets, and links give components. Lists
with one component are done. When lists with several would give no more pairs than they have entries, or a round
no longer halves their pairs, they give the pairs across components that their places in the lists allow to link, which are
verified in the same way. Two similar sets share a list, so they are linked, or in one component, or such a pair: no link between
components is lost.

Words are runs of non-blanks, A-Z lower-cased; a set has the distinct five-word shingles, or the whole
sequence of fewer words. A text that is NULL or has no words has an empty set, is linked with
nothing and is its own component. Tokens and sets are known by 64-bit hashes. Equal rows, equal and NULL ids are
documents of their own; a NULL id is never the smallest of a component unless there is no other. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablespan.llm.components import components
from tablespan.llm.registry import query, read
from tablespan.llm.tables import added_up
from tablespan.llm.words import NOT_BLANK, Block, as_bytes, blocks, give_back, mixed
from tablespan.sources.shared import kept, kept_and_measured

SHINGLE = 5
SKETCH = 1 << 20  # counters of the token sketch
SLICE_ROWS = 1000  # of a batch that are taken from Arrow together
PART_BYTES = 1 << 18  # of their texts that are worked on together
SIZES = 1 << 8  # set sizes counted one by one, to choose the boundary
SCAN_COST = 4  # of a list entry that is scanned, in subsets that are enumerated
STAR_ROUNDS = 8  # at most, before what is left is paired
PAIRS_PER_ENTRY = 1  # pairs across components that are few enough to be made
HOME_TOKENS = 250_000  # of sets that are compared with one set in one group
BROADCAST_ROWS = 200_000  # requests for sets that are sent to all tasks; more are joined by a shuffle

_SHIFT = np.uint64(64 - SKETCH.bit_length() + 1)
_STEPS = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(SHINGLE)]


def shingle_sets(block: Block) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    starts, ends, bounds = block.words(NOT_BLANK)
    words = block.hashes().of(starts, ends)
    n = max(0, len(words) - SHINGLE + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for k, step in enumerate(_STEPS):
        rolled += words[k : k + n] * np.uint64(step)
    rolled = mixed(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            whole = (words[a:b] * np.array(_STEPS[: b - a], dtype=np.uint64)).sum(dtype=np.uint64)
            out.append(mixed(np.array([whole ^ np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_hash(tokens: np.ndarray) -> int:
    """One 64-bit hash of a set, as a signed number."""
    n = len(tokens)
    sums = np.array([tokens.sum(dtype=np.uint64), mixed(tokens + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], dtype=np.uint64)
    return int(mixed(mixed(sums[:1]) * np.uint64(3) + sums[1:] + np.uint64(n)).view(np.int64)[0])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some rows at a time, so that what a task holds beside a batch is bounded."""
    for given in batches:
        for at in range(0, given.num_rows, SLICE_ROWS):
            yield given.slice(at, SLICE_ROWS)
        give_back()


def sketch(docs: DataFrame) -> np.ndarray:
    """Counts of tokens by hash over all sets, followed by counts of sets by size."""

    def fill(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> None:
        for given in _slices(batches):
            for block in blocks(as_bytes(given.column("text")), size=PART_BYTES):
                sets = shingle_sets(block)
                tokens = np.concatenate(sets)
                table[:SKETCH] += np.bincount((tokens >> _SHIFT).astype(np.int64), minlength=SKETCH).astype(np.uint64)
                sizes = np.minimum([len(s) for s in sets], SIZES - 1)
                table[SKETCH:] += np.bincount(sizes, minlength=SIZES).astype(np.uint64)

    return added_up(docs.select("text"), fill, SKETCH + SIZES, "uint64")


def least_overlap(size: int) -> int:
    """What a set of this size shares with any set that it links to."""
    return -(-3 * size // 4)


def boundary(sizes: np.ndarray) -> int:
    """The largest size of sets whose subsets are enumerated, from counts of sets by size."""
    n = np.arange(len(sizes))
    prefix = n - (3 * n + 3) // 4 + 1
    subsets = sizes * (prefix + 1) * prefix / 2
    scans = sizes * prefix * (1 + SCAN_COST)
    costs = [subsets[2 : x + 1].sum() + scans[3 * x // 4 + 1 :].sum() for x in range(len(n) - 1)]
    return int(np.argmin(costs))


def signatures(tokens: np.ndarray, counts: np.ndarray, limit: int) -> np.ndarray:
    """The lists that a set is entered in. Odd numbers stand for subsets, even ones for single tokens."""
    size = len(tokens)
    if size < 2:  # links to its equals only, which are one node
        return tokens[:0]
    ordered = tokens[np.lexsort((tokens, counts[(tokens >> _SHIFT).astype(np.int64)]))]
    prefix = size - least_overlap(size) + 1
    out = []
    if size <= limit:
        part = np.sort(ordered[: prefix + 1])
        i, j = np.triu_indices(len(part), 1)
        out.append(mixed(part[i] * np.uint64(_STEPS[1]) + part[j]) | np.uint64(1))
    if 4 * size > 3 * limit:
        out.append(ordered[:prefix] & ~np.uint64(1))
    return np.concatenate(out)


def entered(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, node, size, lists): each document's set; lists are given once for a node and task."""
    limit = boundary(counts[SKETCH:])
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counts[:SKETCH], 2**32 - 1).astype(np.uint32))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for given in _slices(batches):
            for block in blocks(as_bytes(given.column("text")), size=PART_BYTES):
                sets = shingle_sets(block)
                nodes = [set_hash(s) if len(s) else None for s in sets]
                lists = []
                for node, tokens in zip(nodes, sets, strict=True):
                    fresh = node is not None and node not in met
                    met.add(node)
                    lists.append(signatures(tokens, shared.value, limit) if fresh else tokens[:0])
                part = given.slice(block.first, len(sets))
                bounds = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(nodes, pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(lists).view(np.int64))),
                    ],
                    names=["doc_id", "text_hash", "node", "size", "lists"],
                )

    return rows.mapInArrow(enter, "doc_id long, text_hash long, node long, size long, lists array<long>")


def shared_lists(sets: DataFrame) -> DataFrame:
    """(token, node, size, at): entries of lists with two nodes or more; a list streams through its task.

    `at` is a single token's place in its set; those of subsets are not used.
    """
    entered = sets.filter(F.size("lists") > 0).select(F.posexplode("lists").alias("at", "token"), "node", "size", F.size("lists").alias("n"))
    prefix = F.col("size") - F.ceil(F.lit(3) * F.col("size") / F.lit(4)) + 1  # single tokens stand last, in their order
    place = F.greatest(F.col("at") - (F.col("n") - prefix), F.lit(0))
    entries = entered.select("token", "node", (F.shiftleft("size", 32) + place).alias("packed"))
    order = Window.partitionBy("token").orderBy("node")
    rows = entries.select("*", F.lag("node").over(order).alias("before"), F.lead("node").over(order).alias("after"))
    shared = rows.filter((F.col("before") != F.col("node")) | (F.col("after") != F.col("node")))
    return shared.select("token", "node", F.shiftright("packed", 32).alias("size"), F.col("packed").bitwiseAND((1 << 32) - 1).alias("at"))


def _alike(a: Column, b: Column) -> Column:
    return 4 * F.least(a, b) >= 3 * F.greatest(a, b)


def _enough(a: Column, b: Column, count: Column, subsets: Column) -> Column:
    """Whether sets of sizes a and b that share so many lists may link.

    Of the set whose prefix ends first, all shared tokens are shared prefix tokens or lie behind the
    prefix; so the overlap is at most their number and the longer of the rests.
    """
    needed = F.ceil(3 * (a + b) / F.lit(7))
    rest = F.ceil(F.lit(3) * F.greatest(a, b) / F.lit(4)) - 1
    return (subsets > 0) | (count >= needed - rest)


def _candidates(pairs: DataFrame) -> DataFrame:
    """(a, b, a_size, b_size) of pairs (a, b, a_size, b_size, token) that share enough lists."""
    odd = F.col("token").bitwiseAND(F.lit(1))
    counted = pairs.filter(_alike(F.col("a_size"), F.col("b_size"))).groupBy("a", "b", "a_size", "b_size").agg(
        F.sum(1 - odd).alias("singles"), F.sum(odd).alias("subsets")
    )
    return counted.filter(_enough(F.col("a_size"), F.col("b_size"), F.col("singles"), F.col("subsets"))).select("a", "b", "a_size", "b_size")


def verified(spark: SparkSession, docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose whole sets link.

    The partners of `a` are split into homes of a bounded number of tokens. A set travels once to
    each home that needs it, made from its text on the way.
    """
    pairs = kept(spark, pairs)
    loads = pairs.groupBy("a").agg((F.floor(F.sum("b_size") / HOME_TOKENS) + 1).alias("homes"))
    placed = pairs.join(loads, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("homes")))
    wanted = placed.select(F.col("b").alias("node"), F.struct("a", "salt").alias("home")).unionAll(
        placed.select(F.col("a").alias("node"), F.struct("a", "salt").alias("home")).distinct()
    )
    nodes = wanted.select("node").distinct()
    sources = sets.select("node", "doc_id", "text_hash").join(nodes, "node", "left_semi").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_hash"))).alias("s")
    )
    named = wanted.join(sources, "node").select("node", "home", F.col("s.doc_id").alias("wanted_id"), F.col("s.text_hash").alias("wanted_hash"))
    requests, (n,) = kept_and_measured(spark, named, F.count("*"))
    if n <= BROADCAST_ROWS:
        requests = F.broadcast(requests)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    same = texts.doc_id.eqNullSafe(F.col("wanted_id")) & (texts.text_hash == F.col("wanted_hash"))
    found = texts.join(requests, same).select("node", F.col("home.a").alias("a"), F.col("home.salt").alias("salt"), "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in _slices(batches):
            for block in blocks(as_bytes(given.column("text")), size=PART_BYTES):
                tokens = [s.tobytes() for s in shingle_sets(block)]
                part = given.slice(block.first, len(tokens))
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("a"), part.column("salt"), pa.array(tokens, pa.binary())], names=["node", "a", "salt", "tokens"])

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        held = dict(zip(frame.node, frame.tokens, strict=True))
        first = np.frombuffer(held.pop(key[0]), dtype=np.uint64)
        linked = []
        for node, tokens in held.items():
            second = np.frombuffer(tokens, dtype=np.uint64)
            common = len(np.intersect1d(first, second, assume_unique=True))
            if 7 * common >= 3 * (len(first) + len(second)):
                linked.append(node)
        return pd.DataFrame({"a": [key[0]] * len(linked), "b": linked}, dtype="int64")

    made = found.mapInArrow(make, "node long, a long, salt long, tokens binary")
    return made.groupBy("a", "salt").applyInPandas(compare, "a long, b long")


def _open(entries: DataFrame) -> DataFrame:
    """Entries of lists that have several labels."""
    several = entries.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return entries.join(several.select("token"), "token", "left_semi")


def _stars(entries: DataFrame, weight: Column) -> DataFrame:
    """Pairs of each list's heaviest set with the sets of other labels in it."""
    weighted = entries.withColumn("weight", F.struct(weight.alias("w"), F.col("node").alias("n")))
    hubs = weighted.groupBy("token").agg(F.max(F.struct("weight", "node", "size", "label")).alias("hub"))
    rows = weighted.join(hubs, "token").filter(F.col("label") != F.col("hub.label"))
    return rows.select(F.col("hub.node").alias("a"), F.col("node").alias("b"), F.col("hub.size").alias("a_size"), F.col("size").alias("b_size"), "token")


def _across(entries: DataFrame) -> DataFrame:
    """(a, b, a_size, b_size) of sets of different labels that may link, as far as their lists and places show.

    At the first token that two sets share, their overlap is at most what is left of either from there
    on. Sets that link need ceil(3 (m + n) / 7) common tokens, so that token lies in the first seventh of the one
    that is not larger: only those entries meet all others, and only where both have enough left. Texts that share
    a frequent passage but little else have it late in their order, so they do not pair. Two sets share at most as many lists
    as the one in fewer of them is in, so the rule for pairs that share enough holds back more.
    """
    entries = entries.join(entries.groupBy("node").agg(F.count("*").alias("lists")), "node")
    left = F.col("size") - F.col("at")
    subset = F.col("token").bitwiseAND(F.lit(1)) == 1
    early = entries.filter(subset | (7 * left >= 6 * F.col("size")))
    a, b = (
        side.select("token", *(F.col(c).alias(f"{name}{c}") for c in ("node", "size", "label", "lists", "at")))
        for name, side in (("a", early), ("b", entries))
    )
    odd = a.token.bitwiseAND(F.lit(1))
    smaller = (a.asize < b.bsize) | ((a.asize == b.bsize) & (a.anode < b.bnode))
    reach = (odd == 1) | (7 * F.least(a.asize - a.aat, b.bsize - b.bat) >= 3 * (a.asize + b.bsize))
    able = _enough(a.asize, b.bsize, F.least(a.alists, b.blists), odd) & _alike(a.asize, b.bsize)
    pairs = a.join(b, (a.token == b.token) & smaller & (a.alabel != b.blabel) & able & reach).drop(b.token)
    named = pairs.select(F.col("anode").alias("a"), F.col("bnode").alias("b"), F.col("asize").alias("a_size"), F.col("bsize").alias("b_size"))
    return named.distinct()


def node_components(spark: SparkSession, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, label) of all nodes that link to another one."""
    lists = kept(spark, shared_lists(sets))
    # A set whose lists all have company is central among its near copies.
    central = lists.groupBy("node").agg((F.count("*") / F.max("size")).alias("central"))
    entries = kept(spark, lists.join(central, "node").distinct().withColumn("label", F.col("node")))
    links = spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))  # not rows of the driver, which would pass Python workers
    weight, before = F.col("central"), float("inf")
    for n in range(STAR_ROUNDS):
        found = kept(spark, verified(spark, docs, sets, _candidates(_stars(entries, weight))))
        labels = components(spark, links.unionAll(found))
        links = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))  # stars in place of all links so far
        relabelled = entries.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        entries = kept(spark, _open(relabelled))
        by_label = entries.groupBy("token", "label").agg(F.count("*").alias("n"))
        by_token = by_label.groupBy("token").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
        sums = by_token.agg(F.sum("n").alias("entries"), F.sum((F.col("n") * F.col("n") - F.col("same")) / 2).alias("pairs")).first()
        if not sums.entries or sums.pairs <= PAIRS_PER_ENTRY * sums.entries or 2 * sums.pairs > before:
            break
        before = sums.pairs
        weight = F.xxhash64("node", F.lit(n))
    more = verified(spark, docs, sets, _across(entries))
    return components(spark, links.unionAll(more))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, label) of every document.

    `label` names the component also where it has no id; it is NULL for an empty set.
    """
    sets = kept(spark, entered(docs, sketch(docs)))
    labels = node_components(spark, docs, sets)
    nodes = sets.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    nodes = kept(spark, nodes)
    smallest = nodes.groupBy("label").agg(F.min("least").alias("component_id"))
    named = nodes.join(smallest, "label").select("node", "component_id", "label")
    return sets.join(named, "node", "left").select(
        "doc_id",
        "text_hash",
        F.col("size").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "label",
    )


def first_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: that with the smallest id, then hash.

    Documents with empty sets stay. Of equal rows one stays.
    """
    rows = kept(spark, near_duplicates(spark, docs).filter("label IS NOT NULL").groupBy("label", "doc_id", "text_hash").agg(F.count("*").alias("n")))
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = rows.groupBy("label").agg(F.min(own).alias("first"))
    others = rows.join(first, "label").filter(own != F.col("first")).select("doc_id", "text_hash")
    others, (n_others,) = kept_and_measured(spark, others.distinct(), F.count("*"))
    twins, (n_twins,) = kept_and_measured(spark, rows.filter("n > 1").select("doc_id", "text_hash"), F.count("*"))
    named = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    marked = docs.select(*named, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))

    def among(frame: DataFrame, n: int, how: str) -> DataFrame:
        held = F.broadcast(frame) if n <= BROADCAST_ROWS else frame
        held = held.select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash"))
        return marked.join(held, marked.doc_id.eqNullSafe(F.col("h_id")) & (marked.text_hash == F.col("h_hash")), how)

    marked = among(others, n_others, "left_anti")
    if n_twins:
        marked = among(twins, n_twins, "left_anti").unionByName(among(twins, n_twins, "left_semi").dropDuplicates(["doc_id", "text_hash"]))
    return marked.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


@query(
    r"""
    WITH RECURSIVE d AS (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT r, array_to_string(w[i + 1 : i + 5], ' ') AS t
          FROM (SELECT r, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    links AS (SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.t = b.t AND a.r <> b.r
              JOIN n x ON x.r = a.r JOIN n y ON y.r = b.r
              GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
    reach(a, b) AS (SELECT r, r FROM n UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least_id AS (SELECT reach.a AS r, min(doc_id) AS c FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
    SELECT doc_id, coalesce(n.n, 0) AS n_shingles, CASE WHEN n.n IS NULL THEN doc_id ELSE c END AS component_id
    FROM d LEFT JOIN n USING (r) LEFT JOIN least_id USING (r)
    """
)
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, read(spark, sf_dir, "documents")).drop("text_hash", "label")
