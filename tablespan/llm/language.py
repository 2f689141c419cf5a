"""Language identification by unigram pieces, summed over all segmentations.

The pieces are those of a public vocabulary; the single bytes among them spell every word. Each language
has a probability for each piece, learned by expectation maximisation from counted words. A word's probability is the
sum over all ways to cut it into pieces, by the forward algorithm; a text's is the product over its words. The
forward pass runs over all distinct words of a block at once, and a task remembers words it has met.

Words are runs of letters and of all signs beyond ASCII, in lower case, each after a marker of its start. A
text that is NULL or has no letter is `und` with score 0, and so is every text where no language was learned.
Learning takes every word of its documents; long ones, as runs of signs of scripts without blanks are, in consecutive
parts of whole signs, of which only the first has the marker.
Training uses a documented number of documents of each language, chosen by a hash of their ids, so every language that
rows are marked with is learned; NULL languages and NULL ids are left out of it. Equal rows are documents of their own. Ties go to the first language by name. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm.pretokens import distinct_values
from tablespan.llm.registry import query, read
from tablespan.llm.words import SpanHashes, _BYTE_VALUES, blocks, class_table, give_back
from tablespan.sources.shared import kept

VOCABULARY = "piece_bpe_32k.model"
#: The vocabulary's mark of a word's start, and the byte that stands for it here.
MARK, START = "▁", b" "
LETTERS = class_table(rb"[a-z\x80-\xFF]")

TRAIN_DOCS = 5_000  # of each language that the model is learned from, chosen by hash
MOST_LANGUAGES = 200
ROUNDS = 3
SMOOTHING = 0.2  # of a count, added to every piece
TRAIN_WORD_BYTES = 24  # of a word's part that is learned from, with the marker, so that sums need no scaling
EVIDENCE_WORDS = 20  # a longer text's evidence is scaled to so many words for the score
SLICE_ROWS = 500  # of a batch that are worked on at once
SLICE_BYTES = 1 << 18  # of their texts that are worked on together
BROADCAST_ROWS = 100_000  # languages whose shares are sent to all tasks; more are joined by a shuffle
KNOWN_WORDS = 120_000  # a task remembers so many, then starts anew
CELLS = 1 << 16  # words times bytes at once, where all sums are held
LANES = CELLS // 8  # words at once, where only the last sums are held
AHEAD = 1 << 16  # ends of words whose pieces are looked up at once
UNKNOWN = "und"
LEAST_SCORE = 0.5  # of a document that is taken to be in a language
HELD_OUT = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


@cache
def vocabulary(path: str) -> list[bytes]:
    """The pieces that words can be made of, as bytes; every single byte is one."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            piece = model.id_to_piece(i).replace(MARK, START.decode()).encode()
            if LETTERS[np.frombuffer(piece[1:], dtype=np.uint8)].all() and (piece[:1] == START or LETTERS[piece[0]]):
                pieces.add(piece)
    return sorted(pieces)


def _joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A buffer of all words, and their starts and lengths in it."""
    lengths = np.array(list(map(len, words)), dtype=np.int64)
    return np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


class Pieces:
    """The vocabulary as sorted hashes."""

    def __init__(self, pieces: list[bytes]):
        buffer, starts, lengths = _joined(pieces)
        hashes = SpanHashes(_BYTE_VALUES[buffer]).of(starts, starts + lengths)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        self.lengths = sorted(set(lengths.tolist()))
        self.n = len(pieces)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The pieces' numbers; n for spans that are none."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), self.n - 1)
        return np.where(self.hashes[at] == hashes, self.ids[at], self.n)


def _groups(lengths: np.ndarray, lanes: int | None = None) -> Iterator[np.ndarray]:
    """Numbers of words of like lengths, not too many at once: `lanes`, or as many as all their bytes allow."""
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        shortest = int(lengths[order[at]])
        longest = max(8, -(-shortest // 4) * 4 if shortest <= 64 else 2 * shortest)
        upto = int(np.searchsorted(lengths[order], longest, side="right"))
        step = lanes or max(1, CELLS // longest)
        for a in range(at, upto, step):
            yield order[a : min(a + step, upto)]
        at = upto


def _spans(pieces: Pieces, hashes: SpanHashes, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, list[tuple[int, np.ndarray]]]]:
    """For each end j: (piece length, piece number of each word) of all pieces that may end there."""
    longest, ahead = int(lengths.max()), max(1, AHEAD // len(starts))
    for first in range(1, longest + 1, ahead):
        ends = np.arange(first, min(first + ahead, longest + 1))
        inside = ends[:, None] <= lengths
        stops = np.minimum(starts + ends[:, None], len(hashes.sums) - 1)
        found: list[list[tuple[int, np.ndarray]]] = [[] for _ in ends]
        for size in pieces.lengths:
            if size > ends[-1]:
                break
            short = max(0, size - first)  # ends before the piece's length
            to = stops[short:]
            ids = pieces.find(hashes.of(np.minimum(starts + ends[short:, None] - size, to), to))
            ids[~inside[short:]] = pieces.n
            for i in np.flatnonzero((ids < pieces.n).any(axis=1)).tolist():
                found[short + i].append((size, ids[i]))
        yield from zip(ends.tolist(), found, strict=True)


def log_probabilities(pieces: Pieces, chances: np.ndarray, words: list[bytes]) -> np.ndarray:
    """The log probability of each word in each language, summed over all segmentations.

    `chances`: pieces by languages, with a last row of zeros. Values are scaled at every step.
    """
    buffer, starts, lengths = _joined(words)
    hashes = SpanHashes(_BYTE_VALUES[buffer])
    k = chances.shape[1]
    out = np.zeros((len(words), k))
    for group in _groups(lengths, LANES):
        n, reach = len(group), min(pieces.lengths[-1], int(lengths[group].max()))
        ring = np.zeros((reach + 1, n, k))  # sums for the last positions, all on the scale of `scale`
        ring[0] = 1.0
        scale = np.zeros((n, k))
        for j, found in _spans(pieces, hashes, starts[group], lengths[group]):
            total = np.zeros((n, k))
            for size, ids in found:
                total += ring[(j - size) % (reach + 1)] * chances[ids]
            ring[j % (reach + 1)] = total
            small = (total > 0) & (total < 1e-100)
            if small.any():
                factor = np.where(small, total, 1.0)
                ring /= factor
                scale += np.log(factor)
            done = lengths[group] == j
            if done.any():
                with np.errstate(divide="ignore"):
                    out[group[done]] = np.log(ring[j % (reach + 1)][done]) + scale[done]
    return out


def expected_counts(pieces: Pieces, chances: np.ndarray, words: list[bytes], times: np.ndarray) -> np.ndarray:
    """Expected uses of each piece by forward and backward sums; `times`: words by languages."""
    buffer, starts, lengths = _joined(words)
    hashes = SpanHashes(_BYTE_VALUES[buffer])
    k = chances.shape[1]
    counts = np.zeros((pieces.n + 1, k))
    for group in _groups(lengths):
        own, n, longest = lengths[group], len(group), int(lengths[group].max())
        forward = np.zeros((longest + 1, n, k))
        forward[0] = 1.0
        steps = []
        for j, found in _spans(pieces, hashes, starts[group], own):
            for size, ids in found:
                forward[j] += forward[j - size] * chances[ids]
            steps.append((j, found))
        whole = forward[own, np.arange(n)]
        weight = np.divide(times[group], whole, out=np.zeros((n, k)), where=whole > 0)
        backward = np.zeros((longest + 1, n, k))
        backward[own, np.arange(n)] = 1.0
        for j, found in reversed(steps):
            for size, ids in found:
                chance = chances[ids]
                np.add.at(counts, ids, forward[j - size] * chance * backward[j] * weight)
                backward[j - size] += chance * backward[j]
    return counts[:-1]


def _lowered(column: pa.Array) -> list[bytes]:
    return [(text or "").lower().encode() for text in column.to_pylist()]


def _parts(word: bytes) -> list[bytes]:
    """The marked word, or its consecutive parts of less than TRAIN_WORD_BYTES and a marker; no sign is cut."""
    parts, at = [], 0
    while len(word) - at >= TRAIN_WORD_BYTES:
        to = at + TRAIN_WORD_BYTES - 1
        while word[to] & 0xC0 == 0x80:
            to -= 1
        parts.append(word[at:to])
        at = to
    parts.append(word[at:])
    return [START + parts[0], *parts[1:]]


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n): how often each marked word, or part of a long one, occurs in each language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (given.slice(at, SLICE_ROWS) for given in batches for at in range(0, given.num_rows, SLICE_ROWS))
        for part in slices:
            for lang in part.column("lang").unique().to_pylist():
                rows = part.filter(pa.compute.equal(part.column("lang"), lang))
                for block in blocks(_lowered(rows.column("text")), lower=False, size=SLICE_BYTES):
                    starts, ends, _ = block.words(LETTERS)
                    distinct, first, place = distinct_values(block.hashes().of(starts, ends))
                    whole = block.buffer.tobytes()
                    parts = [_parts(whole[a:b]) for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
                    n = np.bincount(place, minlength=len(distinct)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * sum(map(len, parts)), pa.string()),
                            pa.array([p for own in parts for p in own], pa.binary()),
                            pa.array(np.repeat(n, np.array(list(map(len, parts)), dtype=np.int64))),
                        ],
                        names=["lang", "word", "n"],
                    )

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, word binary, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Languages, pieces, and the pieces' probabilities in each language."""

    def __init__(self, languages: list[str], pieces: Pieces, chances: np.ndarray):
        self.languages, self.pieces, self.chances = languages, pieces, chances


def training_docs(docs: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """(lang, text): of each language about `most` of the documents with an id that are not held out; all if there are fewer."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select(F.col("lang").alias("lang"), "doc_id", "text")
    shares = rows.groupBy("lang").agg((F.lit(most) / F.count("*")).alias("share")).withColumnRenamed("lang", "of")
    shares = kept(docs.sparkSession, shares)
    if shares.count() <= BROADCAST_ROWS:  # the texts stay where they are
        shares = F.broadcast(shares)
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    return rows.join(shares, (rows.lang == shares.of) & chosen).select("lang", "text")


def learn(spark: SparkSession, docs: DataFrame, path: str, rounds: int = ROUNDS) -> Model:
    """A model from documents with `lang` and `text`. The driver gets pieces by languages, no texts."""
    words = kept(spark, word_counts(docs))
    languages = sorted(r.lang for r in words.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    pieces = Pieces(vocabulary(path))
    chances = np.full((pieces.n, len(languages)), 1.0 / pieces.n)
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast((languages, pieces, np.vstack([chances, np.zeros(len(languages))])))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, own, p = shared.value
            counts = np.zeros((own.n, len(names)))
            for given in batches:
                n = np.zeros((given.num_rows, len(names)))
                column = np.array([names.index(x) for x in given.column("lang").to_pylist()], dtype=np.int64)
                n[np.arange(given.num_rows), column] = given.column("n").to_numpy()
                counts += expected_counts(own, p, given.column("word").to_pylist(), n)
            piece, lang = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(counts[piece, lang])], names=["piece", "lang", "n"])

        got = words.mapInArrow(expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full((pieces.n, len(languages)), SMOOTHING)
        counts[got.piece, got.lang] += got.n
        chances = counts / counts.sum(axis=0)
    return Model(languages, pieces, chances)


_known: dict = {}


def _scores(model: Model, words: list[bytes], hashes: list[int]) -> np.ndarray:
    """Log probabilities of distinct words, from the task's memory where it has them."""
    if _known.get("model") is not model or len(_known["places"]) > KNOWN_WORDS:
        _known.update(model=model, places={}, rows=np.zeros((1 << 10, len(model.languages)), dtype=np.float32))
    places = _known["places"]
    at = list(map(places.get, hashes))
    missing = [i for i, x in enumerate(at) if x is None]
    if missing:
        fresh = log_probabilities(model.pieces, model.chances, [START + words[i] for i in missing])
        had = len(places)
        for i, place in zip(missing, range(had, had + len(missing)), strict=True):
            at[i] = places[hashes[i]] = place
        if len(places) > len(_known["rows"]):
            _known["rows"] = np.resize(_known["rows"], (1 << len(places).bit_length(), len(model.languages)))
        _known["rows"][had : len(places)] = fresh
    return _known["rows"][at]


def identified(docs: DataFrame, model: Model, carried: list[str], text: str = "text") -> DataFrame:
    """The carried columns of each row with `lang_pred` and `score`; neither name may be carried.

    Batches are worked on in slices, so what a task holds beside a batch is bounded.
    """
    ended = Model(model.languages, model.pieces, np.vstack([model.chances, np.zeros(len(model.languages))]))
    shared = docs.sparkSession.sparkContext.broadcast(ended)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for given in batches:
                for at in range(0, given.num_rows, SLICE_ROWS):
                    part = given.slice(at, SLICE_ROWS)
                    predicted, scores = _predictions(shared.value, part.column(text).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in carried), pa.array(predicted, pa.string()), pa.array(scores, pa.float64())],
                        names=[*carried, "lang_pred", "score"],
                    )
                give_back()
        finally:
            _known.clear()  # the process goes on to other tasks
            give_back()

    types = dict(docs.dtypes)
    kinds = ", ".join(f"`{c}` {types[c]}" for c in carried)
    return docs.select(*dict.fromkeys([*carried, text])).mapInArrow(score, f"{kinds}, lang_pred string, score double")


def _predictions(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The language and the score of each text."""
    k = len(model.languages)
    predicted: list[str] = []
    scores: list[float] = []
    for block in blocks([(text or "").lower().encode() for text in texts], lower=False, size=SLICE_BYTES):
        starts, ends, bounds = block.words(LETTERS)
        n = len(bounds) - 1
        sums = np.zeros((n, max(1, k)))
        if len(starts) and k:
            distinct, first, place = distinct_values(block.hashes().of(starts, ends))
            whole = block.buffer.tobytes()
            words = [whole[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            logs = _scores(model, words, distinct.tolist())[place].astype(np.float64)
            before = np.vstack([np.zeros(k), np.cumsum(logs, axis=0)])
            sums = before[bounds[1:]] - before[bounds[:-1]]
        count = np.diff(bounds)
        sums = sums / np.maximum(1.0, count / EVIDENCE_WORDS)[:, None]
        chance = np.exp(sums - sums.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        for i in range(n):
            text = texts[block.first + i]
            known = bool(k and count[i] and text and _has_letter(text))
            predicted.append(model.languages[best[i]] if known else UNKNOWN)
            scores.append(float(chance[i, best[i]]) if known else 0.0)
    return predicted, scores


def _has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


def model_for(spark: SparkSession, docs: DataFrame) -> Model:
    return learn(spark, training_docs(docs), public_tokenizers.path(VOCABULARY))


def in_known_languages(spark: SparkSession, docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents that have a language with at least that score, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)))
    text = names[docs.columns.index("text")]
    kept_rows = identified(rows, model_for(spark, docs), names, text).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept_rows.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))


@query()
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    result = identified(docs, model_for(spark, docs), ["doc_id"])
    return result.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
