"""Spelling variants: words one edit apart, joined by asymmetric chunks, and the word that each is a form of.

Two words that are one insertion, deletion or replacement apart share all that the edit leaves alone. The shorter
word (of two equally long ones, either) gives disjoint chunks: its two halves, and the half that is touched gives two
again, since it is one edit away from its counterpart too. So it gives four keys, each a kept half with a kept quarter.
The other word gives its positional grams, for partners of its own length and one less: the chunk's own place, or that place
shifted by one behind the edit. Equal keys of one partner length join, and pairs are verified by their edit distance.
A key holds about three quarters of a word, so lists stay short however many words begin or end alike; no pair is lost,
because one edit touches one quarter only.

Words are maximal runs of letters, A-Z lower-cased. Where the crc32 of a document's id and a run is divisible by
`damage`, the run loses one code point first, as the contract of the query says. A NULL text has no words, a NULL
id counts as an empty one. Repeated rows count again. Words with fewer than `least_count` occurrences, or shorter than
`least_length` (6 at least, so that no quarter is empty), are left out before and after all counts. Equally frequent
near words are ordered by code points. Other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm.registry import query, read
from tablespan.sources.shared import kept

LETTERS = "[a-zÀ-ÿ]+"  # of lower-cased texts
LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_RATIO = 5  # a form is so many times as frequent
DAMAGE = 199  # one of so many runs loses a code point
QUARTERS = 4


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    text = F.translate(F.col("text").cast("string"), ascii_uppercase, ascii_lowercase)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= least_length)
    mark = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("mark"), F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    words = runs.withColumn("mark", mark).select(F.when(F.col("mark") % damage == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _bounds(length: Column) -> list[Column]:
    """Where the quarters of a word of this length begin, and its end."""
    half = F.floor(length / 2)
    return [F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length]


def _keys(word: Column, length: Column, longer: int) -> Column:
    """What is left of a word without each quarter, as a partner of `length` cuts it; this word is `longer` by 0 or 1.

    The quarter that is left out is longer by as much, so what follows it is shifted.
    """
    bounds = [b.cast("int") for b in _bounds(length)]
    kept_parts = [
        F.xxhash64(length.cast("int"), F.lit(k), F.concat(word.substr(F.lit(1), bounds[k]), word.substr(bounds[k + 1] + 1 + longer, length)))
        for k in range(QUARTERS)
    ]
    return F.array(*kept_parts)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) of all pairs of words one edit apart, each pair once, from distinct (word, n)."""
    word, length = F.col("word"), F.length("word")
    own = words.select(F.explode(_keys(word, length, 0)).alias("key"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    as_long = own.select("key", F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    longer = words.select(F.explode(_keys(word, length - 1, 1)).alias("key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = own.join(as_long, "key").filter("a < b").unionAll(own.join(longer, "key"))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()


def followed(spark: SparkSession, steps: DataFrame) -> DataFrame:
    """(word, root) for each (word, form): the last word that steps lead to, by doubling.

    Each step multiplies the count by FORM_RATIO at least, so no walk is long or closed.
    """
    hops = kept(spark, steps.select("word", F.col("form").alias("root")))
    while True:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = kept(spark, hops.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        hops = longer.select("word", "root")
        if not longer.filter("moved").head(1):
            return hops


def variants(spark: SparkSession, docs: DataFrame, ratio: int = FORM_RATIO, **limits: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word; `limits` as in `word_counts`."""
    words = kept(spark, word_counts(docs, **limits))
    pairs = kept(spark, near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    taken = -F.col("best.order") >= ratio * F.col("n")
    rows = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.order")).alias("form_n")
    )
    rows = kept(spark, rows)
    roots = followed(spark, rows.filter("form IS NOT NULL").select("word", "form"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query(
    r"""
    WITH RECURSIVE r AS (
      SELECT coalesce(doc_id::VARCHAR, '') AS id,
             unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
      FROM documents),
    h AS (SELECT id, run, count(*) AS k, hex(encode(id || ':' || run)) AS x FROM r WHERE length(run) >= 6 GROUP BY id, run),
    crc AS (SELECT run, k, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
                range(1, len(x), 2), lambda i: [('0x' || x[i:i + 1])::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
              lambda c, b: CASE WHEN xor(c, b) % 2 = 1 THEN xor(xor(c, b) // 2, 3988292384::UBIGINT) ELSE xor(c, b) // 2 END)) AS m FROM h),
    w AS (SELECT CASE WHEN m % 199 = 0 THEN substr(run, 1, (m % length(run))::BIGINT) || substr(run, (m % length(run))::BIGINT + 2) ELSE run END AS word, k FROM crc),
    v AS (SELECT word, sum(k)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
    left_out AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
    near AS (SELECT a.word, b.word AS other, b.n FROM left_out a JOIN left_out b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
             UNION SELECT v.word, l.word, l.n FROM v JOIN left_out l ON v.word = l.rest
             UNION SELECT l.word, v.word, v.n FROM v JOIN left_out l ON v.word = l.rest),
    best AS (SELECT word, count(*) AS n_near, min({'o': -n, 'w': other}) AS b FROM near GROUP BY word),
    f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.o >= 5 * v.n THEN b.w END AS form, CASE WHEN -b.o >= 5 * v.n THEN -b.o END AS form_n
          FROM v LEFT JOIN best USING (word)),
    walk AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.next)
    SELECT f.word, f.form, walk.at AS root, n, n_near, form_n FROM f JOIN walk ON walk.word = f.word AND walk.next IS NULL
    """
)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark, read(spark, sf_dir, "documents"))
