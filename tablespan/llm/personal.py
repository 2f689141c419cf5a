"""Personal data in texts, in DataFrame functions throughout: fixed patterns, then bootstrapped contexts.

Base kinds are found by patterns and checked (address parts, Luhn sums, numbers of digits). They seed a
search for identifiers that no pattern knows: each checked span is a seed as a whole, also with blanks in it,
and spans that overlap are one. In the text around them a mention is a word, or the rest of one, with a digit or
an @. The two words before the word in which it starts are its lexical pattern, whatever stands in them: a checked span
in them counts by its kind, a number as 0. Patterns and instances form a graph, in which scores go back and forth:
a pattern is as good as the mean of its instances, damped where it has few, and an instance is as
good as its patterns make it together (noisy or); seeds keep a score of one. A pattern takes part when it has
enough seeds or discovered instances, those with a high score. What is discovered in one hop makes patterns of the next,
until a hop adds nothing or MOST_HOPS are done. Instances discovered in the end are reported wherever they stand, as kind
`context`.

Java's matcher does the finding. All patterns are written so that it runs in linear time and without
recursion: runs are possessive, and a run is entered at its start only. Start positions are sums of the
lengths between the matches.

A NULL text is empty. Equal rows and rows with equal or NULL ids are documents of their own. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm.registry import query, read
from tablespan.sources.shared import kept

#: The base kinds in order, each with its pattern in a linear form.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a pattern to match at all; finding these is cheap.
NEEDED = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PARTS = rf"^(?:{BYTE}\.){{3}}{BYTE}$"
#: Noncharacters that stand for checked spans while mentions are cut: the first sign of a span by kind, and all its others.
FIRSTS, REST, STRAY = "\uFDD0\uFDD1\uFDD2\uFDD3", "\uFDD4", "\uFDEF"
MENTION = rf"[{FIRSTS}]{REST}*+|(?<![^\s{FIRSTS}{REST}])[^\s0-9@{FIRSTS}{REST}]*+[0-9@][^\s{FIRSTS}{REST}]*+"
BLANKS = r"\s+"

ROUNDS = 2  # of scores in a hop
MOST_HOPS = 10
LEAST_SEEDS = 3  # distinct seeds or discovered instances that a pattern needs
LEAST_SCORE = 0.6  # of an instance that is reported
LEAST_DIGITS = 4  # in an instance that is reported, unless it has an @
RUN = 128
BROADCAST_ROWS = 100_000  # documents with discovered spans that are sent to all tasks; more are joined by a shuffle


def _luhn(value: Column) -> Column:
    """Whether a digit string's Luhn sum ends in zero."""

    def digit(i: Column) -> Column:
        d = F.substr(value, F.length(value) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(value) - 1), F.lit(0), lambda s, i: s + digit(i)) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(PARTS)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _runs(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """What the values before each run of RUN make together; NULL without values."""
    zero = F.lit(0).cast("long")
    made = F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int")),
        F.array(zero),
        lambda sums, k: F.array_append(sums, merge(F.element_at(sums, -1), F.aggregate(F.slice(values, k * RUN + 1, RUN), zero, merge))),
    )
    return F.when(F.size(values) > 0, made)


def _upto(values: Column, runs: Column, n: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """What the first n values make together."""
    run = F.floor(n / RUN).cast("int")
    return merge(F.get(runs, run), F.aggregate(F.slice(values, run * RUN + 1, n - run * RUN), F.lit(0).cast("long"), merge))


def located(rows: DataFrame, patterns: dict[str, tuple[str, Column]], counted: str | None = None) -> DataFrame:
    """For each name a column of that name: all matches in `text`, as (start, stop, value, place).

    `patterns`: name to (pattern, whether to look at all). `place` says how many matches of `counted`, which no
    match of a pattern touches, are before. Sums are taken in runs, so the work stays far below the square of the
    matches; one long number has the length in its lower half and `place` in its upper one.
    """
    others = rows.columns
    nothing = F.array().cast("array<string>")
    for name, (pattern, look) in patterns.items():
        rows = rows.withColumn(f"{name}_found", F.when(look, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(nothing))
    for name, (pattern, _) in patterns.items():
        rows = rows.withColumn(f"{name}_between", F.when(F.size(f"{name}_found") > 0, F.split("text", pattern, -1)).otherwise(nothing))
    carried = [c for c in others if c != "text"]
    add = lambda a, b: a + b

    def weight(between: Column) -> Column:
        length = F.length(between).cast("long")
        return length if counted is None else length + F.shiftleft(F.regexp_count(between, F.lit(counted)).cast("long"), 32)

    def steps(name: str) -> Column:
        found = F.col(f"{name}_found")
        return F.transform(
            found,
            lambda m, i: weight(F.get(f"{name}_between", i)) + F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(0),
        )

    keep = [c for name in patterns for c in (f"{name}_found", f"{name}_between")]
    rows = rows.select(*carried, *keep, *(steps(name).alias(f"{name}_steps") for name in patterns))
    rows = rows.select("*", *(_runs(F.col(f"{name}_steps"), add).alias(f"{name}_runs") for name in patterns))

    def spans(name: str) -> Column:
        def span(value: Column, i: Column) -> Column:
            return F.struct(_upto(F.col(f"{name}_steps"), F.col(f"{name}_runs"), i + 1, add).alias("sum"), value.alias("value"))

        return F.transform(f"{name}_found", span).alias(name)

    def halves(name: str) -> Column:
        def span(s: Column) -> Column:
            start = s["sum"].bitwiseAND(F.lit((1 << 32) - 1))
            return F.struct(start.alias("start"), (start + F.length(s["value"])).alias("stop"), s["value"].alias("value"), F.shiftright(s["sum"], 32).cast("int").alias("place"))

        return F.transform(name, span).alias(name)

    return rows.select(*carried, *map(spans, patterns)).select(*carried, *map(halves, patterns))


def _marked(rows: DataFrame) -> DataFrame:
    """The rows with `signs` of `whole` where there are spans, and `text`: `whole` with the signs of `base` as marks.

    All other signs stay in their places. Spans that overlap have one first mark.
    """
    later = lambda a, b: F.greatest(a, b)
    rows = rows.withColumn("whole", F.regexp_replace("whole", f"[{FIRSTS}{REST}]", STRAY))
    signs = F.when(F.size("base") > 0, F.regexp_extract_all("whole", F.lit("(?s)."), F.lit(0)))
    rows = rows.select("*", signs.alias("signs"), F.transform("base", lambda s: s["stop"]).alias("stops")).withColumn("stop_runs", _runs(F.col("stops"), later))

    def between(a: Column, b: Column) -> Column:
        return F.array_join(F.slice("signs", (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")), "")

    def mark(s: Column, i: Column) -> Column:
        done = _upto(F.col("stops"), F.col("stop_runs"), i, later)
        first = F.when(s["start"] >= done, F.substring(F.lit(FIRSTS), s["rank"] + 1, F.lit(1))).otherwise("")
        more = s["stop"] - F.greatest(s["start"], done) - F.length(first)
        return F.concat(between(done, s["start"]), first, F.repeat(F.lit(REST), F.greatest(more, F.lit(0)).cast("int")))

    parts = F.array_join(F.transform("base", mark), "")
    text = F.when(F.size("base") > 0, F.concat(parts, between(F.array_max("stops"), F.size("signs")))).otherwise(F.col("whole"))
    return rows.withColumn("text", text).drop("stops", "stop_runs")


def base_spans(docs: DataFrame, carried: Column | None = None) -> DataFrame:
    """(row, doc_id, base, mentions): checked base spans in order; the mentions and, as seeds, the base spans with a context.

    `carried` goes along in a column of that name.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        (F.lit(None).cast("boolean") if carried is None else carried).alias("carried"),
    )
    text = F.col("text")
    rows = rows.withColumn("whole", text)
    patterns = {kind: (pattern, NEEDED[kind](text)) for kind, pattern in PATTERNS.items()}
    rows = located(rows, patterns)

    def checked(kind: str, rank: int) -> Column:
        return F.transform(
            F.filter(kind, lambda s: _passes(kind, s["value"])),
            lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["stop"].alias("stop")),
        )

    base = F.sort_array(F.flatten(F.array(*(checked(k, i) for i, k in enumerate(PATTERNS)))))
    look = F.col("whole").rlike("[0-9@]")
    rows = _marked(rows.select("row", "doc_id", "carried", "whole", base.alias("base")))
    rows = located(rows.withColumn("words", F.when(look, F.split("text", BLANKS, -1))), {"mention": (MENTION, look)}, BLANKS)

    def mention(m: Column) -> Column:
        seed = m["value"].rlike(f"^[{FIRSTS}]")
        value = F.when(seed, F.array_join(F.slice("signs", (m["start"] + 1).cast("int"), F.length(m["value"])), ""))
        value = F.coalesce(value, F.rtrim(m["value"], F.lit(".,;:!?)]}'\"")))
        first, second = F.get("words", m["place"] - 2), F.get("words", m["place"] - 1)
        context = F.when((F.length(first) > 0) & (F.length(second) > 0), F.concat(first, F.lit(" "), second)).otherwise("")
        context = F.regexp_replace(F.regexp_replace(context, f"{REST}+", ""), "[0-9]+", "0")
        return F.struct(
            m["start"].alias("start"),
            (m["start"] + F.length(value)).alias("stop"),
            F.lower(value).alias("instance"),
            F.lower(context).alias("pattern"),
            seed.alias("seed"),
        )

    return rows.select("row", "doc_id", "carried", "base", F.transform("mention", mention).alias("mentions"))


def instance_scores(spark: SparkSession, found: DataFrame, rounds: int = ROUNDS, hops: int = MOST_HOPS) -> DataFrame:
    """(instance, score) of the unseen instances that are discovered.

    Edges are counted before anything is joined; a pattern or an instance that most rows share is one
    key of narrow rows, summed in part before each shuffle and split by the adaptive skew join. Patterns of too few
    instances can never take part, so their edges are not kept. More patterns and higher scores at the start of a hop never
    lower a score at its end, so what was admitted or discovered stays.
    """
    mentions = found.select(F.inline("mentions")).filter((F.col("pattern") != "") & (F.length("instance") > 0))
    edges = mentions.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    large = edges.groupBy("pattern").agg(F.count("*").alias("size")).filter(F.col("size") >= LEAST_SEEDS)
    edges = kept(spark, edges.join(large.select("pattern"), "pattern"))
    plausible = F.contains("instance", F.lit("@")) | (F.length(_digits(F.col("instance"))) >= LEAST_DIGITS)
    seeds = edges.groupBy("instance").agg(F.max("seed").alias("seed")).filter("seed").select("instance", F.lit(1.0).alias("score"))
    known, before = seeds, None
    for _ in range(hops):
        scored = edges.join(known, "instance", "left").fillna(0.0, ["score"])
        good = kept(spark, scored.groupBy("pattern").agg(F.count_if(F.col("score") > 0).alias("known")).filter(F.col("known") >= LEAST_SEEDS).select("pattern"))
        own = edges.join(good, "pattern")
        scored = scored.join(good, "pattern")
        for _ in range(rounds):
            patterns = scored.groupBy("pattern").agg((F.sum("score") / (F.count("*") + 1)).alias("trust"))
            instances = own.join(patterns, "pattern").groupBy("instance").agg(
                F.max("seed").alias("seed"),
                F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999)))))).alias("score"),
            )
            instances = kept(spark, instances)
            scored = own.join(instances.select("instance", "score"), "instance")
        unseen = instances.filter(~F.col("seed") & (F.col("score") >= LEAST_SCORE) & plausible).select("instance", "score")
        now = (good.count(), unseen.count())
        if now == before or not now[1]:
            break
        before = now
        known = seeds.union(unseen)
    return unseen


def discovered(spark: SparkSession, found: DataFrame) -> DataFrame:
    """(row, added): spans of discovered instances; mentions are cut so that they touch no base span."""
    scores = kept(spark, instance_scores(spark, found).select("instance"))
    mentions = found.select("row", F.explode("mentions").alias("m")).filter(~F.col("m.seed"))
    hits = mentions.select("row", F.col("m.instance").alias("instance"), "m.start", "m.stop")
    span = F.struct("start", F.lit(len(PATTERNS)).alias("rank"), F.lit("context").alias("kind"), "stop")
    return hits.join(scores, "instance").groupBy("row").agg(F.collect_list(span).alias("added"))


def personal_data(spark: SparkSession, docs: DataFrame, carried: Column | None = None) -> DataFrame:
    """(row, doc_id, carried, base, spans): base spans, and all spans with the discovered ones."""
    found = kept(spark, base_spans(docs, carried))
    added = kept(spark, discovered(spark, found))
    added = F.broadcast(added) if added.count() <= BROADCAST_ROWS else added
    return found.join(added, "row", "left").select(
        "row", "doc_id", "carried", "base", F.sort_array(F.concat("base", F.coalesce("added", F.slice("base", 1, 0)))).alias("spans")
    )


def masked(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """All columns of the documents; each span in `text` is replaced by its kind in brackets.

    Overlapping spans become one, named by the first. A NULL text stays NULL; `n_chars`, where
    there is one, counts the new text.
    """
    carried = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)))
    at = docs.columns.index("text")
    rows = personal_data(spark, docs, carried).select("carried", "spans", F.col(f"carried.c{at}").alias("text"))
    signs = F.when(F.size("spans") > 0, F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0)))
    rows = rows.select("carried", "spans", "text", signs.alias("signs"))

    def between(a: Column, b: Column) -> Column:
        return F.array_join(F.slice("signs", a + 1, F.greatest(b - a, F.lit(0))), "")

    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("long").alias("end"))

    def step(done: Column, span: Column) -> Column:
        part = F.concat(between(done["end"].cast("int"), span["start"].cast("int")), F.lit("["), F.upper(span["kind"]), F.lit("]"))
        parts = F.when(span["start"] < done["end"], done["parts"]).otherwise(F.array_append(done["parts"], part))
        return F.struct(parts.alias("parts"), F.greatest(done["end"], span["stop"]).alias("end"))

    cut = F.aggregate("spans", start, step, lambda d: F.concat(F.array_join(d["parts"], ""), between(d["end"].cast("int"), F.size("signs"))))
    rows = rows.select("carried", F.when(F.size("spans") > 0, cut).otherwise(F.col("text")).alias("masked"))

    def column(i: int, name: str) -> Column:
        if i == at:
            return F.col("masked").alias(name)
        value = F.col(f"carried.c{i}")
        return (F.length("masked").cast(docs.schema[name].dataType) if name == "n_chars" else value).alias(name)

    return rows.select(*(column(i, name) for i, name in enumerate(docs.columns)))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))


@query()
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(spark, read(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, PATTERNS), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
