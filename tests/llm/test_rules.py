import collections
import re

from pyspark.sql import functions as F

from tablespan.llm import rules as R
from tests.llm.frames import SMALL, documents, given, written


def expected(text):
    text = text or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    count = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def actual(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, bad string")


ODD = [None, "", " \t\r\n", "a", "a b", "a b c", "a b c a b c", "a a a a a a", "x\n\nx\n x\nx\r\n", "é🙂 # | ü b c", "\x0b\x0c a\x0bb", "l\n" * 500, "a b c d " * 20000, "# " * 60]


def test_statistics(spark, tmp_path):
    rows = [*enumerate(ODD), (3, "a"), (None, "z")]
    folder = written(tmp_path, documents=documents(spark, rows), labels=labels(spark, [(0, None, 0, "x"), (None, 1, 0, "x"), (99, 0, 0, "x")]))
    result = R.op10_quality_rules(spark, folder).collect()
    assert len(result) == len(rows)
    texts = dict(rows)
    assert not [(r.doc_id, actual(r), expected(texts[r.doc_id])) for r in result if actual(r) != expected(texts[r.doc_id])]
    assert all(r.kept == (not r.base_failed) for r in result)  # nothing was learned


def test_given_documents(spark):
    texts = {d["doc_id"]: d["text"] for d in given("documents")}
    result = R.op10_quality_rules(spark, SMALL).collect()
    assert len(result) == len(texts) and all(actual(r) == expected(texts[r.doc_id]) for r in result)
    assert all(not (r.kept and r.base_failed) for r in result)


def test_learned_rules_hold_on_given_labels(spark):
    folder = "/root/testdata/sf0.01"
    marks = {x["doc_id"]: x["quality"] for x in given("labels", folder)}
    result = [r for r in R.op10_quality_rules(spark, folder).collect() if r.doc_id in marks]
    bad = [r for r in result if marks[r.doc_id] == 0]
    good = [r for r in result if marks[r.doc_id] == 1 and not r.base_failed]
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)
    assert sum(r.kept for r in good) >= 0.98 * len(good)


def test_list_finds_a_planted_conjunction(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), *(F.pmod(F.xxhash64("id", F.lit(f)), F.lit(100)).cast("double").alias(f) for f in R.FEATURES)
    )
    marked = rows.withColumn("bad", ((F.col("n_symbols") > 70) & (F.col("mean_word") <= 40)).cast("long"))
    rules = R.learn(spark, marked)
    wrong = marked.filter(R.verdict(rules) == (F.col("bad") == 1)).count()
    assert rules and {c.feature for c in rules[0]} >= {"n_symbols", "mean_word"} and wrong < 60
    assert "n_symbols > " in " & ".join(map(str, rules[0])) and R.learn(spark, marked.limit(0)) == []


def test_no_documents(spark, tmp_path):
    assert R.op10_quality_rules(spark, written(tmp_path, documents=documents(spark, []), labels=labels(spark, []))).count() == 0
