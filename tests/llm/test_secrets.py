import hashlib
import re
import time

from tablespan.llm import secrets
from tablespan.llm.words import blocks
from tests.llm.frames import SMALL, documents, given, written
from pyspark.sql import functions as F

PATTERNS = [
    ("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def expected(text):
    spans = sorted((m.start(), n, kind, m.end()) for n, (kind, p, good) in enumerate(PATTERNS) for m in p.finditer(text or "") if good(m))
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    counts = [sum(s[2] == k for s in spans) for k in ("assign", "access", "hex")]
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


def actual(r):
    return (r.n_assign, r.n_access, r.n_hex, r.base_sha256)


KEY = "aB3dE6gH9jK2mN5pQ8sT1v"
HEX = "0123456789abcdef01234567"
ODD = [
    None, "", "x", "password=abc", "PASSWORD: 'abcdef'", "token=secret=abcdef", "secret=token = abcdef12", "apikey:abc-def api_KEY=\"zzzzzz\"",
    "é AKIA" + "A1" * 9 + " é", "AKIAAKIA" + "B" * 8, "éü " + HEX + "é", "f" * 23 + " " + "f" * 24, "ſecret=abcdef", "toKen=abcdef", "secret\n=abcdef",
    "tokentoken==abcdef", "passwd='" + HEX + "'", HEX * 2000,
]


def test_base_spans(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, ODD[4]), (None, ODD[5])]
    folder = written(tmp_path, documents=documents(spark, rows))
    result = secrets.op3_secrets(spark, folder).collect()
    assert sorted((r.doc_id, *actual(r)) for r in result if r.doc_id is not None) == sorted((i, *expected(t)) for i, t in rows if i is not None)
    assert len(result) == len(rows)


def test_given_documents(spark):
    texts = {d["doc_id"]: d["text"] for d in given("documents")}
    result = secrets.op3_secrets(spark, SMALL).collect()
    assert len(result) == len(texts)
    assert all(actual(r) == expected(texts[r.doc_id]) for r in result)


def test_owners_decide(spark, tmp_path):
    copied, own = f"key {KEY} end", f"key {KEY[::-1]} é"
    rows = [(i, copied, "en", f"s{i}") for i in range(5)] + [(7, own, "en", "s1"), (8, own, "en", "s1"), (9, "A1a" * 10, None, None)]
    folder = written(tmp_path, documents=documents(spark, rows))
    result = {r.doc_id: r for r in secrets.op3_secrets(spark, folder).collect()}
    assert [result[i].n_example for i in range(5)] == [1] * 5 and result[0].spans == ""
    assert result[7].spans == result[8].spans == "owned:4:26" and result[7].n_live == 1
    assert result[9].spans == "" and result[9].n_live == 0
    found = secrets.candidates(documents(spark, rows), F.col("doc_id"), F.col("source"))
    assert sorted((r.repositories, r.owners) for r in secrets.ownership(found).collect()) == [(2, 1), (5, 5)]


def test_spans_of_a_long_text_take_linear_time():
    """Mixed tokens among base spans: those that touch no base span are taken, in time that grows with the text."""
    parts = [f"{KEY}{i} token={KEY}{i}" if i % 3 else f"{HEX}{KEY} {KEY}x{i}" for i in range(40_000)]
    text = " ".join(parts).encode()
    block = next(iter(blocks([text], lower=False)))
    began = time.process_time()
    (spans,) = secrets._spans(block)
    assert time.process_time() - began < 20
    base = [(a, b) for a, kind, b, _ in spans if kind < 3]
    few = next(iter(blocks([" ".join(parts[:60]).encode()], lower=False)))
    (found,) = secrets._spans(few)
    short = [(a, b) for a, kind, b, _ in found if kind < 3]
    runs = [m.span() for m in re.finditer(rb"[A-Za-z0-9+/_=-]{20,}", few.buffer.tobytes()) if secrets._mixed(m[0])]
    assert [(a, b) for a, kind, b, _ in found if kind == 3] == [(a, b) for a, b in runs if not any(a < y and x < b for x, y in short)]
    assert len(base) == 40_000 and sum(kind == 3 for _, kind, _, _ in spans) > 30_000


def test_no_documents(spark, tmp_path):
    assert secrets.op3_secrets(spark, written(tmp_path, documents=documents(spark, []))).count() == 0
