import hashlib
import random

import pytest

from tablespan.llm import substrings as S
from tests.llm.frames import SMALL, documents, given, written


def expected(docs):
    """By brute force; documents in order of id, NULL last, equal rows in any order."""
    seen, rows = set(), []
    for name, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            string = data[i : i + 100]
            if string in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(string)
        rest = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rows.append((name, len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(rows, key=repr)


def actual(frame):
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()], key=repr)


def made(seed):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgé" for b in "xyz12"]
    prose = lambda n: " ".join(draw.choices(words, k=n))
    passages = [prose(n) for n in (20, 25, 30, 40, 60, 200)]
    docs = []
    for i in range(80):
        parts = [prose(draw.randint(0, 60)) if draw.random() < 0.5 else draw.choice(passages)[draw.randint(0, 40) :] for _ in range(draw.randint(0, 5))]
        docs.append((i * 3, draw.choice(["", " ", "\n"]).join(parts)))
    for i in range(60):  # one key with many phrases
        docs.append((1000 + i, prose(5) + passages[2] + prose(5)))
    for i in range(10):  # near copies
        copy = list(docs[i + 20][1])
        if copy:
            copy[draw.randrange(len(copy))] = "#"
        docs.append((2000 + i, "".join(copy)))
    docs += [(3000, None), (3001, ""), (3002, "a" * 99), (3003, "a" * 1000), (3004, "a" * 150), (3005, "ab" * 300), (3006, "\0" * 230), (3007, "\0" * 99 + "\1" + "\0" * 120)]
    docs += [(None, docs[85][1]), (3008, prose(30_000)), (3009, docs[85][1] * 2)]
    draw.shuffle(docs)
    return docs


@pytest.mark.parametrize("heavy", [S.HEAVY_KEY, 20])
def test_made_documents(spark, heavy):
    docs = made(heavy)
    result = actual(S.without_repeats(spark, documents(spark, docs).repartition(5), heavy))
    assert result == expected(docs)
    assert sum(0 < r[2] < r[1] for r in result) > 30


def test_repeated_ids_and_rows(spark):
    text, other = "one two three four five " * 8, "other words stand here, and no word of the first one " * 4
    docs = [(5, text), (5, text), (5, text), (1, "short"), (1, "short"), (2, other), (7, text + other)]
    assert actual(S.without_repeats(spark, documents(spark, docs).repartition(3))) == expected(docs)


def test_given_documents(spark):
    docs = [(d["doc_id"], d["text"]) for d in given("documents")]
    assert actual(S.op5_repeated_substrings(spark, SMALL)) == expected(docs)


def test_no_documents(spark, tmp_path):
    assert S.op5_repeated_substrings(spark, written(tmp_path, documents=documents(spark, []))).count() == 0
