import random
import re
import zlib
from collections import Counter

import pytest

from tablespan.llm import spelling
from tests.llm.frames import documents, given, written


def edits(a, b):
    """Whether b is a with exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(docs, damage=199):
    counts = Counter()
    for name, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and edits(w, x)] for w in words}
    best = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: x for w, x in best.items() if words[x] >= 5 * words[w]}
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words.get(form.get(w))))
    return sorted(out, key=repr)


def actual(frame):
    return sorted([(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()], key=repr)


def made(seed):
    """Words with chains of variants, of lengths at the border, with repeated and accented letters."""
    draw = random.Random(seed)
    letters = "aabcdeéÿ×"
    base = ["".join(draw.choices(letters, k=draw.randint(5, 12))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abcabcabc"]
    pool = {}
    for w in [w for w in base for _ in range(3)]:
        n = draw.choice([4, 6, 40, 200, 200])
        while n > 1:
            pool[w] = max(n, pool.get(w, 0))
            i = draw.randrange(len(w))
            w = draw.choice([w[:i] + w[i + 1 :], w[:i] + draw.choice(letters) + w[i:], w[:i] + draw.choice(letters) + w[i + 1 :]])
            n = n // draw.choice([1, 4, 5, 6])
            if draw.random() < 0.2:
                break
    words = [draw.choice([w, w.upper() if w.isascii() else w]) for w, n in pool.items() for _ in range(n)]
    draw.shuffle(words)
    docs = [(i % 17, draw.choice([" ", ", ", "1", "\n"]).join(words[i : i + 9])) for i in range(0, len(words), 9)]
    return docs + [(3, None), (4, ""), (None, "abcabcabc abcabcabd " * 3), (None, None), docs[0], docs[0], (5, "wortwort" * 30_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_made_documents(spark, tmp_path, seed):
    docs = made(seed)
    frame = documents(spark, docs).repartition(5)
    want = expected(docs)
    assert sum(r[1] is not None for r in want) > 10 and any(r[1] != r[2] for r in want if r[1])
    assert actual(spelling.op12_spelling_variants(spark, written(tmp_path, documents=frame))) == want
    assert actual(spelling.variants(spark, frame, damage=3)) == expected(docs, 3)


def test_given_documents(spark):
    docs = [(d["doc_id"], d["text"]) for d in given("documents")]
    assert actual(spelling.op12_spelling_variants(spark, "/root/testdata/sf0.001")) == expected(docs)


def test_pairs_are_made_once_and_from_few_candidates(spark):
    words = spark.createDataFrame([(f"pre{i:05d}".translate(str.maketrans("0123456789", "abcdefghij")), 5) for i in range(3000)], "word string, n long")
    pairs = [tuple(sorted(r)) for r in spelling.near_pairs(words).select("a", "b").collect()]
    texts = [r.word for r in words.collect()]
    place = set(texts)
    want = {tuple(sorted((w, w[:i] + c + w[i + 1 :]))) for w in texts for i in range(8) for c in "abcdefghij" if w[i] != c and w[:i] + c + w[i + 1 :] in place}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_no_words(spark, tmp_path):
    assert spelling.op12_spelling_variants(spark, written(tmp_path, documents=documents(spark, []))).collect() == []
    assert spelling.variants(spark, documents(spark, [(1, None), (2, "no long words")])).collect() == []
