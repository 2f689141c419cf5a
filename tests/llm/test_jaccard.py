import random
import re

import numpy as np

from tablespan.llm import jaccard as J
from tablespan.llm.components import components
from tablespan.sources.shared import kept, recorded
from tests.llm.frames import SMALL, documents, given, written


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def expected(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    lists = {}
    for i, s in enumerate(sets):
        for x in s:
            lists.setdefault(x, []).append(i)
    pairs = {(a, b) for members in lists.values() for a in members for b in members if a < b} if len(docs) < 3000 else set()
    for a, b in pairs:
        if find(a) != find(b) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for i, (name, _) in enumerate(docs):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return sorted([(name, len(s), least.get(find(i))) for i, ((name, _), s) in enumerate(zip(docs, sets, strict=True))], key=repr)


def actual(frame):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()], key=repr)


def edited(draw, words, share):
    return [draw.choice("uvwxyz") if draw.random() < share else w for w in words]


def made(seed):
    """Chains of near copies of all lengths, copies, a passage that many share, and short texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    docs, n = [], 0
    for length in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 26, 30, 36, 40, 60, 120, 400]:
        for _ in range(3):
            words = draw.choices(vocabulary, k=length)
            for _ in range(draw.randint(1, 9)):
                words = edited(draw, words, 0.03)
                docs.append((n, " ".join(words)))
                n += 1
    passage = draw.choices(vocabulary, k=40)
    for _ in range(60):
        docs.append((n, " ".join(passage + draw.choices(vocabulary, k=draw.randint(0, 25)))))
        n += 1
    docs += [(n + i, docs[i * 7][1].upper()) for i in range(20)]
    docs += [(500, None), (501, ""), (502, " \t\n"), (None, docs[100][1]), (None, "only without a name"), (3, docs[3][1]), (3, docs[3][1])]
    draw.shuffle(docs)
    return docs


def test_made_documents(spark, tmp_path):
    for seed in (1, 2):
        docs = made(seed)
        folder = written(tmp_path / str(seed), documents=documents(spark, docs).repartition(6))
        result = actual(J.op9_near_duplicates(spark, folder))
        assert result == expected(docs)
        assert sum(r[0] != r[2] for r in result) > 100


def test_given_documents(spark):
    docs = [(d["doc_id"], d["text"]) for d in given("documents")]
    assert actual(J.op9_near_duplicates(spark, SMALL)) == expected(docs)


def test_signatures_meet():
    """Similar sets share a list, whatever the boundary and the order of tokens."""
    draw = np.random.default_rng(3)
    counts = draw.integers(0, 3, J.SKETCH).astype(np.uint32)
    checked = 0
    for _ in range(3000):
        size = int(draw.integers(2, 60))
        a = np.unique(draw.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[draw.random(len(a)) > 0.1], draw.integers(0, 1 << 63, int(draw.integers(0, 4)), dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if len(a) == len(b) == common or 7 * common < 3 * (len(a) + len(b)):
            continue
        checked += 1
        for limit in (0, 10, 28, 100):
            both = np.intersect1d(J.signatures(a, counts, limit), J.signatures(b, counts, limit))
            odd = both & np.uint64(1)
            singles, subsets = int((odd == 0).sum()), int((odd == 1).sum())
            needed = -(-3 * (len(a) + len(b)) // 7) - (J.least_overlap(max(len(a), len(b))) - 1)
            assert subsets or singles >= max(1, needed)
    assert checked > 500


def test_components(spark):
    draw = random.Random(9)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(draw.randint(0, 90), draw.randint(0, 90)) for _ in range(50)] + [(7, 7)]
    labels = {r.node: r.label for r in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(labels[i] == 100 for i in range(100, 161)) and all(labels[i] == 500 for i in range(500, 560))
    assert all(labels.get(a, a) == labels.get(b, b) for a, b in links)
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_documents(spark, tmp_path):
    assert J.op9_near_duplicates(spark, written(tmp_path, documents=documents(spark, []))).count() == 0


def test_links_that_are_stars_settle_in_one_round(spark):
    """The driver has one job to write a round and none to compare it; a first round that changes nothing is the last."""
    for links in ([(1, i) for i in range(2, 40)] + [(70, 50), (50, 60), (50, 60), (50, 50)], []):
        frame = spark.createDataFrame(links, "a long, b long")
        with recorded() as folders:
            found = components(spark, frame)
        assert len(folders) == 2  # the links, and the round
        assert {r.node: r.label for r in found.collect()} == {i: min(i, 50) if i > 49 else 1 for pair in links for i in pair}


def test_no_rows_of_the_driver_pass_python_workers(spark, monkeypatch):
    texts = ["a b c d e f g h i", "k l m n o p q r s", "a b c d e f g h i j", "k l m n o p q r s", "t u v w x y"]
    docs = kept(spark, documents(spark, list(enumerate(texts))))
    monkeypatch.setattr(type(spark), "createDataFrame", None)  # its rows would start further Python workers, which stay
    assert {r.doc_id: r.component_id for r in J.near_duplicates(spark, docs).collect()} == {0: 0, 1: 1, 2: 0, 3: 1, 4: 4}
