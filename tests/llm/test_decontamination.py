import hashlib
import random
import re

import duckdb
import numpy as np

from tablespan.llm import decontamination as D
from tablespan.llm import queries as text_queries
from tablespan.sources.shared import kept
from tests.llm.frames import SMALL, documents, given, written


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def expected(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(name)
    sizes = {len(x) for x in windows}
    rows = []
    for name, text in docs:
        w = words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if own := windows.get(tuple(w[i : i + size])):
                    found |= {str(x) for x in own if x is not None}
                    hit |= set(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        rows.append((name, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(rows, key=repr)


def actual(frame):
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect()], key=repr)


def test_given_tables(spark):
    docs = [(d["doc_id"], d["text"]) for d in given("documents")]
    items = [(b["item_id"], b["text"]) for b in given("benchmark")]
    result = actual(D.op1_decontamination(spark, SMALL))
    assert result == expected(docs, items)
    assert any(r[2] for r in result)


NAMELESS = " ".join(f"p{i}" for i in range(20))


def odd(draw):
    few = ["a", "B", "c", "é", "9"]
    items = [(i, " ".join(draw.choices(few, k=n))) for i, n in enumerate([0, 1, 2, 5, 12, 13, 14, 20, 30])]
    items += [(None, NAMELESS), (None, NAMELESS.replace("p3", "q3")), (None, None)]
    items += [(3, "again and again"), (50, None), (51, "?!"), (10, items[7][1])]
    docs = [(i, "-".join(draw.choices(few, k=draw.choice([1, 3, 40, 300])))) for i in range(12)]
    docs += [(20, None), (21, ""), (22, "... "), (23, "x " * 40_000 + items[8][1] + " y"), (24, items[7][1].upper()), (24, items[7][1]), (25, items[6][1])]
    docs += [(26, "AGAIN,and\nagain"), (27, items[8][1][:20])]
    docs += [(28, NAMELESS), (29, f"{items[8][1]} {NAMELESS}")]
    return docs, items


def test_odd_texts(spark, tmp_path):
    docs, items = odd(random.Random(2))
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, segment string")
    folder = written(tmp_path, documents=documents(spark, docs).repartition(3), benchmark=bench)
    assert actual(D.op1_decontamination(spark, folder)) == expected(docs, items)


def test_blocks_of_items_agree(spark):
    docs, items = odd(random.Random(4))
    frame = spark.createDataFrame(items, "item_id long, text string")
    index = kept(spark, D.positional_index(documents(spark, docs)))
    found = lambda n: set(map(tuple, D.searched(spark, index, frame, at_once=n).collect()))
    few, all_at_once = found(10), found(D.ITEM_WORDS)
    named = lambda rows: {r for r in rows if r[2] is not None}
    assert named(few) == named(all_at_once) != set()
    # Items without an id may be in different blocks, so only the words they cover are the same.
    words_of = lambda rows: {(r[0], r[1], k) for r in rows - named(rows) for k in range(r[3], r[4])}
    assert words_of(few) == words_of(all_at_once) != set()


def test_items_without_an_id_hit(spark, tmp_path):
    docs = [(1, NAMELESS), (2, "x " * 300 + NAMELESS), (3, "p0 p1 p2")]
    items = [(None, NAMELESS)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    folder = written(tmp_path, documents=documents(spark, docs), benchmark=bench)
    result = actual(D.op1_decontamination(spark, folder))
    assert result == expected(docs, items)
    assert [(r[2], r[3], r[5]) for r in result] == [(20, 0, True), (20, 0, True), (0, 0, False)]
    sql = text_queries.ORACLES["op1_decontamination"]
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    assert sorted(db.sql(sql).fetchall()) == [tuple(r) for r in result]


def test_proximity(spark):
    docs = [(1, "one two three"), (2, "one and two then three"), (3, "three two one"), (4, "one far away from it all two three")]
    index = kept(spark, D.positional_index(documents(spark, docs).coalesce(1), gap=20))
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    ids = lambda slop: {r.document for r in D.searched(spark, index, items, slop=slop).collect()}
    assert ids(0) == {0} and ids(2) == {0, 1} and ids(4) == {0, 1, 2} and ids(9) == {0, 1, 2, 3}


def test_rarest_terms_come_first():
    w = D.Windows([("a", np.array([5, 6, 7]))], {5: 10, 6: 1, 7: 3}, 13)
    assert w.terms[0, :3].tolist() == [6, 7, 5] and w.offsets[0, :3].tolist() == [1, 2, 0]


def test_empty_tables(spark, tmp_path):
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = [(1, "a b c")]
    assert actual(D.op1_decontamination(spark, written(tmp_path / "a", documents=documents(spark, docs), benchmark=bench))) == expected(docs, [])
    assert D.op1_decontamination(spark, written(tmp_path / "b", documents=documents(spark, []), benchmark=some)).count() == 0
