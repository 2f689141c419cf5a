import itertools
import re
import time
import zlib

import numpy as np
import public_tokenizers

from tablespan.llm import language as L
from tests.llm.frames import SMALL, documents, given, written


def test_given_documents(spark):
    langs = {d["doc_id"]: d["lang"] for d in given("documents")}
    result = L.op2_language(spark, SMALL).collect()
    assert len(result) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in result)
    held = [r for r in result if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in result)


def test_probability_sums_all_segmentations():
    pieces = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b" ", b" a"]
    own = L.Pieces(pieces)
    chances = np.vstack([np.random.default_rng(1).dirichlet(np.ones(len(pieces)), 2).T, np.zeros(2)])

    def brute(word):
        total = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
            parts = [word[a:b] for a, b in itertools.pairwise(at)]
            if all(p in pieces for p in parts):
                total += np.prod([chances[pieces.index(p)] for p in parts], axis=0)
        return total

    words = [b" abc", b" a", b" abcabcab", b" ccc", b" abc" + b"abcb" * 2]
    got = L.log_probabilities(own, chances, words)
    assert np.allclose(got, np.log([brute(w) for w in words]))
    long = L.log_probabilities(own, chances, [b" " + b"abc" * 5000])
    assert np.isfinite(long).all()
    counts = L.expected_counts(own, chances, [b" abc"], np.ones((1, 2)))
    assert np.allclose((counts * np.array([[len(p)] for p in pieces])).sum(axis=0), 4)  # every sign is used once


def plain_forward(pieces, chances, word):
    """The log probability by the plain recursion, scaled at each step."""
    number = {p: i for i, p in enumerate(pieces)}
    sums, logs = [np.ones(chances.shape[1])], np.zeros(chances.shape[1])
    longest = max(map(len, pieces))
    for j in range(1, len(word) + 1):
        total = np.zeros(chances.shape[1])
        for size in range(1, min(longest, j) + 1):
            if word[j - size : j] in number:
                total = total + sums[-size] * chances[number[word[j - size : j]]]
        scale = total.max()
        sums = [x / scale for x in [*sums, total][-longest:]]
        logs += np.log(scale)
    return np.log(sums[-1]) + logs


def test_long_runs_score_as_the_plain_recursion(monkeypatch):
    pieces = L.vocabulary(public_tokenizers.path(L.VOCABULARY))
    draw = np.random.default_rng(3)
    chances = draw.dirichlet(np.ones(len(pieces)), 3).T
    ended = np.vstack([chances, np.zeros(3)])
    own = L.Pieces(pieces)
    signs = [chr(c) for c in draw.integers(0x4E00, 0x9FFF, 400)]
    runs = ["".join(draw.choice(signs, n)).encode() for n in (1, 7, 30, 333, 340)] + [b" the", b"the" * 90, b"x"]
    want = [plain_forward(pieces, chances, w) for w in runs]
    assert np.allclose(L.log_probabilities(own, ended, runs), want, rtol=1e-9)
    monkeypatch.setattr(L, "AHEAD", 7)
    monkeypatch.setattr(L, "LANES", 2)
    assert np.allclose(L.log_probabilities(own, ended, runs), want, rtol=1e-9)


def test_runs_without_blanks_take_seconds_a_megabyte():
    own = L.Pieces(L.vocabulary(public_tokenizers.path(L.VOCABULARY)))
    draw = np.random.default_rng(4)
    model = L.Model(["a", "b", "c"], own, np.vstack([draw.dirichlet(np.ones(own.n), 3).T, np.zeros(3)]))
    texts = ["".join(map(chr, draw.integers(0x4E00, 0x9FFF, 1000))) for _ in range(350)]
    began = time.process_time()
    predicted, scores = L._predictions(model, texts)
    spent = time.process_time() - began
    L._known.clear()
    assert len(predicted) == 350 and spent < 15


def test_predictions_against_brute_force():
    pieces = [b"a", b"b", b"c", b" ", b" a", b"ab", b"bc", b"cab"] + [bytes([x]) for x in "é日".encode()]
    own, draw = L.Pieces(pieces), np.random.default_rng(5)
    chances = draw.dirichlet(np.ones(len(pieces)), 2).T
    model = L.Model(["p", "q"], own, np.vstack([chances, np.zeros(2)]))
    texts = ["abc cab", "ABC", "", None, "12", "é日 a", "ab " * 200, "a\nb", "日日日日 abcabcabc"]
    predicted, scores = L._predictions(model, texts)
    L._known.clear()
    for text, lang, score in zip(texts, predicted, scores, strict=True):
        found = re.findall(rb"[a-z\x80-\xFF]+", (text or "").lower().encode())
        if not found:
            assert (lang, score) == ("und", 0.0)
            continue
        sums = sum(plain_forward(pieces, chances, b" " + w) for w in found) / max(1.0, len(found) / L.EVIDENCE_WORDS)
        chance = np.exp(sums - sums.max()) / np.exp(sums - sums.max()).sum()
        assert lang == "pq"[chance.argmax()] and abs(score - chance.max()) < 1e-4


def test_rare_languages_are_learned(spark):
    rows = [(i, "the of and", "en", "s") for i in range(3000)] + [(5000 + i, "der die und", "de", "s") for i in range(9)]
    chosen = L.training_docs(documents(spark, rows), most=100)
    counts = {r.lang: r["count"] for r in chosen.groupBy("lang").count().collect()}
    usable = sum(zlib.crc32(str(5000 + i).encode()) % 5 != 0 for i in range(9))
    assert counts["de"] == usable and 50 < counts["en"] < 150


def test_every_word_has_a_segmentation():
    pieces = L.vocabulary(public_tokenizers.path(L.VOCABULARY))
    assert set(bytes([b]) for b in range(256)) <= set(pieces) and len(pieces) > 10_000 and b" the" in pieces


ODD = [None, "", "12 34 !", "—", "日本語 テスト", "İstanbul ÉCOLE", "a", "x" * 50_000, "the of and " * 30_000, "\0 the and", "ª", "² ³"]


def test_odd_texts(spark, tmp_path):
    rows = [(i, t, ["en", None][i % 2], None) for i, t in enumerate(ODD)] + [(None, "the and of", "en", "s"), (50, "the of and to in", "en", "s"), (51, "der die und das", "de", "s")] * 3
    result = L.op2_language(spark, written(tmp_path, documents=documents(spark, rows))).collect()
    assert len(result) == len(rows)
    by_id = {r.doc_id: r for r in result}
    for i, text in enumerate(ODD):
        letters = any(map(str.isalpha, text or ""))
        assert (by_id[i].lang_pred == "und") == (not letters), (text, by_id[i])
    assert not by_id[None].held_out


def test_long_runs_are_learned(spark, tmp_path):
    texts = {"zh": "我们今天在学校里学习中文和数学，然后回家吃饭", "ja": "わたしたちはきょうがっこうでべんきょうしました", "ru": "достопримечательность человеконенавистничество"}
    rows = [(i, text, lang, "s") for lang, text in texts.items() for i in range(40)]
    docs = documents(spark, rows)
    counted = {(r.lang, bytes(r.word)): r.n for r in L.word_counts(docs).collect()}
    for lang, text in texts.items():
        assert sum(n * len(w.lstrip()) for (own, w), n in counted.items() if own == lang) == 40 * len(text.replace(" ", "").encode())
        assert all(len(w) <= L.TRAIN_WORD_BYTES and w.decode() for _, w in counted)
    result = L.op2_language(spark, written(tmp_path, documents=documents(spark, [(1000 * n + i, t, lang, "s") for n, (lang, t) in enumerate(texts.items()) for i in range(40)]))).collect()
    assert len(result) == 120 and all(r.lang_pred == list(texts)[r.doc_id // 1000] and r.score > 0.9 for r in result)


def test_nothing_to_learn_from(spark, tmp_path):
    result = L.op2_language(spark, written(tmp_path / "a", documents=documents(spark, [(1, "the and", None, None)]))).collect()
    assert [(r.lang_pred, r.score) for r in result] == [("und", 0.0)]
    assert L.op2_language(spark, written(tmp_path / "b", documents=documents(spark, []))).count() == 0
