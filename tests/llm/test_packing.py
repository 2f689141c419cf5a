import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablespan.llm import packing
from tablespan.llm.pretokens import Encoder
from tests.llm.frames import SMALL, documents, given


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_those_of_the_library(library):
    own = Encoder(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.PATTERN)
    draw = random.Random(5)
    signs = ["a", "'", "s", " ", "  ", "\n", "1", "!", "é", "'ll", "'re", "t", "ve", "\t", "日", "🙂", "<|endoftext|>", " ", "²", "x_y"]
    texts = ["", "'"] + ["".join(draw.choices(signs, k=draw.randint(1, 14))) for _ in range(3000)] + [d["text"] for d in given("documents")[:40]]
    ids, bounds = own.encode(texts)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def check(pieces, docs, library):
    """Every id of every document in exactly one piece; sequences without a gap, all full but the last."""
    wanted = sorted([*library.encode(d[1] or "", add_special_tokens=False).ids, packing.TERMINATOR] for d in docs)
    by_place, sequences, found = {}, {}, []
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4").tolist()
        assert len(ids) == p.length > 0 and zlib.crc32(bytes(p.ids)) == p.ids_crc32
        by_place[(p.sequence_id, p.offset)] = (p, ids)
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for k, spans in sequences.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == packing.SEQUENCE_TOKENS or k == max(sequences)
    current = []
    for _, (p, ids) in sorted(by_place.items()):
        assert p.start == len(current)
        current += ids
        if len(current) == p.doc_tokens:
            found.append((p.doc_id, current))
            current = []
    assert not current and sorted(ids for _, ids in found) == wanted
    assert sorted((i for i, _ in found), key=repr) == sorted((d[0] for d in docs), key=repr)


def test_given_documents(spark, library):
    docs = [(d["doc_id"], d["text"]) for d in given("documents")]
    check(packing.packed(spark, documents(spark, docs).repartition(5)).collect(), docs, library)
    assert packing.op6_packing(spark, SMALL).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_odd_documents(spark, library):
    docs = [(1, None), (1, None), (None, "x"), (2, ""), (3, "word " * 9000), (4, "'"), (4, "\n\n"), (5, "a<|endoftext|>b")]
    check(packing.packed(spark, documents(spark, docs)).collect(), docs, library)


def test_no_documents(spark):
    assert packing.packed(spark, documents(spark, [])).count() == 0
