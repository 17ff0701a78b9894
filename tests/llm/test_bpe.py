"""Ids equal those of tiktoken; decoding gives the bytes back."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from orrery.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return bpe.Vocabulary(ranks)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(vocabulary, reference, texts):
    ids, offs, decoded = bpe.Encoder(vocabulary)(pa.array(texts, pa.large_string()))
    assert decoded.tobytes() == "".join(texts).encode()
    for i, t in enumerate(texts):
        assert ids[offs[i]:offs[i + 1]].tolist() == reference.encode_ordinary(t), t


def test_pattern_is_the_public_one():
    assert bpe.PATTERN == P.PATTERN


def test_hash_is_perfect_and_minimal(vocabulary, ranks):
    slots = vocabulary.hash.slots(vocabulary.slot_key)
    assert np.array_equal(np.sort(slots), np.arange(len(ranks)))
    assert (vocabulary.lookup(np.arange(1000, dtype=np.uint64)) == -1).all()


def test_random_texts(vocabulary, reference):
    rnd = random.Random(7)
    chars = list("aZé ß\n\t\r\x0b\x1c\x85  'stmdrevl0９½٣!?.,#$漢字🙂́​᠎   ''   ")
    for _ in range(150):
        same(vocabulary, reference, ["".join(rnd.choices(chars, k=rnd.randrange(60))) for _ in range(rnd.randrange(1, 9))])


def test_contractions_and_spaces_at_borders(vocabulary, reference):
    same(vocabulary, reference, ["", "'s", "'", " 's", "x'll", "x'l", "x're", "'r", "  's", "\n's", "a'sb", "''s", "'S",
                                 "", " ", "a ", " a", "  \n", "\n\n a", ""])


def test_long_pre_token(vocabulary, reference):
    same(vocabulary, reference, ["=" * 30_000, "ab" * 20_000])


def test_whole_table(spark, reference):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = bpe.encode(docs, PATH)
    for t, r in zip(docs.orderBy("doc_id").collect(), got.orderBy("doc_id").collect(), strict=True):
        ids = reference.encode_ordinary(t.text)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.text.encode()).hexdigest()
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(got, PATH).collect()}
    assert back == {t.doc_id: t.text.encode() for t in docs.collect()}


def test_awkward_rows(awkward, empty, reference):
    rows = bpe.encode(awkward, PATH).collect()
    assert len(rows) == awkward.count()
    texts = [(r.doc_id, r.text or "") for r in awkward.collect()]
    key = lambda x: (x[0] is None, x[0] or 0)
    for (i, t), r in zip(sorted(texts, key=key), sorted(rows, key=key), strict=True):
        assert r.doc_id == i and r.ids == reference.encode_ordinary(t)
    assert bpe.encode(empty, PATH).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(awkward.selectExpr("doc_id", "array(50256) as ids"), PATH).collect()
