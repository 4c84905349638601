import random
import string

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumenfold.llm import bpe
from lumenfold.llm import words as W

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=12))
def test_words_split_and_hash(texts):
    found = {}
    for a, _, rows, hashes, starts, ends in W.words(pa.array(texts, pa.string()), W.SPACE):
        for r, h, s, e in zip(rows, hashes, starts, ends):
            found.setdefault(a + int(r), []).append((int(h), int(s), int(e)))
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        want, at = [], 0
        for w in raw.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" "):
            if w:
                want.append((W.hash_one(w), at, at + len(w)))
            at += len(w) + 1
        assert found.get(i, []) == want


def test_groups_cover_all_rows():
    offsets = np.array([0, 5, 5, 100, 101, 3_000_000, 3_000_001])
    got = list(W.groups(offsets, size=50))
    assert [a for a, _ in got] == [0] + [b for _, b in got[:-1]] and got[-1][1] == 6 and all(b > a for a, b in got)


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    v = bpe.Vocabulary(bpe.read_vocabulary(VOCABULARY))
    return v, tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=v.rank, special_tokens={})


def _texts():
    rng = random.Random(4)
    texts = ["", "a", " ", "  two  blanks \n\n", "I'll won't 'tis", "naïve Größe 日本語 😀", "x" * 3000, "ab" * 2000, "".join(rng.choice(string.printable) for _ in range(5000))]
    return texts + ["".join(chr(rng.randrange(1, 0xD7FF)) for _ in range(300)) for _ in range(20)] + ["The quick brown fox jumps. " * 500]


def test_bpe_is_that_of_the_vocabulary(reference):
    v, t = reference
    texts = _texts() + [None]
    ids, bound = bpe.Encoder(v).encode(texts)
    for i, text in enumerate(texts):
        assert ids[bound[i] : bound[i + 1]].tolist() == (t.encode_ordinary(text) if text else [])
    assert [x.decode() for x in v.decode(ids, bound).to_pylist()] == [x or "" for x in texts]


def test_matrix_and_heap_agree(reference):
    v, t = reference
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdetion ng") for _ in range(rng.randrange(2, bpe.LONG))).encode() for _ in range(300)]
    ids, count = v.merge(words)
    bound = np.concatenate([[0], np.cumsum(count)])
    for i, w in enumerate(words):
        assert ids[bound[i] : bound[i + 1]].tolist() == v.merge_long(w)


def test_cache_can_start_anew(reference, monkeypatch):
    v, t = reference
    monkeypatch.setattr(bpe, "CACHE", 3)
    e = bpe.Encoder(v)
    for text in ("one two three four", "five six one", "two"):
        ids, _ = e.encode([text])
        assert ids.tolist() == t.encode_ordinary(text)


def test_bpe_round_trip_in_spark(spark):
    rows = [(i, t) for i, t in enumerate([*_texts(), None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    encoded = bpe.encode_documents(docs, VOCABULARY)
    got = {r["doc_id"]: r for r in encoded.collect()}
    assert all(got[i]["round_trip"] for i, t in rows if t is not None)
    assert got[len(rows) - 1]["token_ids"] is None and got[len(rows) - 1]["n_tokens"] is None and got[0]["n_tokens"] == 0
    assert {r["doc_id"]: r["text"] for r in bpe.decode_documents(encoded, VOCABULARY).collect()} == dict(rows)
