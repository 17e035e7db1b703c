import hashlib

import numpy as np
import pytest

from legtrail.llm import minhash


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def test_packing_is_undone():
    prints = np.random.default_rng(0).integers(0, 16, minhash.BINS).astype(np.uint8)
    assert (minhash.unpacked(minhash.packed(prints)) == prints).all()
    assert len(minhash.packed(prints)) == minhash.BINS


@pytest.mark.parametrize("size", [1, 2, 7, 60, 3000])
def test_likeness_has_no_bias(size):
    donors, draw, errors = minhash.Donors(), np.random.default_rng(size), []
    for _ in range(60):
        both = draw.integers(0, 2**64, 3 * size, np.uint64)
        a, b = both[: 2 * size], both[size:]
        found = minhash.likeness(minhash.fingerprint(a, donors), minhash.fingerprint(b, donors))
        errors.append(found - 1 / 3)
    assert abs(np.mean(errors)) < 0.08 and (size < 60 or np.abs(errors).max() < 0.12)


def test_equal_sets_have_equal_prints_whatever_the_order():
    donors, values = minhash.Donors(), np.random.default_rng(3).integers(0, 2**64, 9, np.uint64)
    assert (minhash.fingerprint(values, donors) == minhash.fingerprint(np.tile(values[::-1], 3), donors)).all()


@pytest.fixture
def rows(edges):
    return minhash.edited_fingerprints(edges).collect()


def test_next_document_is_that_of_the_next_smaller_id(documents):
    texts = {i: " ".join(f"{'ab'[i % 2]}{(j * (1 + i % 3)) % 90}" for j in range(40 + 7 * i)) for i in range(0, 60, 3)}
    found = {r.doc_id: r for r in minhash.edited_fingerprints(documents(list(texts.items()))).collect()}
    order = sorted(texts, reverse=True)
    assert sorted(found) == sorted(texts)
    for doc_id, following in zip(order, [*order[1:], order[0]]):
        text, other, row = texts[doc_id], texts[following], found[doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.n_chars == len(text)
        assert row.near_edited == pytest.approx(jaccard(text, edited), abs=0.12)
        assert row.near_next == pytest.approx(jaccard(text, other), abs=0.12)
        near = minhash.likeness(minhash.unpacked(row.fingerprint), minhash.unpacked(row.edited_fingerprint))
        assert near == pytest.approx(row.near_edited)


def test_edges(rows, edges):
    assert len(rows) == 10
    texts = {r.doc_id: r.text or "" for r in edges.collect()}
    by_text = {}
    for row in rows:
        key = tuple(sorted(shingles(texts[row.doc_id])))
        assert by_text.setdefault(key, row.fingerprint) == row.fingerprint
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    assert {r.near_next for r in rows if r.doc_id == 6} == {1.0}


def test_one_document_and_none(documents, nothing):
    row = minhash.edited_fingerprints(documents([(1, "abcd")])).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert minhash.edited_fingerprints(nothing).collect() == []
