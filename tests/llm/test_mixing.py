import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from legtrail.llm import mixing


@pytest.fixture
def sources(documents):
    """Three sources; one holds most of the words, one row is there twice, some have no words or no source."""
    rows, i = [], 0
    for source, count in (("big", 120), ("mid", 40), ("small", 12)):
        for _ in range(count):
            rows.append((i, " ".join(["w"] * (1 + i % 9)), "en", source))
            i += 1
    return documents([*rows, (500, None, "en", "small"), (501, "", "en", "bare"), (502, "a b", "en", None), (0, "w", "en", "big")])


def plain_exponent(tokens, fits):
    low, high = 0.0, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        raised = [n**middle for n in tokens]
        weights = [r / sum(raised) for r in raised]
        low, high = (low, middle) if fits(weights) else (middle, high)
    return (low + high) / 2


def entropy(weights):
    return -sum(w * math.log(w) for w in weights)


def totals(rows):
    tokens = Counter()
    for r in rows:
        tokens[r.source] += r.tokens * r.copies
    return tokens


@pytest.mark.parametrize("repeats", [1.0, 1.5, 3.0, 1000.0])
def test_repetition_limit(sources, repeats):
    rows = mixing.mixture(sources, repeats=repeats).collect()
    base, mixed = totals(r for r in rows if r.epoch == 0), totals(rows)
    seen = {s: mixed[s] / base[s] for s in base if base[s]}
    assert min(seen.values()) == pytest.approx(1, abs=0.02)
    assert max(seen.values()) <= repeats * 1.5 + 0.1  # whole documents
    counts = Counter((r.doc_id, r.source) for r in rows)
    assert set(counts) == {(r.doc_id, r.source) for r in sources.collect()}
    weights = {r.source: r.weight for r in rows if r.weight is not None}
    tokens = [base[s] for s in sorted(weights, key=str)]
    limit = lambda w: max(a / b for a, b in zip(w, tokens)) / min(a / b for a, b in zip(w, tokens)) <= repeats
    expected = plain_exponent(tokens, limit)
    raised = [n**expected for n in tokens]
    for source, r in zip(sorted(weights, key=str), raised):
        assert weights[source] == pytest.approx(r / sum(raised), abs=1e-6)


def test_target_entropy_and_budget(sources):
    rows = mixing.mixture(sources, entropy_share=0.9, budget=2000).collect()
    weights = {r.source: r.weight for r in rows if r.weight is not None}
    assert entropy(weights.values()) == pytest.approx(0.9 * math.log(len(weights)), abs=1e-5)
    mixed = totals(rows)
    for source, weight in weights.items():
        assert 0 <= mixed[source] - round(2000 * weight) < 9  # the last document may reach over


def test_blocks_are_permutations(sources):
    rows = mixing.mixture(sources, repeats=3.0).filter("tokens > 0").collect()
    blocks = defaultdict(list)
    for r in rows:
        blocks[r.source, r.epoch].append((r.doc_id, r.text_hash))
    for (source, epoch), docs in blocks.items():
        assert len(docs) == len(set(docs))
        if epoch:
            assert set(docs) <= set(blocks[source, epoch - 1])
        if (source, epoch + 1) in blocks:
            assert set(docs) == set(blocks[source, 0])


def test_mixed_repeats_rows(sources):
    rows = mixing.mixed(sources, 3.0)
    assert rows.columns == sources.columns
    times = Counter(r.doc_id for r in rows.collect())
    mixture = mixing.mixture(sources, repeats=3.0).collect()
    assert times == sum((Counter({r.doc_id: r.copies}) for r in mixture), Counter())


def test_edges(edges, nothing):
    assert mixing.mixed(edges, 2.0).count() >= 10
    assert mixing.mixture(nothing, repeats=2.0).collect() == []
    assert mixing.mixed(nothing, 2.0).collect() == []
    with pytest.raises(ValueError):
        mixing.mixture(nothing)


def test_no_python_in_the_plan(spark, plan):
    docs = spark.range(9).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    text = plan(mixing.mixture(docs, repeats=2.0))
    assert "Python" not in text and "Arrow" not in text
