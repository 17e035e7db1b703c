import random

import numpy as np
import pytest

from legtrail.llm import gru, language

PARTS = {"aa": ["lo", "mi", "ra", "tu"], "bb": ["sch", "ung", "eit", "ber"], "cc": ["ция", "про", "ска", "ть"]}


def test_gradients_are_those_of_the_loss():
    net = gru.new_network(["a", "b", "c"], 4, 1)
    for cell in net.cells:
        cell.update({name: values.astype(float) for name, values in cell.items()})
    net.out, net.bias = net.out.astype(float), net.bias.astype(float)
    draw = np.random.default_rng(0)
    data, target = draw.integers(0, 5, (6, 7)).astype(np.uint8), draw.integers(0, 3, 6)
    _, found = gru.loss_gradients(net, data, target)
    for values, gradient in zip(net.parameters(), found):
        for _ in range(5):
            at = tuple(draw.integers(0, min(5, n)) for n in values.shape)
            kept = values[at]
            values[at] = kept + 1e-3
            more = gru.loss_gradients(net, data, target)[0]
            values[at] = kept - 1e-3
            less = gru.loss_gradients(net, data, target)[0]
            values[at] = kept
            assert gradient[at] == pytest.approx((more - less) / 2e-3, abs=1e-4)


def test_both_directions_reach_every_position():
    net = gru.new_network(["a", "b"], 8, 2)
    one = gru.label_positions(net, np.frombuffer(b"abcdef", np.uint8)[None])
    other = gru.label_positions(net, np.frombuffer(b"xbcdef", np.uint8)[None])
    last = gru.label_positions(net, np.frombuffer(b"abcdex", np.uint8)[None])
    assert one.shape == (1, 6, 2) and np.allclose(one.sum(axis=2), 1)
    assert not np.allclose(one[0, 5], other[0, 5]) and not np.allclose(one[0, 0], last[0, 0])


def test_pooling_is_the_sum_over_positions():
    net = gru.new_network(["a", "b"], 8, 2)
    text = "Some words, some 42 " + "x" * 70
    total = np.zeros(2)
    for word in text.lower().split():
        if any(map(str.isalpha, word)):
            for data in language.sequences(word):
                total += gru.label_positions(net, np.frombuffer(data, np.uint8)[None])[0].sum(axis=0)
    label, score = language.Labeller(net).pooled([text])[0]
    assert (label, score) == ("ab"[total.argmax()], pytest.approx(total.max() / total.sum()))


@pytest.fixture(scope="module")
def texts():
    draw, rows = random.Random(1), []
    for i in range(240):
        lang = ("aa", "bb", "cc")[i % 3]
        rows.append((i, " ".join("".join(draw.choices(PARTS[lang], k=draw.randint(1, 3))) for _ in range(20)), lang))
    return rows


def test_held_out_accuracy(documents, texts):
    rows = language.identify(documents([*texts, (900, None), (901, "12 34 !"), (902, ""), (None, "lomi ratu", "bb")])).collect()
    truth = {i: lang for i, _, lang in texts}
    assert len(rows) == 244 and {r.held_out for r in rows} == {True, False}
    assert all(r.lang_pred == truth[r.doc_id] for r in rows if r.doc_id in truth)
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (900, 901, 902)} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in rows)


def test_nothing_to_learn_from(edges, nothing):
    assert {(r.lang_pred, r.score) for r in language.identify(edges).collect()} == {("und", 0.0)}
    assert language.identify(nothing).collect() == []


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(language, "KEPT_CHARACTERS", 15)
    net = gru.new_network(["a", "b"], 8, 2)
    labeller = language.Labeller(net)
    found = [labeller.pooled([text])[0] for text in ("one two three", "four five", "one two three")]
    assert found[0] == found[2]


def test_every_position_has_a_label():
    net = gru.new_network(["a", "b"], 8, 2)
    found = language.Labeller(net).positions("Ünder " + "y" * 40)
    assert [(word, len(labels)) for word, labels in found] == [("ünder", 8), ("y" * 40, 42)]
