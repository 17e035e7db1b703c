import random
import re

import pytest

from legtrail.llm import line_runs


def plain_removed(docs, least):
    """Lines in runs of ``least`` words that also occur earlier, by comparing all runs of lines."""
    seen, gone = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        lines = (text or "").split("\n")
        for start in range(len(lines)):
            for end in range(start + 1, len(lines) + 1):
                run = tuple(lines[start:end])
                if (words := sum(len(re.findall(r"\S+", line)) for line in run)) >= least and run in seen:
                    gone.setdefault(doc_id, set()).update(range(start, end))
                if words or run:
                    seen.add(run)
    return gone


def check(documents, docs, least):
    expected = plain_removed(docs, least)
    for row in line_runs.deduplicated(documents(docs), least).collect():
        gone = {i for s in row.removed for i in range(s["first"], s["last"])}
        assert gone == expected.get(row.doc_id, set()), row.doc_id
        lines = (dict(docs)[row.doc_id] or "").split("\n")
        assert row.text == "\n".join(line for i, line in enumerate(lines) if i not in gone)
        assert (row.n_lines, row.n_removed) == (len(lines), len(gone))


@pytest.mark.parametrize("seed, least", [(1, 1), (2, 4), (3, 9), (4, 30)])
def test_random_documents_against_all_runs(documents, seed, least):
    draw = random.Random(seed)
    pool = ["", "a", "b c", "d", " e  f g ", "h\ti", *[f"line {i}" for i in range(4)]]
    docs = []
    for i in range(25):
        lines = draw.choices(pool, k=draw.randint(0, 10))
        if docs and draw.random() < 0.6:
            other = draw.choice(docs)[1].split("\n")
            at = draw.randint(0, len(other))
            lines[draw.randint(0, len(lines)) :] = other[at : at + draw.randint(0, 12)]
        docs.append((i, "\n".join([*lines, f"own {i}"][draw.randint(0, 1) :])))
    check(documents, docs, least)


def test_long_copies_of_short_lines(documents):
    lines = [f"w{i % 7}" for i in range(150)]
    check(documents, [(1, "\n".join(lines)), (2, "x\n" + "\n".join(lines[20:90])), (3, "\n".join(lines[::-1]))], 40)


def test_edges(edges):
    rows = {(r.doc_id, r.n_lines): r for r in line_runs.deduplicated(edges).collect()}
    assert len(rows) == 9  # the repeated row gives the same result twice
    assert rows[1, 1].n_removed == 0 and rows[5, 1].n_removed == 0 and rows[6, 1].n_removed == 1
    assert rows[6, 1].text == "" and rows[2, 1].text == "" and rows[None, 1].text == "no id here at all"


def test_pipeline_form_keeps_columns(edges):
    rows = line_runs.without_copies(edges)
    assert rows.columns == edges.columns
    assert sorted(str(r.doc_id) for r in rows.collect()) == ["1", "1", "2", "3", "4", "5", "7", "8", "None"]


def test_no_documents(nothing):
    assert line_runs.deduplicated(nothing).collect() == []
    assert line_runs.without_copies(nothing).collect() == []
