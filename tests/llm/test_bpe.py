import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from legtrail.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LETTERS = "aAbB zé漢字🙂\n\t  1'sdtll.!\u0085 \x1c ſ"


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as file:
        return bpe.Coder(bpe.read_ranks(file.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    ranks = {token: i for i, token in enumerate(coder.tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(coder, library):
    draw = random.Random(1)
    for letters in (LETTERS, "abcdeinorst", "aaab "):
        for _ in range(500):
            text = "".join(draw.choices(letters, k=draw.randint(0, 120)))
            assert coder.encode(text) == library.encode_ordinary(text)
            assert coder.decode(coder.encode(text)) == text.encode()


def test_prefixes_grow_byte_by_byte(coder, library):
    table, data = bpe.Prefixes(coder), "internationalisation".encode()
    for i in range(len(data)):
        table.append(data[i : i + 1])
        assert table.ids() == bpe.Prefixes(coder, data[: i + 1]).ids()
    table.cut(5)
    assert table.ids() == bpe.Prefixes(coder, data[:5]).ids()


def test_edits_give_the_ids_of_the_new_text(coder, library):
    draw = random.Random(2)
    text = "".join(draw.choices(LETTERS + "thn ", k=3000))
    edited, anew = bpe.Edited(coder, text), 0
    for _ in range(100):
        start = draw.randint(0, len(edited.text))
        end = min(len(edited.text), start + draw.randint(0, 5))
        anew = max(anew, edited.replace(start, end, "".join(draw.choices(LETTERS, k=draw.randint(0, 6)))))
        assert edited.ids() == library.encode_ordinary(edited.text)
    assert anew < 60


def test_cache_starts_anew(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_CHARACTERS", 12)
    texts = ["one two three four five", "six seven eight", "one nine"]
    found = coder.coded_pieces(texts)
    assert [[i for piece in row for i in piece[0]] for row in found] == [library.encode_ordinary(t) for t in texts]


def test_documents(edges, library):
    rows = bpe.encode_documents(edges, PATH, public_tokenizers.PATTERN).collect()
    assert len(rows) == 10
    texts = {row.doc_id: row.text or "" for row in edges.collect()}
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert (row.n_tokens, row.ids) == (len(ids), ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_no_documents(nothing):
    assert bpe.encode_documents(nothing, PATH, public_tokenizers.PATTERN).collect() == []


def test_ranks_with_gaps_are_refused():
    with pytest.raises(ValueError):
        bpe.read_ranks(b"YQ== 0\nYg== 2\n")


def test_batches_by_size_hold_every_row():
    import pyarrow as pa

    from legtrail.llm.common import pieces_of_size

    texts = ["a" * n for n in (0, 3, 9, 1, 1, 40, 0, 2)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    parts = [part.column(0).to_pylist() for part in pieces_of_size([batch, batch.slice(0, 0)], 0, 10)]
    assert sum(parts, []) == texts and len(parts) == 3
