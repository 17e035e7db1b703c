"""Byte-level BPE by a dynamic program over byte prefixes.

Every prefix of a piece of text has one valid encoding, so it is enough to keep, for each prefix, the last
token of that encoding; the tokens before it are those of the prefix that ends where this token begins. A token
may end a prefix if it and the last token of the shorter prefix stay apart under the merge rules. So a byte more
needs one step, and an edit needs new steps only from the edited piece of text to where the pieces agree again.
"""

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterable
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from legtrail.llm.common import KEPT_CHARACTERS, pieces_of_size, texts_of

#: Bytes of text whose new pieces are encoded together, in order, so that neighbours share prefixes.
BYTES_AT_ONCE = 4_000_000


def read_ranks(lines: bytes) -> list[bytes]:
    """Token bytes by id, from a file with a base64 token and its rank on each line."""
    pairs = (line.split() for line in lines.splitlines() if line)
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


class Prefixes:
    """Last token of every prefix of one growing piece of text."""

    def __init__(self, coder: "Coder", data: bytes = b""):
        self.coder, self.data, self.last = coder, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """One step for each byte. Only one token fits, so the order of trying is free: the last token, a byte
        longer, then the shortest tokens first."""
        coder = self.coder
        token_of, apart, alone = coder.ranks.get, coder.apart.get, coder.alone.get
        longest, last, sizes = coder.longest, self.last, coder.sizes
        end, self.data = len(self.data), self.data + more
        data = self.data
        while end < len(data):
            end += 1
            begin = likely = end - 1 - sizes[last[-1]] if last else 0
            while True:
                token = token_of(data[begin:end])
                if token is not None:
                    if begin:
                        left = last[begin - 1]
                        fits = apart(left << 32 | token)
                        if fits is None:
                            fits = coder.stay_apart(left, token)
                    else:
                        fits = alone(token)
                        if fits is None:
                            fits = coder.stands(token)
                    if fits:
                        last.append(token)
                        break
                begin = end - 1 if begin == likely else begin - 1
                if begin == likely:
                    begin -= 1
                if begin < 0 or end - begin > longest:
                    raise ValueError("a byte has no token")

    def become(self, data: bytes) -> None:
        """The same as a new table of ``data``; steps are taken only beyond the common prefix."""
        old, same, most = self.data, 0, min(len(self.data), len(data))
        if data[:most] == old[:most]:
            same = most
        else:
            while data[same] == old[same]:
                same += 1
        del self.last[same:]
        self.data = data[:same]
        self.append(data[same:])

    def cut(self, length: int) -> None:
        self.data, self.last = self.data[:length], self.last[:length]

    def ids(self) -> list[int]:
        found, end, last, size = [], len(self.data), self.last, self.coder.sizes
        while end:
            token = last[end - 1]
            found.append(token)
            end -= size[token]
        found.reverse()
        return found


class Coder:
    """Encodes and decodes by token ranks and the pattern that first splits a text."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.ranks = {token: i for i, token in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.matches = regex.compile(pattern).finditer
        self.sizes = list(map(len, tokens))
        self.longest = max(self.sizes, default=0)
        self.never = len(tokens)
        self.apart: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.made_of: dict[int, tuple[int, int] | None] = {}
        self.table = Prefixes(self)
        self.decimal = list(map(str, range(len(tokens))))
        self.known: dict[str, tuple[list[int], str, bytes]] = {}
        self.characters = 0

    def parts(self, data: bytes, stop: int = 1) -> list[bytes]:
        """Plain merging, lowest rank first, until ``stop`` parts are left; for the few bytes of a token."""
        found = [data[i : i + 1] for i in range(len(data))]
        while len(found) > stop:
            ranks = [self.ranks.get(a + b, self.never) for a, b in zip(found, found[1:])]
            rank = min(ranks)
            if rank == self.never:
                break
            at = ranks.index(rank)
            found[at : at + 2] = [found[at] + found[at + 1]]
        return found

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives this one; None for a byte or a token that merging never gives."""
        if token not in self.made_of:
            two = self.parts(self.tokens[token], 2)
            real = len(two) == 2 and two[0] + two[1] in self.ranks
            self.made_of[token] = (self.ranks[two[0]], self.ranks[two[1]]) if real else None
        return self.made_of[token]

    def stands(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        found = self.alone[token] = len(self.tokens[token]) == 1 or self.halves(token) is not None
        return found

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the two tokens next to each other are the encoding of their bytes.

        Undoes merges at the seam, latest first (of equal ones the right one). While two tokens met at the seam,
        merging them must have come after the merge that took one of them away.
        """
        ok = self.stands(left) and self.stands(right)
        a, b, until, by_right = left, right, self.never, False
        while ok:
            seam = self.ranks.get(self.tokens[a] + self.tokens[b], self.never)
            if seam < until or by_right and seam == until and seam != self.never:
                ok = False
                break
            age_a = a if len(self.tokens[a]) > 1 else -1
            age_b = b if len(self.tokens[b]) > 1 else -1
            if age_a < 0 and age_b < 0:
                break
            by_right = age_b >= age_a
            if by_right:
                until, b = b, self.halves(b)[0]
            else:
                until, a = a, self.halves(a)[1]
        self.apart[left << 32 | right] = ok
        return ok

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern; a token as a whole is taken as it is."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        self.table.become(piece)
        return self.table.ids()

    def learn(self, missing: Iterable[str]) -> None:
        """Keeps for each piece of text its ids, the same in decimal, and the bytes that the ids decode to."""
        decimal = self.decimal
        for piece in sorted(missing):  # neighbours share prefixes
            ids = self.encode_piece(piece.encode())
            self.known[piece] = ids, ",".join([decimal[i] for i in ids]), self.decode(ids)

    def coded_pieces(self, texts: list[str]) -> list[list[tuple[list[int], str, bytes]]]:
        """What is known of each match of the pattern, text by text."""
        found = list(map(self.split, texts))
        different = set().union(*found)
        new = different.difference(self.known)
        self.characters += sum(map(len, new))
        if self.characters > KEPT_CHARACTERS:
            self.known.clear()
            self.characters, new = sum(map(len, different)), different
        self.learn(new)
        return [list(map(self.known.__getitem__, pieces_)) for pieces_ in found]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(piece[0] for piece in self.coded_pieces([text])[0]))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Edited:
    """An encoded text that is kept up to date under edits; only pieces near an edit are encoded anew."""

    def __init__(self, coder: Coder, text: str = ""):
        self.coder, self.text = coder, ""
        self.starts: list[int] = []
        self.coded: list[list[int]] = []
        self.replace(0, 0, text)

    def replace(self, start: int, end: int, new: str) -> int:
        """Puts ``new`` for characters ``start`` to ``end``; gives the number of pieces encoded anew.

        Splitting starts again two pieces before the edit (the pattern looks at one character beyond a match) and
        stops at the first old piece after the edit that begins where a new one does.
        """
        shift = len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        first = max(0, bisect_right(self.starts, start) - 3)
        begin = self.starts[first] if self.starts else 0
        later = {s + shift: i for i, s in enumerate(self.starts) if s >= end}
        stop, starts, coded = len(self.starts), [], []
        for match in self.coder.matches(self.text, begin):
            if match.start() in later and match.start() >= start + len(new):
                stop = later[match.start()]
                break
            starts.append(match.start())
            coded.append(self.coder.encode_piece(match.group().encode()))
        self.starts = self.starts[:first] + starts + [s + shift for s in self.starts[stop:]]
        self.coded = self.coded[:first] + coded + self.coded[stop:]
        return len(coded)

    def ids(self) -> list[int]:
        return list(chain.from_iterable(self.coded))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """Ids and round trip of every whole text.

    ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, unless ``with_ids`` is off, ``ids``. A null text counts as
    empty (no ids); repeated rows give repeated rows; a null ``doc_id`` stays null; other columns are left aside. The
    rank file (under 1 MB) is read once on the driver and shipped as a broadcast variable.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as file:
        content = spark.sparkContext.broadcast(file.read())

    def run(batches):
        coder = Coder(read_ranks(content.value), pattern)
        for part in pieces_of_size(batches, 1, BYTES_AT_ONCE):
            counts, hashes, decoded, all_ids = [], [], [], []
            for coded in coder.coded_pieces(part.column(1).to_pylist()):
                counts.append(sum([len(piece[0]) for piece in coded]))
                hashes.append(hashlib.sha256(",".join([piece[1] for piece in coded]).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([piece[2] for piece in coded])).hexdigest())
                if with_ids:
                    all_ids.append(list(chain.from_iterable([piece[0] for piece in coded])))
            columns = [part.column(0), pa.array(counts, pa.int64())]
            columns += [pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return texts_of(docs, "doc_id").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
