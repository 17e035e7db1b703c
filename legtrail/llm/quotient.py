"""Counting quotient filters without loss, kept sorted, over packed sequences of whole numbers.

A sequence of up to ``longest`` numbers of ``bits`` bits (0: no number) is packed in one key. The key is permuted by a
Feistel network, which can be undone; the high bits of the permuted key are its quotient, all other bits are kept as
its remainder. A filter holds the entries of one range of permuted keys (those that begin with the same ``depth`` bits)
in order: a bit for each quotient that occurs, a bit for each entry that ends its run, the remainders in their whole
bytes and then the bits beyond them, and a bit for each entry that counts more than once, whose counts follow in bytes, large ones
apart. Equal keys have equal places in all filters, so filters are merged by
merging what is sorted, and nothing is lost: keys come back by undoing the permutation.
"""

from dataclasses import dataclass

import numpy as np

ROUNDS = 4


def spread(values: np.ndarray, turn: int) -> np.ndarray:
    """A well-spread hash of 64-bit values, another one for each turn."""
    values = values + np.uint64((0x9E3779B97F4A7C15 * (turn + 1)) % 2**64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def mask(bits: int) -> np.uint64:
    return np.uint64(2**bits - 1)


@dataclass(frozen=True)
class Entries:
    """Permuted keys in order, as high and low part, and how often each occurs."""

    high: np.ndarray
    low: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.counts)

    def __getitem__(self, part) -> "Entries":
        return Entries(self.high[part], self.low[part], self.counts[part])


@dataclass(frozen=True)
class Layout:
    """How sequences are packed: ``longest`` numbers below 2 ** ``bits``, in two words."""

    longest: int
    bits: int

    def __post_init__(self):
        if not (self.longest >= 2 and 1 <= self.bits and self.longest * self.bits <= 126):
            raise ValueError("a key has two numbers or more, and 126 bits at most")

    @property
    def total(self) -> int:
        return self.longest * self.bits

    @property
    def low_bits(self) -> int:
        return self.total // 2

    @property
    def high_bits(self) -> int:
        return self.total - self.low_bits

    def packed(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Keys of sequences given as one array for each place; places at the end may be left out."""
        high, low = (np.zeros(len(columns[0]), np.uint64) for _ in range(2))
        move, carry = np.uint64(self.bits), np.uint64(self.low_bits - self.bits)
        for i in range(self.longest):
            high = ((high << move) | (low >> carry)) & mask(self.high_bits)
            low = (low << move) & mask(self.low_bits)
            if i < len(columns):
                low |= columns[i].astype(np.uint64)
        return high, low

    def unpacked(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        columns = []
        move, carry = np.uint64(self.bits), np.uint64(self.low_bits - self.bits)
        for _ in range(self.longest):
            columns.append((low & mask(self.bits)).astype(np.int64))
            low = (low >> move) | ((high & mask(self.bits)) << carry)
            high = high >> move
        return columns[::-1]

    def permuted(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for turn in range(ROUNDS):
            high = high ^ (spread(low, 2 * turn) & mask(self.high_bits))
            low = low ^ (spread(high, 2 * turn + 1) & mask(self.low_bits))
        return high, low

    def restored(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for turn in reversed(range(ROUNDS)):
            low = low ^ (spread(high, 2 * turn + 1) & mask(self.low_bits))
            high = high ^ (spread(low, 2 * turn) & mask(self.high_bits))
        return high, low

    def counted(self, high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> Entries:
        """Permuted keys in any order as sorted entries, equal ones as one; without counts each counts once."""
        n = len(high)
        if self.total <= 64:
            whole = (high << np.uint64(self.low_bits)) | low
            if counts is None:
                whole.sort()
            else:
                order = np.argsort(whole, kind="stable")  # fast on what is sorted in long stretches
                whole, counts = whole[order], counts[order]
            new = np.flatnonzero(whole[1:] != whole[:-1]) + 1
            first = np.append(np.zeros(min(n, 1), np.int64), new)
            high, low = whole[first] >> np.uint64(self.low_bits), whole[first] & mask(self.low_bits)
        else:
            order = np.lexsort((low, high))
            high, low = high[order], low[order]
            counts = None if counts is None else counts[order]
            new = np.flatnonzero((high[1:] != high[:-1]) | (low[1:] != low[:-1])) + 1
            first = np.append(np.zeros(min(n, 1), np.int64), new)
            high, low = high[first], low[first]
        if counts is None:
            counts = np.diff(np.append(first, n))
        else:
            counts = np.add.reduceat(counts, first) if n else counts
        return Entries(high, low, counts)

    def ranges(self, entries: Entries, depth: int) -> list[tuple[int, Entries]]:
        """(first ``depth`` bits, entries) of each range that has entries; all bits of a range are in the high part."""
        begin = entries.high >> np.uint64(self.high_bits - depth)
        cuts = np.flatnonzero(begin[1:] != begin[:-1]) + 1
        starts = np.append(np.zeros(min(len(entries), 1), np.int64), cuts)
        ends = np.append(cuts, len(entries))
        return [(int(begin[a]), entries[a:b]) for a, b in zip(starts, ends)]


def size_of(bits: int, n: int) -> int:
    """Bytes for ``n`` numbers of so many bits."""
    return n * (bits // 8) + -(-n * (bits % 8) // 8)


def quotient_bits(layout: Layout, depth: int, entries: int) -> int:
    """Bits of the quotient below the range: about one quotient for each entry."""
    return min(layout.high_bits - depth, max(0, entries - 1).bit_length())


def to_bytes(layout: Layout, depth: int, entries: Entries) -> bytes:
    """A filter over entries of one range of ``depth`` bits."""
    n = len(entries)
    q = quotient_bits(layout, depth, n)
    high_rest = layout.high_bits - depth - q
    in_range = entries.high & mask(layout.high_bits - depth)
    quotient = (in_range >> np.uint64(high_rest)).astype(np.int64)
    occupied = np.zeros(2**q, bool)
    occupied[quotient] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True)[:n]
    parts = [bytes_of(in_range & mask(high_rest), high_rest), bytes_of(entries.low, layout.low_bits)]
    often = entries.counts > 1
    several = entries.counts[often]
    small = np.minimum(several, 255).astype(np.uint8)
    large = several[several >= 255].astype("<i8")
    head = np.array([n, q, len(small), len(large)], "<i8").tobytes()
    bits = [np.packbits(flags).tobytes() for flags in (occupied, run_end, often)]
    return b"".join([head, *bits, *parts, small.tobytes(), large.tobytes()])


def from_bytes(layout: Layout, depth: int, begin: int, data: bytes) -> Entries:
    """The entries of a filter of the range that begins with ``begin``."""
    n, q, small, large = (int(x) for x in np.frombuffer(data, "<i8", 4))
    at = 32
    high_rest = layout.high_bits - depth - q

    def take(size: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, np.uint8, size, at)
        at += size
        return found

    occupied = np.flatnonzero(np.unpackbits(take(-(-(2**q) // 8)), count=2**q))
    run_end = np.unpackbits(take(-(-n // 8)), count=n)
    often = np.unpackbits(take(-(-n // 8)), count=n).astype(bool)
    run = np.cumsum(run_end) - run_end
    quotient = occupied[run].astype(np.uint64)
    rest = numbers_of(take(size_of(high_rest, n)), high_rest, n)
    low = numbers_of(take(size_of(layout.low_bits, n)), layout.low_bits, n)
    high = (np.uint64(begin << (layout.high_bits - depth))) | (quotient << np.uint64(high_rest)) | rest
    several = take(small).astype(np.int64)
    several[several == 255] = np.frombuffer(data, "<i8", large, at)
    counts = np.ones(n, np.int64)
    counts[often] = several
    return Entries(high, low, counts)


def bytes_of(values: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of each value: first their whole bytes, then the bits beyond them of all values together."""
    whole, over = divmod(bits, 8)
    data = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    if not over:
        return data[:, :whole].tobytes()
    beyond = np.unpackbits(np.ascontiguousarray(data[:, whole]), bitorder="little").reshape(-1, 8)[:, :over]
    return data[:, :whole].tobytes() + np.packbits(beyond, bitorder="little").tobytes()


def numbers_of(data: np.ndarray, bits: int, n: int) -> np.ndarray:
    whole, over = divmod(bits, 8)
    full = np.zeros((n, 8), np.uint8)
    full[:, :whole] = data[: n * whole].reshape(n, whole)
    if over:
        beyond = np.unpackbits(data[n * whole :], count=n * over, bitorder="little").reshape(n, over)
        full[:, whole] = np.packbits(beyond, axis=1, bitorder="little")[:, 0]
    return full.reshape(-1).view("<u8")


def merged(layout: Layout, filters: list[Entries]) -> Entries:
    """One filter's entries from those of several over the same range."""
    if not filters:
        none = np.zeros(0, np.uint64)
        return Entries(none, none, np.zeros(0, np.int64))
    parts = [np.concatenate([getattr(f, name) for f in filters]) for name in ("high", "low", "counts")]
    return layout.counted(*parts)
