"""Toxicity of documents whose words may be disguised.

A disguised word is read as the output of a noisy channel: letters may be written as look-alike digits and signs,
repeated, or set apart by separators. Each written character has a few readings, which make a lattice; the Viterbi
path under a character language model is the restored text. Documents are scored by the words (and beginnings
of words) of the restored text that mark toxic documents among those labelled.
"""

import re
import string
from collections import Counter
from itertools import chain, groupby
from math import exp, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from legtrail.llm.common import Kept, labelled_sample, pieces, pieces_of_size, remainder, texts_of
from legtrail.session import scratch

#: Labelled documents that the marks and the weights are learned from, at most; letters are counted over all texts.
LABELLED_DOCUMENTS = 12_000
#: Different tokens that a task holds with their numbers before it counts their letters.
TOKENS_AT_ONCE = 300_000
#: Bytes of text whose tokens are looked up together, more only for a single long text.
TEXT_AT_ONCE = 2 << 20
#: Score from which a document counts as toxic.
TOXIC = 0.7
#: Letters and digits of a token that may be a part of a word set apart, at most.
CHUNK = 4
#: Single characters in a row that are read as one word, at least.
SINGLES = 3
#: Lengths of the beginnings of words that may be marks.
BEGINNINGS = range(4, 9)
#: A mark is in so many toxic documents at least, and this much likelier there (log), beyond chance (likelihood ratio).
LEAST_TOXIC, LEAST_WEIGHT, LEAST_RATIO = 4, 3.0, 25.0

# Letters that digits and signs stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
# Fixed value: letters of the Latin script, of which look-alikes are written.
LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u024f]{2,}")
# Log probabilities of the channel: a look-alike, a repeated letter; a sign within a word and between words; a digit so.
AS_LOOK_ALIKE, AS_REPEAT = -1.0, -1.0
AS_NOISE, AS_GAP = -1.5, -3.5
DIGIT_AS_NOISE, DIGIT_AS_GAP = -8.0, -6.0


class LetterModel:
    """Probability of a letter after two others; a space stands before and after a word."""

    def __init__(self, counts: dict[str, float]):
        self.three, self.two, self.one = Counter(counts), Counter(), Counter()
        self.pairs, self.singles = Counter(), Counter()
        for letters, n in counts.items():
            self.two[letters[1:]] += n
            self.one[letters[2]] += n
            self.pairs[letters[:2]] += n
            self.singles[letters[1]] += n
        self.total = sum(self.one.values())
        self.known: dict[str, float] = {}

    def __call__(self, before: str, letter: str) -> float:
        """Log probability of ``letter`` after the two characters ``before``."""
        key = before + letter
        found = self.known.get(key)
        if found is None:
            p = (self.one[letter] + 0.1) / (self.total + 10)
            p = (self.two[key[1:]] + 2 * p) / (self.singles[before[1]] + 2)
            p = (self.three[key] + 4 * p) / (self.pairs[before] + 4)
            found = self.known[key] = log(p)
        return found


def trigrams(word: str) -> list[str]:
    full = f"  {word} "
    return [full[i : i + 3] for i in range(len(full) - 2)]


def readings(written: str, at: int) -> list[tuple[str, float]]:
    """What the character at a place may stand for: a letter, nothing, or a space (end of a word)."""
    char = written[at]
    if char.isalpha():
        repeat = at and written[at - 1] == char
        return [(char, 0.0), ("", AS_REPEAT)] if repeat else [(char, 0.0)]
    found = [(letter, AS_LOOK_ALIKE) for letter in LOOK_ALIKES.get(char, "")]
    if at and written[at - 1] == char:
        found.append(("", AS_REPEAT))
    noise, gap = (DIGIT_AS_NOISE, DIGIT_AS_GAP) if char.isdigit() else (AS_NOISE, AS_GAP)
    return [*found, ("", noise), (" ", gap)]


def restored(written: str, model: LetterModel) -> str:
    """The likeliest text behind ``written``, by Viterbi over pairs of last characters."""
    paths: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
    for at in range(len(written)):
        after: dict[str, tuple[float, tuple | None]] = {}
        for reading, channel in readings(written, at):
            for last, (score, path) in paths.items():
                if reading == "" or reading == last[1] == " ":
                    state, total, new = last, score + channel, path
                else:
                    state = "  " if reading == " " else last[1] + reading
                    total, new = score + channel + model(last, reading), (reading, path)
                if state not in after or total > after[state][0]:
                    after[state] = (total, new)
        paths = after
    best = max(paths.items(), key=lambda item: item[1][0] + (0.0 if item[0][1] == " " else model(item[0], " ")))[1]
    letters, path = [], best[1]
    while path:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters))


TWICE, THRICE = re.compile(r"(.)\1", re.DOTALL), re.compile(r"(.)\1\1", re.DOTALL)
SIGNS = re.compile("[" + re.escape("".join(LOOK_ALIKES)) + "]")
#: Letters, then only signs and digits.
LETTERS_FIRST = re.compile(r"([^\W\d_]+)([\W\d_]*)")
#: Letters by which a word is first compared with all marks.
HEAD = 4


def once(text: str) -> str:
    """The text with every row of one character as that character."""
    return "".join([char for char, before in zip(text, " " + text) if char != before])


def plain(core: str) -> bool:
    """Letters only, none three times in a row: nothing to restore."""
    return core.isalpha() and not THRICE.search(core)


def core_of(token: str) -> str:
    """The token without signs around it."""
    if token.isalnum():
        return token
    token = token.strip(string.punctuation)  # the usual ones at once
    start, end = 0, len(token)
    while start < end and not token[start].isalnum():
        start += 1
    while end > start and not token[end - 1].isalnum():
        end -= 1
    return token[start:end]


def certain(token: str, core: str) -> bool:
    """Nothing in the token could be a disguise: letters only, none twice in a row, no look-alike around them."""
    if not core.isalpha() or TWICE.search(core):
        return False
    return len(core) == len(token) or not SIGNS.search(token)


class Words(Kept):
    """The words behind each token as it is written: the likeliest reading, and the letters as they stand."""

    def __init__(self, model: LetterModel | None):
        super().__init__()
        self.model = model

    def made(self, token: str) -> tuple[str, ...]:
        core = core_of(token)
        literal = (core,) if plain(core) else ()
        if self.model is None or certain(token, core):
            return literal
        if not SIGNS.search(token) and not any(map(str.isalpha, token)):
            return ()
        return tuple(dict.fromkeys((*literal, *restored(token, self.model).split())))


def single(token: str) -> str:
    """The one character of a token, without signs around it; empty if there are more."""
    if len(token) == 1:
        return token
    core = core_of(token) if len(token) <= 2 * CHUNK else ""
    return core if len(core) == 1 else ""


def spaced(tokens: list[str], chars: dict[int, str]) -> list[str]:
    """Rows of three or more single characters, each as one token with spaces; ``chars`` has those by their place, in order."""
    if sum(len(tokens[place]) <= 3 for place in chars) < SINGLES:
        return []
    found = []
    for _, row in groupby(enumerate(chars), lambda pair: pair[1] - pair[0]):
        row = [chars[place] for _, place in row]
        if len(row) >= SINGLES:
            found.append(" ".join(row))
    return found


def chunk_of(token: str) -> str:
    """A token that may be part of a word, without signs around it that stand for no letter; empty if it is too long."""
    if not 0 < len(core_of(token)) <= CHUNK and token not in LOOK_ALIKES:
        return ""
    return token.strip("".join({c for c in token if not c.isalnum() and c not in LOOK_ALIKES}))


def tokens_of(text: str) -> set[str]:
    tokens = text.lower().split()
    short = ((place, token) for place, token in enumerate(tokens) if len(token) <= 2 * CHUNK)
    return {*tokens, *spaced(tokens, {place: char for place, token in short if (char := single(token))})}


def marks_of(word: str) -> list[str]:
    """A word as a whole, and its beginnings."""
    return [f"{word}$", *(word[:n] for n in BEGINNINGS if n <= len(word))]


class Letters(dict):
    """A bit for each letter that a character may stand for; different letters may share one."""

    def __missing__(self, char: str) -> int:
        bits = 0
        for letter in LOOK_ALIKES.get(char, char):
            bits |= 1 << ord(letter) % 61
        self[char] = bits
        return bits

    def of(self, text: str) -> int:
        bits = 0
        for char in text:
            bits |= self[char]
        return bits


class Starts(Kept):
    """For each token the beginnings of marked words that it may stand for, as first part of a word set apart."""

    def __init__(self, marks: dict[str, float]):
        super().__init__()
        whole = [mark[:-1] for mark in marks if mark.endswith("$")]
        self.beginnings = {word[:n] for word in whole for n in range(len(word) + 1)}

    def after(self, before: set[str], chunk: str) -> set[str]:
        for at in range(len(chunk)):
            letters = [letter for letter, _ in readings(chunk, at) if letter != " "]
            before = {word + letter for word in before for letter in letters} & self.beginnings
        return before

    def made(self, token: str) -> set[str]:
        chunk = chunk_of(token)
        return self.after({""}, chunk) - {""} if chunk else set()


class Token(NamedTuple):
    """What a token may mean: the weight of its strongest mark, its one character, what marked words it may begin."""

    weight: float
    char: str
    begins: frozenset[str]


class Row(NamedTuple):
    """What neighbouring short tokens may stand for: beginnings of marked words, and marked words that they are read as."""

    reached: set[str]
    complete: set[str]


class Rows(Kept):
    """What each row of tokens, with spaces between them, may stand for; it goes on from the row without its last token."""

    def __init__(self, starts: "Starts", words: Words, marks: dict[str, float]):
        super().__init__()
        self.starts, self.words, self.marks = starts, words, marks

    def made(self, row: str) -> Row:
        before, _, token = row.rpartition(" ")
        if not before:
            return Row(self.starts.made(token), set())
        chunk = chunk_of(token)
        reached = self.starts.after(self[before].reached, chunk) - {""} if chunk else set()
        complete = {word for word in reached if f"{word}$" in self.marks}
        if complete:
            complete &= set(self.words[" ".join(map(chunk_of, row.split(" ")))])
        return Row(reached, complete)


#: Most tokens: nothing to look at again.
NOTHING = Token(0.0, "", frozenset())


def packed(codes: list[np.ndarray]) -> np.ndarray:
    """Code points of up to ``HEAD`` places, each an array, as one number."""
    whole = np.zeros(len(codes[0]), np.uint64)
    for code in codes:
        whole = whole << np.uint64(16) | (code & 0xFFFF).astype(np.uint64)
    return whole


def packed_texts(texts: set[str], size: int) -> np.ndarray:
    """The texts of one size, packed."""
    chosen = [text for text in texts if len(text) == size]
    places = [np.array([ord(text[i]) for text in chosen], np.int64) for i in range(size)]
    return packed(places) if chosen else np.zeros(0, np.uint64)


class Tokens(Kept):
    """What each token means, looked at once by a task."""

    def __init__(self, words: Words, marks: dict[str, float]):
        super().__init__()
        self.words, self.marks, self.starts = words, marks, Starts(marks)
        self.rows = Rows(self.starts, words, marks)
        self.signs: dict[str, bool] = {}
        self.whole_heads = packed_texts({mark.removesuffix("$")[:HEAD] for mark in marks}, HEAD)
        self.once_heads = [packed_texts({once(mark.removesuffix("$")[:HEAD]) for mark in marks}, n + 1) for n in range(HEAD)]
        self.heads = {mark.removesuffix("$")[:HEAD] for mark in marks}
        self.heads_once = {once(head) for head in self.heads}
        self.letters = Letters()
        needed = {self.letters.of(mark.removesuffix("$")) for mark in marks}
        self.needed = [bits for bits in needed if not any(bits & other == other != bits for other in needed)]

    def able(self, token: str) -> bool:
        """False if no reading of the token can hold a mark.

        What stands before the first sign begins the first word, but for repeats; later words are made of signs alone, if
        only signs follow. A word that is to hold a mark has all its letters, and begins as it does.
        """
        parts = LETTERS_FIRST.fullmatch(token)
        if parts and parts[1].isalpha():
            begin = once(parts[1][: 4 * HEAD])
            if len(begin) >= HEAD or len(parts[1]) < 4 * HEAD and not parts[2]:
                if any(begin[:n] in self.heads_once for n in range(1, HEAD + 1)):
                    return True
                signs = parts[2][:16] if SIGNS.search(parts[2]) else ""
                if signs not in self.signs:
                    self.signs[signs] = self.has_letters(parts[2])
                return self.signs[signs] if signs == parts[2] else bool(signs) and self.has_letters(parts[2])
        return self.has_letters(token)

    def has_letters(self, token: str) -> bool:
        """Whether all letters of some mark are among those that the characters may stand for."""
        there = self.letters.of(token)
        for bits in self.needed:
            if there & bits == bits:
                return True
        return False

    def nothing(self, tokens: np.ndarray) -> np.ndarray:
        """True for tokens that :meth:`made` would give ``NOTHING`` for: most words, told in arrays over their letters.

        They are of Latin letters, with a point or comma behind at most, too long to be part of a word set apart, and
        begin like no marked word: as they stand, or if letters are repeated, with every repeat dropped.
        """
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        if self.words.model is None or not len(tokens):
            return np.zeros(len(tokens), bool)
        codes = np.frombuffer("".join(tokens).encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        latin = (codes >= 97) & (codes <= 122) | (codes >= 0xDF) & (codes <= 0x24F) & (codes != 0xF7)
        pointed = np.isin(codes[ends - 1], [ord(c) for c in ".,;:"])
        others = np.add.reduceat(~latin, starts, dtype=np.int64)
        able = (others == pointed) & (sizes - pointed > CHUNK)
        new = np.append(True, codes[1:] != codes[:-1])
        new[starts] = True
        repeated = np.add.reduceat(~new, starts, dtype=np.int64) > 0
        places = [codes[np.minimum(starts + i, len(codes) - 1)] for i in range(HEAD)]
        marked = np.isin(packed(places), self.whole_heads)
        # the first places at which letters stand with every repeat dropped
        kept = np.flatnonzero(new)
        first = np.searchsorted(kept, starts)
        enough = np.append(first[1:], len(kept)) - first - pointed >= HEAD
        once_places = [codes[kept[np.minimum(first + i, len(kept) - 1)]] for i in range(HEAD)]
        marked_once = np.zeros(len(tokens), bool)
        for n in range(HEAD):
            marked_once |= np.isin(packed(once_places[: n + 1]), self.once_heads[n])
        return able & np.where(repeated, enough & ~marked_once, ~marked)

    def mark(self, word: str) -> float:
        """The weight of the strongest mark of a word."""
        if word[:HEAD] not in self.heads:
            return 0.0
        return max([self.marks.get(mark, 0.0) for mark in marks_of(word)])

    def made(self, token: str) -> Token:
        core = core_of(token)
        if self.words.model is None:
            words = (core,) if plain(core) else ()
        elif certain(token, core):
            if len(core) > CHUNK and core[:HEAD] not in self.heads:
                return NOTHING  # most words
            words = (core,)
        else:
            words = self.words[token] if self.able(token) else ()
        weight = max(map(self.mark, words), default=0.0)
        char = core if len(core) == 1 and len(token) <= 2 * CHUNK else token if len(token) == 1 else ""
        begins = self.starts.made(token) if len(core) <= CHUNK else None
        return Token(weight, char, frozenset(begins or ())) if weight or char or begins else NOTHING

    def joined(self, tokens: list[str], places: list[int]) -> set[str]:
        """Marked words set apart over neighbouring short tokens, where the letter model reads them so.

        Rows begin at ``places``. Beginnings of words do not count here: neighbours that make one by chance are frequent.
        """
        found = set()
        if self.words.model is None or not self.marks:
            return found
        for place in places:
            row = tokens[place]
            for at in range(place + 1, len(tokens)):
                after = tokens[at]
                if len(after) > CHUNK and after.isalnum():
                    break
                row = f"{row} {after}"
                known = self.rows[row]
                if known.complete:
                    found |= known.complete
                if not known.reached:
                    break
        return found

    def evidence(self, text: str) -> list[float]:
        return self.evidences([text])[0]

    def evidences(self, texts: list[str]) -> list[list[float]]:
        """For each text: its strongest mark, how many there are, and what they weigh together.

        Tokens are encoded for all texts at once, so that each is looked up once, and only places of tokens that may
        tell something are gone through.
        """
        rows = [text.lower().split() for text in texts]
        coded = pa.array(chain.from_iterable(rows), pa.large_string()).dictionary_encode()
        kinds = coded.dictionary.to_numpy(zero_copy_only=False)
        known = [NOTHING if nothing else self[token] for token, nothing in zip(kinds, self.nothing(kinds).tolist())]
        telling = np.fromiter((found is not NOTHING for found in known), bool, len(known))
        codes = coded.indices.to_numpy()
        places = np.flatnonzero(telling[codes])
        begins = np.append(0, np.cumsum([len(row) for row in rows], dtype=np.int64))
        cuts = np.searchsorted(places, begins)
        found = []
        for row, begin, first, last in zip(rows, begins.tolist(), cuts[:-1], cuts[1:]):
            some = places[first:last]
            tokens = {place - begin: known[code] for place, code in zip(some.tolist(), codes[some].tolist())}
            found.append(self.weighed(row, tokens) if tokens else [0.0, 0.0, 0.0])
        return found

    def weighed(self, row: list[str], tokens: dict[int, Token]) -> list[float]:
        """The evidence of a row of tokens, of which those that may tell something are known by their places."""
        hits = [weight for weight in {row[place]: token.weight for place, token in tokens.items()}.values() if weight]
        apart = spaced(row, {place: token.char for place, token in tokens.items() if token.char})
        hits += [weight for weight in (self[text].weight for text in set(apart)) if weight]
        words = self.joined(row, [place for place, token in tokens.items() if token.begins])
        hits += [self.marks[f"{word}$"] for word in words]
        hits.sort()  # sums must not depend on the order in a set
        return [max(hits, default=0.0), log(1 + len(hits)), log(1 + sum(hits))]


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights and, last, the constant, by Newton steps with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * w)
    return w


class Model:
    """Letter model, marks and weights; gives scores."""

    def __init__(self, letters: LetterModel | None, marks: dict[str, float], weights: np.ndarray):
        self.letters, self.marks, self.weights = letters, marks, weights

    def scorer(self):
        tokens = Tokens(Words(self.letters), self.marks)
        *slopes, constant = self.weights.tolist()

        def scores(texts: list[str]) -> list[float]:
            margins = [constant + sum(a * b for a, b in zip(slopes, found)) for found in tokens.evidences(texts)]
            return [1 / (1 + exp(-min(30.0, max(-30.0, margin)))) for margin in margins]

        return scores


def triples(words: list[str], n: np.ndarray) -> dict[str, int]:
    """How often each three letters occur in words of Latin letters, the i-th word counting ``n[i]`` times.

    Words with one letter three times in a row are left out.
    """
    codes = np.frombuffer("".join([f"  {word} " for word in words]).encode("utf-16-le"), "<u2").astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 3
    inside = np.ones(len(codes), bool)
    ends = np.cumsum(sizes)
    inside[ends - 1] = inside[ends - 2] = False  # would go on in the next word
    rows = np.flatnonzero((codes[:-2] == codes[1:-1]) & (codes[1:-1] == codes[2:]) & (codes[:-2] != ord(" ")))
    for word in np.unique(np.searchsorted(ends, rows, side="right")):
        inside[ends[word] - sizes[word] : ends[word]] = False
    found = codes[:-2] << 20 | codes[1:-1] << 10 | codes[2:]
    kinds, place = np.unique(found[inside[:-2]], return_inverse=True)
    totals = np.bincount(place, np.repeat(n, sizes)[:-2][inside[:-2]], len(kinds))
    texts = (chr(kind >> 20) + chr(kind >> 10 & 1023) + chr(kind & 1023) for kind in kinds.tolist())
    return dict(zip(texts, map(int, totals.tolist())))


def letter_model(texts: DataFrame) -> LetterModel | None:
    """From the plain words of all texts, each once for every document that has it; labels play no part.

    Only words of Latin letters count, as look-alikes stand for no others: so there are at most as many
    triples as that alphabet has, however large the corpus.
    """

    def run(batches):
        counts: Counter = Counter()
        tokens: Counter = Counter()

        def add():
            cores = ((core_of(token), n) for token, n in tokens.items())
            known = [(core, n) for core, n in cores if LATIN.fullmatch(core)]
            if known:
                counts.update(triples([core for core, _ in known], np.array([n for _, n in known])))
            tokens.clear()

        for part in pieces(batches):
            for text in part.column(0).to_pylist():
                tokens.update(set(text.lower().split()))
                if len(tokens) > TOKENS_AT_ONCE:
                    add()
        add()
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["letters", "n"])

    counted = texts.select("_text").mapInArrow(run, "letters string, n bigint")
    counts = counted.groupBy("letters").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    return LetterModel(dict(zip(counts["letters"], map(float, counts["n"])))) if counts["letters"] else None


def find_marks(words: DataFrame) -> dict[str, float]:
    """Marks and their weights from (id, label, words), a row for each document; those rare in toxic ones stay where they are.

    Each document gives its different marks, so they are counted in one pass, in part before the shuffle.
    """
    cut = lambda n: lambda word: F.when(F.char_length(word) >= n, F.substring(word, 1, n))
    beginnings = [F.transform("words", cut(n)) for n in BEGINNINGS]
    whole = F.transform("words", lambda w: F.concat(w, F.lit("$")))
    kinds = F.array_distinct(F.array_compact(F.concat(whole, *beginnings)))
    rows = words.dropDuplicates(["id"]).select("label", F.explode(kinds).alias("mark"))
    counted = rows.groupBy("mark").agg(F.sum("label").alias("t"), F.count("*").alias("n"))
    counted = counted.filter(F.col("t") >= LEAST_TOXIC).toArrow().to_pydict()
    total, toxic = words.agg(F.count("*"), F.sum("label")).first()
    found = {}
    share = (toxic or 0) / max(1, total)
    for mark, t, n in zip(counted["mark"], counted["t"], counted["n"]):
        other = n - t
        weight = log((t + 0.5) / (toxic + 1)) - log((other + 0.5) / (total - toxic + 1))
        ratio = 0.0
        if 0 < share < 1:
            ratio = 2 * t * log(t / (n * share)) + (2 * other * log(other / (n * (1 - share))) if other else 0.0)
        if weight >= LEAST_WEIGHT and ratio >= LEAST_RATIO:
            found[mark] = weight
    return found


def train(docs: DataFrame, labels: DataFrame, keep: Column, bound: int = LABELLED_DOCUMENTS) -> Model:
    """Learns from at most ``bound`` labelled documents for which ``keep`` (over labels) holds, letters from all texts.

    Without labels, or with one class only, there are no marks and every score is the smoothed share of label 1.
    """
    with scratch(docs.sparkSession) as kept:
        sample = kept.staged(labelled_sample(docs, labels, "toxic", keep, bound), "labelled")
        letters = letter_model(texts_of(docs))

        def split(batches):
            words = Words(letters)
            for part in pieces(batches):
                texts = part.column(2).to_pylist()
                found = [sorted({word for token in tokens_of(text) for word in words[token]}) for text in texts]
                columns = [part.column(0), part.column(1), pa.array(found, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "words"])

        keyed = sample.select(F.xxhash64("doc_id", "_text").alias("id"), F.col("_label").cast("int").alias("label"), "_text")
        words = kept.staged(keyed.mapInArrow(split, "id bigint, label int, words array<string>"), "restored")
        marks = find_marks(words)

        def weigh(batches):
            tokens = Tokens(Words(letters), marks)
            for part in pieces_of_size(batches, 2, TEXT_AT_ONCE):
                rows = tokens.evidences(part.column(2).to_pylist())
                columns = [part.column(0), part.column(1), pa.array(rows, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "x"])

        rows = keyed.mapInArrow(weigh, "id bigint, label int, x array<double>").toArrow()
        order = np.argsort(rows["id"].to_numpy(), kind="stable")
        y = rows["label"].to_numpy().astype(float)[order]
        x = np.array(rows["x"].to_pylist(), float).reshape(-1, 3)[order]
        if not marks or y.min() == y.max():
            share = (y.sum() + 1) / (len(y) + 2)
            return Model(letters, {}, np.array([0.0, 0.0, 0.0, log(share / (1 - share))]))
        return Model(letters, marks, fit_logistic(x, y))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (doc_id, text).

    Documents whose id has remainder 1 (crc32 of its text, modulo 3) are held out of training. Null and empty texts
    score as texts without marks; repeated rows give repeated rows; a null id is not held out.
    """
    out = remainder(F.col("doc_id"), 3) == 1
    model = train(docs, labels, ~out)

    def run(batches):
        scores = model.scorer()
        for part in pieces_of_size(batches, 2, TEXT_AT_ONCE):
            column = pa.array(scores(part.column(2).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), column], ["doc_id", "held_out", "score"])

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = texts_of(docs, "doc_id", F.coalesce(out, F.lit(False)).alias("held_out"))
    rows = rows.mapInArrow(run, f"doc_id {key}, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))
