"""Language of documents: a byte network labels every position, and a document's probabilities are pooled.

The network runs over the words of a text (with the white space around them), so a word's positions get the same
labels wherever it stands: each task labels a word once and adds up its positions for each time it occurs.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from legtrail.llm.common import KEPT_CHARACTERS, pieces, remainder, smallest_hashes, texts_of
from legtrail.llm.gru import Network, label_positions, train

#: Documents that the network learns from, and words of each, at most: those with the smallest hashes.
DOCUMENTS = 6_000
WORDS_OF_EACH = 40
#: Longest byte sequence; longer words are cut and the network starts again at each cut.
LONGEST = 32
UNKNOWN = "und"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def sequences(word: str) -> list[bytes]:
    """The bytes of a word between spaces, cut to sequences."""
    data = b" " + word.encode() + b" "
    return [data[i : i + LONGEST] for i in range(0, len(data), LONGEST)]


def by_length(rows: list[tuple[bytes, int]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Byte matrices of sequences of one length, with the number that goes with each."""
    sorted_rows: dict[int, tuple[list, list]] = {}
    for data, number in rows:
        held = sorted_rows.setdefault(len(data), ([], []))
        held[0].append(data)
        held[1].append(number)
    return {
        n: (np.frombuffer(b"".join(d), np.uint8).reshape(-1, n), np.array(numbers, np.int64))
        for n, (d, numbers) in sorted_rows.items()
    }


class Labeller:
    """Adds up the label probabilities of all positions, word by word."""

    def __init__(self, net: Network):
        self.net, self.places, self.characters = net, {}, 0
        self.sums = np.zeros((0, len(net.labels)))

    def learn(self, words: set[str]) -> None:
        new = [word for word in words if word not in self.places]
        self.characters += sum(map(len, new))
        if self.characters > KEPT_CHARACTERS:
            self.places.clear()
            self.sums, new = self.sums[:0], list(words)
            self.characters = sum(map(len, new))
        start = len(self.places)
        self.places.update((word, start + i) for i, word in enumerate(new))
        sums = np.zeros((len(new), len(self.net.labels)))
        lettered = [i for i, word in enumerate(new) if any(map(str.isalpha, word))]
        groups = by_length([(data, i) for i in lettered for data in sequences(new[i])])
        for data, numbers in groups.values():
            for at in range(0, len(data), 4096):
                found = label_positions(self.net, data[at : at + 4096]).sum(axis=1)
                np.add.at(sums, numbers[at : at + 4096], found)
        self.sums = np.concatenate([self.sums, sums])

    def positions(self, text: str) -> list[tuple[str, list[str]]]:
        """Each word of a text with the label of each of its bytes (and of the spaces around it)."""
        found = []
        for word in words_of(text):
            rows = [label_positions(self.net, np.frombuffer(data, np.uint8)[None])[0] for data in sequences(word)]
            found.append((word, [self.net.labels[i] for i in np.concatenate(rows).argmax(axis=1)]))
        return found

    def pooled(self, texts: list[str]) -> list[tuple[str, float]]:
        """Label and its share of all positions' probability; unknown for a text without letters."""
        split = [words_of(text) for text in texts]
        wanted = set().union(*split)
        if not wanted <= self.places.keys():
            self.learn(wanted)
        found = []
        for words in split:
            at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
            total = self.sums[at].sum(axis=0)
            best = int(total.argmax()) if len(total) else 0
            known = total.sum() > 0
            found.append((self.net.labels[best], float(total[best] / total.sum())) if known else (UNKNOWN, 0.0))
        return found


def learn(docs: DataFrame, documents: int = DOCUMENTS) -> Network | None:
    """The network, from words of at most ``documents`` documents with an id, a language and remainder not 1.

    What comes to the driver is at most ``WORDS_OF_EACH`` words of each. None if there is nothing to learn from.
    """
    keep = (remainder(F.col("doc_id"), 3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    keys = smallest_hashes(docs.filter(keep).select("doc_id").distinct(), "doc_id", documents)
    chosen = texts_of(docs.filter(keep).join(F.broadcast(keys), "doc_id", "left_semi"), "lang")

    def run(batches):
        for part in pieces(batches):
            rows = []
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = {word[:200] for word in words_of(text) if any(map(str.isalpha, word))}
                ordered = sorted(words, key=lambda word: (xxhash.xxh64_intdigest(word), word))
                rows += [(lang, word) for word in ordered[:WORDS_OF_EACH]]
            columns = [pa.array([row[i] for row in rows], pa.string()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word"])

    found = chosen.mapInArrow(run, "lang string, word string").toArrow()
    rows = sorted(zip(found["lang"].to_pylist(), found["word"].to_pylist()))
    labels = sorted({lang for lang, _ in rows})
    if not labels:
        return None
    numbers = {lang: i for i, lang in enumerate(labels)}
    return train(by_length([(data, numbers[lang]) for lang, word in rows for data in sequences(word)]), labels)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs`` (doc_id, text, lang).

    Documents whose id has remainder 1 (crc32 of its text, modulo 3) are held out of training. ``lang_pred`` is ``und``
    and the score 0 for a null text, a text without letters, and if there is no language to learn. Repeated rows give
    repeated rows; a null id is not held out and not learned from.
    """
    net = learn(docs)

    def run(batches):
        labeller = Labeller(net) if net else None
        for part in pieces(batches):
            texts = part.column(2).to_pylist()
            found = labeller.pooled(texts) if labeller else [(UNKNOWN, 0.0)] * len(texts)
            columns = [part.column(0), part.column(1)]
            columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    key = docs.schema["doc_id"].dataType.simpleString()
    out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return texts_of(docs, "doc_id", out).mapInArrow(run, f"doc_id {key}, held_out boolean, lang_pred string, score double")
