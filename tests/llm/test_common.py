from pyspark.sql import functions as F

from legtrail.llm.common import labelled_sample, smallest_hashes


def test_smallest_hashes_are_those_of_the_whole_table(spark):
    rows = spark.range(40_000).withColumnRenamed("id", "doc_id")
    wanted = {r[0] for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(300).collect()}
    assert {r[0] for r in smallest_hashes(rows, "doc_id", 300).collect()} == wanted
    assert smallest_hashes(rows, "doc_id", 50_000).count() == 40_000
    assert smallest_hashes(rows.limit(0), "doc_id", 5).collect() == []


def test_contradicting_and_null_labels_are_left_out(documents, labels_of):
    docs = documents([(i, f"text {i}") for i in range(6)] + [(None, "x")])
    labels = labels_of([(0, 1, 0), (1, 0, 0), (1, 1, 0), (2, None, 0), (3, 0, 0), (3, 0, 0), (None, 1, 0), (99, 1, 0)])
    rows = labelled_sample(docs, labels, "quality", F.lit(True), 10).collect()
    assert sorted((r.doc_id, r._text, r._label) for r in rows) == [(0, "text 0", 1), (3, "text 3", 0)]


def test_caches_are_bounded_by_characters(monkeypatch):
    from legtrail.llm import common, minhash

    monkeypatch.setattr(common, "KEPT_CHARACTERS", 10)
    hashes = minhash.WordHashes()
    first = [hashes[word] for word in ("abc", "defg", "hij")]
    assert len(hashes) == 3
    assert hashes["a" * 50] and len(hashes) == 1
    assert [hashes[word] for word in ("abc", "defg", "hij")] == first
