"""Large CSV files by ranges: equal to the read in one task, whatever the quoted texts hold."""

import csv
import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from legtrail.sources import csv_files, csv_ranges

KIND = "n int, s string, t timestamp_ntz, z string"
PIECES = ["a", ",", '"', "\n", "\r\n", "\n\n", "é漢", " ", "n,s,t,z\n", '""', "plain text", "\n,\n", "'"]


def written(path, seed, n, header="n,s,t,z", end="\n"):
    draw = random.Random(seed)
    out = io.StringIO()
    out.write(header + end)
    writer = csv.writer(out, lineterminator=end)
    for i in range(n):
        text = "".join(draw.choice(PIECES) for _ in range(draw.choice([0, 1, 3, 9])))
        if draw.random() < 0.002:
            text = "\n".join(["x" * 50] * 400)  # longer than a range
        writer.writerow([i, text.strip(), "2024-01-01T00:00:00Z", draw.choice(["NA", "q", "line\nbreak"])])
        if draw.random() < 0.02:
            out.write(end)
    path.write_text(out.getvalue(), newline="")
    return path


def whole(spark, path, schema):
    return spark.read.schema(schema).options(**csv_files.READ_OPTIONS).csv(str(path))


@pytest.fixture
def cut(spark):
    """A session that cuts files every 4 KB."""
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    apart.conf.set("spark.sql.files.openCostInBytes", "4k")
    return apart


def same(got, expected):
    order = lambda df: sorted(map(str, map(tuple, df.collect())))
    assert order(got) == order(expected)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranges_equal_the_read_in_one_task(cut, tmp_path, seed, end):
    files = [written(tmp_path / f"f{i}.csv", 10 * seed + i, 900, end=end) for i in range(3)]
    schema = whole(cut, files[0], KIND).schema
    lines = csv_ranges._lines(cut, [str(f) for f in files])
    assert lines.rdd.getNumPartitions() > 10
    blocks = csv_ranges._blocks(lines)
    assert blocks.filter("n_before % 2 = 1").count() > 0, "some ranges begin inside a record"
    got = csv_files.scan_same_header(cut, str(tmp_path), schema)
    assert got.count() == 2700
    same(got, whole(cut, tmp_path, schema))
    same(csv_files.scan(cut, str(tmp_path), schema), whole(cut, tmp_path, schema))


def test_files_without_line_breaks_in_quotes_are_cut_by_the_reader(cut, tmp_path, plan):
    (tmp_path / "f.csv").write_text("n,s\n" + "".join(f'{i},"a, ""b"" {i}"\n' for i in range(3000)))
    schema = whole(cut, tmp_path, "n int, s string").schema
    got = csv_files.scan_same_header(cut, str(tmp_path), schema)
    assert got.rdd.getNumPartitions() > 5 and "Window" not in plan(got)
    same(got, whole(cut, tmp_path, schema))


def test_what_cannot_be_cut_is_read_whole(cut, tmp_path):
    """A compressed file, and one with a quote that is never closed."""
    packed, odd = tmp_path / "packed", tmp_path / "odd"
    packed.mkdir(), odd.mkdir()
    text = written(tmp_path / "f.csv", 5, 2000).read_bytes()
    with gzip.open(packed / "f.csv.gz", "wb") as out:
        out.write(text)
    (odd / "f.csv").write_bytes(text + b'2000,"open\n')
    schema = whole(cut, packed, KIND).schema
    for folder in (packed, odd):
        same(csv_files.scan_same_header(cut, str(folder), schema), whole(cut, folder, schema))


def test_small_and_large_files_with_other_headers(cut, tmp_path):
    written(tmp_path / "a.csv", 6, 500)
    written(tmp_path / "b.csv", 7, 20)
    (tmp_path / "c.csv").write_text("z,n\n" + "".join(f'"x\n{i}",{i}\n' for i in range(1000)))
    schema = whole(cut, tmp_path / "a.csv", KIND).schema
    got = csv_files.scan(cut, str(tmp_path), schema)
    assert got.count() == 1520 and got.filter("s is null and t is null and z like 'x%'").count() == 1000
    with pytest.raises(ValueError, match="another header"):
        csv_files.scan_same_header(cut, str(tmp_path), schema)


def test_a_large_file_without_header_is_an_error(cut, tmp_path):
    (tmp_path / "f.csv").write_text("".join(f"{i},b\n" for i in range(3000)))
    schema = whole(cut, tmp_path, "n int, s string").schema
    with pytest.raises(ValueError, match="no header"):
        csv_files.scan(cut, str(tmp_path), schema)


def test_headers_are_read_without_the_text(spark, tmp_path):
    """Bytes read, as the file system counts them, for a file of 60 MB in three splits and ten of 6 MB."""
    line = "1,some text of a row,2024-01-01T00:00:00Z,q\n"
    (tmp_path / "large.csv").write_text("n,s,t,z\n" + line * (60_000_000 // len(line)))
    for i in range(10):
        (tmp_path / f"f{i}.csv").write_text("s,n\n" + line * (6_000_000 // len(line)))
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem

    def bytes_read():
        return sum(s.getBytesRead() for s in files.getAllStatistics())

    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", "20m")
    before = bytes_read()
    found = csv_files.file_headers(apart, str(tmp_path), "n").collect()
    used = bytes_read() - before
    assert {(r.file.rsplit("/", 1)[-1], tuple(r.header)) for r in found} == {
        ("large.csv", ("n", "s", "t", "z")), *[(f"f{i}.csv", ("s", "n")) for i in range(10)],
    }
    assert 0 < used < 0.01 * sum(r["size"] for r in found) + 11 * 65536
    print("bytes read for headers:", used)


@pytest.mark.parametrize("text, size", [("128MB", 1 << 27), ("134217728b", 1 << 27), ("16m", 1 << 24), ("1000", 1000), ("1g", 1 << 30)])
def test_split_size(spark, text, size):
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", text)
    assert csv_files.split_size(apart) == size


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_blocks_are_put_in_order_in_parts(cut, spark, tmp_path, monkeypatch, end):
    """Blocks of many lines are cut in parts, alike in both passes, whatever other files are read with them."""
    monkeypatch.setattr(csv_ranges, "LINES_PER_PART", 5)
    for i in range(3):
        written(tmp_path / f"f{i}.csv", 70 + i, 300, end=end)
    (tmp_path / "plain.csv").write_text(f"n,s,t,z{end}" + f"1,a,2024-01-01T00:00:00Z,q{end}" * 5000, newline="")
    files = [str(tmp_path / name) for name in ("f0.csv", "f1.csv", "f2.csv", "plain.csv")]
    schema = whole(cut, files[0], KIND).schema
    blocks = csv_ranges._blocks(csv_ranges._lines(cut, files))
    assert blocks.groupBy("file", "block").count().agg(F.max("count")).first()[0] > 10
    assert blocks.filter("n_before % 2 = 1 and part > 0").count() > 0, "some parts begin inside a record"
    got = csv_files.scan_same_header(cut, str(tmp_path), schema)
    same(got, whole(cut, tmp_path, schema))
    # in one block each
    same(csv_files.scan_same_header(spark, str(tmp_path), schema, split_over=0), whole(cut, tmp_path, schema))
