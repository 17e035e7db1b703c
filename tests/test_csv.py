from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from legtrail import schemas
from legtrail.plans import consolidate
from legtrail.sources import csv_files

FULL = (
    "ICAO24,call_sign,departure_time,departure_date,arrival_time,arrival_date,"
    "departure_airport_ICAO,destination_airport_ICAO,id"
)
SWAPPED = FULL.replace("destination_airport_ICAO,id", "id,destination_airport_ICAO")
LACKING = FULL.replace("destination_airport_ICAO,", "")


def flight(aircraft, *tail, day="2022-10-26"):
    return ",".join([aircraft, "CALL1", f"{day}T07:11:05Z", day, f"{day}T08:40:50Z", day, *tail])


@pytest.fixture
def daily(tmp_path):
    def write(name, *lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")

    write("bl_dep_2022_10_25.csv", FULL, flight("a1", "HOME", "AWAY", "k1"), flight("a2", "HOME", "NA", "k2"))
    write("bl_dep_2022_10_26.csv", SWAPPED, flight("a3", "HOME", "k3", "AWAY"))
    write("bl_dep_2022_10_29.csv", LACKING, flight("a4", "HOME", "k4"))
    write("bl_arr_2022_10_26.csv", FULL, flight("a5", "NA", "HOME", "k5"))
    write("bl_dep_SV_2022_10_26.csv", ",".join(schemas.STATE_VECTORS.names),
          "a3,NA,NA,1650000120,NA,40.1234567890125,FALSE,NA,k3,2022-10-26,2022-10-26",
          "a3,6.5,46.7,1650000300,1000.5,60.25,TRUE,NA,k3,2022-10-26,2022-10-26")
    write("bl_dep_all.csv", FULL, flight("zz", "HOME", "AWAY", "old"))
    return str(tmp_path)


def test_union_by_name_over_three_headers(spark, daily, rows):
    df = csv_files.scan(spark, daily, schemas.FLIGHTS, r"^bl_dep_\d+")
    assert df.columns == schemas.FLIGHTS.names
    assert rows(df, "ICAO24", "id", "departure_airport_ICAO", "destination_airport_ICAO") == [
        ("a1", "k1", "HOME", "AWAY"),
        ("a2", "k2", "HOME", None),
        ("a3", "k3", "HOME", "AWAY"),
        ("a4", "k4", "HOME", None),
    ]
    first = df.filter("id = 'k1'").first()
    assert first.departure_time == datetime(2022, 10, 26, 7, 11, 5)
    assert first.departure_date == date(2022, 10, 26)


def test_name_pattern_leaves_out_points_and_consolidated(spark, daily, rows):
    got = rows(csv_files.scan(spark, daily, schemas.FLIGHTS, r"^bl_arr_\d+"), "id")
    assert got == [("k5",)]


def test_points_keep_rows_without_position(spark, daily, rows):
    df = consolidate.daily_files(spark, daily, "bl_dep_SV", date(2022, 11, 1))
    assert rows(df, "requested_time", "longitude", "velocity", "special_purpose_indicator", "origin_country") == [
        (1650000120.0, None, 40.1234567890125, False, None),
        (1650000300.0, 6.5, 60.25, True, None),
    ]
    assert consolidate.daily_files(spark, daily, "bl_dep_SV", date(2023, 4, 26)).isEmpty()


def test_wrong_header_fails_and_is_not_read_by_position(spark, daily):
    with pytest.raises(Exception, match="(?i)header"):
        csv_files.scan_same_header(spark, daily, schemas.FLIGHTS, r"^bl_dep_2022_10_26").collect()


def test_file_without_header_is_an_error(spark, tmp_path):
    (tmp_path / "bl_dep_2022_10_25.csv").write_text(flight("a1", "HOME", "AWAY", "k1") + "\n")
    with pytest.raises(ValueError, match="no header"):
        csv_files.scan(spark, str(tmp_path), schemas.FLIGHTS)


def test_empty_file_and_header_only(spark, tmp_path):
    (tmp_path / "bl_dep_2022_10_25.csv").write_text("")
    (tmp_path / "bl_dep_2022_10_26.csv").write_text(FULL + "\n")
    df = csv_files.scan(spark, str(tmp_path), schemas.FLIGHTS)
    assert df.columns == schemas.FLIGHTS.names and df.isEmpty()


def test_extra_column_comes_last_as_text(spark, tmp_path, rows):
    (tmp_path / "bl_dep_2022_10_25.csv").write_text(FULL + ",note\n" + flight("a1", "HOME", "AWAY", "k1", "x") + "\n")
    (tmp_path / "bl_dep_2022_10_26.csv").write_text(FULL + "\n" + flight("a2", "HOME", "AWAY", "k2") + "\n")
    df = csv_files.scan(spark, str(tmp_path), schemas.FLIGHTS)
    assert df.columns == [*schemas.FLIGHTS.names, "note"]
    assert rows(df, "id", "note") == [("k1", "x"), ("k2", None)]


def test_quoted_headers_are_found(spark, tmp_path, rows):
    header = ",".join(f'"{name}"' for name in LACKING.split(","))
    (tmp_path / "bl_dep_2022_10_25.csv").write_text("﻿" + header + "\r\n" + flight("a1", "HOME", "k1") + "\r\n")
    assert rows(csv_files.scan(spark, str(tmp_path), schemas.FLIGHTS), "ICAO24", "id") == [("a1", "k1")]


def test_csv_text_format(spark, tmp_path):
    df = spark.sql(
        "SELECT timestamp_ntz'2022-10-26 07:11:05' AS t, date'2022-10-26' AS d, 1650000120D AS whole,"
        " 40.1234567890125D AS part, true AS yes, false AS no, cast(null AS double) AS nothing,"
        " ' padded' AS s"
    )
    csv_files.write_csv(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*.csv")))
    assert text.splitlines()[1] == "2022-10-26T07:11:05Z,2022-10-26,1650000120,40.1234567890125,TRUE,FALSE,NA, padded"


def test_round_trip_by_folder(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 'say "x", y'), ("b", None)], "k string, v string")
    csv_files.write_csv(df, str(tmp_path / "out"), F.concat(F.lit("name_"), "k"))
    back = csv_files.scan(spark, str(tmp_path / "out"), df.schema, "^name_a", part="folder")
    assert rows(back) == [("a", 'say "x", y')]


def test_line_breaks_quotes_and_header_names_in_texts(spark, tmp_path, rows):
    texts = ["a\nb", 'say "x"\n\n"y"', "ICAO24", "ICAO24,k\nICAO24", "plain"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "ICAO24 string, k int")
    csv_files.write_csv(df, str(tmp_path / "out"))
    assert rows(csv_files.scan(spark, str(tmp_path / "out"), df.schema), "k", "ICAO24") == list(enumerate(texts))
