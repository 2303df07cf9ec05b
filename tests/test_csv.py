"""CSV split inside of records against Spark's reader of whole files."""

import csv
import random

import pytest

from corpusgauge.sources import tables
from corpusgauge.sources.csv_records import csv_records

SCHEMA = "id int, text string, note string"


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(["id", "text", "note"])
        out.writerows(rows)


def values(draw):
    return "".join(draw.choices(["a", "é ", ",", '"', '""', "\n", "\n\n", "x" * 30, "plain words "], k=draw.randrange(9)))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_reader_of_whole_files(spark, tmp_path, end):
    draw = random.Random(3)
    for at in range(3):
        rows = [(n, values(draw), draw.choice(["", "y", values(draw)])) for n in range(400)]
        rows[100] = (100, "one, long\n" * 3000 + '"', "")  # longer than several splits
        write(tmp_path / f"part{at}.csv", rows, end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert csv_records(spark, str(tmp_path)).rdd.getNumPartitions() > 10
        got = tables.read_csv(spark, str(tmp_path), SCHEMA).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    wanted = tables.read_csv_whole(spark, str(tmp_path), SCHEMA).collect()
    assert len(got) == 1200
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


def test_empty_file_and_header_alone(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    write(tmp_path / "head.csv", [])
    assert tables.read_csv(spark, str(tmp_path), SCHEMA).collect() == []
