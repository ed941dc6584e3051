"""CSV files that many tasks read at once, against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import types as T

from basketwise.sources import readers

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "Text, quoted", "Summary")])


def _cell(text):
    return '"' + text.replace('"', '""') + '"' if set(text) & set('",\r\n') else text


def _file(rows, end):
    header = [f.name for f in SCHEMA]
    return "".join(",".join(map(_cell, r)) + end for r in [header, *rows])


def _rows(seed, n):
    rng = random.Random(seed)
    parts = ["plain", '"', '""', ",", "\n", "\r\n", "\n\n", "é", " ", 'a "b" c', "\n\"\n"]
    return [(str(i), "x" + "".join(rng.choices(parts, k=rng.randint(0, 9))) + "y", rng.choice(["s", "two\nlines", 'q"', "z"])) for i in range(n)]


def _whole(spark, path):
    """The same by one task per file."""
    reader = spark.read.schema(SCHEMA).options(header=True, multiLine=True, quote='"', escape='"', enforceSchema=False, mode="FAILFAST")
    return sorted(map(tuple, reader.csv(path).collect()))


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_many_tasks_read_one_file_like_one(spark, tmp_path, small_splits, end, seed):
    rows = _rows(seed, 120)
    rows[60] = ("60", "long" + "\n".join(["line with , and \"\" quotes"] * 20), "s")  # fills several splits
    path = tmp_path / "a.csv"
    path.write_bytes(_file(rows, end).encode())
    got = readers.read_csv(spark, str(path), SCHEMA)
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 20
    found = sorted(map(tuple, got.collect()))
    assert found == sorted(rows)
    # that reader takes the file's line end for a line feed inside cells, too
    assert sorted(tuple(c.replace(end, "\n") for c in r) for r in found) == _whole(spark, str(path))


def test_several_files_and_no_end_of_line(spark, tmp_path, small_splits):
    for i in range(3):
        text = _file(_rows(i, 30 * i), "\n")
        (tmp_path / f"part-{i}.csv").write_bytes((text if i else text + "\n").encode().removesuffix(b"\n"))
    got = sorted(map(tuple, readers.read_csv(spark, str(tmp_path), SCHEMA).collect()))
    assert got == sorted(_rows(1, 30) + _rows(2, 60))


def test_empty_file_and_missing_texts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text('id,"Text, quoted",Summary\n1,NA,""\n\n2,,x\n')
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path), SCHEMA).collect())) == [("1", None, None), ("2", None, "x")]


@pytest.mark.parametrize("text", ['id,other,Summary\n1,a,b\n', 'id,"Text, quoted",Summary\n1,a\n'])
def test_wrong_header_or_number_of_cells_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Exception, match="header differs|MALFORMED"):
        readers.read_csv(spark, str(tmp_path), SCHEMA).collect()
