"""The split CSV reader against Python's own, at block sizes that cut cells, quotes and line ends."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tabwright.sources.records import records
from tabwright.sources.tables import read_csv

SCHEMA = "a string, b string, c string"


@pytest.fixture
def blocks(spark):
    """Sets the size of the blocks that files are split into."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def sized(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")
        spark.conf.set(names[2], "1")

    yield sized
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def written(rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end, quoting=quoting).writerows([("a", "b", "c"), *rows])
    return out.getvalue()


def random_rows(n, seed):
    draw = random.Random(seed)
    pieces = ["x", "yy", "é", "\n", "\n\n", '"', ",", " ", "long " * 30, "\r\n", '""', "1"]
    return [tuple("k" + "".join(draw.choice(pieces) for _ in range(draw.randint(0, 6))) + "e" for _ in range(3)) for _ in range(n)]


@pytest.mark.parametrize("size", [7, 64, 500, 10_000_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_as_read_in_one_piece(spark, tmp_path, blocks, size, end):
    rows = random_rows(60, size)
    for i, part in enumerate((rows[:40], rows[40:], [])):
        (tmp_path / f"{i}.csv").write_text(written(part, end, csv.QUOTE_ALL if i else csv.QUOTE_MINIMAL), newline="")
    blocks(size)
    table = read_csv(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, table.collect())) == sorted(rows)
    if size == 64:
        assert spark.read.text(str(tmp_path), lineSep="\n").rdd.getNumPartitions() > 20


def test_cell_over_many_blocks(spark, tmp_path, blocks):
    text = "\n".join(f"line {i}" for i in range(400))
    (tmp_path / "t.csv").write_text(written([("1", text, "x"), ("2", "plain", "y")]), newline="")
    blocks(100)
    assert sorted(map(tuple, read_csv(spark, str(tmp_path), SCHEMA).collect())) == [("1", text, "x"), ("2", "plain", "y")]


def test_last_line_without_end_and_blank_lines(spark, tmp_path, blocks):
    (tmp_path / "t.csv").write_text('a,b,c\n\n1,2,3\n   \n4,"\n",6', newline="")
    blocks(5)
    assert sorted(map(tuple, read_csv(spark, str(tmp_path), SCHEMA).collect())) == [("1", "2", "3"), ("4", "\n", "6")]


def test_header_with_a_line_break(spark, tmp_path, blocks):
    (tmp_path / "t.csv").write_text('a,"b\nb",c\n1,2,3\n', newline="")
    blocks(4)
    table = read_csv(spark, str(tmp_path))
    assert table.columns == ["a", "b\nb", "c"] and [tuple(r) for r in table.collect()] == [(1, 2, 3)]


@pytest.mark.parametrize("line", ["2,c", "3,d,e,f", '"3,d,e"'])
@pytest.mark.parametrize("multiline", [True, False])
def test_rows_of_wrong_width_raise(spark, tmp_path, line, multiline):
    (tmp_path / "t.csv").write_text(f"a,b,c\n1,2,3\n{line}\n", newline="")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_csv(spark, str(tmp_path), SCHEMA, multiline=multiline).select("a").collect()


def test_open_quote_raises(spark, tmp_path, blocks):
    (tmp_path / "t.csv").write_text('a,b,c\n1,"2,3\n4,5,6\n7,8,9\n', newline="")
    for size in (6, 1_000_000):
        blocks(size)
        with pytest.raises(ValueError, match="not closed"):
            read_csv(spark, str(tmp_path), SCHEMA)


def test_nothing_but_a_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n")
    assert read_csv(spark, str(tmp_path), SCHEMA).collect() == []


def test_only_pieces_of_records_are_shuffled(spark, tmp_path, blocks):
    (tmp_path / "t.csv").write_text(written([(str(i), "two\nlines" if i % 10 == 0 else "x", "y") for i in range(2_000)]), newline="")
    blocks(2_000)
    plan = records(spark, str(tmp_path))
    n_blocks = spark.read.text(str(tmp_path)).select(F.col("_metadata.file_block_start")).distinct().count()
    assert plan.count() == 2_001 and n_blocks > 5
