"""CSV with line breaks inside fields, read in parallel."""

import os
import random

import pytest

from demandcast.sources import files as io
from demandcast.sources import quoted_csv as Q

NAMES = ["id", "note", "size"]


def field(rng):
    """A field as text, with breaks, doubled quotes, commas and long runs."""
    kinds = ["plain", "two\nlines", 'he said ""so""', "a,b", "", "\n", 'x""\n""y', "z" * rng.randrange(1, 90), "ü\nß", "\n\n\n" + "q" * 60, "r" * 70 + "\n" + "s" * 50 + "\nt"]
    return rng.choice(kinds)


def write(path, rows, end="\n", last_end=True):
    text = end.join([",".join(NAMES)] + [f'{i},"{note}",{size}' for i, note, size in rows])
    with open(path, "w", newline="") as fh:
        fh.write(text + (end if last_end else ""))
    return path


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(str(i), field(rng), str(rng.randrange(100))) for i in range(n)]


def multi_line(spark, path):
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("mode", "FAILFAST")
    return sorted(reader.csv(path).collect(), key=repr)


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_multi_line_reader_over_many_splits(spark, tmp_dir, small_splits, end):
    folder = os.path.join(tmp_dir, "drops")
    os.makedirs(folder)
    write(os.path.join(folder, "a.csv"), rows_of(1, 150), end)
    write(os.path.join(folder, "b.csv"), rows_of(2, 40), end, last_end=False)
    found = Q.read_quoted(spark, folder, NAMES, io.DIALECT)
    assert Q.lines_of(spark, folder).rdd.getNumPartitions() > 10
    inside = Q.inside_at_start(Q.ranges_of(Q.lines_of(spark, folder))).filter("inside").count()
    assert inside > 2  # splits that begin inside a field
    want = multi_line(spark, folder)
    assert len(want) == 190 and sorted(found.collect(), key=repr) == want
    assert sorted(io.read_csv(spark, folder).collect(), key=repr) == want


def test_shuffled_ranges_give_the_same(spark, tmp_dir, small_splits):
    """Beyond the broadcast limit the lines are put in order by a shuffle."""
    path = write(os.path.join(tmp_dir, "a.csv"), rows_of(3, 120))
    spark.conf.set("spark.demandcast.broadcastMaxRows", "-1")
    try:
        found = sorted(Q.read_quoted(spark, path, NAMES, io.DIALECT).collect(), key=repr)
    finally:
        spark.conf.unset("spark.demandcast.broadcastMaxRows")
    assert found == multi_line(spark, path)


def test_a_field_over_several_splits(spark, tmp_dir, small_splits):
    long = "\n".join("line %d" % i for i in range(400))
    path = write(os.path.join(tmp_dir, "a.csv"), [("1", "x", "2"), ("2", long, "3"), ("3", "y", "4")])
    found = sorted(tuple(r) for r in io.read_csv(spark, path).collect())
    assert found == [("1", "x", "2"), ("2", long, "3"), ("3", "y", "4")]


def test_plain_files_use_the_plain_reader(spark, tmp_dir, small_splits):
    path = write(os.path.join(tmp_dir, "a.csv"), [(str(i), 'a "", b', "7") for i in range(100)])
    assert Q.read_quoted(spark, path, NAMES, io.DIALECT) is None
    df = io.read_csv(spark, path)
    assert df.rdd.getNumPartitions() > 5 and df.count() == 100 and set(r.note for r in df.collect()) == {'a ", b'}


def test_malformed_files_fail(spark, tmp_dir):
    path = os.path.join(tmp_dir, "open.csv")
    with open(path, "w") as fh:
        fh.write('id,note,size\n1,"never closed,2\n3,x,4\n')
    with pytest.raises(Exception, match="never closes"):
        io.read_csv(spark, path).collect()
    folder = os.path.join(tmp_dir, "two")
    os.makedirs(folder)
    write(os.path.join(folder, "a.csv"), [("1", "x\ny", "2")])
    with open(os.path.join(folder, "b.csv"), "w") as fh:
        fh.write('note,id,size\n"a\nb",1,2\n')
    with pytest.raises(Exception, match="header"):
        io.read_csv(spark, folder).collect()
    path = os.path.join(tmp_dir, "short.csv")
    with open(path, "w") as fh:
        fh.write('id,note,size\n1,"a\nb"\n')
    with pytest.raises(Exception):
        io.read_csv(spark, path).collect()


def test_types_nulls_and_blank_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "a.csv")
    with open(path, "w") as fh:
        fh.write('﻿id,note,size\n\n1,"a\nb",\n  \n2,,5\n3,"",6\n')
    schema = "id long, note string, size int"
    from pyspark.sql.types import StructType

    got = sorted(tuple(r) for r in io.read_csv(spark, path, StructType.fromDDL(schema)).collect())
    assert got == [(1, "a\nb", None), (2, None, 5), (3, None, 6)]
