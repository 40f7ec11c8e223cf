"""Records of quoted CSV found by the prefix scan, against the built-in reader that takes a whole file per task."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from stratum.sources import records
from stratum.sources.csv import read_csv_named, read_csv_positional

COLUMNS = ("a", "b", "c")
FIELDS = ["x", "", '"q, ""u"" z"', '"line\nbreak"', '"a\n\n,b"', '""', '"""x"""', '5" disk', '"ab"cd', ' "sp"', "é"]


def built_in(spark, path):
    df = (spark.read.schema("a string, b string, c string, _corrupt_record string")
          .options(header=True, multiLine=True, quote='"', escape='"', mode="PERMISSIVE").csv(path))
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def scanned(spark, path):
    def parse(record):
        return F.from_csv(record, "a string, b string, c string, _corrupt_record string",
                          {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    df = records.csv_records(spark, path, parse, os.path.join(tempfile.mkdtemp(prefix="stratum-test-"), "out"))
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def some_file(rnd, path, rows, eol="\n", open_end=False):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(f'h1,"h{eol}2",h3{eol}')
        for _ in range(rows):
            line = ",".join(rnd.choice(FIELDS) for _ in range(rnd.choice([3, 3, 3, 3, 2, 4])))
            f.write(line.replace("\n", eol) + eol + (eol if rnd.random() < 0.05 else ""))
        if open_end:
            f.write("x,\"never closed\ny,z")


@pytest.fixture()
def small_splits(spark, monkeypatch):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def use(size, lines):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        monkeypatch.setattr(records, "CHUNK_LINES", lines)
    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("seed,size,lines", [(1, 300, 1), (2, 500, 4), (3, 10**8, 16), (4, 2000, 1 << 15)])
def test_same_rows_and_rejects_as_the_built_in_reader(spark, scratch, small_splits, seed, size, lines):
    rnd = random.Random(seed)
    for i in range(3):
        some_file(rnd, os.path.join(scratch, f"f{i}.csv"), rnd.choice([0, 5, 60]), open_end=i == 2)
    small_splits(size, lines)
    assert scanned(spark, scratch) == built_in(spark, scratch)


def test_dos_line_ends_and_empty_files(spark, scratch, small_splits):
    rnd = random.Random(9)
    some_file(rnd, os.path.join(scratch, "dos.csv"), 40, eol="\r\n")
    open(os.path.join(scratch, "empty.csv"), "w").close()
    with open(os.path.join(scratch, "header.csv"), "w") as f:
        f.write("\n\nh1,h2,h3\n")
    small_splits(400, 2)
    unified = [r.replace("\\r\\n", "\\n") for r in built_in(spark, scratch)]
    assert scanned(spark, scratch) == sorted(unified)


def test_a_large_record_over_many_splits(spark, scratch, small_splits):
    long = "\n".join(f"{i}, said" for i in range(500))
    with open(os.path.join(scratch, "l.csv"), "w") as f:
        f.write(f'a,b,c\n1,"{long}",2\n3,4,5\n')
    small_splits(256, 8)
    good, rejects = read_csv_positional(spark, scratch, COLUMNS)
    assert sorted(map(tuple, good.collect())) == [("1", long, "2"), ("3", "4", "5")] and rejects.count() == 0


def test_scan_reads_one_file_in_many_tasks(spark, scratch, small_splits):
    with open(os.path.join(scratch, "big.csv"), "w") as f:
        f.write("a,b,c\n" + '"x, ""y""",2,"two\nlines"\n' * 5000)
    small_splits(20_000, 256)
    df = records.csv_lines(spark, os.path.join(scratch, "big.csv"))
    assert records.long_records(df).count() == 5000 and df.where("alone").count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Python" not in plan
    assert spark.read.text(os.path.join(scratch, "big.csv")).rdd.getNumPartitions() > 5


def test_named_scan_takes_names_from_the_header(spark, scratch):
    with open(os.path.join(scratch, "n.csv"), "w", encoding="latin-1") as f:
        f.write('id,"full name",x\n1,"Café\nNoir",y\n2\n3,a,b,c\n')
    got = read_csv_named(spark, scratch, encoding="ISO-8859-1")
    assert got.columns == ["id", "full name", "x"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [
        ("1", "Café\nNoir", "y"), ("2", None, None), ("3", "a", "b")]))


def test_lines_without_open_quotes_are_not_shuffled(spark, scratch):
    path = os.path.join(scratch, "plain.csv")
    with open(path, "w") as f:
        f.write("a,b,c\n" + '"x, ""y""",2,z\n' * 3000)
    df = records.csv_lines(spark, path)
    assert df.count() == 3000 and df.where("not alone").count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" not in plan and "SortMergeJoin" not in plan


def test_records_are_written_without_a_sort(spark, scratch):
    path = os.path.join(scratch, "in.csv")
    with open(path, "w") as f:
        f.write('a,b,c\n1,2,3\n"x\ny",5,6\n')
    out = os.path.join(scratch, "out")
    good, rejects = read_csv_positional(spark, path, COLUMNS, stage_to=out)
    assert sorted(map(tuple, good.collect())) == [("1", "2", "3"), ("x\ny", "5", "6")] and rejects.count() == 0
    assert not [f for f in os.listdir(out) if f.startswith("several=")]
