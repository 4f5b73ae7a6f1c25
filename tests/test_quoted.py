import random

import pytest
from pyspark.sql import types as T

from inkgrain.operators.rowid import dense_row_id
from inkgrain.sources import csv

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("TEXT", T.StringType()), T.StructField("LABEL", T.IntegerType())])
CELLS = ["plain", "two\nlines", 'say "hi", ok', '"', '""', ",", "\n", "\n\n\n", " spaces ", "x" * 300, ("line\n" * 80), 'q"\n"' * 40, "Straße \U0001f600\n日本"]


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def write(folder, name, rows, end="\n", last=True):
    folder.mkdir(exist_ok=True)
    lines = ["id,TEXT,LABEL"] + [f"{i},{'' if t is None else quoted(t)},{i % 3}" for i, t in rows]
    (folder / name).write_bytes((end.join(lines) + (end if last else "")).encode())


def read(spark, path, size=None, **how):
    """The rows read in parts of ``size`` bytes, in the order of their places."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if size:
        spark.conf.set(key, size)
    try:
        rows = csv.read_labelled(spark, str(path), id_col="id", id_type=T.LongType(), split=True, place_col="at", **how)
        assert not size or rows.rdd.getNumPartitions() > 1
        return [(r["id"], r["TEXT"], r["LABEL"]) for r in rows.orderBy("at").collect()]
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("size", [40, 97, 1000])
def test_parts_of_any_size_give_the_rows_of_one_task(spark, tmp_path, size):
    rng = random.Random(size)
    texts = CELLS + ["".join(rng.choice('ab ",\n') for _ in range(rng.randrange(60))) for _ in range(40)] + [None, ""]
    rng.shuffle(texts)
    write(tmp_path / "t", "a.csv", list(enumerate(texts)))
    one = csv.read_labelled(spark, str(tmp_path / "t"), id_col="id", id_type=T.LongType())
    got = read(spark, tmp_path / "t", size)
    assert [r[0] for r in got] == list(range(len(texts)))
    assert got == sorted(map(tuple, one.select("id", "TEXT", "LABEL").collect()))
    assert [t or None for _, t, _ in got] == [t or None for t in texts]


def test_line_ends_empty_lines_and_several_files(spark, tmp_path):
    write(tmp_path / "t", "a.csv", [(0, "a\r\nb"), (1, "c")], end="\r\n")
    write(tmp_path / "t", "b.csv", [(2, "d\ne"), (3, "f" * 200)], end="\n\n", last=False)
    write(tmp_path / "t", "c.csv", [])
    for size in (None, 30):
        assert read(spark, tmp_path / "t", size) == [(0, "a\r\nb", 0), (1, "c", 1), (2, "d\ne", 2), (3, "f" * 200, 0)]


def test_a_record_over_many_parts(spark, tmp_path):
    text = "".join(f"line {i}, \"quoted\"\n" for i in range(500))
    write(tmp_path / "t", "a.csv", [(0, "x"), (1, text), (2, text), (3, "y")])
    assert read(spark, tmp_path / "t", 200) == [(0, "x", 0), (1, text, 1), (2, text, 2), (3, "y", 0)]


@pytest.mark.parametrize("line", ['7,5" pipe,1', '7,"never closed,1', '7,"a"b,1', "7,x", "seven,x,1"])
def test_bad_records_stop_the_read(spark, tmp_path, line):
    write(tmp_path / "t", "a.csv", [(0, "x\ny"), (1, "z")])
    with open(tmp_path / "t" / "a.csv", "a") as f:
        f.write(line + "\n" + "8,ok,1\n" * 20)
    for size in (None, 40):
        with pytest.raises(Exception, match="(?i)malformed"):
            read(spark, tmp_path / "t", size)


def test_other_headers_stop_the_read(spark, tmp_path):
    write(tmp_path / "t", "a.csv", [(0, "x")])
    (tmp_path / "t" / "b.csv").write_text("id,LABEL,TEXT\n1,1,y\n")
    with pytest.raises(Exception, match="another header"):
        read(spark, tmp_path / "t")


def test_ids_follow_files_and_lines(spark, tmp_path):
    write(tmp_path / "t", "b.csv", [(i, f"b\n{i}") for i in range(60)])
    write(tmp_path / "t", "a.csv", [(100, "first")])
    rows = csv.read_labelled(spark, str(tmp_path / "t"), id_col="id", id_type=T.LongType(), split=True, place_col="at")
    got = dense_row_id(rows, "n", order_by="at").orderBy("n").collect()
    assert [r["id"] for r in got] == [100, *range(60)] and [r["n"] for r in got] == list(range(61))
