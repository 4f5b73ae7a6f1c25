import random
import struct

import numpy as np
import pytest

from inkgrain.sources.vectors import read_vectors
from inkgrain.sources.wordbin import chains, write_word2vec


def file_bytes(rows, width, feed=b"\n", words=None):
    body = b"".join(w.encode() + b" " + struct.pack(f"<{width}f", *v) + feed for w, v in rows)
    return f"{len(rows) if words is None else words} {width}\n".encode() + body


def made(rng, n, width):
    """Vectors whose bytes hold many blanks and line feeds, and words of all lengths."""
    bad = [struct.unpack("<f", bytes(rng.choice(b"\x20\x0a\x0d\x00\x3f\xc0") for _ in range(4)))[0] for _ in range(200)]
    word = lambda i: rng.choice(["w", "é", "日本", "x" * 70]) + str(i)
    return [(word(i), [rng.choice(bad) if rng.random() < 0.5 else float(np.float32(rng.gauss(0, 1))) for _ in range(width)]) for i in range(n)]


def read(spark, path, size=None):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if size:
        spark.conf.set(key, size)
    try:
        return {r["word"]: r["vector"] for r in read_vectors(spark, str(path), "word2vec").collect()}
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("width,size,feed", [(1, 50, b"\n"), (3, 64, b""), (20, 41, b"\n"), (20, 1000, b""), (7, None, b"\n")])
def test_parts_of_any_size_give_all_vectors(spark, tmp_path, width, size, feed):
    rows = made(random.Random(width), 120, width)
    (tmp_path / "a.bin").write_bytes(file_bytes(rows[:90], width, feed))
    (tmp_path / "b.bin").write_bytes(file_bytes(rows[90:], width, feed))
    got = read(spark, tmp_path, size)
    assert got.keys() == {w for w, _ in rows}
    for w, v in rows:
        assert np.array_equal(np.array(got[w], dtype=np.float32), np.array(v, dtype=np.float32), equal_nan=True)


def test_chains_follow_every_beginning():
    rng = random.Random(4)
    for _ in range(200):
        ends = np.cumsum([rng.randint(1, 9) for _ in range(rng.randint(1, 60))]) - 1
        step, size = rng.randint(2, 25), int(ends[-1]) + 1
        limit = step + 5
        upto, leave, count = chains(ends, step, limit)
        for begin in range(min(limit, size - 1) + 1):
            at, n = begin, 0
            while at < size:
                at, n = int(ends[np.searchsorted(ends, at)]) + step, n + 1
            i = int(np.searchsorted(upto, begin))
            assert (leave[i], count[i]) == (at - size, n)


@pytest.mark.parametrize("size", [60, None])
def test_bad_files_stop_the_read(spark, tmp_path, size):
    rows = made(random.Random(1), 30, 4)
    whole = file_bytes(rows, 4, b"")
    for name, raw in {"short": whole[:-1], "shorter": whole[:-40], "few": file_bytes(rows, 4, words=31), "text": b"no header here at all\n" * 9}.items():
        (tmp_path / name).write_bytes(raw)
        with pytest.raises(Exception, match="cut off|no word2vec header"):
            read(spark, tmp_path / name, size)
    (tmp_path / "more").write_bytes(file_bytes(rows, 4, words=29))
    assert len(read(spark, tmp_path / "more", size)) == 29
    (tmp_path / "none").write_bytes(b"0 4\n")
    assert read(spark, tmp_path / "none") == {}


def test_round_trip_in_several_files(spark, tmp_path):
    rows = [(w, [float(np.float32(x)) for x in v]) for w, v in made(random.Random(2), 200, 16)]
    df = spark.createDataFrame(rows, "word string, vector array<float>")
    write_word2vec(df, str(tmp_path / "out"), files=4)
    got = read(spark, tmp_path / "out", 700)
    assert len(got) == 200
    for r in df.collect():
        assert np.array_equal(np.float32(got[r["word"]]), np.float32(r["vector"]), equal_nan=True)
    with pytest.raises(ValueError, match="blanks"):
        write_word2vec(spark.createDataFrame([("a b", [1.0])], "word string, vector array<float>"), str(tmp_path / "bad"))
