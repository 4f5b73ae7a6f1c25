import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline as cp  # noqa: E402
from cases import awkward, bare  # noqa: E402
from test_near_spans import cut_all, truth  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from inkgrain.llm.shared import written  # noqa: E402


SF = "/root/testdata/sf0.01"  # the smallest table with labels enough to learn from


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(written(stage(spark, out[-1], SF), "stage"))
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()]


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_toxicity_drops_what_it_rejects(spark, stages):
    before, after = {d for d, _ in rows(stages[0])}, {d for d, _ in rows(stages[1])}
    assert after < before
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert np.mean([labels[d] for d in before - after if d in labels]) > 0.8


def test_exact_keeps_one_of_each_text(stages):
    best = {}
    for d, t in rows(stages[1]):
        best[bare(t)] = min(best.get(bare(t), (0, d)), (-len(t or ""), d))
    assert {d for d, _ in rows(stages[2])} == {d for _, d in best.values()}


def test_near_keeps_the_first_of_each_class(stages):
    assert {d for d, _ in rows(stages[3])} == {d for d, c, _ in truth(rows(stages[2])) if d == c}


def test_substring_texts(stages):
    import hashlib

    want = cut_all(rows(stages[3]))
    got = dict(rows(stages[4]))
    before = dict(rows(stages[3]))
    for (d, n, gone, sha), _ in want.items():
        assert hashlib.sha256(b" ".join(got[d].encode().split())).hexdigest() == sha
        assert gone or got[d] == before[d]
    assert stages[4].where(F.col("n_chars") != F.length("text")).count() == stages[3].where(F.col("n_chars") != F.length("text")).count()


def test_packed(stages):
    pieces = stages[5].collect()
    assert {p["doc_id"] for p in pieces} == {d for d, _ in rows(stages[4])}
    assert all(zlib.crc32(bytes(p["ids"])) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"] for p in pieces)


def test_awkward_tables_pass_through(spark, sf):
    for table in (awkward(spark), awkward(spark, [])):
        docs = table
        for name, stage in cp.STAGES[:-1]:
            docs = written(stage(spark, docs, sf), "stage")
            assert docs.columns == table.columns
        assert {r["doc_id"] for r in cp.STAGES[-1][1](spark, docs, sf).collect()} == {r["doc_id"] for r in docs.collect()}


def test_registered(spark):
    names = entry.queries()
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert {"op3_exact_dedup", "op4_url_rules"} <= set(entry.oracle_sql())


def test_working_tables_of_earlier_stages_are_deleted(spark):
    import os

    from inkgrain.llm.shared import collected, drop_unread, written

    with collected() as paths:
        first = written(spark.range(5), "first")
        second = written(spark.range(7), "second")
    places = [p.removeprefix("file://") for p in paths]
    assert len(paths) == 2 and all(map(os.path.exists, places))
    assert drop_unread(paths, second.join(spark.range(3), "id")) == paths[1:]
    assert not os.path.exists(places[0]) and second.count() == 7 and first.schema == second.schema
