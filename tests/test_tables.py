import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from inkgrain.functions import probability as pr
from inkgrain.functions.names import with_class_name
from inkgrain.operators import metrics as mt
from inkgrain.operators.rowid import dense_row_id, require_unique
from inkgrain.operators.splits import stratified_folds, stratified_split
from inkgrain.operators.store import new_path
from inkgrain.plans.pseudo import pseudo_labels, run_summary, union_pseudo_labels
from inkgrain.sources import csv
from inkgrain.sources.vectors import parse_vector_lines, read_vectors


@pytest.fixture(scope="module")
def skewed(spark):
    labels = [0] * 300 + [1] * 37 + [2] * 5 + [3] * 58
    return spark.createDataFrame([(i * 3, y) for i, y in enumerate(labels)], "id long, label int")


def order(rows, seed=42):
    return sorted(rows, key=lambda r: (hashlib.md5(f"{seed}-{r.id}".encode()).hexdigest(), r.id))


def test_split_sizes_and_members(skewed):
    rows = stratified_split(skewed.repartition(5), "label", "id", 0.15).collect()
    assert len(rows) == 400 and sum(r.is_test for r in rows) == math.ceil(0.15 * 400)
    for label, n in Counter(r.label for r in rows).items():
        mine = order([r for r in rows if r.label == label])
        held = sum(r.is_test for r in mine)
        assert abs(held - 0.15 * n) < 1
        assert [r.is_test for r in mine] == [False] * (n - held) + [True] * held


def test_folds_partition_the_rows(skewed):
    rows = stratified_folds(skewed, "label", "id", 5).collect()
    again = stratified_folds(skewed.repartition(7), "label", "id", 5).collect()
    assert sorted(rows) == sorted(again) and len({r.id for r in rows}) == 400
    sizes = Counter(r.fold for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 5
    for label in range(4):
        per = Counter({f: 0 for f in range(5)})
        per.update(r.fold for r in rows if r.label == label)
        assert max(per.values()) - min(per.values()) <= 1
    other = stratified_folds(skewed, "label", "id", 5, seed=1).collect()
    assert sorted(rows) != sorted(other)


def test_null_labels_are_kept(spark):
    rows = spark.createDataFrame([(i, None if i % 10 == 0 else i % 3) for i in range(100)], "id long, label int")
    assert stratified_folds(rows, "label", "id", 5).count() == stratified_split(rows, "label", "id").count() == 100
    weights = mt.class_weights(rows, "label").collect()
    assert len(weights) == 100 and {r.weight for r in weights if r.label is None} == {100 / (4 * 10)}


def test_large_classes_get_more_groups(spark, monkeypatch):
    from inkgrain.operators import splits

    rows = spark.range(3000).select("id", F.lit(1).alias("label"))
    want = sorted(stratified_folds(rows, "label", "id", 3).collect())
    monkeypatch.setattr(splits, "GROUP_ROWS", 2)
    assert sorted(stratified_folds(rows, "label", "id", 3).collect()) == want


def test_no_class_is_ranked_in_one_task(skewed):
    plan = stratified_folds(skewed, "label", "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(label#" in plan and "__group" in plan
    assert "hashpartitioning(id" not in plan


def test_metrics(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 9)] + [(2, 0)] * 4
    df = spark.createDataFrame(pairs, "label int, prediction int")
    classes = [0, 1, 2, 9]
    tp = {c: sum(a == b == c for a, b in pairs) for c in classes}
    true, said = Counter(a for a, _ in pairs), Counter(b for _, b in pairs)
    f1 = {c: 2 * tp[c] / (true[c] + said[c]) for c in classes}
    assert mt.macro_f1(df, "label", "prediction").first()[0] == pytest.approx(sum(f1.values()) / 4)
    report = {r["class"]: r for r in mt.classification_report(df, "label", "prediction").collect()}
    assert set(report) == {"0", "1", "2", "9", "accuracy", "macro avg", "weighted avg"}
    assert report["9"].recall == 0.0 and report["2"].precision == 0.0
    assert report["accuracy"].f1 == pytest.approx(8 / 15)
    assert report["weighted avg"].f1 == pytest.approx(sum(f1[c] * true[c] for c in classes) / 15)
    assert {r.label: (r.n, r.percent) for r in mt.share_distribution(df, "label").collect()}[2][1] == pytest.approx(400 / 15)
    weights = {r.label: r.weight for r in mt.class_weights(df, "label").collect()}
    assert weights == pytest.approx({0: 15 / 21, 1: 15 / 12, 2: 15 / 12})


def test_probabilities(spark):
    df = spark.createDataFrame([(0, [0.9, 0.05, 0.05]), (1, [0.4, 0.4, 0.2]), (2, [0.1, 0.2, 0.7]), (3, [0.0, 0.0, 0.0])], "id int, p array<double>")
    p = F.col("p")
    assert [r.id for r in df.where(pr.is_confident(p, 0.9)).collect()] == [0]
    assert df.where(pr.is_confident(p, 1.01)).count() == 0
    assert [r[0] for r in df.select(pr.argmax_label(p, ["x", "y", "z"])).collect()] == ["x", "x", "z", "x"]
    assert df.select(pr.normalise(p)).collect()[3][0] == pytest.approx([1 / 3] * 3)
    assert df.select(pr.soft_vote([p, F.reverse(p)])).first()[0] == pytest.approx([0.475, 0.05, 0.475])


def test_pseudo_labels_keep_the_label_type(spark):
    given = spark.createDataFrame([(1, 5)], "id long, label short")
    scored = spark.createDataFrame([(7, [0.05, 0.95]), (8, [0.5, 0.5])], "id long, p array<double>")
    new = pseudo_labels(scored, "p", [3, 5], "label", 0.9)
    both = union_pseudo_labels(given, new.select("id", "label"), "label")
    assert both.schema["label"].dataType.typeName() == "short"
    assert sorted(map(tuple, both.collect())) == [(1, 5), (7, 5)]
    row = run_summary(given, "label", scored, "p", 0.9).first()
    assert (row.pseudo_rows, row.extended_rows, row.pseudo_percent) == (1, 2, 50.0)


def test_dense_ids(spark):
    # One key holds most rows, and copies of rows are identical.
    rows = spark.createDataFrame([("a",)] * 700 + [(f"k{i:03d}",) for i in range(300)], "key string").repartition(9)
    out = dense_row_id(rows, "id", order_by="key").orderBy("id").collect()
    assert [r.id for r in out] == list(range(1000))
    assert [r.key for r in out] == sorted(r.key for r in out)
    assert sorted(r.id for r in dense_row_id(rows, "id").collect()) == list(range(1000))


def test_csv_round_trip(spark):
    texts = ['say "hi", ok', "two\nlines", "back\\slash", " spaces ", "", None, "plain", '"', "a,b", "''"]
    rows = spark.createDataFrame([(i, t, i % 3) for i, t in enumerate(texts)], "id long, TEXT string, LABEL int")
    path = new_path(spark, "csv")
    csv.write_texts(rows, path)
    back = csv.read_labelled(spark, path, id_col="id", id_type=LongType()).select("id", F.coalesce("TEXT", F.lit("")).alias("t"), "LABEL")
    assert sorted(map(tuple, back.collect())) == [(i, t or "", i % 3) for i, t in enumerate(texts)]
    assert csv.has_column(spark, path, "id") and not csv.has_column(spark, path, "nope")
    assert csv.read_unlabelled(spark, path).columns == ["TEXT"]
    with pytest.raises(ValueError, match="nope"):
        csv.read_labelled(spark, path, label_col="nope")


def test_ids_keep_their_type_and_bad_cells_stop(spark):
    path = new_path(spark, "csv")
    csv.write_texts(spark.createDataFrame([("x7", "a", "1"), ("0012", "b", "zz")], "id string, TEXT string, LABEL string"), path)
    assert {r.id for r in csv.read_unlabelled(spark, path, id_col="id").collect()} == {"x7", "0012"}
    with pytest.raises(Exception, match="Malformed|FAILED_READ_FILE"):
        csv.read_labelled(spark, path).collect()
    out = new_path(spark, "predictions")
    csv.write_predictions(spark.createDataFrame([("x7", 1)], "id string, label int"), out)
    assert csv.read_predictions(spark, out, "string").first().id == "x7"


def test_parquet_input(spark):
    path = new_path(spark, "table") + ".parquet"
    spark.createDataFrame([("k", "two\nlines", 1)], "id string, TEXT string, LABEL int").write.parquet(path)
    assert csv.has_column(spark, path, "id")
    assert csv.read_labelled(spark, path, id_col="id").first() == ("k", "two\nlines", 1)


def test_ids_follow_the_files(spark):
    folder = new_path(spark, "files")
    for name, n in (("a", 1), ("b", 50), ("c", 7)):
        spark.range(n).select(F.concat(F.lit(name), F.col("id")).alias("TEXT")).coalesce(1).write.option("header", True).csv(f"{folder}/{name}")
    rows = csv.read_unlabelled(spark, f"{folder}/*")
    got = [r.TEXT for r in dense_row_id(rows, "id").orderBy("id").collect()]
    assert got == ["a0"] + [f"b{i}" for i in range(50)] + [f"c{i}" for i in range(7)]


def test_ids_must_be_unique(spark):
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    require_unique(rows(1, 2), "id")
    with pytest.raises(ValueError, match="nulls"):
        require_unique(rows(1, None), "id")
    with pytest.raises(ValueError, match="1 repeated"):
        require_unique(rows(1, 1, 2), "id")


def test_predictions(spark):
    path = new_path(spark, "predictions")
    csv.write_predictions(spark.createDataFrame([(2, 1), (1, 0)], "k long, y int"), path, "k", "y")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert set(lines) == {"id,label", "1,0", "2,1"}
    assert sorted(map(tuple, csv.read_predictions(spark, path).collect())) == [(1, 0), (2, 1)]


def test_vector_text(spark):
    path = new_path(spark, "vectors")
    spark.createDataFrame([("2 3",), ("cat 1 2.5 -3e-1",), ("dog 0 0 1",)], "value string").coalesce(1).write.text(path)
    rows = {r.word: r.vector for r in read_vectors(spark, path, "text").collect()}
    assert rows.keys() == {"cat", "dog"} and rows["cat"] == pytest.approx([1, 2.5, -0.3])
    with pytest.raises(ValueError):
        read_vectors(spark, path, "bin")
    narrow = spark.createDataFrame([("2 1",), ("cat 5",), ("dog 7",)], "value string")
    assert sorted(map(tuple, parse_vector_lines(narrow).collect())) == [("cat", [5.0]), ("dog", [7.0])]
    assert parse_vector_lines(narrow.where("value <> '2 1'")).count() == 2
    uneven = spark.createDataFrame([("cat 5 6",), ("dog 7",)], "value string")
    with pytest.raises(Exception, match="another width"):
        parse_vector_lines(uneven).collect()


def test_class_names(spark):
    df = with_class_name(spark.createDataFrame([(0,), (5,), (7,)], "label int"), "label")
    assert [r.class_name for r in df.collect()] == ["Human-written text", "ChatGPT generated text", None]
