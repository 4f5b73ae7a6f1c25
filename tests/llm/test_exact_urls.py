import hashlib
import random

from pyspark.sql import functions as F

from cases import ROWS, awkward, bare
from inkgrain.llm import exact
from inkgrain.llm.exact import drop_exact, exact_groups
from inkgrain.llm.urls import judge_urls, rule_table


def groups_of(rows):
    by = {}
    for i, (d, t) in enumerate(rows):
        by.setdefault(bare(t), []).append((len(t or ""), d, i))
    return by


def check(got, rows):
    by = groups_of(rows)
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        sha = r["text_sha256"]
        kept[sha] = kept.get(sha, 0) + r["kept"]
    assert set(kept.values()) <= {1}
    want = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in by.items()}
    for r in got:
        group = want[r["text_sha256"]]
        assert r["group_size"] == len(group)
        longest = max(n for n, _, _ in group)
        ids = [d for n, d, _ in group if n == longest]
        known = [d for d in ids if d is not None]
        assert r["keep_id"] == (min(known) if known else None)


def test_exact_awkward(spark):
    check(exact_groups(awkward(spark)).collect(), [r[:2] for r in ROWS])


def test_exact_without_broadcast_and_with_a_crowded_filter(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("abcdefgh") * rng.randint(0, 30) + " " * rng.randint(0, 3)) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(exact_groups(df, broadcast_bytes=0).collect(), rows)
    check(exact_groups(df, bits_per_row=1).collect(), rows)


def test_exact_plan_is_native_and_unique_rows_do_not_shuffle(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    plan = exact_groups(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    alone = plan.split("Union")[1]
    assert "Exchange hashpartitioning" not in alone.split("SortMergeJoin")[0].split("BroadcastHashJoin")[0]


def test_exact_extreme_ids(spark):
    rows = [(-(2**63), "a b"), (2**63 - 1, "ab "), (0, "a b"), (-(2**63), "x"), (2**63 - 1, "x"), (None, "x")]
    check(exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_exact_empty_and_drop(spark):
    assert exact_groups(awkward(spark, [])).count() == 0
    assert drop_exact(awkward(spark, [])).count() == 0
    df = awkward(spark)
    left = drop_exact(df)
    assert left.columns == df.columns
    assert left.count() == len(groups_of([r[:2] for r in ROWS]))


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:cut]


def judge(url, rules):
    host, path = url_parts(url)
    best = None
    for verdict, rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or (len(rule), len(h)) > best[0]:
                best = ((len(rule), len(h)), rule, verdict)
    return (host, path, best[1], best[2]) if best else (host, path, None, "allow")


def test_urls_against_every_rule(spark):
    rng = random.Random(4)
    hosts = ["org", "example.org", "a.example.org", "xexample.org", "com", "b.com", "EXAMPLE.org", "", "org.", "..org", "a..org"]
    paths = ["", "/", "/e", "/es", "/es/", "/es/1", "/en/1", "/en/12/x", "/fr/\u00e9", "/ES/", "/es/\U0010ffff\U0010ffff"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a=/es/', '#x://y'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "://", "x://", "http://a://b/c", "http://org/es/\n1"] * 2
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
             ("block", "org/e"), ("allow", "org/es"), ("allow", "a.example.org/es/1"), ("block", "b.com/"), ("allow", "example.org/es/\U0010ffff")]
    pages = spark.createDataFrame([(i % 350, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = judge_urls(pages, rule_table(spark, rules)).collect()
    want = sorted((i % 350, *judge(u, rules)) for i, u in enumerate(urls))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_urls_hot_key_many_partitions_and_empty(spark):
    rules = [("block", "h.com/a/"), ("allow", "h.com/")]
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.when(F.col("id") % 2 == 0, F.lit("http://h.com/a/b")).otherwise(F.concat(F.lit("http://h.com/"), F.col("id").cast("string"))).alias("url"))
    got = judge_urls(pages, rule_table(spark, rules))
    assert {(r["verdict"], r["count"]) for r in got.groupBy("verdict").count().collect()} == {("block", 1500), ("allow", 1500)}
    assert judge_urls(pages.limit(0), rule_table(spark, rules)).count() == 0
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in judge_urls(pages.limit(5), none, default="block").collect()} == {"block"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shared_folder_is_the_named_one(spark, tmp_path):
    assert exact.written(spark.range(3), "x").inputFiles()[0].replace("file://", "").startswith(spark.conf.get("spark.checkpoint.dir").replace("file://", ""))
