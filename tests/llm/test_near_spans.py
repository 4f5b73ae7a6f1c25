import hashlib
import itertools
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cases import PLAIN, ROWS, awkward, union_find
from inkgrain.llm.components import components
from inkgrain.llm.neardup import BANDS, BUCKET_BITS, ROWS as BAND_ROWS, Sampler, drop_near, jaccard, near_groups, weighted_shingles
from inkgrain.llm.spans import SuffixAutomaton, anchors, remove_repeats
from inkgrain.llm.words import runs, spans, word_hashes


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(40)]
    hub = [(1000, 1001 + i) for i in range(200)]
    loose = [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(60)]
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in chain + hub + loose]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = [(a, b) for a, b in edges if a != b]
    assert got == union_find({x for e in linked for x in e}, linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_samples_agree_as_often_as_weights_are_similar():
    rng = np.random.default_rng(0)
    sampler = Sampler(4000)
    elements = np.sort(rng.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2))
    a, b = rng.uniform(1, 8, 60), rng.uniform(1, 8, 60)
    b[:30] = a[:30]
    grid = lambda w: np.exp(np.rint(np.log(w) * 16) / 16)
    exact = jaccard((elements, grid(a)), (elements, grid(b)))
    share = np.mean(sampler.sample(elements, a) == sampler.sample(elements, b))
    assert abs(share - exact) < 0.04
    assert np.array_equal(sampler.sample(elements, a), Sampler(4000).sample(elements, a))


def truth(rows):
    """Classes by comparing all pairs of different texts."""
    raws = [(t or "").encode() for _, t in rows]
    df = np.zeros(1 << BUCKET_BITS)
    for r in raws:
        df[np.unique((word_hashes(r) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))] += 1
    idf = np.log((1 + len(raws)) / (1 + df)) + 1
    sets = {r: weighted_shingles(r, idf) for r in set(raws)}
    edges = [(raws.index(x), raws.index(y)) for x, y in itertools.combinations(sets, 2) if len(sets[x][0]) and len(sets[y][0]) and jaccard(sets[x], sets[y]) >= 0.8]
    edges += [(i, raws.index(r)) for i, r in enumerate(raws) if r.split() and raws.index(r) != i]
    same = {}
    for i, r in enumerate(raws):
        if r.split():
            edges.append((same.setdefault(r" ".join(map(str, r.split())), i), i))
    top = union_find(range(len(rows)), edges)
    classes = {}
    for i, t in top.items():
        classes.setdefault(t, []).append(i)
    out = []
    for members in classes.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], min(ids) if ids else None, len(members)) for i in members]
    return sorted(out, key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def test_near_groups_against_all_pairs(spark):
    """Groups of edited copies around the threshold: chains, hubs, and copies that match no other."""
    rng = random.Random(8)
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([30, 120, 300]))]
        for _ in range(rng.choice([2, 12, 25])):
            rows.append((len(rows), " ".join(edited(rng, base, rng.randint(0, max(1, len(base) // 30))))))
    rows += [(len(rows) + i, " ".join(f"w{rng.randrange(3000)}" for _ in range(50))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in near_groups(df).collect()), key=str)
    want = truth(rows)
    assert sum(a != b for a, b in zip(got, want)) <= 2  # banding finds a pair at the threshold with probability 0.998
    shuffled = near_groups(df, broadcast_bytes=0)
    assert sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in shuffled.collect()), key=str) == got


def test_near_awkward(spark):
    got = near_groups(awkward(spark)).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in got), key=str) == truth([r[:2] for r in ROWS])
    assert sum(r["kept"] for r in got) == len({(r["class_id"], r["class_size"]) if r["class_id"] is not None else i for i, r in enumerate(got)})
    assert near_groups(awkward(spark, [])).count() == 0
    df = awkward(spark)
    left = drop_near(df)
    assert left.columns == df.columns
    assert {r["doc_id"] for r in left.collect()} == {1, 4, 5, 6, 7, None, 9, 10, 11}


def test_bands_find_pairs_at_the_threshold():
    p = 0.8**BAND_ROWS
    assert 1 - (1 - p) ** BANDS > 0.99


def test_word_hashes_are_those_of_words():
    rng = random.Random(1)
    text = "".join(rng.choice("ab \t\n\x0b\x0c\r  é日") for _ in range(5000)).encode()
    words = text.split()
    h = word_hashes(text)
    assert len(h) == len(words)
    assert len({(x, y) for x, y in zip(h.tolist(), words)}) == len(set(words)) == len(set(h.tolist()))
    many = (" ".join(f"w{i % 5000}" for i in range(400_000))).encode()  # over several blocks
    assert len(set(word_hashes(many).tolist())) == 5000
    r = runs(h, 7)
    assert len({(x, tuple(words[i : i + 7])) for i, x in enumerate(r.tolist())}) == len(set(r.tolist()))
    assert spans(h, np.array([3]), np.array([10]))[0] == spans(np.concatenate([h[3:10]]), np.array([0]), np.array([7]))[0]


def test_automaton():
    rng = random.Random(3)
    for _ in range(60):
        added = [[rng.choice("abc") for _ in range(rng.randint(0, 20))] for _ in range(rng.randint(1, 3))]
        automaton = SuffixAutomaton()
        for s in added:
            automaton.add(s)
        known = {tuple(s[i:j]) for s in added for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        text = [rng.choice("abcd") for _ in range(30)]
        want = [max([n for n in range(1, i + 2) if tuple(text[i + 1 - n : i + 1]) in known], default=0) for i in range(30)]
        assert automaton.matches(text) == want


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
    seen = []
    for _ in range(5):
        h = np.concatenate([rng.integers(0, 1 << 63, rng.integers(0, 70), dtype=np.uint64), passage, rng.integers(0, 1 << 63, 60, dtype=np.uint64)])
        at = int(np.flatnonzero(h == passage[0])[0])
        starts, sizes, anchor = anchors(h)
        each = np.repeat(anchor, sizes)
        assert len(each) == len(h) - 49
        seen.append(tuple(each[at : at + 41]))
    assert len(set(seen)) == 1


def cut_all(rows, length=50):
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - length + 1):
            if d is not None:
                k = tuple(w[i : i + length])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if d is not None and first[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def repeats(rng, n):
    """Passages in many contexts, parts of passages, whole copies, a periodic text and its own repetition."""
    passages = [[f"p{rng.randrange(50)}" for _ in range(rng.choice([49, 50, 51, 70, 160]))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            words += p[a : len(p) - rng.randint(0, 5)] + [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 60))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(n + 5, rows[3][1]), (n + 6, "la " * 400), (n + 7, "la " * 300), (n + 8, ("a b " * 100)), (n + 8, rows[4][1]), (n + 9, rows[4][1] + " " + rows[4][1])]
    rng.shuffle(rows)
    return rows


def test_repeats_against_all_windows(spark):
    rows = repeats(random.Random(6), 120)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for windows in (2_000_000, 1000):
        got = remove_repeats(df, bucket_windows=windows)
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()) == cut_all(rows)
    for r in remove_repeats(df).collect():
        assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]


def test_repeats_awkward(spark):
    long = [(d, t) for d, t, _ in ROWS] + [(20, " ".join([PLAIN] * 4)), (21, "x " + " ".join([PLAIN] * 5))]
    df = awkward(spark, [(d, t, "en") for d, t in long])
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in remove_repeats(df).collect())
    assert got == cut_all(long)
    assert remove_repeats(awkward(spark, [])).count() == 0
    assert dict(remove_repeats(df, also=("row", "kept_x")).dtypes)["row"] == "string" if "kept_x" in df.columns else True


def test_texts_are_shuffled_once(spark, capsys):
    """Joins on the written buckets move only the spans; texts without a window are in no join; untouched texts stay as they are."""
    rows = repeats(random.Random(9), 60) + [(500, None), (501, ""), (502, "  a \n b ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = remove_repeats(df, bucket_windows=1000, as_is=True)
    out.explain()
    plan = capsys.readouterr().out
    assert "SelectedBucketsCount" in plan or "Bucketed: true" in plan
    assert not any("text" in line for line in plan.splitlines() if "Exchange" in line)
    assert plan.count("Exchange") == 1
    kept = {(r["doc_id"], r["n_words"]): r["kept"] for r in out.collect() if r["n_removed"] == 0}
    for doc, text in rows:
        n = len((text or "").split())
        if (doc, n) in kept:
            assert kept[doc, n] == text


def test_hot_passage_is_removed_everywhere_but_once(spark):
    passage = " ".join(f"h{i}" for i in range(60))
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.md5(F.col("id").cast("string")), F.lit(passage), F.sha1(F.col("id").cast("string"))).alias("text"))
    got = remove_repeats(df, texts=False).groupBy("n_words", "n_removed").count().collect()
    assert sorted(map(tuple, got)) == [(62, 0, 1), (62, 60, 1999)]
