"""Remove passages that earlier documents hold, by suffix automata of reference passages."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkgrain.llm.shared import bucketed, ship, written
from inkgrain.llm.words import runs, signed, spans, word_hashes

LENGTH = 50
#: Anchors are least hashes of this many words inside a window.
GRAM = 8
#: Texts are written in buckets of about this many windows (16 MB); Spark allows 100,000 buckets.
BUCKET_WINDOWS = 2_000_000
MOST_BUCKETS = 100_000


class SuffixAutomaton:
    """All substrings of the sequences added, one state per class of equal end positions."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]

    def add(self, sequence) -> None:
        nexts, link, size = self.next, self.link, self.size
        last = 0
        for c in sequence:
            q = nexts[last].get(c)
            if q is not None and size[q] == size[last] + 1:  # known from an earlier sequence
                last = q
                continue
            if q is not None:
                last = self.split(last, q, c)
                continue
            now = len(size)
            nexts.append({})
            size.append(size[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = now
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                link[now] = q if size[q] == size[p] + 1 else self.split(p, q, c)
            last = now

    def split(self, p: int, q: int, c) -> int:
        nexts, link, size = self.next, self.link, self.size
        copy = len(size)
        nexts.append(dict(nexts[q]))
        size.append(size[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = copy
            p = link[p]
        return copy

    def matches(self, sequence) -> list[int]:
        """Matching statistics: for each place, how many words ending there are a substring."""
        nexts, link, size = self.next, self.link, self.size
        state = held = 0
        out = []
        for c in sequence:
            to = nexts[state].get(c)
            while to is None and state:
                state = link[state]
                held = size[state]
                to = nexts[state].get(c)
            if to is not None:
                state = to
                held += 1
            out.append(held)
        return out


def anchors(h: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``length`` words in runs that share their anchor: first window, number of windows, hash of the anchor.

    The anchor of a window is the first least hash of its GRAM-word runs, so equal windows have equal anchors.
    """
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    g = runs(h, min(GRAM, length))
    wide = length - min(GRAM, length) + 1
    at = np.empty(n, dtype=np.int64)
    for k in range(0, n, 1 << 16):
        view = np.lib.stride_tricks.sliding_window_view(g[k : k + (1 << 16) + wide - 1], wide)[: n - k]
        at[k : k + len(view)] = view.argmin(axis=1) + np.arange(k, k + len(view))
    starts = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    return starts, np.diff(np.append(starts, n)), g[at[starts]]


def repeated_spans(docs: DataFrame, length: int = LENGTH, bucket_windows: int = BUCKET_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """``row, start, n, ref_row, ref_start``: runs of ``n`` windows of ``docs`` (row, doc_id, text, ...) that a document with a smaller id holds; and ``docs``, written in buckets by row.

    ``docs`` has no null ids. The texts are shuffled once, into the buckets; every join by row then moves the narrow side alone.

    Windows are grouped into runs with one anchor. Anchors of one document alone drop out. Runs equal as a whole are settled by
    the smallest document of their hash; only runs that share an anchor with a different run are looked at window by
    window. All minima combine on the map side, so a passage in a third of all documents meets in no task.
    """

    def cut(batches):
        for batch in batches:
            parts = []
            for row, doc, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                h = word_hashes(text.encode()) if text else np.empty(0, dtype=np.uint64)
                starts, sizes, anchor = anchors(h, length)
                if len(starts):
                    whole = spans(h, starts, starts + sizes + length - 1)
                    parts.append((signed(anchor), signed(whole), np.full(len(starts), row), np.full(len(starts), doc), starts, sizes))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts)], ["anchor", "run", "row", "doc", "start", "n"])

    cuts = docs.select("row", "doc_id", "text").mapInArrow(cut, "anchor long, run long, row long, doc long, start long, n long")
    cuts = written(cuts, "runs")
    windows_in_all = cuts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    docs = bucketed(docs, "texts", "row", min(MOST_BUCKETS, 1 + windows_in_all // bucket_windows))
    several = cuts.groupBy("anchor").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).where("x < y").select("anchor")
    cuts = written(cuts.join(written(several, "anchors"), "anchor"), "candidates")

    first = cuts.groupBy("anchor", "run").agg(F.min(F.struct("doc", "row", "start")).alias("first"))
    first = written(first, "first")
    mixed = written(first.groupBy("anchor").count().where("count > 1").select("anchor", F.lit(True).alias("mixed")), "mixed")
    judged = written(cuts.join(first, ["anchor", "run"]), "judged")
    later = judged.where("doc > first.doc").select("row", "start", "n", F.col("first.row").alias("ref_row"), F.col("first.start").alias("ref_start"))

    asked = judged.where("doc = first.doc").join(mixed, "anchor").groupBy("row").agg(F.collect_list(F.struct("start", "n", "anchor")).alias("asked"))
    asked = written(asked, "asked")
    looked = docs.join(asked.hint("shuffle_hash"), "row")

    def windows(batches):
        for batch in batches:
            parts = []
            for row, doc, text, asked in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text", "asked"))):
                h = runs(word_hashes(text.encode()), length)
                at = np.concatenate([np.arange(a["start"], a["start"] + a["n"]) for a in asked])
                anchor = np.concatenate([np.full(a["n"], a["anchor"], dtype=np.int64) for a in asked])
                parts.append((anchor, signed(h[at]), np.full(len(at), row), np.full(len(at), doc), at))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts)], ["anchor", "window", "row", "doc", "start"])

    each = looked.select("row", "doc_id", "text", "asked").mapInArrow(windows, "anchor long, window long, row long, doc long, start long")
    each = written(each, "windows")
    least = written(each.groupBy("anchor", "window").agg(F.min(F.struct("doc", "row", "start")).alias("first"), F.max("doc").alias("y")).where("first.doc < y").drop("y"), "least")
    single = each.join(least, ["anchor", "window"]).where("doc > first.doc")
    single = single.select("row", "start", F.lit(1).cast("long").alias("n"), F.col("first.row").alias("ref_row"), F.col("first.start").alias("ref_start"))

    # runs that go on in both texts become one
    runs_ = later.unionByName(single).distinct().withColumn("diagonal", F.col("start") - F.col("ref_start"))
    before = Window.partitionBy("row", "ref_row", "diagonal").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    runs_ = runs_.withColumn("island", F.col("start") - F.coalesce(F.sum("n").over(before), F.lit(0)))
    runs_ = runs_.groupBy("row", "ref_row", "diagonal", "island").agg(F.min("start").alias("start"), F.sum("n").alias("n"), F.min("ref_start").alias("ref_start"))
    return written(runs_.select("row", "start", "n", "ref_row", "ref_start"), "spans"), docs


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, texts: bool = True, also: tuple[str, ...] = (), as_is: bool = False, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``kept`` if ``texts``), and the columns ``also``, of every row.

    Words are runs without blank, \\t, \\n, \\v, \\f, \\r. A word goes if a window of ``length`` words covers it whose words also start in a
    document with a smaller id; windows are judged on the input. ``kept`` joins the others by one blank; with ``as_is``, a text that loses
    nothing is kept unchanged, null texts included.

    Joins of anchor and window hashes find the repeated spans (``repeated_spans``). The words of the first document that holds a passage are
    its reference; each span is run through the suffix automaton of its reference, and what has a matching statistic of ``length`` or more goes,
    so that equal hashes of unequal words remove nothing. A reference is fetched once, whatever the number of its copies.

    Texts too short for a window pass by without a shuffle. The others are shuffled once, at every size of the table.

    Null and empty texts have no words. Rows with a null id are neither references nor cut. Rows that repeat an id do not cut each
    other; rows equal in id and text get equal results. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *also)
    named = named.withColumn("row", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(5), F.coalesce("text", F.lit(""))))
    # a window has ``length`` words and a blank between each two of them
    holds_window = F.col("doc_id").isNotNull() & (F.coalesce(F.length("text"), F.lit(0)) >= 2 * length - 1)
    found, stored = repeated_spans(named.where(holds_window), length, bucket_windows)

    wanted = found.select("ref_row", "ref_start", "n").distinct()
    asked = wanted.groupBy(F.col("ref_row").alias("row")).agg(F.collect_list(F.struct("ref_start", "n")).alias("asked"))
    asked = written(asked, "asked")

    def fetch(batches):
        for batch in batches:
            out = []
            for row, text, asked in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "asked"))):
                words = text.encode().split()
                out += [(row, a["ref_start"], a["n"], b" ".join(words[a["ref_start"] : a["ref_start"] + a["n"] + length - 1])) for a in asked]
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())], ["ref_row", "ref_start", "n", "words"])

    sources = stored.select("row", "text").join(asked.hint("shuffle_hash"), "row")
    passages = sources.mapInArrow(fetch, "ref_row long, ref_start long, n long, words binary").dropDuplicates(["ref_row", "ref_start", "n"])
    passages = written(passages, "passages")
    pairs = found.join(passages, ["ref_row", "ref_start", "n"]).groupBy("row").agg(F.collect_list(F.struct("start", "n", "words")).alias("found"))
    pairs = written(pairs, "found")
    joined = stored.join(pairs.hint("shuffle_hash"), "row", "left")
    others = named.where(~holds_window).withColumn("found", F.lit(None).cast(pairs.schema["found"].dataType))
    types = dict(named.dtypes)
    names = ["doc_id", *also]

    def strip(batches):
        cache: dict[bytes, SuffixAutomaton] = {}
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
                words = text.encode().split() if text else []
                covered = np.zeros(len(words) + 1, dtype=np.int32)
                for a in found or ():
                    automaton = cache.get(a["words"])
                    if automaton is None:
                        automaton = SuffixAutomaton()
                        automaton.add(a["words"].split())
                        if len(a["words"]) < 200_000:
                            if len(cache) >= 8:
                                cache.pop(next(iter(cache)))
                            cache[a["words"]] = automaton
                    for i, held in enumerate(automaton.matches(words[a["start"] : a["start"] + a["n"] + length - 1])):
                        if held >= length:
                            end = a["start"] + i + 1
                            covered[end - length] += 1
                            covered[end] -= 1
                gone = np.cumsum(covered[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if gone.any() else b" ".join(words)
                out[0].append(len(words))
                out[1].append(int(gone.sum()))
                out[2].append(hashlib.sha256(kept).hexdigest())
                if texts:
                    out[3].append(text if as_is and not gone.any() else kept.decode())
            columns = [*(batch.column(c) for c in names), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
            if texts:
                columns.append(pa.array(out[3], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "n_removed", "kept_sha256", *["kept"] * texts])

    schema = ", ".join(f"`{c}` {types[c]}" for c in names) + ", n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts
    both = [part.select(*names, "text", "found").mapInArrow(strip, schema) for part in (joined, others)]
    return both[0].unionByName(both[1])
