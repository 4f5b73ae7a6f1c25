"""Secrets in texts: fixed patterns, and strings in a sensitive place that a primed compressor cannot shorten."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkgrain.llm.shared import ship

#: Bytes of the identifier dictionary, which is sent to every task.
DICTIONARY_BYTES = 64 << 10
#: Identifiers that a task counts before it passes them on.
COUNTED = 200_000
#: Parts in which the commonest identifiers are ranked before the driver sees them.
PARTS = 16
#: Code points of surrounding text on either side that the compressor sees.
AROUND = 512
#: A sensitive word counts for candidates that begin at most this many code points after it, on the same line.
REACH = 48
#: Marginal compressed bytes per code point from which a candidate is reported.
LEAST_NOVELTY = 0.7
LEVEL = 3

KINDS = ("assign", "access", "hex", "novel")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run is matched whole, so shorter runs fail either way
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

SENSITIVE_WORDS = "access auth bearer cert cookie cred encrypt key login pass private pwd salt secret session sign token".split()
SENSITIVE = re.compile(rf"(?<![a-z])(?:{'|'.join(SENSITIVE_WORDS)})|(?<=[_-])(?:{'|'.join(SENSITIVE_WORDS)})", re.IGNORECASE | re.ASCII)
SENSITIVE_BYTES = tuple(w.encode() for w in SENSITIVE_WORDS)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=~-]{12,}")
IDENTIFIER = re.compile(rb"[A-Za-z_]{3,24}")


def base_spans(text: str, low: bytes) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns; ``low`` is the UTF-8 text with A-Z in lower case."""
    out = []
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"akia" in low:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


class Novelty:
    """A zstandard compressor that knows the common identifiers."""

    def __init__(self, dictionary: bytes):
        import zstandard

        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
        if primed:
            primed.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False).compress

    def marginal(self, before: str, candidate: str, after: str) -> float:
        """Compressed bytes that the candidate adds to its surroundings, per code point."""
        left, right = before.encode(), after.encode()
        more = len(self.compress(left + candidate.encode() + right)) - len(self.compress(left + right))
        return more / len(candidate)

    def spans(self, text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int, float]]:
        """Candidates after a sensitive word on their line that overlap no taken span and add ``LEAST_NOVELTY`` or more.

        A candidate has two of: lower-case letters, upper-case letters, digits. It is measured at its first place, before its own
        repeats; the repeats share its figure.
        """
        marks = [m.end() for m in SENSITIVE.finditer(text)]
        if not marks:
            return []
        busy = sorted((a, b) for _, a, b in taken)
        out, known, mark, block = [], {}, 0, 0
        for m in CANDIDATE.finditer(text):
            start, end = m.span()
            while mark < len(marks) and marks[mark] <= start:
                mark += 1
            if not mark or start - marks[mark - 1] > REACH or "\n" in text[marks[mark - 1] : start]:
                continue
            while block < len(busy) and busy[block][1] <= start:
                block += 1
            if any(a < end for a, _ in busy[block : block + 1]):
                continue
            word = m[0]
            if sum(map(bool, (re.search("[a-z]", word), re.search("[A-Z]", word), re.search("[0-9]", word)))) < 2:
                continue
            if word not in known:
                after = text[end : end + AROUND].split(word, 1)[0]
                known[word] = self.marginal(text[max(0, start - AROUND) : start], word, after)
            if known[word] >= LEAST_NOVELTY:
                out.append(("novel", start, end, known[word]))
        return out


def identifier_dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY_BYTES) -> bytes:
    """The identifiers (letters and underscores, 3 to 24) that most documents hold, up to ``size`` bytes, the commonest last.

    Counted over all documents and whole texts; ties go by name. Strings with digits never enter, so a secret that many copies
    share does not become known. Only as many rows as the dictionary has room for reach the driver.
    """
    ship(docs.sparkSession)

    def count(batches):
        total = Counter()
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                if raw:
                    total.update(set(IDENTIFIER.findall(raw)))
                if len(total) >= COUNTED:
                    yield rows(total)
                    total = Counter()
        yield rows(total)

    def rows(total):
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    counted = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out, room, most = [], size, size // 4  # a word takes four bytes at least
    # The best of each of a few parts first: what reaches the driver then depends on neither texts nor partitions.
    by_count = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(PARTS))).orderBy(F.desc("n"), "word")
    best = counted.withColumn("place", F.row_number().over(by_count)).where(F.col("place") <= most)
    for r in best.orderBy(F.desc("n"), "word").limit(most).collect():
        room -= len(r["word"]) + 1
        if room < 0:
            break
        out.append(bytes(r["word"]))
    return b" ".join(reversed(out))


def find_secrets(docs: DataFrame, dictionary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, found`` of every row; ``found`` is an array of ``(kind, start, end, value, novelty)``, by start, then kind.

    Offsets are code points, ends exclusive. ``assign``, ``access`` and ``hex`` are the fixed patterns (leftmost, not overlapping within a kind);
    ``novel`` are further strings that follow a sensitive word and cost a compressor, primed with the identifier dictionary and
    run over the surrounding text, nearly as many bytes as they have letters. One pass without a shuffle; texts are read whole.

    Null and empty texts have an empty array. Repeated rows and null ids each get a row; an empty table gives none. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(dictionary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("novelty", pa.float64())]))

    def run(batches):
        novelty = Novelty(sent.value)
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                here = []
                if text:
                    low = text.encode().lower()
                    base = base_spans(text, low)
                    here = [(*s, None) for s in base]
                    if any(w in low for w in SENSITIVE_BYTES):
                        here += novelty.spans(text, base)
                    here.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                out.append([{"kind": k, "start": a, "end": b, "value": text[a:b], "novelty": v} for k, a, b, v in here])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, found)], ["doc_id", "found"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, found array<struct<kind: string, start: long, end: long, value: string, novelty: double>>")


def span_list(found: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts of the fixed patterns, their spans as a SHA-256, and all spans as text."""
    found = F.col("found")
    of_kind = lambda kind: F.filter(found, lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    base = span_list(F.filter(found, lambda s: s["kind"] != "novel"))
    judged = find_secrets(docs, identifier_dictionary(docs))
    return judged.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), span_list(found).alias("spans"))
