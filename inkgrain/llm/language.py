"""Language of a text from unigram pieces, summed over all segmentations of its words."""

from __future__ import annotations

import hashlib
import re
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.llm.shared import bucket, ship, written

#: Bound of the training sample: rows per language, taken by a hash of id and text.
SAMPLE_ROWS = 2_000
MAX_LANGUAGES = 1_000
ROUNDS = 4
LONGEST_PIECE = 12
#: A run of more letters is scored as consecutive runs of this many.
LONGEST_RUN = 60
CACHE_WORDS = 150_000

#: Characters that the pattern's \w has beside letters and decimal digits, such as fractions and Roman numerals.
NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
LETTERS = re.compile(rf"[^\W\d_{NUMBERS}]+")
#: The same with those characters, a much smaller class; few words need the other pattern.
SIGNS = re.compile(r"[^\W\d_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def public_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece vocabulary in lower case that consist of letters; U+2581 marks the start of a word."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())}
    return sorted(p for p in pieces if p and len(p) <= LONGEST_PIECE and all(c.isalpha() for c in p.removeprefix("▁")))


def words_of(text: str | None) -> list[str]:
    out = []
    for run in SIGNS.findall(text.lower()) if text else ():
        for w in (run,) if run.isalpha() else LETTERS.findall(run):
            if len(w) <= LONGEST_RUN:
                out.append(w)
            else:
                out += [w[i : i + LONGEST_RUN] for i in range(0, len(w), LONGEST_RUN)]
    return out


@dataclass
class Pieces:
    """Finds the pieces that a matrix of code points holds. Two slots a piece make every look-up two gathers."""

    pieces: list[str]

    def __post_init__(self):
        self.size = len(self.pieces)
        self.unknown, self.none = self.size, self.size + 1
        with np.errstate(over="ignore"):
            self.hashes = np.zeros(self.size + 2, dtype=np.uint64)
            for i, p in enumerate(self.pieces):
                h = np.uint64(len(p))
                for c in p:
                    h = h * BASE + np.uint64(ord(c))
                self.hashes[i] = h
        self.tables = [np.full(1 << 20, self.none, dtype=np.int32) for _ in range(4)]
        for i in range(self.size):
            for k, t in enumerate(self.tables):
                slot = self.slot(self.hashes[i : i + 1], k)[0]
                if t[slot] == self.none:
                    t[slot] = i
                    break
            else:
                raise ValueError("too many pieces for the tables")
        self.depth = 1 + max((k for k, t in enumerate(self.tables) if (t != self.none).any()), default=0)

    @staticmethod
    def slot(h, k):
        with np.errstate(over="ignore"):
            return ((h ^ (h >> np.uint64(29))) * np.uint64((0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)[k])) >> np.uint64(44)

    def find(self, h: np.ndarray) -> np.ndarray:
        out = self.tables[0][self.slot(h, 0)]
        bad = (self.hashes[out] != h) & (out != self.none)  # a piece is in a later table only if its slot here is taken
        out[bad] = self.none
        for k in range(1, self.depth):
            at = np.nonzero(bad)
            if not len(at[0]):
                break
            other = self.tables[k][self.slot(h[at], k)]
            right = self.hashes[other] == h[at]
            out[at] = np.where(right, other, out[at])
            bad[at] = ~right & (other != self.none)
        return out

    def spans(self, words: list[str]) -> dict[int, np.ndarray]:
        """For words of one length: length of piece -> ids (words x starts). Unknown single letters count as one piece."""
        n = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), n).astype(np.uint64)
        found = {}
        with np.errstate(over="ignore"):
            for size in range(1, min(LONGEST_PIECE, n) + 1):
                h = np.full((len(words), n - size + 1), np.uint64(size))
                for k in range(size):
                    h = h * BASE + codes[:, k : n - size + 1 + k]
                ids = self.find(h)
                if size == 1:
                    ids = np.where(ids == self.none, self.unknown, ids)
                found[size] = ids
        return found

    def forward(self, spans: dict[int, np.ndarray], p: np.ndarray, n: int, letter: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
        """alpha[j]: scaled probability of the first j letters over all segmentations, by word and language; and the log of the scale.

        With ``letter``, a factor for each letter of a word, that is the only scale.
        """
        u, g = len(spans[1]), p.shape[1]
        alpha, scale = [np.ones((u, g))], np.zeros((u, g))
        for j in range(1, n + 1):
            a = np.zeros((u, g))
            for size in range(1, min(LONGEST_PIECE, j) + 1):
                ids = spans[size][:, j - size]
                at = np.flatnonzero(ids != self.none)  # few of the longer spans are pieces
                if 2 * len(at) > u:
                    a += alpha[j - size] * p[ids] * (1 if letter is None else letter**size)
                elif len(at):
                    a[at] += alpha[j - size][at] * p[ids[at]] * (1 if letter is None else letter[at] ** size)
            alpha.append(a)
            if letter is None and j % 16 == 0:
                s = np.maximum(a, 1e-280)
                for k in range(max(0, j - LONGEST_PIECE), j + 1):
                    alpha[k] = alpha[k] / s
                scale += np.log(s)
        return alpha, scale

    def log_likelihood(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """words x languages."""
        out = np.zeros((len(words), p.shape[1]))
        for n, at in by_length(words):
            for k in range(0, len(at), 8192):
                part = at[k : k + 8192]
                alpha, scale = self.forward(self.spans([words[i] for i in part]), p, n)
                out[part] = np.log(np.maximum(alpha[n], 1e-300)) + scale
        return out

    def expected(self, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected pieces (pieces x languages) over all segmentations; counts: words x languages.

        The pieces of a long word are scaled by the letter, so that all its segmentations together have probability one.
        """
        out = np.zeros_like(p)
        for n, at in by_length(words):
            for k in range(0, len(at), 8192):
                part = at[k : k + 8192]
                spans, weight = self.spans([words[i] for i in part]), counts[part]
                letter = None
                if n > 15:
                    alpha, scale = self.forward(spans, p, n)
                    letter = np.exp(-(np.log(np.maximum(alpha[n], 1e-300)) + scale) / n)
                alpha, _ = self.forward(spans, p, n, letter)
                weight = weight / np.maximum(alpha[n], 1e-300)
                beta = [None] * n + [np.ones_like(weight)]
                held, masses = [], []
                for j in range(n - 1, -1, -1):
                    b = np.zeros_like(weight)
                    for size in range(1, min(LONGEST_PIECE, n - j) + 1):
                        ids = spans[size][:, j]
                        step = p[ids] * beta[j + size]
                        if letter is not None:
                            step *= letter**size
                        b += step
                        known = ids != self.none
                        held.append(ids[known])
                        masses.append((alpha[j] * step * weight)[known])
                    beta[j] = b
                at_cell = np.concatenate(held)[:, None] * p.shape[1] + np.arange(p.shape[1])
                out += np.bincount(at_cell.ravel(), np.concatenate(masses).ravel(), out.size).reshape(out.shape)
        out[self.none] = 0
        return out


def by_length(words):
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    return [(int(lengths[at[0]]), at) for at in np.split(order, cuts) if len(at)]


_tables: dict[bytes, Pieces] = {}


def table_of(pieces: list[str]) -> Pieces:
    key = hashlib.sha256("\n".join(pieces).encode()).digest()
    if key not in _tables:
        _tables[key] = Pieces(pieces)
    return _tables[key]


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[str]
    p: np.ndarray


def train_languages(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> LanguageModel:
    """Per-language piece probabilities by expectation maximisation over all segmentations of the words of a sample.

    The sample holds about ``sample_rows`` rows a language, by a hash of id and text, whole texts; rows with null language do not count.
    Words are counted by Spark; each round is one job over the counted words, and only sums per piece and
    language (bounded by the vocabulary) reach the driver. With no labelled row, the model knows no language.
    """
    spark = docs.sparkSession
    ship(spark)
    pieces = public_pieces(vocabulary)
    rows = docs.where(F.col(lang_col).isNotNull())
    sizes = rows.groupBy(F.col(lang_col).alias("lang")).count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r["lang"] for r in sizes]
    g = len(languages)
    if not g:
        return LanguageModel([], pieces, np.zeros((len(pieces) + 2, 0)))
    place = spark.createDataFrame([(r["lang"], i, min(1 << 30, int(sample_rows / r["count"] * (1 << 30)))) for i, r in enumerate(sizes)], "lang string, g int, below long")
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col), F.lit(3))
    sample = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.pmod(key, F.lit(1 << 30)).alias("h"))
    sample = sample.join(F.broadcast(place), "lang").where("h < below").select("g", "text")

    def split(batches):
        for batch in batches:
            for lang, text in zip(batch.column("g").to_pylist(), batch.column("text").to_pylist()):
                words, counts = np.unique(words_of(text), return_counts=True) if text else ((), ())
                if len(words):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.int32()), pa.array(words.tolist(), pa.string()), pa.array(counts, pa.int64())], ["g", "word", "n"])

    counted = sample.mapInArrow(split, "g int, word string, n long").groupBy("word").agg(*[F.sum(F.when(F.col("g") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(g)])
    counted = written(counted.select("word", F.array(*[f"n{i}" for i in range(g)]).alias("n")), "words")
    size = len(pieces) + 2
    p = np.full((size, g), 1 / (size - 1))
    p[-1] = 0
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((pieces, p))

        def step(batches, sent=sent):
            names, now = sent.value
            total, words, counts = np.zeros_like(now), [], []
            for batch in batches:
                words += ["▁" + w for w in batch.column("word").to_pylist()]
                counts += batch.column("n").to_pylist()
                if len(words) >= 20_000:
                    total += table_of(names).expected(words, np.array(counts, dtype=float), now)
                    words, counts = [], []
            if words:
                total += table_of(names).expected(words, np.array(counts, dtype=float), now)
            at, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[at, lang], pa.float64())], ["piece", "g", "n"])

        sums = counted.mapInArrow(step, "piece int, g int, n double").groupBy("piece", "g").agg(F.sum("n").alias("n")).collect()
        new = np.full((size, g), 0.01)
        for r in sums:
            new[r["piece"], r["g"]] += r["n"]
        new[-1] = 0
        p = new / new.sum(axis=0)
        sent.unpersist()
    return LanguageModel(languages, pieces, p)


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row: the language whose model gives the text the highest probability, summed
    over all segmentations of its words, and its posterior under equal priors (ties: first by name).

    ``und`` with score 0 if the text is null or has no letter, or no language is known. One pass without shuffle; the model is
    bounded by vocabulary times languages. Repeated rows and null ids each get a row.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        known = sent.value
        table, g = table_of(known.pieces), len(known.languages)
        cache: dict[str, int] = {}
        scores = np.zeros((CACHE_WORDS, g))
        for batch in batches:
            texts = [words_of(t) if g else [] for t in batch.column("_text").to_pylist()]
            langs, best = [None] * len(texts), [0.0] * len(texts)
            at = 0
            while at < len(texts):  # as many texts at once as bring a fair number of new words
                fresh: dict[str, None] = {}
                end = at
                while end < len(texts) and (end == at or len(fresh) < 20_000):
                    fresh.update(dict.fromkeys(w for w in texts[end] if w not in cache))
                    end += 1
                new = list(fresh)
                if len(cache) + len(new) > CACHE_WORDS:
                    cache.clear()
                    new = list(dict.fromkeys(w for t in texts[at:end] for w in t))
                if len(new) > len(scores):
                    scores = np.zeros((len(new), g))
                if new:
                    first = len(cache)
                    scores[first : first + len(new)] = table.log_likelihood(["▁" + w for w in new], known.p)
                    cache.update(zip(new, range(first, first + len(new))))
                for i in range(at, end):
                    if not texts[i]:
                        langs[i] = "und"
                        continue
                    total = scores[np.fromiter(map(cache.__getitem__, texts[i]), dtype=np.int64, count=len(texts[i]))].sum(axis=0)
                    k = int(np.argmax(total))
                    langs[i], best[i] = known.languages[k], float(1 / np.exp(total - total[k]).sum())
                at = end
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(best, pa.float64())], ["doc_id", "lang_pred", "score"])

    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    return kept.mapInArrow(run, f"doc_id {dict(kept.dtypes)['doc_id']}, lang_pred string, score double")


def judged_languages(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Predict every document; rows whose crc32(doc_id) mod 4 is 2 are never learnt from."""
    held = F.coalesce(bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train_languages(docs.where(~held), vocabulary)
    return predict_languages(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
