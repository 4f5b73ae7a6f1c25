"""Byte-pair encoding by backtracking over longest matches, and decoding by offset tables."""

from __future__ import annotations

import hashlib
import json
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.llm.shared import ship

CACHE_WORDS = 250_000
CACHE_PAIRS = 400_000
END = "</w>"
#: Characters outside these long-settled ranges are split by the tokenizers library itself, as Unicode versions differ.
SETTLED = regex.compile(r"[^\x00-\u024F\u0386-\u03CE\u0400-\u045F\u2010-\u2027\u2030-\u205E\u20AC\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3]")
#: The last symbol of a word is another symbol than the same byte inside it.
LAST = 0x400


class OffsetTable:
    """Concatenated byte strings, and where each one starts; joins any list of them without a loop."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(s) for s in strings], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.bytes = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        ends = np.cumsum(size)
        if not len(ends):
            return b""
        return self.bytes[np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1])].tobytes()


class Encoder:
    """Encodes as the tokenizer file says: NFC, lower case, words by pattern, byte symbols, merges by rank, ends of words.

    In every word an Aho-Corasick automaton finds the tokens that start at each place. The longest is taken if it is
    compatible with the token before (if the two, encoded together, stay these two); else the next shorter; if none fits, the
    place is marked and the token before is taken back. Compatible neighbours everywhere are exactly what merging gives.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        # rank of a token: -1 for single symbols, else the place of its merge; a token is named by its id
        self.rank = {i: -1 for i in vocab.values()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            whole = vocab[(a.removesuffix(END) if a.endswith(END) else a) + b]
            self.merged[vocab[a], vocab[b]] = (rank, whole)
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = (vocab[a], vocab[b]), rank
        self.pairs: dict[tuple[int, int], bool] = {}
        size = max(max(vocab.values()), *self.special.values(), 0) + 1
        self.length, self.shorter = [0] * size, [-1] * size
        by_symbols: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        reachable = {}
        for token, i in sorted(vocab.items(), key=lambda x: self.rank[x[1]]):
            if i in self.special.values():
                continue
            symbols = token.removesuffix(END)
            if token.endswith(END) and symbols:
                symbols = symbols[:-1] + chr(ord(symbols[-1]) + LAST)
            else:
                symbols = token
            left_right = self.parts.get(i)
            reachable[i] = left_right is None or (reachable[left_right[0]] and reachable[left_right[1]] and self.stays(*left_right, self.rank[i]))
            if reachable[i]:
                self.length[i] = len(symbols)
                by_symbols[symbols] = i
                self.automaton.add_word(symbols, i)
        for symbols, i in by_symbols.items():  # the longest token that is a proper beginning of each
            self.shorter[i] = next((by_symbols[symbols[:k]] for k in range(len(symbols) - 1, 0, -1) if symbols[:k] in by_symbols), -1)
        self.automaton.make_automaton()
        self.byte_char = byte_symbols()
        self.to_symbols = {i: c for i, c in enumerate(self.byte_char)}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        names = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.names = OffsetTable([(names.get(i, "") + " ").encode() for i in range(size)])
        self.decimals = OffsetTable([f"{i} ".encode() for i in range(size)])
        self.wide = size > 1 << 16
        self.splitter = tokenizers.Tokenizer.from_file(path)

    def stays(self, left: int, right: int, limit: int | None = None) -> bool:
        """Whether no merge crosses the border of two neighbouring tokens before merge ``limit``.

        Undo the merges next to the border, the latest first. Of the same merge on both sides the left one is done first, so
        a merge across the border must come strictly before the left piece's own and not after the right piece's.
        """
        before = float("inf") if limit is None else limit
        while True:
            across = self.merged.get((left, right))
            if across is not None and across[0] < before:
                return False
            a, b = self.rank[left], self.rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                before, left = a, self.parts[left][1]
            else:
                before, right = b + 1, self.parts[right][0]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.stays(left, right)
        return known

    def encode_symbols(self, symbols: str) -> list[int]:
        n, length, shorter, pairs = len(symbols), self.length, self.shorter, self.pairs
        longest = [0] * n
        for last, token in self.automaton.iter(symbols):
            longest[last + 1 - length[token]] = token  # matches come by their end, so the longest stays
        out: list[int] = []
        dead = bytearray(n + 1)
        at, before, token = 0, -1, longest[0]
        while True:
            while token >= 0:
                end = at + length[token]
                if not dead[end]:
                    if before < 0:
                        break
                    fits = pairs.get((before, token))
                    if fits is None:
                        fits = self.compatible(before, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at, before, token = end, token, longest[end]
            else:
                dead[at] = 1
                taken = out.pop()
                at -= length[taken]
                before, token = out[-1] if out else -1, shorter[taken]

    def word(self, word: str) -> bytes:
        return self.symbols(word.encode("utf-8").decode("latin-1").translate(self.to_symbols))

    def symbols(self, symbols: str) -> bytes:
        ids = self.encode_symbols(symbols[:-1] + chr(ord(symbols[-1]) + LAST))
        return np.array(ids, dtype="<u4" if self.wide else "<u2").tobytes()

    def plain(self, text: str) -> bytes:
        if not text.isascii():
            if SETTLED.search(text):
                words = self.splitter.pre_tokenizer.pre_tokenize_str(self.splitter.normalizer.normalize_str(text))
                return b"".join([self.symbols(w) for w, _ in words])
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        words = self.pattern.findall(text.lower())
        cache, out = self.cache, []
        for w in words:
            ids = cache.get(w)
            if ids is None:
                ids = self.older.get(w)
                if ids is None:
                    ids = self.word(w)
                if len(w) <= 64:
                    if len(cache) >= CACHE_WORDS:
                        self.older = cache
                        cache = self.cache = {}
                    cache[w] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; the strings of special tokens are those tokens."""
        if not text:
            return np.empty(0, dtype=np.int64)
        kind = "<u4" if self.wide else "<u2"
        if self.cut is None or "<|" not in text:
            raw = self.plain(text)
        else:
            raw = b"".join(np.array([self.special[s]], dtype=kind).tobytes() if s in self.special else self.plain(s) for s in self.cut.split(text) if s)
        return np.frombuffer(raw, dtype=kind).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """Tokens joined by one blank, which is what a tokenizer file without a decoder gives."""
        return self.names.join(ids)[:-1]

    def decimal(self, ids: np.ndarray) -> bytes:
        return self.decimals.join(ids)[:-1]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [], 0x100
    for b in range(256):
        if b in printable:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


KINDS = {
    "ids": ("array<int>", pa.list_(pa.int32()), lambda e, x: x.astype(np.int32)),
    "decoded": ("string", pa.string(), lambda e, x: e.decode(x).decode()),
    "n_tokens": ("long", pa.int64(), lambda e, x: len(x)),
    "ids_sha256": ("string", pa.string(), lambda e, x: hashlib.sha256(e.decimal(x)).hexdigest()),
    "decoded_sha256": ("string", pa.string(), lambda e, x: hashlib.sha256(e.decode(x)).hexdigest()),
}


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``doc_id`` and the named columns of every row: ids, their decoded text, their number, or SHA-256 digests of both.

    One pass without shuffle; an executor's worker holds the tables of the vocabulary and a bounded cache of words. Null and empty
    texts have no ids. Repeated rows and null ids each get a row.
    """
    ship(docs.sparkSession)
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))

    def run(batches):
        coder = encoder(vocabulary)
        for batch in batches:
            out: list[list] = [[] for _ in columns]
            for text in batch.column("_text").to_pylist():
                ids = coder.encode(text)
                for values, name in zip(out, columns):
                    values.append(KINDS[name][2](coder, ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, KINDS[c][1]) for v, c in zip(out, columns))], ["doc_id", *columns])

    schema = ", ".join([f"doc_id {dict(kept.dtypes)['doc_id']}", *(f"{c} {KINDS[c][0]}" for c in columns)])
    return kept.mapInArrow(run, schema)


def decode_documents(coded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, decoded`` from arrays of ids; null decodes to the empty text."""
    ship(coded.sparkSession)
    kept = coded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("_ids"))

    def run(batches):
        coder = encoder(vocabulary)
        for batch in batches:
            texts = [coder.decode(np.array(x or [], dtype=np.int64)).decode() for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return kept.mapInArrow(run, f"doc_id {dict(kept.dtypes)['doc_id']}, decoded string")
