import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import ROWS, awkward
from inkgrain.llm.bpe import Encoder, decode_documents, encode_documents
from inkgrain.llm.packing import digest, hilbert, pack, token_ids

WORD, BYTE, RANKS = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))


def test_encoder_equals_the_library():
    mine, lib, rng = Encoder(WORD), Tokenizer.from_file(WORD), random.Random(2)
    letters = "aaabcdeeefghiijklmnooprstuuvwxyzé0123.,-'\" \n\t"
    tokens = [t.replace("</w>", "") for t in lib.get_vocab()]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 20))) for _ in range(4000)]
    texts += ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 4))) for _ in range(4000)]
    texts += [f"a{chr(c)}B{chr(c)}" for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    texts += ["<|endoftext|>a<|startoftext|>", "<|endoftext|", "x" * 3000, "ab" * 2000, "日本語" * 50, "Σας ΣΑΣ İ"]
    for text, want in zip(texts, lib.encode_batch(texts, add_special_tokens=False)):
        ids = mine.encode(text)
        assert ids.tolist() == want.ids, text
        assert mine.decode(ids).decode() == lib.decode(want.ids, skip_special_tokens=False)


def test_encode_and_decode_documents(spark):
    lib = Tokenizer.from_file(WORD)
    coded = encode_documents(awkward(spark), WORD, columns=("ids", "decoded", "n_tokens"))
    got = sorted(map(tuple, coded.collect()), key=str)
    want = []
    for d, t, _ in ROWS:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((d, ids, lib.decode(ids, skip_special_tokens=False), len(ids)))
    assert got == sorted(want, key=str)
    back = decode_documents(coded.select("doc_id", "ids"), WORD).collect()
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in back) == sorted((w[0] or 0, w[2]) for w in want)
    assert encode_documents(awkward(spark, []), WORD).count() == 0


def test_hilbert_neighbours():
    size = 1 << 4
    grid = np.array([(x, y) for x in range(size) for y in range(size)])
    order = grid[np.argsort(hilbert(grid, 4))]
    assert sorted(hilbert(grid, 4)) == list(range(size * size))
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_ids_equal_the_library(spark, sf):
    lib = Tokenizer.from_file(BYTE)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + [t or "" for _, t, _ in ROWS] + ["a" * 5000, "\u3000\u00a0 x"]
    for text, want in zip(texts, lib.encode_batch(texts, add_special_tokens=False)):
        assert token_ids(text, RANKS).tolist() == want.ids


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" + "\n" * 1_000_000 + "b c", "x " + "\t " * 500_000])
def test_very_long_blanks_have_the_ids_of_the_library(text):
    assert token_ids(text, RANKS).tolist() == Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False).ids


def test_pack_takes_very_long_blanks(spark):
    text = "a" + " " * 1_000_000 + "b"
    rows = digest(pack(spark.createDataFrame([(1, text), (3, "x")], "doc_id long, text string"), RANKS)).collect()
    check_pieces(rows, {1: text, 3: "x"}, 1024)


def check_pieces(rows, texts, length):
    lib = Tokenizer.from_file(BYTE)
    docs = {}
    for r in rows:
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    total = 0
    for (d, n), pieces in docs.items():
        if d is None or d == 2:  # rows that share an id
            continue
        ids = lib.encode(texts[d] or "", add_special_tokens=False).ids + [0]
        assert n == len(ids)
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], dtype="<u4").tobytes())
            at += p["length"]
        assert at == n
    sequences = {}
    for r in rows:
        total += r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(-(-total // length)))
    for s, parts in sequences.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or s == max(sequences)


def test_pack(spark):
    rows = digest(pack(awkward(spark).repartition(5, "text"), RANKS, length=64)).collect()
    check_pieces(rows, {d: t for d, t, _ in ROWS}, 64)
    assert sum(r["start"] == 0 for r in rows) == len(ROWS)
    assert pack(awkward(spark, []), RANKS).count() == 0


def test_copies_lie_together_and_a_hot_text_splits(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text here")).otherwise(F.concat_ws(" ", F.md5(F.col("id").cast("string")), F.lit("x"))).alias("text"))
    rows = pack(docs, RANKS).collect()
    places = sorted(r["sequence_id"] * 1024 + r["offset"] for r in rows if r["doc_id"] % 3 == 0 and r["start"] == 0)
    assert places[-1] - places[0] < 3000 * 4
