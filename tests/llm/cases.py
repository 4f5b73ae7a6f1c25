"""Tables with every awkward row, and plain definitions to compare with."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
PLAIN = "the quick brown fox jumps over the lazy dog and runs far away from the old barn near the river"

ROWS = [
    (1, PLAIN, "en"),
    (2, PLAIN, "en"),
    (2, PLAIN, "en"),  # a repeated row
    (3, PLAIN.replace(" ", "  "), "en"),
    (4, "", "en"),
    (5, None, None),
    (6, " \t\n", "de"),
    (7, LONG, "en"),
    (8, LONG + " end", "en"),
    (None, PLAIN, "en"),
    (None, None, None),
    (9, "12345 !!! ???", "fr"),
    (10, "Straße Ünïcode \u00a0 日本語 \U0001f600 <|endoftext|> İΣ", "de"),
    (11, "x", "en"),
]


def awkward(spark, rows=ROWS):
    """Extra columns carry names that an operator might use itself."""
    clash = "row _row node key score n sha kept text_hash found band value packed place part word bits lang_pred predicted _id _text _t".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in clash)
    full = [(d, t, g, "s", len(t) if t is not None else None, *clash) for d, t, g in rows]
    return spark.createDataFrame(full, schema)


def bare(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def union_find(nodes, edges):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}
