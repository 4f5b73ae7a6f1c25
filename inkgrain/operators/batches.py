"""Per-text work on Arrow batches: character and word n-grams counted and weighted, word vectors pooled.

Spark cleans, splits and deals the texts and joins, groups and ranks what comes out. A task turns each different token of a batch into
numbers once and counts whole batches in numpy, so that no text becomes thousands of rows before it is summed up.
Functions sent to tasks are closures: executors need no copy of this package.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgrain.operators.store import write_table

#: Texts counted at once.
TEXTS_AT_ONCE = 64
#: Texts whose words are counted at once.
WORD_TEXTS_AT_ONCE = 1024
#: Bits of a word in the code of a word n-gram.
WORD_BITS = 31
#: Bytes that a word of a vocabulary takes in a task, and an n-gram.
WORD_BYTES, GRAM_BYTES = 200, 12
#: Different n-grams that a task holds before it passes its counts on and starts anew.
HELD_TERMS = 1 << 21
#: Bits that all characters of an n-gram share in its code; the other bits of a key are the place of its text.
CODE_BITS = 56
#: Rows of an Arrow batch that a task gives back.
ROWS_AT_ONCE = 1 << 16
#: Weights of the terms of a text that have a slot.
FOUND = "array<struct<idx: int, __w: double>>"


def split_repeats(texts: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose id occurs once, and the others or ``None``. Null ids are equal to each other, as in a grouping."""
    often = write_table(texts.groupBy(id_col).count().where("count > 1").select(F.col(id_col).alias("__often")), "repeats")
    if often.isEmpty():
        return texts, None
    same = F.col(id_col).eqNullSafe(F.col("__often"))
    return texts.join(often, same, "left_anti"), texts.join(often, same, "left_semi")


def codable(lo: int, hi: int) -> bool:
    """Whether n-grams of these sizes fit into a code with an alphabet of a hundred characters or more. Padded tokens have at least three
    characters and share the blank between them, so the shortest n-gram has three."""
    return lo == 3 <= hi <= 8


def _counter(lo: int, hi: int):
    """``count(texts, alphabet) -> (row, code, tf)`` in their order: the n-grams inside the tokens of folded texts.

    ``alphabet`` maps code points to numbers below ``2 ** (CODE_BITS // hi)``, the blank to 1 and those that do not count to 0; a code is the numbers
    of its characters, the first one lowest.
    """
    bits = CODE_BITS // hi

    def count(texts, alphabet):
        points = np.frombuffer((" " + "  ".join(texts) + " ").encode("utf-32-le"), dtype="<u4")
        c = alphabet[points].astype(np.int64)
        row = np.repeat(np.arange(len(texts)), np.array([len(t) + 2 for t in texts]))
        blank, code, right, keys = c == 1, c, c > 0, []
        for n in range(2, hi + 1):
            m = max(len(c) - n + 1, 0)
            code = code[:m] | (c[n - 1 :] << (bits * (n - 1)))
            right = right[:m] & (c[n - 1 :] > 0)
            if n > 2:  # a blank is only the first or the last character
                right &= ~blank[n - 2 : n - 2 + m]
            if n >= lo:
                at = np.flatnonzero(right)
                keys.append((row[at] << CODE_BITS) | code[at])
        key = np.concatenate(keys)
        key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        return key[first] >> CODE_BITS, key[first] & ((1 << CODE_BITS) - 1), np.diff(first, append=len(key))

    return count


def _merger():
    """``merged(parts)``: parts ``[keys, *values]`` added up by key, in the order of keys."""

    def merged(parts):
        keys, *values = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return [keys[first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)]

    return merged


def _spelled(bits: int, lo: int, hi: int):
    """``spelled(codes, letters)``: the n-grams of codes, by the characters that have the numbers."""

    def spelled(codes, letters):
        digits, out = [(codes >> (bits * k)) & ((1 << bits) - 1) for k in range(hi)], np.empty(len(codes), dtype=object)
        for size in range(lo, hi + 1):
            at = np.flatnonzero((digits[size - 1] > 0) & (digits[size] == 0 if size < hi else True))
            joined = np.column_stack([letters[d[at]] for d in digits[:size]]).tobytes().decode("utf-32-le")
            out[at] = [joined[i : i + size] for i in range(0, len(joined), size)]
        return out

    return spelled


def char_totals(texts: DataFrame, text_col: str, lo: int, hi: int, group_col: str | None = None) -> DataFrame:
    """``(term, n, docs)``: how often each n-gram of the folded texts occurs, and in how many rows; with ``group_col (term, group, n, docs)``, the rows
    of each group by themselves. Tasks sum up before they shuffle."""
    count, bits = _counter(lo, hi), CODE_BITS // hi
    merged, spelled = _merger(), _spelled(bits, lo, hi)
    kind = dict(texts.dtypes)[group_col] if group_col else ""

    def plain(text):
        """A text with more characters than a code has room for."""
        total = {}
        for token in text.split(" ") if text else ():
            padded = f" {token} "
            for n in range(lo, min(hi, len(padded)) + 1):
                for i in range(len(padded) - n + 1):
                    total[padded[i : i + n]] = total.get(padded[i : i + n], 0) + 1
        return total

    def rows(group, names, n, docs):
        for at in range(0, len(names), ROWS_AT_ONCE):
            cut = slice(at, at + ROWS_AT_ONCE)
            columns = {"term": pa.array(names[cut], pa.string()), "n": pa.array(n[cut], pa.int64()), "docs": pa.array(docs[cut], pa.int64())}
            if group_col:
                columns[group_col] = pa.nulls(len(columns["term"]), group[1]) if group[0] is None else pa.array([group[0]] * len(columns["term"]), group[1])
            yield pa.RecordBatch.from_pydict(columns)

    def run(batches):
        # group -> what was summed up, and what came since
        alphabet, letters, held = np.zeros(0x110000, dtype=np.int32), [0, 32], {}
        alphabet[32] = 1

        def told(group):
            total, fresh = held.pop(group)
            if fresh or total:
                codes, n, docs = merged(fresh + ([total] if total else []))
                yield from rows(group, spelled(codes, np.array(letters, dtype="<u4")), n, docs)

        for batch in batches:
            every, groups = batch.column(0).to_pylist(), batch.column(1).to_pylist() if group_col else [0] * len(batch)
            of = batch.schema.field(1).type if group_col else None
            parts = {}
            for text, group in zip(every, groups):
                parts.setdefault((group, of), []).append(text)
            for group, texts in parts.items():
                for at in range(0, len(texts), TEXTS_AT_ONCE):
                    some = texts[at : at + TEXTS_AT_ONCE]
                    seen = np.unique(np.frombuffer("".join(some).encode("utf-32-le"), dtype="<u4"))
                    new = seen[alphabet[seen] == 0]
                    if len(letters) + len(new) >= 1 << bits:
                        for other in list(held):
                            yield from told(other)
                        alphabet[:], letters = 0, [0, 32]
                        alphabet[32], new = 1, seen[seen != 32]
                        if len(letters) + len(new) >= 1 << bits:
                            for text in some:
                                found = plain(text)
                                yield from rows(group, list(found), list(found.values()), [1] * len(found))
                            continue
                    alphabet[new] = np.arange(len(letters), len(letters) + len(new))
                    letters += new.tolist()
                    _, code, tf = count(some, alphabet)
                    total, fresh = held.setdefault(group, (None, []))
                    fresh.append([code, tf, np.ones(len(code), dtype=np.int64)])
                    if sum(len(x[0]) for x in fresh) > HELD_TERMS:
                        total, fresh = merged(fresh + ([total] if total else [])), []
                        held[group] = total, fresh
                        if len(total[0]) > HELD_TERMS:
                            yield from told(group)
        for group in list(held):
            yield from told(group)

    groups = [group_col] if group_col else []
    found = texts.select(text_col, *groups).mapInArrow(run, ", ".join(["term string", "n long", "docs long", *[f"`{group_col}` {kind}"] * len(groups)]))
    return found.groupBy("term", *groups).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def word_totals(texts: DataFrame, words_col: str, lo: int, hi: int, group_col: str | None = None) -> DataFrame:
    """``(term, docs)``, or ``(term, group, docs)``: in how many rows each word or pair of words of the arrays is. Tasks sum up before they shuffle."""
    merged, low = _merger(), (1 << WORD_BITS) - 1
    kind = dict(texts.dtypes)[group_col] if group_col else ""

    def run(batches):
        number, held = {}, {}

        def told(group, words):
            total, fresh = held.pop(group)
            if not (fresh or total):
                return
            codes, docs = merged(fresh + ([total] if total else []))
            for at in range(0, len(codes), ROWS_AT_ONCE):
                code = codes[at : at + ROWS_AT_ONCE]
                first, last = words.take(pa.array(code >> WORD_BITS)), words.take(pa.array(code & low))
                columns = {"term": pc.binary_join_element_wise(first, last, " ", null_handling="skip"), "docs": pa.array(docs[at : at + ROWS_AT_ONCE])}
                if group_col:
                    columns[group_col] = pa.nulls(len(code), group[1]) if group[0] is None else pa.array([group[0]] * len(code), group[1])
                yield pa.RecordBatch.from_pydict(columns)

        def all_told():
            words = pa.array([None, *number], pa.string())
            for group in list(held):
                yield from told(group, words)

        for batch in batches:
            of = batch.schema.field(1).type if group_col else None
            for at in range(0, len(batch), WORD_TEXTS_AT_ONCE):
                part = batch.slice(at, WORD_TEXTS_AT_ONCE)
                lists = part.column(0)
                flat = lists.flatten().dictionary_encode()
                place = np.array([number.setdefault(w, len(number) + 1) for w in flat.dictionary.to_pylist()], dtype=np.int64)
                place = place[flat.indices.to_numpy()]
                row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
                codes = [(row, place)] if lo == 1 else []
                if hi == 2:
                    two = np.flatnonzero(row[1:] == row[:-1])
                    codes.append((row[two], (place[two] << WORD_BITS) | place[two + 1]))
                row, code = (np.concatenate(x) for x in zip(*codes))
                each, back = np.unique(code, return_inverse=True)
                key = np.unique((row << 32) | back)  # a term counts once a row
                row, code = key >> 32, each[key & ((1 << 32) - 1)]
                groups = part.column(1).to_pylist() if group_col else [0] * len(part)
                names = {g: i for i, g in enumerate(dict.fromkeys(groups))}
                owner = np.array([names[g] for g in groups], dtype=np.int64)[row]
                for g, i in names.items():
                    total, fresh = held.setdefault((g, of), (None, []))
                    mine = code[owner == i]
                    fresh.append([mine, np.ones(len(mine), dtype=np.int64)])
                    if sum(len(x[0]) for x in fresh) > HELD_TERMS:
                        held[g, of] = merged(fresh + ([total] if total else [])), []
                if len(number) > HELD_TERMS or sum(len(total[0]) for total, _ in held.values() if total) > 2 * HELD_TERMS:
                    yield from all_told()
                    number.clear()
        yield from all_told()

    groups = [group_col] if group_col else []
    found = texts.select(words_col, *groups).mapInArrow(run, ", ".join(["term string", "docs long", *[f"`{group_col}` {kind}"] * len(groups)]))
    return found.groupBy("term", *groups).agg(F.sum("docs").alias("docs"))


def char_lists(rows: DataFrame, keys, text_col: str, lo: int, hi: int) -> DataFrame:
    """``(*keys, terms)``: one row a text with the array of its ``(term, tf)``."""
    keys = list(keys)

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                texts = part.column(len(keys)).to_pylist()
                # every different token once, then every different n-gram once; both by their place in the batch
                words = {}
                codes = [[words.setdefault(w, len(words)) for w in t.split(" ")] if t else [] for t in texts]
                place, each = {}, []
                for w in words:
                    padded = f" {w} "
                    grams = [padded[i : i + n] for n in range(lo, min(hi, len(padded)) + 1) for i in range(len(padded) - n + 1)]
                    each.append([place.setdefault(g, len(place)) for g in grams])
                flat = [np.array([g for c in some for g in each[c]], dtype=np.int64) for some in codes]
                key = np.concatenate([(i << 40) | x for i, x in enumerate(flat)])
                key.sort()
                first = np.flatnonzero(np.diff(key, prepend=-1))
                ends = pa.array(np.searchsorted(key[first] >> 40, np.arange(len(part) + 1)).astype(np.int32))
                terms = pa.array(list(place), pa.string()).take(pa.array(key[first] & ((1 << 40) - 1)))
                entries = pa.StructArray.from_arrays([terms, pa.array(np.diff(first, append=len(key)))], ["term", "tf"])
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], pa.ListArray.from_arrays(ends, entries)], [*keys, "terms"])

    return rows.select(*keys, text_col).mapInArrow(run, f"{_schema(rows, keys)}, terms array<struct<term: string, tf: long>>")


class Coded:
    """A vocabulary as codes that a task can hold.

    ``held`` goes to the tasks, once: the sorted ``codes``, and what belongs to them in the same order; its place in there is the number of a term. ``entries(listed)``
    gives the function ``(column, held) -> (row, number, tf)`` for texts, or (``listed``) for counted ones, ``names(numbers, held)`` are the terms,
    and ``codes_of(terms)`` are below 0 for those that have no code.
    """

    def __init__(self, spark: SparkSession, held: dict, entries, names, codes_of, at_once: int):
        self.entries, self.names, self.at_once = entries, names, at_once
        self.sent, self._codes, self._codes_of = spark.sparkContext.broadcast(held), held["codes"], codes_of

    def numbers(self, terms) -> np.ndarray:
        """The numbers of terms, below 0 for those that the vocabulary has not."""
        code = self._codes_of(list(terms))
        at = np.minimum(np.searchsorted(self._codes, code), len(self._codes) - 1)
        return np.where(self._codes[at] == code, at, -1)


def _points(terms: pa.Array):
    """Code points and lengths of an array of strings, without an object for each."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms), "")[0].as_py() if len(terms) else ""
    return np.frombuffer(joined.encode("utf-32-le"), dtype="<u4"), pc.utf8_length(terms).to_numpy().astype(np.int64)


def _char_entries(lo: int, hi: int):
    def make(listed: bool):
        count, bits = _counter(lo, hi), CODE_BITS // hi

        def counted(lists, alphabet):
            """``(row, code, tf)`` of counted texts; terms with a character that the vocabulary has not have no code."""
            entries = lists.flatten()
            coded = entries.field("term").dictionary_encode()
            names = coded.dictionary.to_pylist()
            sizes = np.array([len(x) for x in names], dtype=np.int64)
            c = alphabet[np.frombuffer("".join(names).encode("utf-32-le"), dtype="<u4")].astype(np.int64)
            owner, starts = np.repeat(np.arange(len(names)), sizes), np.cumsum(sizes) - sizes
            code = np.zeros(len(names), dtype=np.int64)
            np.add.at(code, owner, c << (bits * (np.arange(len(c)) - starts[owner])))
            code[owner[c == 0]] = -1
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            return row, code[coded.indices.to_numpy()], entries.field("tf").to_numpy()

        def entries(column, held):
            codes = held["codes"]
            row, code, tf = counted(column, held["alphabet"]) if listed else count(column.to_pylist(), held["alphabet"])
            gram = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            known = np.flatnonzero(codes[gram] == code)
            return row[known], gram[known], tf[known]

        return entries

    return make


def coded_vocabulary(vocabulary: DataFrame, lo: int, hi: int, column: str = "idf") -> Coded | None:
    """A vocabulary of n-grams with its ``idf`` (or the array in another column) as codes, or ``None`` if its characters are too many for a code."""
    bits = CODE_BITS // hi
    table = vocabulary.select("term", column).where(F.length("term") <= hi).toArrow().combine_chunks()
    if not len(table):
        return None
    letters, sizes = _points(table.column("term").chunk(0))
    points = np.unique(letters)
    points = points[points != 32]
    if len(points) + 2 > 1 << bits:
        return None
    alphabet = np.zeros(0x110000, dtype=np.int32)
    alphabet[32], alphabet[points] = 1, np.arange(2, len(points) + 2)
    codes, starts = np.zeros(len(sizes), dtype=np.int64), np.cumsum(sizes) - sizes
    for k in range(hi):
        at = np.flatnonzero(sizes > k)
        codes[at] |= alphabet[letters[starts[at] + k]].astype(np.int64) << (bits * k)
    order = np.argsort(codes)
    values = table.column(column).chunk(0).take(pa.array(order))
    held = {"codes": codes[order], "alphabet": alphabet, "letters": np.concatenate([[0, 32], points]).astype("<u4"), **_valued(values)}
    spelled = _spelled(bits, lo, hi)

    def codes_of(terms):
        each = [alphabet[[ord(x) for x in t]].tolist() if 0 < len(t) <= hi else [0] for t in terms]
        return np.array([sum(x << (bits * k) for k, x in enumerate(c)) if all(c) else -1 for c in each], dtype=np.int64)

    names = lambda n, held: pa.array(spelled(held["codes"][n], held["letters"]), pa.string())
    return Coded(vocabulary.sparkSession, held, _char_entries(lo, hi), names, codes_of, TEXTS_AT_ONCE)


def _valued(values: pa.Array) -> dict:
    """``idf[which]`` for numbers, ``docs`` with a row a term for arrays."""
    if pa.types.is_list(values.type):
        return {"docs": values.flatten().to_numpy().reshape(len(values), -1).astype(np.int32)}
    idf, which = np.unique(values.to_numpy(), return_inverse=True)
    return {"idf": idf, "which": which.astype(np.min_scalar_type(len(idf)))}


def _schema(rows: DataFrame, names) -> str:
    types = dict(rows.dtypes)
    return ", ".join(f"`{c}` {types[c]}" for c in names)


def _weighed(nested: bool) -> str:
    return f"found {FOUND}" if nested else "term string, tf long, weight double"


def weigher(coded: Coded, keys, slots: DataFrame | None = None, listed: bool = False):
    """The function that weighs batches of the keys and then the text, or (``listed``) its ``(term, tf)``: each row is scaled to length 1 over the whole vocabulary.

    Without ``slots (term, idx)`` it gives the rows of all terms, else one row a text with the ``(idx, weight)`` of those that have a slot.
    """
    keys, entries, names, sent, at_once = list(keys), coded.entries(listed), coded.names, coded.sent, coded.at_once
    asked = idx = None
    if slots is not None:
        picked = {r["term"]: r["idx"] for r in slots.select("term", "idx").collect()}
        asked, idx = coded.numbers(picked), np.array(list(picked.values()), dtype=np.int32)
        asked, idx = asked[asked >= 0], idx[asked >= 0]
        order = np.argsort(asked)
        asked, idx = asked[order], idx[order]

    def weighted(batches):
        held = sent.value
        for batch in batches:
            for at in range(0, len(batch), at_once):
                part = batch.slice(at, at_once)
                row, gram, tf = entries(part.column(len(keys)), held)
                w = (1 + np.log(tf)) * held["idf"][held["which"][gram]]
                w /= np.sqrt(np.bincount(row, w * w, len(part)))[row]
                if asked is not None:
                    place = np.minimum(np.searchsorted(asked, gram), max(len(asked) - 1, 0))
                    kept = np.flatnonzero(asked[place] == gram) if len(asked) else np.zeros(0, dtype=np.int64)
                    slot = idx[place[kept]]
                    order = np.lexsort((slot, row[kept]))
                    kept, slot = kept[order], slot[order]
                    ends = np.searchsorted(row[kept], np.arange(len(part) + 1)).astype(np.int32)
                    found = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(slot), pa.array(w[kept])], ["idx", "__w"]))
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], found], [*keys, "found"])
                    continue
                for cut in range(0, len(row), ROWS_AT_ONCE):
                    some = slice(cut, cut + ROWS_AT_ONCE)
                    taken = part.select(keys).take(pa.array(row[some]))
                    columns = [*taken.columns, names(gram[some], held), pa.array(tf[some].astype(np.int64)), pa.array(w[some])]
                    yield pa.RecordBatch.from_arrays(columns, [*keys, "term", "tf", "weight"])

    return weighted


def weights(rows: DataFrame, keys, column: str, coded: Coded, slots: DataFrame | None = None) -> DataFrame:
    """TF-IDF of folded texts, or of the arrays of their ``(term, tf)``.

    ``(*keys, term, tf, weight)`` of the vocabulary's terms; with ``slots (term, idx)``, one row a text instead: ``(*keys, found)`` with the array of
    ``(idx, weight)`` in the order of ``idx``.
    """
    keys = list(keys)
    weighted = weigher(coded, keys, slots, _is_listed(rows, column))
    return rows.select(*keys, column).mapInArrow(weighted, f"{_schema(rows, keys)}, {_weighed(slots is not None)}")


def _is_listed(rows: DataFrame, column: str) -> bool:
    kind = rows.schema[column].dataType
    return kind.typeName() == "array" and kind.elementType.typeName() == "struct"


def class_sums(rows: DataFrame, label_col: str, column: str, coded: Coded) -> DataFrame:
    """``(term, label, o)``: the weights of the terms (:func:`weights`) added up over the rows of each label, in the task first."""
    entries, names, sent, at_once, merged = coded.entries(_is_listed(rows, column)), coded.names, coded.sent, coded.at_once, _merger()

    def run(batches):
        held, labels, kind, total, fresh = sent.value, {}, None, None, []

        def told(total):
            keys, sums = total
            each = pa.array(list(labels), kind)
            for at in range(0, len(keys), ROWS_AT_ONCE):
                some = keys[at : at + ROWS_AT_ONCE]
                yield pa.RecordBatch.from_arrays([names(some >> 20, held), each.take(pa.array(some & ((1 << 20) - 1))), pa.array(sums[at : at + ROWS_AT_ONCE])], ["term", "label", "o"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, len(batch), at_once):
                part = batch.slice(at, at_once)
                row, gram, tf = entries(part.column(1), held)
                w = (1 + np.log(tf)) * held["idf"][held["which"][gram]]
                w /= np.sqrt(np.bincount(row, w * w, len(part)))[row]
                label = np.array([labels.setdefault(x, len(labels)) for x in part.column(0).to_pylist()], dtype=np.int64)
                fresh.append(merged([[(gram << 20) | label[row], w]]))
                if sum(len(x[0]) for x in fresh) > HELD_TERMS:
                    total, fresh = merged(fresh + ([total] if total else [])), []
                    if len(total[0]) > HELD_TERMS:
                        yield from told(total)
                        total = None
        if fresh or total:
            yield from told(merged(fresh + ([total] if total else [])))

    found = rows.select(label_col, column).mapInArrow(run, f"term string, label {dict(rows.dtypes)[label_col]}, o double")
    return found.groupBy("term", "label").agg(F.sum("o").alias("o"))


def found_column(weighted, column):
    """A column with the array ``found`` of each row, by the function that weighs batches without keys: rows keep their other columns
    and their place, so nothing is joined or shuffled for it."""

    def run(array: pa.Array) -> pa.Array:
        parts = [b.column(0) for b in weighted([pa.RecordBatch.from_arrays([array], ["terms"])])]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.struct([("idx", pa.int32()), ("__w", pa.float64())])))

    return F.arrow_udf(run, FOUND)(column)


def coded_counts(rows: DataFrame, keys, column: str, coded: Coded) -> DataFrame:
    """``(*keys, grams, tfs)``: one row a folded text, with the numbers of its terms of the vocabulary and how often they occur. A table to write once
    and use in many fits."""
    keys, entries, sent, at_once = list(keys), coded.entries(_is_listed(rows, column)), coded.sent, coded.at_once

    def run(batches):
        held = sent.value
        for batch in batches:
            for at in range(0, len(batch), at_once):
                part = batch.slice(at, at_once)
                row, gram, tf = entries(part.column(len(keys)), held)
                ends = pa.array(np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (gram, tf)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], *lists], [*keys, "grams", "tfs"])

    return rows.select(*keys, column).mapInArrow(run, f"{_schema(rows, keys)}, grams array<int>, tfs array<int>")


def _fold_weigher(coded: Coded, sizes, min_df: int):
    """``weigh(grams, tfs, held) -> (row, gram, columns)``: for every fold the weights of a fit without it, 0 for terms that its vocabulary has not.
    ``sizes`` are the rows of the fits, and the vocabulary holds the texts of each fold that have a term."""

    def weigh(grams, tfs, held):
        if "idfs" not in held:
            total, n = held["docs"].sum(axis=1), held["docs"].shape[1]
            left = [total - held["docs"][:, f] for f in range(n)]
            held["idfs"] = [np.where(df >= min_df, np.log((1 + sizes[f]) / (1 + df)) + 1, 0.0) for f, df in enumerate(left)]
        row = np.repeat(np.arange(len(grams)), grams.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        gram, tf = grams.flatten().to_numpy().astype(np.int64), 1 + np.log(tfs.flatten().to_numpy())
        columns = []
        for idf in held["idfs"]:
            w = tf * idf[gram]
            norm = np.sqrt(np.bincount(row, w * w, len(grams)))
            norm[norm == 0] = 1.0
            columns.append(w / norm[row])
        return row, gram, columns

    return weigh


def fold_sums(counted: DataFrame, label_col: str, fold_col: str, coded: Coded, sizes, min_df: int) -> DataFrame:
    """``(term, label, o0, o1, ...)``: :func:`class_sums` of the fits without each fold, from :func:`coded_counts`, whose texts are read once for all of them."""
    names, sent, merged, weigh, k = coded.names, coded.sent, _merger(), _fold_weigher(coded, sizes, min_df), len(sizes)

    def run(batches):
        held, labels, kind, total, fresh = {**sent.value}, {}, None, None, []

        def told(total):
            keys, each = total[0], pa.array(list(labels), kind)
            for at in range(0, len(keys), ROWS_AT_ONCE):
                some, cut = keys[at : at + ROWS_AT_ONCE], slice(at, at + ROWS_AT_ONCE)
                columns = [names(some >> 20, held), each.take(pa.array(some & ((1 << 20) - 1))), *[pa.array(x[cut]) for x in total[1:]]]
                yield pa.RecordBatch.from_arrays(columns, ["term", "label", *[f"o{f}" for f in range(k)]])

        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, len(batch), WORD_TEXTS_AT_ONCE):
                part = batch.slice(at, WORD_TEXTS_AT_ONCE)
                row, gram, columns = weigh(part.column(2), part.column(3), held)
                fold = part.column(1).to_numpy()[row]
                label = np.array([labels.setdefault(x, len(labels)) for x in part.column(0).to_pylist()], dtype=np.int64)
                fresh.append(merged([[(gram << 20) | label[row], *[np.where(fold == f, 0.0, w) for f, w in enumerate(columns)]]]))
                if sum(len(x[0]) for x in fresh) > HELD_TERMS:
                    total, fresh = merged(fresh + ([total] if total else [])), []
                    if len(total[0]) > HELD_TERMS:
                        yield from told(total)
                        total = None
        if fresh or total:
            yield from told(merged(fresh + ([total] if total else [])))

    sums = ", ".join(f"o{f} double" for f in range(k))
    found = counted.select(label_col, fold_col, "grams", "tfs").mapInArrow(run, f"term string, label {dict(counted.dtypes)[label_col]}, {sums}")
    return found.groupBy("term", "label").agg(*[F.sum(f"o{f}").alias(f"o{f}") for f in range(k)])


def fold_features(counted: DataFrame, id_col: str, prefix: str, coded: Coded, sizes, min_df: int, slots) -> DataFrame:
    """``(id, prefix0, prefix1, ...)``: the features of every text by the fits without each fold, from :func:`coded_counts`. ``slots`` are the terms that each fit
    has selected, in the order of the features."""
    sent, weigh, k = coded.sent, _fold_weigher(coded, sizes, min_df), len(sizes)
    chosen = [coded.numbers(terms) for terms in slots]

    def run(batches):
        held = {**sent.value}
        for batch in batches:
            for at in range(0, len(batch), WORD_TEXTS_AT_ONCE):
                part = batch.slice(at, WORD_TEXTS_AT_ONCE)
                row, gram, columns = weigh(part.column(1), part.column(2), held)
                out = [part.column(0)]
                for numbers, w in zip(chosen, columns):
                    order = np.argsort(numbers)
                    place = np.minimum(np.searchsorted(numbers[order], gram), len(numbers) - 1)
                    kept = np.flatnonzero(numbers[order][place] == gram)
                    dense = np.zeros((len(part), len(numbers)))
                    dense[row[kept], order[place[kept]]] = w[kept]
                    out.append(pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * len(numbers)), pa.array(dense.ravel())))
                yield pa.RecordBatch.from_arrays(out, [id_col, *[f"{prefix}{f}" for f in range(k)]])

    arrays = ", ".join(f"{prefix}{f} array<double>" for f in range(k))
    return counted.select(id_col, "grams", "tfs").mapInArrow(run, f"{_schema(counted, [id_col])}, {arrays}")


def _word_entries(lo: int, hi: int):
    low_code = lambda first, last: (first << WORD_BITS) | last

    def make(listed: bool):
        def places(held):
            """Numbers of the words, made once by a worker."""
            if "place" not in held:
                held["place"] = dict(zip(held["words"].to_pylist(), range(len(held["words"]))))
                del held["place"][None]
            return held["place"]

        def code_of(term, place):
            """The code of a term, below 0 if the vocabulary has not all of its words."""
            first, blank, last = term.rpartition(" ")
            return low_code(place.get(first, -1), place.get(last, -1)) if blank else place.get(last, -1)

        def numbered(lists):
            """The row of each entry of the lists."""
            return np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))

        def placed(row, code, codes):
            """Row and place in the vocabulary of the codes that it has, and which these are."""
            each, back = np.unique(code, return_inverse=True)
            at = np.minimum(np.searchsorted(codes, each), len(codes) - 1)
            at[codes[at] != each] = -1
            gram = at[back]
            known = np.flatnonzero(gram >= 0)
            return row[known], gram[known], known

        def counted(lists, codes, place):
            flat = lists.flatten().dictionary_encode()
            number = np.array([place.get(w, -1) for w in flat.dictionary.to_pylist()], dtype=np.int64)
            number, row = number[flat.indices.to_numpy()], numbered(lists)
            parts = [(row, number)] if lo == 1 else []
            if hi == 2:
                two = np.flatnonzero(row[1:] == row[:-1])
                parts.append((row[two], low_code(number[two], number[two + 1])))  # -1 for either word leaves the code below 0
            row, gram, _ = placed(*(np.concatenate(x) for x in zip(*parts)), codes)
            key = (row << 32) | gram
            key.sort()
            first = np.flatnonzero(np.diff(key, prepend=-1))
            return key[first] >> 32, key[first] & ((1 << 32) - 1), np.diff(first, append=len(key))

        def entered(lists, codes, place):
            entries = lists.flatten()
            terms = entries.field("term").dictionary_encode()
            code = np.array([code_of(t, place) for t in terms.dictionary.to_pylist()], dtype=np.int64)
            row, gram, known = placed(numbered(lists), code[terms.indices.to_numpy()], codes)
            return row, gram, entries.field("tf").to_numpy()[known]

        return lambda column, held: (entered if listed else counted)(column, held["codes"], places(held))

    return make


def _word_names():
    low = (1 << WORD_BITS) - 1

    def names(n, held):
        code, words = held["codes"][n], held["words"]
        return pc.binary_join_element_wise(words.take(pa.array(code >> WORD_BITS)), words.take(pa.array(code & low)), " ", null_handling="skip")

    return names


def coded_words(vocabulary: DataFrame, most_bytes: int, lo: int = 1, hi: int = 2, column: str = "idf", gram_bytes: int = GRAM_BYTES) -> Coded | None:
    """A vocabulary of words and pairs of words with its ``idf`` (or the array in another column) as codes, or ``None`` if it takes more than ``most_bytes`` in a task.

    A code is the numbers of the words of a term, from 1, the last one lowest, so it is exact. Tasks make the codes and Spark sorts them; the driver
    gets them without the terms, and the different words as one array.
    """
    grams = vocabulary.count()
    if grams * gram_bytes > most_bytes:
        return None
    pieces, spark = F.split("term", " ", -1), vocabulary.sparkSession
    found = write_table(vocabulary.select(F.explode(pieces).alias("word")).distinct(), "words")
    if grams * gram_bytes + found.count() * WORD_BYTES > most_bytes:
        return None
    words = found.sort("word").toArrow().column("word")
    words = pa.concat_arrays([pa.array([None], pa.string()), *[x.cast(pa.string()) for x in words.chunks]])
    table, nested = vocabulary.where(F.size(pieces) <= 2).select("term", column), vocabulary.schema[column].dataType.typeName() == "array"
    idf = None if nested else np.unique(table.select(column).distinct().toArrow().column(0).to_numpy())
    sent, kind = spark.sparkContext.broadcast({"words": words}), "array<int>" if nested else "int"

    def run(batches):
        held = sent.value
        if "place" not in held:
            held["place"] = dict(zip(held["words"].to_pylist(), range(len(held["words"]))))
        place = held["place"]
        for batch in batches:
            lists = pc.split_pattern(batch.column(0), " ")
            number = np.array([place[w] for w in lists.flatten().to_pylist()], dtype=np.int64)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            last = np.cumsum(sizes) - 1
            code = np.where(sizes == 2, number[last - (sizes == 2)] << WORD_BITS, 0) | number[last]
            value = batch.column(1) if nested else pa.array(np.searchsorted(idf, batch.column(1).to_numpy()).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(code), value], ["code", "value"])

    table = table.mapInArrow(run, f"code long, value {kind}").sort("code").toArrow()
    if not len(table):
        return None
    codes, value = table.column("code").to_numpy(), table.column("value")
    if nested:
        held = {"docs": np.concatenate([x.flatten().to_numpy() for x in value.chunks]).reshape(len(codes), -1).astype(np.int32, copy=False)}
    else:
        held = {"idf": idf, "which": value.to_numpy()}

    def codes_of(terms):
        cut = [t.rpartition(" ") for t in terms]
        first, last = (pc.fill_null(pc.index_in(pa.array([c[i] for c in cut], pa.string()), value_set=words), -1).to_numpy().astype(np.int64) for i in (0, 2))
        pair = np.array([bool(c[1]) for c in cut], dtype=bool)
        return np.where(pair, (first << WORD_BITS) | last, last)  # -1 for either word leaves the code below 0

    return Coded(spark, {"codes": codes, "words": words, **held}, _word_entries(lo, hi), _word_names(), codes_of, WORD_TEXTS_AT_ONCE)


def pooled_sums(rows: DataFrame, id_col: str, tokens_col: str, vectors: DataFrame, dim: int) -> DataFrame:
    """``(id, sums, n)`` of every row: the summed vectors of its known tokens, repeats counted, and how many these are."""
    pool = _pooler(rows.sparkSession, vectors, dim)

    def run(batches):
        for batch in batches:
            for part, sums, n in pool(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), sums, n], [id_col, "sums", "n"])

    return rows.select(id_col, tokens_col).mapInArrow(run, f"{_schema(rows, [id_col])}, sums array<double>, n long")


def pooled_column(spark: SparkSession, tokens, vectors: DataFrame, dim: int):
    """A column with the ``sums`` and ``n`` of :func:`pooled_sums` for the array of tokens of each row."""
    pool = _pooler(spark, vectors, dim)

    def run(array: pa.Array) -> pa.Array:
        parts = [pa.StructArray.from_arrays([sums, n], ["sums", "n"]) for _, sums, n in pool(pa.RecordBatch.from_arrays([array], ["tokens"]), 0)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("sums", pa.list_(pa.float64())), ("n", pa.int64())]))

    return F.arrow_udf(run, "struct<sums: array<double>, n: long>")(tokens)


def _pooler(spark: SparkSession, vectors: DataFrame, dim: int):
    """``pool(batch, at)``: parts of a batch with the sums and counts of the tokens in its column ``at``."""
    table = vectors.select("word", F.col("vector").cast("array<float>").alias("vector")).toArrow()
    if table.column("vector").null_count or any(x.flatten().null_count for x in table.column("vector").chunks):
        raise ValueError("the vector table has nulls")
    flat = [x.flatten().to_numpy(zero_copy_only=False) for x in table.column("vector").chunks]
    matrix = np.concatenate(flat).reshape(-1, dim) if flat else np.zeros((0, dim), dtype=np.float32)
    place = dict(zip(table.column("word").to_pylist(), range(len(matrix))))
    sent = spark.sparkContext.broadcast((place, matrix))

    def pool(batch, column):
        place, matrix = sent.value
        for at in range(0, len(batch), TEXTS_AT_ONCE):
            part = batch.slice(at, TEXTS_AT_ONCE)
            lists = part.column(column)
            coded = lists.flatten().dictionary_encode()
            spot = np.array([place.get(w, -1) for w in coded.dictionary.to_pylist()], dtype=np.int64)
            spot = spot[coded.indices.to_numpy()]
            row = np.repeat(np.arange(len(part)), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
            row, spot = row[spot >= 0], spot[spot >= 0]
            sums, n = np.zeros((len(part), dim)), np.bincount(row, minlength=len(part))
            some = np.flatnonzero(n)
            if len(some):
                sums[some] = np.add.reduceat(matrix[spot].astype(float), (np.cumsum(n) - n)[some], axis=0)
            ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * dim)
            yield part, pa.ListArray.from_arrays(ends, pa.array(sums.ravel())), pa.array(n)

    return pool
