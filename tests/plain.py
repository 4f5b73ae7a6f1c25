"""Small definitions in plain Python that the Spark expressions are checked against."""

import math
import re
from collections import Counter

from inkgrain.functions.scalar import MARKERS

ADVERSARIAL = [
    "",
    "   ",
    "Hello.",
    "U.S. is. Ok...",
    "ends so.\n",
    "a b c",
    "\x1cA\x1dB\x1e",
    "a\r\r\rb",
    "x    y",
    "one\n\n\ntwo",
    "a   b    c",
    "ÉTÉ ß ΔΣ Ⅷ Ⓐ ǅ ǅA AB A1 1A X",
    "A1 B-2 C.C. aBC ABC",
    "٣٤ ٥ 12 3x x3 x-3 mp3 3d 3D",
    "²³ x² ½",
    "😀😀😀 a😀b",
    "éoverall overall_ overall, Overall. OVERALL",
    "ultimately ultımately ultİmately thiſ underscores thıs underſcores",
    "Furthermore, moreover. In conclusion it is worth noting that in summary; in  summary",
    "it is important to note it is worth noting to summarize in essence this highlights this demonstrates notably",
    "soonnnn bbb BBB bbbccc yyy aaa ...!!!??? --- ",
    "wow!!! really??? ok... yes!? no.",
    "a,b,c,,, ;:'\"`~^|<>@#$%&*()_+-=[]{}\\/",
    "... ... ...",
    "First one here. Second! Third has five words now? ",
]


CONSONANTS = set("bcdfghjklmnpqrstvwxyz")
ASCII_MARKS = [(33, 47), (58, 64), (91, 96), (123, 126)]
#: Letters that fold together when case is ignored, beyond their own other case.
FOLDED = {"\u0130": "i", "\u0131": "i", "\u017f": "s", "\u212a": "k"}


class Counter33:
    """Walks over a text once, character by character, and counts what the 33 columns need."""

    def __init__(self, text):
        self.text, self.tokens, self.runs = text, [], []
        token = ""
        for c in text:
            if c.isspace():
                self.end(token)
                token = ""
            else:
                token += c
            if self.runs and self.runs[-1][0] == c:
                self.runs[-1][1] += 1
            else:
                self.runs.append([c, 1])
        self.end(token)

    def end(self, token):
        if token:
            self.tokens.append(token)

    def sentences(self):
        """Number of words of every piece between closing marks; a mark at the very end opens one more piece."""
        first, last = 0, len(self.text)
        while first < last and self.text[first].isspace():
            first += 1
        while last > first and self.text[last - 1].isspace():
            last -= 1
        sizes, at, in_word = [0], first, False
        while at < last:
            c = self.text[at]
            if c in ".!?":
                stop = at
                while stop < last and self.text[stop] in ".!?":
                    stop += 1
                if stop == last or self.text[stop].isspace():
                    sizes.append(0)
                    in_word, at = False, stop
                    continue
                sizes[-1] += not in_word
                in_word, at = True, stop
                continue
            if c.isspace():
                in_word = False
            else:
                sizes[-1] += not in_word
                in_word = True
            at += 1
        return sizes

    def marker(self, marker):
        """Occurrences that do not touch a word character on either side."""
        folded = [FOLDED.get(c) or (c.lower() if len(c.lower()) == 1 else c) for c in self.text]
        inside = lambda i: 0 <= i < len(self.text) and (self.text[i].isalnum() or self.text[i] == "_")
        found = at = 0
        while at + len(marker) <= len(folded):
            if folded[at : at + len(marker)] == list(marker) and not inside(at - 1) and not inside(at + len(marker)):
                found += 1
                at += len(marker)
            else:
                at += 1
        return found

    def columns(self):
        size, tokens, sizes = len(self.text), self.tokens, self.sentences()
        upper = commas = shouts = asks = marks = digit_runs = 0
        before = ""
        for c in self.text:
            upper += c.isupper()
            commas += c == ","
            shouts += c == "!"
            asks += c == "?"
            marks += any(lo <= ord(c) <= hi for lo, hi in ASCII_MARKS)
            digit_runs += c.isdecimal() and not before.isdecimal()
            before = c
        letters = kinds = capital = mixed = 0
        seen = set()
        for w in tokens:
            letters += len(w)
            states = [("U" if c.isupper() else "l" if c.islower() or c.istitle() else "-") for c in w]
            capital += len(w) > 1 and "U" in states and "l" not in states
            low = w.lower()
            ascii_kind = ["d" if "0" <= c <= "9" else "a" if "a" <= c <= "z" else "" for c in low]
            mixed += any({x, y} == {"a", "d"} for x, y in zip(ascii_kind, ascii_kind[1:]))
        for w in "".join(self.text.lower()).split():
            kinds += w not in seen
            seen.add(w)
        filled = [n for n in sizes if n]
        k, total, squares = len(filled), sum(filled), sum(n * n for n in filled)
        out = {"char_len": size, "word_count": len(tokens), "sentence_count": len(sizes), "words_per_sentence": len(tokens) / len(sizes)}
        out["type_token_ratio"] = min(1.0, kinds / len(tokens)) if tokens else 0.0
        out["avg_word_len"] = letters / len(tokens) if tokens else 0.0
        out["sent_len_std"] = math.sqrt(k * squares - total * total) / k if k > 1 else 0.0
        out["punct_ratio"], out["uppercase_char_ratio"] = marks / (size or 1), upper / (size or 1)
        out["comma_per_word"] = commas / (len(tokens) + 1)
        out["exclamation_count"], out["question_count"] = shouts, asks
        out["allcaps_word_count"], out["alphanum_mix_count"], out["digit_group_count"] = capital, mixed, digit_runs
        long = [c for c, n in self.runs if n > 2]
        out["triple_consonant_count"] = sum(c in CONSONANTS for c in long)
        out["char_repeat_run_count"] = sum(c != "\n" for c in long)
        out["log_char_len"] = math.log(1 + size)
        out["ai_marker_count"] = 0
        for m in MARKERS:
            hits = self.marker(m)
            out["ai_marker_count"] += hits
            out["marker_" + "".join(m.split())] = 1 if hits else 0
        return out


def scalar(t):
    return Counter33(t).columns()


def word_terms(t):
    return re.findall(r"\b\w\w+\b", t.lower())


def word_grams(t, stop, lo, hi):
    kept = [w for w in word_terms(t) if w not in stop]
    return [" ".join(kept[i : i + n]) for n in range(lo, hi + 1) for i in range(len(kept) - n + 1)]


def char_grams(t, lo, hi):
    out = []
    for w in t.lower().split():
        w = f" {w} "
        if len(w) <= lo:
            out.append(w)
            continue
        for n in range(lo, hi + 1):
            out.extend(w[i : i + n] for i in range(len(w) - n + 1))
    return out


def embedding_tokens(t):
    return [w for w in re.findall(r"(?:(?!\d)\w)+", t.lower()) if 2 <= len(w) <= 15 and not w.startswith("_")]


def tfidf(docs, analyse, min_df):
    """{doc: {term: weight}} with smoothed idf, sub-linear tf and unit rows."""
    counts = {d: Counter(analyse(t)) for d, t in docs.items()}
    df = Counter(term for c in counts.values() for term in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items() if n >= min_df}
    out = {}
    for d, c in counts.items():
        row = {t: (1 + math.log(n)) * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(w * w for w in row.values()))
        out[d] = {t: w / norm for t, w in row.items()}
    return out, idf


def chi2(weights, labels):
    """{(term, label): score} for weighted one-vs-rest counts."""
    terms = {t for row in weights.values() for t in row}
    out = {}
    for label in sorted(set(labels.values())):
        p = sum(v == label for v in labels.values()) / len(labels)
        for t in terms:
            total = sum(row.get(t, 0.0) for row in weights.values())
            seen = sum(row.get(t, 0.0) for d, row in weights.items() if labels[d] == label)
            e1, e0 = total * p, total * (1 - p)
            out[t, label] = (seen - e1) ** 2 / e1 + (total - seen - e0) ** 2 / e0 if e1 and e0 else 0.0
    return out
