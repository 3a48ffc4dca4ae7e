"""Language identification by cross-parsing.

For each language a suffix automaton is built over running labelled text: words of letters, in
lower case, with one space between them and at both ends. A text in the same form is cut into
phrases by longest matches in the automaton, across words: the fewer phrases, the more alike. A
text's cost in a language is the number of its phrases, weighted by log2 of the automaton's size
(the bits that a pointer costs) and normalised by the text's letters; the language of the least
cost wins. The whole text is parsed, a character that a language never has is a phrase. The texts
of a slice are parsed side by side, one character of each at a time; the last few, which are long,
are then finished one by one.

Learning uses a bounded sample: for each language the texts of smallest hash until SAMPLE_CHARS
letters; the number of languages is bounded by MAX_LANGUAGES (more raise an error). Prediction
sees the text only.

Defined results: a text that is null or has no letter is ``und`` with score 0; with no labelled
text every text is ``und``; ties go to the language that sorts first; other columns, repeated
rows and very long texts are handled like any other.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.llm.arrays import add_columns, quoted

SAMPLE_CHARS = 60_000
#: Texts that one language's sample is cut from, at most.
SAMPLE_TEXTS = 100
MAX_LANGUAGES = 256
UNKNOWN = "und"
#: Transitions of one language as a table, at most (more are looked up one by one).
TABLE = 8_000_000
#: Texts that are worth a step of all of them.
FEW = 48
@lru_cache
def _letters() -> np.ndarray:
    """For each code point itself if it is a letter, else a space."""
    every = np.arange(0x110000, dtype=np.uint32)
    return np.where(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000), every, np.uint32(32))


def running(text: str) -> str:
    """Words of letters in lower case, with one space around each; empty without a letter."""
    found = _letters()[np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), "<u4")]
    keep = found != 32
    if not keep.any():
        return ""
    keep[1:] |= found[:-1] != 32  # the space after a word
    first = int(keep.argmax())
    return " " + found[first:][keep[first:]].tobytes().decode("utf-32-le")


class SuffixAutomaton:
    """Automaton of all substrings of some texts.

    codes: the code of each code point (0: none); n: number of codes; states: number of states; the
    transitions are two arrays: keys (state * n + code) and the states that they lead to.
    """

    def __init__(self, texts):
        self.next: list[dict[str, int]] = [{}]
        link, size = [-1], [0]
        for text in texts:
            last = 0
            for c in text:
                if c in self.next[last]:
                    q = self.next[last][c]
                    if size[q] == size[last] + 1:
                        last = q
                        continue
                    clone = self._clone(link, size, q, size[last] + 1)
                    p = last
                    while p != -1 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = clone
                    last = clone
                    continue
                new = len(self.next)
                self.next.append({})
                size.append(size[last] + 1)
                link.append(0)
                p = last
                while p != -1 and c not in self.next[p]:
                    self.next[p][c] = new
                    p = link[p]
                if p != -1:
                    q = self.next[p][c]
                    if size[q] == size[p] + 1:
                        link[new] = q
                    else:
                        clone = self._clone(link, size, q, size[p] + 1)
                        while p != -1 and self.next[p].get(c) == q:
                            self.next[p][c] = clone
                            p = link[p]
                        link[q] = link[new] = clone
                last = new
        self.states = len(self.next)
        self.bits = float(np.log2(self.states + 1))
        known = sorted(self.next[0])
        self.n = len(known) + 1
        self.codes = np.zeros(ord(known[-1]) + 2 if known else 1, np.uint8 if self.n <= 256 else np.int32)
        self.codes[[ord(c) for c in known]] = np.arange(1, self.n)
        code = {c: i + 1 for i, c in enumerate(known)}
        self.keys = np.array([s * self.n + code[c] for s, row in enumerate(self.next) for c in row], np.int64)
        self.to = np.array([t for row in self.next for t in row.values()], np.int32)
        del self.next

    def _clone(self, link, size, q, length) -> int:
        self.next.append(dict(self.next[q]))
        size.append(length)
        link.append(link[q])
        return len(self.next) - 1

    def coded(self, chars: np.ndarray) -> np.ndarray:
        """Codes of code points."""
        return self.codes[np.minimum(chars, np.uint32(len(self.codes) - 1))]

    def phrases(self, text: str) -> int:
        """Longest-match phrases of a text; a character that never occurs is one by itself."""
        table = dict(zip(self.keys.tolist(), self.to.tolist()))
        code = self.coded(np.array([ord(c) for c in text], np.uint32)).tolist()
        return _finish(lambda k: table.get(k, -1), self.n, code, 0, 0)

    def flat(self) -> np.ndarray:
        """The transitions of all states by code; -1: none."""
        out = np.full(self.states * self.n, -1, np.int32)
        out[self.keys] = self.to
        return out


def _finish(get, n: int, code: list[int], state: int, count: int) -> int:
    """Phrases with those of the codes that follow ``count`` phrases and a match that led to ``state``."""
    for c in code:
        to = get(state * n + c)
        if to < 0:
            count += state > 0
            to = get(c)
            if to < 0:
                count, to = count + 1, 0
        state = to
    return count + (state > 0)


class Parser:
    """Several automata over the same texts. Made where it is used: its tables aren't sent."""

    def __init__(self, automata: list[SuffixAutomaton]):
        self.automata = automata
        self.quick = [i for i, a in enumerate(automata) if a.states * a.n <= TABLE]
        found = [automata[i] for i in self.quick]
        self.n = np.array([[a.n] for a in found], np.int64)
        sizes = [a.states * a.n for a in found]
        self.first = (np.cumsum(sizes) - sizes).astype(np.int64)[:, None] if found else np.zeros((0, 1), np.int64)
        self.flat = np.empty(sum(sizes), np.int32)
        for a, lo, size in zip(found, self.first[:, 0].tolist(), sizes):
            self.flat[lo : lo + size] = a.flat()
        self.slow = {i: dict(zip(a.keys.tolist(), a.to.tolist())) for i, a in enumerate(automata) if i not in self.quick}

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text (the longest first) for each automaton."""
        out = np.zeros((len(self.automata), len(texts)), np.int64)
        if not texts:
            return out
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(t) for t in texts])
        for i, table in self.slow.items():
            code = self.automata[i].coded(chars)
            out[i] = [_finish(lambda k, table=table: table.get(k, -1), self.automata[i].n, c.tolist(), 0, 0) for c in np.split(code, ends[:-1])]
        if not self.quick:
            return out
        code = np.stack([self.automata[i].coded(chars) for i in self.quick])
        sizes = np.array([len(t) for t in texts])
        start = np.cumsum(sizes) - sizes
        state, count = np.zeros((len(self.quick), len(texts)), np.int64), np.zeros((len(self.quick), len(texts)), np.int64)
        active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right").tolist()
        t = 0
        while t < len(active) and active[t] >= FEW:
            k = active[t]
            c, s = code.take(start[:k] + t, axis=1), state[:, :k]
            to = self.flat.take(self.first + s * self.n + c)
            lost = to < 0
            anew = self.flat.take(self.first + c)
            count[:, :k] += lost & (s > 0)
            count[:, :k] += lost & (anew < 0)
            state[:, :k] = np.where(lost, np.maximum(anew, 0), to)
            t += 1
        left = active[t] if t < len(active) else 0
        count[:, left:] += state[:, left:] > 0
        for j, (lo, n) in enumerate(zip(self.first[:, 0].tolist(), self.n[:, 0].tolist())):
            get = memoryview(self.flat)[lo:].__getitem__
            for k in range(left):
                count[j, k] = _finish(get, n, code[j, start[k] + t : ends[k]].tolist(), int(state[j, k]), int(count[j, k]))
        out[self.quick] = count
        return out


class Model:
    """One automaton for each language, in order of name."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        self.automata = [SuffixAutomaton(dict.fromkeys(samples[name])) for name in self.languages]
        self.parser: Parser | None = None

    def __getstate__(self):
        return self.__dict__ | {"parser": None}

    def predict(self, arr: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text. Score: how far the second language is behind."""
        names, scores = [UNKNOWN] * len(arr), np.zeros(len(arr))
        read = [(i, running(value)) for i, value in enumerate(arr.to_pylist()) if value] if self.automata else []
        read = sorted(((i, t) for i, t in read if t), key=lambda x: -len(x[1]))
        if not read:
            return names, scores
        self.parser = self.parser or Parser(self.automata)
        costs = self.parser.phrases([t for _, t in read]).T * np.array([a.bits for a in self.automata])
        best = costs.argmin(axis=1)
        order = np.sort(costs, axis=1)
        for k, (i, _) in enumerate(read):
            names[i] = self.languages[best[k]]
            scores[i] = 1 - order[k, 0] / order[k, 1] if order.shape[1] > 1 else 1.0
        return names, scores


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model from the labelled rows of df: those with a language and a text."""
    rows = df.select(quoted(lang).cast("string").alias("lang"), quoted(text).cast("string").alias("text")).where("lang is not null and text is not null")
    if rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # A text gives at most what one language needs; ties of the hash are ties of the text.
    short = rows.select("lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"), F.xxhash64("text").alias("h"))
    top = short.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).where(F.col("n") <= SAMPLE_TEXTS)
    upto = F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    found = top.withColumn("before", F.coalesce(upto, F.lit(0))).where(F.col("before") < SAMPLE_CHARS).select("lang", "text").toLocalIterator()  # bound: MAX_LANGUAGES samples
    samples: dict[str, list[str]] = {}
    for row in found:
        if text_ := running(row["text"]):
            samples.setdefault(row["lang"], []).append(text_)
    return Model(samples)


def predict(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """df with the predicted language and a score from 0 to 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bound: MAX_LANGUAGES samples

    def make(arr: pa.Array) -> list[pa.Array]:
        names, scores = shared.value.predict(arr)
        return [pa.array(names, pa.string()), pa.array(scores)]

    return add_columns(df, quoted(text).cast("string"), make, [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept out of learning."""
    return F.coalesce(F.crc32(quoted(doc_id).cast("string")) % 4 == 2, F.lit(False))


def digests(df: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of ``documents``."""
    model = fit(df.where(~held_out()))
    return predict(df.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
