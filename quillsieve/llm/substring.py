"""Removal of long passages that an earlier document has, by recompression.

Every text is parsed by rounds of run and pair compression. A symbol's name is a 64-bit hash of
what it stands for, so all tasks give the same name to the same thing without exchanging names,
and which neighbours merge depends on names alone: equal word sequences get equal symbols but at
their ends. With each symbol goes its context, the words that its existence depends on. A window
of ``width`` words takes as its anchor, of the highest level that has a symbol whose context lies
within the window, the symbol with the smallest hash. The anchor depends on the window's words
alone, so equal windows have equal anchors, and some twenty windows in a row share one.

1. Anchors (key, hash of all words of their windows, document, windows) are written; a key is
   shared if documents with different ids have it.
2. Rows with equal key and equal word hash hold the same windows: all but the one with the
   smallest id are removed without looking at windows.
3. Only rows that are the first of their words, but not of their key, are compared window by
   window, with the other first rows of the key.

Hot keys: minima are aggregated before the shuffle, joins are plain equi-joins that adaptive
execution can split, and no group is collected. Hashes decide equality within a key, that is by
64 bits for the key and 64 for the words. Repeats within a document are run-length encoded.

Defined results: a null text has no words; a text shorter than a window loses nothing; windows
are judged on the input; only a smaller doc_id counts, so rows with equal doc_id don't remove
each other's words; other columns are kept; a row without a doc_id neither removes words nor loses
any; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.llm.arrays import Words, mix, quoted, ragged, steps
from quillsieve.llm.tables import Scratch

WIDTH = 50
ROUNDS = 3
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)


class Parse:
    """Words of some texts, their hashes, and hashes of any range of words."""

    def __init__(self, arr: pa.Array):
        self.words = Words(arr)
        codes, names = self.words.codes()
        digest = xxhash.xxh3_64_intdigest
        self.hash = np.fromiter((digest(n) for n in names), np.uint64, len(names))[codes]
        n = len(codes)
        self.inverse = np.full(n + 1, _INVERSE, np.uint64)
        powers = np.full(n + 1, _BASE, np.uint64)
        self.inverse[0] = powers[0] = 1
        self.inverse, powers = np.cumprod(self.inverse), np.cumprod(powers)[:n]
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.hash) * powers, dtype=np.uint64)])

    def range_hash(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.prefix[hi] - self.prefix[lo]) * self.inverse[lo] + (hi - lo).astype(np.uint64))

    def levels(self, rounds: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(symbol, context start, context end, words) of level 0, 1, ..., in order of place."""
        off, n = self.words.off, len(self.words)
        doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
        before, after = off[:-1] - 1, off[1:] + 1  # outside of any window
        sym, lo, hi, length = mix(self.hash), np.arange(n), np.arange(1, n + 1), np.ones(n, np.int64)
        yield sym, lo, hi, length
        for k in range(rounds):
            # Runs of a symbol: the neighbours on both sides decide.
            first = np.ones(len(sym), bool)
            first[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(first)
            if not len(at):
                return
            size = np.diff(np.append(at, len(sym)))
            left, right = np.maximum(at - 1, 0), np.minimum(at + size, len(sym) - 1)
            own = doc[at]
            lo = np.where((at > 0) & (doc[left] == own), lo[left], before[own])
            hi = np.where((at + size < len(sym)) & (doc[right] == own), hi[right], after[own])
            sym = np.where(size > 1, mix(sym[at] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), sym[at])
            doc, length = own, np.add.reduceat(length, at)
            # Pairs of a symbol of one half of all names and one of the other.
            is_left = mix(sym ^ np.uint64((k + 1) * 0xA0761D6478BD642F & (1 << 64) - 1)) >> np.uint64(63) == 0
            same = np.append(doc[1:] == doc[:-1], False)  # as the next one
            pair = is_left & np.append(~is_left[1:], False) & same
            merged = np.concatenate([[False], pair[:-1]])  # into the one before
            next_hi = np.where(same, np.append(hi[1:], 0), after[doc])
            last_lo = np.where(np.concatenate([[False], same[:-1]]), np.concatenate([[0], lo[:-1]]), before[doc])
            name = np.where(pair, mix(mix(sym) + np.append(sym[1:], np.uint64(0)) * np.uint64(0xE7037ED1A0B428DB)), sym)
            lo = np.where(is_left, lo, last_lo)
            hi = np.where(is_left, next_hi, hi)  # of a pair: the second one's end
            hi[:-1] = np.where(pair[:-1], np.append(hi[1:], 0)[:-1], hi[:-1])
            length = length + np.where(pair, np.append(length[1:], 0), 0)
            stay = ~merged
            sym, lo, hi, doc, length = name[stay], lo[stay], hi[stay], doc[stay], length[stay]
            yield sym, lo, hi, length

    def windows(self, width: int) -> np.ndarray:
        """The first words of all windows."""
        off = self.words.off
        return ragged(off[:-1], np.maximum(np.diff(off) - width + 1, 0))

    def anchors(self, width: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, first window, windows) in order of place."""
        at = self.windows(width)
        key = np.zeros(len(at), np.uint64)
        place = np.full(len(at), -1, np.int64)  # level and symbol
        todo = np.arange(len(at))
        for level, (sym, lo, hi, length) in reversed(list(enumerate(self.levels(rounds)))):
            if not len(todo):
                break
            first = np.searchsorted(lo, at[todo])
            stop = np.searchsorted(hi, at[todo] + width, side="right")
            some = stop > first
            who, first, stop = todo[some], first[some], stop[some]
            # Most words (they are the rarest), then smallest hash, then leftmost, of any range:
            # a table of minima over powers of two.
            order = (255 - np.minimum(length, 255)).astype(np.uint64) << np.uint64(56)
            order = order | mix(sym) >> np.uint64(38) << np.uint64(30) | np.arange(len(sym), dtype=np.uint64)
            table = [order]
            while 2 ** len(table) <= width:
                half, last = 2 ** (len(table) - 1), table[-1]
                table.append(np.concatenate([np.minimum(last[:-half], last[half:]), last[-half:]]) if len(last) > half else last)
            if len(who):
                power = np.log2(stop - first).astype(np.int64)
                flat = np.stack(table)
                best = np.minimum(flat[power, first], flat[power, stop - (1 << power)])
                best = (best & np.uint64((1 << 30) - 1)).astype(np.int64)
                key[who] = mix(sym[best] + np.uint64(level))
                place[who] = best * (rounds + 1) + level
            todo = todo[~some]
        cut = np.ones(len(at), bool)
        cut[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(cut)
        return key[first], at[first], np.diff(np.append(first, len(at)))


def _anchor_rows(width: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 2):
                p = Parse(part.column(2))
                key, at, count = p.anchors(width, rounds)
                doc = np.searchsorted(p.words.off, at, side="right") - 1
                words = p.range_hash(at, at + count + width - 1)
                # Rows that repeat the one right before them hold the same windows again.
                again = np.zeros(len(at), bool)
                again[1:] = (key[1:] == key[:-1]) & (words[1:] == words[:-1]) & (doc[1:] == doc[:-1]) & (count[1:] == count[:-1]) & (at[1:] == at[:-1] + count[:-1])
                first = np.flatnonzero(~again)
                last = np.append(first[1:], len(at)) - 1 if len(first) else first
                total = at[last] + count[last] - at[first]
                doc, start = doc[first], at[first] - p.words.off[doc[first]]
                ids = part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([pa.array(key[first].view(np.int64)), pa.array(words[first].view(np.int64)), *ids, pa.array(start << 31 | total), pa.array(count[first].astype(np.int32))], ["key", "words", "doc_id", "tid", "span", "period"])

    return run


def _lists(arr: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets (from 0) and values of a list array; a null is empty."""
    flat = arr.flatten()
    sizes = np.asarray(arr.value_lengths().fill_null(0))
    return np.concatenate([[0], np.cumsum(sizes)]), flat


def _window_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 2):
                p = Parse(part.column(2))
                off, rows = _lists(part.column(3))
                key, span, period = (np.asarray(rows.field(k)) for k in ("key", "span", "period"))
                doc = np.repeat(np.arange(len(part)), np.diff(off))
                at = ragged((span >> 31) + p.words.off[doc], period)
                # A window comes back each period; its repeats cover all words from the first to the last.
                upto = np.repeat((span & (1 << 31) - 1) - period + 1, period)
                key, doc = np.repeat(key, period), np.repeat(doc, period)
                ids = part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(p.range_hash(at, at + width).view(np.int64)), *ids, pa.array((at - p.words.off[doc]) << 31 | upto)], ["key", "words", "doc_id", "tid", "span"])

    return run


def _cut_rows(width: int, n: int, names: list[str]):
    """Texts without the words of the spans in the column after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, n):
                text = part.column(n)
                w = Words(text)
                off, rows = _lists(part.column(n + 1))
                span = np.asarray(rows)
                doc = np.repeat(np.arange(len(part)), np.diff(off))
                edge = np.zeros(len(w) + 1, np.int64)
                np.add.at(edge, w.off[doc] + (span >> 31), 1)
                np.add.at(edge, w.off[doc] + (span >> 31) + (span & (1 << 31) - 1) + width - 1, -1)
                gone = np.cumsum(edge)[:-1] > 0
                lost = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.off])
                # Kept words, each with a space after it but for a text's last one.
                kept = np.flatnonzero(~gone)
                lens = np.diff(w.ends)[kept]
                koff = np.searchsorted(kept, w.off)
                final = koff[1:][koff[1:] > koff[:-1]] - 1
                room = lens + 1
                room[final] -= 1
                data = np.full(int(room.sum()), 32, np.uint8)
                data[ragged(np.cumsum(room) - room, lens)] = w.data[ragged(w.ends[kept], lens)]
                ends = np.concatenate([[0], np.cumsum(room)])[koff]
                out = pa.LargeStringArray.from_buffers(len(part), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:n], out, pa.array(w.counts), pa.array(lost)], names)

    return run


def spans(df: DataFrame, scratch: Scratch, width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, tid, spans): windows to remove, as first window << 31 | number of windows.

    df: doc_id, tid, text, where tid tells rows of one doc_id apart.
    """
    rows = "key long, words long, doc_id long, tid long, span long"
    anchors = scratch.cut(df.mapInArrow(_anchor_rows(width, rounds), rows + ", period int"), "anchors")
    keys = anchors.groupBy("key").agg(F.min("doc_id").alias("key_low"), F.max("doc_id").alias("high")).where("key_low < high").drop("high")
    shared = scratch.cut(anchors.join(keys, "key"), "shared")
    scratch.drop(anchors)
    same = shared.groupBy("key", "words").agg(F.min("doc_id").alias("low"), F.first("key_low").alias("key_low"))
    split = same.groupBy("key").agg(F.max("low").alias("top"), F.first("key_low").alias("k")).where("top > k").select("key", F.lit(True).alias("split"))
    judged = shared.drop("key_low").join(same.join(split, "key", "left"), ["key", "words"])
    judged = scratch.cut(judged, "judged")
    scratch.drop(shared)
    # Not the first with these words: gone. First with them, in a key with other words: by window.
    whole = judged.where("doc_id > low").select("doc_id", "tid", "span")
    firsts = judged.where("split and doc_id = low").groupBy("doc_id", "tid").agg(F.collect_list(F.struct("key", "span", "period")).alias("rows"))
    texts = df.join(firsts, ["doc_id", "tid"]).select("doc_id", "tid", "text", "rows")
    windows = scratch.cut(texts.mapInArrow(_window_rows(width), rows), "windows")
    lows = windows.groupBy("key", "words").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    single = windows.join(lows, ["key", "words"]).where("doc_id > low").select("doc_id", "tid", "span")
    found = whole.union(single).groupBy("doc_id", "tid").agg(F.collect_list("span").alias("spans"))
    out = scratch.cut(found, "spans")
    scratch.drop(judged, windows)
    return out


def dedupe(df: DataFrame, width: int = WIDTH, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """df with ``kept`` (the words left, joined by one space), ``n_words``, ``n_removed``."""
    scratch = Scratch(df.sparkSession, "substring")
    tid = F.xxhash64(quoted(text)).alias("tid")
    found = spans(df.select(quoted(doc_id).cast("long").alias("doc_id"), tid, quoted(text).cast("string").alias("text")), scratch, width)
    made = [T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    keep = [f for f in df.schema.fields if f.name.lower() not in ("kept", "n_words", "n_removed")]
    n = len(keep)
    plain = df.select(*[quoted(f.name).alias(f"c{i}") for i, f in enumerate(keep)], quoted(text).cast("string").alias("source"), quoted(doc_id).cast("long").alias("key_id"), tid)
    joined = plain.join(found.select(F.col("doc_id").alias("key_id"), "tid", "spans"), ["key_id", "tid"], "left").select(*[f"c{i}" for i in range(n)], "source", "spans")
    out = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(keep)] + made)
    cut = joined.mapInArrow(_cut_rows(width, n, out.names), out)
    return cut.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(keep)], *[f.name for f in made])


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of ``documents``."""
    return dedupe(df.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
