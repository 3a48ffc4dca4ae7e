"""Near copies by the Jaccard similarity of their sets of five-word shingles.

Candidates are found by SimHash fingerprints of the shingles: texts whose fingerprints the grid
range-join of ``simhash`` links, directly or by others, are compared. Most pairs at SIMILARITY differ
in more bits than a grid can hold, so beside the fingerprints there are minima of HASHES hash functions
over a text's shingles, ROWS of which make a band; texts that agree in one of BANDS bands are compared
too. At a similarity of exactly SIMILARITY a pair meets in a band with probability
1 - (1 - 0.8**3)**12 = 0.9998, above it more often. Whatever meets is verified on the sets of
shingles themselves, so no pair below SIMILARITY links.

Texts with equal sets meet as one. A cell with many texts is compared in blocks of bounded size,
as pairs of blocks in separate groups. A cell returns stars and not its pairs.

Defined results: words are split at ASCII blanks and A-Z is lowered; a text of fewer than five
words is one shingle; texts without a word are copies of each other; other columns are ignored; an
empty table gives an empty result. A null doc_id is a document like any other: it names a component
only where no other id does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.llm import simhash
from quillsieve.llm.arrays import Words, add_columns, mix, quoted, ragged
from quillsieve.llm.components import connected
from quillsieve.llm.tables import Scratch

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 12, 3
HASHES = BANDS * ROWS
#: Texts and shingles of one block of a cell; larger cells are compared block by block.
BLOCK, BLOCK_SHINGLES = 1024, 500_000
#: Shingles of one product of two blocks.
COLUMNS = 4096
_FACTORS = np.random.default_rng(5).integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each text, and the hashes of its distinct shingles in order."""
    words = Words(arr, lower=True)
    codes, names = words.codes()
    if not len(words):
        return np.zeros(len(arr) + 1, np.int64), np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))[codes]
    counts = words.counts
    each = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    start, size = ragged(words.off[:-1], each), np.repeat(np.minimum(counts, SHINGLE), each)
    sums = np.zeros(len(start), np.uint64)
    for k in range(SHINGLE):
        word = hashes[np.minimum(start + k, len(hashes) - 1)]
        sums = np.where(k < size, mix(sums * np.uint64(0x9FB21C651E98DF25) + word), sums)
    doc = np.repeat(np.arange(len(arr)), each)
    order = np.lexsort((sums, doc))
    sums, doc = sums[order], doc[order]
    new = np.ones(len(sums), bool)
    new[1:] = (sums[1:] != sums[:-1]) | (doc[1:] != doc[:-1])
    return np.searchsorted(doc[new], np.arange(len(arr) + 1)), sums[new]


def sketch(arr: pa.Array) -> list[pa.Array]:
    """The name of each text's set of shingles, their number, the cells of its bands, and its fingerprint."""
    off, sums = shingles(arr)
    sizes = np.diff(off)
    some = np.flatnonzero(sizes)
    name, cells = np.zeros(len(arr), np.uint64), np.zeros((len(some), BANDS), np.uint64)
    if len(some):
        at = off[some]
        name[some] = mix(np.add.reduceat(mix(sums), at) + sizes[some].astype(np.uint64))
        for k in range(HASHES):
            band = k // ROWS
            cells[:, band] = mix(cells[:, band] * np.uint64(0x9FB21C651E98DF25) + np.minimum.reduceat(sums * _FACTORS[k], at))
    bounds = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))])
    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(cells.view(np.int64).ravel()))
    return [pa.array(name.view(np.int64)), pa.array(sizes), lists, pa.array(simhash.fingerprint_array(arr, SHINGLE))]


def fingerprint_cells(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(name, size, band, cell): the sets that links of fingerprints join share a cell of band BANDS."""
    prints = docs.where("size > 0").select("name", "size", "fp").distinct()
    found = connected(simhash.links(prints.select("fp").distinct(), scratch), scratch)
    return prints.join(found, prints.fp == found.node, "left").select("name", "size", F.lit(BANDS).alias("band"), F.coalesce("root", "fp").alias("cell"))


def close(off: np.ndarray, sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each text of ``a`` and each of ``b`` (places in off) reach SIMILARITY."""
    own = np.unique(np.concatenate([a, b]))
    sizes = np.diff(off)
    doc, at = np.repeat(np.arange(len(own)), sizes[own]), ragged(off[own], sizes[own])
    _, column, count = np.unique(sums[at], return_inverse=True, return_counts=True)
    # Shingles of one text only are in no intersection.
    order = np.argsort(column, kind="stable")
    order = order[count[column[order]] > 1]
    column, doc = np.unique(column[order], return_inverse=True)[1], doc[order]
    both = np.zeros((len(a), len(b)), np.int64)
    left, right = np.searchsorted(own, a), np.searchsorted(own, b)
    cuts = np.searchsorted(column, np.arange(0, int(column[-1]) + 1 + COLUMNS if len(column) else 1, COLUMNS))
    for lo, hi in zip(cuts, cuts[1:]):
        part = np.zeros((len(own), COLUMNS), np.float32)
        part[doc[lo:hi], column[lo:hi] % COLUMNS] = 1
        both += (part[left] @ part[right].T).astype(np.int64)
    # At least four fifths, in whole numbers.
    return 10 * both >= round(10 * SIMILARITY) * (sizes[a][:, None] + sizes[b][None, :] - both)


def stars(names: np.ndarray, linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of a group that links join, each with its group's first member."""
    i, j = np.nonzero(linked)
    i, j = a[i], b[j]
    i, j = i[names[i] != names[j]], j[names[i] != names[j]]
    label = np.arange(len(names))
    while len(i):
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group (band, cell, x, y); a group is of bounded size."""
    rest: pa.Table | None = None

    def groups(rows: pa.Table) -> np.ndarray:
        return np.stack([np.asarray(rows.column(k)).astype(np.int64) for k in range(4)], axis=1)

    def judge(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        key, side, names = groups(rows), np.asarray(rows.column("side")), np.asarray(rows.column("name"))
        off, sums = shingles(rows.column("text").chunk(0))
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
        found = []
        for lo, hi in zip(cuts, cuts[1:]):
            a, b = (lo + np.flatnonzero(side[lo:hi] == k) for k in (0, 1))
            if key[lo, 2] == key[lo, 3]:
                b = a
            if len(a) and len(b) and hi - lo > 1:
                found.append(stars(names[lo:hi], close(off, sums, a, b), a - lo, b - lo))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        key = groups(rows)
        change = np.flatnonzero((key[:-1] != key[-1]).any(axis=1))
        at = int(change[-1]) + 1 if len(change) else 0
        if at:
            yield from judge(rows.slice(0, at))
        rest = rows.slice(at)
    if rest is not None and rest.num_rows:
        yield from judge(rest)


def components(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, name, component_id): component_id is the smallest id that links reach."""
    scratch = Scratch(df.sparkSession, "jaccard")
    whole = df.select(quoted(doc_id).alias("doc_id"), F.xxhash64(quoted(text)).alias("tid"), quoted(text).cast("string").alias("text"))
    made = [T.StructField("name", T.LongType()), T.StructField("size", T.LongType()), T.StructField("cells", T.ArrayType(T.LongType())), T.StructField("fp", T.LongType())]
    docs = scratch.cut(add_columns(whole, F.col("text"), sketch, made).drop("text"), "sketches")
    cells = docs.select("name", "size", F.posexplode("cells").alias("band", "cell")).union(fingerprint_cells(docs, scratch)).distinct()
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
    full = cells.groupBy("band", "cell").agg(F.count("*").alias("n"), blocks.alias("blocks")).where("n > 1").drop("n")
    met = cells.join(full, ["band", "cell"]).withColumn("own", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("band", "cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).cast("int").alias("side"), "name")
    met = scratch.cut(met, "cells")
    # One text for each set that meets another.
    wanted = docs.join(met.select("name").distinct(), "name").groupBy("name").agg(F.min(F.struct("doc_id", "tid")).alias("r")).select("name", F.col("r.doc_id").alias("d"), F.col("r.tid").alias("t"))
    texts = whole.join(wanted, F.expr("doc_id <=> d and tid = t")).select("name", "text").dropDuplicates(["name"])
    keys = ["band", "cell", "x", "y"]
    # A stated number of partitions: the work of a group grows with the square of its rows.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.join(texts, "name").select(*keys, "side", "name", "text").repartition(parts, *keys).sortWithinPartitions(*keys)
    links = scratch.cut(dealt.mapInArrow(_stars, "a long, b long").distinct(), "links")
    found = connected(links, scratch)
    prints = docs.groupBy("name").agg(F.min("doc_id").alias("low"))
    # Linked sets only: the others are components by themselves.
    linked = prints.join(found, prints.name == found.node).select("name", "root", "low")
    lows = linked.groupBy("root").agg(F.min("low").alias("least"))
    least = prints.join(linked.join(lows, "root").select("name", "least"), "name", "left").select("name", F.coalesce("least", "low").alias("component_id"))
    return docs.join(least, "name").select("doc_id", "name", "component_id")


def dedupe(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of df whose document has the smallest id of its component; rows without an id stay."""
    gone = components(df, text, doc_id).where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    gone = Scratch(df.sparkSession, "jaccard").cut(gone, "gone")  # ids only; the planner knows its size
    return df.join(gone, quoted(doc_id) == gone.gone_id, "left_anti")
