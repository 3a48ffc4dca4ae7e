"""SimHash near-duplicates.

Embedding: a fingerprint maps to the bit counts (0, 1 or 2) of its 32 two-bit segments. The
Manhattan distance of two count vectors is at most the Hamming distance of the fingerprints.

Grid range-join: the segments are dealt to ``d // 2 + 1`` blocks, so that vectors within ``d`` of
each other are within 1 in some block. Each block is a grid whose cells are the count vectors of
its segments. A fingerprint stands in its own cell and probes the cells one step above it (its
vector with one count more); two vectors within 1 either share a cell, or one probes the other's.
In a cell the Manhattan distance over all segments is checked, then the exact Hamming distance.

Copies meet as one fingerprint. A cell with many fingerprints is compared in blocks of bounded
size, as pairs of blocks in separate groups. A cell returns stars (at most one row for each of
its fingerprints) and not its pairs.

Defined results: a text that is null or has no word has fingerprint 0 and links like any other;
a text of one or two words is one shingle; repeated rows have equal fingerprints; other columns
are ignored; an empty table gives an empty result. A null doc_id is a document like any other: it
is the smallest of a component only where no other id is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.llm.arrays import Words, add_columns, quoted, ragged
from quillsieve.llm.components import connected
from quillsieve.llm.tables import Scratch

SEED = 42
#: Fingerprints of one block of a cell; larger cells are compared block by block.
BLOCK = 1024
#: Fingerprints compared at once with a block.
ROWS = 256


def fingerprint_array(arr: pa.Array, shingle: int = 3) -> np.ndarray:
    """64-bit fingerprints (as signed integers) of texts."""
    words = Words(arr, lower=True)
    out = np.zeros(len(arr), np.uint64)
    counts = words.counts
    if not len(words):
        return out.view(np.int64)
    # Words with one space between them, as one buffer.
    lens = np.diff(words.ends)
    flat = np.full(len(words.data) + len(words), 32, np.uint8)
    flat[np.arange(len(words.data)) + np.repeat(np.arange(len(words)), lens)] = words.data
    buffer = flat.tobytes()
    start = words.ends[:-1] + np.arange(len(words))
    end = start + lens
    some = np.flatnonzero(counts)
    each = np.maximum(counts[some] - shingle + 1, 1)
    first = ragged(words.off[some], each)
    last = first + np.repeat(np.minimum(counts[some], shingle), each) - 1
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(buffer[a:b], SEED) for a, b in zip(start[first].tolist(), end[last].tolist())])
    begins = np.cumsum(each) - each
    # Bits as bytes, summed eight at a time in 64-bit lanes over at most 255 rows.
    pieces = -(-each // 255)
    cuts = np.repeat(begins, pieces) + 255 * ragged(np.zeros(len(each), np.int64), pieces)
    lanes = np.unpackbits(np.frombuffer(raw, np.uint8)).view(np.uint64).reshape(-1, 8)
    sums = np.add.reduceat(lanes, cuts, axis=0).view(np.uint8).reshape(-1, 64).astype(np.int64)
    sums = np.add.reduceat(sums, np.cumsum(pieces) - pieces, axis=0)
    out[some] = np.packbits(2 * sums > each[:, None], axis=1).view(">u8").ravel()
    return out.view(np.int64)


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """df with ``out``: the fingerprint as a signed 64-bit integer."""

    def make(arr: pa.Array) -> list[pa.Array]:
        return [pa.array(fingerprint_array(arr))]

    return add_columns(df, quoted(text).cast("string"), make, [T.StructField(out, T.LongType())])


_ONES = 0x5555555555555555


def grids(distance: int) -> list[tuple[int, int]]:
    """(first segment, one after the last) of each grid's block of segments."""
    blocks = distance // 2 + 1
    edges = [32 * i // blocks for i in range(blocks + 1)]
    return list(zip(edges, edges[1:]))


def embed(fp):
    """Counts of the 32 segments, as two bits each (a column of long)."""
    odd, even = fp.bitwiseAND(F.lit(_ONES)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_ONES))
    return F.shiftleft(odd.bitwiseAND(even), 1).bitwiseOR(odd.bitwiseXOR(even))


def ladder(u: np.ndarray) -> np.ndarray:
    """Counts as bits (one if at least 1, another if 2): their Hamming distance is the Manhattan
    distance of the count vectors."""
    odd, even = u & np.uint64(_ONES), u >> np.uint64(1) & np.uint64(_ONES)
    return (odd | even) | (odd & even) << np.uint64(1)


def close_stars(fp: np.ndarray, side: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a group linked at ``distance``, each with its group's smallest member.

    side: 0 and 1 for the two blocks that are compared; all 0 for a block with itself. home: of the
    two of a pair at least one stands in its own cell.
    """
    u = fp.view(np.uint64)
    steps = ladder(u)
    found_i, found_j = [], []
    other = np.flatnonzero(side == 1)
    own = np.flatnonzero(side == 0)
    for a, b in ((own[home[own]], other), (other[home[other]], own)) if len(other) else ((own[home[own]], own),):
        for lo in range(0, len(a), ROWS):
            x = a[lo : lo + ROWS]
            i, j = np.nonzero(np.bitwise_count(steps[x][:, None] ^ steps[b][None, :]) <= distance)
            i, j = x[i], b[j]
            exact = (np.bitwise_count(u[i] ^ u[j]) <= distance) & (u[i] != u[j])
            found_i.append(i[exact])
            found_j.append(j[exact])
    i, j = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in (found_i, found_j))
    label = np.arange(len(fp))
    while len(i):
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _stars(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by group; a group is a run of equal (grid, cell, x, y), of bounded size."""
        rest: np.ndarray | None = None

        def cells(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            cut = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            found = [close_stars(np.ascontiguousarray(g[:, 4]), g[:, 5], g[:, 6] == 1, distance) for g in np.split(rows, cut) if len(g) > 1 and g[:, 6].any()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            rows = rows if rest is None else np.concatenate([rest, rows])
            change = np.flatnonzero((rows[:-1, :4] != rows[-1, :4]).any(axis=1))
            at = int(change[-1]) + 1 if len(change) else 0
            if at:
                yield from cells(rows[:at])
            rest = rows[at:]
        if rest is not None and len(rest):
            yield from cells(rest)

    return run


def links(prints: DataFrame, scratch: Scratch, distance: int = 3, fp: str = "fp") -> DataFrame:
    """(a, b) fingerprints whose components are those of all links at ``distance``.

    prints: distinct fingerprints.
    """
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    cells = []
    for grid, (lo, hi) in enumerate(grids(distance)):
        mask = (1 << 2 * hi) - (1 << 2 * lo)
        cell = F.col("packed").bitwiseAND(F.lit(signed(mask)))
        cells.append(F.struct(F.lit(grid).alias("grid"), cell.alias("cell"), F.lit(1).alias("home")))
        if distance:
            for k in range(lo, hi):  # a count of 2 has no step above it
                able = F.shiftrightunsigned("packed", 2 * k + 1).bitwiseAND(F.lit(1)) == 0
                step = F.when(F.shiftright("packed", 2 * k).bitwiseAND(F.lit(1)) == 0, F.lit(1 << 2 * k)).otherwise(F.lit(signed(3 << 2 * k)))
                cells.append(F.when(able, F.struct(F.lit(grid).alias("grid"), cell.bitwiseXOR(step).alias("cell"), F.lit(0).alias("home"))))
    named = prints.select(F.col(fp).alias("fp"), embed(F.col(fp)).alias("packed"))
    named = named.select("fp", F.explode(F.array_compact(F.array(*cells))).alias("c")).select("c.grid", "c.cell", "c.home", "fp")
    full = named.groupBy("grid", "cell").agg(F.count("*").alias("n"), F.sum("home").alias("homes")).where("n > 1 and homes > 0").select("grid", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    met = named.join(full, ["grid", "cell"])
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("grid", "cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp", (F.col("own") > F.col("other")).cast("int").alias("side"), "home")
    keys = ["grid", "cell", "x", "y"]
    # A stated number of partitions: the work of a group grows with the square of its rows, so
    # small partitions must not be put together by their bytes.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.repartition(parts, *keys).sortWithinPartitions(*keys)
    return scratch.cut(dealt.mapInArrow(_stars(distance), "a long, b long").distinct(), "links")


def components(df: DataFrame, distance: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id that links reach."""
    scratch = Scratch(df.sparkSession, "simhash")
    docs = scratch.cut(fingerprints(df.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))).drop("text"), "prints")
    prints = docs.groupBy("fp").agg(F.min("doc_id").alias("low"))
    found = connected(links(prints.select("fp"), scratch, distance), scratch)
    # Linked fingerprints only: the others are components by themselves.
    linked = prints.join(found, prints.fp == found.node).select("fp", "root", "low")
    lows = linked.groupBy("root").agg(F.min("low").alias("least"))
    least = prints.join(linked.join(lows, "root").select("fp", "least"), "fp", "left").select("fp", F.coalesce("least", "low").alias("component_id"))
    return docs.join(least, "fp").select("doc_id", "fp", "component_id")


def dedupe(df: DataFrame, distance: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of df whose document has the smallest id of its component; rows without an id stay."""
    gone = components(df, distance, text, doc_id).where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    gone = Scratch(df.sparkSession, "simhash").cut(gone, "gone")  # ids only; the planner knows its size
    return df.join(gone, quoted(doc_id) == gone.gone_id, "left_anti")


def digests(df: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of ``documents``."""
    return components(df).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
