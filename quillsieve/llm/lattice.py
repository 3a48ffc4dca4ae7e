"""Embedding near-duplicates by lattice hashing.

In each of several tables a random projection sends a unit vector to eight dimensions, where its
cell is the nearest point of the lattice E8. A vector is indexed in its own cell and probes the
cells of those lattice neighbours (of 240) that it lies nearest to. Vectors that meet in a cell
are compared by cosine in double precision; those below the threshold never link.

Equal vectors meet as one, with their number. A cell with many vectors is compared in blocks of
bounded size, as pairs of blocks in separate groups. A cell returns, for each of its vectors, the
number of links that no earlier table has found (whether two vectors meet in another table can be
computed from the vectors alone) and a star, and so no pairs are written.

Scale and number of tables are the same for every number of vectors, so whether two vectors link
depends on them alone; recall at a cosine of exactly 0.9 is over 0.95, and higher above it.

Defined results: a vector that is null, empty, zero or has null or non-finite components links
with nothing and is kept; vectors of different sizes don't link; repeated rows of one id count
as separate vectors; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.arrays import mix, quoted
from quillsieve.llm.components import connected
from quillsieve.llm.tables import Scratch

SEED = 20_25
PROBES = 8
#: Vectors of one block of a cell.
BLOCK = 1024
#: Scale of the projection, tables.
SCALE, TABLES = 1.0, 10


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            whole.append(v)
    half = [v for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + half)


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: of D8 or of D8 moved by a half."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def _name(points: np.ndarray, salt: int) -> np.ndarray:
    """64-bit names of lattice points (their last axis), in one table."""
    twice = np.rint(points * 2).astype(np.int64).view(np.uint64)
    name = np.full(points.shape[:-1], salt, np.uint64)
    for k in range(8):
        name = mix(name * np.uint64(0x9FB21C651E98DF25) + twice[..., k])
    return name


def cells(unit: np.ndarray, scale: float, tables: int, probes: int = PROBES) -> np.ndarray:
    """For each unit vector and table the names of its own cell and of the cells it probes."""
    roots, dim = _roots(), unit.shape[1]
    out = np.zeros((len(unit), tables, 1 + probes), np.uint64)
    for t in range(tables):
        rng = np.random.default_rng([SEED, t, dim])
        x = unit @ rng.normal(0, scale, (dim, 8)) + rng.uniform(0, 1, 8)
        home = nearest(x)
        toward = np.argpartition(-((x - home) @ roots.T), probes, axis=1)[:, :probes]
        out[:, t, 0] = _name(home, t * 1000003 + dim)
        out[:, t, 1:] = _name(home[:, None, :] + roots[toward], t * 1000003 + dim)
    return out


def _matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) for each size of vector; no nulls and only finite vectors that aren't zero."""
    sizes = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten()).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = flat[starts[rows][:, None] + np.arange(size)]
        x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of large or tiny numbers
        yield rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cell_rows(scale: float, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, unit in _matrix(batch.column(1)):
                for lo in range(0, len(rows), 2048):
                    names = cells(unit[lo : lo + 2048], scale, tables)
                    ids = batch.column(0).take(pa.array(np.repeat(rows[lo : lo + 2048], names[0].size)))
                    table, probe = np.indices(names.shape)[1:]
                    yield pa.RecordBatch.from_arrays([ids, pa.array(table.ravel().astype(np.int32)), pa.array(names.view(np.int64).ravel()), pa.array((probe == 0).ravel())], ["rep", "table", "cell", "home"])

    return run


def _compare(ids, side, home, many, table, cell, unit, threshold, scale):
    """id, links that are found first in this cell, smallest id reached, of a group."""
    a = np.flatnonzero(side == 0)
    b = np.flatnonzero(side == 1)
    within = not len(b)
    b = a if within else b
    close = unit[a] @ unit[b].T >= threshold
    close &= home[a][:, None] | home[b][None, :]
    if within:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    i, j = a[i], b[j]
    keep = ids[i] != ids[j]
    i, j = i[keep], j[keep]
    if not len(i):
        return None
    used, where = np.unique(np.concatenate([i, j]), return_inverse=True)
    label = np.arange(len(used))
    p, q = where[: len(i)], where[len(i) :]
    own = ids[used]
    while True:
        low = label.copy()
        np.minimum.at(low, p, label[q])
        np.minimum.at(low, q, label[p])
        low = low[low]
        if (low == label).all():
            break
        label = low
    links = np.zeros(len(used), np.int64)
    names = cells(unit[used], scale, table + 1)
    for lo in range(0, len(p), 65536):
        u, v = p[lo : lo + 65536], q[lo : lo + 65536]
        new = np.ones(len(u), bool)
        for t in range(table):
            met = (names[u, t] == names[v, t, :1]).any(axis=1) | (names[v, t] == names[u, t, :1]).any(axis=1)
            new &= ~met
        # Two vectors that probe each other's cell meet in both; the cell of smaller name counts.
        a, b = names[u, table], names[v, table]
        both = (a[:, 1:] == b[:, :1]).any(axis=1) & (b[:, 1:] == a[:, :1]).any(axis=1) & (a[:, 0] != b[:, 0])
        new &= ~both | (np.minimum(a[:, 0], b[:, 0]) == cell)
        np.add.at(links, u[new], many[used[v[new]]])
        np.add.at(links, v[new], many[used[u[new]]])
    return own, links, own[label]


def _groups(threshold: float, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by group (table, cell, x, y); a group is of bounded size."""
        rest: pa.Table | None = None

        def judge(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = rows.combine_chunks()
            key = np.stack([np.asarray(rows.column(k)).astype(np.int64) for k in range(4)], axis=1)
            ids, many = (np.asarray(rows.column(k)) for k in ("rep", "many"))
            side, home = np.asarray(rows.column("side")), np.asarray(rows.column("home"))
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            found = []
            vectors = rows.column("embedding").chunk(0)
            for at, unit in _matrix(vectors):
                place = np.full(len(key), -1)
                place[at] = np.arange(len(at))
                for lo, hi in zip(cuts, cuts[1:]):
                    own = np.arange(lo, hi)[place[lo:hi] >= 0]
                    if len(own) > 1 and home[own].any() and (out := _compare(ids[own], side[own], home[own], many[own], int(key[lo, 0]), key[lo, 1].astype(np.uint64), unit[place[own]], threshold, scale)):
                        found.append(out)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in range(3)], ["rep", "links", "low"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            key = np.stack([np.asarray(rows.column(k)).astype(np.int64) for k in range(4)], axis=1)
            change = np.flatnonzero((key[:-1] != key[-1]).any(axis=1))
            at = int(change[-1]) + 1 if len(change) else 0
            if at:
                yield from judge(rows.slice(0, at))
            rest = rows.slice(at)
        if rest is not None and rest.num_rows:
            yield from judge(rest)

    return run


def link(df: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of df."""
    spark = df.sparkSession
    scratch = Scratch(spark, "lattice")
    raw = df.select(quoted(vec_id).alias("vec_id"), quoted(embedding).alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = F.coalesce(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    # Zero has two signs; a sum with zero leaves one.
    rows = raw.withColumn("good", good).withColumn("embedding", F.when(F.col("good"), F.transform("embedding", lambda x: x + F.lit(0).cast(dict(raw.dtypes)["embedding"][6:-1]))))
    reps = scratch.cut(rows.where("good").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many")), "vectors")
    named = scratch.cut(reps.select("rep", "embedding").mapInArrow(_cell_rows(SCALE, TABLES), "rep long, table int, cell long, home boolean"), "cells")
    full = named.groupBy("table", "cell").agg(F.count("*").alias("n"), F.count_if("home").alias("homes")).where("n > 1 and homes > 0").select("table", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    met = named.join(full, ["table", "cell"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("table", "cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).cast("int").alias("side"), "home", "rep")
    keys = ["table", "cell", "x", "y"]
    dealt = met.join(reps, "rep").select(*keys, "side", "home", "rep", "many", "embedding").repartition(*keys).sortWithinPartitions(*keys)
    found = scratch.cut(dealt.mapInArrow(_groups(threshold, SCALE), "rep long, links long, low long"), "found")
    roots = connected(found.select(F.col("rep").alias("a"), F.col("low").alias("b")), scratch)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = reps.join(counts, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    classes = classes.select("embedding", (F.col("many") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    out = rows.join(classes, "embedding", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
