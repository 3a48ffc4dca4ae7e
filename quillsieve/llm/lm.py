"""Language-model scores: a unigram base and a gated recurrent model.

Counts. A first pass counts the words of all training documents (each slice of texts aggregates
its own before the shuffle). The most frequent words by these exact counts, up to FREQUENT, go to
every task; a second pass writes each document as two bytes a word, which is what the model reads, and
(word, document) rows of the other words, to which their counts are joined. No table of all words
is held anywhere, and every count covers all training documents.

Model. A gated recurrent network reads the document word by word; the most frequent words (with
the end, and one name for all other words) are predicted by a softmax over classes and one within
the class. The number of words grows with the square root of the training tokens up to MOST_WORDS,
which bounds a worker's memory. Another word's probability is that of the common name times its
smoothed share among such words. Each task trains on all of its training documents by truncated
backpropagation in numpy, in windows through which the state is carried, from the same start (the
counts); the tasks' weights are averaged by tokens. Documents run side by side in lanes; scoring
carries the state through a whole document, whatever its length.

Defined results: a null text is an empty one and has the end as its only token; a null doc_id is a
training document; repeated rows get equal scores; other columns are ignored; without training
documents N and V are 0 and the model is its start; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.arrays import Words, binary, bounds, pieces, quoted, ragged, steps
from quillsieve.llm.tables import Scratch

#: At most RARE words, as a place takes two bytes.
FREQUENT = RARE = 65_535
#: Names of the network's words: a power of two from LEAST_WORDS to MOST_WORDS, by training tokens.
LEAST_WORDS, MOST_WORDS = 256, 2048
CLASSES, HIDDEN = 32, 24
#: Tokens after which the state starts anew while learning (never while scoring), so that a long
#: document fills many lanes.
STRETCH = 2048
#: Weights in a row of the rows that are averaged.
PART = 4096
WINDOW, RATE, MOST_LANES, LARGEST, UPDATES = 32, 0.02, 512, 5, 100
#: Rows of a class whose words are weighed at once, so that they stay in a core's cache.
BLOCK = 1024
#: Rows of a name from which on a matrix product adds them.
LONG = 16
END, OTHER = 0, 1  # names of the end and of words outside the list
LN10 = float(np.log(10))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(quoted(doc_id).cast("string")) % 7 == 2, F.lit(False))


class Lists:
    """Frequent words and, once counted, their counts and names in the network."""

    def __init__(self, words: list[bytes], size: int = LEAST_WORDS):
        self.words, self.size = words, size
        self.place = {w: i for i, w in enumerate(words)}

    def places(self, distinct: list[bytes]) -> np.ndarray:
        get = self.place.get
        return np.fromiter((get(w, RARE) for w in distinct), np.int64, len(distinct))

    def counted(self, counts: np.ndarray, ends: int, others: int) -> None:
        """names: the network's name of each frequent word; order: names by falling count."""
        n = len(counts)
        self.log, self.known, self.names = np.zeros(RARE + 1), np.zeros(RARE + 1, bool), np.full(RARE + 1, OTHER, np.int64)
        self.log[:n], self.known[:n] = np.log10(counts + 1.0), counts > 0
        top = np.lexsort((np.arange(n), -counts))[: self.size - 2]
        top = top[counts[top] > 0]
        self.names[top] = np.arange(2, 2 + len(top))
        total = np.zeros(self.size)
        total[2 : 2 + len(top)] = counts[top]
        total[END], total[OTHER] = ends, others + counts.sum() - counts[top].sum()
        order = np.argsort(-total, kind="stable")
        self.rank = np.empty(self.size, np.int64)
        self.rank[order] = np.arange(self.size)
        self.total = np.maximum(total[order], 0.01)  # by rank


class Network:
    """Gated recurrent network; the input is the name before, the output class and word."""

    def __init__(self, lists: Lists, flat: np.ndarray | None = None):
        """Weights as given; or a start that predicts by counts alone."""
        rng = np.random.default_rng(11)
        self.size = lists.size // CLASSES
        self.shapes = {"x": (lists.size, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "c": (HIDDEN + 1, CLASSES), "w": (CLASSES, HIDDEN + 1, self.size)}
        self.p, at = {}, 0
        for k, shape in self.shapes.items():
            n = int(np.prod(shape))
            self.p[k] = (rng.normal(0, 0.1, shape) if flat is None else flat[at : at + n].reshape(shape)).astype(np.float32)
            at += n
        if flat is None:
            inside = np.log(lists.total.reshape(CLASSES, -1))
            classes = np.log(lists.total.reshape(CLASSES, -1).sum(axis=1))
            self.p["c"][HIDDEN] = np.clip(classes - classes.mean(), -LARGEST, LARGEST)
            self.p["w"][:, HIDDEN] = np.clip(inside - inside.mean(axis=1, keepdims=True), -LARGEST, LARGEST)
        self.m = {k: np.zeros(s, np.float32) for k, s in self.shapes.items()}
        self.v = {k: np.zeros(s, np.float32) for k, s in self.shapes.items()}
        self.t = 0

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.shapes]).astype(np.float64)

    def output(self, states: np.ndarray, target: np.ndarray, learn: dict | None = None):
        """ln P of each target (by rank) given the state before it; gradients if ``learn``."""
        size, m = self.size, len(target)
        cls = target // size
        order = np.argsort(cls.astype(np.uint16), kind="stable")  # sorted by radix
        cuts = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
        s = states.take(order, axis=0)
        word = (target - cls * size).take(order) + np.arange(m) * size  # places in a flat table of sorted rows
        cls = cls.take(order) + np.arange(m) * CLASSES
        p, n = self.p["c"], HIDDEN  # the last row is the bias
        e = s @ p[:n]  # weights are bounded, so no exponential overflows
        e += p[n]
        found = e.ravel().take(cls)
        np.exp(e, out=e)
        total = e @ np.ones(CLASSES, np.float32)
        back = None
        if learn is not None:
            e *= (1 / total)[:, None]
            e.ravel()[cls] -= 1
            learn["c"] = np.concatenate([s.T @ e, np.ones((1, m), np.float32) @ e])
            back = e @ p[:n].T
            learn["w"] = np.zeros(self.shapes["w"], np.float32)
        ones, row, inside = np.ones(size, np.float32), np.ones(BLOCK, np.float32), np.empty(m, np.float32)
        room, spare = np.empty((BLOCK, size), np.float32), np.empty((BLOCK, n), np.float32)
        for c in range(CLASSES):
            p = self.p["w"][c]
            for lo in range(cuts[c], cuts[c + 1], BLOCK):
                hi = min(lo + BLOCK, cuts[c + 1])
                sc, at, e = s[lo:hi], word[lo:hi] - lo * size, room[: hi - lo]
                np.matmul(sc, p[:n], out=e)
                e += p[n]
                found[lo:hi] += e.ravel().take(at)
                np.exp(e, out=e)
                np.matmul(e, ones, out=inside[lo:hi])
                if learn is not None:
                    e *= (1 / inside[lo:hi])[:, None]
                    e.ravel()[at] -= 1
                    learn["w"][c, :n] += sc.T @ e
                    learn["w"][c, n] += row[: hi - lo] @ e
                    back[lo:hi] += np.matmul(e, p[:n].T, out=spare[: hi - lo])
        place = np.empty(m, np.int64)
        place[order] = np.arange(m)
        out = (found - np.log(total) - np.log(inside)).take(place)
        return out, back if back is None else back.take(place, axis=0)

    def adam(self, grads: dict[str, np.ndarray], n: int) -> None:
        self.t += 1
        rate = np.float32(RATE * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t))
        for k, g in grads.items():
            g = (g / n).astype(np.float32, copy=False)
            np.clip(g, -1, 1, out=g)
            m, v, p = self.m[k], self.v[k], self.p[k]
            m *= np.float32(0.9)
            m += np.float32(0.1) * g
            v *= np.float32(0.999)
            g *= g
            g *= np.float32(0.001)
            v += g
            np.sqrt(v, out=g)
            g += np.float32(1e-6)
            np.divide(m, g, out=g)
            g *= rate
            p -= g
            np.clip(p, -LARGEST, LARGEST, out=p)

    def lanes(self, names: np.ndarray, rank: np.ndarray, sizes: np.ndarray, learn: bool) -> np.ndarray:
        """ln P of every token of some documents, in order; learns from each window if asked."""
        total, n = int(sizes.sum()), HIDDEN
        out = np.zeros(total, np.float32)
        if not total:
            return out
        heads = np.cumsum(sizes) - sizes
        starts = heads
        if learn:
            pieces = -(-sizes // STRETCH)
            place = ragged(np.zeros(len(sizes), np.int64), pieces)
            starts = np.repeat(heads, pieces) + STRETCH * place
            sizes = np.minimum(np.repeat(sizes, pieces) - STRETCH * place, STRETCH)
        # Learning needs windows one after the other: few documents take fewer lanes.
        count = int(np.clip(total // (WINDOW * UPDATES if learn else 1024), 4 if learn else 16, MOST_LANES))
        load = [(0, i) for i in range(min(count, len(sizes)))]
        parts: list[list[int]] = [[] for _ in load]
        for d in np.argsort(-sizes, kind="stable").tolist():
            used, lane = heapq.heappop(load)
            parts[lane].append(d)
            heapq.heappush(load, (used + int(sizes[d]), lane))
        tokens = [np.concatenate([np.arange(starts[d], starts[d] + sizes[d]) for d in part]) for part in parts]
        tokens.sort(key=len, reverse=True)
        lens = np.array([len(t) for t in tokens])
        at = np.full((int(lens[0]), len(tokens)), -1, np.int64)  # the token of each step and lane
        for lane, t in enumerate(tokens):
            at[: len(t), lane] = t
        first = np.zeros(total, bool)
        first[starts] = True
        previous = np.empty(total, np.int64)
        previous[1:], previous[0] = names[:-1], END
        previous[heads] = END
        h = np.zeros((len(tokens), n), np.float32)
        active = np.searchsorted(-lens, -np.arange(len(at))).tolist()  # lanes with a token left
        room = np.empty((10, WINDOW * len(tokens), n), np.float32)  # for all windows, one after the other
        product = np.empty((3, len(tokens), n), np.float32)
        for lo in range(0, len(at), WINDOW):
            hi = min(lo + WINDOW, len(at))
            edges = np.cumsum([0, *active[lo:hi]]).tolist()
            token = np.concatenate([at[t, : active[t]] for t in range(lo, hi)])
            m, each = len(token), range(hi - lo)
            name = previous[token]
            fresh = np.flatnonzero(first[token])  # states that start anew
            cut = np.searchsorted(fresh, edges)
            anew = [fresh[cut[t] : cut[t + 1]] - edges[t] for t in each]
            # Gates lie one after the other (update, reset, new), so that each is one run of memory.
            # The first two are sigmoids, by way of tanh of half their input.
            half = np.array([0.5, 0.5, 1], np.float32)
            u = np.ascontiguousarray(self.p["u"].reshape(n, 3, n).transpose(1, 0, 2))
            x = self.p["x"].reshape(-1, 3, n)
            before, states, hidden, d_new, gates, d = *room[:4, :m], room[4:7, :m], room[7:, :m]
            for k in range(3):
                np.take(x[:, k] * half[k], name, axis=0, out=gates[k], mode="clip")
            u_half = u * half[:, None, None]
            for t in each:
                a, b = edges[t], edges[t + 1]
                h0, gate, new, bn, own = before[a:b], gates[:2, a:b], gates[2, a:b], hidden[a:b], states[a:b]
                h0[:] = h[: b - a]
                h0[anew[t]] = 0
                gate += np.matmul(h0, u_half[:2], out=product[:2, : b - a])
                np.tanh(gate, out=gate)
                gate *= np.float32(0.5)
                gate += np.float32(0.5)
                np.matmul(h0, u[2], out=bn)
                new += np.multiply(gate[1], bn, out=product[2, : b - a])
                np.tanh(new, out=new)
                np.subtract(h0, new, out=own)
                own *= gate[0]
                own += new
                h = own
            grads: dict | None = {} if learn else None
            out[token], back = self.output(states, rank[token], grads)
            if not learn:
                continue
            z, r, new = gates
            # What the gradient of a state is multiplied by: towards update, reset and new.
            to_z, to_n, to_r = before - new, 1 - new * new, hidden * r
            rest = 1 - z
            to_z *= z
            to_z *= rest
            to_n *= rest
            to_r *= 1 - r
            back_u = np.ascontiguousarray(u.transpose(0, 2, 1))
            dh = np.zeros_like(h)
            for t in reversed(each):
                a, b = edges[t], edges[t + 1]
                g, dn = back[a:b], d_new[a:b]
                g[: len(dh)] += dh[: len(g)]
                np.multiply(g, to_n[a:b], out=dn)
                np.multiply(g, to_z[a:b], out=d[0, a:b])
                np.multiply(dn, to_r[a:b], out=d[1, a:b])
                np.multiply(dn, r[a:b], out=d[2, a:b])
                dh = g * z[a:b]
                for part in np.matmul(d[:, a:b], back_u, out=product[:, : b - a]):
                    dh += part
                dh[anew[t]] = 0
            grads["u"] = np.concatenate(before.T @ d, axis=1)
            grads["x"] = _sums(name, [d[0], d[1], d_new], len(self.p["x"]))
            self.adam(grads, m)
        return out


def _sums(name: np.ndarray, parts: list[np.ndarray], n: int) -> np.ndarray:
    """Sums of the rows of each name, of some tables side by side. Long groups are sums by matrix
    products, which are quicker; the rows of OTHER, about half of all, stay where they are."""
    out = np.empty((n, len(parts), parts[0].shape[1]), np.float32)
    usual = (name == OTHER).astype(np.float32)
    at = np.flatnonzero(name != OTHER)
    own = name[at].astype(np.uint16)
    at = at[np.argsort(own, kind="stable")]
    flat = out.reshape(n, -1)
    rows = np.empty((len(at), flat.shape[1]), np.float32)
    for k, part in enumerate(parts):
        rows[:, k * out.shape[2] : (k + 1) * out.shape[2]] = part.take(at, axis=0)
    count = np.bincount(own, minlength=n)
    end = np.cumsum(count)
    flat[:] = 0
    ones = np.ones(int(count.max()), np.float32)
    for k in np.flatnonzero(count >= LONG).tolist():
        np.matmul(ones[: count[k]], rows[end[k] - count[k] : end[k]], out=flat[k])
    few = np.flatnonzero((count > 0) & (count < LONG))
    if len(few):
        at = ragged(end[few] - count[few], count[few])
        flat[few] = np.add.reduceat(rows.take(at, axis=0), np.cumsum(count[few]) - count[few], axis=0)
    for k, part in enumerate(parts):
        out[OTHER, k] = usual @ part
    return flat


class Coded:
    """Documents as places in the frequent list, two bytes a word; each gets its end."""

    def __init__(self, arr: pa.Array, lists: Lists):
        off, data = bounds(arr)
        off = off // 2
        self.place = np.ascontiguousarray(data).view("<u2").astype(np.int64)
        self.doc = np.repeat(np.arange(len(arr)), np.diff(off))
        self.sizes = np.diff(off) + 1
        self.names = np.full(int(self.sizes.sum()), END, np.int64)
        self.words = np.arange(len(self.place)) + self.doc  # the tokens that aren't ends
        self.names[self.words] = lists.names[self.place]


ROWS = "word binary, doc_id long, tid long, train boolean, n long, codes binary"


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to words and their counts, aggregated slice by slice."""
    for batch in batches:
        for part in steps(batch, 0):
            codes, distinct = Words(part.column(0), lower=True).coded()
            yield pa.RecordBatch.from_arrays([distinct.cast(pa.binary()), pa.array(np.bincount(codes, minlength=len(distinct)))], ["word", "n"])


def _code_rows(shared):
    """Columns doc_id, tid, train, text to two kinds of ROWS: a word of a document that isn't
    frequent; a document, with its codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared.value
        names = [f.split()[0] for f in ROWS.split(", ")]
        for batch in batches:
            for part in steps(batch, 3):
                w = Words(part.column(3), lower=True)
                codes, distinct = w.coded()
                place = lists.places(pieces(distinct))[codes]
                doc = np.repeat(np.arange(len(part)), w.counts)
                rare = np.flatnonzero(place == RARE)
                pair, n = np.unique(doc[rare] * max(1, len(distinct)) + codes[rare], return_counts=True)
                at = pa.array(pair // max(1, len(distinct)))
                word = distinct.cast(pa.binary()).take(pa.array(pair % max(1, len(distinct))))
                yield pa.RecordBatch.from_arrays([word, *[part.column(k).take(at) for k in range(3)], pa.array(n), pa.nulls(len(pair), pa.binary())], names)
                packed = binary(w.off * 2, place.astype("<u2").view(np.uint8))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(part), pa.binary()), *part.columns[:3], pa.nulls(len(part), pa.int64()), packed], names)

    return run


def _train_rows(shared):
    """Codes to the task's weights times its tokens, PART weights a row, and the tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, net, seen = shared.value, Network(shared.value), 0
        for batch in batches:
            for part in steps(batch, 0):
                t = Coded(part.column(0), lists)
                net.lanes(t.names, lists.rank[t.names], t.sizes, learn=True)
                seen += len(t.names)
        if seen:
            flat = net.flat() * seen
            parts = [flat[lo : lo + PART].tobytes() for lo in range(0, len(flat), PART)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array(parts, pa.binary()), pa.array(np.full(len(parts), float(seen)))], ["at", "weights", "tokens"])

    return run


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of weights added up by place; holds one row a place, however many tasks there were."""
    sums: dict[int, np.ndarray] = {}
    tokens: dict[int, float] = {}
    for batch in batches:
        for at, weights, n in zip(*(c.to_pylist() for c in batch.columns)):
            sums[at] = sums.get(at, 0) + np.frombuffer(weights)
            tokens[at] = tokens.get(at, 0.0) + n
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary()), pa.array(list(tokens.values()))], ["at", "weights", "tokens"])


def _learned(marks: DataFrame, ready, start: np.ndarray) -> np.ndarray:
    """Weights averaged over the tasks by their tokens; the start without training documents."""
    rows = "at long, weights binary, tokens double"
    spread = marks.where("train").select("codes").mapInArrow(_train_rows(ready), rows).repartition("at")
    flat = start.copy()
    for row in spread.mapInArrow(_sum_rows, rows).collect():  # one row a PART of the weights
        flat[row["at"] * PART : (row["at"] + 1) * PART] = np.frombuffer(row["weights"]) / row["tokens"]
    return flat


def _score_rows(shared, weights):
    """Columns doc_id, tid, train, codes to the sums that need no rare word's count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, net = shared.value, Network(shared.value, weights.value)
        for batch in batches:
            for part in steps(batch, 3):
                t, n = Coded(part.column(3), lists), len(part)
                ln = net.lanes(t.names, lists.rank[t.names], t.sizes, learn=False)
                model = np.bincount(np.repeat(np.arange(n), t.sizes), ln, minlength=n) / LN10
                log, other = lists.log[t.place], lists.names[t.place] == OTHER
                made = [model, np.bincount(t.doc, log, minlength=n), np.bincount(t.doc, log * other, minlength=n)]
                counts = [np.bincount(t.doc[other], minlength=n), np.bincount(t.doc[lists.known[t.place]], minlength=n), t.sizes]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *[pa.array(m) for m in made + counts]], ["doc_id", "tid", "train", "model", "usual", "other", "n_other", "n_usual", "n_tokens"])

    return run


def _frequent(counts: DataFrame) -> list:
    """The words whose counts are the highest, at most FREQUENT: all words of the highest buckets of
    the logarithm of counts that fit together. Nothing else reaches the driver."""
    bucket = F.floor(F.log2("c") * 64)
    sizes = counts.groupBy(bucket.alias("b")).count().collect()  # a few thousand rows at most
    least, room = None, FREQUENT
    for row in sorted(sizes, key=lambda r: -r["b"]):
        room -= row["count"]
        if room < 0:
            break
        least = row["b"]
    if least is None:
        return []
    return sorted(counts.where(bucket >= least).collect(), key=lambda r: (-r["c"], bytes(r["word"])))


def network_words(tokens: int) -> int:
    """The power of two next to the square root of the tokens, within the bounds."""
    return int(np.clip(2 ** round(np.log2(max(1, tokens)) / 2), LEAST_WORDS, MOST_WORDS))


def scores(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row."""
    spark = df.sparkSession
    scratch = Scratch(spark, "lm")
    docs = df.select(quoted(doc_id).cast("long").alias("doc_id"), F.xxhash64(quoted(text)).alias("tid"), held_out(doc_id).alias("held_out"), quoted(text).cast("string").alias("text"))
    train = docs.where("not held_out")
    counts = scratch.cut(train.select("text").mapInArrow(_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    top = _frequent(counts)
    usual = np.array([row["c"] for row in top], np.int64)
    ends = train.select("held_out").count()
    seen = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = seen["n"] + ends, seen["v"] + (ends > 0)
    lists = Lists([bytes(row["word"]) for row in top], network_words(n))
    lists.counted(usual, ends, seen["n"] - int(usual.sum()))
    other = lists.names[: len(usual)] == OTHER
    n_other, v_other = seen["n"] - int(usual[~other].sum()), seen["v"] - int((~other).sum())

    ready = spark.sparkContext.broadcast(lists)  # bound: FREQUENT words
    rows = scratch.cut(docs.select("doc_id", "tid", (~F.col("held_out")).alias("train"), "text").mapInArrow(_code_rows(ready), ROWS), "rows")
    rare = rows.where("word is not null")
    marks = rows.where("word is null")
    joined = rare.join(counts, "word", "left").select("doc_id", "tid", (F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("log"), F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("known"), F.lit(0).alias("copies"))
    every = joined.union(marks.select("doc_id", "tid", F.lit(0.0), F.lit(0), F.lit(1)))
    per = every.groupBy("doc_id", "tid").agg(F.sum("log").alias("log"), F.sum("known").alias("known"), F.sum("copies").alias("copies"))
    per = scratch.cut(per.select(F.col("doc_id").alias("d"), F.col("tid").alias("t"), (F.col("log") / F.col("copies")).alias("rare"), (F.col("known") / F.col("copies")).cast("long").alias("n_rare")), "documents")
    scratch.drop(counts)

    weights = spark.sparkContext.broadcast(_learned(marks, ready, Network(lists).flat()))
    shape = "doc_id long, tid long, train boolean, model double, usual double, other double, n_other long, n_usual long, n_tokens long"
    judged = marks.select("doc_id", "tid", "train", "codes").mapInArrow(_score_rows(ready, weights), shape)
    end_log, base_log, other_log = float(np.log10(ends + 1)), float(np.log10(n + v + 1)), float(np.log10(n_other + v_other + 1))
    return judged.join(per, F.expr("doc_id <=> d and tid = t")).select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("n_usual") + F.col("n_rare") + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("usual") + F.col("rare") + end_log - F.col("n_tokens") * base_log).alias("base_score"),
        (F.col("model") + F.col("other") + F.col("rare") - F.col("n_other") * other_log).alias("score"),
    )


def digests(df: DataFrame) -> DataFrame:
    return scores(df.select("doc_id", "text"))
