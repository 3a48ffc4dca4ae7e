"""Text operators against brute force, the tiktoken library and planted cases."""

import hashlib
import pickle
import random
import re
import shutil
import tracemalloc
import zlib
from collections import Counter
from math import log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from quillsieve.llm import bpe, decontam, langid, license_scan, lm, rollup, simhash, substring
from quillsieve.llm.components import connected
from quillsieve.llm.queries import vocabulary
from quillsieve.llm.tables import Scratch

DOCS = "doc_id long, text string"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def sha(x):
    return hashlib.sha256(x).hexdigest()


def words(rng, n, vocabulary=40):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# BPE


def test_bpe_equals_tiktoken(spark):
    v = vocabulary()
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    rng = random.Random(1)
    alphabet = "abc ABC\n\t  '12é日😀<|endoftext|>\x1c\x85 "
    rows = [(0, None), (1, ""), (2, "a" * 20000), (3, "<|endoftext|>"), (4, " \n\n  x")] + [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))) for i in range(5, 200)]
    got = {r.doc_id: r for r in bpe.digests(docs(spark, rows), v).collect()}
    for i, text in rows:
        ids = reference.encode_ordinary(text or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())), text


def test_bpe_keeps_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "hi there", "x", 2)], "doc_id long, text string, ids string, `a.b` int")
    out = bpe.decode(bpe.encode(df, vocabulary()), vocabulary())
    assert out.columns == ["doc_id", "text", "a.b", "ids", "decoded"] and bytes(out.first().decoded) == b"hi there"
    assert bpe.digests(spark.createDataFrame([], DOCS), vocabulary()).count() == 0


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(3000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.slot.tolist()) == list(range(3000)) and h.find(keys).tolist() == list(range(3000))


# Substrings


def brute_removed(rows, width):
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first = {}
    for i in sorted(split):
        for p in range(len(split[i]) - width + 1):
            first.setdefault(tuple(split[i][p : p + width]), i)
    out = {}
    for i, w in split.items():
        gone = set()
        for p in range(len(w) - width + 1):
            if first[tuple(w[p : p + width])] < i:
                gone |= set(range(p, p + width))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("width", [5, 50])
def test_substring_equals_brute_force(spark, width):
    rng = random.Random(width)
    shared = [words(rng, rng.randrange(width, 3 * width)) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, "one"), (3, "x " * 400), (4, "x " * 300), (5, "a b " * 200), (6, "b a " * 200), (7, " ".join(shared[0])), (8, " ".join(shared[0]))]
    for i in range(9, 60):
        parts = words(rng, rng.randrange(2 * width))
        for s in rng.sample(shared, rng.randrange(3)):
            parts += s[rng.randrange(5) :] + words(rng, rng.randrange(9))
        rows.append((i, "  ".join(parts)))
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.dedupe(docs(spark, rows), width).collect()}
    assert got == brute_removed(rows, width)


def test_substring_repeated_rows_and_empty(spark):
    text = " ".join(words(random.Random(3), 80))
    got = substring.dedupe(docs(spark, [(2, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 80), (2, 80)]
    assert substring.digests(spark.createDataFrame([], DOCS)).count() == 0


# SimHash


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)  # so that cells are compared block by block
    rng = random.Random(5)
    base = [words(rng, 300, 5000) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, "Hello"), (3, "hello"), (4, "two words")]
    for i in range(5, 140):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"new{i}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r for r in simhash.digests(docs(spark, rows)).collect()}
    fp = {i: brute_fingerprint(t) for i, t in rows}
    root = {i: i for i in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in fp:
        for j in fp:
            if i < j and (fp[i] ^ fp[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    for i in fp:
        assert got[i].fingerprint == f"{fp[i]:016x}" and got[i].component_id == find(i)
    assert len({find(i) for i in fp}) < len(fp) - 50
    kept = simhash.dedupe(docs(spark, rows)).select("doc_id").collect()
    assert {r.doc_id for r in kept} == {find(i) for i in fp}


def test_grids_meet_within_distance():
    """Of fingerprints within reach one stands in or one step above the other's cell of some grid."""
    rng = random.Random(2)
    counts = lambda x: [(x >> 2 * k & 3).bit_count() for k in range(32)]
    for distance in (0, 1, 2, 3, 4, 6):
        for _ in range(1000):
            a = rng.getrandbits(64)
            b = a
            for k in rng.sample(range(64), distance):
                b ^= 1 << k
            p, q = counts(a), counts(b)
            assert any(sum(abs(x - y) for x, y in zip(p[lo:hi], q[lo:hi])) <= (distance > 0) for lo, hi in simhash.grids(distance))
            steps = simhash.ladder(np.array([a, b], np.uint64))
            assert int(np.bitwise_count(steps[0] ^ steps[1])) == sum(abs(x - y) for x, y in zip(p, q)) <= distance


def test_simhash_links_of_all_near_fingerprints(spark, monkeypatch):
    """Components of planted fingerprints, the extreme ones too, against all pairs."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(6)
    made = {0, 2**64 - 1, 0b111, 2**64 - 8}
    for _ in range(60):
        a = rng.choice([0, 2**64 - 1, rng.getrandbits(64), rng.getrandbits(64)])
        for _ in range(rng.randrange(8)):
            made.add(a)
            for k in rng.sample(range(64), rng.randrange(1, 5)):
                a ^= 1 << k
    fps = sorted(made)
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long").repartition(3)
    scratch = Scratch(spark, "test")
    for distance in (0, 1, 3):
        edges = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= distance}
        got = {r.node % 2**64: r.root % 2**64 for r in connected(simhash.links(df, scratch, distance), scratch).collect()}
        root = {f: f for f in fps}
        find = lambda x: x if root[x] == x else find(root[x])
        for a, b in edges:
            root[find(a)] = find(b)
        groups = lambda of, nodes: {frozenset(n for n in nodes if of(n) == of(m)) for m in nodes}
        linked = {f for e in edges for f in e}
        assert set(got) == linked and groups(got.get, linked) == groups(find, linked)


def test_simhash_null_ids_and_clashing_columns(spark):
    rows = [(None, "a b c d e", 1), (None, "a b c d e", 1), (4, "a b c d e", 1), (5, None, 2), (6, "", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int").selectExpr("*", "1 AS component_id", "2 AS low")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.components(df).collect()), key=str)
    assert got == sorted([(None, 4), (None, 4), (4, 4), (5, 5), (6, 5)], key=str)
    assert simhash.dedupe(df).columns == df.columns and sorted(str(r.doc_id) for r in simhash.dedupe(df).collect()) == ["4", "5", "None", "None"]


# Licenses


def test_license_places_and_suppression(spark):
    rows = [
        (0, None),
        (1, ""),
        (2, "MIT License mit license. Under the Apache\nLicense, Version 2.0 and the GNU General-Public license v3 or later"),
        (3, "SPDX-License-Identifier: MIT"),
        (4, "nothing to see"),
        (5, "K License: Apache  license élan Licensed under CC BY-NC 4.0."),
    ]
    got = {r.doc_id: r for r in license_scan.digests(docs(spark, rows)).collect()}
    upper = {i: i + 32 for i in range(65, 91)}
    for i, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(upper))
        at = sorted((k, label) for phrase, label in license_scan.BASE for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split())
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None)
        assert r.base_labels == ",".join(sorted({label for _, label in at})) and set(r.base_labels.split(",")) <= {*r.labels.split(","), ""}
        assert 0 <= r.score <= 1
    assert got[2].labels == "apache,apache-2.0,gpl,gpl-3.0-or-later,mit"
    assert got[3].labels == "mit" and got[4].labels == "" and got[5].labels == "apache,cc-by-nc-4.0"
    assert len(license_scan.rules()) > 200


def least_matches(pattern):
    """Matches of a rule's pattern: every alternative, and no optional part."""
    from re import _constants as c, _parser

    def texts(parsed):
        out = [""]
        for op, arg in parsed:
            if op is c.LITERAL:
                new = [chr(arg)]
            elif op is c.IN:
                new = {c.LITERAL: lambda x: [chr(x)], c.RANGE: lambda x: [chr(x[0])], c.CATEGORY: lambda x: ["7"]}[arg[0][0]](arg[0][1])
                new += [chr(x) for kind, x in arg[1:] if kind is c.LITERAL]
            elif op is c.CATEGORY:
                new = ["7"]
            elif op is c.ANY:
                new = ["w"]
            elif op is c.MAX_REPEAT:
                new = [x * arg[0] for x in texts(arg[2])] if arg[0] else [""]
            elif op is c.SUBPATTERN:
                new = texts(arg[3])
            elif op is c.BRANCH:
                new = [x for branch in arg[1] for x in texts(branch)]
            else:
                raise ValueError(op)
            out = [a + b for a in out for b in new]
        return out

    return [" ".join(x.split()) for x in texts(_parser.parse(pattern))]


def test_license_rules_contain_root_and_keyword():
    for r in license_scan.rules():
        for text in least_matches(r.pattern):
            assert r.keyword in f" {text} " and any(root in text for root in license_scan.ROOTS), (r, text)


def test_license_each_rule_alone(spark):
    """A least match of a rule, alone in a text, is found with at least the rule's confidence."""
    least = {i: least_matches(r.pattern)[0] for i, r in enumerate(license_scan.rules())}
    rows = [*least.items(), (9000, "available under a Creative Commons Attribution 4.0 International license"), (9001, "Permission is hereby granted, free of charge, to any person obtaining a copy"), (9002, "Proprietary and confidential."), (9003, "available under Apache 2.0")]
    got = {r.doc_id: r for r in license_scan.digests(docs(spark, rows)).collect()}
    assert not [(i, text) for i, text in least.items() if not got[i].labels or not got[i].score]
    assert [got[i].labels for i in range(9000, 9004)] == ["cc-by-4.0", "mit", "proprietary", "apache-2.0"]


def brute_detections(text):
    """All matches of all rules, then suppression by definition."""
    upper = {i: i + 32 for i in range(65, 91)}
    line = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(upper))) + " "
    hits = []
    for rank, r in enumerate(license_scan.rules()):
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", line):
            start = line[: m.start()].count(" ") - 1
            hits.append((start, start + m[0].count(" ") + 1, rank, r))
    inside = lambda x, y: y[3].priority <= x[3].priority and y[0] <= x[0] and x[1] <= y[1] and ((y[0], y[1]) != (x[0], x[1]) or y[2] < x[2])
    return sorted((x[0], x[1], x[3].label, x[3].confidence) for x in hits if not any(inside(x, y) for y in hits))


def test_license_equals_brute_force(spark):
    """Texts of matches in random order, of words between them, a very long one, clashing columns."""
    rng = random.Random(17)
    least = [t for r in license_scan.rules() for t in least_matches(r.pattern)[:3]]
    rows = [(0, None), (1, ""), (2, "Copyright (c) 2020 by mit license all rights reserved"), (3, "MIT License " * 1500)]
    rows += [(i, rng.choice([" ", ", ", " and "]).join(rng.choice([*least, "v 2 0", "or later", "the", "license", "Version 3"]) for _ in range(rng.randrange(1, 40)))) for i in range(4, 120)]
    df = docs(spark, rows).selectExpr("*", "1 AS base", "2 AS detections", "3 AS n_words", "4 AS line")
    for r in license_scan.scan(df).collect():
        assert [tuple(x) for x in r.detections] == brute_detections(r.text), r.text
        assert r.line == 4


# Language model


def test_lm_base_and_shape(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["The cat sat", "the dog ran", "A bird flew"]) for _ in range(20))) for i in range(900)] + [(2000, None), (2001, ""), (2002, "unseenword The")]
    rows += [rows[3]] * 2
    got = lm.digests(docs(spark, rows)).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    counts = Counter(x for i, t in rows if not held(i) for x in tokens(t))
    n, v, texts = sum(counts.values()), len(counts), dict(rows)
    assert len(got) == len(rows)
    for r in got:
        own = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(counts[x] > 0 for x in own), n)
        assert r.base_score == pytest.approx(sum(log10((counts[x] + 1) / (n + v + 1)) for x in own))
    unseen = [r for r in got if r.held_out and r.n_tokens > 10]
    assert unseen and sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert lm.digests(spark.createDataFrame([], DOCS)).count() == 0


def test_lm_counts_are_exact_for_every_word(spark, monkeypatch):
    """Words beyond the frequent list, a very long text, clashing columns, repeated and null ids."""
    monkeypatch.setattr(lm, "FREQUENT", 5)
    rng = random.Random(13)
    rows = [(i, " ".join(words(rng, rng.randrange(40), 30))) for i in range(60)] + [(100, " ".join(words(rng, 30000, 50))), (None, "w1 w2"), (3, "w1 once"), (3, "w1 once")]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS word", "2 AS n", "3 AS train").repartition(4)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(x for i, t in rows if not held(i) for x in [*t.split(), None])
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(t.split()) + 1, round(sum(log10((counts[x] + 1) / (n + v + 1)) for x in [*t.split(), None]), 6)) for i, t in rows)
    got = lm.scores(df).collect()
    assert sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert [lm.network_words(x) for x in (0, 10**5, 10**6, 10**12)] == [256, 256, 1024, 2048]


def test_lm_gradients():
    """Backpropagation against differences."""
    lists = lm.Lists([])
    lists.counted(np.zeros(0, np.int64), 1, 10)
    rng = np.random.default_rng(1)
    net, names = lm.Network(lists), rng.integers(0, lists.size, 12)
    sizes, seen = np.array([7, 5]), {}
    net.adam = lambda grads, n: seen.update({k: g.copy() for k, g in grads.items()})
    net.lanes(names, lists.rank[names], sizes, learn=True)
    cls, word = divmod(int(lists.rank[names][0]), net.size)
    for key, at in (("u", (1, 2)), ("u", (3, 60)), ("c", (0, 1)), ("c", (lm.HIDDEN, cls)), ("x", (int(names[0]), 5)), ("w", (cls, 2, word)), ("w", (cls, lm.HIDDEN, (word + 1) % net.size))):
        loss = []
        for step in (1e-2, -1e-2):
            net.p[key][at] += step
            loss.append(-net.lanes(names, lists.rank[names], sizes, learn=False).astype(np.float64).sum())
            net.p[key][at] -= step
        assert (loss[0] - loss[1]) / 2e-2 == pytest.approx(seen[key][at], abs=2e-3)


def random_network(rng, docs_of: list[int]):
    lists = lm.Lists([str(i).encode() for i in range(400)])
    lists.counted(rng.integers(0, 1000, 400), 50, 3000)
    sizes = np.array(docs_of)
    names = rng.integers(0, 200, int(sizes.sum()))
    names[np.cumsum(sizes) - 1] = lm.END
    return lists, lm.Network(lists), names, sizes


def test_lm_lanes_equal_one_document_at_a_time():
    """Documents that end inside windows, and longer ones than a window, against plain steps."""
    rng = np.random.default_rng(3)
    lists, net, names, sizes = random_network(rng, [1, 70, 33, 32, 5, 1, 100, 64, 2, 31] * 3)
    net.p["c"] += rng.normal(0, 0.3, net.p["c"].shape).astype(np.float32)
    net.p["w"] += rng.normal(0, 0.3, net.p["w"].shape).astype(np.float32)
    p, n = {k: v.astype(np.float64) for k, v in net.p.items()}, lm.HIDDEN
    soft = lambda x: x - np.log(np.exp(x).sum())
    want, at = [], 0
    for size in sizes.tolist():
        h, before = np.zeros(n), lm.END
        for name in names[at : at + size].tolist():
            a, b = p["x"][before], h @ p["u"]
            z, r = 1 / (1 + np.exp(-(a + b)[:n])), 1 / (1 + np.exp(-(a + b)[n : 2 * n]))
            new = np.tanh(a[2 * n :] + r * b[2 * n :])
            h, before = new + z * (h - new), name
            cls, word = divmod(int(lists.rank[name]), net.size)
            s = np.append(h, 1)
            want.append(soft(s @ p["c"])[cls] + soft(s @ p["w"][cls])[word])
        at += size
    assert net.lanes(names, lists.rank[names], sizes, learn=False) == pytest.approx(np.array(want), abs=1e-4)


def test_lm_sums_of_names():
    rng = np.random.default_rng(5)
    for m in (1, 7, 3000):
        for name in (rng.zipf(1.4, m) % 256, np.ones(m, np.int64), rng.integers(0, 256, m)):
            parts = [rng.normal(size=(m, 4)).astype(np.float32) for _ in range(3)]
            want = np.zeros((256, 12))
            np.add.at(want, name, np.concatenate(parts, axis=1))
            assert lm._sums(name, parts, 256) == pytest.approx(want, abs=1e-3)


def test_lm_learning_needs_little_beside_its_tables(monkeypatch):
    """Learning is bound by memory: what a window takes, in numbers a token."""
    monkeypatch.setattr(lm, "UPDATES", 1)
    lists, net, names, sizes = random_network(np.random.default_rng(4), [64] * 512)
    rank = lists.rank[names]
    tracemalloc.start()
    net.lanes(names, rank, sizes, learn=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / 4 / (lm.WINDOW * 512) < 550  # 486; 650 with tables made anew for each step


# Decontamination


def test_decontam_copies_and_templates(spark):
    items = [(1, "Then Alice buys 3 red apples for 5 dollars and walks Alice home with 3 of them today."), (2, "tiny item"), (3, None), (4, "a plain passage of words without any number or name that is long enough to be found")]
    rows = [
        (0, None),
        (1, ""),
        (2, f"Before it. {items[0][1]} After it."),
        (3, "So Bob buys 4 red apples for 9 euros and walks Bob home with 4 of them today."),
        (4, "So Bob buys 4 red apples for 9 euros and walks Eve home with 7 of them today."),
        (5, f"unrelated words, {items[3][1]}, more words"),
        (6, "entirely unrelated words that share nothing with the benchmark at all"),
        (5, "repeated id without anything"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.found(docs(spark, rows), bench).collect()}
    assert set(got) == {(2, 1), (3, 1), (5, 4)} and got[2, 1].same and not got[3, 1].same
    assert {r.doc_id for r in decontam.clean(docs(spark, rows), bench).collect()} == {0, 1, 4, 6}
    assert decontam.found(docs(spark, rows), bench.limit(0)).count() == 0


def test_decontam_of_many_items_through_a_full_filter(spark, monkeypatch):
    """A filter that is far too small lets windows through and changes nothing."""
    monkeypatch.setattr(decontam, "FILTER_BITS", 1)
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, 40, 10000))) for i in range(400)]
    rows = [(i, f"x {t} y") for i, t in items] + [(1000 + i, " ".join(words(rng, 500, 10000))) for i in range(20)]
    got = {(r.doc_id, r.item_id) for r in decontam.found(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, i) for i, _ in items}


def template(text):
    """(kind, core) of each word under both readings, written apart from the operator."""
    out, first = [], True
    for raw in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        core = re.sub(r"^[\W_]+|[\W_]+$", "", raw)
        if core:
            kind = decontam.describe(raw.encode())[1]
            name = kind == decontam.LITERAL and core[0].isupper()
            out.append((core.lower(), decontam.NAME if name else kind, decontam.NAME if name and not first else kind))
        first = raw.rstrip("\"')]»”’")[-1:] in (".", "!", "?", ":")
    return out


def brute_found(item, text):
    """Every alignment of an item with a text, window by window."""
    a, b = template(item), template(text)
    width = min(decontam.WINDOW, len(a))
    total = len(a) - width + 1
    best = None
    for shift in range(-len(a) + 1, len(b)) if a else ():
        value, good, same = {}, 0, True
        for q in range(total):
            p = q + shift
            if p < 0 or p + width > len(b):
                continue
            own, there = a[q : q + width], b[p : p + width]
            plain = [x[0] for x in own] == [x[0] for x in there]
            form = lambda w, k: [x[0] if x[k] == decontam.LITERAL else x[k] for x in w]
            able = lambda k: sum(x[k] == decontam.LITERAL for x in own) >= min(decontam.LITERALS, width)
            if not (plain or width >= decontam.LEAST and any(able(k) and form(own, k) == form(there, k) for k in (1, 2))):
                continue
            new, fits = {}, True
            for x, y in zip(own, there):
                fits &= x[0] == y[0] or (x[1] != decontam.LITERAL and x[1] == y[1])
                if x[1] != decontam.LITERAL:
                    fits &= value.get(x[:2], new.setdefault(x[:2], y[0])) == y[0]
            if fits:
                value |= new
                good += 1
                same &= all(k[0] == v for k, v in new.items())
        if good >= min(decontam.ENOUGH, -(-total // 2)) and total > 0:
            best = max(best or (0,), (good, good / total, same))
    return best


def test_decontam_equals_brute_force(spark):
    """Items with repeated and exchanged names, numbers and units, in texts with edits."""
    rng = random.Random(21)
    pool = "the a of buys sells apples walks home each day with and how many does pay for tells asks left".split()
    def phrase(n):
        return " ".join(rng.choice([*pool, "Anna", "Bob", "12", "7", "km", "days", "5kg", "$3"]) + rng.choice(["", "", "", ".", ",", "?"]) for _ in range(n))
    items = [(i, phrase(rng.choice([0, 2, 4, 7, 8, 9, 14, 25, 40]))) for i in range(40)] + [(50, None), (51, "Anna " * 12), (None, phrase(20))]
    rows = [(0, None), (1, "")]
    for i in range(2, 120):
        parts = [phrase(rng.randrange(12))]
        for _, t in rng.sample(items[:40], rng.randrange(3)):
            for old, new in rng.sample([("Anna", "Eve"), ("12", "13"), ("Bob", "Anna"), ("km", "miles"), ("home", "away"), ("7", "7")], rng.randrange(4)):
                t = t.replace(old, new)
            parts += [t, phrase(rng.randrange(6))]
        rows.append((i, " ".join(parts)))
    rows += [(3, rows[3][1]), (None, items[38][1] or "x"), (None, "clean words only")]
    df = docs(spark, rows).selectExpr("*", "1 AS item_id", "2 AS kind", "'h' AS hash")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS doc_id")
    got = {(r.doc_id, r.item_id): (r.n_windows, r.share, r.same) for r in decontam.found(df, bench).collect()}
    want = {(d, i): best for d, text in rows for i, item in items if i is not None and (best := brute_found(item, text))}
    assert got == want and len(want) > 40 and 0 < sum(not same for _, _, same in want.values())
    left = decontam.clean(df, bench)
    bad = {(d if d is not None else text) for d, text in rows if any(k[0] == d and (d is not None or brute_found(dict(items)[k[1]], text)) for k in want)}
    assert left.columns == df.columns and sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, text in rows if (d if d is not None else text) not in bad)


def test_decontam_finds_every_exact_copy(spark):
    items = [(1, "What is 12 + 7 * 3 - 5?"), (2, "Anna Berta Carla Dora Emil Fritz Gustav Hans Ida Jan"), (3, "1 2 3 4 5 6 7 8 9"), (4, "tiny item"), (5, "Der Hund und die Katze des Nachbarn im Garten"), (6, "?!"), (7, "")]
    rows = [(10 + i, f"so it goes, {t} and no more") for i, t in items] + [(20, "What is 13 + 8 * 4 - 6?"), (21, "a tiny, item"), (22, "tiny other item")]
    got = {(r.doc_id, r.item_id) for r in decontam.found(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(10 + i, i) for i in range(1, 6)} | {(21, 4)}


def test_decontam_ignores_the_text_around(spark):
    """Words capitalised elsewhere in a document change no match of a question with other numbers."""
    item = "A farmer sells 12 eggs on each of 5 mornings. How many of 40 eggs does he sell there?"
    other = item.replace("12", "17").replace(" 5 ", " 6 ").replace("40", "90")
    rows = [(0, other), (1, f"He asked, How Many Eggs and A Farmer. Then came this. {other}"), (2, f"Q {other}"), (3, other.replace(". How", ", how"))]
    rows += [(4, "A baker burns 12 loaves on all of 5 evenings. How few of 40 pans will he need here?")]
    got = {r.doc_id: r.same for r in decontam.found(docs(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {0: False, 1: False, 2: False, 3: False}


ODD_WORDS = "Anna. (buys) 3 $3,000.50 5kg 5KG. km KM! twelve TWELVE, -7 1st 12% don't _x_ __ ... İz ΑΣ' 'Σ ªb x² Ⅷ ٣ ٣km ½ e\u0301tude. «Où» „Wie“ end.\") Straße! ẞ? a:b co-op. x… ’tis \x00y\x1f end.\x00 kg, 二十 Hundred? 7.5kg"


def test_decontam_describes_words_by_their_patterns():
    """The short way for plain words gives what the patterns give."""
    plain = [w.encode() for w in ODD_WORDS.split(" ")] + [b"a\xffb", b"\xff", b"\xe2\x80", b"ok\xe2\x80"]
    for word in plain:
        raw = word.decode("utf-8", "replace")
        core = re.sub(r"^[\W_]+|[\W_]+$", "", raw)
        low = core.lower()
        measure = re.match(r"[+-]?\d[\d.,]*([a-z]+)\Z", low)
        number = re.match(r"[+-]?[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th)?\Z", low)
        kind = decontam.LITERAL
        if number or low in decontam.NUMBERS:
            kind = decontam.NUMBER
        elif low in decontam.UNITS:
            kind = decontam.UNIT
        elif measure and measure[1] in decontam.UNITS:
            kind = decontam.MEASURE
        ends = bool(re.search(r"[.!?:][\"')\]»”’]*\Z", raw))
        assert decontam.describe(word) == (xxhash.xxh3_64_intdigest(low.encode()), kind, core[:1].isupper(), ends, bool(core), low.encode()), word


@pytest.mark.parametrize("width", range(1, 11))
def test_decontam_windows_are_equal_where_their_words_are(width, monkeypatch):
    """Of all widths, over several blocks and texts, and texts shorter than a window."""
    monkeypatch.setattr(decontam, "BLOCK", 16)
    rng = random.Random(width)
    texts = [words(rng, rng.choice([0, 1, 3, width, 30]), 2) for _ in range(40)]
    t = decontam.Templates(pa.array([" ".join(x) for x in texts]))
    want = [(int(t.off[d]) + i, tuple(x[i : i + width])) for d, x in enumerate(texts) for i in range(len(x) - width + 1)]
    at, hashes = t.windows(width, 1)
    assert at.tolist() == [p for p, _ in want]
    assert len(set(zip(hashes.tolist(), (w for _, w in want)))) == len(set(hashes.tolist())) == len({w for _, w in want})


def test_decontam_work_for_a_word_and_a_window(monkeypatch):
    """Plain words need no pattern; a window of 8 words is hashed in 4 rounds."""
    class Counting:
        n = 0

        def sub(self, *args):
            self.n += 1
            return re.sub(r"^[\W_]+|[\W_]+$", *args)

    trim, mixed = Counting(), []
    monkeypatch.setattr(decontam, "_TRIM", trim)
    monkeypatch.setattr(decontam, "_KNOWN", {})
    t = decontam.Templates(pa.array([" ".join(f"{a}{b}{c}{d}." for a in "abcdefgh" for b in "aeiou" for c in "klmnopqrst" for d in "xyz") + " 12 a-b"]))
    assert trim.n == 2
    monkeypatch.setattr(decontam, "mix", lambda x, mix=decontam.mix: mixed.append(len(x)) or mix(x))
    n = len(t.windows(8, 1)[0])
    assert n == 1195 and sum(mixed) < 4.1 * n


# Rollups


def test_rollup_batches_are_idempotent(spark, tmp_path):
    store = rollup.Store(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    d = spark.createDataFrame([(1, "a b", "s", "en"), (2, None, "s", None), (3, "c", None, "en")], "doc_id long, text string, source string, lang string")
    rows = lambda df, sign=1: rollup.deltas(df, {"words-1": rollup.count(F.col("text"), "words-1")}, sign)
    total = lambda: sorted(((r.source, r.lang, r.n_docs, r.n_tokens) for r in store.totals().collect()), key=str)
    for _ in range(2):
        store.commit(1, rows(d))
    whole = sorted([("s", "en", 1, 2), ("s", None, 1, 0), (None, "en", 1, 1)], key=str)
    assert total() == whole
    store.commit(2, rows(d.where("doc_id = 1"), -1))
    assert total() == [x for x in whole if x[:2] != ("s", "en")]
    store.compact()
    assert not store.commit(2, rows(d)) and total() == [x for x in whole if x[:2] != ("s", "en")]


def test_rollup_takes_a_late_batch(spark, tmp_path):
    store = rollup.Store(spark, str(tmp_path / "store"))
    rows = lambda n: spark.createDataFrame([("s", None, "words-1", 1, n)], rollup.SCHEMA)
    total = lambda: [(r.n_docs, r.n_tokens) for r in store.totals().collect()]
    assert store.commit(1, rows(1)) and store.commit(3, rows(100))
    store.compact()
    assert store.commit(2, rows(10)) and total() == [(3, 111)]
    assert store.commit(2, rows(10)) and not store.commit(3, rows(100)) and total() == [(3, 111)]
    store.compact()
    assert not any(store.commit(b, rows(1000)) for b in (1, 2, 3)) and total() == [(3, 111)]
    assert store.commit(4, rows(1000)) and total() == [(4, 1111)]


def test_rollup_survives_a_stop_at_any_point(spark, tmp_path):
    """A batch that is written again in part, or a base that is, takes nothing away."""
    store = rollup.Store(spark, str(tmp_path / "store"))
    rows = lambda n: spark.createDataFrame([("s", None, "words-1", 1, n)], rollup.SCHEMA)
    total = lambda: [(r.n_docs, r.n_tokens) for r in store.totals().collect()]
    store.commit(1, rows(1))
    (tmp_path / "store" / "batch=1.1").mkdir()  # begun, never ended
    (tmp_path / "store" / "base=0.0").mkdir()
    assert total() == [(1, 1)]
    with pytest.raises(Exception, match="stop here"):
        store.commit(1, rows(5).withColumn("n_tokens", F.raise_error(F.lit("stop here")).cast("long")))
    assert total() == [(1, 1)]
    assert store.commit(1, rows(7)) and store.commit(2, rows(10)) and total() == [(2, 17)]
    kept = tmp_path / "kept"
    shutil.copytree(tmp_path / "store" / "batch=2.0", kept)
    store.compact()
    shutil.copytree(kept, tmp_path / "store" / "batch=2.0")  # stopped before it was deleted
    assert total() == [(2, 17)]
    store.compact()
    assert total() == [(2, 17)] and sorted(x.name for x in (tmp_path / "store").iterdir()) == ["base=1.0"]


def test_rollup_of_bpe_tokens(spark, tmp_path):
    """Two vocabularies as tokenizer versions, a revision from one to the other, against tiktoken."""
    second = bpe.Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = [(1, "Hello there, world", "a", "en"), (2, "Grüße an alle 123", "a", "de"), (3, None, "b", None), (4, "Hello there, world", "a", "en")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    both = rollup.bpe_count(rollup.bpe_count(d, vocabulary(), "one"), second, "two")
    store = rollup.Store(spark, str(tmp_path / "store"))
    store.commit(1, rollup.deltas(both, {"bpe-one": F.col("one")}))
    store.commit(2, rollup.deltas(both.where("doc_id < 3"), {"bpe-one": F.col("one")}, -1).union(rollup.deltas(both.where("doc_id < 3"), {"bpe-two": F.col("two")})))
    size = lambda v, t: len(tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={}).encode_ordinary(t or ""))
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in store.totals().collect()}
    assert got == {("a", "en", "bpe-one"): (1, size(vocabulary(), rows[3][1])), ("b", None, "bpe-one"): (1, 0), ("a", "en", "bpe-two"): (1, size(second, rows[0][1])), ("a", "de", "bpe-two"): (1, size(second, rows[1][1]))}


# Language


def test_langid_held_out(spark):
    rng = random.Random(9)
    parts = {"aa": ["tion", "the", "ing", "and"], "bb": ["eux", "le", "que", "oi"], "cc": ["ung", "sch", "der", "keit"]}
    make = lambda lang: " ".join("".join(rng.choices(parts[lang], k=rng.randrange(1, 4))) for _ in range(30))
    rows = [(i, make(lang), lang) for i, lang in ((i, rng.choice(list(parts))) for i in range(300))] + [(1000, None, "aa"), (1001, "", None), (1002, "12 + 34 !", "bb"), (1003, make("cc"), None)]
    df = spark.createDataFrame(rows, DOCS + ", lang string")
    got = {r.doc_id: r for r in langid.digests(df).collect()}
    held = [(i, lang) for i, _, lang in rows[:300] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i, _ in held) and sum(got[i].lang_pred == lang for i, lang in held) >= 0.95 * len(held)
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "cc"]
    assert all(0 <= r.score <= 1 for r in got.values())
    none = langid.digests(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_langid_refuses_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    monkeypatch.setattr(langid, "SAMPLE_TEXTS", 2)
    make = lambda n: spark.createDataFrame([(f"word{i} text", f"l{k}") for k in range(n) for i in range(2)], "text string, lang string")
    assert langid.fit(make(3)).languages == ["l0", "l1", "l2"]
    with pytest.raises(ValueError, match="more than 3 languages"):
        langid.fit(make(4))


def test_langid_reads_running_text():
    """Longest matches go across words; only letters count."""
    assert langid.running(" Ab,c 12\u00bd D_e\n") == " ab c d e " and langid.running("12 \u00bd\u00b2 _") == ""
    model = langid.Model({"x": [" one two three "], "y": [" two one three "]})
    assert [a.phrases(" one two ") for a in model.automata] == [1, 2]
    names, scores = model.predict(pa.array(["One TWO", "two, one?", None, "", "7"]))
    assert names == ["x", "y", "und", "und", "und"] and (scores[2:] == 0).all() and (scores[:2] > 0).all()


def test_langid_equals_brute_force(spark):
    """Each prediction is the least number of greedy phrases times bits, over whole texts."""
    rng = random.Random(11)
    make = lambda alphabet: " ".join("".join(rng.choices(alphabet, k=rng.randrange(1, 7))) for _ in range(rng.randrange(1, 60)))
    rows = [(i, make("abcde" if i % 2 else "cdefg"), "odd" if i % 2 else "even") for i in range(60)] + [(100, make("abcdefg") * 400, None), (100, "abc", "odd"), (None, "fgf", None)]
    df = spark.createDataFrame(rows, DOCS + ", lang string").selectExpr("*", "1 AS score", "'z' AS lang_pred").repartition(3)
    model = langid.fit(df)
    parts = {}
    for name, a in zip(model.languages, model.automata):
        parts[name] = ("\0".join(langid.running(t) for _, t, lang in rows if lang == name), a.bits)
    for r in langid.predict(df, model).collect():
        text, costs = langid.running(r.text), {}
        for name, (known, bits) in parts.items():
            at = n = 0
            while at < len(text):
                k = 1
                while at + k < len(text) and text[at : at + k + 1] in known:
                    k += 1
                at, n = at + k, n + 1
            costs[name] = n * bits
        best, second = sorted(costs.values())
        assert (r.lang_pred, r.score) == (min(costs, key=lambda k: (costs[k], k)), pytest.approx(1 - best / second))
    assert langid.predict(df, model).columns == ["doc_id", "text", "lang", "lang_pred", "score"]


def test_automaton_phrases(monkeypatch):
    """Greedy longest matches, compared with a search in all substrings."""
    rng = random.Random(3)
    known = ["".join(rng.choices("abc", k=rng.randrange(1, 9))) for _ in range(30)]
    parts = {w[i:j] for w in known for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    automaton, tried = langid.SuffixAutomaton(known), []
    for _ in range(300):
        word, at, n = "".join(rng.choices("abcdé", k=rng.randrange(40))), 0, 0
        while at < len(word):
            at += max([k for k in range(1, len(word) - at + 1) if word[at : at + k] in parts], default=1)
            n += 1
        assert automaton.phrases(word) == n
        tried.append((word, n))
    # Side by side, wholly or until few are left, and without a table.
    tried.sort(key=lambda x: -len(x[0]))
    texts, want = [t for t, _ in tried if t], [n for t, n in tried if t]
    second = langid.SuffixAutomaton([w[::-1] for w in known[:9]])
    for few, table in ((1, 10**6), (48, 10**6), (10**6, 10**6), (1, 0), (1, 4 * second.states)):
        monkeypatch.setattr(langid, "FEW", few)
        monkeypatch.setattr(langid, "TABLE", table)
        both = langid.Parser(pickle.loads(pickle.dumps([automaton, second])))
        assert both.phrases(texts).tolist() == [want, [second.phrases(t) for t in texts]]
