"""Embeddings, components, conversations and the pipeline against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np

import corpus_pipeline
from quillsieve.llm import chat, jaccard, lattice
from quillsieve.llm.components import connected
from quillsieve.llm.queries import op6_chat
from quillsieve.llm.tables import Scratch


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(connected(df, Scratch(spark, "test")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}
    assert connected(df.limit(0), Scratch(spark, "test")).count() == 0


def test_lattice_nearest_is_nearest():
    rng = np.random.default_rng(0)
    x, roots = rng.normal(0, 2, (500, 8)), lattice._roots()
    near = lattice.nearest(x)
    others = near[:, None, :] + roots[None]
    assert len(roots) == 240 and ((x - near) ** 2).sum(1).max() <= 1 + 1e-9
    assert (((x[:, None, :] - others) ** 2).sum(2) >= ((x - near) ** 2).sum(1)[:, None] - 1e-9).all()


def test_lattice_links(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 16)
    rng = np.random.default_rng(1)
    rows, centre = [], rng.normal(size=(30, 64))
    for i in range(400):
        c = centre[rng.integers(30)]
        rows.append((i, [float(v) for v in (c / np.linalg.norm(c) + rng.normal(0, rng.choice([0.01, 0.04, 0.3]), 64)).astype(np.float32)]))
    rows += [(500 + i, rows[0][1]) for i in range(3)] + [(600, None), (601, []), (602, [0.0] * 64), (603, [float("nan")] * 64), (604, [None] + [1.0] * 63), (605, [float("inf")] + [1.0] * 63), (606, [1.0, 2.0])]
    got = {r.vec_id: r for r in lattice.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    able = [(i, np.array(e)) for i, e in rows if e and len(e) == 64 and all(v is not None and np.isfinite(v) for v in e) and any(e)]
    ids, x = np.array([i for i, _ in able]), np.array([e / np.linalg.norm(e) for _, e in able])
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    true, found = close.sum(1), np.array([got[int(i)].n_links for i in ids])
    assert (found <= true).all() and found.sum() >= 0.95 * true.sum() and len(got) == len(rows)
    # Components: all links that brute force knows, but for those that no table met.
    root = {int(i): int(i) for i in ids}
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in zip(*np.nonzero(close)):
        a, b = sorted((find(int(ids[a])), find(int(ids[b]))))
        root[b] = a
    assert sum(got[i].component_id == find(i) for i in root) >= 0.98 * len(root)
    assert all(find(got[i].component_id) == find(i) for i in root) and len({find(i) for i in root}) > 30
    for i in (600, 601, 602, 603, 604, 605, 606):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert lattice.link(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_lattice_repeated_ids_and_clashing_columns(spark):
    """Copies of a vector, also under one id, link with each other; extra columns change nothing."""
    v, w = [1.0, 2.0, 3.0], [-3.0, 0.0, 1.0]
    df = spark.createDataFrame([(1, v), (1, v), (2, v), (3, w), (None, w), (4, [-0.0, 0.0, 1e-30]), (5, [0.0, -0.0, 1e30])], "vec_id long, embedding array<double>")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in lattice.link(df.selectExpr("*", "1 AS rep", "2 AS cell", "3 AS links", "4 AS good")).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 1, 3), (None, 1, 3), (4, 1, 4), (5, 1, 4)], key=str)


def test_lattice_recall_at_threshold():
    """Pairs at a cosine of exactly 0.9 meet in some table, by the one plan of every size."""
    assert not hasattr(lattice, "plan")
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, 4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    u, v = (lattice.cells(x, lattice.SCALE, lattice.TABLES) for x in (a, b))
    met = (u == v[:, :, :1]).any(axis=(1, 2)) | (v == u[:, :, :1]).any(axis=(1, 2))
    assert met.mean() > 0.95


def brute_chat(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, own in turns.items():
        own.sort()
        told, loss = "".join(f"{r}\n{t}\n" for _, r, t in own), "".join(t for _, r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


CHAT = "conv_id long, turn long, role string, text string"


def written(role, text):
    escape = lambda x: x.replace("\\", "\\e").replace("<", "\\l").replace("[", "\\b")
    return f"<s>{escape(role)}[INST]{escape(text)}[/INST]</s>"


def check_windows(got):
    """Budget, repeated turns and form of the windows of a conversation."""
    for r in got:
        parts = r.text.split("</s>")[:-1]
        sizes = [-(-(len(p) + 4) // 4) for p in parts]
        assert sum(sizes) == r.n_tokens and (r.n_tokens <= chat.BUDGET or len(parts) == 1)
        assert all("<" not in p[3:].replace("[/INST]", "").replace("[INST]", "") for p in parts)


def test_chat_reads_back(spark):
    rng = random.Random(2)
    rows = [(1, 0, None, None), (1, None, "user", "no turn"), (2, 0, "system", "a\\e<\\\\[l"), (2, 0, "assistant", "\\b\\l\\e</s>"), (2, 0, "assistant", "\\b\\l\\e</s>"), (3, 0, "user", "x" * 9000), (None, 5, "assistant", "no conversation")]
    for i in range(700):  # beyond a block
        rows.append((4, i, "system" if not i else ("user", "assistant")[i % 2], f"turn {i} [INST] <s>" * rng.randrange(60)))
    df = spark.createDataFrame(rows, CHAT)
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    sortable = [(c, -1 if t is None else t, r, x) for c, t, r, x in rows]
    assert {c: tuple(r)[1:5] for c, r in got.items()} == brute_chat(sortable)
    w = chat.windows(df).orderBy("block", "piece", "span").where("conv_id = 4").collect()
    assert len(w) > 20 and all(r.text.startswith("<s>system[INST]") or r.n_tokens > 700 for r in w) and max(r.n_repeated for r in w) == 1 + chat.HISTORY_TURNS
    assert {r.block for r in w} == {0, 1, 2} and all(r.n_repeated for r in w[1:] if r.n_tokens < 700)
    check_windows(chat.windows(df).collect())
    assert chat.digests(df.limit(0)).count() == 0


def test_chat_budget_with_large_system_turn(spark):
    rows = [(1, 0, "system", "s" * 8000), *[(1, i, "user", "short words") for i in range(1, 41)], (2, 0, "system", "<" * 900), *[(2, i, "assistant", "[" * 300) for i in range(1, 30)]]
    df = spark.createDataFrame(rows, CHAT)
    got = chat.windows(df).orderBy("block", "piece", "span").collect()
    check_windows(got)
    assert [r.n_repeated for r in got if r.conv_id == 1] == [0, 0] and len([r for r in got if r.conv_id == 2]) > 5
    assert {r.conv_id: tuple(r)[1:5] for r in chat.digests(df).collect()} == brute_chat(rows)


def test_chat_repeated_turn_numbers_are_cut_into_pieces(spark):
    """Blocks of more rows than MOST, and extra columns with clashing names."""
    rng = random.Random(4)
    rows = [(1, rng.randrange(3), rng.choice(["user", "assistant"]), f"t{rng.randrange(400)}") for _ in range(1500)] + [(1, 10**12, "user", "far away"), (2, 0, "user", "one")]
    df = spark.createDataFrame(rows, CHAT).selectExpr("*", "1 AS block", "2 AS tokens", "'x' AS piece").repartition(5)
    assert {r.conv_id: tuple(r)[1:5] for r in chat.digests(df).collect()} == brute_chat(rows)
    got = chat.windows(df).collect()
    check_windows(got)
    assert {r.piece for r in got} == set(range(6))


def test_chat_query_has_the_planted_conversation(spark, tmp_path):
    spark.createDataFrame([(5, 0, "user", "hi"), (5, 1, "assistant", "ho")], CHAT).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in op6_chat(spark, str(tmp_path)).collect()}
    assert got[-1].n_turns == 2 and got[-1].loss_chars == len("</s>[INST] ok [/INST]") and got[5].loss_chars == 2


def test_pipeline_on_planted_cases(spark, tmp_path):
    rng = random.Random(6)
    text = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.randrange(10**6)}x" for _ in range(n))
    passage, item = text(70), text(20)
    copy = text(120)
    rows = [(0, copy, "en"), (1, copy, "en"), (2, text(30) + " " + passage, None), (3, passage + " " + text(30), "en"), (4, f"{text(20)} {item} {text(20)}", "en"), (5, None, "en"), (6, "12 34", "en")] + [(i, text(60), "en") for i in range(7, 20)]
    spark.createDataFrame([(i, t, lang, "s", len(t or ""), 1) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, extra int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, *_ in rows} - {1, 4, 5, 6} and all(r.exact for r in got.values())
    assert got[3].n_chars == len(rows[3][1]) - len(passage) - 1 and got[2].n_chars == len(rows[2][1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "passages", "benchmark_free", "tokens"]


def test_pipeline_on_empty_repeated_and_null_rows(spark, tmp_path):
    """No documents; documents with equal ids, without ids, with nulls anywhere, and a very long one."""
    rng = random.Random(8)
    text = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.randrange(10**6)}x" for _ in range(n))
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    twice, long = text(60), text(30_000)
    rows = [(1, twice, "en", "s", 1), (1, twice, "en", "s", 1), (1, text(60), "en", None, None), (None, text(60), None, "s", 1), (None, text(60), "en", None, 1), (2, long, None, None, None), (3, None, None, None, None), (None, None, None, None, None), (4, "", "en", "s", 0)]
    item = text(20)
    for name, some in (("none", []), ("some", rows)):
        spark.createDataFrame(some, shape).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(1, item), (2, None), (None, "x")], "item_id long, text string").write.parquet(str(tmp_path / name / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    got = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "1", "2", "None", "None"] and all(r.exact for r in got)
    assert max(r.n_tokens for r in got) > 30_000


def test_jaccard_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)  # so that cells are compared block by block
    rng = random.Random(8)
    base = [[f"w{rng.randrange(3000)}" for _ in range(150)] for _ in range(5)]
    rows = [(0, None), (1, ""), (2, "One two"), (3, "one  TWO"), (4, "a " * 900)]
    for i in range(5, 150):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    for i in sets:
        for j in sets:
            if i < j and (sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r.doc_id: r.component_id for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {i: find(i) for i in sets} and 8 < len(set(got.values())) < 100
    assert jaccard.dedupe(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_jaccard_null_ids_and_clashing_columns(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, "alone one two three four"), (4, "a b c d e f"), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS name", "2 AS cells", "3 AS component_id")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.components(df).collect()), key=str)
    assert got == sorted([(None, 4), (None, 4), (None, None), (4, 4), (5, 5), (6, 5)], key=str)
    assert jaccard.dedupe(df).columns == df.columns and sorted(str(r.doc_id) for r in jaccard.dedupe(df).collect()) == ["4", "5", "None", "None", "None"]


def test_pipeline_drops_near_copies(spark):
    """A copy with words changed at 0.8 or above goes, one below it stays."""
    rng = random.Random(12)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    changed = lambda at: " ".join("other" + w if k in at else w for k, w in enumerate(words))
    rows = [(0, " ".join(words)), (1, changed({30, 80})), (2, changed({20, 50, 80, 110})), *[(i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(60))) for i in range(3, 9)]]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, df, "").collect()} == {0, 2, *range(3, 9)}
