"""Chat formatting in budgeted windows; DataFrame functions only.

A conversation is dealt in blocks: the turns whose numbers share all but their last BLOCK_BITS
bits, ordered by (turn, role, text). Prefix sums of a block's tokens start a new span where the
next turn would not fit. A window holds the system turn, repeated history (the last turns before
the span, within limits of turns and tokens) and the span. The mask covers the texts of the span's
assistant turns only, so each assistant text is a target once.

Tokens are those of the written form: with role, marks and escapes. A window never has more than
the budget, except for a single turn that has more by itself: that one is a window alone, as
nothing is cut. A system turn of more than half of the room is not repeated.

Texts are shuffled once, by conversation and block; conversations of one block need nothing else.
For longer ones the last turns of each block and the system turn are joined to the blocks after.
Blocks with more than MOST rows (turn numbers that come again and again) are numbered by a range
sort and cut into pieces, so no group is larger than that.

A turn is written ``<s>role[INST]text[/INST]</s>``. Within roles and texts a backslash becomes
``\\e``, ``<`` becomes ``\\l`` and ``[`` becomes ``\\b``; no control string can arise from a text, and
the texts can be read back exactly.

Defined results: a null role or text is empty; a null turn comes first; equal turn numbers are
ordered by role and text, repeated rows are separate turns; rows without a conv_id are one
conversation; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.llm.tables import Scratch

BUDGET, HISTORY_TOKENS, HISTORY_TURNS = 1024, 256, 4
BLOCK_BITS = 8
#: Rows of a block that isn't cut into pieces, and of a piece.
MOST, PIECE = 512, 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\e")), F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")), F.lit("\\e"), F.lit("\\"))


def line(role: Column, text: Column) -> Column:
    """A turn as it is written."""
    return F.concat(F.lit("<s>"), escape(role), F.lit("[INST]"), escape(text), F.lit("[/INST]</s>"))


def estimate(written: Column) -> Column:
    """Tokens of a written turn: a fourth of its characters, rounded up."""
    return F.ceil(F.length(written) / 4).cast("long")


def _pieces(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows with the number of the piece of their block that they belong to."""
    order = ["conv_id", "block", "turn", "role", "text"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = scratch.cut(sorted_.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "placed")
    parts = placed.groupBy("conv_id", "block", "part").agg(F.count("*").alias("size"), F.min("at").alias("low"))
    # Rows of one block here: at most one for each partition that holds part of it.
    before = parts.alias("p").join(parts.alias("q"), F.expr("p.conv_id <=> q.conv_id and p.block = q.block and q.part < p.part"), "left")
    offsets = before.groupBy("p.conv_id", "p.block", "p.part").agg((F.first("p.low") - F.coalesce(F.sum("q.size"), F.lit(0))).alias("base"))
    o = offsets.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), F.col("part").alias("k"), "base")
    return placed.join(o, F.expr("conv_id <=> c and block = b and part = k")).withColumn("piece", F.floor((F.col("at") - F.col("base")) / PIECE)).select(*rows.columns, "piece")


def _blocks(rows: DataFrame) -> DataFrame:
    turn = F.struct("turn", "role", "text", "tokens")
    return rows.groupBy("conv_id", "block", "piece").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def _context(rows: DataFrame, ids: DataFrame, scratch: Scratch, history_turns: int) -> DataFrame | None:
    """For each block but a conversation's first: the system turn and the turns before it.

    ids: conv_id, block, piece. None if no conversation has two blocks.
    """
    w = Window.partitionBy("conv_id").orderBy("block", "piece")  # small rows, one for each block
    next_ = lambda c: F.lead(c).over(w).alias(f"next_{c}")
    ordered = ids.select("conv_id", "block", "piece", F.row_number().over(w).alias("n"), next_("block"), next_("piece"))
    many = scratch.cut(ordered.where("next_block is not null or n > 1").withColumnsRenamed({"conv_id": "c", "block": "b", "piece": "p"}), "many")
    if many.isEmpty():
        return None
    own = _blocks(rows.join(many.select("c", "b", "p"), F.expr("conv_id <=> c and block = b and piece = p"), "left_semi"))
    own = scratch.cut(own.join(many, F.expr("conv_id <=> c and block = b and piece = p")).select("conv_id", "n", "next_block", "next_piece", F.expr("if(n = 1 and turns[0].role = 'system', turns[0], null)").alias("system"), "turns"), "long")
    rest = F.expr("if(system is null, turns, slice(turns, 2, size(turns)))")
    tails = own.where("next_block is not null").withColumn("rest", rest).select("conv_id", F.col("next_block").alias("b"), F.col("next_piece").alias("p"), F.expr(f"slice(rest, greatest(1, size(rest) - {history_turns} + 1), {history_turns})").alias("tail"))
    first = own.where("system is not null").select(F.col("conv_id").alias("sc"), "system")
    return scratch.cut(tails.join(first, F.expr("conv_id <=> sc"), "left").select(F.col("conv_id").alias("c"), "b", "p", "tail", "system"), "context")


KIND = "array<struct<turn:bigint,role:string,text:string,tokens:bigint>>"


def windows(df: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS, tokens: Callable[[Column], Column] = estimate) -> DataFrame:
    """conv_id, block, piece, span (their order), first_turn, n_repeated, n_tokens, text, mask.

    df: conv_id, turn, role, text. n_repeated: turns at the head that other windows have as theirs;
    mask: (start, size) in characters of the text; tokens: the count of a written turn.
    """
    scratch = Scratch(df.sparkSession, "chat")
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), empty("role").alias("role"), empty("text").alias("text"))
    rows = rows.withColumn("block", F.coalesce(F.shiftright("turn", BLOCK_BITS), F.lit(-(2**63))))
    sizes = scratch.cut(rows.groupBy("conv_id", "block").count(), "sizes")
    large = sizes.where(F.col("count") > MOST).select(F.col("conv_id").alias("c"), F.col("block").alias("b"))
    ids = sizes.select("conv_id", "block", F.lit(0).cast("long").alias("piece"))
    if large.isEmpty():
        rows = rows.withColumn("piece", F.lit(0).cast("long"))
    else:
        within = F.expr("conv_id <=> c and block = b")
        cut = _pieces(rows.join(large, within, "left_semi"), scratch)
        rows = rows.join(large, within, "left_anti").withColumn("piece", F.lit(0).cast("long")).unionByName(cut)
        ids = ids.join(large, within, "left_anti").union(cut.select("conv_id", "block", "piece").distinct())
    rows = rows.withColumn("tokens", tokens(line(F.col("role"), F.col("text"))).cast("long"))
    context = _context(rows, ids, scratch, history_turns)
    blocks = _blocks(rows)
    if context is None:
        blocks = blocks.withColumns({"c": F.lit(None).cast("long"), "tail": F.lit(None).cast(KIND), "system": F.lit(None).cast(KIND[6:-1]), "first": F.lit(True)})
    else:
        blocks = blocks.join(context, F.expr("conv_id <=> c and block = b and piece = p"), "left").withColumn("first", F.col("tail").isNull())
    half = (budget - history_tokens) // 2
    whole = blocks.select("conv_id", "block", "piece", "turns", F.expr(f"coalesce(tail, cast(array() as {KIND}))").alias("tail"), F.expr("first and turns[0].role = 'system'").alias("own_system"), "system")
    whole = whole.withColumn("head", F.expr(f"filter(array(if(own_system, turns[0], system)), x -> x is not null and x.tokens <= {half})"))
    whole = whole.withColumn("room", F.lit(budget - history_tokens) - F.expr("if(size(head) > 0, head[0].tokens, 0)"))
    # The first turns of the spans, from prefix sums of tokens.
    starts = F.expr("""
      aggregate(turns, named_struct('sum', 0L, 'i', 1, 'starts', array(1)),
        (a, x) -> if(a.sum > 0 and a.sum + x.tokens > room,
          named_struct('sum', x.tokens, 'i', a.i + 1, 'starts', array_append(a.starts, a.i)),
          named_struct('sum', a.sum + x.tokens, 'i', a.i + 1, 'starts', a.starts))).starts""")
    recent = f"slice(turns, greatest(if(own_system, 2, 1), s - {history_turns}), greatest(0, s - greatest(if(own_system, 2, 1), s - {history_turns})))"
    cut = whole.withColumn("starts", starts).withColumn(
        "windows",
        F.expr(f"""
          transform(starts, (s, i) -> named_struct(
            'own', slice(turns, s, coalesce(get(starts, i + 1), size(turns) + 1) - s),
            'past', concat(tail, {recent}),
            'head', if(own_system and s = 1, slice(head, 1, 0), head)))"""),
    )
    each = cut.select("conv_id", "block", "piece", F.posexplode("windows").alias("span", "w")).select("conv_id", "block", "piece", "span", "w.own", "w.past", "w.head")
    total = lambda c: f"aggregate({c}, 0L, (a, y) -> a + y.tokens)"
    near = each.withColumn("recent", F.expr(f"slice(past, greatest(1, size(past) - {history_turns} + 1), {history_turns})"))
    near = near.withColumn("history", F.expr(f"filter(recent, (x, i) -> {total(f'slice(recent, i + 1, {history_turns})')} <= {history_tokens})"))
    again = F.expr(f"case when {total('own')} + {total('head')} + {total('history')} <= {budget} then concat(head, history) when {total('own')} + {total('head')} <= {budget} then head else slice(head, 1, 0) end")
    ready = near.select("conv_id", "block", "piece", "span", "own", again.alias("again"))
    written = lambda x: line(x["role"], x["text"])
    built = ready.withColumns({"before": F.array_join(F.transform("again", written), ""), "lines": F.transform("own", written), "said": F.transform("own", lambda x: F.struct(F.length(escape(x["role"])).alias("r"), F.length(escape(x["text"])).alias("t"), (x["role"] == "assistant").alias("target")))})
    mask = F.expr("""
      aggregate(said, named_struct('at', length(before), 'out', cast(array() as array<struct<start:int,size:int>>)),
        (a, x) -> named_struct(
          'at', a.at + x.r + x.t + 20,
          'out', if(x.target, array_append(a.out, named_struct('start', a.at + x.r + 9, 'size', x.t)), a.out))).out""")
    return built.select("conv_id", "block", "piece", "span", F.expr("own[0].turn").alias("first_turn"), F.size("again").alias("n_repeated"), F.expr(f"{total('own')} + {total('again')}").alias("n_tokens"), F.concat("before", F.array_join("lines", "")).alias("text"), mask.alias("mask"))


def digests(df: DataFrame) -> DataFrame:
    """Per conversation, read back from the windows: turns, targets and sizes.

    The digests are of all of a conversation's text, which so has to fit one value; for that reason
    this query deals the turns by conversation at once, and nothing is shuffled after it.
    """
    out = windows(df.repartition("conv_id"))
    lines = F.expr("slice(split(text, '</s>', -1), n_repeated + 1, size(split(text, '</s>', -1)) - 1 - n_repeated)")
    role = lambda x: unescape(F.regexp_replace(x, r"(?s)^<s>|\[INST\].*$", ""))
    said = lambda x: unescape(F.regexp_replace(x, r"(?s)^<s>[^\[]*\[INST\]|\[/INST\]$", ""))
    read = out.select(
        "conv_id",
        F.struct("block", "piece", "span").alias("n"),
        F.length("text").alias("chars"),
        F.transform(lines, lambda x: F.concat(role(x), F.lit("\n"), said(x), F.lit("\n"))).alias("turns"),
        F.array_join(F.transform("mask", lambda m: unescape(F.substring(F.col("text"), m["start"] + 1, m["size"]))), "").alias("loss"),
    )
    whole = read.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "turns", "loss"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    loss = F.array_join("w.loss", "")
    turns = F.flatten("w.turns")
    return whole.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
