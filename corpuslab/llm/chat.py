"""Chat formatting over reply trees, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.running import running
from ..operators.topn import top_per_group
from ..session import Scratch

START, END = "<|im_start|>", "<|im_end|>"
#: Turns that are joined into one string before the blocks of a conversation are.
BLOCK = 64
LOSS_ROLE = "assistant"
#: What a text may not contain unescaped: marks of this template, and those of other common ones.
CONTROL = r"(<)(\||/?s>)|(\[)(/?INST\])"
MIN_TURN = -(1 << 63)


def escape(text: Column, line: bool = False) -> Column:
    """Double each backslash, then put one behind the first character of every control string.

    ``line``: newlines get one before them as well.  ``unescape`` takes one backslash
    before any character away, so the way back is exact.
    """
    out = F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, "$1$3\\\\$2$4")
    return F.replace(out, F.lit("\n"), F.lit("\\\n")) if line else out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chains(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Messages (tree, node, parent, score, conv_id, items) of plain conversations, each turn replying to the turn before it.

    Rows of one conversation and turn are one node, ordered by role and text; null texts
    and roles are empty, a null turn comes before all others, null conversations form one.
    """
    d = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.coalesce(F.concat(F.lit("k"), F.col(conv_col).cast("string")), F.lit("")).alias("tree"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(MIN_TURN)).alias("node"),
        F.struct(F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("item"),
    )
    nodes = d.groupBy("tree", "node").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list("item")).alias("items"))
    return running(nodes, ["tree"], "node", F.col("node"), "parent", how="last", inclusive=False).withColumn("score", F.lit(0.0))


def climb(messages: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Pointer tables: table k has, for each node, the ancestor ``2^k`` steps up (null past the root), the nodes and the score on the way.

    Each table is the self-join of the one before it, so the number of joins is the
    logarithm of the depth.  A parent that is not there makes its reply a root.  Finished
    nodes leave the join, so they share no null key.  Replies in a circle are an error.
    """
    start = messages.select("tree", "node", F.col("parent").alias("top"), F.lit(1).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).alias("score"))
    known = start.select("tree", F.col("node").alias("top"), F.lit(True).alias("there"))
    linked = start.where(F.col("top").isNotNull()).join(known, ["tree", "top"], "left").withColumn("top", F.when(F.col("there"), F.col("top"))).drop("there")
    tables = [scratch.save(linked.unionByName(start.where(F.col("top").isNull())), "climb")]
    rounds = max(1, tables[0].count()).bit_length() + 1
    while not (open_nodes := tables[-1].where(F.col("top").isNotNull())).isEmpty():
        if len(tables) > rounds:
            raise ValueError("messages reply to each other in a circle")
        up = tables[-1].select("tree", F.col("node").alias("top"), F.col("top").alias("_top"), F.col("depth").alias("_depth"), F.col("score").alias("_score"))
        joined = open_nodes.join(up, ["tree", "top"]).select("tree", "node", F.col("_top").alias("top"), (F.col("depth") + F.col("_depth")).alias("depth"), (F.col("score") + F.col("_score")).alias("score"))
        tables.append(scratch.save(joined.unionByName(tables[-1].where(F.col("top").isNull())), "climb"))
    return tables


def paths(messages: DataFrame, scratch: Scratch, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, pos): the nodes of the ``branches`` best root-to-leaf paths of each tree, ``pos`` from 1 at the root.

    Paths rank by the sum of their scores, then by length, then by leaf.
    """
    tables = climb(messages, scratch)
    parents = tables[0].where(F.col("top").isNotNull()).select("tree", F.col("top").alias("node")).distinct()
    leaves = tables[-1].join(parents, ["tree", "node"], "left_anti")
    best = top_per_group(leaves, ["tree"], [F.desc("score"), F.desc("depth"), F.asc("node")], branches, spread_on="node", rank="rank")
    rows = best.select("tree", F.col("node").alias("leaf"), "rank", "node", F.col("depth").alias("pos"))
    for k, jump in reversed(list(enumerate(tables[:-1]))):
        step = jump.where(F.col("top").isNotNull()).select("tree", "node", "top")
        above = rows.join(step, ["tree", "node"]).select("tree", "leaf", "rank", F.col("top").alias("node"), (F.col("pos") - (1 << k)).alias("pos"))
        rows = scratch.save(rows.unionByName(above), "paths")
    return rows


def _spans(blocks: Column, width, spans) -> Column:
    """Fold of (offset, array of spans) over an array, each element giving its length and its own spans."""
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))

    def step(acc, x):
        moved = F.transform(spans(x), lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["stop"] + acc["at"]).alias("stop")))
        return F.struct((acc["at"] + width(x)).alias("at"), F.concat(acc["spans"], moved).alias("spans"))

    return F.aggregate(blocks, empty, step)["spans"]


def format_chat(messages: DataFrame, scratch: Scratch, branches: int = 1, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(tree, leaf, rank, conv_id, formatted, loss): one conversation per chosen path.

    ``messages``: tree, node, parent, score, conv_id, items (array of role and text).
    ``loss`` has the code point spans of the texts of ``loss_role`` in ``formatted``.
    Turns are joined in blocks of ``BLOCK`` first, so the task that makes a long
    conversation gets its blocks and not its rows.
    """
    at = paths(messages, scratch, branches)
    rows = at.join(messages.select("tree", "node", "conv_id", "items"), ["tree", "node"])
    rows = rows.select("tree", "leaf", "rank", "pos", "conv_id", F.posexplode("items").alias("sub", "item"))
    head = F.concat(F.lit(START), escape(F.col("item.role"), line=True), F.lit("\n"))
    body = escape(F.col("item.text"))
    loss = F.when(
        F.col("item.role") == loss_role,
        F.array(F.struct(F.length("head").cast("long").alias("start"), (F.length("head") + F.length("body")).cast("long").alias("stop"))),
    ).otherwise(F.array().cast("array<struct<start:bigint,stop:bigint>>"))
    rows = rows.withColumn("head", head).withColumn("body", body).withColumn("loss", loss)
    turn = F.struct("pos", "sub", F.concat("head", "body", F.lit(END + "\n")).alias("text"), "loss")
    key = ["tree", "leaf", "rank"]
    blocks = rows.groupBy(*key, F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(turn)).alias("turns"))
    blocks = blocks.select(
        *key,
        "conv_id",
        F.struct(
            "block",
            F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("text"),
            _spans(F.col("turns"), lambda t: F.length(t["text"]).cast("long"), lambda t: t["loss"]).alias("loss"),
        ).alias("part"),
    )
    whole = blocks.groupBy(*key).agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list("part")).alias("parts"))
    return whole.select(
        *key,
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"),
        _spans(F.col("parts"), lambda p: F.length(p["text"]).cast("long"), lambda p: p["loss"]).alias("loss"),
    )


def parse_chat(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    role = r"(?s)^<\|im_start\|>([^\n\\]*+(?:\\.[^\n\\]*+)*+)\n(.*)$"
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(unescape(F.regexp_extract(p, role, 1)).alias("role"), unescape(F.regexp_extract(p, role, 2)).alias("text")),
    )


def chat_digests(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from each formatted conversation.

    See ``chains`` for nulls and ties; repeated rows are turns of their own.  An empty
    table gives no rows; a conversation without assistant turns has an empty loss text.
    """
    scratch = Scratch(turns.sparkSession, "chat")
    messages = scratch.save(chains(turns, conv_col, turn_col, role_col, text_col), "messages")
    made = scratch.save(format_chat(messages, scratch).select("conv_id", "formatted", "loss"), "formatted")
    read = made.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), parse_chat(F.col("formatted")).alias("turns"), "formatted", "loss")
    under = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))))
    read = read.withColumn("loss_text", F.array_join(under, ""))
    everything = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(everything.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
