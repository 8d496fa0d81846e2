"""Chat formatting from reply trees.

Messages form trees: each replies to one message or starts a tree. Iterative
self-joins by pointer doubling (round k joins every message with the state of
its ancestor 2^k above) give each message its depth and its path's score in a
logarithmic number of rounds; the leaves of a tree rank by that score; and the
same jump tables, applied once each to the chosen leaves, list every message of
their paths. A path becomes one formatted conversation with a loss mask.

Joins are on one integer per message, so a tree with a third of all messages is
spread like any other; a message with very many replies is a skewed join key,
which AQE splits. Only a finished conversation is one value: it must fit in one
string (2 GB).

Template, per turn:

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>LF

Inside roles and texts a backslash is doubled and every control string, of this
template or another common one, gets a backslash behind its first character, so
none is left; removing one backslash before any character restores the text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.llm.common import materialise
from sparkwright.llm.sharding import prefix_sums

# The marks of this template, and control strings of public chat templates.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (START, SEP, END, "<|system|>", "<|user|>", "<|assistant|>", "<|endoftext|>",
           "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>",
           "<|eot_id|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _literal(s: str) -> str:
    return re.sub(r"([\[\]|/<>])", r"\\\1", s)


#: The first character of a control string; the rest is looked ahead at, so each occurrence counts.
_CONTROL_HEAD = "|".join(
    _literal(h) + "(?=" + "|".join(_literal(s[1:]) for s in CONTROL if s[0] == h) + ")"
    for h in sorted({s[0] for s in CONTROL}))


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL_HEAD, "$0\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


# ---------------------------------------------------------------------------
# Trees
# ---------------------------------------------------------------------------


def linear_threads(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """Messages (node, tree, parent, score, role, text) of conversations given
    as numbered turns: each turn replies to the one before it.

    Turns follow each other by number (nulls last), ties by role and text hash,
    so repeated rows are turns of their own. Rows with a null conversation are
    one conversation. Null roles and texts are empty. Scores are 0.
    """
    rows = turns.select(
        F.col(conv).alias("tree"), F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "*", F.xxhash64("text").alias("_hash"), F.lit(1).cast("long").alias("_one"))
    placed = materialise(
        prefix_sums(rows, ["tree", "_turn", "role", "_hash"], "_one")
        .select(F.col("row_number").alias("node"), "tree", "role", "text"), "chat-turns")
    first = placed.groupBy("tree").agg(F.min("node").alias("_first"))
    first = first.select(F.col("tree").alias("_tree"), "_first")
    return placed.join(first, F.col("tree").eqNullSafe(F.col("_tree"))).select(
        "node", "tree", F.when(F.col("node") > F.col("_first"), F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"), "role", "text")


def reply_messages(rows: DataFrame, tree: str = "tree_id", message: str = "message_id",
                   parent: str = "parent_id", score: str = "score", role: str = "role",
                   text: str = "text") -> DataFrame:
    """Messages (node, tree, parent, score, role, text) of a table of replies.

    A null parent, or one that the tree doesn't have, starts a path. Of rows
    with equal tree and id the first by parent, role and text hash gets the
    replies; the others are messages too. Nothing replies to a null id. A null
    or non-finite score is 0, null roles and texts are empty.
    """
    value = F.col(score).cast("double")
    narrow = rows.select(
        F.col(tree).alias("tree"), F.col(message).alias("_id"), F.col(parent).alias("_parent"),
        F.when(F.abs(value) < float("inf"), value).otherwise(0.0).alias("score"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "*", F.xxhash64("text").alias("_hash"), F.lit(1).cast("long").alias("_one"))
    placed = materialise(
        prefix_sums(narrow, ["tree", "_id", "_parent", "role", "_hash", "score"], "_one")
        .select(F.col("row_number").alias("node"), "tree", "_id", "_parent", "score", "role",
                "text"), "chat-messages")
    heads = placed.filter("_id IS NOT NULL").groupBy(
        F.col("tree").alias("_htree"), F.col("_id").alias("_hid")).agg(F.min("node").alias("_head"))
    replies = placed.filter("_parent IS NOT NULL").join(
        heads, F.col("tree").eqNullSafe(F.col("_htree")) & (F.col("_parent") == F.col("_hid")),
        "left")
    # Roots pass by the join: as null keys they would all be one partition.
    roots = placed.filter("_parent IS NULL").withColumn("_head", F.lit(None).cast("long"))
    columns = ["node", "tree", F.col("_head").alias("parent"), "score", "role", "text"]
    return replies.select(columns).unionByName(roots.select(columns))


def _climb(links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(node, tree, depth, total) of every message that reaches a root, and the
    jump tables: (node, up), the ancestor 2^k above, for k = 0, 1, ...

    Messages on or below a cycle of replies never reach a root and are left out.
    """
    state = materialise(links.select(
        "node", "tree", F.col("parent").alias("up"), F.lit(0).cast("long").alias("depth"),
        F.col("score").alias("total")), "chat-state")
    state = state.withColumn("depth", F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long"))
    n, jumps = state.count(), []
    while True:
        waiting = state.filter("up IS NOT NULL")
        if waiting.isEmpty() or 1 << len(jumps) > n:
            return state.filter("up IS NULL").drop("up"), jumps
        jumps.append(waiting.select("node", "up"))
        above = state.select(F.col("node").alias("up"), F.col("up").alias("_up"),
                             F.col("depth").alias("_depth"), F.col("total").alias("_total"))
        moved = waiting.join(above, "up").select(
            "node", "tree", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"),
            (F.col("total") + F.col("_total")).alias("total"))
        state = materialise(state.filter("up IS NULL").unionByName(moved), "chat-state")


def chosen_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """(path, node, place, rank, total): the messages, root first (place 0), of
    each tree's ``branches`` best root-to-leaf paths (None: of all, rank 0).

    A path is named by its leaf and ranks by the sum of its messages' scores,
    ties by the leaf's node. The best of a tree are found by partial aggregates
    of at most ``branches`` leaves each, so a large tree isn't sorted in a task.
    """
    links = messages.select("node", "tree", "parent", "score")
    reached, jumps = _climb(links)
    parents = links.filter("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
    leaves = reached.join(parents, "node", "left_anti")
    if branches is None:
        best = leaves.select("node", "depth", "total", F.lit(0).alias("rank"))
    elif branches == 1:
        top = F.min(F.struct((-F.col("total")).alias("_minus"), "node", "depth", "total"))
        best = leaves.groupBy("tree").agg(top.alias("_b")).select("_b.*", F.lit(1).alias("rank"))
    else:
        order = [F.desc("total"), F.asc("node")]
        part = Window.partitionBy("tree", F.pmod("node", F.lit(4096))).orderBy(*order)
        best = (leaves.withColumn("rank", F.row_number().over(part))
                .filter(F.col("rank") <= branches)
                .withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order)))
                .filter(F.col("rank") <= branches))
    found = materialise(best.select(
        F.col("node").alias("path"), "node", F.col("depth").alias("place"), "rank", "total"),
        "chat-paths")
    for k, jump in enumerate(jumps):
        up = found.join(jump, "node").select(
            "path", F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place"), "rank",
            "total")
        found = materialise(found.unionByName(up), "chat-paths")
    return found


# ---------------------------------------------------------------------------
# Text
# ---------------------------------------------------------------------------


def format_paths(messages: DataFrame, paths: DataFrame,
                 learn: Sequence[str] = ("assistant",)) -> DataFrame:
    """(tree, path, rank, total, formatted, loss_spans): one row per path.

    ``loss_spans`` lists [start, end) in code points of ``formatted`` of the
    texts of the roles ``learn``, in order. A tree without messages has no row.
    """
    turns = (paths.join(messages.select("node", "tree", "role", "text"), "node")
             .withColumn("_head", F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)))
             .withColumn("_body", escape(F.col("text")))
             .withColumn("_turn", F.concat("_head", "_body", F.lit(END + "\n"))))
    before = Window.partitionBy("path").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1)
    turns = turns.withColumn("_start", F.length("_head") + F.coalesce(
        F.sum(F.length("_turn")).over(before), F.lit(0)))
    learnt = F.when(F.col("role").isin(*learn), F.struct(
        F.col("_start").alias("start"), (F.col("_start") + F.length("_body")).alias("end")))
    grouped = turns.groupBy("path").agg(
        F.first("tree").alias("tree"), F.first("rank").alias("rank"), F.first("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("place", F.col("_turn").alias("turn")))).alias("_turns"),
        F.sort_array(F.collect_list(learnt)).alias("loss_spans"))
    return grouped.select("tree", "path", "rank", "total",
                          F.array_join("_turns.turn", "").alias("formatted"), "loss_spans")


def turns_of(formatted: Column) -> Column:
    """ARRAY<STRUCT<role, text>> of a formatted conversation."""
    turns = F.filter(F.split(formatted, _literal(END) + "\n"), lambda t: t != "")
    return F.transform(turns, lambda t: F.struct(
        unescape(F.substring_index(F.substr(t, F.lit(len(START) + 1)), SEP, 1)).alias("role"),
        unescape(F.substring_index(t, SEP, -1)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the mask, nothing between them."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Conversations given as turns, each formatted: conv_id, formatted,
    loss_spans. An empty table gives no rows; columns other than conv_id, turn,
    role and text are not read."""
    messages = materialise(linear_threads(turns), "chat-links")
    done = format_paths(messages, chosen_paths(messages))
    return done.select(F.col("tree").alias("conv_id"), "formatted", "loss_spans")


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of formatted conversations finds: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    read = formatted.select("conv_id", "formatted", turns_of(F.col("formatted")).alias("_turns"),
                            loss_text(F.col("formatted"), F.col("loss_spans")).alias("_loss"))
    whole = F.array_join(F.transform("_turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


_MARKS = len(START) + len(SEP) + len(END) + 1
_CONTROL_SQL = "|".join(_literal(s) for s in CONTROL).replace("'", "''")

ORACLE_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (
  SELECT *, {_MARKS} + length(role) + length(text)
         + length(role) - length(replace(role, '\', '')) + length(text) - length(replace(text, '\', ''))
         + len(regexp_extract_all(role, '{_CONTROL_SQL}'))
         + len(regexp_extract_all(text, '{_CONTROL_SQL}')) AS chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""
