"""Chat formatting of reply trees.

Messages point at their parents. Pointers that double in length each round (self-joins, so a tree of depth d takes
log2(d) of them) give every message its root, its depth and the summed score of its path. The leaves of a tree are
ranked by the mean score of their path, the best ``branches`` are chosen, and the same pointers enumerate
the messages of each chosen path, which is formatted as one conversation.

Template: a turn is ``<turn role="ROLE">`` line feed TEXT line feed ``</turn>`` line feed. In texts every ``<turn`` or
``</turn``, with the backslashes before it, gets one backslash more, so only the template's own marks have none, and
``unescaped`` takes it off again. In roles ``%``, ``"``, ``<`` and line feeds are percent-encoded. The loss mask is a list
of spans, start and length in code points, one for the text of each assistant turn.

Defined cases: null text or role counts as empty; a null tree id is a tree of its own; a message without parent, with
a null parent or one that does not occur is a root; of messages that repeat an id the children follow the first by
(score, role, text), the others are leaves beside it; messages on a cycle of parents, or below it, lead to no root and
belong to no path; a null score counts as 0; equal scores are ranked by the leaf's id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.storage import bounded_batches, stored

OPEN = re.compile(r'<turn role="([^"]*)">\n')
CLOSE = "\n</turn>\n"
CONTROL = re.compile(r"(\\*</?turn)")
ESCAPED = re.compile(r"\\(\\*</?turn)")
ROLE_CODES = {"%": "%25", '"': "%22", "<": "%3C", "\n": "%0A"}


def escaped(text: str) -> str:
    return CONTROL.sub(r"\\\1", text)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The conversation, and starts and lengths of the assistant's texts in it."""
    parts, at, starts, lengths = [], 0, [], []
    for role, text in turns:
        head = '<turn role="' + "".join(ROLE_CODES.get(c, c) for c in role) + '">\n'
        body = escaped(text)
        if role == "assistant":
            starts.append(at + len(head))
            lengths.append(len(body))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), starts, lengths


def read_back(conversation: str) -> list[tuple[str, str]]:
    """(role, text) of every turn."""
    turns, at = [], 0
    while at < len(conversation):
        head = OPEN.match(conversation, at)
        end = conversation.index(CLOSE, head.end())
        role = head[1]
        for char, code in reversed(ROLE_CODES.items()):
            role = role.replace(code, char)
        turns.append((role, unescaped(conversation[head.end() : end])))
        at = end + len(CLOSE)
    return turns


def _pointers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (node, above) of the ancestors 1, 2, 4, .. steps up, and (node, root, depth, total) of the rooted ones."""
    step = stored(nodes.select("node", F.col("parent").alias("above"), F.col("score").alias("total")), "pointers")
    jumps, messages = [], step.count()
    # finished messages have no pointer left; total is the score of the messages stepped over
    state = step.select("node", "above", "total", F.lit(1).cast("long").alias("size"), F.col("node").alias("last"))
    while True:
        open_ = state.where("above is not null")
        jumps.append(open_.select("node", "above"))
        up = state.select(
            F.col("node").alias("above"),
            F.col("above").alias("next"),
            F.col("total").alias("total_up"),
            F.col("size").alias("size_up"),
            F.col("last").alias("last_up"),
        )
        moved = open_.join(up, "above").select(
            "node", F.col("next").alias("above"), (F.col("total") + F.col("total_up")).alias("total"),
            (F.col("size") + F.col("size_up")).alias("size"), F.col("last_up").alias("last"),
        )
        state = stored(state.where("above is null").unionByName(moved), "pointers")
        # pointers now lead 2 ** rounds up: one that goes on beyond as many messages as there are lies on or below a cycle
        if 1 << len(jumps) >= messages or state.where("above is not null").isEmpty():
            break
    return jumps, state.where("above is null").select("node", F.col("last").alias("root"), F.col("size").alias("depth"), "total")


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """tree, branch (1 for the best), leaf_id, mean_score, turns (array of role, text from the root) of the chosen paths.

    messages: tree_id, message_id, parent_id, score, role, text.
    """
    tree = F.when(F.col("tree_id").isNull(), "n").otherwise(F.concat(F.lit("t"), F.col("tree_id").cast("string")))
    rows = messages.select(
        "tree_id",
        tree.alias("tree"),
        "message_id",
        "parent_id",
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = stored(rows.withColumn("node", F.monotonically_increasing_id()), "messages")
    # the first of the messages with one id has its children
    owner = rows.where("message_id is not null").groupBy("tree", "message_id")
    owner = owner.agg(F.min(F.struct("score", "role", "text", "node")).alias("first")).select(
        "tree", F.col("message_id").alias("parent_id"), F.col("first.node").alias("parent")
    )
    nodes = stored(rows.select("tree", "parent_id", "node", "score").join(owner, ["tree", "parent_id"], "left"), "nodes")
    jumps, rooted = _pointers(nodes)
    parents = nodes.select(F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = rooted.join(parents, "node", "left_anti").join(rows.select("node", "tree", "tree_id", "message_id"), "node")
    leaves = leaves.withColumn("mean_score", F.col("total") / F.col("depth"))
    rank = Window.partitionBy("tree").orderBy(F.desc("mean_score"), "message_id", "node")
    leaves = leaves.withColumn("branch", F.row_number().over(rank)).where(F.col("branch") <= branches)
    leaves = stored(leaves, "leaves")
    # every ancestor of a chosen leaf: each pointer table doubles the part of the path that is known
    known = leaves.select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    for k, jump in enumerate(jumps):
        more = known.join(jump, "node").select("leaf", F.col("above").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        known = stored(known.union(more), "paths")
    turns = known.join(rows.select("node", "role", "text"), "node").groupBy("leaf").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns")
    )
    return leaves.join(turns.withColumnRenamed("leaf", "node"), "node").select(
        "tree_id", "branch", F.col("message_id").alias("leaf_id"), "mean_score", F.expr("transform(turns, t -> struct(t.role, t.text))").alias("turns")
    )


def format_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            got = [formatted([(t["role"], t["text"]) for t in turns]) for turns in part.column("turns").to_pylist()]
            columns = {c: part.column(c) for c in ("tree_id", "branch", "leaf_id", "mean_score")}
            columns["conversation"] = pa.array([g[0] for g in got], pa.string())
            columns["loss_starts"] = pa.array([g[1] for g in got], pa.list_(pa.int64()))
            columns["loss_lengths"] = pa.array([g[2] for g in got], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """tree_id, branch, leaf_id, mean_score, conversation, loss_starts, loss_lengths of every chosen path."""
    bounded_batches(messages.sparkSession)
    kinds = dict(messages.dtypes)
    schema = (
        f"tree_id {kinds['tree_id']}, branch int, leaf_id {kinds['message_id']}, mean_score double, conversation string,"
        " loss_starts array<long>, loss_lengths array<long>"
    )
    return paths(messages, branches).mapInArrow(format_rows, schema)


def digest_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a reader of the conversations finds: turns, and the text under the loss mask."""
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        columns = ("conversation", "loss_starts", "loss_lengths")
        for whole, starts, lengths in zip(*(batch.column(c).to_pylist() for c in columns)):
            turns = read_back(whole)
            told = "".join(f"{role}\n{text}\n" for role, text in turns)
            loss = "".join(unescaped(whole[s : s + n]) for s, n in zip(starts, lengths))
            found = (len(turns), told, len(loss), loss, len(whole))
            for k, v in zip(out, found):
                out[k].append(hashlib.sha256(v.encode("utf-8")).hexdigest() if isinstance(v, str) else v)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("tree_id"), *(pa.array(v, t) for v, t in zip(out.values(), kinds))], names=["conv_id", *out]
        )


def read_digests(formatted_conversations: DataFrame) -> DataFrame:
    kind = dict(formatted_conversations.dtypes)["tree_id"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted_conversations.mapInArrow(digest_rows, schema)
