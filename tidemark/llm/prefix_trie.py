"""Prefix trie of conversations: adaptive radix trees over turn ids, chunk by chunk of the sorted keys."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, stored, text_or_empty
from tidemark.llm.radix_tree import Node, RadixTree, shared

#: Bytes of a turn id: 16 of a SHA-256 over role and text, then the text's length, both big-endian.
WIDTH = 20
#: Bytes of keys that are one tree; a task builds one tree after the other.
TREE_BYTES = 4 << 20
#: Ids that are joined in one piece before a node's ids are hashed in order.
RUN_IDS = 1_000

_PART = (
    "part long, tree long, depth long, low long, parent_low long, n_convs long, n_children long, n_leaves long, "
    "used long, kept long, ends string, node binary, parent binary"
)


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the ids of a conversation's turns in order, null turns first, ties by turn id."""
    said, words = text_or_empty(role), text_or_empty(text)
    whole = F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, words)
    size = F.octet_length(words)
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(F.col(turn).cast("long").alias("turn"), F.sha2(whole, 256).substr(1, 32).alias("id"), size.alias("size")).alias("turn"),
    )
    # All conversations of a group of five lie in one partition from here on: one shuffle serves both steps.
    rows = rows.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).repartition("base")
    listed = rows.groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    ids = F.transform("turns", lambda t: F.concat(t["id"], F.lpad(F.hex(t["size"].cast("long")), 8, "0")))
    return listed.select("base", "conv_id", ids.alias("turns"))


def rebuilt(listed: DataFrame) -> DataFrame:
    """(conv_id, key): the first h turns of the group's first conversation, then its own turns after its first h."""
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.col("turns"))).over(Window.partitionBy("base"))
    lead = F.coalesce("first", F.array().cast("array<string>"))
    rows = listed.withColumn("first", first).withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int"))
    own = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    ids = F.concat(F.slice(lead, F.lit(1), F.col("h")), own)
    return rows.select("conv_id", F.unhex(F.array_join(ids, "")).alias("key"))


def plain(listed: DataFrame) -> DataFrame:
    """(conv_id, key) of the conversations as they are."""
    return listed.select("conv_id", F.unhex(F.array_join("turns", "")).alias("key"))


def _ends(members: DataFrame) -> DataFrame:
    """(digest, ends): SHA-256 of each key's ids in ascending order, joined by commas.

    Ids are joined in runs of the globally sorted rows, by all tasks; what then
    meets in order, for the hash, is one row for each run.
    """

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids = None, []
        for batch in batches:
            rows = []
            for digest, conv in zip(batch["digest"], batch["conv_id"]):
                if ids and (digest != key or len(ids) >= RUN_IDS):
                    rows.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = digest
                ids.append(conv)
            yield pd.DataFrame(rows, columns=["digest", "start", "ids"])
        if ids:
            yield pd.DataFrame([(key, ids[0], ",".join(map(str, ids)))], columns=["digest", "start", "ids"])

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            rows = []
            for digest, ids in zip(batch["digest"], batch["ids"]):
                if digest != key:
                    if state is not None:
                        rows.append((key, state.hexdigest()))
                    key, state = digest, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(rows, columns=["digest", "ends"])
        if state is not None:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["digest", "ends"])

    ordered = members.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    joined = ordered.mapInPandas(runs, "digest binary, start long, ids string")
    gathered = joined.repartition("digest").sortWithinPartitions("digest", "start")
    return gathered.mapInPandas(hashes, "digest binary, ends string")


class _Turn:
    """A node of the trie while its subtree is walked."""

    __slots__ = ("depth", "low", "count", "size", "in_head", "in_tail", "identity", "children", "leaves", "used", "kept", "end")

    def __init__(self, depth: int, low: int, count: int, size: int, in_head: bool, in_tail: bool, identity: bytes | None):
        self.depth, self.low, self.count, self.size = depth, low, count, size
        self.in_head, self.in_tail, self.identity = in_head, in_tail, identity
        self.children = self.leaves = self.used = self.kept = 0
        self.end = None


def _tree_rows(rows: list[tuple], before: int, after: int, part: int, number: int) -> list[tuple]:
    """What the sorted ``rows`` (key, count, low, ends) say of each trie node, from one radix tree.

    ``before`` and ``after`` are the turns that the first and last key share
    with the keys just outside (-1: there is none). Nodes of those depths on the
    first and last path occur in other trees too: they go out with their
    identity, to be summed. A node counts as new in the first tree that has it, so sums over
    trees count every node and leaf once.
    """
    tree = RadixTree()
    for key, count, low, ends in rows:
        tree.insert(key, count, low, (key, ends))
    head, tail = rows[0][0], rows[-1][0]
    out: list[tuple] = []

    def close(turn: _Turn, parent: _Turn | None) -> None:
        new = not turn.in_head
        turn.used += turn.count * turn.size
        turn.kept += turn.size * new
        if turn.end is not None and not turn.children and not (turn.end[0] == tail and after * WIDTH == len(tail)):
            turn.leaves += 1
        if parent is not None:
            parent.children += new
            parent.leaves += turn.leaves
            parent.used += turn.used
            parent.kept += turn.kept
        out.append((
            part, number, turn.depth, turn.low, parent.low if parent else None, turn.count, turn.children,
            turn.leaves, turn.used, turn.kept, turn.end[1] if turn.end else None, turn.identity, parent.identity if parent else None,
        ))

    def opened(node: Node, start: int, spine: bytearray, above: list[_Turn]) -> int:
        """Puts the turns whose last byte lies on the node's path on ``above``; how many there are."""
        depths = range(start // WIDTH + 1, len(spine) // WIDTH + 1)
        for depth in depths:
            end, parent = depth * WIDTH, above[-1]
            turn = bytes(spine[end - WIDTH : end])
            in_head = parent.in_head and depth <= before and head[end - WIDTH : end] == turn
            in_tail = parent.in_tail and depth <= after and tail[end - WIDTH : end] == turn
            named = hashlib.blake2b(parent.identity + turn, digest_size=16).digest() if in_head or in_tail else None
            above.append(_Turn(depth, node.low, node.count, int.from_bytes(turn[-4:], "big"), in_head, in_tail, named))
        return len(depths)

    root = _Turn(0, tree.root.low, tree.root.count, 0, before >= 0, after >= 0, b"" if max(before, after) >= 0 else None)
    root.end = tree.root.end
    above, spine = [root], bytearray()
    stack = [(iter(tree.root.children()), 0, 0)]  # children left, turns opened, bytes of the path
    while stack:
        children, many, size = stack[-1]
        step = next(children, None)
        if step is None:
            stack.pop()
            for _ in range(many):
                turn = above.pop()
                close(turn, above[-1])
            if size:
                del spine[-size:]
            continue
        node = step[1]
        start = len(spine)
        spine += node.path
        many = opened(node, start, spine, above)
        if node.end is not None:
            above[-1].end = node.end
        stack.append((iter(node.children()), many, len(node.path)))
    close(root, None)
    return out


def nodes(keys: DataFrame) -> DataFrame:
    """One row per trie node of ``keys`` (conv_id, key): the columns of ``trie``."""
    spark = keys.sparkSession
    members = stored(keys.select(F.unhex(F.sha2("key", 256)).substr(1, 16).alias("digest"), "conv_id", "key"), "trie_keys")
    distinct = members.groupBy("digest").agg(
        F.first("key").alias("key"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low")
    )
    joined = distinct.join(_ends(members.select("digest", "conv_id")), "digest").drop("digest")
    ordered = joined.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id().cast("long"))
    kept = stored(ordered, "trie_sorted")

    # How far the last key of a part and the first key of the next one agree: two numbers for each part.
    bounds = kept.groupBy("part").agg(F.min("key").alias("head"), F.max("key").alias("tail"))
    present = sorted(row["part"] for row in bounds.select("part").collect())
    following = {a: b for a, b in zip(present, present[1:])}
    steps = spark.createDataFrame(list(following.items()) or [(-1, -1)], "part long, next long")
    heads = bounds.select(F.col("part").alias("next"), F.col("head").alias("next_head"))
    meeting = bounds.select("part", "tail").join(steps, "part").join(heads, "next")

    @F.pandas_udf("long")
    def agreed(tails: pd.Series, heads: pd.Series) -> pd.Series:
        return pd.Series([shared(a, b) // WIDTH for a, b in zip(tails, heads)], dtype="int64")

    after = {row["part"]: row["turns"] for row in meeting.select("part", agreed("tail", "next_head").alias("turns")).collect()}
    before = {following[part]: turns for part, turns in after.items()}

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size, part, reach, number = [], 0, None, -1, 0
        columns = [field.split()[0] for field in _PART.split(", ")]

        def flush(end: int) -> pd.DataFrame:
            return pd.DataFrame(_tree_rows(rows, reach, end, part, number), columns=columns).astype(
                {"parent_low": "Int64"}
            )

        for batch in batches:
            for at, key, n, low, ends in zip(batch["part"], batch["key"], batch["n"], batch["low"], batch["ends"]):
                key = bytes(key)
                if rows and at != part:
                    yield flush(after.get(part, -1))
                    rows, size, number = [], 0, 0
                if not rows and at != part:
                    part, reach = at, before.get(at, -1)
                elif rows and size + len(key) > TREE_BYTES:
                    turns = shared(rows[-1][0], key) // WIDTH
                    yield flush(turns)
                    rows, size, reach, number = [], 0, turns, number + 1
                rows.append((key, n, low, ends))
                size += len(key)
        if rows:
            yield flush(after.get(part, -1))

    again = small_batches(kept).repartition("part").sortWithinPartitions("part", "key")
    found = stored(again.mapInPandas(build, _PART), "trie_parts")

    edges = found.where(F.col("node").isNotNull())
    whole = stored(
        edges.groupBy("node").agg(
            F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("low").alias("low"),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "used", "kept")), F.max("ends").alias("ends"),
        ),
        "trie_edges",
    )
    lows = whole.select("node", F.col("low").alias("whole_low"))
    # Which tree has which shared node: the children below one are then spread over their trees.
    held = edges.select("part", "tree", "node").join(lows, "node").withColumnRenamed("node", "parent")
    inner = found.where(F.col("node").isNull())
    under = inner.where(F.col("parent").isNotNull()).join(held, ["part", "tree", "parent"])
    parents = lows.withColumnRenamed("node", "parent").withColumnRenamed("whole_low", "parent_low")
    columns = ["depth", "low", "parent_low", "n_convs", "n_children", "n_leaves", "used", "kept", "ends"]
    return (
        inner.where(F.col("parent").isNull()).select(columns)
        .unionByName(under.withColumn("parent_low", F.col("whole_low")).select(columns))
        .unionByName(whole.join(parents, "parent", "left").select(columns))
        .select(
            F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            (F.col("used") - F.col("kept")).alias("saved_tokens"),
            F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def trie(
    conversations: DataFrame, rebuild: bool = True, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per distinct prefix of the conversations, the textless root included.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (bytes that sharing saves in the subtree), ends_sha256.

    - Turns go by ``turn``, null first; equal or repeated turn numbers go by the
      turn's id, so repeated rows stay repeated turns.
    - A null or empty role or text is empty. Rows without a conversation id
      belong to no conversation and are left out. An empty table has no root.
    - With ``rebuild``, every conversation takes the first turns of its group's
      first one; a conversation may then have no turn and ends at the root.
    - Very long texts are hashed where they are and never shuffled. One
      conversation is one key of 20 bytes a turn, which a task holds whole.
    - Other columns, whatever their names, are ignored.
    """
    listed = turns(conversations, conv, turn, role, text)
    return nodes(rebuilt(listed) if rebuild else plain(listed))
