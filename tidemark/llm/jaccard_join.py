"""N-gram Jaccard join: count vectors of shingle groups in R-trees, exact checks of what they leave.

A document is a set of word shingles. Its point counts the shingles that fall in
each hash group; two sets share at most the sum of the smaller counts, so most
pairs need no look at the sets. The points of one tree cannot be kept apart
when groups are many, so the join goes over blocks: two sets that link share one
of the first few shingles of each in a common order (rare words first), and each
block of documents with such a shingle is searched by its own R-tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SlotFilter, release, small_batches, stored, text_or_empty, without
from tidemark.llm.components import components

U = np.uint64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Counters of word frequency; fixed, so that they may go to every task.
COUNTERS = 1 << 17
LEAF = 32
#: Most points of a block in one task; larger blocks are dealt out as pairs of parts.
PART = 2048
#: Rows of small blocks that share a task.
TASK_ROWS = 4_000
#: Shingles of the whole sets in a task, on average, at most.
TASK_SHINGLES = 1_000_000
#: Most groups of a point in a tree: longer points are folded, which only loosens their bounds.
GROUPS = 1 << 14


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 30_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(29))


def word_hashes(text: str) -> np.ndarray:
    parts = text.encode("utf-8", "replace").translate(_LOWER).split()
    return np.fromiter(map(_WORDS.__getitem__, parts), np.uint64, len(parts))


def _rolled(h: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the shingles in order; fewer words count as one shingle."""
    width = min(words, len(h))
    count = len(h) - width + 1 if width else 0
    made = np.full(count, width, np.uint64)
    for k in range(width):
        made = _mix(made * U(0x9E3779B97F4A7C15) + h[k : k + count])
    return made


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted hashes of the different shingles of a whole text."""
    return np.unique(_rolled(word_hashes(text), words))


def ranked(text: str, words: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted shingles, and the place of each in the common order: the summed weights of its words.

    A shingle of frequent words is frequent; its place depends on its words alone.
    """
    h = word_hashes(text)
    made, first = np.unique(_rolled(h, words), return_index=True)
    own = weight[(h & U(COUNTERS - 1)).astype(np.int64)]
    width = min(words, len(h))
    total = np.zeros(len(h) - width + 1 if width else 0, np.int16)
    for k in range(width):
        total += own[k : k + len(total)]
    return made, total[first]


def vector(made: np.ndarray) -> bytes:
    """Counts by hash group, one or two a group, in half a byte each.

    Empty where a count does not fit, which rules nothing out.
    """
    groups = 32
    while groups * 2 < len(made):
        groups *= 2
    counts = np.bincount((made & U(groups - 1)).astype(np.int64), minlength=groups)
    if counts.max(initial=0) > 15:
        return b""
    half = counts.astype(np.uint8).reshape(2, -1)
    return (half[0] | half[1] << 4).tobytes()


def counts_of(points: list[bytes]) -> np.ndarray:
    """The counts of points of one size, a row each."""
    packed = np.frombuffer(b"".join(points), np.uint8).reshape(len(points), -1)
    return np.concatenate([packed & 15, packed >> 4], 1)


def folded(v: np.ndarray, groups: int) -> np.ndarray:
    """Counts of fewer groups: the last axis added up to ``groups``."""
    return v.reshape(*v.shape[:-1], -1, groups).sum(-2, dtype=np.uint16)


def _leaf_bounds(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap of every row of ``x`` with every row of ``y``, a few rows at a time."""
    step = max(1, (1 << 19) // y.size)
    some = [np.minimum(x[k : k + step, None, :], y[None, :, :]).sum(2, dtype=np.int64) for k in range(0, len(x), step)]
    return np.concatenate(some)


def may_link(overlap: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    return (100 + percent) * overlap >= percent * sizes


def _pair_bounds(a: list[bytes], b: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap of each pair of points."""
    out = np.empty(len(a), np.int64)
    lengths = np.array([(len(x), len(y)) for x, y in zip(a, b)]).reshape(-1, 2)
    for la, lb in np.unique(lengths, axis=0):
        at = np.flatnonzero((lengths == (la, lb)).all(1))
        if not la or not lb:
            out[at] = sizes[at]
            continue
        for some in np.array_split(at, -(-len(at) * int(la + lb) // (1 << 22)) or 1):
            x, y = (folded(counts_of([v[k] for k in some]), 2 * min(la, lb)) for v in (a, b))
            out[some] = np.minimum(x, y).sum(1)
    return out


class Tree:
    """An R-tree over points sorted by size: leaves of ``LEAF`` points, boxes by their largest counts."""

    def __init__(self, sizes: np.ndarray, classes: np.ndarray, vectors: list[bytes]):
        self.sizes, self.classes = sizes, classes
        self.levels: list[list[tuple]] = [[]]
        for low in range(0, len(sizes), LEAF):
            rows = np.arange(low, min(low + LEAF, len(sizes)))
            groups = min(GROUPS, 2 * min(len(vectors[k]) for k in rows))
            points = None
            if groups:
                points = np.concatenate([folded(counts_of([vectors[k]]), groups) for k in rows])
            own = classes[rows]
            box, alone = None if points is None else points.max(0), (own == own[0]).all()
            self.levels[0].append((rows, points, box, sizes[rows[0]], sizes[rows[-1]], own[0] if alone else None))
        while len(self.levels[-1]) > 1:
            below, above = self.levels[-1], []
            for low in range(0, len(below), LEAF):
                part = below[low : low + LEAF]
                box = None
                if all(p[2] is not None for p in part):
                    groups = min(len(p[2]) for p in part)
                    box = np.max([folded(p[2], groups) for p in part], 0)
                own = {p[5] for p in part}
                alone = own.pop() if len(own) == 1 else None
                above.append((range(low, low + len(part)), None, box, part[0][3], part[-1][4], alone))
            self.levels.append(above)

    def pairs(self, percent: int) -> np.ndarray:
        """Rows (a, b) of different classes whose points do not rule a link out."""
        found = []
        top = len(self.levels) - 1
        todo = [(top, 0, 0)]
        while todo:
            level, i, j = todo.pop()
            one, two = self.levels[level][i], self.levels[level][j]
            if one[5] is not None and one[5] == two[5]:
                continue
            small, large = (one, two) if one[4] <= two[4] else (two, one)
            if 100 * small[4] < percent * large[3]:
                continue
            if one[2] is not None and two[2] is not None and i != j:
                groups = min(len(one[2]), len(two[2]))
                bound = int(np.minimum(folded(one[2], groups), folded(two[2], groups)).sum())
                if not may_link(bound, one[3] + two[3], percent):
                    continue
            if level:
                todo += [(level - 1, a, b) for a in one[0] for b in two[0] if i != j or a <= b]
                continue
            a, b = one[0], two[0]
            sizes = self.sizes[a][:, None] + self.sizes[b][None, :]
            open_ = self.classes[a][:, None] != self.classes[b][None, :]
            if i == j:
                open_ &= a[:, None] < b[None, :]
            if one[1] is not None and two[1] is not None:
                groups = min(one[1].shape[1], two[1].shape[1])
                x, y = folded(one[1], groups), folded(two[1], groups)
                open_ &= may_link(_leaf_bounds(x, y), sizes, percent)
            x, y = np.nonzero(open_)
            found.append(np.stack([a[x], b[y]], 1))
        return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _sketch(rows: DataFrame, words: int) -> DataFrame:
    """One pass: (doc_id, n, signature) of every document, and the word counters of every task."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            out, slots = [], []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                h = word_hashes(text)
                made = np.unique(_rolled(h, words))
                slots.append((h & U(COUNTERS - 1)).astype(np.int32))
                out.append((doc, len(made), xxhash.xxh3_128_digest(made.tobytes()), None))
            if slots:
                counters += np.bincount(np.concatenate(slots), minlength=COUNTERS)
            yield pd.DataFrame(out, columns=["doc_id", "n", "signature", "counter"]).astype({"doc_id": "Int64", "counter": "Int32"})
        release()
        used = np.flatnonzero(counters)
        yield pd.DataFrame({
            "doc_id": None, "n": counters[used], "signature": None, "counter": used,
        }).astype({"doc_id": "Int64", "counter": "Int32"})

    return stored(rows.mapInPandas(sketch, "doc_id long, n long, signature binary, counter int"), "sketch")


def _points(rows: DataFrame, words: int, percent: int, weight: np.ndarray, alike: DataFrame) -> DataFrame:
    """(doc_id, n, point, prefix) of one document for each set, without those in ``alike``.

    ``prefix`` has the shingles of which a linked set must share one, rare ones first.
    """
    copies = SlotFilter(alike, "doc_id")

    def point(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, again in zip(batch["doc_id"], batch["text"], copies.held(batch["slot"])):
                made, rank = ranked(text, words, weight)
                if not len(made):
                    continue
                least = -(-percent * len(made) // 100)
                # The hashes are sorted, so a stable sort by rank leaves them in order within it.
                order = np.argsort(rank, kind="stable")
                prefix = made[order[: len(made) - least + 1]].view(np.int64)
                out.append((doc, len(made), xxhash.xxh3_128_digest(made.tobytes()), vector(made), prefix, again))
            yield pd.DataFrame(out, columns=["doc_id", "n", "signature", "point", "prefix", "again"])
        release()

    schema = "doc_id long, n long, signature binary, point binary, prefix array<long>, again boolean"
    made = stored(rows.withColumn("slot", copies.slot("doc_id")).mapInPandas(point, schema), "points")
    first = made.where("again").join(alike, ["doc_id", "signature"], "left_anti")
    return made.where("NOT again").unionByName(first.select(made.columns)).drop("again", "signature")


def _blocks(points: DataFrame, percent: int) -> DataFrame:
    """(token, doc_id, rows, leader) of the rows that may link inside their block, by size and place; ``rows`` counts all.

    Of two linked sets the smaller one has a shared token among the first of its
    prefix already, as the overlap must reach ``percent`` of the larger one too.
    So a row stays if a larger set close in size follows such an early row of
    its own, or if such a row of a smaller set, close in size, comes before it.
    Sizes are dense in blocks over ``PART`` rows, which stay whole and are dealt by
    class. One shuffle of the tokens; sizes and counts come from windows over it.
    """
    early = F.col("pos") < F.expr(f"n - (2 * {percent} * n + {99 + percent}) div {100 + percent} + 1")
    tokens = points.select("doc_id", "n", F.posexplode("prefix").alias("pos", "token")).select(
        "token", "doc_id", (2 * F.col("n") + F.when(early, 0).otherwise(1)).alias("place")
    )
    by_size = Window.partitionBy("token").orderBy("place")
    every = by_size.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n, early = F.expr("place div 2"), F.col("place") % 2 == 0
    before = F.last(F.when(early, n), ignorenulls=True).over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    sized = tokens.withColumns({"before": before, "after": F.lead(n).over(by_size), "rows": F.count(F.lit(1)).over(every)})
    close = sized.where(
        (F.col("rows") > PART) | (100 * F.col("before") >= percent * n) | (early & (100 * n >= percent * F.col("after")))
    )
    return close.select("token", "doc_id", "rows", F.min("doc_id").over(Window.partitionBy("token")).alias("leader"))


def _verified(pairs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link. Only texts whose id may be in a pair are looked at again."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    wanted = SlotFilter(ids, "doc_id")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            some = batch[wanted.held(batch["slot"])]
            made = [shingles(text, words).view(np.int64) for text in some["text"]]
            yield pd.DataFrame({"doc_id": some["doc_id"], "made": pd.Series(made, index=some.index, dtype=object)})
        release()

    found = rows.withColumn("slot", wanted.slot("doc_id")).mapInPandas(sets, "doc_id long, made array<long>")
    left, right = (found.withColumnsRenamed({"doc_id": x, "made": f"set_{x}"}) for x in "ab")
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    overlap = F.size(F.array_intersect("set_a", "set_b"))
    total = F.size("set_a") + F.size("set_b")
    return both.where((100 + percent) * overlap >= percent * total).select("a", "b").distinct()


def _open_sets(rows: DataFrame, open_ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, point, made) of the documents that are still open: their points and whole sorted sets."""
    wanted = SlotFilter(open_ids, "doc_id")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            some = batch[wanted.held(batch["slot"])]
            made = [shingles(text, words) for text in some["text"]]
            out = [(doc, len(m), vector(m), m.tobytes()) for doc, m in zip(some["doc_id"], made) if len(m)]
            yield pd.DataFrame(out, columns=["doc_id", "n", "point", "made"])
        release()

    return rows.withColumn("slot", wanted.slot("doc_id")).mapInPandas(sets, "doc_id long, n long, point binary, made binary")


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs whose points do not rule a link out."""
    left, right = (
        points.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("point").alias(f"point_{x}")) for x in "ab"
    )

    @F.pandas_udf("boolean")
    def possible(n_a: pd.Series, n_b: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        sizes = (n_a + n_b).to_numpy()
        return pd.Series(may_link(_pair_bounds(a.to_list(), b.to_list(), sizes), sizes, percent))

    close = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    both = pairs.join(left, "a").join(right, "b").where(close)
    return both.where(possible("n_a", "n_b", "point_a", "point_b")).select("a", "b")


def _dealt(inside: DataFrame) -> DataFrame:
    """The rows of blocks (token, doc_id, class, rows) dealt out to tasks, with their part and the parts (i, j) to compare.

    Whole small blocks share tasks of about ``TASK_ROWS`` rows. A large block is dealt
    by class: a class of ``PART`` rows or more has parts of its own, the others
    share parts. Only two parts that hold different classes meet, in a task of
    their own, so a hot class is never copied against itself.
    """
    zero = F.lit(0).cast("long")
    whole = inside.where(F.col("rows") <= PART)
    count = inside.agg(F.count_if(F.col("rows") <= PART).alias("whole"), F.count_if(F.col("rows") > PART).alias("large")).first()
    tasks = max(1, -(-count["whole"] // TASK_ROWS))
    whole = whole.withColumns({"part": zero, "i": zero, "j": zero}).withColumn("task", F.pmod(F.xxhash64("token"), F.lit(tasks)))
    if not count["large"]:
        return whole.drop("rows")
    large = inside.where(F.col("rows") > PART)
    own = large.groupBy("token", "class").agg(F.count(F.lit(1)).alias("own"))
    shared = own.where(F.col("own") < PART).groupBy("token").agg(F.ceil(F.sum("own") / PART).alias("shared"))
    chunk = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("own") / PART))
    part = F.when(F.col("own") < PART, F.pmod(F.xxhash64("class"), F.col("shared"))).otherwise(F.xxhash64("class", chunk))
    placed = large.join(own.join(shared, "token", "left"), ["token", "class"]).withColumn("part", part).drop("rows", "own", "shared")
    parts = stored(placed.groupBy("token", "part").agg(F.min("class").alias("low"), F.max("class").alias("high")), "parts")
    left, right = (parts.withColumnsRenamed({"part": x, "low": f"low_{x}", "high": f"high_{x}"}) for x in "ij")
    couples = left.join(right, "token").where("i <= j AND least(low_i, low_j) < greatest(high_i, high_j)")
    met = couples.select("token", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("part"))
    apart = placed.join(met, ["token", "part"]).withColumn("task", F.xxhash64("token", "i", "j"))
    return whole.drop("rows").unionByName(apart)


def _gathered(left: DataFrame) -> DataFrame:
    """(task, doc_id, class, heads, blocks) of open rows, so that a task gets a document's set once for all its blocks.

    Blocks that share documents go to one task: each follows the smallest id
    near it, two steps far. Where too much would meet, a block goes by its token.
    """
    single = (F.col("i") == 0) & (F.col("j") == 0)
    some = left.where(single).select("token", "doc_id", "n")
    first = some.groupBy("token").agg(F.min("doc_id").alias("first"))
    near = some.join(first, "token").groupBy("doc_id").agg(F.min("first").alias("near"))
    home = stored(some.join(near, "doc_id").groupBy("token").agg(F.min("near").alias("home"), F.sum("n").alias("volume")), "homes")
    volume = home.agg(F.sum("volume")).first()[0] or 0
    tasks = F.lit(max(1, -(-volume // TASK_SHINGLES)))
    small = home.groupBy("home").agg(F.sum("volume").alias("volume")).where(F.col("volume") <= TASK_SHINGLES).select("home")
    at = home.join(small.withColumn("small", F.lit(True)), "home", "left").select(
        "token", F.pmod(F.when(F.col("small"), F.xxhash64("home")).otherwise(F.xxhash64("token")), tasks).alias("shared")
    )
    placed = left.join(at, "token", "left").withColumn("task", F.when(single, F.col("shared")).otherwise(F.col("task")))
    return placed.groupBy("task", "doc_id").agg(
        F.first("class").alias("class"), F.first("heads").alias("heads"),
        F.collect_set(F.array("token", "part", "i", "j")).alias("blocks"),
    )


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    place = np.searchsorted(many, few)
    place[place == len(many)] = 0
    return int((many[place] == few).sum())


def _searched(blocks: DataFrame, percent: int) -> DataFrame:
    """Rows of blocks that are in some pair which points alone leave open, each once a block."""
    return _search(blocks, percent, checked=False)


def _linked(blocks: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) by the whole sets of rows as ``_gathered``: of each task a spanning forest of its classes."""
    return _search(blocks, percent, checked=True)


def _search(blocks: DataFrame, percent: int, checked: bool) -> DataFrame:
    """Blocks searched for pairs over classes, each pair in one block where that can be told.

    Where whole sets are ``checked``, classes that a task has linked already
    are not compared again. Either way there are at most as many rows out as
    in, however many pairs a block has.
    """
    same = ["task", "token", "doc_id", "class", "part", "i", "j", "heads", "n"]

    def small(frame: pd.DataFrame, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = [], []
        for size in np.unique(counts):
            first = starts[counts == size]
            for x in range(size):
                for y in range(x + 1, size):
                    left.append(first + x), right.append(first + y)
        none = np.zeros(0, np.int64)
        return (np.concatenate(left), np.concatenate(right)) if left else (none, none)

    def search(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        # What the group before this one held is free now.
        release()
        if checked:
            own = [np.stack(blocks) for blocks in frame["blocks"]]
            frame = frame.drop(columns="blocks").iloc[np.repeat(np.arange(len(frame)), [len(b) for b in own])]
            frame[["token", "part", "i", "j"]] = np.concatenate(own)
        frame = frame.sort_values(["token", "i", "j", "n", "doc_id"], ignore_index=True)
        block = frame[["token", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.append(True, (block[1:] != block[:-1]).any(1)))
        counts = np.diff(np.append(starts, len(frame)))
        n, classes, part = frame["n"].to_numpy(), frame["class"].to_numpy(), frame["part"].to_numpy()
        points, heads = frame["point"].to_list(), frame["heads"].to_list()
        tiny = counts <= 8
        a, b = small(frame, starts[tiny], counts[tiny])
        near = (classes[a] != classes[b]) & (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))
        a, b = a[near], b[near]
        bounds = _pair_bounds([points[k] for k in a], [points[k] for k in b], n[a] + n[b])
        near = may_link(bounds, n[a] + n[b], percent)
        found = [np.stack([a[near], b[near]], 1)]
        for low, count in zip(starts[~tiny], counts[~tiny]):
            rows = slice(low, low + count)
            found.append(Tree(n[rows], classes[rows], points[rows]).pairs(percent) + low)
        pairs = np.concatenate(found)
        token, i, j = block.T
        # In a task for two parts of a block, pairs within a part belong to another task.
        pairs = pairs[(part[pairs[:, 0]] != part[pairs[:, 1]]) | (i[pairs[:, 0]] == j[pairs[:, 0]])]
        if len(pairs):
            met = np.array([not any(t < token[x] for t in set(heads[x]) & set(heads[y])) for x, y in pairs.tolist()])
            pairs = pairs[met]
        if not checked:
            return frame.loc[np.unique(pairs), same]
        ids, made = frame["doc_id"].to_numpy(), frame["made"].to_list()
        above: dict[int, int] = {}

        def root(one: int) -> int:
            while one in above:
                above[one] = one = above.get(above[one], above[one])
            return one

        out = []
        for x, y in pairs.tolist():
            p, q = root(classes[x]), root(classes[y])
            if p == q:
                continue
            one, two = np.frombuffer(made[x], np.uint64), np.frombuffer(made[y], np.uint64)
            if may_link(_overlap(one, two), len(one) + len(two), percent):
                above[max(p, q)] = min(p, q)
                out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    rows = "task long, token long, doc_id long, class long, part long, i long, j long, heads array<long>, n long"
    return blocks.groupBy("task").applyInPandas(search, "a long, b long" if checked else rows)


def link(
    docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Sets link when their overlap is at least ``percent`` of their union. Words
    are split at ASCII white space and lower-cased in A to Z. A null text, or
    one without words, has an empty set, links with nothing and is its own
    component; rows with equal sets link. Rows of one id are one document that
    links as any of them does; a null id has a null component. No pair of
    different sets is given up: what points cannot rule out is checked on the
    whole sets, and only pairs already known to be in one component are not
    looked at again; the links that go on are as many as there are rows of
    blocks at most, however large a group of copies. Very long texts are taken
    whole. Other columns, whatever their names, are ignored.
    """
    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    sketch = _sketch(rows, words)
    sizes = sketch.where("signature IS NOT NULL").drop("counter")
    known = rows.where("doc_id IS NOT NULL")
    counters = sketch.where("counter IS NOT NULL").groupBy("counter").agg(F.sum("n").alias("n")).collect()
    weight = np.zeros(COUNTERS, np.int16)
    for r in counters:
        weight[r["counter"]] = round(4 * np.log2(1 + r["n"]))

    # Equal sets need one point. Its id stands for them.
    real = sizes.where("n > 0 AND doc_id IS NOT NULL")
    heads = real.groupBy("signature").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("rows"))
    alike = stored(
        real.join(heads.where("rows > 1"), "signature").where("doc_id <> head").select("doc_id", "head", "signature"), "alike"
    )
    points = _points(known, words, percent, weight, alike)
    light = points.drop("prefix")

    kept = stored(_blocks(points, percent), "blocks")

    # First links: each document with the leaders of its first and last block.
    ends = kept.groupBy("doc_id").agg(
        F.min(F.struct("token", "leader"))["leader"].alias("x"), F.max(F.struct("token", "leader"))["leader"].alias("y")
    )
    star = ends.select(F.explode(F.array("x", "y")).alias("a"), F.col("doc_id").alias("b")).where("a <> b").distinct()
    first = _verified(stored(_bounded(star, light, percent), "pairs"), known, words, percent)
    equal = alike.select(F.col("head").alias("a"), F.col("doc_id").alias("b"))
    first = stored(first, "links")
    classes = components(first)

    # Then every pair that lies in different classes so far and shares a block.
    sorted_in = kept.join(classes.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "class", F.coalesce("component", "doc_id")
    ).drop("component", "leader")
    mixed = sorted_in.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    inside = stored(sorted_in.join(mixed.select("token"), "token", "left_semi"), "mixed")
    heads_of = stored(
        inside.groupBy("doc_id").agg(F.slice(F.sort_array(F.collect_set("token")), 1, 4).alias("heads")), "heads"
    )
    # A block whose documents all share one earlier block has nothing to add to that.
    firsts = inside.join(heads_of.select("doc_id", F.col("heads")[0].alias("first")), "doc_id")
    needed = firsts.groupBy("token").agg(F.min("first").alias("low"), F.max("first").alias("high"))
    needed = needed.where("low < high OR high = token").select("token")
    inside = stored(inside.join(needed, "token", "left_semi"), "needed")
    dealt = _dealt(inside).join(light.join(heads_of, "doc_id"), "doc_id")
    left = stored(_searched(dealt, percent), "open")
    sets = _open_sets(known, left.select("doc_id"), words)
    second = stored(_linked(stored(_gathered(left), "gathered").join(sets, "doc_id"), percent), "links")

    found = components(first.unionByName(second).unionByName(equal))
    named = found.select(F.col("id").alias("doc_id"), "component")
    return sizes.join(named, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def representatives(
    docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with the smallest id of their component, with all their columns; null ids stay."""
    found = stored(link(docs, words, percent, id_col, text_col), "components")
    return without(docs, found.where("doc_id <> component_id").select("doc_id"), id_col, None)
