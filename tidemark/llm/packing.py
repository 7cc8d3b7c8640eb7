"""Best-fit packing: every piece goes where the squared counts of open gaps stay smallest."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, stored, text_or_empty
from tidemark.llm.tokens import encoder

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The token ids of every whole text, then ``end_id``, cut into pieces of ``capacity`` tokens.

    Only longer documents are cut; their last piece may be shorter. A null text
    counts as empty, which is one piece of one token. ``row`` tells apart rows
    with the same id. ``with_ids`` adds the ids of each piece.
    """
    end = np.array([end_id], "<u4").tobytes()
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            for row, doc, ids in zip(batch["row"], batch["doc_id"], words.encode_all(batch["text"])):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    own = (np.frombuffer(part, "<u4").astype(np.int32),) if with_ids else ()
                    out.append((row, doc, piece, at // 4, len(part) // 4, zlib.crc32(part), *own))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
            yield frame.astype({"doc_id": "Int64"})

    rows = small_batches(docs).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        text_or_empty(text_col).alias("text"),
    )
    return rows.mapInPandas(cut, schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; ``lengths`` go in falling order.

    Of all open bins with room, the piece goes to the gap that makes the sum of
    squared numbers of bins per gap smallest; the tightest gap wins ties. A bin
    is opened only where none has room. With falling lengths, the many short
    pieces come last and fill what is left.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for k, length in enumerate(lengths.tolist()):
        gaps = np.flatnonzero(count[length:]) + length
        if len(gaps):
            left = gaps - length
            # One bin less with the old gap, one more with the new; a full bin has no gap.
            change = np.where(left > 0, 2 * count[left] + 2, 1) - 2 * count[gaps]
            gap = int(gaps[change.argmin()])
            own = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, own, used = capacity, used, used + 1
        bins[k], offsets[k] = own, capacity - gap
        if gap > length:
            count[gap - length] += 1
            open_bins[gap - length].append(own)
    return bins, offsets


def pack(cut: DataFrame, capacity: int = 2048, shard_pieces: int = 40_000) -> DataFrame:
    """``cut`` (of ``pieces``) with sequence_id and offset, gapless in every sequence.

    Full pieces are sequences by themselves. The others are dealt by hash into
    shards of about ``shard_pieces``, and each shard is packed in one task: a
    shard leaves about one bin partly empty, so the number of sequences does
    not depend on the number of machines. No piece or row is left out; an empty
    table gives no rows. Rows alike in all columns are packed one by one.
    """
    found = stored(cut.withColumn("at", F.monotonically_increasing_id()), "pieces")
    part = F.col("length") < capacity
    shards = max(1, -(-found.where(part).count() // shard_pieces))
    schema = found.schema.add("sequence_id", "long").add("offset", "long")

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "at"], ascending=[False, True], kind="stable")
        bins, offsets = place(rows["length"].to_numpy(), capacity)
        return rows.drop(columns="shard").assign(sequence_id=bins * shards + key[0], offset=offsets)

    full = found.where(~part).withColumns({"sequence_id": -1 - F.col("at"), "offset": F.lit(0).cast("long")})
    dealt = found.where(part).withColumn("shard", F.pmod(F.xxhash64("at"), F.lit(shards)))
    packed = dealt.groupBy("shard").applyInPandas(fill, schema)
    return full.unionByName(packed).drop("at")
