"""Suffix-array dedup: repeated byte strings by bucket-pointer refinement.

A suffix's bucket is the hash of its first bytes. Suffixes alone in their
bucket repeat nothing and leave; the others are refined by the buckets of later
offsets until a bucket tells whether a string of the wanted length repeats:

1. One suffix is sampled for each stretch of starts, by the smallest hash of a
   short gram. The choice depends on bytes of the string alone, so equal strings
   sample the same offset. The sampled suffixes are sorted by q-gram bucket.
2. Where that bucket repeats, it is refined by the bytes before and after. If
   the whole neighbourhood repeats, so does every string inside it.
3. Only starts whose sample is neither alone nor settled become suffixes of
   their own, and those of one sample for each neighbourhood, for comparison.
   Their bucket is the pair of the q-gram buckets here and at the later offset
   where the string ends.

Buckets, neighbourhoods and the texts of one id are told by 64 bits or more:
many texts share one passage, and 32 bits fail at some 2^16 of them.

Each round is a sort by bucket over all tasks, in which neighbours are compared.
The sort ranges split a hot bucket like any other rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SlotFilter, small_batches, stored, text_or_empty

U = np.uint64
_SEGMENT = 1 << 20
_MIX = U(0xD6E8FEB86659FD93)
_BASE = 0x9E3779B97F4A7C15
_PLACE = U((1 << 24) - 1)
_SHORT = 12


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * _MIX
    h = (h ^ (h >> U(32))) * _MIX
    return h ^ (h >> U(32))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * U(0xA24BAED4963EE407))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Hashes:
    """Hashes of any substring of ``raw`` from sums over its prefixes."""

    def __init__(self, raw: bytes):
        up, self.down = _powers(1 << max(16, len(raw).bit_length()))
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[np.frombuffer(raw, np.uint8)] * up[: len(raw)], out=self.sums[1:])

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return _mix((self.sums[high] - self.sums[low]) * self.down[low])

    def every(self, size: int, count: int) -> np.ndarray:
        """Hashes of the substrings of ``size`` bytes that start at 0, 1, ... (``count`` of them)."""
        return _mix((self.sums[size : size + count] - self.sums[:count]) * self.down[:count])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of each window of ``width``."""
    count, reach, step = len(values) - width + 1, values, 1
    while step * 2 <= width:
        reach, step = np.minimum(reach[:-step], reach[step:]), step * 2
    return np.minimum(reach[:count], reach[width - step : width - step + count])


class Segment:
    """The starts of one stretch of a text, and the sampled suffix that speaks for each of them."""

    def __init__(self, raw: bytes, base: int, length: int, gram: int):
        part = raw[base : base + _SEGMENT + length - 1]
        self.base, self.length, self.gram, self.size = base, length, gram, len(part)
        self.starts = len(part) - length + 1
        self.slack = length - gram
        self.hashes = Hashes(part)
        # Windows go on to the end of the text, so that a string's samples do not depend on what follows it.
        short = self.hashes.every(_SHORT, self.size - _SHORT + 1)
        ranked = (short & ~_PLACE) | np.arange(len(short), dtype=np.uint64)
        self.speaker = (_smallest(ranked, self.slack + 1) & _PLACE).astype(np.int64)
        last = np.flatnonzero(np.append(np.diff(self.speaker) != 0, True))
        last = last[self.speaker[last] + gram <= self.size]
        self.last_start, self.sampled = last, self.speaker[last]

    def buckets(self) -> tuple[np.ndarray, np.ndarray]:
        """q-gram bucket of the sampled suffixes, and the hash that refines it: the bytes around."""
        at = self.sampled
        low, high = np.maximum(at - self.slack, 0), np.minimum(at + self.length, self.size)
        around = self.hashes.between(low, high) + _mix((high - low).astype(U) * U(7919) + (at - low).astype(U))
        return self.hashes.between(at, at + self.gram), _mix(around)

    def _own(self, places: np.ndarray) -> np.ndarray:
        places = np.asarray(places, np.int64)
        return places[(places >= self.base) & (places < self.base + self.size)] - self.base

    def _within(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which starts lie in any of the ranges from ``low`` to before ``high``."""
        change = np.zeros(self.starts + 1, np.int32)
        low = np.clip(low, 0, self.starts)
        np.add.at(change, low, 1)
        np.add.at(change, np.clip(high, low, self.starts), -1)
        return np.cumsum(change[:-1]) > 0

    def settled(self, whole: np.ndarray) -> np.ndarray:
        """Which starts repeat because the whole neighbourhood of a sample does."""
        at = self._own(whole)
        at = at[np.isin(at, self.sampled)]
        return self._within(at - self.slack, at + 1)

    def open(self, places: np.ndarray, whole: np.ndarray, shown: np.ndarray) -> np.ndarray:
        """Starts to refine, given the places of samples whose bucket repeats.

        A lone sample rules out the strings that hold it and were bound to
        sample it. Where the start's own sample repeats as a ``whole``, the
        string does too, and one of the alike samples is ``shown`` for the
        others to be compared with.
        """
        lone = ~np.isin(self.sampled, self._own(places))
        ruled_out = self._within(self.sampled[lone] - self.slack, self.last_start[lone] + 1)
        speaker = self.speaker[: self.starts]
        return np.flatnonzero((~ruled_out & ~np.isin(speaker, self._own(whole))) | np.isin(speaker, self._own(shown)))

    def refined(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of whole strings: that of their first q-gram with that of their last, at a later offset."""
        first = self.hashes.between(starts, starts + self.gram)
        later = self.hashes.between(starts + self.slack, starts + self.length)
        return _mix(first * U(3) + later), _mix(first + later * U(5)) >> U(32)


def segments(raw: bytes, length: int, gram: int) -> Iterator[Segment]:
    for base in range(0, len(raw) - length + 1, _SEGMENT):
        yield Segment(raw, base, length, gram)


def sampled(raw: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    for part in segments(raw, length, gram):
        yield *part.buckets(), part.sampled + part.base


def _signed(values: np.ndarray, kind: type) -> np.ndarray:
    return values.astype(np.uint64 if kind is np.int64 else np.uint32).view(kind)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.Table]:
    """The batches of a task joined to tables of about ``rows`` rows; for rows of a few numbers each."""
    waiting, count = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(waiting).combine_chunks()
            waiting, count = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def twins(rows: DataFrame, bucket: list[str], finer: str | None = None) -> DataFrame:
    """The rows that share their bucket with another row, found by one sort.

    ``finer`` adds ``whole``: true where a neighbour in the bucket has that
    column's value too, and ``first``: the first row with that value. A bucket may go on in the next range; so the first and
    the last row of each range, two for each task, are compared once more.
    """
    order = [*bucket, *([finer] if finer else []), *[c for c in rows.columns if c not in bucket and c != finer]]
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", whole boolean, first boolean, twin boolean, edge boolean"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[pa.Table, dict[str, np.ndarray]] | None = None

        def released(table: pa.Table, flags: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
            flagged = table
            for name in ("whole", "first", "twin", "edge"):
                flagged = flagged.append_column(name, pa.array(flags[name]))
            yield from flagged.filter(pa.array(flags["twin"] | flags["edge"])).to_batches()

        for table in _gathered(batches):
            count = table.num_rows
            flags = {"whole": np.zeros(count, bool), "first": np.ones(count, bool), "twin": np.zeros(count, bool),
                     "edge": np.zeros(count, bool)}
            if held is None:
                flags["edge"][0] = True
            else:
                table = pa.concat_tables([held[0], table])
                flags = {name: np.concatenate([held[1][name], flag]) for name, flag in flags.items()}
            same = np.ones(table.num_rows - 1, bool)
            for name in bucket:
                values = table.column(name).to_numpy()
                same &= values[1:] == values[:-1]
            alike = same
            if finer:
                values = table.column(finer).to_numpy()
                alike = same & (values[1:] == values[:-1])
            for name, equal in (("twin", same), ("whole", alike)):
                flags[name][1:] |= equal
                flags[name][:-1] |= equal
            flags["first"][1:] = ~alike
            held = table.slice(table.num_rows - 1), {name: flag[-1:] for name, flag in flags.items()}
            yield from released(table.slice(0, table.num_rows - 1), {name: flag[:-1] for name, flag in flags.items()})
        if held is not None:
            yield from released(held[0], {**held[1], "edge": np.ones(1, bool)})

    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(sorted_rows.mapInArrow(compare, schema), "twins")
    shared = found.where("edge").groupBy(*bucket).count().where("count > 1").select(*bucket)
    late = found.where("edge AND NOT twin").join(shared, bucket, "left_semi")
    return found.where("twin").unionByName(late.select(found.columns)).drop("twin", "edge")


_KEY = ["doc_id", "tag"]


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _lists(batch: pa.RecordBatch, name: str) -> Iterator[np.ndarray]:
    column = batch.column(name)
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return (values[low:high] for low, high in zip(ends[:-1], ends[1:]))


def _keyed_rows(batch: pa.RecordBatch, of: list[int], found: list[tuple], names: list[tuple[str, type]]) -> pa.RecordBatch:
    """One row for each number found, with the key of the text (row ``of`` of the batch) that it was found in."""
    sizes = [len(columns[0]) for columns in found]
    row = pa.array(np.repeat(np.array(of, np.int64), sizes))
    arrays = [pa.array(_signed(np.concatenate(values), kind)) for values, (_, kind) in zip(zip(*found), names)]
    arrays[2:2] = [batch.column(key).take(row) for key in _KEY]
    labels = [name for name, _ in names]
    return pa.RecordBatch.from_arrays(arrays, names=[*labels[:2], *_KEY, *labels[2:]])


def _sampled(docs: DataFrame, length: int, gram: int) -> DataFrame:
    names = [("bucket", np.int64), ("around", np.int64), ("place", np.int64)]

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, found = [], []
            for k, raw in enumerate(_bytes(batch)):
                parts = list(sampled(raw, length, gram))
                if len(parts) > 1:  # stretches overlap
                    q, around, place = map(np.concatenate, zip(*parts))
                    place, first = np.unique(place, return_index=True)
                    parts = [(q[first], around[first], place)]
                if parts:
                    of.append(k)
                    found.append(parts[0])
            if found:
                yield _keyed_rows(batch, of, found, names)

    return docs.mapInArrow(sample, "bucket long, around long, doc_id long, tag long, place long").withColumn(
        "place", F.col("place").cast("int")
    )


def _open_starts(marked: DataFrame, length: int, gram: int) -> DataFrame:
    names = [("bucket", np.int64), ("check", np.int32), ("start", np.int64)]

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, found = [], []
            marks = zip(_bytes(batch), *(_lists(batch, name) for name in ("places", "whole", "shown")))
            for k, (raw, places, whole, shown) in enumerate(marks):
                for part in segments(raw, length, gram):
                    starts = part.open(places, whole, shown)
                    if len(starts):
                        of.append(k)
                        found.append((*part.refined(starts), starts + part.base))
            if found:
                yield _keyed_rows(batch, of, found, names)

    return marked.mapInArrow(refine, "bucket long, check int, doc_id long, tag long, start long").withColumn(
        "start", F.col("start").cast("int")
    )


def runs(covered: np.ndarray) -> np.ndarray:
    """(low, high) of the stretches where ``covered`` holds."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return edges.reshape(-1, 2)


def _settled(raw: bytes, length: int, gram: int, whole: np.ndarray) -> np.ndarray:
    """Starts that repeat because the whole neighbourhood of a sample does."""
    if not len(whole):
        return whole
    if len(raw) - length < _SEGMENT:
        # One stretch: every place was sampled in it and speaks for the starts up to it, with no hash formed again.
        change = np.zeros(len(raw) - length + 2, np.int32)
        np.add.at(change, np.maximum(whole - (length - gram), 0), 1)
        np.add.at(change, np.minimum(whole + 1, len(change) - 1), -1)
        return np.flatnonzero(np.cumsum(change[:-1]) > 0)
    return np.concatenate([np.flatnonzero(part.settled(whole)) + part.base for part in segments(raw, length, gram)])


def removed(raw: bytes, length: int, gram: int, whole, starts) -> np.ndarray:
    """Which bytes a repeated string covers, given whole samples and refined starts."""
    covered = np.zeros(len(raw) + 1, np.int32)
    for at in (np.asarray(starts, np.int64), _settled(raw, length, gram, np.asarray(whole, np.int64))):
        np.add.at(covered, at, 1)
        np.add.at(covered, at + length, -1)
    return np.cumsum(covered[:-1]) > 0


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(
    docs: DataFrame, length: int = 400, gram: int = 280, id_col: str = "doc_id", text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``spans`` and ``kept``).

    A byte is removed when a string of ``length`` bytes that covers it also
    starts anywhere else, in this or another document, on the input as it is.
    Null counts as empty; texts shorter than ``length`` lose nothing; repeated
    rows repeat each other, whatever their ids; an empty table gives no rows;
    other columns are ignored. Long texts are worked on in stretches. Texts
    are shuffled only where a sampled suffix repeats. With ``with_text``, the
    removed spans (byte ranges) and the remaining bytes come along.
    """
    text = text_or_empty(text_col)
    rows = small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text")
    )
    suffixes = stored(_sampled(rows.where(F.octet_length("text") >= length), length, gram), "suffixes")
    shared = twins(suffixes, ["bucket"], "around")
    mixed = shared.where("NOT whole").select("bucket").distinct()
    shown = shared.where("whole AND first").join(mixed, "bucket", "left_semi").select(*_KEY, "place")
    places = shared.select(*_KEY, "place", "whole", F.lit(False).alias("shown")).unionByName(
        shown.select(*_KEY, "place", F.lit(True).alias("whole"), F.lit(True).alias("shown"))
    )
    found = F.sort_array(F.collect_list(F.struct("place", "whole", "shown")))
    marks = stored(
        places.groupBy(*_KEY).agg(found.alias("found")).select(
            *_KEY,
            F.col("found.place").alias("places"),
            F.expr("transform(filter(found, x -> x.whole), x -> x.place)").alias("whole"),
            F.expr("transform(filter(found, x -> x.shown), x -> x.place)").alias("shown"),
        ),
        "marks",
    )
    near = rows.withColumn("near", SlotFilter(marks, "doc_id").holds("doc_id"))
    some = near.where("near").drop("near")

    def keyed(other: DataFrame):
        return F.col("doc_id").eqNullSafe(other["other_id"]) & (F.col("tag") == other["other_tag"])

    def other(frame: DataFrame) -> DataFrame:
        return frame.withColumnsRenamed({"doc_id": "other_id", "tag": "other_tag"})

    named = other(marks)
    marked = some.join(named, keyed(named)).select(*_KEY, "text", "places", "whole", "shown")
    again = twins(_open_starts(marked, length, gram), ["bucket", "check"])
    starts = other(again.select(*_KEY, "start").distinct().groupBy(*_KEY).agg(F.collect_list("start").alias("starts")))
    full = (
        some.join(named, keyed(named), "left").drop("other_id", "other_tag")
        .join(starts, keyed(starts), "left").select("doc_id", "text", "whole", "starts")
    )
    schema = RESULT + (", spans array<array<long>>, kept binary" if with_text else "")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, whole, given in zip(*(batch[c] for c in ("doc_id", "text", "whole", "starts"))):
                raw = text.encode("utf-8", "replace")
                gone = removed(raw, length, gram, [] if whole is None else whole, [] if given is None else given)
                spans = runs(gone)
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                row = (doc, len(raw), int(gone.sum()), len(spans), hashlib.sha256(kept).hexdigest())
                out.append((*row, spans.tolist(), kept) if with_text else row)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")]).astype({"doc_id": "Int64"})

    clear = near.where("NOT near").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
        *([F.array().cast("array<array<long>>").alias("spans"), F.encode("text", "UTF-8").alias("kept")] if with_text else []),
    )
    return clear.unionByName(full.mapInPandas(cut, schema))
