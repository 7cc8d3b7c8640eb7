"""Phrase collocations: n-grams counted in a prefix-free parse of the corpus.

Content-triggered windows cut every document into overlapping chunks. Equal
chunks are one dictionary entry with a parse frequency, so copies cost nothing
after the parse. Pages hold distinct chunks as word codes. Which n-grams can be
frequent is settled page by page: pages send packed hashes of their n-grams to
the tasks that own a range of hashes, and get back those that are frequent over
all pages. Phrases that pass are counted exactly, by their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, stored, text_or_empty

#: Words of the longest phrase, and words by which a chunk reaches into the next one.
LONGEST = 5
OVERLAP = LONGEST - 1
#: A window of ``OVERLAP`` words begins a chunk where its hash is 0 modulo this.
TRIGGER = 64
#: Bytes of text that one page holds before it is closed.
PAGE_BYTES = 4 << 20
#: Entries that one task sums at most, on average, when hashes are counted.
RANGE_ENTRIES = 2_000_000

#: The score of a cut, in decimals of 38 digits, cut to a whole number.
SCORE = (
    "(cast(a as decimal(19, 0)) * cast(n as decimal(16, 0)) * 1000BD) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
)

# Marks between pieces.
_MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_MARKS, b"." * len(_MARKS))

_PAGE = "page long, lang string, words binary, codes binary, lengths binary, owned binary, digests array<binary>, copies array<long>, size long"


def words_of(text: str) -> list[bytes]:
    """Words of a text, A-Z in lower case, with b"." between pieces."""
    raw = text.encode("utf-8", "replace").lower().translate(_TABLE)
    return raw.replace(b".", b" . ").split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _gram(longer: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of their first n-1 words and of their last word."""
    return _mix(longer * np.uint64(0x9E3779B97F4A7C15) + word)


def chunk_starts(hashes: np.ndarray, trigger: int = TRIGGER) -> np.ndarray:
    """Where the chunks of one document begin: at its start, and at every triggering window."""
    windows = len(hashes) - OVERLAP + 1
    if windows <= 1:
        return np.zeros(1 if len(hashes) else 0, np.int64)
    window = hashes[:windows]
    for k in range(1, OVERLAP):
        window = _gram(window, hashes[k : windows + k])
    hit = np.flatnonzero(window % np.uint64(trigger) == 0)
    return np.unique(np.append(hit, 0))


class _Codes(dict):
    """Word -> code of a page; code 0 is the mark between pieces."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


class _Page:
    """Distinct chunks of one language."""

    def __init__(self):
        self.codes, self.size, self.texts = _Codes({b".": 0}), 0, []

    def add(self, text: str) -> None:
        words = words_of(text)
        self.size += len(text)
        if words:
            self.texts.append(np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words)))

    def row(self, page: int, lang: str, trigger: int) -> tuple:
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.codes), np.uint64, len(self.codes))
        hashes[0] = 0
        chunks: dict[bytes, list] = {}
        for codes in self.texts:
            of_words = hashes[codes]
            starts = chunk_starts(of_words, trigger).tolist()
            for start, end in zip(starts, [*starts[1:], len(codes)]):
                reach = min(end + OVERLAP, len(codes))
                # The words owned are part of the identity: a last chunk owns all it holds.
                digest = xxhash.xxh3_128(of_words[start:reach].tobytes(), seed=reach - end).digest()
                found = chunks.get(digest)
                if found:
                    found[2] += 1
                else:
                    chunks[digest] = [codes[start:reach], end - start, 1]
        held = list(chunks.values())
        flat = np.concatenate([c for c, _, _ in held]) if held else np.zeros(0, np.int32)
        return (
            page, lang, _packed(b" ".join(self.codes)), _packed(flat), np.array([len(c) for c, _, _ in held], np.int32).tobytes(),
            np.array([n for _, n, _ in held], np.int32).tobytes(), list(chunks), [n for _, _, n in held], len(flat),
        )


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", trigger: int = TRIGGER) -> DataFrame:
    """Pages of distinct chunks, stored."""
    from pyspark import TaskContext

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [field.split()[0] for field in _PAGE.split(", ")]
        number = TaskContext.get().partitionId() << 33
        pages: dict[str, _Page] = {}

        def close(langs: list[str]) -> pd.DataFrame:
            nonlocal number
            rows = []
            for lang in langs:
                rows.append(pages.pop(lang).row(number, lang, trigger))
                number += 1
            return pd.DataFrame(rows, columns=columns)

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                pages.setdefault(lang, _Page()).add(text)
                if pages[lang].size >= PAGE_BYTES:
                    yield close([lang])
                elif len(pages) > 1 and sum(p.size for p in pages.values()) >= 2 * PAGE_BYTES:
                    yield close(list(pages))
        if pages:
            yield close(list(pages))

    rows = small_batches(docs).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text")
    )
    return stored(rows.mapInPandas(read, _PAGE), "pages")


def dictionary(pages: DataFrame) -> DataFrame:
    """(page, times): the parse frequency of each chunk of a page, 0 where another page keeps the chunk."""
    found = pages.select("page", "lang", F.posexplode(F.arrays_zip("digests", "copies")).alias("at", "chunk"))
    rows = found.select("page", "lang", "at", F.col("chunk.digests").alias("digest"), F.col("chunk.copies").alias("copies"))
    kept = rows.groupBy("lang", "digest").agg(F.sum("copies").alias("times"), F.min(F.struct("page", "at")).alias("keeper"))
    return kept.groupBy("keeper.page").agg(F.collect_list(F.struct(F.col("keeper.at").alias("at"), "times")).alias("times"))


class _Grams:
    """The words of a page in order, 0 wherever a phrase must stop, and how often each place counts."""

    def __init__(self, row: pd.Series):
        self.words = _unpacked(row["words"]).split(b" ")
        self.codes = np.frombuffer(_unpacked(row["codes"]), np.int32)
        self.weight = np.frombuffer(_unpacked(row["weight"]), np.int64)
        self.hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words), np.uint64, len(self.words))[self.codes]

    def lengths(self, longest: int, frequent: dict[int, np.ndarray], tag) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, starts, hashes) of the n-grams whose shorter parts are frequent, where that is known.

        ``frequent`` has the sorted tags of the frequent n-grams, by n. Places that
        do not count are named too: longer n-grams that do count reach over them.
        """
        alive, hashes = self.codes != 0, self.hashes
        for n in range(1, longest + 1):
            if n > 1:
                both = np.zeros_like(alive)
                both[:-1] = alive[:-1] & alive[1:]
                alive = both
                at = np.flatnonzero(alive)
                longer = np.zeros_like(self.hashes)
                longer[at] = _gram(hashes[at], self.hashes[at + n - 1])
                hashes = longer
            at = np.flatnonzero(alive)
            if n in frequent:
                good = _within(tag(hashes[at]), frequent[n])
                alive = np.zeros_like(alive)
                alive[at[good]] = True
                at = at[good]
            yield n, at, hashes[at]


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    place = np.searchsorted(known, values)
    found = np.zeros(len(values), bool)
    inside = place < len(known)
    found[inside] = known[place[inside]] == values[inside]
    return found


def _packed(data: bytes | np.ndarray) -> bytes:
    return zstandard.compress(data if isinstance(data, bytes) else data.tobytes(), 1)


def _unpacked(data) -> bytes:
    return zstandard.decompress(bytes(data))


_HELD = "page long, lang string, words binary, codes binary, weight binary"


def _rows(frame: DataFrame, make, schema: str) -> DataFrame:
    """One page after the other through ``make``, which gives the columns of a frame."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                made = pd.DataFrame(make(row))
                if len(made):
                    yield made

    return frame.mapInPandas(run, schema)


def held(pages: DataFrame) -> DataFrame:
    """Pages with the chunks that they keep, each followed by a stop, and the parse frequency of each place."""

    def keep(row: pd.Series) -> dict:
        lengths, owned = np.frombuffer(row["lengths"], np.int32), np.frombuffer(row["owned"], np.int32)
        times = np.zeros(len(lengths), np.int64)
        for entry in row["times"]:
            times[entry["at"]] = entry["times"]
        kept = times > 0
        within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        inside = np.repeat(kept, lengths)
        place = np.arange(inside.sum()) + np.repeat(np.arange(kept.sum()), lengths[kept])
        codes = np.zeros(len(place) + kept.sum(), np.int32)
        weight = np.zeros(len(codes), np.int64)
        codes[place] = np.frombuffer(_unpacked(row["codes"]), np.int32)[inside]
        weight[place] = np.where(within < np.repeat(owned, lengths), np.repeat(times, lengths), 0)[inside]
        return {"page": [row["page"]], "lang": [row["lang"]], "words": [row["words"]], "codes": [_packed(codes)], "weight": [_packed(weight)]}

    return _rows(pages.join(dictionary(pages), "page"), keep, _HELD)


def _candidates(pages: DataFrame, levels: range, bits: int, least: int) -> DataFrame:
    """(page, n, tags): what each page has that is frequent over all pages, for the lengths of ``levels``, stored.

    The first ``bits`` of a hash name the range that a task sums; the tag is
    these and 32 bits more. Tags that fall together only let an n-gram pass
    here. A page's counts are cut at ``least``, which is all the sum has to tell.
    """
    number = np.uint8 if least <= 255 else np.int32

    def send(row: pd.Series) -> dict:
        grams = _Grams(row)
        out = {"page": [], "lang": [], "n": [], "owner": [], "tags": [], "counts": []}
        for n, at, hashes in grams.lengths(levels[-1], {}, None):
            if n not in levels or not len(at):
                continue
            tags, group = np.unique(_tags(hashes, bits), return_inverse=True)
            count = np.minimum(np.bincount(group, grams.weight[at], len(tags)), least).astype(number)
            owner = (tags >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(owner)) + 1
            for start, part, amounts in zip([0, *cuts.tolist()], np.split(tags, cuts), np.split(count, cuts)):
                out["page"].append(row["page"]), out["lang"].append(row["lang"]), out["n"].append(n)
                out["owner"].append(int(owner[start])), out["tags"].append(part.astype(np.uint32).tobytes())
                out["counts"].append(amounts.tobytes())
        return out

    def settle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, n, owner = key
        parts = [np.frombuffer(b, np.uint32) for b in rows["tags"]]
        counts = np.concatenate([np.frombuffer(b, number) for b in rows["counts"]])
        tags, group = np.unique(np.concatenate(parts), return_inverse=True)
        good = (np.bincount(group, counts, len(tags)) >= least)[group]
        masks = np.split(good, np.cumsum([len(p) for p in parts])[:-1])
        top = np.uint64(owner) << np.uint64(32)
        blobs = [(part[mask].astype(np.uint64) | top).tobytes() for part, mask in zip(parts, masks)]
        some = [k for k, blob in enumerate(blobs) if blob]
        return pd.DataFrame({
            "page": rows["page"].to_numpy()[some], "n": np.full(len(some), n, np.int32), "tags": pd.Series([blobs[k] for k in some], dtype=object),
        })

    sent = _rows(pages, send, "page long, lang string, n int, owner long, tags binary, counts binary")
    return stored(sent.groupBy("lang", "n", "owner").applyInPandas(settle, "page long, n int, tags binary"), "frequent")


def _tags(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(32 - bits)


def _answered(pages: DataFrame, answers: DataFrame) -> DataFrame:
    """Pages with the frequent n-grams that they have; pages without any are done."""
    return pages.join(answers.groupBy("page").agg(F.collect_list(F.struct("n", "tags")).alias("frequent")), "page")


def _known(entries) -> dict[int, np.ndarray]:
    found: dict[int, list] = {}
    for entry in entries if entries is not None else []:
        found.setdefault(int(entry["n"]), []).append(np.frombuffer(entry["tags"], np.uint64))
    return {n: np.sort(np.concatenate(blobs)) for n, blobs in found.items()}


def _runs(pages: DataFrame, bits: int) -> DataFrame:
    """Pages cut down to runs of words of which all neighbours are frequent pairs."""

    def cut(row: pd.Series) -> dict:
        grams, known = _Grams(row), _known(row["frequent"])
        *_, (_, at, _) = grams.lengths(2, known, lambda hashes: _tags(hashes, bits))
        joined = np.zeros(len(grams.codes), bool)
        joined[at] = True
        named = joined.copy()
        named[at + 1] = True
        index = np.flatnonzero(named)
        stop = ~joined[index]
        place = np.arange(len(index)) + np.cumsum(stop) - stop
        codes = np.zeros(len(index) + stop.sum(), np.int32)
        weight = np.zeros(len(codes), np.int64)
        codes[place], weight[place] = grams.codes[index], grams.weight[index]
        used, codes = np.unique(np.append(0, codes), return_inverse=True)
        words = b" ".join(grams.words[c] for c in used.tolist())
        return {"page": [row["page"]], "lang": [row["lang"]], "words": [_packed(words)], "codes": [_packed(codes[1:].astype(np.int32))], "weight": [_packed(weight)]}

    return _rows(pages, cut, _HELD)


def _exact(pages: DataFrame, count, bits: int, least: int) -> DataFrame:
    """(lang, phrase, size, f), summed over all pages by the words themselves.

    ``count`` gives, for a page, (size, hashes, phrases, counts). A page sends
    one packed row to each task that owns a range of hashes.
    """

    def send(row: pd.Series) -> dict:
        out = {"lang": [], "size": [], "owner": [], "phrases": [], "counts": []}
        for size, hashes, phrases, counts in count(row):
            owner = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(owner, kind="stable")
            owners, starts = np.unique(owner[order], return_index=True)
            for one, places in zip(owners.tolist(), np.split(order, starts[1:])):
                out["lang"].append(row["lang"]), out["size"].append(size), out["owner"].append(one)
                out["phrases"].append(_packed(b"\n".join(phrases[k] for k in places.tolist())))
                out["counts"].append(counts[places].tobytes())
        return out

    def settle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, size, _ = key
        total: dict[bytes, int] = {}
        for phrases, counts in zip(rows["phrases"], rows["counts"]):
            for phrase, f in zip(_unpacked(phrases).split(b"\n"), np.frombuffer(counts, np.int64).tolist()):
                total[phrase] = total.get(phrase, 0) + f
        found = [(phrase.decode("utf-8", "replace"), f) for phrase, f in total.items() if f >= least or size == 0]
        return pd.DataFrame({
            "lang": pd.Series([lang] * len(found), dtype=object),
            "phrase": pd.Series([phrase for phrase, _ in found], dtype=object),
            "size": np.full(len(found), size, np.int32),
            "f": pd.Series([f for _, f in found], dtype="int64"),
        })

    sent = _rows(pages, send, "lang string, size int, owner long, phrases binary, counts binary")
    return sent.groupBy("lang", "size", "owner").applyInPandas(settle, "lang string, phrase string, size int, f long")


def _phrases(longest: int, bits: int):
    """What a page counts of the phrases, of two words or more, that can be frequent."""

    def count(row: pd.Series) -> Iterator[tuple]:
        grams, known = _Grams(row), _known(row["frequent"])
        frequent = {n: known.get(n, np.zeros(0, np.uint64)) for n in range(3, longest + 1)}
        number = np.zeros(len(grams.codes), np.int64)  # of the phrase one word shorter at each place
        for n, at, hashes in grams.lengths(longest, frequent, lambda hashes: _tags(hashes, bits)):
            if not len(at):
                break
            _, first, group = np.unique(number[at] * len(grams.words) + grams.codes[at + n - 1], return_index=True, return_inverse=True)
            number[at] = group
            if n == 1:
                continue
            total = np.zeros(len(first), np.int64)
            np.add.at(total, group, grams.weight[at])
            first, total = first[total > 0], total[total > 0]
            places = at[first].tolist()
            yield n, hashes[first], [b" ".join(grams.words[c] for c in grams.codes[i : i + n].tolist()) for i in places], total

    return count


def _words(row: pd.Series) -> Iterator[tuple]:
    """What a page counts of each word, and of all words (size 0)."""
    grams = _Grams(row)
    total = np.zeros(len(grams.words), np.int64)
    np.add.at(total, grams.codes, grams.weight)
    at = np.flatnonzero(total[1:]) + 1
    words = [grams.words[c] for c in at.tolist()]
    yield 0, np.zeros(1, np.uint64), [b""], total[1:].sum(keepdims=True)
    yield 1, np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), words, total[at]


def frequencies(
    docs: DataFrame, least: int = 100, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang", trigger: int = TRIGGER
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f), words and phrases of up to ``longest`` words with f of ``least`` or more,
    and (lang, n), all words of each language; all exact."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases of 2 to {LONGEST} words")
    parsed = parse(docs, text_col, lang_col, trigger)
    words = parsed.agg(F.sum("size")).first()[0] or 0
    bits = max(4, min(31, int(np.ceil(np.log2(max(1, words / RANGE_ENTRIES))))))
    pages = stored(held(parsed), "dictionary")
    pairs = _candidates(pages, range(2, 3), bits, least)
    runs = stored(_runs(_answered(pages, pairs), bits), "runs")
    # Pages whose runs are all of two words have no longer candidate, but are spelled all the same.
    longer = _candidates(runs, range(3, longest + 1), bits, least) if longest > 2 else pairs.limit(0)
    told = longer.groupBy("page").agg(F.collect_list(F.struct("n", "tags")).alias("frequent"))
    phrases = _exact(runs.join(told, "page", "left"), _phrases(longest, bits), bits, least)
    counts = stored(phrases.unionByName(_exact(pages, _words, bits, least)), "phrases")
    return counts.where("size > 0"), counts.where("size = 0").select("lang", F.col("f").alias("n"))


def _slice(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def collocations(
    docs: DataFrame, least: int = 100, longest: int = LONGEST, top: int = 2_000, text_col: str = "text", lang_col: str = "lang",
    trigger: int = TRIGGER,
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``longest`` words with a = f(phrase) >= ``least`` is scored
    by its weakest cut into l = f(first part) and r = f(rest): the floor of
    1000 a n / (l r), exactly. Phrases that a longer one has, as often, go. Of
    the others each language's first ``top`` stay (a report): by score, then a,
    both falling, then by the phrase's bytes.

    - A null text has no words; a null language is ``und``; null and repeated ids
      do not matter, as every row counts; other columns are ignored.
    - A very long text is cut into chunks like all others and lies in one page.
    - An empty table, or one without frequent phrases, gives no rows.
    - Equal scores and counts go by phrase, so the result does not depend on partitions.
    """
    counts, totals = frequencies(docs, least, longest, text_col, lang_col, trigger)
    found = counts.where("size > 1").withColumn("words", F.split("phrase", " "))
    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part"))
    cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "cut",
        _slice(F.lit(1), F.col("cut")).alias("part"), _slice(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("rest"),
    )
    cuts = cuts.join(parts, ["lang", "part"]).withColumnRenamed("of_part", "l").drop("part")
    cuts = cuts.withColumnRenamed("rest", "part").join(parts, ["lang", "part"]).withColumnRenamed("of_part", "r").drop("part")
    cuts = cuts.join(totals, "lang")
    scored = cuts.withColumn("score", F.expr(SCORE).cast("long")).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("weakest")
    )
    # Every shorter phrase inside a longer candidate, and the most that any such candidate counts.
    inner = found.where("size > 2").select(
        "lang", "f", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part_size")
    ).select("lang", "f", "words", "part_size", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part_size") + 1)).alias("start"))
    covered = inner.select("lang", "f", _slice(F.col("start"), F.col("part_size")).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("f").alias("within")
    )
    left = scored.join(covered, ["lang", "phrase"], "left").where(F.coalesce(F.col("within") < F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("weakest.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("weakest.l").alias("l"), F.col("weakest.r").alias("r"),
        "n", F.col("weakest.score").alias("score"),
    )
