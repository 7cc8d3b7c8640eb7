"""Packing: ids as the whole tokenizer gives them, gapless sequences, few of them."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import hard_rows
from tidemark.llm.packing import pack, pieces, place
from tidemark.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text: str) -> np.ndarray:
    ids = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    return np.array([*ids, 0], "<u4")


def test_word_by_word_is_the_tokenizer():
    draw = random.Random(1)
    texts = ["".join(chr(draw.randrange(256)) for _ in range(200)) for _ in range(60)]
    texts += ["İstanbul ΣΑΣ don't I'LL 'sx 12½", "a<|endoftext|>b", "\x1c a\x85b\xa0c", "œuvre ÀÉ", "日本 語", "", " "]
    encoder, whole = WordEncoder(PATH, limit=20), Tokenizer.from_file(PATH)
    for text in texts:
        got = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids, text


def test_frequent_words_stay_known():
    encoder, made = WordEncoder(PATH, limit=20), []
    make = encoder.words.make
    encoder.words.make = lambda word: made.append(word) or make(word)
    for k in range(200):
        encoder.encode(f"frequent rare{k}x")
    assert made.count("frequent") == 1
    assert len(encoder.words) + len(encoder.words.old) <= 20


def test_batch_is_text_by_text():
    draw = random.Random(2)
    texts = ["", " \n\xa0", "One\x85two\x0bthree\xa0four", "日本 語", "a<|endoftext|>b", "x\x1cy", "don't 'sx", "\n\n", "x\udc80"]
    texts += ["".join(chr(draw.randrange(256)) for _ in range(draw.randrange(90))) for _ in range(60)]
    draw.shuffle(texts)
    whole = Tokenizer.from_file(PATH)
    want = [whole.encode(t.encode("utf-8", "replace").decode(), add_special_tokens=False).ids for t in texts]
    for limit in (8, 100_000):
        got = WordEncoder(PATH, limit=limit).encode_all(texts)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == want
    assert WordEncoder(PATH).encode_all([]) == []


def test_words_of_a_batch_are_looked_up_once():
    encoder, asked = WordEncoder(PATH), Counter()
    words = encoder.words

    class Counted(dict):
        def __missing__(self, part):
            asked[part] += 1
            return words[part]

    encoder.words = Counted()
    encoder.encode_all([f"frequent rare{k}x Frequent\tfrequent" for k in range(200)])
    assert asked["frequent"] == 1 and asked["rare"] == 200


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_and_places(hard, capacity):
    rows = pack(pieces(hard, PATH, capacity), capacity, shard_pieces=50).collect()
    want = Counter()
    for doc, text, *_ in hard_rows():
        ids = ids_of(text or "")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[doc, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity


def test_few_sequences():
    draw = random.Random(3)
    lengths = np.sort([min(2047, int(draw.lognormvariate(5.5, 1)) + 1) for _ in range(20_000)])[::-1]
    bins, offsets = place(lengths, 2048)
    assert len(set(bins.tolist())) <= -(-int(lengths.sum()) // 2048) + 2


def test_sum_of_squares_choice():
    # Two bins have a gap of 4, one a gap of 3; the piece of 3 must leave the sum of squares smallest:
    # the gap of 3 gives 4, a gap of 4 gives 1 + 1 + 1.
    bins, _ = place(np.array([7, 6, 6, 3]), 10)
    assert bins[3] in (1, 2)


def test_empty(nothing):
    assert pack(pieces(nothing, PATH)).count() == 0


def test_ids_come_along(hard):
    row = pieces(hard, PATH, with_ids=True).where("doc_id = 4").first()
    assert row.ids == ids_of("one two").tolist()
