"""Radix trees and the conversation trie against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tidemark.llm import prefix_trie
from tidemark.llm.radix_tree import RadixTree, shared

SCHEMA = "conv_id long, turn long, role string, text string, base string, turns string, key string, part string"


def brute(rows: list[tuple], rebuild: bool = True) -> set[tuple]:
    """The trie by lists of prefixes."""
    held: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            whole = f"{len(role.encode())}:{role}{text}".encode()
            held.setdefault(conv, []).append(((-1 << 62) if turn is None else turn, hashlib.sha256(whole).digest()[:16], role, text))
    told = {conv: [(r, t) for *_, r, t in sorted(found)] for conv, found in held.items()}
    made = {}
    for conv, own in told.items():
        h = zlib.crc32(str(conv).encode()) % 9
        made[conv] = told.get(conv - conv % 5, [])[:h] + own[h:] if rebuild else own
    members: dict[tuple, list[int]] = {}
    for conv, said in made.items():
        for depth in range(len(said) + 1):
            members.setdefault(tuple(said[:depth]), []).append(conv)
    out = set()
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        ends = sorted(c for c in convs if len(made[c]) == len(prefix))
        out.add((
            min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs),
            sum(len(p) == len(prefix) + 1 for p in below),
            sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return out


def got(spark, rows: list[tuple], rebuild: bool = True, parts: int = 3) -> list[tuple]:
    frame = spark.createDataFrame([(*row, "b", "t", "k", "p") for row in rows], SCHEMA).repartition(parts)
    return [tuple(row) for row in prefix_trie.trie(frame, rebuild).collect()]


def talk(seed: int, convs: int, longest: int) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(convs * 2), convs):
        for turn in range(draw.randint(0, longest)):
            rows.append((conv, turn, draw.choice(["user", "a"]), draw.choice(["é", "x" * 9, ""]) if turn else "hello"))
    return rows


def test_radix_tree_keeps_all_keys_in_order():
    draw = random.Random(7)
    keys = {bytes(draw.choice(b"\x00\x01ab\xff") for _ in range(draw.randint(0, 6))) for _ in range(600)}
    keys |= {bytes([a]) + b"tail" for a in range(256)}
    tree = RadixTree()
    for number, key in enumerate(draw.sample(sorted(keys), len(keys))):
        tree.insert(key, 1, number, key)

    def walk(node, path):
        if node.end is not None:
            yield path, node
        for byte, child in node.children():
            assert child.path[0] == byte
            yield from walk(child, path + child.path)

    found = list(walk(tree.root, b""))
    assert [path for path, _ in found] == sorted(keys)
    assert all(path == node.end for path, node in found)
    assert tree.root.count == len(keys) and tree.root.layout == 256


@pytest.mark.parametrize("a, b, common", [(b"", b"a", 0), (b"ab", b"ab", 2), (b"abc", b"abx", 2), (b"x" * 999, b"x" * 500 + b"y", 500)])
def test_shared_prefix(a, b, common):
    assert shared(a, b) == shared(b, a) == common


@pytest.mark.parametrize("size", [1, 60, 4 << 20])
@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_like_brute_force(spark, monkeypatch, size, rebuild):
    """Trees of one key, of three turns, and of everything give the same nodes."""
    monkeypatch.setattr(prefix_trie, "TREE_BYTES", size)
    rows = talk(3, 60, 6)
    found = got(spark, rows, rebuild)
    assert len(found) == len(set(found))
    assert set(found) == brute(rows, rebuild)


def test_runs_of_ids_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN_IDS", 3)
    rows = [(conv, 0, "user", "same") for conv in range(0, 900, 5)] + [(11, 0, "user", "other")]
    assert set(got(spark, rows, False)) == brute(rows, False)


def test_hard_conversations(spark):
    rows = [
        (None, 0, "user", "no conversation"), (5, None, None, None), (5, 0, "user", "a"), (5, 0, "user", "a"),
        (5, 0, "b", "tie"), (6, 3, "user", None), (7, 1, None, "long " * 200_000), (8, 1, "", "long " * 200_000),
        (20, -4, "u", "x"), (-3, 0, "u", "x"), (23, 0, "u", "absent first"), (24, 0, "1:", "u"), (24, 1, "1", ":u"),
    ]
    # -3 - (-3) % 5 is -3 + 3 = 0 in SQL, -5 in Python; neither is there, so its own turns after h count.
    assert set(got(spark, rows, False)) == brute(rows, False)
    assert set(got(spark, rows)) == brute(rows)


def test_no_conversation(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 0, "user", "x")]) == []
