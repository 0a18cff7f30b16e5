import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimweave.llm import trie
from dimweave.llm.radix import LAYOUTS, RadixTree

SCHEMA = "conv_id long, turn long, role string, text string, depth string, name string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA)


def brute(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, trie_order(r, x), r or "", x or ""))
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = sorted(turns.get(c - int(c - 5 * int(c / 5)), []))
        rebuilt[c] = tuple(t[3:] for t in base[:h] + sorted(own)[h:])
    members, ends, children, leaves, saved = defaultdict(list), defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
        ends[s].append(c)
    for n in members:
        if n:
            children[n[:-1]] += 1
    for n, m in members.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(m) - 1) * (len(n[-1][1].encode()) if n else 0)
            leaves[n[:d]] += not children[n]
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def trie_order(role, text):
    r, x = role or "", text or ""
    return hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()[:32], len(x.encode())


def nodes(spark, rows):
    out = trie.prefix_trie(trie.rebuild(trie.turns_of(frame(spark, rows)), 5, 9))
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in out.collect())


def some_rows():
    rng = random.Random(5)
    rows = [(None, 0, "user", "nobody's"), (7, None, None, None), (7, 3, "user", ""), (8, 0, "user", "é" * 9), (8, 0, "user", "é" * 9),
            (-3, 0, "user", "a"), (-3, 1, "assistant", "b"), (12, 0, "", "a"), (13, 0, "a", ""), (14, 0, "user", "x" * 100_000)]
    rows += [(99, t, "user", f"turn {t}") for t in range(400)]
    for c in range(100, 400):  # a third begin with the same turn, 60 are copies
        n = rng.randint(1, 6)
        rows += [(c, t, "user", "first" if t == 0 and c % 3 else str(rng.randint(0, 2))) for t in range(n)]
    return rows + [(c, t, "user", f"copy {t}") for c in range(400, 460) for t in range(3)]


@pytest.mark.parametrize("shard_bytes", [trie.SHARD_BYTES, 500])
def test_equals_brute_force(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(trie, "SHARD_BYTES", shard_bytes)  # 500: many shards, so that paths are open
    rows = some_rows()
    random.Random(1).shuffle(rows)
    got, expected = nodes(spark, rows), brute(rows)
    assert [tuple(-1 if x is None else x for x in r) for r in got] == [tuple(-1 if x is None else x for x in r) for r in expected]


def test_empty_tables_and_turnless_conversations(spark):
    assert nodes(spark, []) == [] and nodes(spark, [(None, 1, "user", "x")]) == []
    alone = next(c for c in range(6, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    assert nodes(spark, [(alone, 0, "user", "x")]) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_blocks_of_one_node(spark):
    ids = list(range(-5, 10_000))
    import pyarrow as pa
    batches = [pa.record_batch([pa.array([b"n"] * len(p)), pa.array(p)], ["name", "conv_id"]) for p in (ids[:6000], ids[6000:])]
    hashed = [r for b in trie._hashed(trie._blocks(iter(batches))) for r in b.to_pylist()]
    assert hashed == [{"name": b"n", "ends_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()}]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.binary(max_size=6), max_size=80))
def test_radix_tree_keeps_its_keys_in_order(keys):
    tree = RadixTree()
    for k in keys:
        tree.insert(k, k)
    here, found = bytearray(), []
    for at, own, value, _ in tree.walk():
        del here[at:]
        here += own
        if value is not None:
            assert bytes(here) == value
            found.append(value)
    assert found == sorted(keys)


def test_layouts_grow():
    tree = RadixTree()
    sizes = []
    for b in random.Random(2).sample(range(256), 256):
        tree.insert(b"shared" + bytes([b]) + b"rest", b)
        sizes.append(tree.root.size)
    assert sorted(set(sizes[1:])) == sorted(LAYOUTS) and tree.root.prefix == b"shared"
    assert [b for b, _ in tree.root.items()] == list(range(256))
