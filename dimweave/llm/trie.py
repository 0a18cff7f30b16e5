"""The prefix trie of conversations: which of them share their first turns.

1. A turn becomes a fixed-width id of ``WIDTH`` bytes: 16 of the SHA-256 of its role and text,
   then the text's number of bytes, big-endian.  A conversation is the string of its turns' ids,
   and equal conversations are one string with a count, so copies combine before they move.
2. The strings are dealt to shards by range, so that a first turn which a third of all
   conversations share is spread over as many shards as its conversations need.  Every shard puts
   its strings into an adaptive radix tree; the tree's nodes lie at any byte, but only depths that
   are a whole number of turns are nodes of the trie.
3. A node that is no prefix of its shard's first or last string lies in that shard alone and is
   finished there.  The others, at most two paths for each shard, are open: their counts are
   added up by name, and the sums over subtrees run up the open paths by pointer doubling.
4. The ids of the conversations that end at a node are hashed in order: blocks of sorted ids
   first, then the blocks of each node, both as streams, so that no task holds a node's ids.

Cases: a null role or text counts as empty; turns are ordered by turn, null first, and equal
turns by their id; rows without a conv_id belong to no conversation and don't count; repeated
rows are further turns; conversations without turns (as ``rebuild`` may leave them) end at the
root; an empty table gives an empty result; other columns don't matter.  One conversation's ids
(20 bytes a turn) must fit into a row; its texts needn't.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.radix import RadixTree
from dimweave.session import ensure_checkpoint_dir

WIDTH = 20
SHARD_BYTES = 8 << 20
#: Ids that one block of a node's ends holds at most.
BLOCK_IDS = 4_096
NODE = ("name binary, parent binary, depth long, bytes long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, open boolean")
FIELDS = [("name", pa.binary()), ("parent", pa.binary()), *((c, pa.int64()) for c in (
    "depth", "bytes", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("open", pa.bool_())]
OUT_ROWS = 10_000


def turn_id(role: Column, text: Column) -> Column:
    """The id as hexadecimal digits."""
    r, t = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    named = F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t)
    return F.concat(F.left(F.sha2(named.cast("binary"), 256), F.lit(32)), F.lpad(F.hex(F.octet_length(t)), 8, "0"))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids): the ids of each conversation's turns in order."""
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), turn_id(F.col("role"), F.col("text")).alias("id"))
    return rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "id"))), lambda x: x["id"]).alias("ids"))


def rebuild(turns: DataFrame, groups: int, parts: int) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % groups (none where it
    is absent) in the place of its own first h; h = crc32(c as text) % parts."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % parts).cast("int")
    head = turns.select(F.col("conv_id").alias("base"), F.slice("ids", 1, parts).alias("head"))
    own = turns.withColumn("h", h).withColumn("of", F.col("conv_id") - F.col("conv_id") % groups)
    none = F.array().cast("array<string>")
    ids = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("ids", F.col("h") + 1, F.size("ids")))
    return own.join(head, own["of"] == head["base"], "left").select("conv_id", ids.alias("ids"))


def _name(digest) -> bytes:
    return digest.digest()[:16]


def _path_names(key: bytes) -> set[bytes]:
    h = hashlib.sha256()
    names = {_name(h)}
    for at in range(0, len(key), WIDTH):
        h.update(key[at:at + WIDTH])
        names.add(_name(h))
    return names


class _Open:
    """A node of the trie whose subtree is being walked."""

    __slots__ = ("digest", "name", "depth", "bytes", "open", "conv", "convs", "children", "leaves", "saved", "waiting", "leaf")

    def __init__(self, digest, depth: int, size: int, edge: set[bytes]):
        self.digest, self.name, self.depth, self.bytes = digest, _name(digest), depth, size
        self.open, self.conv = self.name in edge, None
        self.convs = self.children = self.leaves = self.saved = 0
        self.waiting: list[list] = []  # finished children, until this node's conv_id is known
        self.leaf = True

    def seen(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.convs += n


def trie_nodes(keys: list[bytes], convs: list[int], counts: list[int]) -> Iterator[list]:
    """The nodes (rows of NODE) of distinct strings of ids, each with the smallest of its
    conversations and their number."""
    tree = RadixTree()
    for key, conv, n in zip(keys, convs, counts):
        tree.insert(key, (conv, n))
    edge = _path_names(min(keys)) | _path_names(max(keys))
    path = [_Open(hashlib.sha256(), 0, 0, edge)]
    here = bytearray()

    def close() -> Iterator[list]:
        node = path.pop()
        above = path[-1] if path else None
        if not node.open:
            node.leaves += node.leaf
            node.saved += (node.convs - 1) * node.bytes
        row = [node.name, above.name if above else None, node.depth, node.bytes, node.conv, None, node.convs, node.children,
               node.leaves, node.saved, node.open]
        for child in node.waiting:
            child[5] = None if node.open else node.conv
            yield child
        if above is None:
            yield row
            return
        above.seen(node.conv, node.convs)
        above.leaf = False
        if not node.open:
            above.children, above.leaves, above.saved = above.children + 1, above.leaves + node.leaves, above.saved + node.saved
        above.waiting.append(row)

    for at, own, value, _ in tree.walk():
        while path[-1].depth * WIDTH > at:
            yield from close()
        del here[at:]
        here += own
        for depth in range(at // WIDTH + 1, len(here) // WIDTH + 1):
            turn = bytes(here[(depth - 1) * WIDTH:depth * WIDTH])
            digest = path[-1].digest.copy()
            digest.update(turn)
            path.append(_Open(digest, depth, int.from_bytes(turn[16:], "big"), edge))
        if value is not None:
            path[-1].seen(*value)
    while path:
        yield from close()


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns: tuple[list, ...] = ([], [], [])
    for batch in batches:
        for held, name in zip(columns, ("key", "conv_id", "n")):
            held += batch[name].to_pylist()
    if not columns[0]:
        return
    rows: list[list] = []
    for row in trie_nodes(*columns):
        rows.append(row)
        if len(rows) == OUT_ROWS:
            yield _batch(rows)
            rows = []
    yield _batch(rows)


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows) if rows else [[]] * len(FIELDS), FIELDS)],
                           pa.schema(FIELDS))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (name, conv_id) -> (name, first id, ids joined by commas), BLOCK_IDS at most."""
    name, ids = None, []
    out: list[tuple] = []
    batch = lambda rows: pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.int64(), pa.string()))],
                                         ["name", "first", "ids"])
    for b in batches:
        for n, c in zip(b["name"].to_pylist(), b["conv_id"].to_pylist()):
            if ids and (n != name or len(ids) == BLOCK_IDS):
                out.append((name, ids[0], ",".join(map(str, ids))))
                ids = []
            name = n
            ids.append(c)
        if len(out) > 1_000:
            yield batch(out)
            out = []
    if ids:
        out.append((name, ids[0], ",".join(map(str, ids))))
    if out:
        yield batch(out)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by (name, first) -> (name, SHA-256 of all its ids)."""
    name, h = None, None
    for b in batches:
        out = []
        for n, ids in zip(b["name"].to_pylist(), b["ids"].to_pylist()):
            if n == name:
                h.update(b"," + ids.encode())
                continue
            if h is not None:
                out.append((name, h.hexdigest()))
            name, h = n, hashlib.sha256(ids.encode())
        if out:
            yield pa.record_batch([pa.array(c) for c in zip(*out)], ["name", "ends_sha256"])
    if h is not None:
        yield pa.record_batch([pa.array([name]), pa.array([h.hexdigest()])], ["name", "ends_sha256"])


def _ends(sequences: DataFrame) -> DataFrame:
    """(name, ends_sha256) of each node where a conversation ends."""
    rows = sequences.select(F.unhex(F.left(F.sha2("key", 256), F.lit(32))).alias("name"), "conv_id")
    order = rows.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    blocks = order.mapInArrow(_blocks, "name binary, first long, ids string")
    return blocks.repartition("name").sortWithinPartitions("name", "first").mapInArrow(_hashed, "name binary, ends_sha256 string")


def _finish_open(parts: DataFrame) -> DataFrame:
    """The open nodes: counts added up by name, and the sums of all open nodes below them."""
    total = parts.groupBy("name").agg(
        F.min("parent").alias("parent"), F.max("depth").alias("depth"), F.max("bytes").alias("bytes"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))).checkpoint()
    below = total.groupBy(F.col("parent").alias("_name")).agg(F.count("*").alias("_open"))
    now = total.join(below, total["name"] == below["_name"], "left").drop("_name")
    now = now.withColumn("n_children", F.col("n_children") + F.coalesce("_open", F.lit(0))).drop("_open")
    now = now.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
    now = now.withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("bytes")).withColumn("up", F.col("parent"))
    deepest = total.agg(F.max("depth")).collect()[0][0] or 0
    now = now.checkpoint()
    for _ in range(deepest.bit_length()):  # what lies 1, 2, 4, .. levels below
        given = now.filter("up is not null").groupBy(F.col("up").alias("_to")).agg(
            F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
        further = now.select(F.col("name").alias("_at"), F.col("up").alias("_up"))
        now = now.join(given, now["name"] == given["_to"], "left").join(further, now["up"] == further["_at"], "left")
        now = now.withColumn("n_leaves", F.col("n_leaves") + F.coalesce("_leaves", F.lit(0)))
        now = now.withColumn("saved_tokens", F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).withColumn("up", F.col("_up"))
        now = now.drop("_to", "_leaves", "_saved", "_at", "_up").checkpoint()
    return now.drop("up")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each node of the trie over ``turns`` (conv_id, ids): name (of the node), parent,
    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256."""
    ensure_checkpoint_dir(turns.sparkSession)
    sequences = turns.select("conv_id", F.unhex(F.array_join("ids", "")).alias("key")).checkpoint()
    distinct = sequences.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).checkpoint()
    size = distinct.agg(F.sum(F.length("key") + 16).alias("n")).collect()[0]["n"] or 0
    shards = distinct.repartitionByRange(-(-size // SHARD_BYTES) or 1, "key")
    built = shards.select("key", "conv_id", "n").mapInArrow(_shard, NODE).checkpoint()
    opened = _finish_open(built.filter("open"))
    known = opened.select(F.col("name").alias("_up"), F.col("conv_id").alias("_up_conv"))
    columns = ["name", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    closed = built.filter("not open").select(columns)
    inside = closed.filter("parent_conv_id is not null")
    under = closed.filter("parent_conv_id is null").unionByName(opened.withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns))
    under = under.join(known, under["parent"] == known["_up"], "left").withColumn("parent_conv_id", F.col("_up_conv")).select(columns)
    ends = _ends(sequences)
    nodes = inside.unionByName(under)
    nodes = nodes.join(ends.withColumnRenamed("name", "_end"), nodes["name"] == F.col("_end"), "left").drop("_end")
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
