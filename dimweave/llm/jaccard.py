"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document's set holds its distinct word shingles (64-bit hashes); two sets link when
100 * intersection >= ``PERCENT`` * union.  Equal sets are one node.

1. Inverted-list lengths: chunks of documents send their distinct shingles to buckets, which
   answer how many sets hold each.  Rare shingles come first in one order for all.
2. A linked partner shares at least T = ceil(PERCENT * n / 100) of a set's n shingles, so it is
   in one of the n - T + 1 shortest lists.  Only those lists are made, and only where more than
   one set is in them.  Sets that meet in a list (with sizes that allow a link) form a block.
3. In a block every set is a query against the others: its short lists are merged and their
   occurrences counted, and sets that reach T - L of them are probed by binary search in the L
   long lists (DivideSkip), up to the exact overlap.  Sets already known to be connected aren't
   searched again; the links found are a spanning forest, so dense groups give no pairs.
4. Connected components of the links.

Blocks of ordinary size share tasks.  A block of more than ``BLOCK`` shingles is cut into parts,
and each pair of parts is a task of its own, so none holds more than two parts, and no pair of
sets is left out.  The merge of the short lists is one counted numpy merge instead of a heap.

Cases: null and empty texts, or texts without words, have the empty set and link with nothing;
texts of fewer words than a shingle have one shingle, the whole sequence; repeated rows are
equal sets; documents with a null id link but never name a component, which is null where all
its ids are; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm import packed
from dimweave.llm.components import components
from dimweave.llm.packed import Chunk, squeeze, squeeze_sorted, unsqueeze, unsqueeze_sorted
from dimweave.llm.words import LOWER, mix, words_of

SHINGLE, PERCENT = 5, 80
#: Shingles that a task searches at once, in the blocks of a task or a pair of parts.
BLOCK = 2_000_000
BUCKET_ENTRIES = 1_000_000
#: Bits of the hashes that lists are counted by; a shared hash only makes a list look longer.
COUNT_BITS = 44
#: The weight of a probe against a merge step in the choice of L.
PROBE = 0.0085
ROWS = "kind int, bucket long, chunk long, node long, n long, doc_id long, blob binary"
ROWS_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("node", pa.int64()),
                         ("n", pa.int64()), ("doc_id", pa.int64()), ("blob", pa.binary())])
POSTS, SET, MEMBER = 0, 1, 2


@dataclass
class Sets:
    """A chunk's sets: ``shingle`` sorted within each ``doc``, ``n`` and ``node`` for each
    document, and ``lead``: the first document of each non-empty node."""

    doc: np.ndarray
    shingle: np.ndarray
    n: np.ndarray
    node: np.ndarray
    lead: np.ndarray


def sets_of(chunk: Chunk) -> Sets:
    words = words_of(LOWER[chunk.buffer], chunk.bounds)
    h = words.hashes()
    docs = len(chunk.ids)
    size = np.diff(words.first)
    whole = np.ones(len(h), bool)  # where a shingle begins
    if len(h):
        whole = np.arange(len(h)) <= words.first[words.text + 1] - SHINGLE
    shingle = mix(packed.roll(h, SHINGLE))
    for few in range(1, SHINGLE):
        first = words.first[:-1][size == few]
        shingle[first] = mix(packed.roll(h, few)[first] ^ np.uint64(few))
        whole[first] = True
    doc, shingle = words.text[whole], shingle[whole]
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    doc, shingle = doc[new], shingle[new]
    n = np.bincount(doc, minlength=docs)
    node = np.zeros(docs, np.uint64)
    np.add.at(node, doc, mix(shingle ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    node = mix(node ^ (n.astype(np.uint64) << np.uint64(40)))
    some = np.flatnonzero(n)
    _, first = np.unique(node[some], return_index=True)
    return Sets(doc, shingle, n, node, some[np.sort(first)])


def _leading(s: Sets) -> np.ndarray:
    lead = np.zeros(len(s.n), bool)
    lead[s.lead] = True
    return lead[s.doc]


def _keys(shingle: np.ndarray) -> np.ndarray:
    return shingle & ~np.uint64((1 << (64 - COUNT_BITS)) - 1)


def _ask(buckets: int):
    def run(chunk: Chunk) -> Iterator[dict]:
        s = sets_of(chunk)
        keys, count = np.unique(_keys(s.shingle[_leading(s)]), return_counts=True)
        for bucket, a, b in packed.by_bucket(keys, buckets):
            yield {"bucket": bucket, "chunk": chunk.name, "blob": squeeze_sorted(keys[a:b], count[a:b].astype(np.uint16))}

    return run


def _lengths(_: int, blobs: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    asked = [unsqueeze_sorted(b) for _, b in blobs]
    _, place = np.unique(np.concatenate([k for k, _ in asked]), return_inverse=True)
    total = np.bincount(place, np.concatenate([n for _, n in asked]))
    length = np.minimum(total, 65_535).astype(np.uint16)[place]
    at = 0
    for (chunk, _), (k, _) in zip(blobs, asked):
        yield chunk, squeeze(length[at:at + len(k)])
        at += len(k)


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """The shingles that a partner of a set of n must share with it."""
    return -(-percent * n // 100)


def _posts(percent: int, buckets: int):
    """Members, the posts of short lists, and the sets that have posts."""
    def run(chunk: Chunk, got: list[tuple[int, bytes]]) -> pa.Table:
        s = sets_of(chunk)
        own = _leading(s)
        doc, shingle = s.doc[own], s.shingle[own]
        keys, place = np.unique(_keys(shingle), return_inverse=True)
        length = np.concatenate([unsqueeze(b)[0] for _, b in got])[place] if got else np.zeros(0, np.uint16)
        order = np.lexsort((shingle, length, doc))  # each set's shingles, rarest first
        begin = np.searchsorted(doc, np.arange(len(s.n)))
        rank = np.arange(len(doc)) - begin[doc]
        short = (rank < (s.n - least_overlap(s.n, percent) + 1)[doc]) & (length[order] > 1)
        token, of = shingle[order][short], doc[short]
        out = [{"kind": MEMBER, "node": int(x), "n": int(n), "doc_id": i} for x, n, i in zip(
            s.node.view(np.int64), s.n, chunk.doc_ids().to_pylist())]
        live = np.unique(of)
        end = np.searchsorted(doc, live, side="right")
        out += [{"kind": SET, "node": int(s.node.view(np.int64)[d]), "n": int(s.n[d]), "blob": squeeze_sorted(shingle[a:b])}
                for d, a, b in zip(live.tolist(), begin[live].tolist(), end.tolist())]
        by = np.argsort(token, kind="stable")
        token, of = token[by], of[by]
        for bucket, a, b in packed.by_bucket(token, buckets):
            out.append({"kind": POSTS, "bucket": bucket, "chunk": chunk.name, "blob": squeeze_sorted(
                token[a:b], s.node[of[a:b]], s.n[of[a:b]].astype(np.uint32))})
        return pa.Table.from_pylist(out, ROWS_SCHEMA)

    return run


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links -> (node, smallest node of its component), without the roots themselves."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    label = np.arange(len(names))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    child = label != np.arange(len(names))
    return names[child], names[label[child]]


def _meet(percent: int):
    """The lists of a bucket -> links between sets that share a list and may link by size."""
    def run(table: pa.Table) -> pa.Table:
        parts = [unsqueeze_sorted(b) for b in table["blob"].to_pylist()]
        token, node, n = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((node, n, token))
        token, node, n = token[order], node[order].view(np.int64), n[order].astype(np.int64)
        # sizes ascend within a list: two sets that fit are connected by the steps between them
        step = (token[1:] == token[:-1]) & (node[1:] != node[:-1]) & (100 * n[:-1] >= percent * n[1:])
        a, b = forest(node[:-1][step], node[1:][step])
        return pa.table({"a": a, "b": b})

    return run


class Search:
    """T-occurrence search among sets of one task."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.n = np.array([len(x) for x in sets], np.int64)
        shingle, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.n)
        order = np.argsort(shingle, kind="stable")  # owners ascend within a list
        shingle, owner = shingle[order], owner[order]
        new = np.ones(len(shingle), bool)
        new[1:] = shingle[1:] != shingle[:-1]
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, len(shingle)))
        self.owner, self.start, self.length = owner, start, length
        # each set's lists
        which = np.empty(len(shingle), np.int64)
        which[order] = np.cumsum(new) - 1
        self.lists = np.split(which, np.cumsum(self.n)[:-1])

    def partners(self, q: int, known: np.ndarray) -> np.ndarray:
        """The later sets that link with q and aren't in ``known`` (a mask)."""
        own = self.lists[q]
        own = own[self.length[own] > 1]
        own = own[np.argsort(self.length[own], kind="stable")]
        t = int(least_overlap(self.n[q], self.percent))
        if len(own) < t:
            return np.zeros(0, np.int64)
        skip = min(t - 1, int(t / (PROBE * np.log2(max(self.length[own[-1]], 2)) + 1)))
        cut = len(own) - skip
        lists = [self.owner[a:a + n] for a, n in zip(self.start[own].tolist(), self.length[own].tolist())]
        lists = [x[np.searchsorted(x, q, side="right"):] for x in lists]  # each pair once
        short = np.concatenate(lists[:cut])
        found, count = np.unique(short, return_counts=True)
        keep = (count >= t - skip) & ~known[found]
        found, count = found[keep], count[keep]
        # 100 * i >= percent * (n + m - i)  <=>  i >= percent * (n + m) / (100 + percent)
        need = -(-self.percent * (self.n[q] + self.n[found]) // (100 + self.percent))
        for left, x in zip(range(skip, 0, -1), lists[cut:]):
            alive = count + left >= need
            found, count, need = found[alive], count[alive], need[alive]
            if not len(found):
                break
            at = np.searchsorted(x, found)
            count += x[np.minimum(at, len(x) - 1)] == found if len(x) else 0
        return found[count >= need]


def links_of(nodes: np.ndarray, sets: list[np.ndarray], part: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among sets; where there are two parts, only links between
    them are looked for."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), nodes[i]))
    nodes, part = nodes[order], part[order]
    search = Search([sets[i] for i in order], percent)
    root = np.arange(len(order))
    two = part.min() != part.max()
    a, b = [], []
    for q in range(len(order)):
        known = root == root[q]
        if two:
            known = known | (part == part[q])
        for r in search.partners(q, known).tolist():
            if root[r] != root[q]:
                a.append(nodes[q])
                b.append(nodes[r])
                root[root == root[r]] = root[q]
    return np.array(a, np.int64), np.array(b, np.int64)


def _link(percent: int):
    def run(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        _, first = np.unique(node, return_index=True)
        blobs = table["blob"].take(pa.array(first)).to_pylist()
        a, b = links_of(node[first], [unsqueeze_sorted(x)[0] for x in blobs], table["part"].to_numpy()[first], percent)
        a, b = forest(a, b)  # as stars: where a task holds whole blocks, no round is left
        return pa.table({"a": a, "b": b})

    return run


def similar_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT,
                      block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles (size of the set) and component_id (smallest id that links reach)."""
    chunks = packed.pack(docs, doc_id=doc_id, text=text)
    total = packed.total_bytes(chunks)
    buckets = 1 + total // (6 * BUCKET_ENTRIES)
    sent = chunks.mapInArrow(packed.each_chunk(_ask(buckets), packed.BLOB_SCHEMA), packed.BLOB)
    lengths = packed.in_buckets(sent, _lengths)
    rows = packed.with_answers(chunks, lengths, _posts(percent, buckets), ROWS).checkpoint()
    meet = rows.filter(F.col("kind") == POSTS).select("bucket", "blob").groupBy("bucket").applyInArrow(_meet(percent), "a long, b long")
    blocks = components(meet).withColumnRenamed("root", "block")

    sets = rows.filter(F.col("kind") == SET).select("node", "n", "blob")
    held = sets.join(blocks, "node")
    sizes = (rows.filter(F.col("kind") == SET).select("node", "n").distinct().join(blocks, "node")
             .groupBy("block").agg(F.sum("n").alias("size")).checkpoint())
    bins = 1 + (sizes.agg(F.sum("size").alias("s")).collect()[0]["s"] or 0) // block
    # large blocks by pairs of parts, the others by bin
    big = sizes.filter(F.col("size") > block).select("block", F.ceil(2 * F.col("size") / block).cast("int").alias("k"))
    held = held.join(big, "block", "left")
    part = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    pairs = F.when(F.col("k").isNull(), F.array(F.struct(F.pmod(F.xxhash64("block"), F.lit(bins)).alias("x"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))))
    pairs = pairs.otherwise(F.transform(F.sequence(F.lit(0), F.coalesce("k", F.lit(1)) - 1), lambda o: F.struct(
        F.col("block").alias("x"), F.least(o, part).alias("i"), F.greatest(o, part).alias("j"))))
    dealt = held.select("node", "blob", F.coalesce(part, F.lit(0)).alias("part"), F.explode(pairs).alias("p")).select(
        "p.*", "node", "blob", "part")
    links = dealt.groupBy("x", "i", "j").applyInArrow(_link(percent), "a long, b long")
    found = components(links)

    members = rows.filter(F.col("kind") == MEMBER).select("doc_id", "node", F.col("n").alias("n_shingles"))
    linked = members.filter("n_shingles > 0").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    name = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (linked.join(name, "root").select("doc_id", "n_shingles", "component_id")
            .union(members.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))
