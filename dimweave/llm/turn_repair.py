"""Repair of conversations by the cheapest edits, with an audit of them.

A conversation is right when its roles' initials read ``(s?(ua)+)?``.  Its turns may be kept (K,
cost 0), given the role user or assistant (R, 2) or deleted (D, 3); an empty turn of either role
may be inserted anywhere (I, 2); a truncated turn that stays adds 1, and blank or duplicate
turns must go.  The audit is the edits' initials in order; of equally cheap audits the one that
comes first in ASCII order is taken.

The programme runs over the turns with the cheapest audit for each of four states (nothing yet,
after a system, user or assistant turn).  Audits are persistent: an audit is a node that names
the one before its last edit, so audits share their beginnings.  A node holds its ancestors at
distances 1, 2, 4, .. and a hash of its whole audit; two equally cheap audits are compared by
searching their longest common prefix with these, and a prefix whose hash is equal is
verified edit by edit unless it is the same node.

Rows are sorted within partitions and streamed, a conversation at a time.  As soon as the
audits of all states share a beginning it is settled: its edits and the turns that they leave are
written, and forgotten.  So a task holds, of a conversation of any length, the unsettled turns
and 16 bytes for each distinct turn.

Cases: nulls count as one space (a null conv_id is one conversation); turns are ordered by
number, null first, then role and text; repeated rows are duplicates; very long conversations
come in several parts; a conversation of which no turn is left has empty audit and turns; an
empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = b"KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: By state: the state that a role's initial leads to.
STEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: By state: the role that an inserted or changed turn gets there.
GIVEN = ("user", "user", "assistant", "user")
ACCEPTED = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"
END = ".!?"
#: Nodes after which a shared beginning is looked for, and turns that one part holds at least.
SETTLE_NODES, PART_TURNS = 65_536, 8_192
PRIME, FACTOR = (1 << 61) - 1, 1_000_003
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
PARTS = ("conv_id long, part long, last boolean, " + ", ".join(f"{c} long" for c in COUNTS)
         + ", audit string, repaired array<struct<role:string,text:string>>")
PART_SCHEMA = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("last", pa.bool_()), *((c, pa.int64()) for c in COUNTS),
                         ("audit", pa.string()), ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


class Audits:
    """Persistent strings of edits; node 0 is the empty one."""

    def __init__(self) -> None:
        self.edit, self.depth, self.hash = bytearray(1), [0], [0]
        self.up: list[list[int]] = [[]]

    def add(self, node: int, edit: int) -> int:
        ancestors, k = [node], 0
        while k < len(self.up[ancestors[k]]):
            ancestors.append(self.up[ancestors[k]][k])
            k += 1
        self.edit.append(edit)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * FACTOR + edit) % PRIME)
        self.up.append(ancestors)
        return len(self.edit) - 1

    def ancestor(self, node: int, depth: int) -> int:
        far = self.depth[node] - depth
        k = 0
        while far:
            if far & 1:
                node = self.up[node][k]
            far >>= 1
            k += 1
        return node

    def text(self, node: int, below: int = 0) -> bytes:
        """The edits of a node, without those of its ancestor ``below``."""
        out = bytearray()
        while node != below:
            out.append(self.edit[node])
            node = self.up[node][0]
        return bytes(reversed(out))

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth and hash hold the same edits."""
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def before(self, a: int, x: int, b: int, y: int) -> bool:
        """Whether the edits of ``a`` and then x come before those of ``b`` and then y."""
        if a == b:
            return x < y
        shared = min(self.depth[a], self.depth[b])
        p, q = self.ancestor(a, shared), self.ancestor(b, shared)
        if self.hash[p] == self.hash[q]:
            if not self.same(p, q):
                return self.text(a) + bytes([x]) < self.text(b) + bytes([y])
            rest_a, rest_b = self.text(a, p) + bytes([x]), self.text(b, q) + bytes([y])
            return rest_a < rest_b
        for k in reversed(range(len(self.up[p]))):  # to the first nodes that differ
            if k < len(self.up[p]) and self.hash[self.up[p][k]] != self.hash[self.up[q][k]]:
                p, q = self.up[p][k], self.up[q][k]
        if not self.same(self.up[p][0], self.up[q][0]):
            return self.text(a) + bytes([x]) < self.text(b) + bytes([y])
        return self.edit[p] < self.edit[q]

    def shared(self, nodes: list[int]) -> int:
        """The deepest common ancestor."""
        first = nodes[0]
        for node in nodes[1:]:
            depth = min(self.depth[first], self.depth[node])
            a, b = self.ancestor(first, depth), self.ancestor(node, depth)
            for k in reversed(range(len(self.up[a]))):
                if k < len(self.up[a]) and self.up[a][k] != self.up[b][k]:
                    a, b = self.up[a][k], self.up[b][k]
            first = a if a == b else self.up[a][0]
        return first

    def cut(self, root: int, nodes: list[int]) -> tuple[Audits, list[int]]:
        """What the nodes hold after their ancestor ``root``, as audits of their own."""
        out, place, moved = Audits(), {root: 0}, []
        for node in nodes:
            way = []
            while node not in place:
                way.append(node)
                node = self.up[node][0]
            for step in reversed(way):
                place[step] = out.add(place[node], self.edit[step])
                node = step
            moved.append(place[node])
        return out, moved


class Conversation:
    """Takes the turns of one conversation in order, and gives its parts."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.parts = conv_id, 0
        self.count = dict.fromkeys(COUNTS, 0)
        self.low = self.high = self.turn = None
        self.turns, self.initial = 0, None
        self.seen: set[bytes] = set()
        self.audits, self.limit = Audits(), SETTLE_NODES
        self.best: list[tuple[int, int] | None] = [(0, 0), None, None, None]  # by state: cost, node
        self.waiting: deque[tuple[str, str]] = deque()  # turns whose edit isn't settled
        self.state, self.done, self.repaired = START, bytearray(), []

    def _least(self, found: list[tuple[int, int, int]]) -> tuple[int, int] | None:
        """Of (cost, node, edit) the cheapest, then first in order, as (cost, new node)."""
        best = None
        for one in found:
            if best is None or one[0] < best[0] or (one[0] == best[0] and self.audits.before(one[1], one[2], best[1], best[2])):
                best = one
        return best and (best[0], self.audits.add(best[1], best[2]))

    def _insert(self) -> None:
        """Empty turns: a user turn into any state that takes one, then an assistant turn."""
        for sources, target in (((START, SYSTEM, ASSISTANT), USER), ((USER,), ASSISTANT)):
            found = [(c + INSERT_COST, node, INSERT) for c, node in filter(None, (self.best[p] for p in sources))]
            if own := self.best[target]:
                found = [f for f in found if f[0] < own[0] or (f[0] == own[0] and self._first(f, own[1]))]
            if found:
                self.best[target] = self._least(found)

    def _forget(self) -> None:
        """Drops states that no cheapest audit can pass: whatever follows there can follow after an
        assistant turn too, where at most a system turn more must be deleted."""
        if after := self.best[ASSISTANT]:
            for p, more in ((START, DELETE_COST), (SYSTEM, 0)):
                if self.best[p] and self.best[p][0] > after[0] + more:
                    self.best[p] = None

    def _first(self, one: tuple[int, int, int], node: int) -> bool:
        return self.audits.before(one[1], one[2], self.audits.up[node][0], self.audits.edit[node]) if node else False

    def add(self, turn: int | None, role: str, text: str) -> Iterator[dict]:
        self.turns += 1
        if turn is not None:
            if turn != self.turn:
                self.count["gaps"] -= 1  # one more distinct number
                self.turn = turn
            self.low = turn if self.low is None else min(self.low, turn)
            self.high = turn if self.high is None else max(self.high, turn)
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.count["illegal"] += 1
        self.initial = role[:1]
        digest = hashlib.blake2b(f"{len(role)}:{role}".encode() + text.encode(), digest_size=16).digest()
        inside = text.rstrip(WHITE)
        bad = "blank" if not inside else "duplicate" if digest in self.seen else None
        self.seen.add(digest)
        more = 0
        if bad or inside[-1] not in END:
            self.count[bad or "truncated"] += 1
            more = TRUNCATED_COST
        self._insert()
        self._forget()
        found: list[list[tuple[int, int, int]]] = [[], [], [], []]
        for p, own in enumerate(self.best):
            if own is None:
                continue
            cost, node = own
            found[p].append((cost + DELETE_COST, node, DELETE))
            if not bad:
                q = STEPS[p].get(role[:1])
                if q is not None:
                    found[q].append((cost + more, node, KEEP))
                found[STEPS[p][GIVEN[p][0]]].append((cost + REROLE_COST + more, node, REROLE))
        self.best = [self._least(f) for f in found]
        self.waiting.append((role, text))
        if len(self.audits.edit) > self.limit:
            yield from self._settle()

    def _write(self, edits: bytes) -> None:
        for edit in edits:
            role, text = self.waiting.popleft() if edit != INSERT else ("", "")
            if edit == DELETE:
                continue
            if edit != KEEP:
                role = GIVEN[self.state]
            self.state = STEPS[self.state][role[:1]]
            self.repaired.append({"role": role, "text": text})
        self.done += edits

    def _settle(self) -> Iterator[dict]:
        live = [own for own in self.best if own]
        root = self.audits.shared([node for _, node in live])
        self._write(self.audits.text(root))
        self.audits, moved = self.audits.cut(root, [node for _, node in live])
        cut = iter(moved)
        self.best = [own and (own[0], next(cut)) for own in self.best]
        self.limit = max(SETTLE_NODES, 2 * len(self.audits.edit))
        if len(self.done) >= PART_TURNS:
            yield self._part(False)

    def _part(self, last: bool) -> dict:
        out = {"conv_id": self.conv_id, "part": self.parts, "last": last, **self.count, "audit": self.done.decode(),
               "repaired": self.repaired}
        self.parts += 1
        self.done, self.repaired = bytearray(), []
        return out

    def finish(self) -> dict:
        self._insert()
        ends = [own for own in (self.best[p] for p in ACCEPTED) if own]
        cost, node = ends[0]
        for c, other in ends[1:]:
            if c < cost or (c == cost and self.audits.text(other) < self.audits.text(node)):
                cost, node = c, other
        self._write(self.audits.text(node))
        self.count["cost"] = cost
        if self.low is not None:
            self.count["gaps"] += self.high - self.low + 1
        return self._part(True)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: Conversation | None = None
    out: list[dict] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(out, PART_SCHEMA)

    for rows in batches:
        for conv_id, turn, role, text in zip(*(rows[c].to_pylist() for c in ("conv_id", "turn", "role", "text"))):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    out.append(now.finish())
                now = Conversation(conv_id)
            if text is not None:
                out += now.add(turn, role, text)
                size += len(text)
            if size > 4 << 20 and out:
                yield batch()
                out, size = [], 0
    if now is not None:
        out.append(now.finish())
    if out:
        yield batch()


def damage(conversations: DataFrame) -> DataFrame:
    """The rows as they are after the damage that crc32(`conv_id:turn`) % 20 decides; those that
    it drops keep their conv_id, without a text."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")) % 20
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .when(F.col("kind") != 0, F.col("text")))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                written("role").alias("role"), written("text").alias("text"), kind.alias("kind"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("_copy"))
    return rows.drop("_copy")


def repair(rows: DataFrame) -> DataFrame:
    """PARTS for ``rows`` (conv_id, turn, role, text; a null text: no turn).  The parts of a
    conversation follow each other in one partition: audit and repaired hold what each part
    settles, and the counts and the cost are those of the last one."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    return (rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(*order)
            .mapInArrow(_repair, PARTS))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    h, audit, begun = hashlib.sha256(), [], False
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            for turn in row["repaired"]:
                h.update((("\n" if begun else "") + f"{turn['role']}:{turn['text']}").encode())
                begun = True
            audit.append(row["audit"])
            if row["last"]:
                out.append((row["conv_id"], *(row[c] for c in COUNTS), "".join(audit), h.hexdigest()))
                h, audit, begun = hashlib.sha256(), [], False
        kinds = [pa.int64()] * (1 + len(COUNTS)) + [pa.string()] * 2
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(names), kinds)], names)


def digest(parts: DataFrame) -> DataFrame:
    """One row for each conversation: its counts, whole audit, and the SHA-256 of its repaired
    turns (``role:text``, joined by line feeds).  Reads the parts as ``repair`` gives them."""
    return parts.mapInArrow(_digest, "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")
