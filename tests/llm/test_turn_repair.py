import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

from hypothesis import given, settings
from hypothesis import strategies as st

from dimweave.llm import turn_repair
from dimweave.llm.turn_repair import Audits, Conversation

STEPS = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ROLE = {"u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit string"


def brute(turns):
    """Faults, the cheapest audit and the repaired turns, by trying every edit."""
    seen, faults = set(), []
    for _, role, text in turns:
        inside = text.rstrip(WHITE)
        faults.append("b" if not inside else "d" if (role, text) in seen else "" if inside[-1] in ".!?" else "t")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, p, inserted):
        found = [(0, "", ())] if i == len(turns) and p in (0, 3) else []

        def offer(cost, edit, out, rest):
            if rest:
                found.append((cost + rest[0], edit + rest[1], out + rest[2]))

        if inserted < 2:
            for s in STEPS[p].keys() & {"u", "a"}:
                offer(2, "I", ((ROLE[s], ""),), best(i, STEPS[p][s], inserted + 1))
        if i < len(turns):
            _, role, text = turns[i]
            offer(3, "D", (), best(i + 1, p, 0))
            if faults[i] not in ("b", "d"):
                late = int(faults[i] == "t")
                if role[:1] in STEPS[p]:
                    offer(late, "K", ((role, text),), best(i + 1, STEPS[p][role[:1]], 0))
                for s in STEPS[p].keys() & {"u", "a"}:
                    offer(2 + late, "R", ((ROLE[s], text),), best(i + 1, STEPS[p][s], 0))
        return min(found, key=lambda x: x[:2]) if found else None

    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return (gaps, *(faults.count(k) for k in "bdt"), illegal, *best(0, 0, 0))


def run(turns):
    c, parts = Conversation(1), []
    for t in turns:
        parts += c.add(*t)
    parts.append(c.finish())
    last = parts[-1]
    return (*(last[k] for k in turn_repair.COUNTS), "".join(p["audit"] for p in parts),
            tuple((t["role"], t["text"]) for p in parts for t in p["repaired"])), parts


turns = st.lists(st.tuples(st.sampled_from([None, 0, 1, 2, 5]), st.sampled_from(["user", "assistant", "system", "", " ", "unknown", "tool"]),
                           st.sampled_from(["a.", "b!", "c", "", " \n", "d? ", "é", "e."])), max_size=9)


@settings(max_examples=400, deadline=None)
@given(turns)
def test_equals_brute_force(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    assert run(rows)[0] == brute(rows)


@settings(max_examples=150, deadline=None)
@given(turns, st.integers(2, 30))
def test_settled_beginnings_change_nothing(rows, limit):
    old = turn_repair.SETTLE_NODES, turn_repair.PART_TURNS
    whole = run(rows)[0]
    turn_repair.SETTLE_NODES, turn_repair.PART_TURNS = limit, 1
    try:
        assert run(rows)[0] == whole
    finally:
        turn_repair.SETTLE_NODES, turn_repair.PART_TURNS = old


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.sampled_from(b"DIKR")), min_size=1, max_size=40), st.booleans())
def test_audits_compare_like_strings(edits, colliding):
    audits = Audits()
    for of, edit in edits:
        audits.add(of % len(audits.edit), edit)
    if colliding:  # every hash alike: only the verification tells audits apart
        audits.hash = [0] * len(audits.hash)
    for a in range(len(audits.edit)):
        for b in range(len(audits.edit)):
            for x, y in (b"DK", b"RI", b"KK"):
                assert audits.before(a, x, b, y) == (audits.text(a) + bytes([x]) < audits.text(b) + bytes([y]))


def test_a_long_conversation_comes_in_parts_and_is_forgotten():
    rows = [(i, "user" if i % 2 == 0 else "assistant", f"turn {i}" + ("." if i % 7 else "")) for i in range(60_000)]
    got, parts = run(rows)
    assert len(parts) >= 3 and len(got[6]) >= len(rows) and set(got[6]) <= set("KRDI") and got[5] == sum(i % 7 == 0 for i in range(60_000))


def test_query_rows_with_awkward_values(spark):
    rng = random.Random(3)
    rows = [(None, 0, "user", "x."), (None, None, None, None), (5, None, None, "a."), (5, None, "user", None), (6, 1, "user", "long " * 50_000)]
    rows += [(c, rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(["user", "assistant", "system", None]), rng.choice(["a.", "b", "", None, "c!"]))
             for c in range(10, 60) for _ in range(rng.randint(1, 7))]
    rows += [(77, 0, "user", "same.")] * 300
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    expected = defaultdict(list)
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        expected[c] += [(t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    df = spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA)
    got = turn_repair.digest(turn_repair.repair(turn_repair.damage(df))).collect()
    assert len(got) == len(expected)
    for r in got:
        own = sorted(expected[r.conv_id], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        *counts, audit, out = brute(own[:40]) if r.conv_id == 77 else brute(own)
        if r.conv_id == 77:  # one turn 300 times (or 600): all but the first are duplicates
            assert r.duplicate == len(own) - 1 and r.audit == "K" + "D" * (len(own) - 1) + "I"
            continue
        text = "\n".join(f"{a}:{b}" for a, b in out)
        assert tuple(r)[1:] == (*counts, audit, hashlib.sha256(text.encode()).hexdigest())
    empty = next(r for r in got if r.conv_id == dropped)
    assert tuple(empty)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert turn_repair.digest(turn_repair.repair(turn_repair.damage(df.limit(0)))).count() == 0
