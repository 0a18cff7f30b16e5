from dimweave.llm import decontamination
from dimweave.llm.decontamination import find_leaks
from helpers import frame

ITEMS = [(1, "Anna has 12 apples and gives 5 kg of them to Bert who then sells 12 pears to Anna every single day"),
         (2, "the quick brown fox jumps over the lazy dog while seven tired sheep look on from far away"),
         (3, "short item text"), (4, None), (5, ""), (6, "Only Names Here And There Or 1 2 3 4 5")]
LONG = " ".join(f"x{i}" for i in range(400))


def leaks(spark, docs, items=ITEMS):
    bench = spark.createDataFrame([(i, t, "e") for i, t in items], "item_id long, text string, h string")
    return {(r.doc_id, r.item_id): r.kind for r in find_leaks(frame(spark, docs), bench).collect()}


def test_exact_reparameterised_and_inconsistent(spark):
    one = ITEMS[0][1]
    new = one.replace("Anna", "Cleo").replace("Bert", "Dan").replace("12", "30").replace(" 5 kg", " 7 km")
    twisted = new.replace("to Cleo every", "to Rob every").replace("sells 30", "sells 31")
    docs = [(10, f"{LONG} {one} {LONG}"), (11, f"{LONG} {new} {LONG}"), (12, twisted), (13, LONG), (14, None), (15, ""),
            (16, ITEMS[1][1].upper().lower() + "!"), (17, "the quick brown fox jumps over the lazy cat"), (18, "short item text"),
            (18, "short item text"), (19, ITEMS[5][1]), (20, "*** The Quick, brown fox: jumps over the lazy dog while seven tired sheep look on from far away ***")]
    got = leaks(spark, docs)
    assert got[(10, 1)] == "exact" and got[(11, 1)] == "reparameterised" and got[(16, 2)] == "exact"
    assert (12, 1) not in got and (17, 2) not in got and got[(19, 6)] == "exact"
    assert got[(18, 3)] == "exact"
    assert not any(d in (13, 14, 15) for d, _ in got)
    assert got[(20, 2)] == "exact" and len(got) == 6


def test_verbatim_copies_of_any_item(spark):
    items = [*ITEMS, (7, "ALL CAPS 12 + 30 = 42"), (8, "Paris"), (9, "Five Words In Title Case")]
    docs = [(1, f"{LONG} {ITEMS[5][1]} {LONG}"), (2, f"{LONG} short item text {LONG}"), (3, f"{LONG} ALL CAPS 12 + 30 = 42 {LONG}"),
            (4, f"{LONG} Paris {LONG}"), (5, f"{LONG} Five Words In Title Case {LONG}"), (6, LONG), (7, "Other Names In Title Case"),
            (8, ITEMS[5][1]), (9, "paris"), (10, "a short item text")]
    assert leaks(spark, docs, items) == {(d, i): "exact" for d, i in ((1, 6), (2, 3), (3, 7), (4, 8), (5, 9), (8, 6), (9, 8), (10, 3))}


def test_copies_in_other_letter_case(spark):
    one = ITEMS[0][1]
    docs = [(1, f"{LONG} {one.lower()} {LONG}"), (2, f"{LONG} {one.upper()} {LONG}"), (3, one.title())]
    assert leaks(spark, docs) == {(1, 1): "exact", (2, 1): "exact", (3, 1): "exact"}


def test_empty_tables(spark):
    assert leaks(spark, []) == {}
    assert leaks(spark, [(1, LONG)], []) == {}


def brute(docs, items):
    """{(doc_id, item_id, kind)} by the definition, one text and item after the other."""
    import re
    from itertools import groupby

    def parse(text):
        bare = re.sub(r"[^\w\s]+|_", "", text or "").strip(" \t\n\x0b\x0c\r")
        own, out = re.split(r"\s+", bare) if bare else [], []
        for i, w in enumerate(own):
            number = w[0].isnumeric()
            unit = w in decontamination.UNITS and i and own[i - 1][0].isnumeric()
            out.append(decontamination.NAME if w[0].isupper() else decontamination.NUMBER if number else decontamination.UNIT if unit else w.lower())
        return [w.lower() for w in own], out

    n, least, share = decontamination.WINDOW, decontamination.LITERALS, decontamination.SHARE
    found = set()
    for item, rows in groupby(sorted(items, key=lambda r: r[0]), key=lambda r: r[0]):
        windows = []  # (j, words, template or None)
        for _, text in rows:
            own, words = parse(text)
            for j in range(max(1, len(own) - n + 1) if own else 0):
                t = tuple(words[j:j + n])
                windows.append((j, tuple(own[j:j + n]), t if sum(w not in decontamination.SLOTS for w in t) >= least else None))
        if not windows:
            continue
        all_t, all_w = {t for _, _, t in windows if t}, {w for _, w, _ in windows}
        sizes = {len(w) for w in all_w}
        for doc, text in docs:
            own, words = parse(text)
            met = []  # (plain, key, window, shift, slots)
            for size in sizes | {n}:
                for i in range(max(1, len(own) - size + 1) if size == n else len(own) - size + 1 if len(own) > size else 0):
                    mine, template = tuple(own[i:i + size]), tuple(words[i:i + size])
                    for j, w, t in windows:
                        if mine == w:
                            met.append((True, w, w, i - j, ()))
                        if t and template == t:
                            slots = [(a, b) for a, b, s in zip(w, mine, t) if s in decontamination.SLOTS]
                            met.append((False, t, w, i - j, tuple(slots)))
            n_t, n_w = {k for p, k, *_ in met if not p}, {m[2] for m in met}
            by_t = all_t and len(n_t) >= share * len(all_t)
            if not by_t and len(n_w) < share * len(all_w):
                continue
            values = {}
            for p, _, _, shift, slots in met:
                if not p:
                    for a, b in slots:
                        values.setdefault(shift, {}).setdefault(a, set()).add(b)
            agrees = {s: all(len(b) == 1 for b in v.values()) for s, v in values.items()}
            other = {s: any(b != {a} for a, b in v.items()) for s, v in values.items()}
            kept = [m for m in met if m[0] or agrees.get(m[3], True)]
            c_t, c_w = {k for p, k, *_ in kept if not p}, {m[2] for m in kept}
            by_t = by_t and len(c_t) >= share * len(n_t)
            if not by_t and len(c_w) < share * len(all_w):
                continue
            keys = {}  # (window, plain, key) -> changed on every alignment
            for p, k, w, shift, _ in kept:
                keys.setdefault((w, p, k), []).append(not p and other.get(shift, False))
            changed = {}
            for (w, p, k), o in keys.items():
                changed.setdefault(w, []).append((all(o), not p))
            result = [min(o for o, _ in v) and (not by_t or any(t for _, t in v)) for v in changed.values()]
            found.add((doc, item, "reparameterised" if any(result) else "exact"))
    return found


def test_equals_brute_force(spark):
    import random

    rng = random.Random(9)
    names, numbers = ["Ann", "Bob", "Cy"], ["3", "4", "55"]
    stem = "{0} buys {1} red apples and {2} kg of flour then {0} gives {1} apples to {3} who eats {4} of them before the long trip".split()

    def made():
        text = " ".join(stem).format(rng.choice(names), rng.choice(numbers), rng.choice(numbers), rng.choice(names), rng.choice(numbers))
        return " ".join(w for w in text.split() if rng.random() > 0.02)

    items = [(i, made()) for i in range(8)] + [(20, "two words"), (21, "Solo"), (22, "same text shared by two items here"),
                                               (23, "same text shared by two items here"), (24, None)]
    docs = [(d, " ".join(rng.choice([made(), "filler words in between", "Two words", "solo", "same text shared by two items HERE"])
                         for _ in range(rng.randint(1, 3)))) for d in range(60)] + [(None, made()), (None, "two words more"), (None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.kind) for r in find_leaks(frame(spark, docs), bench).collect()}
    assert got == brute(docs, items) and len(got) > 50


def test_null_and_repeated_ids_are_told_apart_by_their_text(spark):
    two = ITEMS[1][1]
    found = find_leaks(frame(spark, [(None, two), (None, LONG), (2, two), (2, two), (2, LONG)]),
                       spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [("2", 2), ("None", 2)] and len({r.text_hash for r in found}) == 1


def test_without_broadcast(spark, monkeypatch):
    docs = [(10, f"{LONG} {ITEMS[0][1]} {LONG}"), (18, "short item text"), (19, ITEMS[5][1]), (20, None)]
    first = leaks(spark, docs)
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 3)
    assert leaks(spark, docs) == first and len(first) == 3


def test_main_path_is_native(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = find_leaks(frame(spark), bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
