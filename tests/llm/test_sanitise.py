"""Personal data: base spans as stated, and terms that give entities away."""

import hashlib

from pyspark.sql import functions as F

from dimweave.llm import sanitise
from helpers import DOCS, brute_spans, frame

ODD = [None, "", "a@b.c_d@e.f g@h.i.", "1.2.3.4.5.6.7.8 001.002.3.255 1.2.3.256 9.9.9.9999999999999999999",
       "é🙂 x@y.zz é +1 (578) 555-6437 4918187128635271", "4918187128635271 4918-1871-2863-5271", "+" * 50 + "123456789012",
       "a" * 30000, "a.b.c.d@" * 300, "a@" + "b." * 9000 + "c", "1 " * 40, "0" * 15, "x@y.z" * 200, "@.@ a@-.-..x",
       "12.13.14.15@q.r", "+12 34 56 78 90 12", "x+1.555.555.5555", "a@b.c,d@e.f"]


def test_base_spans_match_the_stated_patterns(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + DOCS
    got = sanitise.digest(sanitise.find_spans(frame(spark, rows)))
    seen = sorted((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got.filter("doc_id is not null").collect())
    want = []
    for d, t in rows:
        if d is not None:
            s = brute_spans(t)
            text = ",".join(f"{k}:{a}:{b}" for k, a, b in s)
            want.append((d, hashlib.sha256(text.encode()).hexdigest(), *(sum(x[0] == k for x in s) for k in sanitise.KINDS)))
    assert seen == sorted(want)
    assert got.count() == len(rows)


def brute_terms(rows):
    """{(doc_id, text): [(start, end, action)]} by the definition, pair by pair."""
    import math
    import re

    texts = sorted({t or "" for _, t in rows})
    spans = {t: brute_spans(t) for t in texts}
    words = {t: [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", t)] for t in texts}
    with_entity, with_term = {}, {}
    for t in texts:
        for k, a, b in spans[t]:
            with_entity.setdefault((k, t[a:b].lower()), set()).add(t)
        for _, _, w in words[t]:
            with_term.setdefault(w, set()).add(t)
    n = len(texts)
    share = {}
    for e, es in with_entity.items():
        for w, ws in with_term.items():
            if es & ws and len(es) < n:
                share[e, w] = math.log2(len(es & ws) * n / (len(es) * len(ws))) / math.log2(n / len(es))
    out = {}
    for d, t in rows:
        t = t or ""
        best = {w: max([share.get(((k), w), 0) for k in {(k, t[a:b].lower()) for k, a, b in spans[t]}], default=0) for _, _, w in words[t]}
        out[d, t] = [(a, b, "remove" if best[w] >= sanitise.REMOVE - 1e-12 else "generalise") for a, b, w in words[t]
                     if best[w] >= sanitise.GENERALISE - 1e-12 and all(b <= x or y <= a for _, x, y in spans[t])]
    return out


def found_terms(spark, rows):
    return {(r.doc_id, r.text_hash): [(t.start, t.end, t.action) for t in r.terms] for r in sanitise.find_spans(frame(spark, rows)).collect()}


def expect(spark, rows):
    hashes = {r.text: r.h for r in frame(spark, rows).select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    empty = frame(spark, [(1, "")]).select(F.xxhash64("text")).collect()[0][0]
    return {(d, hashes.get(t, empty) if t else empty): v for (d, t), v in brute_terms(rows).items()}


def test_disclosing_terms(spark):
    """What is only ever seen in texts with an entity gives it away; common words don't."""
    rows = [(i, f"note {i} from Quillfeather the writer joe@x.org about item{'abcdefgh'[i]}") for i in range(4)]
    rows += [(10 + i, "copy zanzibar of one text ann@y.org") for i in range(4)]
    rows += [(20 + i, f"the writer wrote about note from item and copy of one text {i}") for i in range(40)]
    found = sanitise.find_spans(frame(spark, rows)).collect()
    terms = {r.doc_id: [dict(rows)[r.doc_id][t.start:t.end] for t in r.terms] for r in found}
    assert all(terms[i] == ["Quillfeather", f"item{'abcdefgh'[i]}"] for i in range(4))
    assert all(terms[10 + i] == ["zanzibar"] for i in range(4))  # four copies are one text
    assert all(not v for d, v in terms.items() if d >= 20)
    clean = {r.doc_id: r.text for r in sanitise.sanitise(frame(spark, rows)).collect()}
    assert clean[0] == "note 0 from  the writer [EMAIL] about "
    assert clean[10] == "copy  of one text [EMAIL]" and clean[20] == rows[8][1]


def test_terms_far_away_repeated_short_and_of_one_text(spark):
    filler = "the and of a to in is it on as at by we be or"
    far = f"Quillfeather {' '.join([filler] * 4)} joe@x.org {filler} quillfeather Zq 77"
    rows = [(i, f"{far} {i % 3}") for i in range(6)] + [(30, f"{filler} kim@z.org Solo")] + [(40 + i, f"{filler} {i % 3} {i}") for i in range(60)]
    text = dict(rows)
    found = {r.doc_id: [text[r.doc_id][t.start:t.end] for t in r.terms] for r in sanitise.find_spans(frame(spark, rows)).collect()}
    assert all(found[i] == ["Quillfeather", "quillfeather", "Zq", "77"] for i in range(6)) and found[30] == ["Solo"]
    # rows that repeat a text bend no count
    assert found_terms(spark, rows) == found_terms(spark, rows + rows[:3] * 9 + rows[-5:] * 7)


def test_terms_equal_brute_force(spark):
    import random

    rng = random.Random(8)
    pool = ["alpha", "beta", "Gamma", "x1", "42", "é", "delta-epsilon", "z", "rare1", "rare2", "rare3", "rare4"]
    people = ["joe@x.org", "Ann@y.org", "10.0.0.1", "+1 555 555 5555", "4918187128635271", "joe@x.org"]
    rows = list(DOCS)
    for d in range(120):
        w = rng.choices(pool[:6], k=rng.randint(1, 9)) + rng.sample(pool, 3)
        for who in rng.sample(people, rng.randint(0, 2)):
            w += [who] + [f"tag{people.index(who)}"] * (rng.random() < .7) + [f"tag{rng.randint(0, 5)}"] * (rng.random() < .1)
        rows.append((d, " ".join(w + [f"u{d}"] * (rng.random() < .2))))
    got, want = found_terms(spark, rows), expect(spark, rows)
    assert got == want and sum(map(len, want.values())) > 20


def test_a_text_of_very_many_spans(spark):
    rows = [(1, " ".join(f"10.{i // 250}.{i % 250}.7 w{i % 50}" for i in range(4_000))), (2, "plain w1 text")]
    got = {r.doc_id: r for r in sanitise.find_spans(frame(spark, rows)).collect()}
    assert [(s.start, s.end) for s in got[1].base] == [(a, b) for _, a, b in brute_spans(rows[0][1])]
    clean = {r.doc_id: r.text for r in sanitise.sanitise(frame(spark, rows)).collect()}
    assert clean[1].count("[IP]") == 4_000 and "10." not in clean[1] and "w1 " in rows[0][1] and clean[2] == "plain w1 text"


def test_sanitise_keeps_rows_and_columns(spark):
    df = frame(spark, DOCS + [(5, "other text joe@x.org")])
    out = sanitise.sanitise(df)
    assert out.columns == df.columns and out.count() == len(DOCS) + 1
    assert out.filter(F.col("text").isNull()).count() == 2
    assert sanitise.sanitise(frame(spark, [])).count() == 0


def test_main_path_is_native(spark):
    plan = sanitise.digest(sanitise.find_spans(frame(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
