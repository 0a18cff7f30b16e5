"""Toxicity, the language model, packing and URL filters."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from dimweave.llm import language_model, packing, toxicity, urls
from helpers import DOCS, LOWER, frame, words


# ---------------------------------------------------------------- toxicity
def test_nearest_is_exact():
    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(200):
        t = np.sort(rng.choice(30, rng.integers(0, 6), replace=False))
        w = rng.random(len(t)) + 0.1
        vectors.append((t, w / np.sqrt((w * w).sum()) if len(t) else w))
    index = toxicity.BlockMaxIndex(vectors, 30, block=8)
    dense = np.zeros((200, 30))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for t, w in vectors[:60]:
        q = np.zeros(30)
        q[t] = w
        want = sorted((-round(s, 9), i) for i, s in enumerate(dense @ q) if s > 0)[:10]
        got = index.nearest(t, w, 10)
        assert [i for _, i in got] == [i for _, i in want]
        assert np.allclose([s for s, _ in got], [-s for s, _ in want])


def test_isotonic_rises():
    x, y = np.array([1, 2, 3, 4, 5, 5]), np.array([0, 1, 0, 1, 1, 0])
    steps, rates = toxicity.isotonic(x, y)
    assert (np.diff(rates) > 0).all() and steps[0] == 1


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    bad = F.when(F.col("doc_id") % 6 == 0, F.concat(F.col("text"), F.lit(" you vile wretch, you vile wretch")))
    docs = docs.withColumn("text", F.coalesce(bad, F.col("text")))
    labels = docs.select("doc_id").withColumn("toxic", (F.col("doc_id") % 6 == 0).cast("int"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model, keep=["doc_id"]).filter(toxicity.crc_part(F.col("doc_id"), 4) == 2).collect()
    hit = sum(r.predicted == (r.doc_id % 6 == 0) for r in rows)
    assert hit >= 0.98 * len(rows)
    one = next(r for r in rows if r.predicted)
    assert one.evidence and all(0 < e.similarity <= 1 + 1e-9 for e in one.evidence)
    assert sum(e.toxic for e in one.evidence) > len(one.evidence) / 2


def test_every_term_counts(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice([f"{a}{b}" for a in "klmnprst" for b in "aeiou"], 12)) + (f" vile{'xyzuv'[i // 8 % 5]}" if i % 8 == 0 else ""))
            for i in range(1, 601)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id").withColumn("toxic", (F.col("doc_id") % 8 == 0).cast("int"))
    out = toxicity.score(docs, toxicity.fit(docs, labels)).filter(toxicity.crc_part(F.col("doc_id"), 4) == 2).collect()
    bad = [r.predicted for r in out if r.doc_id % 8 == 0]
    good = [r.predicted for r in out if r.doc_id % 8]
    assert sum(bad) >= 0.7 * len(bad) and sum(good) <= 0.1 * len(good), (sum(bad), len(bad), sum(good), len(good))
    # a text's length runs over all its terms, so that few shared ones leave it far from every example
    clean = spark.createDataFrame([(0, "vilex " + " ".join(f"far{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(600)))], "doc_id long, text string")
    one = toxicity.score(clean, toxicity.fit(docs, labels)).collect()[0]
    assert one.evidence and all(0 < e.similarity < 0.999 for e in one.evidence)


def test_toxicity_cases(spark):
    labels = spark.createDataFrame([(4, 0, 1), (4, 1, 1), (None, 1, 0), (6, None, 0), (999, 1, 1)], "doc_id long, toxic int, quality int")
    for labelled in (labels, labels.limit(0)):
        df = frame(spark)
        out = toxicity.score(df, toxicity.fit(df, labelled))
        assert out.count() == len(DOCS) and out.filter("score is null or score < 0 or score > 1").count() == 0
        assert set(out.columns) == set(df.columns)
    none = frame(spark, [])
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


# ---------------------------------------------------------------- language model
def brute_model(rows):
    texts = [[b"<s>", *(w.translate(LOWER) for w in words(t)), b"</s>"] for _, t in rows]
    part = [None if d is None else zlib.crc32(str(d).encode()) % 7 for d, _ in rows]

    def counts(which):
        u, b = Counter(), Counter()
        for i in which:
            u.update(texts[i])
            b.update(zip(texts[i], texts[i][1:]))
        return u, b

    train = [i for i, p in enumerate(part) if p is not None and p != 2]
    u, b = counts(train)
    n, v = sum(u.values()) - u[b"<s>"], len([w for w in u if w != b"<s>"])
    su, sb = counts([i for i in train if part[i] == 5])
    eu, eb = u - su, b - sb
    en = sum(eu.values()) - eu[b"<s>"]
    bucket = lambda c: int(math.log2(c)) + 1 if c else 0
    events = {}
    for i in train:
        if part[i] == 5:
            for x, y in zip(texts[i], texts[i][1:]):
                events.setdefault(bucket(eu[x]), []).append((eb[x, y] / max(eu[x], 1), eu[y] / max(en, 1)))
    weights = language_model.mixture([(k, 1.0, p2, p1) for k, e in events.items() for p2, p1 in e], v)
    out = []
    for (d, _), t, p in zip(rows, texts, part):
        base = score = 0.0
        for x, y in zip(t, t[1:]):
            a = np.array(weights[min(weights, key=lambda k: (abs(k - bucket(u[x])), k))]) if weights else np.full(3, 1 / 3)
            if not u[x]:
                a = a * [0, 1, 1] / a[1:].sum()
            score += math.log10(a[0] * b[x, y] / max(u[x], 1) + a[1] * u[y] / max(n, 1) + a[2] / (v + 1))
            base += math.log10((u[y] + 1) / (n + v + 1))
        out.append((d, p == 2, len(t) - 1, sum(u[y] > 0 for y in t[1:]), n, base, score))
    return out


@pytest.mark.parametrize("rows", [DOCS, DOCS + [(100 + i, f"the cat {i % 3} sat on mat {i % 5} " * (i % 4)) for i in range(60)]])
def test_language_model(spark, rows):
    got = sorted((tuple(r) for r in language_model.score_texts(frame(spark, rows).repartition(3)).collect()), key=lambda r: repr((r[0], r[2], r[5])))
    want = sorted(brute_model(rows), key=lambda r: repr((r[0], r[2], r[5])))
    assert [(r[0], r[2], r[3], r[4]) for r in got] == [(r[0], r[2], r[3], r[4]) for r in want]
    assert [r[1] for r in got] == [r[1] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want])
    assert np.allclose([r[6] for r in got], [r[6] for r in want], rtol=1e-3)


def test_language_model_without_documents(spark):
    assert language_model.score_texts(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- packing
def test_ids_equal_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.VOCABULARY)
    texts = [t for _, t in DOCS] + ["it's 's <|endoftext|> a<|endoftext|>b", "ΣΑΣ ΣΑΣ. é ́x", "ﬁ ½ " + "x" * 500 + " 漢字 🙂🙂",
                                    "\x1c a\x1db \x85 c\x00d", "It's DON'T we'll 'sup ''s ÀÉÎÕÜß×÷ª²µ ÿ x²y #*'s's", "\ta\x0bb\x0cc\r\n"]
    ids, begin = packing.WordIds(path).ids(pa.array(texts, pa.string()))
    plain = Tokenizer.from_file(path)
    for t, a, b in zip(texts, begin[:-1], begin[1:]):
        assert ids[a:b].tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_packing(spark):
    rows = DOCS + [(100 + i, "word " * (37 * i)) for i in range(80)]
    got = packing.pack_sequences(frame(spark, rows)).collect()
    known = packing.word_ids(packing.VOCABULARY)
    flat, begin = known.ids(pa.array([t for _, t in rows], pa.string()))
    whole = Counter()
    for (d, _), a, b in zip(rows, begin[:-1], begin[1:]):
        own = np.append(flat[a:b], np.uint32(1)).astype("<u4")
        for s in range(0, len(own), 2048):
            whole[(d, s, min(2048, len(own) - s), zlib.crc32(own[s:s + 2048].tobytes()), len(own))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == whole
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_sequences(frame(spark, [])).count() == 0


def test_shortest_pack_first():
    packs = packing.shortest_pack_first({6: 2, 4: 3, 3: 1, 1: 5}, 10)
    counts = Counter()
    for n, pack in packs:
        assert sum(pack) <= 10 and list(pack) == sorted(pack, reverse=True)
        counts.update({x: n * pack.count(x) for x in set(pack)})
    assert counts == {6: 2, 4: 3, 3: 1, 1: 5}
    assert sum(n for n, _ in packs) == 4


# ---------------------------------------------------------------- URL filters
def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.B.Org"), (4, "http://a.org/x?y#z"), (5, "https://www.example.org/es/1"),
            (6, "https://example.org/en/12#f"), (7, "http://x.com/fr/ads"), (8, "http://x.com/de/"), (9, "http://ads-track.net/en"),
            (10, "http://m.ads-track.example.net/a"), (11, "http://notads-track.net/"), (12, "http://h.net/login?x"),
            (13, "http://h.net/login"), (14, "http://h.net/loginx"), (15, "http://docs.h.net/cgi-bin/a"), (16, "http://h.net/a.EXE"),
            (17, "http://h.net/a.exe?b"), (18, "http://h.net?sessionid=4"), (3, "http://A.B.Org"), (19, "x://"), (20, "http://notorg/")]
    df = spark.createDataFrame([(i, u, "c", "d") for i, u in rows], "page_id long, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, urls.HOST_RULES, urls.PATTERNS).collect()}
    assert got[1] == got[2] == ("", "", None, "allow") and got[19] == ("", "", None, "allow")
    assert got[3] == ("a.b.org", "", None, "allow") and got[4] == ("a.org", "/x", "org/", "allow")
    assert got[5] == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert got[6] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[7][2:] == ("com/fr/", "allow") and got[8][2:] == ("com/de/", "block")
    assert [got[i][3] for i in range(9, 19)] == ["block", "block", "allow", "block", "block", "allow", "allow", "block", "allow", "block"]
    assert urls.judge_urls(df, urls.HOST_RULES, urls.PATTERNS).count() == len(rows)
    assert urls.judge_urls(df.limit(0), urls.HOST_RULES, urls.PATTERNS).count() == 0
    assert urls.judge_urls(df, [], []).filter("verdict = 'block'").count() == 0


def test_pattern_tokens_are_whole():
    assert urls.parse_pattern("||ads-track.").tokens == ("ads", "track")
    assert urls.parse_pattern("banner/x*").tokens == ()
    assert urls.parse_pattern("/cart/").tokens == ("cart",)
