"""Personal data: pattern spans, and terms that give protected entities away.

DataFrame operations only.  The base spans (email, ip, card, phone) come from patterns and
checks.  The information-theoretic part protects every distinct base value (an entity): over the
distinct texts of the corpus it counts in how many an entity, a term, and both occur, and takes

    PMI(entity, term) = log2(n_both * N / (n_entity * n_term)),  IC(entity) = -log2(n_entity / N).

A term whose PMI reaches ``GENERALISE`` of the entity's information content discloses it: it is
generalised, and from ``REMOVE`` on removed, wherever it stands in the texts that hold the entity.
So a term that is only ever seen in texts with the entity goes; one copy of a text more or less is no
evidence, since texts count once.

Terms are runs of letters and digits, lower-cased, of any length and anywhere in the text, but
for those inside a base span.

Counting is exact.  As n_both <= n_entity, a term can only disclose an entity if n_term <=
n_entity ** GENERALISE * N ** (1 - GENERALISE), so frequent terms drop out before the join.
Entities that occur in the same texts are one class, and so are terms: of a text with thousands
of values that occur nowhere else, one pair is counted and not their product.

Offsets are code points, ends exclusive; their sums are taken in steps over whole arrays, so that a
text with very many spans costs little more than its length.  Cases: null and empty texts have no spans; repeated
rows get equal spans; an empty table gives an empty result; rows with the same id and other
texts are kept apart by a hash of the text; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.session import ensure_checkpoint_dir

GENERALISE, REMOVE = 0.8, 0.95
KINDS = ["email", "ip", "card", "phone"]
TERM = "term"
#: The base patterns.  They find what the stated ones find: a run of a class is taken whole
#: (possessive) where a shorter part of it can't lead to a match, and a run is only tried from
#: its first character, so that long runs cost no more than their length.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a kind can't occur.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
LABEL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalise": "[TERM]", "remove": ""}


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn check over a string of digits: every second digit from the right is doubled."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return found.rlike(rf"^{IP_PART}(\.{IP_PART}){{3}}$")
    digits = _digits(found)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(10, 15)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


#: A running total takes in RADIX totals in each of at most LEVELS steps: for as many values as a
#: text can have.
RADIX, LEVELS = 16, 7


def running(values: Column, join: Callable[..., Column], none: int) -> Column:
    """Of an array of numbers the total (``join`` of many) of each and all before it; ``none``: that of
    no number.  In step k every total takes in those RADIX ** k, 2 * RADIX ** k, .. places before."""
    def step(totals: Column, k: int) -> Column:
        far = RADIX ** k
        more = F.transform(totals, lambda x, i: join(x, *(F.coalesce(F.get(totals, i - j * far), F.lit(none)) for j in range(1, RADIX))))
        rest = (lambda t: step(t, k + 1)) if k + 1 < LEVELS else (lambda t: t)
        return F.when(F.size(totals) > far, _bind(more, rest)).otherwise(totals)

    return _bind(values, lambda v: step(v, 0))


def _places(text: Column, pattern: str) -> Column:
    """All matches as (start, end, value).  The text is split at the matches, so parts and matches
    alternate, and a running sum of their lengths gives the offsets."""
    def rows(found: Column, parts: Column) -> Column:
        sizes = F.zip_with(F.slice(parts, F.lit(1), F.size(found)), found, lambda p, m: F.length(p) + F.length(m))
        return F.zip_with(running(sizes, lambda *x: reduce(add, x), 0), found, lambda end, m: F.struct(
            (end - F.length(m)).alias("start"), end.alias("end"), m.alias("value")))

    return _bind(F.regexp_extract_all(text, F.lit(pattern), 0), lambda found: _bind(F.split(text, pattern, -1), lambda parts: rows(found, parts)))


def _spans(text: Column, kind: str) -> Column:
    """All valid spans of a kind."""
    rows = F.transform(_places(text, PATTERNS[kind]), lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("k"), x["end"].alias("end"), x["value"].alias("value")))
    return F.filter(rows, lambda r: _valid(kind, r["value"]))


SPAN = "array<struct<start:int,k:int,end:int,value:string>>"
WORD = r"[\p{L}\p{N}]++"


def base_spans(text: Column) -> Column:
    """The spans of all kinds by start, then kind."""
    none = F.array().cast(SPAN)
    t = F.coalesce(text, F.lit(""))
    own = [F.when(t.contains(NEEDS[k]) if NEEDS[k] else t.rlike("[0-9]{2}|[0-9][ -][0-9]"), _spans(t, k)).otherwise(none)
           for k in KINDS]
    return F.array_sort(F.concat(*own))


def spell(spans: Column, names: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def _classes(rows: DataFrame, of: str) -> DataFrame:
    """(of, n, c1, c2) for distinct (of, text_hash): in how many texts each occurs, and a 128-bit
    mark of which: equal for those that occur in the same texts."""
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "text_hash"))
    return rows.groupBy(of).agg(F.count("*").alias("n"), mark(1).alias("c1"), mark(2).alias("c2"))


def _terms(text: Column) -> Column:
    """A hash of each distinct term."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), 0), lambda w: F.xxhash64(w)))


def _disclosing(docs: DataFrame, held: DataFrame, total: int) -> DataFrame:
    """(text_hash, th, share, entity): the terms (by hash) that disclose an entity of a text; ``docs``
    (text_hash, text) are all texts, ``held`` (text_hash, text, base) once each those with spans."""
    # (outer: a plain explode would compute the array twice)
    entities = held.select("text_hash", F.explode_outer("base").alias("s")).select(
        "text_hash", F.concat_ws(":", F.col("s.k"), F.lower("s.value")).alias("entity")).distinct()
    kinds = _classes(entities, "entity").checkpoint()
    most = kinds.agg(F.max("n")).collect()[0][0]
    if not most or total < 2:
        return held.select("text_hash", F.lit(0).cast("long").alias("th"), F.lit(0.0).alias("share"), F.lit("").alias("entity")).limit(0)
    # of every term, in how many texts it occurs
    rare = most ** GENERALISE * total ** (1 - GENERALISE) * (1 + 1e-9)
    once = docs.dropDuplicates(["text_hash"])  # copies meet before their terms become rows
    everywhere = once.select("text_hash", F.explode_outer(_terms(F.col("text"))).alias("th")).filter("th is not null")
    counts = _classes(everywhere, "th").filter(F.col("n") <= rare)
    here = held.select("text_hash", F.explode_outer(_terms(F.col("text"))).alias("th")).filter("th is not null")
    here = here.join(counts.select("th", F.col("n").alias("n_term"), F.col("c1").alias("t1"), F.col("c2").alias("t2")), "th").checkpoint()
    groups = kinds.groupBy("n", "c1", "c2").agg(F.min("entity").alias("entity"))
    there = (entities.join(groups.select("entity", F.col("n").alias("n_entity")), "entity")
             .withColumn("least", F.pow("n_entity", F.lit(GENERALISE)) * F.lit(total ** (1 - GENERALISE) * (1 + 1e-9))))
    both = here.select("text_hash", "t1", "t2", "n_term").distinct().join(there, "text_hash").filter("n_term <= least")
    told = both.groupBy("entity", "n_entity", "t1", "t2", "n_term").agg(F.count("*").alias("n_both"))
    pmi = F.log2(F.col("n_both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term")))
    content = F.log2(F.lit(float(total)) / F.col("n_entity"))
    strong = (told.withColumn("share", F.when(content > 0, pmi / content).otherwise(F.lit(0.0)))
              .filter(F.col("share") >= GENERALISE - 1e-12).select("entity", "t1", "t2", "n_term", "share"))
    in_text = (both.join(strong, ["entity", "t1", "t2", "n_term"]).groupBy("text_hash", "t1", "t2", "n_term")
               .agg(F.max(F.struct("share", "entity")).alias("m")))
    return here.join(in_text, ["text_hash", "t1", "t2", "n_term"]).select("text_hash", "th", "m.share", "m.entity")


def find_spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_hash, base (the base spans) and terms (the
    disclosing terms: start, end, action, entity, share)."""
    ensure_checkpoint_dir(docs.sparkSession)
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("text_hash"), base_spans(t).alias("base"), t.alias("text"))
    found = found.select("doc_id", "text_hash", "base", F.when(F.size("base") > 0, F.col("text")).alias("text"))
    found = found.checkpoint()  # the texts are not searched again for the counts and the result
    total = found.select("text_hash").distinct().count()
    held = found.filter("text is not null").select("text_hash", "text", "base").dropDuplicates(["text_hash"]).checkpoint()
    told = _disclosing(docs.select(F.xxhash64(t).alias("text_hash"), t.alias("text")), held, total).checkpoint()

    # where these terms stand: the words of their texts, but for those that a base span touches
    words = (held.join(told.select("text_hash").distinct(), "text_hash", "left_semi")
             .select("text_hash", F.explode_outer(_places(F.col("text"), WORD)).alias("x")))
    words = words.select("text_hash", "x.start", "x.end", F.xxhash64(F.lower("x.value")).alias("th")).join(told, ["text_hash", "th"])
    spans = held.select("text_hash", F.explode("base").alias("s")).select("text_hash", "s.start", "s.end").withColumn("is_base", F.lit(True))
    rows = words.drop("th").withColumn("is_base", F.lit(False)).unionByName(
        spans.join(told.select("text_hash").distinct(), "text_hash", "left_semi"), allowMissingColumns=True)
    before = Window.partitionBy("text_hash").orderBy("start", F.desc("is_base")).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("text_hash").orderBy(F.desc("start"), "is_base").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("reach", F.max(F.when(F.col("is_base"), F.col("end"))).over(before))
    rows = rows.withColumn("next", F.min(F.when(F.col("is_base"), F.col("start"))).over(after))
    clear = (F.coalesce(F.col("reach") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("next") >= F.col("end"), F.lit(True)))
    terms = rows.filter(~F.col("is_base") & clear).groupBy(F.col("text_hash").alias("_s_hash")).agg(F.sort_array(F.collect_list(F.struct(
        "start", "end", F.when(F.col("share") >= REMOVE - 1e-12, "remove").otherwise("generalise").alias("action"), "entity", "share"))).alias("terms"))
    none = F.array().cast("array<struct<start:int,end:int,action:string,entity:string,share:double>>")
    bare = found.filter("text is null").select("doc_id", "text_hash", "base", none.alias("terms"))
    full = found.filter("text is not null").select("doc_id", "text_hash", "base").join(terms, F.col("text_hash") == F.col("_s_hash"), "left")
    return full.select("doc_id", "text_hash", "base", F.coalesce("terms", none).alias("terms")).unionByName(bare)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, base_sha256 and spans (all, spelled)."""
    names = F.array(*map(F.lit, [*KINDS, TERM]))
    term = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("k"), t["end"].alias("end")))
    base = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["k"].alias("k"), b["end"].alias("end")))
    def count(k: int) -> Column:  # (a lambda with a second parameter would get the element's index)
        return F.size(F.filter("base", lambda b: b["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = map(count, range(len(KINDS)))
    return found.select("doc_id", *counts, F.sha2(spell(base, names).cast("binary"), 256).alias("base_sha256"),
                        spell(F.array_sort(F.concat(base, term)), names).alias("spans"))


def sanitise(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the spans of ``text`` replaced by their labels; a null text stays null."""
    found = find_spans(docs.select(doc_id, text), doc_id=doc_id, text=text).filter(
        (F.size("base") > 0) | (F.size("terms") > 0)).dropDuplicates(["doc_id", "text_hash"])
    base = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), F.element_at(
        F.array(*[F.lit(LABEL[k]) for k in KINDS]), b["k"] + 1).alias("label")))
    terms = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(
        t["action"] == "remove", LABEL["remove"]).otherwise(LABEL["generalise"]).alias("label")))
    found = found.select(F.col("doc_id").alias("_s_id"), F.col("text_hash").alias("_s_hash"),
                         F.array_sort(F.concat(base, terms)).alias("_s_spans"))
    h = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    joined = docs.withColumn("_s_own", h).join(found, F.col(doc_id).eqNullSafe(F.col("_s_id")) & (F.col("_s_own") == F.col("_s_hash")), "left")
    # what no span covers: from the farthest end so far to the next start
    reach = F.concat(F.array(F.lit(0)), running(F.transform("_s_spans", lambda x: x["end"]), F.greatest, 0))
    n = F.size("_s_spans")
    cut = lambda a, b: F.substring(F.col(text), a + 1, b - a)

    def parts(reach: Column) -> Column:
        own = F.transform("_s_spans", lambda x, i: F.when(x["start"] >= F.get(reach, i), F.concat(
            cut(F.get(reach, i), x["start"]), x["label"])).otherwise(F.lit("")))
        return F.concat(F.array_join(own, ""), cut(F.get(reach, n), F.length(text)))

    return joined.withColumn(text, F.when(F.col("_s_spans").isNull(), F.col(text)).otherwise(_bind(reach, parts))).select(*docs.columns)
