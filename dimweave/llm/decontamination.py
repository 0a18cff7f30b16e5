"""Benchmark decontamination by template canonicalisation, DataFrame operations only.

1. Canonical words: punctuation goes; a word that begins with a capital becomes a name slot, a
   number a number slot, a unit after a number a unit slot; the rest is lower-cased.  A
   re-parameterised question thereby keeps its template.
2. Windows of ``WINDOW`` words are joined by hash with the benchmark's windows under two keys:
   the template (of item windows with at least ``LITERALS`` words that aren't slots), and the
   plain words in lower case (of every window).
3. An item leaks by its templates: where a document holds ``SHARE`` of them, the slots are
   compared (in lower case): along one alignment of document and item, equal values of the item
   must have become equal values of the document.  ``SHARE`` of the matched templates must lie
   on such alignments.
4. It also leaks by its words: where ``SHARE`` of all its windows are met, each by the plain
   words or by a template on such an alignment.  So copies are found whatever their letter case,
   and also of items that are mostly names and numbers.

One pass over the texts finds which windows of items each holds; only these go on.  A document can
only leak an item of whose rarest windows, as many as ``SHARE`` lets it miss and one more, it holds
one; only such pairs are counted, so windows that many items share multiply nothing.  The places of
the windows are looked up in the texts of the pairs that are left.

Cases: null and empty texts match nothing; an item with fewer than ``WINDOW`` words is one
window, and is looked for among the document's windows of that length; every text is judged by
itself, also where rows repeat an id, and rows of equal id and text count once; a null id is an id
like any other; rows that repeat an item's id count as one item holding all their windows; either table may be
empty; other columns don't matter.  The counts returned are of templates where an item leaks by
them, and else of all windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.session import ensure_checkpoint_dir

WINDOW, LITERALS, SHARE = 5, 3, 0.8
#: Benchmark windows that may be broadcast (a few dozen MB); above that the join is shuffled.
BROADCAST_WINDOWS = 500_000
NAME, NUMBER, UNIT = "‹w›", "‹n›", "‹u›"
#: Words that are units where they follow a number.
UNITS = ["km", "m", "cm", "mm", "mi", "mile", "miles", "ft", "foot", "feet", "inch", "inches", "yard", "yards", "kg", "g",
         "mg", "lb", "lbs", "pound", "pounds", "oz", "ounce", "ounces", "ton", "tons", "l", "ml", "litre", "litres", "liter",
         "liters", "gallon", "gallons", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week",
         "weeks", "month", "months", "year", "years", "cent", "cents", "dollar", "dollars", "euro", "euros", "percent",
         "degree", "degrees", "mph", "kph", "kmh"]


BLANKS = " \t\n\x0b\x0c\r"
SLOTS = (NAME, NUMBER, UNIT)


def bare_text(text: Column) -> Column:
    """The text's words without punctuation, still in their own letters (null: empty)."""
    letters = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[^\p{L}\p{N}\s]+", "")
    return F.btrim(letters, F.lit(BLANKS))


def canonical_text(bare: Column) -> Column:
    """The same words as a template."""
    names = F.regexp_replace(bare, r"(?<!\S)\p{Lu}\S*", NAME)
    numbers = F.regexp_replace(names, r"(?<!\S)\p{N}\S*", NUMBER)
    units = F.regexp_replace(numbers, rf"(?<={NUMBER}\s)({'|'.join(UNITS)})(?!\S)", UNIT)
    return F.lower(F.when(bare.rlike(r"\p{N}"), units).otherwise(names))


def _words(bare: Column) -> Column:
    return F.split(bare, r"\s+", -1)


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(hashes: Column, plain: bool, size: int = WINDOW, at: bool = False) -> Column:
    """A hash of each window (``at``: with its place i, as h), from the hashes of the words, which
    must be a column of their own.  Fewer than WINDOW words are one window; of shorter windows,
    texts with more words than that have them."""
    last = F.greatest(F.size(hashes) - size, F.lit(0))
    seed = [F.lit("plain")] if plain else []

    def window(i: Column) -> Column:
        h = F.xxhash64(*seed, *(F.get(hashes, i + k) for k in range(size)))
        return F.struct(i.alias("i"), h.alias("h")) if at else h

    found = F.transform(F.sequence(F.lit(0), last), window)
    none = F.array().cast("array<struct<i:int,h:bigint>>" if at else "array<bigint>")
    return found if size == WINDOW else F.when(F.size(hashes) > size, found).otherwise(none)


def _all_windows(short: list[int], at: bool = False) -> Column:
    """Of a document, a row for each: both keys, for windows of WINDOW words and of the lengths of
    shorter items.  (Outer: a plain explode would also test the array's size where the text is
    read, and compute it twice.)"""
    kinds = [("h_words", False), ("h_own", True)]
    return F.explode_outer(F.concat(*(_windows(F.col(c), plain, n, at) for n in [WINDOW, *short] for c, plain in kinds
                                      if plain or n >= LITERALS)))


def _templates(df: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """(kept columns, words, own, h_words, h_own): rows with at least one word, as a template and in
    lower case, and the hashes of the words."""
    bare = df.select(*keep, bare_text(F.col(text)).alias("bare")).filter("bare <> ''")
    names = [c for c in bare.columns if c != "bare"]
    words = bare.select(*names, _words(canonical_text(F.col("bare"))).alias("words"), _words(F.lower("bare")).alias("own"))
    return words.select("*", _hashes(F.col("words")).alias("h_words"), _hashes(F.col("own")).alias("h_own"))


def _item_windows(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, j, plain, h, w, own, slot): each window under its keys; w: the plain one, which
    names the window; its words in lower case, and which of them are slots.  The template is no
    key of a window with too few literal words."""
    t = _templates(benchmark, text, [F.col(item_id).alias("item_id")])
    w = t.select("item_id", "words", "own", F.explode_outer(F.arrays_zip(
        _windows(F.col("h_words"), False, at=True).alias("t"), _windows(F.col("h_own"), True).alias("w"))).alias("x"))
    w = w.select("item_id", "words", "own", F.col("x.t.i").alias("j"), F.col("x.t.h").alias("t"), F.col("x.w").alias("w"))
    cut = lambda c: F.slice(c, F.col("j") + 1, F.lit(WINDOW))
    w = w.select("item_id", "j", "t", "w", cut(F.col("own")).alias("own"),
                 F.transform(cut(F.col("words")), lambda x: x.isin(*SLOTS)).alias("slot"))
    own = F.struct(F.lit(True).alias("plain"), F.col("w").alias("h"))
    template = F.struct(F.lit(False).alias("plain"), F.col("t").alias("h"))
    enough = F.size(F.filter("slot", lambda x: ~x)) >= LITERALS
    keys = F.explode(F.when(enough, F.array(own, template)).otherwise(F.array(own))).alias("k")
    return w.select("item_id", "j", "w", "own", "slot", keys).select("item_id", "j", "k.plain", "k.h", "w", "own", "slot")


def _counts(t: str, w: str) -> list[Column]:
    """How many templates, and how many windows."""
    return [F.size(F.collect_set(F.when(~F.col("plain"), F.col("h")))).alias(t), F.size(F.collect_set("w")).alias(w)]


def _rarest(keys: DataFrame, totals: DataFrame) -> DataFrame:
    """(item_id, h): the hashes under which each item's rarest windows, and its rarest templates,
    are found, as many as may be missing and one more."""
    shared = keys.join(keys.groupBy("h").agg(F.countDistinct("item_id").alias("n")), "h").join(totals, "item_id")
    least = lambda n: F.col(n) - F.ceil(F.lit(SHARE) * F.col(n)) + 1
    windows = shared.groupBy("item_id", "w", "all_w").agg(F.max("n").alias("n"), F.collect_set("h").alias("h"))
    windows = windows.withColumn("place", F.row_number().over(Window.partitionBy("item_id").orderBy("n", "w")))
    templates = shared.filter("not plain").select("item_id", "h", "n", "all_t").distinct()
    templates = templates.withColumn("place", F.row_number().over(Window.partitionBy("item_id").orderBy("n", "h")))
    return (windows.filter(F.col("place") <= least("all_w")).select("item_id", F.explode("h").alias("h"))
            .union(templates.filter(F.col("place") <= least("all_t")).select("item_id", "h")).distinct())


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", item_id: str = "item_id",
               text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, n_consistent, kind, text_hash): documents that hold a
    benchmark item; kind is exact or reparameterised; text_hash is xxhash64 of the text (null:
    empty)."""
    ensure_checkpoint_dir(docs.sparkSession)
    items = _item_windows(benchmark, item_id, text).checkpoint()
    keys = items.select("item_id", "plain", "h", "w").distinct()
    totals = keys.groupBy("item_id").agg(*_counts("all_t", "all_w"))
    small = items.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    sized = F.broadcast if small else (lambda df: df)
    short = sorted(r["n"] for r in items.select(F.size("own").alias("n")).filter(F.col("n") < WINDOW).distinct().collect())
    share = F.lit(SHARE)

    # One pass over the texts; only windows that some item holds go on, each once for equal rows.
    doc, t = ["k1", "k2"], F.coalesce(F.col(text).cast("string"), F.lit(""))
    docs = docs.select(F.xxhash64(F.col(doc_id).isNull(), doc_id, t).alias("k1"), F.xxhash64(F.lit(8), F.col(doc_id).isNull(), doc_id, t).alias("k2"),
                       F.col(doc_id).alias("doc_id"), t.alias("text"))
    seen = _templates(docs, "text", [F.col("k1"), F.col("k2")]).select(*doc, _all_windows(short).alias("h"))
    held_by = seen.join(sized(items.select("h").distinct()), "h", "left_semi").distinct().checkpoint()
    some = held_by.join(sized(_rarest(keys, totals)), "h").select(*doc, "item_id").distinct()
    pairs = (held_by.join(sized(keys), "h").join(some, [*doc, "item_id"], "left_semi")
             .groupBy(*doc, "item_id").agg(*_counts("n_t", "n_w")).join(totals, "item_id")
             .filter(((F.col("all_t") > 0) & (F.col("n_t") >= share * F.col("all_t"))) | (F.col("n_w") >= share * F.col("all_w"))))
    pairs = pairs.checkpoint()

    # Their texts once more: where those windows lie.
    texts = docs.join(pairs.select(*doc).distinct(), doc, "left_semi")
    row = [*doc, "doc_id", F.xxhash64("text").alias("text_hash")]
    hits = _templates(texts, "text", row).select(*doc, "doc_id", "text_hash", "own", _all_windows(short, at=True).alias("x"))
    hits = hits.select(*doc, "doc_id", "text_hash", "x.i", "x.h", "own").join(sized(items.select("h").distinct()), "h", "left_semi")
    hits = hits.groupBy(*doc, "i", "h").agg(F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"),
                                            F.first(F.slice("own", F.col("i") + 1, F.lit(WINDOW))).alias("ours")).checkpoint()

    # The slots of those pairs alone: window against window.
    met = (hits.join(pairs.select(*doc, "item_id"), doc)
           .join(items.withColumnRenamed("own", "theirs"), ["item_id", "h"]))
    theirs = F.filter(F.zip_with("theirs", "slot", lambda x, s: F.when(s, x)), lambda x: x.isNotNull())
    ours = F.filter(F.zip_with("ours", "slot", lambda x, s: F.when(s, x)), lambda x: x.isNotNull())
    met = met.select(*doc, "item_id", "plain", "h", "w", (F.col("i") - F.col("j")).alias("shift"),
                     F.arrays_zip(theirs.alias("theirs"), ours.alias("ours")).alias("slots"))
    pair = [*doc, "item_id"]
    along = [*pair, "shift"]
    values = (met.filter("not plain").select(*along, F.explode("slots").alias("s")).distinct().groupBy(*along, "s.theirs")
              .agg(F.count("*").alias("n"), F.max(F.col("s.theirs") != F.col("s.ours")).alias("other")))
    lines = values.groupBy(*along).agg(F.max("n").alias("most"), F.max("other").alias("other"))
    # a window that the plain words meet has its own values, on whatever alignment
    window = (met.select(*along, "plain", "h", "w").distinct().join(lines, along, "left")
              .filter(F.col("plain") | (F.coalesce("most", F.lit(1)) == 1))
              .groupBy(*pair, "plain", "h", "w")
              .agg(F.min(~F.col("plain") & F.coalesce("other", F.lit(False))).alias("other"))
              .groupBy(*pair, "w")
              .agg(F.min("other").alias("other"), F.collect_set(F.when(~F.col("plain"), F.col("h"))).alias("t")))
    agreed = window.groupBy(*pair).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("t")))).alias("c_t"), F.count("*").alias("c_w"),
        F.max(F.col("other") & (F.size("t") > 0)).alias("other_t"), F.max("other").alias("other_w"))
    by_template = (F.col("all_t") > 0) & (F.col("n_t") >= share * F.col("all_t")) & (F.col("c_t") >= share * F.col("n_t"))
    out = (pairs.join(agreed, pair).withColumn("by_t", by_template)
           .filter(F.col("by_t") | (F.col("c_w") >= share * F.col("all_w"))))
    named = hits.groupBy(*doc).agg(F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"))
    one = lambda t, w, name: F.when(F.col("by_t"), F.col(t)).otherwise(F.col(w)).cast("long").alias(name)
    other = F.when(F.col("by_t"), F.col("other_t")).otherwise(F.col("other_w"))
    return out.join(named, doc).select(
        "doc_id", "item_id", one("all_t", "all_w", "n_windows"), one("n_t", "n_w", "n_matched"), one("c_t", "c_w", "n_consistent"),
        F.when(other, "reparameterised").otherwise("exact").alias("kind"), "text_hash")
