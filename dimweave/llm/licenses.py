"""License scans by diagonal voting, DataFrame operations only.

1. Every run of ``GRAM`` words of a text is joined by its hash, and by its words, with the
   positions of the templates that hold it (base phrases, notices and license texts).  Runs whose
   hash no template has are dropped inside the text's own array, before any row is made of them.
2. A hit votes for its diagonal, the difference between its place in the text and in the
   template.  A diagonal that all runs of a base phrase vote for is a place of the phrase.
3. Diagonals of one template at most ``REACH`` apart are merged: inserted and lost words move
   the rest of a notice to a neighbouring diagonal.
4. A merged span is verified: it must cover ``SHARE`` of the template's words, and be no longer
   than the template by more than its half and ``REACH`` words.  Of spans that overlap, as those
   of two versions of one notice, the ones with the largest share give their templates' labels.
   A text's score is the largest share of a template that it covers; a base phrase covers all of
   itself.

Words are as in the base patterns; lower-casing letters beyond A-Z changes neither their number
nor whether a template's words, all of ASCII letters and digits, are met, but for the Kelvin
sign, which counts as k in templates and not in the base phrases, which have no k.

Equal texts are voted for once: hits are sets by a 128-bit hash of the text.

Cases: null and empty texts have no words; texts of fewer than ``GRAM`` words have no hits;
repeated rows give equal rows; an empty table gives an empty result; ids don't matter, and other
columns neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimweave.llm.license_texts import PHRASES, TEXTS
from dimweave.session import ensure_checkpoint_dir

GRAM, REACH, SHARE = 3, 8, 0.8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Distinct runs of the templates that are looked up inside the array; beyond that all runs of
#: a text become rows before the join.
LOOKED_UP = 50_000
#: Template positions that may be broadcast; above that the join is shuffled.
BROADCAST_POSITIONS = 500_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), 0)


def _grams(words: Column) -> Column:
    """A hash of each run of GRAM words."""
    n = F.size(words)
    at = lambda i: [F.get(words, i + k) for k in range(GRAM)]
    found = F.transform(F.sequence(F.lit(0), n - GRAM), lambda i: F.struct(i.alias("at"), F.xxhash64(*at(i)).alias("h")))
    return F.when(n >= GRAM, found).otherwise(F.array().cast("array<struct<at:int,h:bigint>>"))


def templates(spark: SparkSession, phrases: list[tuple[str, str]], texts: list[tuple[str, str]]) -> DataFrame:
    """(template, label, phrase, words) of the templates that have GRAM words."""
    rows = [(i, label, phrase, text) for i, (label, text, phrase) in enumerate(
        [(*p, True) for p in phrases] + [(*t, False) for t in texts])]
    return (spark.createDataFrame(rows, "template int, label string, phrase boolean, text string")
            .select("template", "label", "phrase", words_of(F.col("text")).alias("words")).filter(F.size("words") >= GRAM))


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, texts: list[tuple[str, str]] = TEXTS, *,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, base (places of the phrases: start, end,
    label) and spans (verified spans of the texts: start, end, label, share), and score.  Every
    label has a template of at least GRAM words."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    known = templates(spark, phrases, texts)
    positions = known.select("template", "label", "phrase", F.size("words").alias("size"), "words", F.explode(_grams(F.col("words"))).alias("g"))
    positions = positions.select("template", "label", "phrase", "size", F.col("g.at").alias("t_at"), F.col("g.h").alias("h"),
                                 F.slice("words", F.col("g.at") + 1, F.lit(GRAM)).alias("own"))
    held = [r["h"] for r in positions.select("h").distinct().limit(LOOKED_UP + 1).collect()]
    some = positions.count() <= BROADCAST_POSITIONS
    # one pass over the texts: their words, and the runs that some template holds
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(11), t).alias("k2"), words_of(t).alias("words"))
    found = _grams(F.col("words"))
    if len(held) <= LOOKED_UP:
        found = F.filter(found, lambda g: g["h"].isin(held))
    found = F.transform(found, lambda g: F.struct(g["at"].alias("at"), g["h"].alias("h"), F.slice("words", g["at"] + 1, F.lit(GRAM)).alias("w")))
    rows = rows.select("doc_id", "k1", "k2", F.size("words").cast("long").alias("n_words"), found.alias("hits")).checkpoint()

    hits = rows.select("k1", "k2", F.explode("hits").alias("x")).select("k1", "k2", "x.at", "x.h", "x.w")
    met = hits.join(F.broadcast(positions) if some else positions, "h").filter(F.col("w") == F.col("own"))
    line = ["k1", "k2", "template"]
    lines = (met.groupBy(*line, (F.col("at") - F.col("t_at")).alias("diagonal"))
             .agg(F.sort_array(F.collect_set("t_at")).alias("votes"), F.first("label").alias("label"),
                  F.first("phrase").alias("phrase"), F.first("size").alias("size")))
    base = (lines.filter(F.col("phrase") & (F.size("votes") == F.col("size") - (GRAM - 1)))
            .select("k1", "k2", F.lit(True).alias("phrase"), "label", F.col("diagonal").alias("start"),
                    (F.col("diagonal") + F.col("size")).alias("end"), F.lit(1.0).alias("share"), F.lit(True).alias("right")))
    order = Window.partitionBy(*line).orderBy("diagonal")
    begins = (F.col("diagonal") - F.lag("diagonal").over(order) > REACH).cast("int")
    merged = (lines.filter(~F.col("phrase")).withColumn("begins", F.coalesce(begins, F.lit(0)))
              .withColumn("part", F.sum("begins").over(order))
              .groupBy(*line, "part").agg(
                  F.sort_array(F.array_distinct(F.flatten(F.collect_list("votes")))).alias("votes"), F.first("label").alias("label"),
                  F.first("size").alias("size"), F.min(F.col("diagonal") + F.element_at("votes", 1)).alias("start"),
                  F.max(F.col("diagonal") + F.element_at("votes", -1) + GRAM).alias("end")))
    # template words under a run that voted: up to the next run's first word, GRAM at most
    steps = F.zip_with(F.slice("votes", F.lit(1), F.size("votes") - 1), F.slice("votes", F.lit(2), F.size("votes") - 1),
                       lambda a, b: F.least(b - a, F.lit(GRAM)))
    covers = F.aggregate(steps, F.lit(GRAM), lambda a, x: a + x)
    share = (covers / F.col("size")).alias("share")
    right = (covers >= SHARE * F.col("size")) & (F.col("end") - F.col("start") <= 1.5 * F.col("size") + REACH)
    spans = merged.select("k1", "k2", F.lit(False).alias("phrase"), "label", "start", "end", share, right.alias("right"))
    spans = _best_of_overlapping(spans)
    place = F.struct("start", "end", "label", "share")
    each = base.unionByName(spans).groupBy("k1", "k2").agg(
        F.sort_array(F.collect_list(F.when(F.col("phrase"), place))).alias("base"),
        F.sort_array(F.collect_list(F.when(~F.col("phrase") & F.col("right"), place))).alias("spans"), F.max("share").alias("score"))
    with_hits = rows.filter(F.size("hits") > 0).select("doc_id", "k1", "k2", "n_words").join(each, ["k1", "k2"], "left")
    without = rows.filter(F.size("hits") == 0).select("doc_id", "n_words")
    none = F.array().cast("array<struct<start:int,end:int,label:string,share:double>>")
    out = with_hits.select("doc_id", "n_words", "base", "spans", "score").unionByName(without, allowMissingColumns=True)
    return out.select("doc_id", "n_words", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"),
                      F.coalesce("score", F.lit(0.0)).alias("score"))


def _best_of_overlapping(spans: DataFrame) -> DataFrame:
    """``right`` only where no span of the same run of overlapping right spans has a larger share."""
    text = Window.partitionBy("k1", "k2", "right").orderBy("start", "end", "label")
    before = F.max("end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.coalesce((F.col("start") >= F.col("before")).cast("int"), F.lit(0))).over(text)
    spans = spans.withColumn("before", before).withColumn("run", run)
    best = F.max("share").over(Window.partitionBy("k1", "k2", "right", "run"))
    return spans.withColumn("right", F.col("right") & (F.col("share") == best)).drop("before", "run")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score."""
    names = lambda c: F.transform(c, lambda s: s["label"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    n = F.size("base").cast("long")
    start = lambda i: F.when(n > 0, F.try_element_at("base", F.lit(i))["start"].cast("long"))
    return found.select("doc_id", "n_words", n.alias("n_base"), start(1).alias("first_word"), start(-1).alias("last_word"),
                        joined(names("base")).alias("base_labels"), joined(F.concat(names("base"), names("spans"))).alias("labels"),
                        F.col("score"))
