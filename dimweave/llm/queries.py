"""The registered queries of the llm folder: each applies one operator, with its production
parameters, to a whole table; ``ORACLE_SQL`` holds DuckDB SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm import (decontamination, jaccard, language_model, license_texts, licenses, oracles, packing, sanitise, substring,
                          suffix, topk, toxicity, trie, turn_repair, urls)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeated_words(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.digest(sanitise.find_spans(table(spark, sf_dir, "documents")))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), id="vec_id", vector="embedding", k=5)


OP4_SQL = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, unnest(e) AS w, generate_subscripts(e, 1) AS t FROM v),
ids AS (SELECT vec_id FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.w * c.w) AS score
  FROM p q JOIN p c ON c.t = q.t AND c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, CAST(score AS BIGINT) AS score
FROM s QUALIFY rank <= 5"""


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix.remove_later_copies(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), holdout=(4, 2))
    held = F.coalesce(toxicity.crc_part(F.col("doc_id"), 4) == 2, F.lit(False))
    # the text leaves the task again only as doc_id, score and prediction
    return toxicity.score(docs, model, keep=["doc_id"], evidence=False).select("doc_id", held.alias("held_out"), "score", "predicted")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return (urls.judge_urls(pages, urls.HOST_RULES, urls.PATTERNS)
            .select("page_id", "host", "path", "rule", "verdict"))


def _op9_sql() -> str:
    parsed = [urls.parse_pattern(p) for p in urls.PATTERNS]
    hit = {v: " OR ".join(f"regexp_matches(low, '{p.regex}')" for p in parsed if p.verdict == v) for v in ("allow", "block")}
    upper, lower = urls.UPPER, urls.LOWER
    fits = ",\n  ".join(
        f"""CASE WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')
    THEN {{'n': {len(r.name)}, 'rule': '{r.name}', 'v': '{r.verdict}'}} END""" for r in urls.HOST_RULES)
    return f"""WITH u AS (
  SELECT page_id, url, translate(url, '{upper}', '{lower}') AS low,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, low, translate(raw, '{upper}', '{lower}') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, list_max(list_filter([{fits}], lambda x: x IS NOT NULL)) AS best FROM p)
SELECT page_id, host, path, best.rule AS rule,
  coalesce(best.v, CASE WHEN {hit['allow']} THEN 'allow' WHEN {hit['block']} THEN 'block' END, 'allow') AS verdict
FROM r"""


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def _op11_sql() -> str:
    templates = [(i, *row) for i, row in enumerate([(n, "true", t) for n, t in license_texts.PHRASES]
                                                   + [(n, "false", t) for n, t in license_texts.TEXTS])]
    values = ",\n  ".join(f"({i}, '{n}', {p}, '{t}')" for i, n, p, t in templates)
    return f"""WITH tpl(template, label, phrase, txt) AS (VALUES
  {values}),
tw AS (SELECT template, label, phrase, string_split(txt, ' ') AS w FROM tpl),
tp AS (SELECT template, label, phrase, w, len(w) AS size, unnest(range(0, len(w) - 2)) AS t_at FROM tw),
tg AS (SELECT *, w[t_at + 1] || ' ' || w[t_at + 2] || ' ' || w[t_at + 3] AS g FROM tp),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
dp AS (SELECT rid, w, unnest(range(0, greatest(len(w) - 2, 0))) AS pos FROM d),
dg AS (SELECT rid, pos, w[pos + 1] || ' ' || w[pos + 2] || ' ' || w[pos + 3] AS g FROM dp),
votes AS (SELECT DISTINCT rid, template, label, phrase, size, pos - t_at AS diagonal, t_at FROM dg JOIN tg USING (g)),
diagonals AS (SELECT rid, template, label, phrase, size, diagonal, count(*) AS n, min(t_at) AS first, max(t_at) AS last
  FROM votes GROUP BY ALL),
base AS (SELECT rid, label, diagonal AS start, diagonal + size AS stop, 1.0::DOUBLE AS share FROM diagonals WHERE phrase AND n = size - 2),
steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) > {licenses.REACH}
    THEN 1 ELSE 0 END AS begins FROM diagonals WHERE NOT phrase),
parts AS (SELECT *, sum(begins) OVER (PARTITION BY rid, template ORDER BY diagonal) AS part FROM steps),
extent AS (SELECT rid, template, part, label, size, min(diagonal + first) AS start, max(diagonal + last + 3) AS stop FROM parts GROUP BY ALL),
under AS (SELECT DISTINCT v.rid, v.template, p.part, v.t_at + u.k AS word
  FROM votes v JOIN parts p USING (rid, template, diagonal) CROSS JOIN (VALUES (0), (1), (2)) u(k)),
covered AS (SELECT rid, template, part, count(*) AS n FROM under GROUP BY ALL),
spans AS (SELECT rid, label, start, stop, n / size AS share,
    n >= {licenses.SHARE} * size AND stop - start <= 1.5 * size + {licenses.REACH} AS good FROM extent JOIN covered USING (rid, template, part)),
chain AS (SELECT *, max(stop) OVER (PARTITION BY rid ORDER BY start, stop, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM spans WHERE good),
run AS (SELECT *, sum(CASE WHEN start >= before THEN 1 ELSE 0 END)
    OVER (PARTITION BY rid ORDER BY start, stop, label ROWS UNBOUNDED PRECEDING) AS run FROM chain),
best AS (SELECT rid, label FROM run QUALIFY share = max(share) OVER (PARTITION BY rid, run)),
places AS (SELECT rid, count(*) AS n, min(start) AS first_word, max(start) AS last_word FROM base GROUP BY rid),
own AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT rid, label FROM base) GROUP BY rid),
every AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels
  FROM (SELECT rid, label FROM base UNION SELECT rid, label FROM best) GROUP BY rid),
score AS (SELECT rid, max(share) AS score FROM (SELECT rid, share FROM base UNION ALL SELECT rid, share FROM spans) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(places.n, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(own.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
  CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN places USING (rid) LEFT JOIN own USING (rid) LEFT JOIN every USING (rid) LEFT JOIN score USING (rid)"""


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.rebuild(trie.turns_of(table(spark, sf_dir, "conversations")), groups=5, parts=9)
    return trie.prefix_trie(turns).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                          "ends_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.digest(turn_repair.repair(turn_repair.damage(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_personal_data": op2_personal_data,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_topk": op4_topk,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_language_model": op7_language_model,
    "op8_decontamination": op8_decontamination,
    "op9_url_filters": op9_url_filters,
    "op10_packing": op10_packing,
    "op11_license_scans": op11_license_scans,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLE_SQL: dict[str, str] = {
    "op4_topk": OP4_SQL,
    "op9_url_filters": _op9_sql(),
    "op11_license_scans": _op11_sql(),
    "op12_conversation_trie": oracles.OP12,
    "op13_conversation_repair": oracles.op13(),
}
