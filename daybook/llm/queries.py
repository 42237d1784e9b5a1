"""The corpus queries: each operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import ann, decontaminate, katz, lines, mixing, phrases, pii, quality, repeats, runs, simhash, toxicity, urls
from daybook.llm.text import or_empty

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixing.mix_plan(docs)
    return plan.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


ORACLE["op5_mix_sources"] = r"""
WITH docs AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, 3 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sizes),
levels AS (
  SELECT *, row_number() OVER caps AS cap_rank,
         CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
         / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM ranked
  WINDOW caps AS (ORDER BY cap / weight, source NULLS LAST),
         before AS (ORDER BY cap / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (
  SELECT arg_min(level, cap_rank) AS level FROM levels WHERE level <= cap / weight),
rates AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * chosen.level) AS target
  FROM levels, chosen),
planned AS (
  SELECT d.doc_id, d.size, r.source_size, r.target,
         CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
           / 4503599627370496.0 AS draw
  FROM docs d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size AS BIGINT) * copies AS taken, copies
FROM (SELECT *, CAST(floor(rate) AS BIGINT) + CAST(draw < rate - floor(rate) AS BIGINT) AS copies
      FROM planned)
"""


@query
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.judge(pages, urls.rules_frame(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE["op7_url_rules"] = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path,
       (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
       coalesce((SELECT arg_max(rule_verdict, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM parts
"""


def _fold(modulus: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))


def _labels(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col(name).alias("label"))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _fold(4) == 2
    model = quality.fit_quality(docs, _labels(spark, sf_dir, "quality").where(~held_out))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _fold(3) == 1
    model = toxicity.fit_toxicity(docs, _labels(spark, sf_dir, "toxic").where(~held_out))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.personal_data(docs)
    counts = ["n_email", "n_ip", "n_card", "n_phone"]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    text = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", text, "component_id")


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines, those dropped as repetitions, where the first copies are, and what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lines.drop_repeated_lines(docs)
    return found.select("doc_id", "n_lines", "n_dropped", "copies_of", F.sha2("text", 256).alias("kept_sha256"))


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found", "containment")


ORACLE["op2_decontaminate"] = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM documents),
item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM benchmark),
doc_shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
           THEN list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))
           WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS s
  FROM doc_words),
item_shingles AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5
           THEN list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))
           WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS s
  FROM item_words),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id)
SELECT d.doc_id, i.item_id, n_shingles, count(*) AS n_found,
       CAST(count(*) AS DOUBLE) / n_shingles AS containment
FROM doc_shingles d JOIN item_shingles i USING (s) JOIN sizes z ON z.item_id = i.item_id
GROUP BY d.doc_id, i.item_id, n_shingles
HAVING CAST(count(*) AS DOUBLE) / n_shingles >= 0.8
"""


@query
def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query
def op10_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = katz.scores(docs, _fold(10) != 0)
    return scored.select(
        "doc_id", (_fold(10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return phrases.collocations(docs, deal_by="doc_id")


ORACLE["op11_phrases"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ;:!?,' || chr(10) || chr(11) || chr(12) || chr(13) || chr(9),
                     'abcdefghijklmnopqrstuvwxyz......... '), '.')) AS piece
  FROM documents),
worded AS MATERIALIZED (
  SELECT lang, list_filter(string_split(piece, ' '), lambda w: w <> '') AS w FROM pieces),
counts AS MATERIALIZED (
  SELECT lang, phrase, words, count(*) AS f
  FROM (SELECT lang, n AS words,
               unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS phrase
        FROM worded, (VALUES (1), (2), (3), (4)) sizes(n))
  GROUP BY ALL),
known AS MATERIALIZED (SELECT * FROM counts WHERE f >= 30),
cand AS MATERIALIZED (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS w FROM known WHERE words > 1),
split AS MATERIALIZED (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand)),
heads AS MATERIALIZED (
  SELECT s.*, x.f AS l FROM split s JOIN known x ON x.lang || ' ' || x.phrase = s.lang || ' ' || s.head),
cuts AS (
  SELECT h.lang, h.phrase, h.a, h.k, h.l, y.f AS r,
         CAST(2000000 AS HUGEINT) * h.a // (CAST(h.l AS HUGEINT) + y.f) AS score
  FROM heads h JOIN known y ON y.lang || ' ' || y.phrase = h.lang || ' ' || h.tail),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[pos:pos + size - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, words - size + 2)) AS pos
        FROM (SELECT *, unnest(range(2, words)) AS size FROM cand WHERE words > 2))
  GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase)
  WHERE i.longer IS NULL OR CAST(100 AS HUGEINT) * i.longer < CAST(80 AS HUGEINT) * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE words = 1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _planted(texts: pd.Series, ids: pd.Series) -> pd.Series:
    """Every tenth text, by its id, goes on periodically from some word on."""

    def planted(text: str, of: str) -> str:
        h = zlib.crc32(of.encode())
        g, w = h // 10, text.encode("utf-8", "replace").split() if h % 10 == 0 else []
        if not w:
            return text
        n = len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join(w[:a] + [w[a + i % p] for i in range(n - a)]).decode()

    return pd.Series([planted(t, i) for t, i in zip(texts, ids, strict=True)], dtype=object)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    planted = F.pandas_udf(_planted, "string")(or_empty(F.col("text")), id_text)
    found = runs.with_runs(docs.withColumn("text", planted))
    longest = F.array_sort(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("key"), r["start"], r["period"], r["length"]))
    )
    lines_ = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = F.col("top")
    return found.withColumn("top", F.get(longest, F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines_, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op13_repeated_passages"] = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS MATERIALIZED (
  SELECT id, pos, array_to_string(w[pos:pos + 34], ' ') AS seq
  FROM (SELECT id, w, unnest(range(1, len(w) - 33)) AS pos FROM docs)),
repeated AS (SELECT id, pos FROM windows WHERE seq IN (SELECT seq FROM windows GROUP BY seq HAVING count(*) > 1)),
gone AS (
  SELECT id, list(DISTINCT word) AS words
  FROM (SELECT id, unnest(range(pos, pos + 35)) AS word FROM repeated) GROUP BY id),
judged AS (
  SELECT d.doc_id, d.w, len(d.w) AS n_words, coalesce(len(g.words), 0) AS n_removed,
         CASE WHEN g.id IS NULL THEN range(1, len(d.w) + 1)
              ELSE list_sort(list_filter(range(1, len(d.w) + 1), lambda i: NOT list_contains(g.words, i))) END AS stay
  FROM docs d LEFT JOIN gone g ON g.id = d.id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_transform(stay, lambda i: w[i]), ' '), '')) AS kept_sha256
FROM judged
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
