"""One query per operator, over the whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from odflow.llm import mixing
from odflow.llm import quality_rules as rules
from odflow.llm.decontaminate import contamination
from odflow.llm.html_extract import extract_main_text
from odflow.llm.licenses import scan_licenses
from odflow.llm.near_duplicates import near_duplicates
from odflow.llm.pii import KINDS, pseudonymise
from odflow.llm.quality_model import quality_scores
from odflow.llm.simhash import simhash_groups
from odflow.llm.spelling import spelling_forms
from odflow.llm.token_alignment import align_tokens
from odflow.llm.token_counts import token_counts
from odflow.llm.toxicity import toxicity_scores


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), size=3, distance=2)
    return groups.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, size=2, percent=80)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = [F.array_join(c, ",").alias(c) for c in ("licenses", "leftovers")]
    return scan_licenses(docs).select("doc_id", *joined, "n_sentences", F.size("licenses").cast("long").alias("n_licenses"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def op5_quality_by_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op6_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, keep_text=False).select("doc_id", "size", "source_size", "target", "taken")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    valid = F.filter("pii", lambda x: x["was_valid"])
    one_kind = lambda k: lambda x: x["was_valid"] & (x["kind"] == k)
    counts = [F.size(F.filter("pii", one_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return done.select("doc_id", "text", F.coalesce(F.size(valid), F.lit(0)).cast("long").alias("n_replaced"), *counts)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = rules.quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n)),
m AS (SELECT dw.rid, dw.p, dw.n, bw.item_id FROM dw JOIN bw USING (n, win)),
pos AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM m) GROUP BY rid),
it AS (SELECT rid, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM m GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN it USING (rid)
"""

OP1_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  WHERE 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
r AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other),
c AS (SELECT doc_id, min(other) AS low FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id,
       coalesce(c.low, d.doc_id) >= d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _seats(parties: str, parent: str, key: str, votes: str, seats: str, result: str) -> str:
    """SQL of ``parties`` with ``result``: seats by highest quotients votes / (2k + 1), one row per quotient."""
    return f"""
  SELECT p.* EXCLUDE (pid), coalesce(n, 0) AS {result} FROM (SELECT *, row_number() OVER () AS pid FROM {parties}) p LEFT JOIN (
    SELECT pid, count(*) AS n FROM (
      SELECT pid, {seats}, row_number() OVER (PARTITION BY {parent} ORDER BY v / (2 * k + 1) DESC, {key}, k) AS place FROM (
        SELECT *, CAST({votes} AS DOUBLE) AS v, unnest(range(0, CAST({seats} AS BIGINT))) AS k
        FROM (SELECT *, row_number() OVER () AS pid FROM {parties}) WHERE {votes} > 0))
    WHERE place <= {seats} GROUP BY pid) USING (pid)"""


OP6_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS rank FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, list_extract([5.0, 2.0, 1.0], i % 3 + 1)::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most FROM src),
l AS (SELECT *, row_number() OVER r AS k, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w WINDOW r AS (ORDER BY most / weight, source NULLS LAST)),
t AS (SELECT source, source_size, least(most, coalesce((SELECT level FROM l WHERE level * weight <= most ORDER BY k LIMIT 1) * weight, most)) AS target FROM l),
q AS (SELECT *, greatest(1, CAST(ceil(source_size / {mixing.SHARD_WORDS}) AS BIGINT)) AS shards, CAST(round(sum(target) OVER () / {mixing.BLOCK_WORDS}) AS BIGINT) AS all_blocks, 0 AS root FROM t),
sq AS ({_seats("q", "root", "source NULLS LAST", "target", "all_blocks", "source_blocks")}),
pl AS (SELECT d.source, CAST('0x' || substr(rank, 17, 8) AS BIGINT) % shards AS shard, rank, CAST(sum(size) AS BIGINT) AS size
       FROM d JOIN sq ON d.source IS NOT DISTINCT FROM sq.source GROUP BY ALL),
sh AS (SELECT source, shard, shard // {mixing.GROUP} AS grp, CAST(sum(size) AS BIGINT) AS shard_size FROM pl GROUP BY ALL),
g AS (SELECT x.*, sq.source_blocks FROM (SELECT source, grp, CAST(sum(shard_size) AS BIGINT) AS group_size FROM sh GROUP BY ALL) x
      JOIN sq ON x.source IS NOT DISTINCT FROM sq.source),
gq AS ({_seats("g", "source", "grp", "group_size", "source_blocks", "group_blocks")}),
s AS (SELECT sh.*, gq.group_blocks FROM sh JOIN gq ON sh.source IS NOT DISTINCT FROM gq.source AND sh.grp = gq.grp),
ss AS ({_seats("s", "source, grp", "shard", "shard_size", "group_blocks", "blocks")}),
c AS (SELECT *, CASE WHEN shard_size > 0 THEN words // shard_size ELSE 0 END AS copies, CASE WHEN shard_size > 0 THEN words % shard_size ELSE 0 END AS rest
      FROM (SELECT *, CAST(least(blocks * {mixing.BLOCK_WORDS}, 2 * shard_size) AS BIGINT) AS words FROM ss)),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pl),
e AS (SELECT c.source, c.shard, c.copies, b.rank AS end_rank, b.size AS end_size, c.rest - b.before AS end_words FROM b JOIN c
      ON b.source IS NOT DISTINCT FROM c.source AND b.shard = c.shard WHERE before <= rest AND rest < before + size)
SELECT d.doc_id, d.size, sq.source_size, sq.target,
  CAST(coalesce(e.copies * d.size + CASE WHEN d.rank < e.end_rank THEN d.size
    WHEN d.rank = e.end_rank THEN floor(CAST(d.size * e.end_words AS DOUBLE) / e.end_size) ELSE 0 END, 0) AS BIGINT) AS taken
FROM d JOIN sq ON d.source IS NOT DISTINCT FROM sq.source
LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source AND CAST('0x' || substr(d.rank, 17, 8) AS BIGINT) % sq.shards = e.shard
"""


def _op9_sql() -> str:
    share = "CASE WHEN {1} > 0 THEN CAST({0} AS DOUBLE) / {1} ELSE 0 END"
    metrics = {"symbol_share": ("n_symbols", "word_chars"), "upper_share": ("n_upper", "word_chars"),
               "mark_share": ("n_marks", "word_chars"), "repeat_share": ("n_repeat_words", "n_words")}
    columns = ", ".join(f"{share.format(*v)} AS {k}" for k, v in metrics.items())
    count = "length(t) - length(translate(t, '{}', ''))".format
    alpha = rules.ALPHA / len(metrics)
    ladder = ", ".join(map(str, rules.LADDER))
    tests = "\nUNION ALL\n".join(
        f"SELECT lang, '{m}' AS metric, c, row_number() OVER (PARTITION BY lang ORDER BY c DESC) AS step, count(*) AS n, "
        f"count(*) FILTER (WHERE {m} > c) AS k FROM held, (SELECT unnest([{ladder}]) AS c) GROUP BY lang, c" for m in metrics)
    cuts = " AND ".join(f"coalesce(NOT {m} > (SELECT cut FROM cuts WHERE cuts.lang IS NOT DISTINCT FROM x.lang AND metric = '{m}'), true)" for m in metrics)
    return rf"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
       lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
runs AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM runs) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY rid),
lin AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
        WHERE regexp_matches(l, '[^ 	-
]') GROUP BY rid),
m AS (SELECT d.rid, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        {count(rules.SYMBOLS)} AS n_symbols, coalesce(lin.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        {count(rules.UPPER)} AS n_upper, {count(rules.MARKS)} AS n_marks
      FROM d LEFT JOIN lin USING (rid) LEFT JOIN rep USING (rid)),
x AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {columns} FROM m),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT x.* FROM x, crc WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)
         AND xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda a: CAST(ascii(a) AS BIGINT))),
                 lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 3 <> 1),
tests AS ({tests}),
tails AS (SELECT *, CASE WHEN k >= n * {alpha} THEN 1 ELSE list_sum(list_transform(range(0, k + 1),
            lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({alpha}) + (n - j) * ln(1 - {alpha})))) END
            <= {rules.DELTA} / ((SELECT count(DISTINCT coalesce(lang, '?')) FROM held) * {len(metrics)}) AS ok FROM tests),
cuts AS (SELECT lang, metric, min(c) AS cut FROM (SELECT *, bool_and(ok) OVER (PARTITION BY lang, metric ORDER BY step) AS run FROM tails) WHERE run GROUP BY lang, metric)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {cuts} AS kept FROM x
"""


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_near_duplicates": op1_near_duplicates,
    "op2_toxicity": op2_toxicity,
    "op3_license_scan": op3_license_scan,
    "op4_main_text": op4_main_text,
    "op5_quality_by_compression": op5_quality_by_compression,
    "op6_mix_to_weights": op6_mix_to_weights,
    "op7_token_counts": op7_token_counts,
    "op8_pii_pseudonyms": op8_pii_pseudonyms,
    "op9_quality_rules": op9_quality_rules,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_simhash_groups": op11_simhash_groups,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLE = {
    "op6_mix_to_weights": OP6_SQL,
    "op9_quality_rules": _op9_sql(),
    "op1_near_duplicates": OP1_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
}
