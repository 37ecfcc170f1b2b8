"""The registered queries over the thirteen operators, and their DuckDB statements where SQL can say them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from ledgermill.llm import (
    decontam, filter_audit, lang_id, line_dedup, lm_score, mixing, periodic_runs, piece_codec, quality, sharding, simhash,
    token_counts, token_files,
)
from ledgermill.llm.common import documents, learnable

SHARDS = 8
BYTE_BPE = "byte_bpe_50k.tiktoken"
MULTI_BPE, MULTI_IDS = "byte_bpe_multi_50k.tiktoken", 50_256
WORD_BPE = "word_bpe_49k.json"  # drops white space, so words are encoded one by one
PIECES = "piece_bpe_32k.model"
END = 1


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every context limit keeps of all documents."""
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the files that its ids were written to."""
    folder = token_files.token_folder(spark)
    path = public_tokenizers.path(WORD_BPE)
    token_files.write_token_files(documents(spark, sf_dir), folder, path, by_word=True, end_id=END)
    return token_files.document_digests(spark, folder)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and for every copy its shard and its place in the shard's shuffle."""
    report = mixing.mix_report(documents(spark, sf_dir), shards=SHARDS)
    return report.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards"),
        F.array_join(F.col("turns").cast("array<string>"), ",").alias("turns"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    docs = documents(spark, sf_dir)
    data = F.coalesce("text", F.lit("")).cast("binary")
    slim = docs.select("doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    placed = sharding.shard_rows(slim, shards=SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, with the region and its edit distance."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontam.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", F.col("m.item").alias("item_id"), F.col("m.distance").alias("distance"),
        F.col("m.start").alias("start"), F.col("m.end").alias("end"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that stand earlier."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs, least_words=20)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.components(documents(spark, sf_dir), shingle=3, distance=3)
    return found.select("doc_id", simhash.hex64(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict on every document."""
    found = quality.judge(documents(spark, sf_dir))
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select(*base, "quality")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document; a seventh is held out from learning."""
    learn = learnable("doc_id", 7, 2)
    docs = documents(spark, sf_dir)
    path, pattern = public_tokenizers.path(MULTI_BPE), public_tokenizers.PATTERN
    found = lm_score.score_documents(docs, path, pattern, vocabulary=MULTI_IDS, learn=learn)
    return found.select(
        "doc_id", (~learn).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a fifth is held out from learning."""
    learn = learnable("doc_id", 5, 0)
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = lang_id.identify_language(docs, learn=learn)
    return found.select("doc_id", (~learn).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to piece ids and decoded from them."""
    found = piece_codec.round_trip(documents(spark, sf_dir), public_tokenizers.path(PIECES))
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, a tenth of which are made to repeat words."""

    def rewrite(words: list[bytes], doc_id: int | None) -> list[bytes]:
        return words if doc_id is None else periodic_runs.echoed(words, zlib.crc32(str(doc_id).encode()))

    found = periodic_runs.collapse_runs(documents(spark, sf_dir), rewrite=rewrite)
    # a/b > c/d as ad > cb, so that no quotient is rounded.
    top = F.expr(
        "array_sort(runs, (x, y) -> CASE WHEN x.length * y.period > y.length * x.period THEN -1 "
        "WHEN x.length * y.period < y.length * x.period THEN 1 WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1 "
        "WHEN x.period < y.period THEN -1 WHEN x.period > y.period THEN 1 ELSE 0 END)"
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", F.get(top, F.lit(0))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every language, in all orders."""
    return filter_audit.audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_token_files": op2_token_files,
    "op3_mixing": op3_mixing,
    "op4_sharding": op4_sharding,
    "op5_decontamination": op5_decontamination,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_lm_score": op9_lm_score,
    "op10_language_id": op10_language_id,
    "op11_piece_codec": op11_piece_codec,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_filter_audit": op13_filter_audit,
}

def _dealt(level: int) -> str:
    """One level of the tree: the top of every urn, in hashed order, goes to its left part."""
    return f""", urn{level + 1} AS (
  SELECT source, block, pass, upto, CASE WHEN nth <= mine THEN low ELSE middle END AS low,
    CASE WHEN nth <= mine THEN greatest(middle, low + 1) ELSE high END AS high
  FROM (
    SELECT *, (low + high) // 2 AS middle, floor(count(*) OVER (PARTITION BY low) * ((low + high) // 2 - low)::DOUBLE / (high - low)) AS mine,
      row_number() OVER (PARTITION BY low ORDER BY ord, source NULLS FIRST, block, pass) AS nth
    FROM (
      SELECT *, CAST('0x' || substr(md5('1:urn:{level}:' || coalesce(source, chr(0)) || ':' || block || ':' || pass), 1, 4) AS INTEGER) AS ord
      FROM urn{level}
    ) x
  ) y
)"""


ORACLE_SQL: dict[str, str] = {
    # The same cells, cuts, urns and turns by md5; the level of targets by comparing sources with each other.
    "op3_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         coalesce(CAST(doc_id AS VARCHAR), md5(text), '') AS text_key,
         CAST('0x' || substr(md5('1:' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')), 1, 4) AS INTEGER) AS cell
  FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source
), whole AS (SELECT sum(source_size)::DOUBLE AS total FROM per_source
), levels AS (
  -- The level at which each source is full, and the level that the rest would reach were all fuller ones full.
  SELECT p.*, 3.0 * source_size AS most,
    (total - coalesce((SELECT sum(3.0 * q.source_size) FROM per_source q WHERE 3.0 * q.source_size / q.weight < 3.0 * p.source_size / p.weight), 0))
      / (SELECT sum(q.weight) FROM per_source q WHERE 3.0 * q.source_size / q.weight >= 3.0 * p.source_size / p.weight) AS level
  FROM per_source p, whole
), filled AS (SELECT *, most / weight <= level AS capped FROM levels
), targets AS (
  SELECT source, source_size, CASE WHEN capped THEN most::DOUBLE ELSE
      weight * (SELECT total - coalesce((SELECT sum(most) FROM filled WHERE capped), 0) FROM whole)::DOUBLE
      / (SELECT sum(weight) FROM filled WHERE NOT capped)::DOUBLE END AS target
  FROM filled
), passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least(3, floor(target / source_size)) AS INT) ELSE 0 END AS passes,
    CAST(greatest(1, least(65536, round(source_size::DOUBLE / total * 2048))) AS INT) AS blocks
  FROM targets, whole
), placed AS (
  SELECT s.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest, (s.cell * p.blocks) // 65536 AS block
  FROM sized s JOIN passes p ON p.source IS NOT DISTINCT FROM s.source
), blocks AS (
  SELECT source, block, rest, passes, sum(size) AS size,
    CAST('0x' || substr(md5('1:turn:' || coalesce(source, chr(0)) || ':' || block), 1, 4) AS INTEGER) AS turn
  FROM placed GROUP BY ALL
), in_turn AS (
  SELECT source, block, passes, size, rest - (sum(size) OVER (PARTITION BY source ORDER BY turn, block) - size) AS room FROM blocks
), cells AS (
  SELECT p.source, p.block, p.cell, any_value(t.room) AS room,
    sum(sum(p.size)) OVER (PARTITION BY p.source, p.block ORDER BY p.cell) - sum(p.size) AS before, sum(p.size) AS size
  FROM placed p JOIN in_turn t ON t.source IS NOT DISTINCT FROM p.source AND t.block = p.block
  WHERE t.room > 0 AND t.room < t.size GROUP BY p.source, p.block, p.cell
), cut AS (SELECT source, block, max(cell) AS upto FROM cells WHERE before + size / 2 <= room GROUP BY ALL
), urn0 AS (
  SELECT source, block, unnest(range(passes + CASE WHEN room >= size AND size > 0 THEN 1 ELSE 0 END)) AS pass, 65536 AS upto, 0 AS low, 8 AS high
  FROM in_turn
  UNION ALL
  SELECT t.source, t.block, t.passes, c.upto + 1, 0, 8 FROM in_turn t JOIN cut c ON c.source IS NOT DISTINCT FROM t.source AND c.block = t.block
)""" + "".join(_dealt(level) for level in range(3)) + r""", copies AS (
  SELECT p.doc_id, p.cell, p.source, p.text_key, u.pass, u.low AS shard,
    CAST('0x' || substr(md5('1:shuffle:' || u.pass || ':' || p.text_key), 1, 15) AS BIGINT) AS turn
  FROM (SELECT DISTINCT doc_id, cell, source, block, text_key FROM placed) p
  JOIN urn3 u ON u.source IS NOT DISTINCT FROM p.source AND u.block = p.block AND p.cell < u.upto
), listed AS (
  SELECT doc_id, source, text_key, count(*) AS n, string_agg(shard, ',' ORDER BY pass) AS shards, string_agg(turn, ',' ORDER BY pass) AS turns
  FROM copies GROUP BY ALL
)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(p.size * coalesce(c.n, 0) AS BIGINT) AS taken,
  coalesce(c.shards, '') AS shards, coalesce(c.turns, '') AS turns
FROM placed p LEFT JOIN listed c ON c.doc_id IS NOT DISTINCT FROM p.doc_id AND c.source IS NOT DISTINCT FROM p.source AND c.text_key = p.text_key
""",
    # The rule itself instead of the method: all runs that grow from a line until they hold 20 words, either way.
    "op6_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS position
  FROM documents
), trimmed AS (
  SELECT doc_id, position, raw, trim(raw, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS line,
         len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS words
  FROM lines
), full_lines AS (
  SELECT *, row_number() OVER w AS seq, sum(words) OVER w AS upto, sum(words) OVER w - words AS before
  FROM trimmed WHERE words > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY position)
), runs AS (
  SELECT doc_id, seq AS first, max(seq) OVER w AS last, sum(words) OVER w AS held, 0 AS way, list(line) OVER w AS content
  FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING)
  UNION ALL
  SELECT doc_id, min(seq) OVER w, seq, sum(words) OVER w, 1, list(line) OVER w
  FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 19 PRECEDING AND CURRENT ROW)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY way, content ORDER BY doc_id, first) AS nth FROM runs WHERE held >= 20
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(first, last)) AS seq FROM placed WHERE nth > 1
), marked AS (
  SELECT t.doc_id, t.position, t.raw, g.seq IS NOT NULL AS gone
  FROM trimmed t LEFT JOIN full_lines f USING (doc_id, position) LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.seq = f.seq
), joined AS (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY position) FILTER (NOT gone) AS text, count(*) AS n_lines,
         count(*) FILTER (gone) AS n_deleted
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(j.text, '') END AS text,
       coalesce(j.n_lines, 0) AS n_lines, coalesce(j.n_deleted, 0) AS n_deleted
FROM documents d LEFT JOIN joined j USING (doc_id)
""",
    # Every order and step against every part's masks, without diagrams; a bit a filter in masks and orders.
    "op13_filter_audit": r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), marked AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM texts
), scores AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM marked LEFT JOIN scores USING (doc_id) GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT '' AS filter_order, 0 AS step, 0 AS before, 0 AS bit
  UNION ALL
  SELECT filter_order || letter, step + 1, before + o.bit, l.bit FROM orders o JOIN letters l ON (o.before + o.bit) & l.bit = 0
), placed AS (
  -- Every order with the filter of each step and the bits of those before it.
  SELECT f.filter_order, s.step, s.before, s.bit
  FROM orders f JOIN orders s ON s.step >= 1 AND f.step = 5 AND s.filter_order = substr(f.filter_order, 1, s.step)
), counted AS (
  SELECT part, filter_order, step, p.bit,
    sum(CASE WHEN mask & (before + p.bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & p.bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before > 0 AND mask & p.bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = p.bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & p.bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & p.bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, placed p GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
""",
}
