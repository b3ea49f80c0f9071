"""Registered queries of the corpus operators (``opN_<name>``, ``pipeline``) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (decontaminate, exact_dedup, kd_shards, mixing, near_dups, pieces, quality, ranked_search, spelling,
               suffix_dedup, surrogates, token_counts, warc)
from .common import cut, shared_folder, utf8_size, word_count

PII_KEY = b"registered query"  # jobs pass a secret of their own

QUERIES: dict = {}
SQL: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


# ---------------------------------------------------------------- 1 mixing

OP1_SQL = """
WITH sized AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k,
         CAST(coalesce(length(regexp_replace(regexp_replace(regexp_replace(text, '[^\\x20\\x09-\\x0D]+', 'w', 'g'),
              '[\\x20\\x09-\\x0D]+', '', 'g'), '[^w]', '', 'g')), 0) AS BIGINT) AS size
  FROM documents),
src AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY k),
named AS (SELECT *, row_number() OVER (ORDER BY k = 'n', k) AS rn FROM src),
capped AS (SELECT *, CAST(CASE (rn - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS w,
                  source_size * CAST(2 AS DOUBLE) AS cap FROM named),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY cap / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM capped),
targets AS (SELECT k, source_size, least(cap, max(level) OVER () * w) AS target FROM levels),
hashed AS (
  SELECT *, md5('mix-1|' || CAST(doc_id AS VARCHAR)) AS h,
         CASE WHEN size < 16 THEN size
              ELSE (length(bin(size)) - 4) * 8 + (size >> CAST(length(bin(size)) - 4 AS BIGINT)) END AS class
  FROM sized),
lined AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY class, h, size) AS pos FROM hashed),
drawn AS (
  SELECT doc_id, size, source_size, target, pos,
         CASE WHEN source_size > 0 THEN target / source_size ELSE CAST(0 AS DOUBLE) END AS e,
         CAST(CAST('0x' || substr(md5('mix-1#' || k), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS u
  FROM lined JOIN targets USING (k))
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(pos * e + u) - floor((pos - 1) * e + u)) AS BIGINT) AS taken
FROM drawn"""


@register("op1_mixing", OP1_SQL)
def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "source", word_count(F.col("text")).alias("words"))
    out = mixing.mix(cut(docs), size=F.col("words"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


# ---------------------------------------------------------------- 3 sharding

@register("op3_kd_shards")
def op3_kd_shards(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    slim = cut(documents(spark, sf).select(
        "doc_id", "lang", "source", (utf8_size(text) + 1).alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "utf-8")).alias("text_crc32")))
    out = kd_shards.kd_shards(slim, leaves=8, size_col="size", crc_col="text_crc32", slim_first=False)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                      F.col("slot").cast("bigint"), F.lit(None).cast("int").alias("grown_shard"))


# ---------------------------------------------------------------- 8 exact dedup

OP8_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
r AS (
  SELECT doc_id, norm, row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS rn,
         count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM r"""


@register("op8_exact_dedup", OP8_SQL)
def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf))


# ---------------------------------------------------------------- 4 WARC

OP4_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages),
d AS (SELECT *, sha1(payload) AS hexed FROM p),
digits AS (
  SELECT page_id, payload, first_id,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
           ((CAST('0x' || substr(hexed, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT)
             >> CAST(5 * (7 - i % 8) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest
  FROM d)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM digits"""


@register("op4_warc", OP4_SQL)
def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    mono, single = shared_folder(spark, "warc-mono"), shared_folder(spark, "warc")
    warc.write_monolithic(warc.records(pages, min_revisit_bytes=0), mono)
    warc.normalise(spark, mono, single)
    found = warc.indexed(warc.read_archives(spark, single).drop("payload"), warc.read_index(spark, single))
    return warc.resolve_revisits(cut(found), pages.schema["page_id"].dataType.simpleString())


# ---------------------------------------------------------------- 7 quality

@register("op7_compression_quality")
def op7_compression_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


# ---------------------------------------------------------------- 9 decontamination

@register("op9_pigeonhole")
def op9_pigeonhole(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.matches(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


# ---------------------------------------------------------------- 2 personal data

@register("op2_surrogates")
def op2_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return surrogates.replace_entities(docs, key=PII_KEY, found_col="n_replaced")


# ---------------------------------------------------------------- 5 token counts

@register("op5_section_tokens")
def op5_section_tokens(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers as tokenizer_files
    ranks = token_counts.read_ranks(tokenizer_files.path("byte_bpe_50k.tiktoken"))
    return token_counts.section_tokens(spark, documents(spark, sf), ranks, tokenizer_files.PATTERN)


# ---------------------------------------------------------------- 6 near duplicates

@register("op6_odd_sketch")
def op6_odd_sketch(spark: SparkSession, sf: str) -> DataFrame:
    out = near_dups.near_dups(documents(spark, sf), words=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


# ---------------------------------------------------------------- 10 substring dedup

@register("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf), length=100)


# ---------------------------------------------------------------- 11 spelling variants

# crc32 bit by bit over the hex digits of the UTF-8 bytes, least bit of each byte first
OP11_SQL = """
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY 1, 2),
digits AS (SELECT run, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hexed FROM counted),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(hexed) * 4), lambda i:
      (CAST('0x' || substr(hexed, CAST(1 + 2 * (i // 8) AS BIGINT), 2) AS BIGINT) >> CAST(i % 8 AS BIGINT)) & 1)),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) AS h
  FROM digits),
noisy AS (
  SELECT k, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
                                       || substr(run, CAST(h % length(run) + 2 AS BIGINT))
                 ELSE run END AS word
  FROM hashed),
words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM noisy WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
longer AS (SELECT DISTINCT c.word AS a, c.n AS an, w.word AS b, w.n AS bn FROM cuts c JOIN words w ON c.rest = w.word),
near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM cuts x JOIN cuts y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION ALL SELECT a, b, bn FROM longer UNION ALL SELECT b, a, an FROM longer),
ranked AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS rn FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 5 * w.n THEN r.other END AS form,
         CASE WHEN r.other_n >= 5 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.rn = 1),
chain(word, root) AS (
  SELECT word, form FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root AND f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root AND f.form IS NULL)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM formed f LEFT JOIN ends e ON e.word = f.word"""


@register("op11_letter_trees", OP11_SQL)
def op11_letter_trees(spark: SparkSession, sf: str) -> DataFrame:
    words = spelling.count_words(documents(spark, sf), min_length=6, min_count=5, drop_every=199)
    return spelling.forms(words, ratio=5).select("word", "form", "root", "n", "n_near", "form_n")


# ---------------------------------------------------------------- 12 ranked search

OP12_SQL = """
WITH folded AS (
  SELECT doc_id, row_number() OVER () AS d,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
found AS (SELECT doc_id, d, unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
          FROM folded),
tf AS (SELECT doc_id, d, t, count(*) AS tf FROM found GROUP BY 1, 2, 3),
docs AS (SELECT doc_id, d, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1, 2),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
sized AS (SELECT doc_id, d, 10 + (90 * n * n_docs) // n_terms AS m FROM docs, total),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
  FROM benchmark),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY t, n_docs),
scores AS (
  SELECT i.item_id, f.doc_id, f.d, CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * s.m))) AS BIGINT) AS score
  FROM items i JOIN tf f USING (t) JOIN weights w USING (t) JOIN sized s ON s.d = f.d GROUP BY 1, 2, 3),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


@register("op12_rmq_search", OP12_SQL)
def op12_rmq_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_search.search(spark, documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"), k=10)


# ---------------------------------------------------------------- 13 SentencePiece

@register("op13_merge_rounds")
def op13_merge_rounds(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers as tokenizer_files
    model = pieces.read_model(tokenizer_files.path("piece_bpe_32k.model"))
    coded = pieces.decode(pieces.encode(documents(spark, sf).select("doc_id", "text"), model).drop("text"), model)
    return coded.select("doc_id", pieces.n_ids(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


# ---------------------------------------------------------------- pipeline

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
