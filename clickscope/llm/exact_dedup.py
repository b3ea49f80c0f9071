"""Exact deduplication: group by a 128-bit content hash, compare bytes inside the groups, keep one row.

Plan: one shuffle of the distinct texts (``groupBy(hash, sha, text)`` combines copies before the shuffle, and
grouping on the text itself is the byte comparison that keeps colliding hashes apart), then a slim join of
(id, hash, sha) with the groups that have more than one member. Both join sides are exchanged for the join, so
AQE can split a hot group. DataFrame functions only.

Defined cases: null text counts as empty; the row with the most code points of the original text stays, then the
smallest id (null ids come last); rows that repeat id and text are one document and are marked alike; an empty
table gives an empty result; other columns of the input are neither read nor touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, quoted


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def content_hash(norm: Column) -> Column:
    """128-bit hash of the normalised text."""
    return F.unhex(F.md5(norm.cast("binary")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=content_hash) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``hash_of`` maps the normalised text to the grouping hash (a parameter so that tests can force collisions).
    Two texts that share both that hash and SHA-256 would make the membership join ambiguous; the byte comparison
    finds them and the job stops with an error instead of merging them.
    """
    text = F.col(quoted(text_col))
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), normalised(text).alias("norm"),
                       F.coalesce(F.char_length(text), F.lit(0)).alias("points"))
    rows = rows.select("doc_id", "points", "norm", hash_of(F.col("norm")).alias("h"),
                       F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"))
    best = F.min(F.struct((-F.col("points")).alias("neg"), F.col("doc_id").isNull().alias("no_id"),
                          F.col("doc_id").alias("id"))).alias("best")
    groups = rows.groupBy("h", "sha", "norm").agg(F.count(F.lit(1)).alias("group_size"), best)
    members = (groups.where("group_size > 1")
               .groupBy("h", "sha").agg(F.count(F.lit(1)).alias("texts"), F.first("group_size").alias("group_size"),
                                        F.first("best").alias("best"))
               .select("h", "sha", "best", "group_size",
                       F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share both content hashes")))
                       .otherwise(F.lit(True)).cast("boolean").alias("one_text")))
    # one key column of its own: both sides are then exchanged for the join, which AQE needs to split a hot group
    slim = rows.select("doc_id", "points", F.concat("h", "sha").alias("key"), "sha")
    members = members.where("one_text").select(F.concat("h", "sha").alias("key"), "best", "group_size")
    joined = slim.join(members, "key", "left")
    grouped = F.col("group_size").isNotNull()
    keep_id = F.when(grouped, F.col("best.id")).otherwise(F.col("doc_id"))
    is_kept = F.when(grouped, F.col("doc_id").eqNullSafe(F.col("best.id")) & (-F.col("points") == F.col("best.neg")))
    return joined.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(is_kept, F.lit(True)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
