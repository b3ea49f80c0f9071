"""Mixing sources to target weights by systematic sampling.

Every source gets a target (a share of the total, limited to ``max_repeat`` times its own size, the excess reshared
by weight). A document's expected copies are target / size of its source; documents of a source are lined up, their
expected copies prefix-summed, one random offset per source is added, and a document is emitted once for every
integer boundary that its interval crosses. All documents of a source share one expectation, so the prefix sum is
``rank * expectation``; the rank comes from ``gapless_rank`` (size classes, then hash prefixes), so no source is
sorted in one task. Lining up by size class keeps the taken words near the target, as in stratified sampling.

The offset and the line-up come from md5 of a seed and the ids, so a rerun or a retried task gives the same mix.
DataFrame functions only.

Defined cases: null and empty texts have size 0 and are copied like any other document; a null source is a source of
its own; sources without any word have target 0 and copies 0; repeated rows are separate documents; an empty table
gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, gapless_rank, nonnull_key, quoted, word_count

HASH_DIGITS = 3  # 4096 hash cells per size class


def size_class(size: Column) -> Column:
    """Monotone class of a size: exact below 16, then eight classes per power of two."""
    bits = F.length(F.bin(size))
    return F.when(size < 16, size).otherwise(
        (bits - 4).cast("bigint") * 8 + F.call_function("shiftright", size, bits - 4))


def source_targets(docs: DataFrame, key: str, size: str, weights=(3, 1, 2), share: float = 1.5,
                   max_repeat: float = 2.0) -> DataFrame:
    """One row per source key: ``key, source_size, target``.

    Sources in code point order (key ``n``, the null source, last) take the weights in turn. The level at which
    every target is ``min(max_repeat * size, level * weight)`` and the targets sum to ``share`` of all sizes is the
    largest of the levels that cap the first 0, 1, 2, … sources in order of cap per weight. The windows run over one
    row per source.
    """
    t = docs.groupBy(key).agg(F.sum(size).alias("source_size"))
    by_name = Window.orderBy((F.col(key) == "n").asc(), F.col(key).asc())
    w_arr = F.array(*[F.lit(float(w)) for w in weights])
    t = t.withColumn("rn", F.row_number().over(by_name))
    t = t.withColumn("w", F.element_at(w_arr, ((F.col("rn") - 1) % len(weights) + 1).cast("int")))
    t = t.withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    by_cap = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("rn").asc())
    caps_before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    w_from = F.sum("w").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
    t = t.withColumn("level", (F.col("wanted") - caps_before) / w_from)
    t = t.withColumn("level", F.max("level").over(everything))
    return t.select(key, "source_size", F.least(F.col("cap"), F.col("level") * F.col("w")).alias("target"))


def mix(docs: DataFrame, size: Column | None = None, source_col: str = "source", id_col: str = "doc_id",
        weights=(3, 1, 2), share: float = 1.5, max_repeat: float = 2.0, seed: str = "mix-1",
        size_out: str = "size", hash_digits: int = HASH_DIGITS, source_size_out: str = "source_size",
        target_out: str = "target", copies_out: str = "copies") -> DataFrame:
    """All columns of ``docs`` plus ``size``, ``source_size``, ``target`` and ``copies``, named by the ``_out`` names.

    ``size`` is the column expression that is balanced (default: words of ``text``). Input columns with the names of
    the added ones are replaced.
    """
    size = word_count(F.col("text")) if size is None else size
    key, sz, cls, sub, h, pos = fresh(docs, "src", "size", "class", "sub", "hash", "pos")
    added = {c.lower() for c in (size_out, source_size_out, target_out, copies_out)}
    kept = [c for c in docs.columns if c.lower() not in added]
    ident = F.col(quoted(id_col)).cast("string")
    rows = (docs.withColumn(key, nonnull_key(F.col(quoted(source_col)))).withColumn(sz, size)
            .withColumn(h, F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(ident, F.lit(""))))))
    rows = rows.withColumn(cls, size_class(F.col(sz))).withColumn(sub, F.substring(h, 1, hash_digits))
    rows = rows.select(*[F.col(quoted(c)) for c in kept], key, sz, cls, sub, h)
    # equal rows are interchangeable; other columns only separate rows that share size and id
    rest = [c for c in kept if docs.schema[c].dataType.typeName() not in ("map", "variant")]
    order = [F.col(h), F.col(sz), F.xxhash64(*[F.col(quoted(c)) for c in rest])]
    ranked = gapless_rank(rows, key, cls, sub, order, pos)
    targets = source_targets(rows, key, sz, weights, share, max_repeat)
    names = fresh(ranked, "ss", "tg")
    targets = targets.toDF(key, *names)
    out = ranked.join(targets, key)
    expect = F.when(F.col(names[0]) > 0, F.col(names[1]) / F.col(names[0])).otherwise(F.lit(0.0))
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}#"), F.col(key))), 1, 13), 16, 10).cast("double")
         / F.lit(float(1 << 52)))
    crossed = F.floor(F.col(pos) * expect + u) - F.floor((F.col(pos) - 1) * expect + u)
    return out.select(*[F.col(quoted(c)) for c in kept], F.col(sz).alias(size_out),
                      F.col(names[0]).alias(source_size_out), F.col(names[1]).alias(target_out),
                      F.least(crossed, F.ceil(F.lit(float(max_repeat)))).cast("int").alias(copies_out))


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the columns of ``docs``, every document as often as it was drawn."""
    size, source_size, target, copies, each = fresh(docs, "drawn_size", "source_size", "target", "copies", "each")
    drawn = mix(docs, size_out=size, source_size_out=source_size, target_out=target, copies_out=copies, **how)
    drawn = drawn.where(F.col(copies) > 0)
    cols = [F.col(quoted(c)) for c in docs.columns]
    return drawn.withColumn(each, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*cols)
