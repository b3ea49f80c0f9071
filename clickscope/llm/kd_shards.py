"""Sharding by a k-d tree over document metadata with equal bytes per leaf.

A node is split along its widest metadata dimension (range in the node / range in the corpus) at the weighted median
of the bytes, until every node is one leaf. The median is found by counting: bytes per key range in three passes, each
refining the range that holds the median by 8192, so nothing is sorted and only one row per node reaches the driver.
The sort key of a dimension is its scaled value in the high bits and a hash of id and text in the low bits: rows with
equal metadata are still separable, and a hot value is cut inside, which keeps the bytes near equal.

The driver holds the tree: one row per shard. Rows find their leaf through one broadcast lookup per level; slots come
from ``gapless_rank`` (hash prefixes), so a shard is never sorted in one task.

Defined cases: null text has 0 bytes (a row weighs its bytes plus 1); null metadata counts as the smallest value;
repeated rows share a leaf; copies of one text may lie in several shards, as a hot text may exceed a shard; an empty
table gives an empty result; columns with clashing names are replaced by the result's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh, gapless_rank, quoted, utf8_size

VALUE_BITS, PASS_BITS, PASSES = 20, 13, 3
KEY_BITS = PASS_BITS * PASSES  # value in the high VALUE_BITS, hash below


@dataclass
class Split:
    node: int       # heap number: root 1, children 2n and 2n + 1
    dim: int
    low: float      # range of the dimension in the node, for scaling
    width: float
    cut: int        # keys below go left
    left_leaves: int
    leaves: int


def text_prefix_number(col: Column) -> Column:
    """Order-preserving number of a string's first six UTF-8 bytes (a metadata dimension for lang, source, …)."""
    padded = F.rpad(F.hex(F.substring(F.encode(F.coalesce(col.cast("string"), F.lit("")), "utf-8"), 1, 6)), 12, "0")
    return F.conv(padded, 16, 10).cast("double")


def default_dims(docs: DataFrame, size: Column) -> list[Column]:
    """doc_id (crawl order), log size, language and source, as far as the table has them."""
    have = set(docs.columns)
    dims = [F.log2(size.cast("double") + 1)]
    if "doc_id" in have:  # ids that are texts count by their first bytes
        text = isinstance(docs.schema["doc_id"].dataType, T.StringType)
        dims.append(text_prefix_number(F.col("doc_id")) if text else F.col("doc_id").cast("double"))
    dims += [text_prefix_number(F.col(c)) for c in ("lang", "source") if c in have]
    return [F.coalesce(F.when(~F.isnan(d), d), F.lit(-1.0)) for d in dims]


def _key(dim: Column, low: Column, width: Column, h: Column) -> Column:
    top = F.lit((1 << VALUE_BITS) - 1)
    scaled = F.when(width > 0, F.floor((dim - low) / width * top)).otherwise(F.lit(0)).cast("bigint")
    scaled = F.greatest(F.lit(0).cast("bigint"), F.least(scaled, top.cast("bigint")))
    return F.shiftleft(scaled, KEY_BITS - VALUE_BITS) + h


def _with_node_values(rows: DataFrame, node: str, values: list[tuple], schema: str, how: str = "inner") -> DataFrame:
    """Add per-node values (node number first). At the root they are literals; below, one broadcast row per open node,
    so at most one per shard."""
    names = [x.split()[0] for x in schema.split(", ")]
    if [v[0] for v in values] == [1]:
        types = [x.split()[1] for x in schema.split(", ")]
        return rows.select("*", *[F.lit(v).cast(t).alias(n) for v, t, n in zip(values[0], types, names, strict=True)])
    t = rows.sparkSession.createDataFrame(values, schema)
    return rows.join(F.broadcast(t), F.col(node) == F.col(names[0]), how)


def _descend(rows: DataFrame, splits: list[Split], node: str, dims: str, h: str) -> DataFrame:
    """Move rows from a split node to its child; rows of finished nodes stay."""
    cols = [F.col(quoted(c)) for c in rows.columns if c != node]
    t_node, t_dim, t_low, t_width, t_cut = fresh(rows, "t_node", "t_dim", "t_low", "t_width", "t_cut")
    value = F.element_at(F.col(dims), F.col(t_dim) + 1)
    right = (_key(value, F.col(t_low), F.col(t_width), F.col(h)) >= F.col(t_cut)).cast("bigint")
    joined = _with_node_values(rows, node, [(s.node, s.dim, s.low, s.width, s.cut) for s in splits],
                               f"{t_node} long, {t_dim} int, {t_low} double, {t_width} double, {t_cut} long", "left")
    return joined.select(*cols, F.coalesce(F.col(t_node) * 2 + right, F.col(node)).alias(node))


def grow_tree(slim: DataFrame, leaves: int, dims: str, n_dims: int, weight: str, h: str) -> list[list[Split]]:
    """Splits per level for ``leaves`` leaves; ``slim`` has the dims array, the weight and the low-bit hash."""
    node = "kd_node"
    rows = slim.withColumn(node, F.lit(1).cast("bigint"))
    bounds = [f(F.element_at(dims, i + 1)) for i in range(n_dims) for f in (F.min, F.max)]
    whole = rows.agg(*bounds).first()
    if whole[0] is None:
        return []
    spans = [max(whole[2 * i + 1] - whole[2 * i], 0.0) for i in range(n_dims)]
    todo, levels = {1: leaves}, []
    while any(k > 1 for k in todo.values()):
        open_nodes = [n for n, k in todo.items() if k > 1]
        stats = (rows.where(F.col(node).isin(open_nodes)).groupBy(node)
                 .agg(F.sum(weight).alias("w"), *[b.alias(f"b{i}") for i, b in enumerate(bounds)]).collect())
        splits = []
        for r in stats:
            rel = [(r[f"b{2 * i + 1}"] - r[f"b{2 * i}"]) / spans[i] if spans[i] > 0 else 0.0 for i in range(n_dims)]
            d = max(range(n_dims), key=lambda i: (rel[i], -i))
            low = r[f"b{2 * d}"]
            k = todo[r[node]]
            splits.append((Split(r[node], d, low, r[f"b{2 * d + 1}"] - low, 0, k // 2, k), r["w"]))
        splits = _weighted_cuts(rows, splits, node, dims, weight, h)
        levels.append(splits)
        rows = _descend(rows, splits, node, dims, h)
        nxt = {n: k for n, k in todo.items() if k == 1}
        for s in splits:
            nxt[2 * s.node], nxt[2 * s.node + 1] = s.left_leaves, s.leaves - s.left_leaves
        todo = nxt
    return levels


def _weighted_cuts(rows, splits, node, dims, weight, h) -> list[Split]:
    """Find, for every split, the key below which left_leaves / leaves of the node's weight lie."""
    goal = {s.node: w * s.left_leaves / s.leaves for s, w in splits}
    start = {s.node: 0 for s, _ in splits}     # first key of the range that holds the cut
    passed = {s.node: 0 for s, _ in splits}    # weight below that range
    by_node = Window.partitionBy(node).orderBy("bin")
    for step in range(PASSES):
        shift = KEY_BITS - PASS_BITS * (step + 1)
        values = [(s.node, s.dim, s.low, s.width, start[s.node], float(goal[s.node] - passed[s.node])) for s, _ in splits]
        valued = _with_node_values(rows, node, values, "t_node long, t_dim int, t_low double, t_width double, "
                                   "t_start long, t_goal double")
        value = F.element_at(F.col(dims), F.col("t_dim") + 1)
        keyed = valued.select(
            node, weight, "t_goal",
            F.shiftright(_key(value, F.col("t_low"), F.col("t_width"), F.col(h)) - F.col("t_start"), shift).alias("bin"))
        bins = (keyed.where((F.col("bin") >= 0) & (F.col("bin") < (1 << PASS_BITS)))
                .groupBy(node, "bin", "t_goal").agg(F.sum(weight).alias("w")))
        run = bins.withColumn("upto", F.sum("w").over(by_node))
        found = (run.where(F.col("upto") >= F.col("t_goal")).groupBy(node)
                 .agg(F.min(F.struct("bin", "upto", "w")).alias("m")).select(node, "m.bin", "m.upto", "m.w").collect())
        for r in found:
            n = r[node]
            start[n] += r["bin"] << shift
            below = passed[n] + r["upto"] - r["w"]
            if step == PASSES - 1 and goal[n] - below > r["w"] / 2:  # the last, single key: on the nearer side
                start[n] += 1
            passed[n] = below
    return [Split(s.node, s.dim, s.low, s.width, start[s.node], s.left_leaves, s.leaves) for s, _ in splits]


def leaf_numbers(levels: list[list[Split]], leaves: int) -> dict[int, int]:
    """Heap number of each leaf → shard 0 … leaves - 1, left to right."""
    out, first = {}, {1: 0}
    splits = {s.node: s for level in levels for s in level}
    stack = [(1, leaves)]
    while stack:
        n, k = stack.pop()
        if n not in splits:
            out[n] = first[n]
            continue
        s = splits[n]
        first[2 * n], first[2 * n + 1] = first[n], first[n] + s.left_leaves
        stack += [(2 * n, s.left_leaves), (2 * n + 1, s.leaves - s.left_leaves)]
    return out


def kd_shards(docs: DataFrame, leaves: int | None = 8, target_bytes: int | None = None, text_col: str = "text",
              id_col: str = "doc_id", size_col: str | None = None, crc_col: str | None = None,
              dims: list[Column] | None = None, slim_first: bool = True) -> DataFrame:
    """All columns of ``docs`` plus ``size`` (bytes + 1), ``text_crc32``, ``shard`` and ``slot``.

    Give ``leaves``, or ``target_bytes`` (then leaves = ceil(total / target)). ``size_col`` / ``crc_col`` name columns
    that already hold size and crc; otherwise they are computed from the text.
    """
    added = {"size", "text_crc32", "shard", "slot"} - {c for c in (size_col, crc_col) if c}
    docs = docs.select(*[F.col(quoted(c)) for c in docs.columns if c.lower() not in added])
    text = F.col(quoted(text_col)) if text_col in docs.columns else None
    size = F.col(quoted(size_col)) if size_col else utf8_size(text) + 1
    crc = F.col(quoted(crc_col)) if crc_col else F.crc32(F.encode(F.coalesce(text, F.lit("")), "utf-8"))
    rows = docs.withColumn("size", size).withColumn("text_crc32", crc)
    dim_cols = default_dims(rows, F.col("size")) if dims is None else dims
    dm, h, node, key, sub = fresh(rows, "dims", "hash", "node", "shard_key", "sub")
    low_bits = (1 << (KEY_BITS - VALUE_BITS)) - 1
    mixed = F.xxhash64(F.col(quoted(id_col)), F.col("text_crc32"), F.col("size"))
    rows = (rows.withColumn(dm, F.array(*dim_cols))
            .withColumn(h, mixed.bitwiseAND(F.lit(low_bits).cast("bigint")))
            .withColumn(sub, F.substring(F.hex(F.xxhash64(mixed, F.lit(7))), 1, 3)))
    slim = rows.select(dm, h, "size")
    slim = cut(slim) if slim_first else slim
    if leaves is None:
        leaves = max(1, -(-(slim.agg(F.sum("size")).first()[0] or 0) // int(target_bytes)))
    levels = grow_tree(slim, leaves, dm, len(dim_cols), "size", h) if leaves > 1 else []
    rows = rows.withColumn(node, F.lit(1).cast("bigint"))
    for splits in levels:
        rows = _descend(rows, splits, node, dm, h)
    numbers = sorted(leaf_numbers(levels, leaves).items())
    t_node, t_shard = fresh(rows, "t_node", "t_shard")
    rows = _with_node_values(rows, node, numbers, f"{t_node} long, {t_shard} int").withColumn("shard", F.col(t_shard))
    rows = rows.withColumn(key, F.lit(0))
    slot = "slot"
    rows = rows.select(*[F.col(quoted(c)) for c in docs.columns if c.lower() not in ("size", "text_crc32")],
                       "size", "text_crc32", "shard", key, sub, h)
    ranked = gapless_rank(rows, "shard", key, sub, [F.col(h), F.col(quoted(id_col)), F.col("text_crc32")], slot)
    return ranked.withColumn(slot, F.col(slot) - 1).drop(key, sub, h)
