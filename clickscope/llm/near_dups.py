"""Near duplicates: MinHash bands find candidates, odd sketches filter them, full shingle sets confirm the links.

1. Every text becomes its set of word shingles (64-bit hashes). Texts with the same set form one class; everything
   below runs on classes, so exact copies are never paired.
2. 128 MinHash samples per class give the bands (as many rows each as keep the odds of a missed pair below 1e-6), and
   are folded into an odd sketch: sample i flips one of 512 bits, so the XOR of two sketches has at most two bits per
   differing sample. ``odd_limit`` is the population count that a pair at the threshold exceeds with probability below
   1e-6. A second parity bitmap folds the whole set; it refutes pairs without any error.
3. Buckets (classes with an equal band) of two or more classes are kept, one of those with the same members. Buckets
   are dealt in blocks of about ``BLOCK`` classes that share the bucket's first class.
4. First pass: each block yields only a spanning forest of the pairs that its sketches admit (fewer edges than members,
   whatever the group's size); these are confirmed on the full sets, and confirmed links joined to components.
5. Second pass: members whose component is not the bucket's largest meet all others of the bucket, in blocks; admitted
   pairs across components are confirmed too. After it, every admitted pair of a bucket lies in one component or has
   been refuted on the full sets, so no link is lost beyond these odds.

Words are runs of other than ASCII white space, A-Z lower-cased. Defined cases: null and blank texts have the empty
set and are linked with nothing; a text with fewer words than a shingle is one shingle of all its words; rows that
repeat id and text are one document; of a component the smallest id stays (null ids last); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, free_finished_shuffles, fresh, quoted
from .components import components

SAMPLES, BITS, PARITY = 128, 512, 2048
BLOCK = 512
CACHE = 500_000
_rng = np.random.default_rng(20240229)
_MUL = (_rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_ADD = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)[:, None]
_SALT = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1)
_BAND = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Word → 64-bit hash; cleared when it grows beyond CACHE words."""

    def __missing__(self, w):
        if len(self) > CACHE:
            self.clear()
        self[w] = h = xxhash.xxh3_64_intdigest(w)
        return h


class Shingler:
    def __init__(self, words: int):
        self.words, self.cache = words, _Words()

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes."""
        parts = text.encode().lower().split() if text else []
        n = min(self.words, len(parts))
        if not n:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.cache.__getitem__, parts), np.uint64, len(parts))
        acc = _mix(h[:len(h) - n + 1] + np.uint64(n))
        for j in range(1, n):
            acc = _mix(acc + h[j:len(h) - n + 1 + j])
        return np.unique(acc)


def set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def min_samples(s: np.ndarray) -> np.ndarray:
    """MinHash samples; the permutations are x * odd + b modulo 2**32 of mixed hashes."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(best, (x[None, i:i + 2048] * _MUL + _ADD).min(axis=1), out=best)
    return best


def rows_per_band(threshold: float, risk: float = 1e-6) -> int:
    """The most rows per band with which a pair at the threshold shares no band with probability below ``risk``."""
    return max((r for r in range(1, 9) if (1 - threshold ** r) ** (SAMPLES // r) < risk), default=1)


def band_keys(samples: np.ndarray, rows: int) -> np.ndarray:
    bands = SAMPLES // rows
    cells = samples[:bands * rows].astype(np.uint64).reshape(bands, rows)
    acc = _BAND[:bands].copy()
    for j in range(rows):
        acc = _mix(acc + cells[:, j])
    return acc.view(np.int64)


def _fold(bits: np.ndarray, size: int) -> bytes:
    return np.packbits((np.bincount(bits.astype(np.int64), minlength=size) & 1).astype(np.uint8)).tobytes()


def odd_sketch(samples: np.ndarray) -> bytes:
    """Parity bitmap: sample i flips the bit that its value and number hash to."""
    at = _mix(samples.astype(np.uint64) * _SALT + np.arange(SAMPLES, dtype=np.uint64)) & np.uint64(BITS - 1)
    return _fold(at, BITS)


def parity(s: np.ndarray) -> bytes:
    """Parity bitmap of the whole set: each shingle flips one bit, so an XOR never has more bits than the sets differ
    in, and a pair above the threshold's difference is refuted without error."""
    return _fold(s & np.uint64(PARITY - 1), PARITY)


def odd_limit(threshold: float, risk: float = 1e-6) -> int:
    """Twice the number of differing samples that a pair at the threshold exceeds with probability below ``risk``."""
    p, tail = 1 - threshold, 1.0
    for d in range(SAMPLES + 1):
        tail -= math.comb(SAMPLES, d) * p ** d * (1 - p) ** (SAMPLES - d)
        if tail < risk:
            return 2 * d
    return BITS


def similarity(xor_bits: int) -> float:
    """Estimated similarity of a pair from the population count of its XOR-ed sketches."""
    return max(0.0, 1 + BITS / (4 * SAMPLES) * math.log(max(1 - 2 * xor_bits / BITS, 1e-9)))


def sketches(docs: DataFrame, words: int, per_band: int, id_col: str, text_col: str) -> DataFrame:
    """``row_key, doc_id, n_shingles, c (set key), bands, sketch`` per row."""
    text = F.col(quoted(text_col))
    ident = F.col(quoted(id_col))
    rows = docs.select(row_key(ident, text).alias("row_key"), ident.alias("doc_id"), text.alias("text"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = pa.schema([("n_shingles", pa.int64()), ("c", pa.binary()), ("bands", pa.list_(pa.int64())),
                     ("sketch", pa.binary())])

    def sketch(batches):
        shingler = Shingler(words)
        for batch in batches:
            n, c, bands, odd = [], [], [], []
            for t in batch.column("text"):
                s = shingler(t.as_py())
                m = min_samples(s) if len(s) else None
                n.append(len(s))
                c.append(set_key(s))
                bands.append(band_keys(m, per_band) if m is not None else [])
                odd.append(odd_sketch(m) + parity(s) if m is not None else b"")
            cols = [pa.array(x, f.type) for x, f in zip((n, c, bands, odd), out, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("doc_id"), *cols],
                                             names=["row_key", "doc_id", *out.names])

    return rows.mapInArrow(sketch, f"row_key string, doc_id {types['doc_id']}, n_shingles bigint, c binary, "
                                   "bands array<bigint>, sketch binary")


def row_key(ident: Column, text: Column) -> Column:
    """Identity of a row: its id and a hash of its text."""
    return F.concat_ws("|", F.coalesce(ident.cast("string"), F.lit("null")),
                       F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """Full sets ``c, s`` of the wanted classes (``c, row_key``), made again from their documents' texts."""
    text = F.col(quoted(text_col))
    rows = docs.select(row_key(F.col(quoted(id_col)), text).alias("row_key"), text.alias("text"))
    rows = rows.join(wanted.select("row_key"), "row_key", "left_semi").select("row_key", "text")

    def sets(batches):
        shingler = Shingler(words)
        for batch in batches:
            c, s = [], []
            for t in batch.column("text"):
                x = shingler(t.as_py())
                c.append(set_key(x))
                s.append(x.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()), pa.array(s, pa.list_(pa.int64()))],
                                             names=["c", "s"])

    # rows that repeat id and text give the same set again
    return rows.mapInArrow(sets, "c binary, s array<bigint>").dropDuplicates(["c"])


def buckets(classes: DataFrame) -> DataFrame:
    """``bucket, c, m, hub`` of every bucket with two or more classes; of buckets with equal members one is kept."""
    rows = classes.select("c", F.explode("bands").alias("bucket"))
    h = F.xxhash64("c")
    per = (rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(h).alias("x"),
                                      F.bit_xor(F.xxhash64("c", F.lit(1))).alias("y"), F.min("c").alias("hub"))
           .where("m > 1"))
    kept = per.groupBy("m", "x", "y", "hub").agg(F.min("bucket").alias("bucket")).select("bucket", "m", "hub")
    return rows.join(kept, "bucket")


def _groups(batches, keys: list[str]):
    """Arrow tables of consecutive rows with equal keys, across batch borders."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if not t.num_rows:
            continue
        t = pa.concat_tables([held, t]) if held is not None else t
        k = np.column_stack([t.column(x).to_numpy() for x in keys])
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
            yield t.slice(a, b - a)
        held = t.slice(cuts[-1] if len(cuts) else 0)
    if held is not None:
        yield held


def _matrix(t: pa.Table) -> np.ndarray:
    col = t.column("sketch").combine_chunks()
    return np.frombuffer(b"".join(col.to_pylist()), np.uint64).reshape(-1, (BITS + PARITY) // 64)


def admitted(sk: np.ndarray, n: np.ndarray, i: int, limit: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(population counts of the odd sketches, mask): pairs of row i that both bitmaps and the sizes admit."""
    bits = np.bitwise_count(sk ^ sk[i])
    d = bits[:, :BITS // 64].sum(axis=1, dtype=np.int64)
    differ = bits[:, BITS // 64:].sum(axis=1, dtype=np.int64)
    most = (n + n[i]) * ((1 - threshold) / (1 + threshold)) + 1e-6
    return d, (d <= limit) & (differ <= most) & (np.minimum(n, n[i]) >= threshold * np.maximum(n, n[i]) - 1e-9)


def forest(sk: np.ndarray, n: np.ndarray, limit: int, threshold: float) -> list[tuple[int, int]]:
    """Spanning forest of the admitted pairs, nearest sketches first (Prim's method, one row at a time)."""
    g = len(n)
    near, parent = np.full(g, BITS + 1), np.full(g, -1)
    left = np.ones(g, bool)
    edges = []
    for _ in range(g):
        i = int(np.argmin(np.where(left, near, BITS + 2)))
        if near[i] <= limit:
            edges.append((int(parent[i]), i))
        left[i] = False
        d, fits = admitted(sk, n, i, limit, threshold)
        ok = left & fits & (d < near)
        near[ok], parent[ok] = d[ok], i
    return edges


PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _pairs(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([min(r) for r in rows], pa.binary()),
                                       pa.array([max(r) for r in rows], pa.binary())], schema=PAIR)


def forest_pairs(members: DataFrame, limit: int, threshold: float) -> DataFrame:
    """First pass: candidate pairs ``a, b`` of a spanning forest per block of each bucket."""
    n_blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("c", F.lit(5)), n_blocks).cast("int")
    # the hub, one row per bucket, is in every block and so ties the blocks together
    block = F.when(F.col("c") == F.col("hub"), F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array(own))
    dealt = members.select("bucket", F.explode(block).alias("block"), "c", "n_shingles", "sketch")
    dealt = dealt.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "c")

    def run(batches):
        out = []
        for t in _groups(batches, ["bucket", "block"]):
            c = t.column("c").to_pylist()
            if len(c) > 1:
                edges = forest(_matrix(t), t.column("n_shingles").to_numpy(), limit, threshold)
                out += [(c[i], c[j]) for i, j in edges]
            if len(out) > 10_000:
                yield _pairs(out)
                out = []
        if out:
            yield _pairs(out)

    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def cross_pairs(members: DataFrame, limit: int, threshold: float) -> DataFrame:
    """Second pass: admitted pairs across components (column ``root``) within a bucket.

    Members outside the bucket's largest component are the queries; in blocks they meet the bucket's members in blocks.
    """
    per = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("k"))
    main = (per.groupBy("bucket").agg(F.max(F.struct("k", "root")).alias("top"), F.sum("k").alias("m2"),
                                      F.count(F.lit(1)).alias("roots"))
            .where("roots > 1").select("bucket", F.col("top.root").alias("main"),
                                       F.ceil(F.col("m2") / BLOCK).cast("int").alias("tb"),
                                       F.ceil((F.col("m2") - F.col("top.k")) / BLOCK).cast("int").alias("qb")))
    rows = members.select("bucket", "c", "n_shingles", "sketch", "root").join(main, "bucket")
    own_t = F.pmod(F.xxhash64("c", F.lit(6)), F.col("tb")).cast("int")
    own_q = F.pmod(F.xxhash64("c", F.lit(7)), F.col("qb")).cast("int")
    cols = ["bucket", "c", "n_shingles", "sketch", "root"]
    targets = rows.select(*cols, own_t.alias("tb"), F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("qb"),
                          F.lit(False).alias("query"))
    queries = rows.where(~F.col("root").eqNullSafe(F.col("main"))).select(
        *cols, F.explode(F.sequence(F.lit(0), F.col("tb") - 1)).alias("tb"), own_q.alias("qb"),
        F.lit(True).alias("query"))
    dealt = targets.unionByName(queries).repartition("bucket", "tb", "qb").sortWithinPartitions("bucket", "tb", "qb")

    def run(batches):
        out = []
        for t in _groups(batches, ["bucket", "tb", "qb"]):
            c, sk, n = np.array(t.column("c").to_pylist(), object), _matrix(t), t.column("n_shingles").to_numpy()
            _, root = np.unique(np.array(t.column("root").to_pylist(), object), return_inverse=True)
            is_query = t.column("query").to_numpy()
            for i in np.flatnonzero(is_query):
                _, fits = admitted(sk, n, i, limit, threshold)
                out += [(c[i], c[j]) for j in np.flatnonzero(fits & ~is_query & (root != root[i]))]
                if len(out) > 10_000:
                    yield _pairs(out)
                    out = []
        if out:
            yield _pairs(out)

    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach ``percent``: 100 * intersection >= percent * union."""
    x = pairs.join(sets.select(F.col("c").alias("a"), F.col("s").alias("sa")), "a")
    x = x.join(sets.select(F.col("c").alias("b"), F.col("s").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return x.where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def near_dups(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``row_key, doc_id, n_shingles, component_id, stays`` per row of ``docs``.

    ``component_id`` is the smallest id of the component (null if it has none); ``stays`` marks the rows of the one
    document (id and text) of a component that a deduplicated corpus keeps.
    """
    threshold, limit = percent / 100, odd_limit(percent / 100)
    rows = cut(sketches(docs, words, rows_per_band(threshold), id_col, text_col))
    winner = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                            F.col("row_key").alias("row_key"))).alias("best")
    classes = cut(rows.where("n_shingles > 0").groupBy("c").agg(
        winner, F.count(F.lit(1)).alias("members"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    members = cut(buckets(classes).join(classes.select("c", "n_shingles", "sketch"), "c"))
    free_finished_shuffles(docs.sparkSession)
    wanted = (members.select("c").distinct().join(classes.select("c", F.col("best.row_key").alias("row_key")), "c"))
    sets = cut(shingle_sets(docs, wanted, words, id_col, text_col))
    del wanted
    free_finished_shuffles(docs.sparkSession)
    links = cut(confirmed(forest_pairs(members, limit, threshold), sets, percent))
    labels = components(links)
    placed = members.join(labels, members["c"] == labels["node"], "left").drop("node")
    placed = placed.withColumn("root", F.coalesce("root", "c"))
    more = cut(confirmed(cross_pairs(placed, limit, threshold), sets, percent))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    # classes that copies or links tie to another document; all others are components of one row
    tied = classes.select("c", "best", "members").join(labels, F.col("c") == F.col("node"), "left")
    tied = tied.select("c", "best", "members", F.col("root").isNotNull().alias("linked"),
                       F.coalesce("root", "c").alias("root")).where("linked or members > 1")
    comp = tied.groupBy("root").agg(F.min("best").alias("top"))
    named = cut(tied.join(comp, "root").select("c", "top"))
    j = rows.select("row_key", "doc_id", "n_shingles", "c").join(named, "c", "left")
    alone = F.col("top").isNull() | (F.col("n_shingles") == 0)
    return j.select("row_key", "doc_id", "n_shingles",
                    F.when(alone, F.col("doc_id")).otherwise(F.col("top.id")).alias("component_id"),
                    (alone | (F.col("row_key") == F.col("top.row_key"))).alias("stays"))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One document of each component, with the columns of ``docs``; rows that repeat id and text are kept once."""
    key, n = fresh(docs, "row_key", "nth")
    keep = (near_dups(docs, words, percent, id_col, text_col).where("stays")
            .select(F.col("row_key").alias(key)).distinct())
    text, ident = F.col(quoted(text_col)), F.col(quoted(id_col))
    rows = docs.withColumn(key, row_key(ident, text)).join(keep, key, "left_semi")
    once = Window.partitionBy(key).orderBy(F.lit(0))
    cols = [F.col(quoted(c)) for c in docs.columns]
    return rows.withColumn(n, F.row_number().over(once)).where(F.col(n) == 1).select(*cols)
