"""Substring deduplication with suffix arrays: every byte covered by a string of ``length`` bytes that also starts
earlier (smaller id, or same document and earlier place) is removed.

1. *Anchors.* In every window of ``length`` bytes the 32-byte gram with the smallest hash is an anchor, so equal windows
   share an anchor at the same place. Only anchors whose gram occurs again can lie in a repeated window.
2. *Contexts.* The windows that contain an anchor lie within its context, ``length - 32`` bytes to either side. Of
   occurrences with equal contexts all but the first are covered wholly; the first stands for them.
3. *Suffix arrays.* First occurrences with one gram and different contexts go to one task, which sorts their suffixes by
   Lyndon groups (``gsaca``) and reads off, with common prefixes in bytes and nearest-earlier pointers, how far each
   agrees with an earlier one. Bytes between two places where no pair of the group starts to differ are one symbol.
   A gram with more than ``GROUP`` different contexts is a very common phrase; its windows are dealt out by their own
   hashes instead, and their first occurrences found by an aggregate, so no task holds such a group.
4. *Cut.* Covered ranges of a document are united and cut from its bytes.

Texts meet the ranges found for them in one join by document; documents without a suffix-array task are finished there.

Grams and contexts are compared by 64-bit hashes each (a false repeat needs both to collide). Defined cases: null text
is empty; documents shorter than ``length`` lose nothing; rows that repeat id and text are one document and fare alike;
rows that share an id but not the text are ordered by a hash of the text; null ids come last; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, quoted, shared_folder, shuffles_freed
from .gsaca import lcp_array, suffix_array

GRAM = 32
PIECE = 1 << 18          # bytes that are hashed at a time (their arrays stay in the processor's cache)
GROUP = 8192             # contexts of one gram that are sorted in one task (a quarter of a gigabyte at worst)
_rng = np.random.default_rng(77)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POS = np.uint64((1 << 24) - 1)


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each position (by doubling); the last 31 positions have none."""
    h, mul, step = _BYTE[b], int(_ODD), 1
    while step < GRAM:
        h = h[:-step] * np.uint64(mul) + h[step:]
        mul = mul * mul & (1 << 64) - 1
        step *= 2
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _window_min(key: np.ndarray, w: int) -> np.ndarray:
    out, have = key, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (w - have)], out[w - have:]) if w > have else out


def anchors(texts: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted anchor positions of each text, the leftmost smallest gram of every window, and the hashes of these grams."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    hashes: list[list[np.ndarray]] = [[] for _ in texts]
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def flush():
        nonlocal held, size
        if not held:
            return
        b = np.frombuffer(b"".join(x[2] for x in held), np.uint8)
        h = _gram_hashes(b)
        key = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
        low = _window_min(key, length - GRAM + 1) & _POS
        at = 0
        for doc, offset, piece in held:
            p = low[at:at + len(piece) - length + 1].astype(np.int64)
            p = p[np.concatenate([[True], p[1:] != p[:-1]])]
            found[doc].append(p - at + offset)
            hashes[doc].append(h[p])
            at += len(piece)
        held, size = [], 0

    for doc, data in enumerate(texts):
        for s in range(0, max(len(data) - length + 1, 0), PIECE):
            piece = data[s:s + PIECE + length - 1]
            held.append((doc, s, piece))
            size += len(piece)
            if size >= PIECE:
                flush()
    flush()
    out = []
    for f, g in zip(found, hashes, strict=True):
        if len(f) > 1:  # pieces of one text overlap
            at, first = np.unique(np.concatenate(f), return_index=True)
            out.append((at, np.concatenate(g)[first].view(np.int64)))
        else:
            out.append((f[0], g[0].view(np.int64)) if f else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    return out


def _u64(x: list[int]) -> np.ndarray:
    return np.array(x, np.uint64).view(np.int64)


def grams(rows: DataFrame, length: int) -> DataFrame:
    """``h`` of every anchor: the places alone, without contexts."""
    def run(batches):
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column(0).cast(pa.binary())]
            found = [h for _, h in anchors(texts, length)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["h"])

    return rows.select("text").mapInArrow(run, "h bigint")


def order_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, id`` (order, null last), ``tie`` (32 bits of a text hash) and ``text``."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    ident = F.col(quoted(id_col)).cast("bigint")
    return docs.select(ident.alias("doc_id"), F.coalesce(ident, F.lit((1 << 63) - 1)).alias("id"),
                       F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint")).alias("tie"), text.alias("text"))


def occurrences(rows: DataFrame, length: int) -> DataFrame:
    """``h, ctx, id, spot`` per anchor; ``spot`` = tie and position. Of occurrences with equal gram and context in one
    batch, those after the first are known to be covered: their context is null and their gram, no longer needed, a hash
    of the place, as a common gram would pile them up in one task."""
    side = length - GRAM

    def run(batches):
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text").cast(pa.binary())]
            ids, ties = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tie"))
            hs, cs, who, spot = [], [], [], []
            digest = xxhash.xxh3_64_intdigest
            for d, (at, h) in enumerate(anchors(texts, length)):
                data, n = texts[d], len(texts[d])
                hs.append(h)
                # the sides' lengths tell contexts at the ends of a text from those inside
                cs += [digest(data[max(0, p - side):p + length], seed=min(p, side) << 8 | min(n - p - GRAM, side))
                       for p in at.tolist()]
                who.append(np.full(len(at), ids[d], np.int64))
                spot.append(ties[d] << 32 | at)
            if not hs:
                continue
            h, c, who, spot = np.concatenate(hs), _u64(cs), np.concatenate(who), np.concatenate(spot)
            mix = (h.view(np.uint64) * _ODD) ^ c.view(np.uint64)
            order = np.argsort(mix)
            again = np.flatnonzero(mix[order[1:]] == mix[order[:-1]])
            some = np.zeros(len(h), bool)
            some[order[again]] = some[order[again + 1]] = True
            o = np.flatnonzero(some)
            o = o[np.lexsort((spot[o], who[o], c[o], h[o]))]
            same = np.concatenate([[False], (h[o[1:]] == h[o[:-1]]) & (c[o[1:]] == c[o[:-1]])])[:len(o)]
            twin = np.concatenate([[False], (who[o[1:]] == who[o[:-1]]) & (spot[o[1:]] == spot[o[:-1]])])[:len(o)]
            known = np.zeros(len(h), bool)
            known[o[same & ~twin]] = True  # a twin is the same place of a repeated row
            place = ((who.view(np.uint64) * _ODD) ^ spot.view(np.uint64)) * _ODD
            h = np.where(known, place.view(np.int64), h)
            cols = [pa.array(h), pa.array(c, mask=known), pa.array(who), pa.array(spot)]
            yield pa.RecordBatch.from_arrays(cols, names=["h", "ctx", "id", "spot"])

    return rows.select("id", "tie", "text").mapInArrow(run, "h bigint, ctx bigint, id bigint, spot bigint")


def repeated(rows: DataFrame, length: int) -> DataFrame:
    """The occurrences whose gram occurs more than once, and the covered ones. Counting needs the grams only, which come
    straight from the windows' hashes; the contexts are hashed in the second pass."""
    occ = occurrences(rows, length)
    often = (grams(rows, length).groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
             .select(F.col("h").alias("often")))
    j = occ.join(often, F.col("h") == F.col("often"), "left")
    return j.where(F.col("ctx").isNull() | F.col("often").isNotNull()).select("often", "ctx", "id", "spot").toDF(
        "h", "ctx", "id", "spot")


def text_tasks(rep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(covered spots ``id, spot``; context tasks ``id, spot, h, c``): of equal contexts the first stands for all."""
    live = rep.where("ctx is not null")
    classes = live.groupBy("h", "ctx").agg(F.min(F.struct("id", "spot")).alias("first"),
                                           F.count(F.lit(1)).alias("n"))
    firsts = (classes.where("n > 1").select(F.struct("h", "ctx").alias("hc"), "first"))
    later = (live.withColumn("hc", F.struct("h", "ctx")).join(firsts, "hc")
             .where((F.col("id") != F.col("first.id")) | (F.col("spot") != F.col("first.spot"))).select("id", "spot"))
    known = rep.where("ctx is null").select("id", "spot")
    several = classes.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("h").alias("h2"), "c")
    tasks = (classes.join(several, F.col("h") == F.col("h2"))
             .select(F.col("first.id").alias("id"), F.col("first.spot").alias("spot"), "h", "c"))
    return known.unionByName(later), tasks


def finish(n: int, data: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, str]:
    """(removed bytes, maximal removed runs, SHA-256 of the rest)."""
    runs: list[list[int]] = []
    for a, b in sorted(ranges):
        a, b = max(a, 0), min(b, n)
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        elif a < b:
            runs.append([a, b])
    sha, at = hashlib.sha256(), 0
    for a, b in runs:
        sha.update(data[at:a])
        at = b
    sha.update(data[at:])
    return sum(b - a for a, b in runs), len(runs), sha.hexdigest()


MET = ("doc_id bigint, id bigint, tie bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
       "text string, ranges array<bigint>, tasks array<struct<p:bigint,h:bigint,c:bigint>>")


def meet_texts(rows: DataFrame, spots: DataFrame, tasks: DataFrame, length: int) -> DataFrame:
    """Every row with its result, or, if suffix-array tasks are open, with its text, ranges and tasks."""
    side = length - GRAM
    tie, pos = F.shiftright("spot", 32), F.col("spot").bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint"))
    per = (spots.select("id", tie.alias("tie"), pos.alias("p"), F.lit(None).cast("bigint").alias("h"),
                        F.lit(None).cast("bigint").alias("c"))
           .unionByName(tasks.select("id", tie.alias("tie"), pos.alias("p"), "h", "c"))
           .groupBy("id", "tie").agg(
               F.collect_set(F.when(F.col("h").isNull(), F.col("p"))).alias("spots"),  # repeated rows repeat their places
               F.collect_list(F.when(F.col("h").isNotNull(), F.struct("p", "h", "c"))).alias("tasks")))
    met = rows.join(per, ["id", "tie"], "left").select("doc_id", "id", "tie", "text", "spots", "tasks")

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "ranges", "tasks")}
            texts = batch.column("text").cast(pa.binary())
            spots_, tasks_ = batch.column("spots"), batch.column("tasks")
            for i in range(batch.num_rows):
                data = texts[i].as_buffer().to_pybytes()
                n = len(data)
                ranges = [(max(0, p - side), min(n, p + length)) for p in spots_[i].as_py() or ()]
                todo = tasks_[i].as_py() or []
                removed, spans, sha = finish(n, data, ranges) if not todo else (None, None, None)
                flat = [x for r in ranges for x in r] if todo else None
                for k, v in zip(out, (n, removed, spans, sha, data.decode() if todo else None, flat, todo or None),
                                strict=True):
                    out[k].append(v)
            task = pa.list_(pa.struct([("p", pa.int64()), ("h", pa.int64()), ("c", pa.int64())]))
            types = [pa.int64()] * 3 + [pa.string(), pa.string(), pa.list_(pa.int64()), task]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "id", "tie")]
                + [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)],
                names=["doc_id", "id", "tie", *out])

    return met.mapInArrow(run, MET)


def contexts(opened: DataFrame, length: int) -> DataFrame:
    """``h, c, id, spot, lefts (reversed), rights`` of every open task."""
    t = opened.select("id", "tie", F.col("text").cast("binary").alias("data"), F.explode("tasks").alias("t"))
    p, side = F.col("t.p").cast("int"), length - GRAM
    left = F.least(p, F.lit(side))
    data = F.col("data")
    return t.select(
        "t.h", "t.c", "id", (F.shiftleft("tie", 32) + F.col("t.p")).alias("spot"),
        data.substr(p - left + 1, left).alias("left"), data.substr(p + GRAM + 1, F.lit(side)).alias("right"),
        data.substr(p + 1, F.lit(GRAM)).alias("gram"))


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    k, m, step = 0, min(len(a), len(b)), 64
    while step and k < m:  # lengthen by equal blocks, halving them
        if a[k:k + step] == b[k:k + step] and k + step <= m:
            k += step
        else:
            step //= 2
    return k


def _breaks(sides: list[bytes]) -> list[int]:
    """Places where some pair of the strings starts to differ (or one ends): the common prefixes of sorted neighbours."""
    s = sorted(set(sides))
    return sorted({_common(a, b) for a, b in zip(s, s[1:], strict=False)})


def _reach(sides: list[bytes]) -> list[int]:
    """The longest prefix that each string has in common with another one: with a neighbour in sorted order."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    best = [0] * len(sides)
    for i, j in zip(order, order[1:], strict=False):
        k = _common(sides[i], sides[j])
        best[i], best[j] = max(best[i], k), max(best[j], k)
    return best


def may_match(group: list[tuple[bytes, bytes]], length: int) -> list[int]:
    """Numbers of the contexts that have, on both sides of the gram together, enough bytes in common with others (not
    necessarily the same one) for a window of ``length`` bytes."""
    left, right = _reach([g[0] for g in group]), _reach([g[1] for g in group])
    return [i for i, (a, b) in enumerate(zip(left, right, strict=True)) if a + b >= length - GRAM]


def covered_ranges(group: list[tuple[bytes, bytes]], length: int) -> list[tuple[int, int] | None]:
    """For contexts (reversed left side, right side) of one gram in order of occurrence: the bytes before and after the
    gram's start that are covered by a string which an earlier context has too, or None."""
    code: dict = {}
    lefts, rights = _breaks([g[0] for g in group]), _breaks([g[1] for g in group])
    held: list[int] = [0]  # contexts that hold a symbol

    def runs(s: bytes, at: list[int], which: int) -> list[tuple[int, int]]:
        cuts = [0, *[x for x in at if 0 < x < len(s)], len(s)]
        out = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                sym = code.setdefault((which, a, s[a:b]), len(code) + 1)
                if sym == len(held):
                    held.append(0)
                held[sym] += 1
                out.append((sym, b - a))
        return out

    sides = [(runs(left, lefts, 0), runs(right, rights, 1)) for left, right in group]
    # beyond a symbol that no other context has, on either side, nothing around the gram is shared
    sides = [tuple(list(itertools.takewhile(lambda e: held[e[0]] > 1, side)) for side in both) for both in sides]
    gram, lone = len(held), len(held) + 1
    t, width, owner, ahead = [], [], [], []
    for x, both in enumerate(sides):
        left, right = both
        back = sum(w for _, w in left)
        for sym, w in reversed(left):
            t.append(sym), width.append(w), owner.append(x), ahead.append(back)
            back -= w
        t.append(gram), width.append(GRAM), owner.append(x), ahead.append(0)
        for sym, w in right:
            t.append(sym), width.append(w), owner.append(x), ahead.append(-1)
        t.append(lone), width.append(0), owner.append(x), ahead.append(-1)
        lone += 1
    t.append(0), width.append(0), owner.append(-1), ahead.append(-1)
    return _read_off(t, width, owner, ahead, len(group), length)


def _read_off(t, width, owner, ahead, count, length) -> list[tuple[int, int] | None]:
    sa = suffix_array(t)
    lcp = lcp_array(t, sa)
    upto = [0]
    for w in width:
        upto.append(upto[-1] + w)
    out: list[tuple[int, int] | None] = [None] * count
    n = len(sa)
    common = [upto[i + k] - upto[i] for i, k in zip(sa, lcp, strict=True)]  # in bytes, with the suffix before
    for direction in (1, -1):
        stack: list[tuple[int, int]] = []  # (owner, common bytes with the entry above it), owners rising
        r = 0 if direction == 1 else n - 1
        while 0 <= r < n:
            link = common[r] if direction == 1 else (common[r + 1] if r + 1 < n else 0)
            if link < length:
                stack = []
            x = owner[sa[r]]
            while stack and stack[-1][0] >= x:
                link = min(link, stack.pop()[1])
            i = sa[r]
            if stack and ahead[i] >= 0 and link >= length:
                a, b = ahead[i], link - ahead[i]
                old = out[x]
                out[x] = (max(a, old[0]), max(b, old[1])) if old else (a, b)
            stack.append((x, link))
            r += direction
    return out


def sorted_groups(ctx: DataFrame, length: int) -> DataFrame:
    """Covered ranges ``id, spot, back, ahead`` from the suffix arrays of the grams with up to GROUP contexts."""
    dealt = ctx.select("h", "id", "spot", "left", "right").repartition("h").sortWithinPartitions("h", "id", "spot")

    def run(batches):
        def done(rows):
            sides = [(r[2][::-1], r[3]) for r in rows]
            some = may_match(sides, length)
            got = covered_ranges([sides[i] for i in some], length) if some else []
            return [(*rows[i][:2], *g) for i, g in zip(some, got, strict=True) if g]

        held, last, out = [], None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("h", "id", "spot", "left", "right")]
            for h, i, spot, left, right in zip(*cols, strict=True):
                if h != last:
                    if len(held) > 1:
                        out += done(held)
                    held, last = [], h
                held.append((i, spot, left, right))
            if len(out) > 20_000:
                yield _ranges(out)
                out = []
        if len(held) > 1:
            out += done(held)
        if out:
            yield _ranges(out)

    return dealt.mapInArrow(run, "id bigint, spot bigint, back bigint, ahead bigint")


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                      names=["id", "spot", "back", "ahead"])


def spread_groups(ctx: DataFrame, length: int) -> DataFrame:
    """The same for grams with more contexts: each window is a row, its first occurrence the smallest of an aggregate."""
    whole = F.concat("left", "gram", "right")
    size = F.length(whole)
    at = F.explode(F.sequence(F.lit(0), size - length))
    w = (ctx.where(size >= length).select("h", "id", "spot", F.length("left").alias("l"), whole.alias("s"), at.alias("o"))
         .select("h", "id", "spot", "l", "o", (F.col("l") - F.col("o")).alias("back"),
                 F.col("s").substr(F.col("o") + 1, F.lit(length)).alias("s")))
    w = w.select("id", "spot", "back", F.struct("h", "back", F.xxhash64("s"), F.hash("s")).alias("win"))
    first = w.groupBy("win").agg(F.min(F.struct("id", "spot")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.struct("win").alias("key"), "first")
    later = (w.withColumn("key", F.struct("win")).join(first, "key")
             .where((F.col("id") != F.col("first.id")) | (F.col("spot") != F.col("first.spot"))))
    return later.groupBy("id", "spot").agg(F.max("back").cast("bigint").alias("back"),
                                           F.max(F.lit(length) - F.col("back")).cast("bigint").alias("ahead"))


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text",
                   group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``."""
    if length < GRAM + 1:
        raise ValueError(f"length must exceed {GRAM}")
    rows = order_columns(docs, id_col, text_col)
    spark = docs.sparkSession
    staged = shared_folder(spark, "suffix-dedup-grams")  # Parquet packs these rows better than a checkpoint does
    with shuffles_freed(spark):
        repeated(rows, length).write.parquet(staged)
    rep = spark.read.schema("h long, ctx long, id long, spot long").parquet(staged)
    spots, tasks = text_tasks(rep)
    folder = shared_folder(spark, "suffix-dedup")
    with shuffles_freed(spark):
        meet_texts(rows, spots, tasks, length).write.parquet(folder)
    met = spark.read.schema(MET).parquet(folder)
    opened = met.where("tasks is not null")
    ctx = contexts(opened, length)
    found = cut(sorted_groups(ctx.where(F.col("c") <= group), length)
                .unionByName(spread_groups(ctx.where(F.col("c") > group), length)))
    tie, pos = F.shiftright("spot", 32), F.col("spot").bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint"))
    more = (found.select("id", tie.alias("tie"), F.array(pos - F.col("back"), pos + F.col("ahead")).alias("r"))
            .groupBy("id", "tie").agg(F.flatten(F.collect_list("r")).alias("more")))

    def run(batches):
        for batch in batches:
            n, removed, spans, sha = [], [], [], []
            texts = batch.column("text").cast(pa.binary())
            for i in range(batch.num_rows):
                data = texts[i].as_buffer().to_pybytes()
                flat = (batch.column("ranges")[i].as_py() or []) + (batch.column("more")[i].as_py() or [])
                a, b, c = finish(len(data), data, list(zip(flat[::2], flat[1::2], strict=True)))
                n.append(len(data)), removed.append(a), spans.append(b), sha.append(c)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n, removed, spans)], pa.array(sha)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    late = (opened.select("doc_id", "id", "tie", "text", "ranges").join(more, ["id", "tie"], "left")
            .select("doc_id", "text", "ranges", "more")
            .mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"))
    early = met.where("tasks is null").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return early.unionByName(late)
