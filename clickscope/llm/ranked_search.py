"""Ranked lexical search: best-first over document intervals, bounded by range-maximum tables of the posting lists.

Every query item ranks all documents by a sum of integer impacts, one for each item term that a document holds. Documents
are read once into rows of (id, length, item terms with frequencies), which are staged in the shared folder; corpus
counts (documents, terms, documents per term) are exact aggregates over all rows. Then every task takes its staged
documents in chunks and searches each chunk for all items:

1. the chunk's documents are put in an order that keeps like ones together, and every term gets a posting list in that
   order with the impact of each posting, and a sparse table of the positions of range maxima over it;
2. an interval of documents is bounded by the sum over the item's terms of the maximum impact inside it (two look-ups a
   term). The intervals with the largest bounds are split at the document of their largest single impact, which is
   scored exactly; intervals of at most ``LEAF`` documents are scored whole;
3. it ends when no bound can beat the k-th best found, also in the task's earlier chunks. A bound that equals the k-th
   score counts while the interval holds a smaller id.

The lists of all tasks are merged per item. Items are taken in blocks of about ``BLOCK_CHARS`` characters by hash; a block's
terms go to the tasks, its results to the shared folder, and only then the next block is read, so the driver holds one
block at a time.

Defined cases: null and empty texts, and texts without a term, are no documents and match nothing; items without a
term, or whose terms occur nowhere, have no rows; equal scores rank by ascending id, null ids last; rows that repeat an
id are documents of their own and may both be ranked; an item (id and text) that is repeated counts once; items with one
id and different texts are ranked apart; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, shared_folder

# Bytes that end a term (all other ASCII bytes are digits and letters; later bytes belong to terms).
BREAKS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
FOLD = bytes(0x20 if b in set(BREAKS) else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
SCALE, LOW, SPAN = 1_000_000_000, 10, 90  # score resolution; a document's m is LOW + SPAN * (its length / the mean)
CHUNK = 1 << 20        # postings that a task indexes at once (one document more at most)
CHUNK_DOCS = 1 << 15
LEAF = 16              # documents of an interval that is scored whole
WIDTH = 64             # intervals taken at once
BLOCK_CHARS = 4_000_000


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, ASCII letters lower-cased."""
    return text.translate(FOLD).split()


def weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df.astype(np.float64) + 1))).astype(np.int64)


def length_norm(length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents; exact also where the product leaves 64 bits."""
    if len(length) and int(length.max()) * n_docs * SPAN >= 1 << 63:
        return np.array([LOW + SPAN * int(n) * n_docs // n_terms for n in length], np.int64)
    return LOW + SPAN * length * n_docs // max(n_terms, 1)


# ------------------------------------------------------------------ staged documents

STAGED = "length bigint, terms array<int>, tfs array<int>"


def staged_rows(docs: DataFrame, numbers: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``id, length, terms, tfs`` of every document with a term; ``terms`` holds the numbers of the item terms in it."""
    def run(batches):
        get = numbers.get
        width = len(numbers) + 1
        for batch in batches:
            keep, lengths, found, owner = [], [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                words = terms_of(text) if text else ()
                if not words:
                    continue
                mine = [t for t in map(get, words) if t is not None]
                found += mine
                owner.append(len(mine))
                keep.append(i)
                lengths.append(len(words))
            if not keep:
                continue
            key = np.repeat(np.arange(len(keep)), owner) * width + np.array(found, np.int64)
            key.sort()
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            tf = np.diff(np.append(first, len(key)))
            key = key[first]
            ends = np.searchsorted(key, np.arange(len(keep) + 1) * width)
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (key % width, tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array(lengths, pa.int64()), *lists],
                                             names=["id", "length", "terms", "tfs"])

    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *T._parse_datatype_string(STAGED).fields])
    return rows.mapInArrow(run, schema)


# ------------------------------------------------------------------ index of one chunk

class RangeMax:
    """Sparse table: positions of range maxima in constant time, for many ranges at once. Level k holds, for every i, the
    position of the maximum of values[i : i + 2**k]."""

    def __init__(self, values: np.ndarray, longest: int):
        self.values = values
        self.table = np.zeros((max(longest, 1).bit_length(), len(values)), np.int32)
        self.table[0] = np.arange(len(values))
        for k in range(1, len(self.table)):
            half = 1 << (k - 1)
            a = self.table[k - 1, :len(values) - 2 * half + 1]
            b = self.table[k - 1, half:len(values) - half + 1]
            self.table[k, :len(a)] = np.where(values[a] >= values[b], a, b)
        self.log = np.zeros(max(longest, 1) + 1, np.int8)
        self.log[1:] = np.floor(np.log2(np.arange(1, len(self.log)))).astype(np.int8)

    def at(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Positions of the maxima of values[left:right]; the ranges aren't empty."""
        k = self.log[right - left]
        a = self.table[k, left]
        b = self.table[k, right - (1 << k.astype(np.int64))]
        return np.where(self.values[a] >= self.values[b], a, b)


class Index:
    """Posting lists of a chunk. ``tie`` ranks the documents by id."""

    def __init__(self, owner: np.ndarray, terms: np.ndarray, impact: np.ndarray, tie: np.ndarray, n_terms: int):
        self.n, self.tie = len(tie), tie
        order = np.argsort(terms * self.n + owner, kind="stable")
        self.doc, self.impact = owner[order], impact[order]
        self.key = terms[order] * self.n + self.doc
        self.start = np.searchsorted(self.key, np.arange(n_terms + 1) * self.n)
        longest = int(np.diff(self.start).max(initial=1))
        self.best = RangeMax(self.impact, longest)
        self.first_id = RangeMax(-tie, self.n)

    def _bounds(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bound of every row of ranges (one per term), and place and value of its largest impact."""
        full = right > left
        place = np.where(full, self.best.at(np.where(full, left, 0), np.where(full, right, 1)), 0)
        value = np.where(full, self.impact[place], 0)
        top = value.argmax(1)
        rows = np.arange(len(left))
        return value.sum(1), place[rows, top], value[rows, top]

    def search(self, terms: np.ndarray, k: int, floor: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) among which are the chunk's k best above ``floor`` (score, tie): scores above it, or equal
        ones of a smaller tie."""
        left, right = self.start[terms], self.start[terms + 1]
        full = right > left
        terms, left, right = terms[full], left[full][None], right[full][None]
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(terms):
            return found, scores
        base = terms * self.n
        lo, hi = np.array([0]), np.array([self.n])
        bound, place, value = self._bounds(left, right)
        while True:
            if len(found) >= k:
                order = np.lexsort((self.tie[found], -scores))[:k]
                found, scores = found[order], scores[order]
                last = (int(scores[-1]), int(self.tie[found[-1]]))
                if last[0] > floor[0] or (last[0] == floor[0] and last[1] < floor[1]):
                    floor = last
            live = bound > floor[0]
            even = np.flatnonzero(bound == floor[0])
            if len(even):
                live[even] = -self.first_id.values[self.first_id.at(lo[even], hi[even])] < floor[1]
            live &= value > 0
            if not live.all():
                lo, hi, left, right = lo[live], hi[live], left[live], right[live]
                bound, place, value = bound[live], place[live], value[live]
            if not len(lo):
                return found, scores
            take = np.zeros(len(lo), bool)
            take[np.argpartition(-bound, WIDTH)[:WIDTH] if len(lo) > WIDTH else slice(None)] = True
            small = take & (hi - lo <= LEAF)
            if small.any():
                d, s = self._score_all(lo[small], hi[small], left[small], right[small])
                found, scores = np.concatenate([found, d]), np.concatenate([scores, s])
            rest = ~take
            big = take & ~small
            parts = [(lo[rest], hi[rest], left[rest], right[rest], bound[rest], place[rest], value[rest])]
            if big.any():
                d = self.doc[place[big]]
                at = np.searchsorted(self.key, base[None] + d[:, None])
                there = at < right[big]
                there &= self.doc[np.where(there, at, 0)] == d[:, None]
                found = np.concatenate([found, d])
                scores = np.concatenate([scores, np.where(there, self.impact[np.where(there, at, 0)], 0).sum(1)])
                for a, b, x, y in ((lo[big], d, left[big], at), (d + 1, hi[big], at + there, right[big])):
                    some = b > a
                    if some.any():
                        a, b, x, y = a[some], b[some], x[some], y[some]
                        parts.append((a, b, x, y, *self._bounds(x, y)))
            lo, hi, left, right, bound, place, value = (np.concatenate(p) for p in zip(*parts, strict=True))

    def _score_all(self, lo, hi, left, right) -> tuple[np.ndarray, np.ndarray]:
        """All documents of disjoint intervals that hold a term, with their scores."""
        size = (right - left).ravel()
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(left.ravel() - ends + size, size)
        row = np.repeat(np.arange(len(lo)), size.reshape(left.shape).sum(1))
        slot = row * LEAF + self.doc[at] - lo[row]
        total = np.bincount(slot, self.impact[at], minlength=len(lo) * LEAF)  # sums stay far below 2**53: exact
        hit = np.flatnonzero(total > 0)
        return lo[hit // LEAF] + hit % LEAF, total[hit].astype(np.int64)


def like_order(owner: np.ndarray, terms: np.ndarray, impact: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """An order of the documents that puts like ones side by side: by the term of their largest impact, then by length."""
    top = np.full(len(lengths), -1, np.int64)
    order = np.lexsort((impact, owner))
    last = np.flatnonzero(np.concatenate([owner[order][1:] != owner[order][:-1], [True]])) if len(order) else order
    top[owner[order[last]]] = terms[order[last]]
    return np.lexsort((lengths, top))


# ------------------------------------------------------------------ search over all chunks

def _id_ranks(ids: pa.Array) -> np.ndarray:
    """Ranks of the ids of a chunk, nulls last; equal ids follow each other."""
    order = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()
    out = np.empty(len(ids), np.int64)
    out[order] = np.arange(len(ids))
    return out


def _id_key(value):
    return (value is None, value)


class Searcher:
    """Best documents of every item over the chunks of one task."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
        self.items, self.weights, self.n_docs, self.n_terms, self.k = items, weights, n_docs, n_terms, k
        self.top: list[list[tuple]] = [[] for _ in items]  # (score, id), best first

    def add(self, ids: pa.Array, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        owner = np.repeat(np.arange(len(sizes)), sizes)
        m = length_norm(lengths, self.n_docs, self.n_terms)
        impact = self.weights[terms] * ((SCALE * tfs) // (1000 * tfs + 8 * m[owner]))
        order = like_order(owner, terms, impact, lengths)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        ids = ids.take(pa.array(order))
        tie = _id_ranks(ids)
        index = Index(place[owner], terms, impact, tie, len(self.weights))
        values = ids.to_pylist()
        by_tie = [None] * len(values)
        for v, t in zip(values, tie.tolist(), strict=True):
            by_tie[t] = _id_key(v)
        for i, item in enumerate(self.items):
            top, floor = self.top[i], (0, 0)
            if len(top) == self.k:
                floor = (top[-1][0], _below(by_tie, _id_key(top[-1][1])))
            docs, scores = index.search(item, self.k, floor)
            if len(docs):
                top += [(s, values[d]) for d, s in zip(docs.tolist(), scores.tolist(), strict=True) if s > 0]
                top.sort(key=lambda e: (-e[0], _id_key(e[1])))
                del top[self.k:]


def _below(keys: list, key) -> int:
    import bisect
    return bisect.bisect_left(keys, key)


def _chunks(batches):
    """Staged rows in chunks of bounded postings: (ids, lengths, postings per document, terms, tfs)."""
    held, postings, docs = [], 0, 0
    for batch in batches:
        at = 0
        sizes = pa.compute.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(sizes)
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = min(int(np.searchsorted(total, before + CHUNK - postings)) + 1, at + CHUNK_DOCS - docs, batch.num_rows)
            part = batch.slice(at, end - at)
            held.append((part.column(0), part.column(1).to_numpy(), sizes[at:end], part.column(2).flatten().to_numpy(),
                         part.column(3).flatten().to_numpy()))
            postings += int(total[end - 1] - before)
            docs += end - at
            at = end
            if postings >= CHUNK or docs >= CHUNK_DOCS:
                yield _joined(held)
                held, postings, docs = [], 0, 0
    if held:
        yield _joined(held)


def _joined(held):
    ids, *rest = zip(*held, strict=True)
    return pa.concat_arrays(ids), *[np.concatenate(x).astype(np.int64) for x in rest]


def _top_rows(staged: DataFrame, items, weights, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Each task's best documents of every item: ``item, doc_id, score``."""
    id_type = staged.schema["id"].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", id_type),
                           T.StructField("score", T.LongType())])

    def run(batches):
        searcher, kind = Searcher(items, weights, n_docs, n_terms, k), None
        for ids, *arrays in _chunks(batches):
            kind = ids.type
            searcher.add(ids, *arrays)
        rows = [(i, d, s) for i, top in enumerate(searcher.top) for s, d in top]
        if rows:
            i, d, s = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(d, kind), pa.array(s, pa.int64())],
                                             names=["item", "doc_id", "score"])
    return staged.mapInArrow(run, schema)


def _search_block(spark: SparkSession, docs: DataFrame, block: list, k: int, id_col: str, text_col: str) -> DataFrame:
    """``item, rank, doc_id, score`` of one block; ``item`` counts the rows of ``block``."""
    numbers: dict[bytes, int] = {}
    items = []
    for r in block:
        mine = {numbers.setdefault(t, len(numbers)) for t in terms_of((r["text"] or "").encode())}
        items.append(np.array(sorted(mine), np.int64))
    folder = shared_folder(spark, "ranked-search")
    rows = staged_rows(docs, numbers, id_col, text_col)
    rows.write.parquet(folder)
    staged = spark.read.schema(rows.schema).parquet(folder)
    n_docs, n_terms = staged.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    df = np.zeros(len(numbers), np.int64)
    # one row per item term of the block
    for r in staged.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        df[r["t"]] = r["df"]
    top = _top_rows(staged, items, weight(n_docs, df), n_docs, n_terms, k)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item", "rank", "doc_id", "score"))


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    items = items.select(F.col(quoted(item_col)).alias("item_id"), F.col(quoted(item_text_col)).alias("text")).distinct()
    size = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n_blocks = -(-size // BLOCK_CHARS) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    out_schema = T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()),
                               T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
    folder = shared_folder(spark, "ranked-search-found")
    for b in range(n_blocks):
        block = items.where(part == b).collect()
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)],
                                      T.StructType([T.StructField("item", T.IntegerType()), items.schema["item_id"]]))
        found = _search_block(spark, docs, block, k, id_col, text_col)
        found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score").write.parquet(f"{folder}/{b}")
    return spark.read.schema(out_schema).parquet(*[f"{folder}/{b}" for b in range(n_blocks)])
