"""Spelling variant grouping: k-d trees over letter-count vectors.

A word is near another if they differ by exactly one inserted, deleted or replaced code point. Such an edit moves the
vector of letter counts by an L1 distance of at most two: a replacement takes one letter and adds another, an insertion
adds one. So per pair of lengths (l, l) and (l, l + 1) a range search finds all words whose vectors are that close, and
comparing the letters in order confirms them.

1. ``count_words`` counts the words (runs of Latin letters) of all whole texts; partial counts before the shuffle.
2. A k-d tree for every length is fitted on a bounded sample of words (about ``SAMPLE`` words, by hash): it only decides
   which *cell* a word lies in, never which pairs are found. Every word goes to its cell, and as a probe to each cell of
   its own and the next length whose box lies within one edit. Cells with more than ``CELL`` words are dealt into
   chunks by hash, homes by probes, so that no task holds more.
3. Inside a chunk a local k-d tree over the homes (split at the median of the widest letter down to ``LEAF`` words) is
   searched for all probes at once: a box is pruned for the probes that are not within one edit of it, what is left at
   the leaves is compared by vector, then letter by letter.
4. ``forms`` takes each word's most frequent near word if it is ``ratio`` times as frequent, and follows these to the
   last. Counts grow by that ratio with every step, which bounds the steps, so pointers are doubled a fixed number of
   times.

Defined cases: null and empty texts have no words; a null id counts as the empty text in the noise hash; repeated rows
count repeatedly; ties of equal counts go to the smaller word in code-point order; an empty table gives an empty
result; other columns are ignored. Words may be of any length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, quoted

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
N_LETTERS = 26 + 64  # a-z, then U+00C0 … U+00FF
SAMPLE = 65_536      # words that the trees over cells are fitted on
CELL = 32_768        # words a cell is meant to hold
SAMPLE_LEAF = 64     # sampled words below which a cell is not split further
LEAF = 24            # words in a leaf of the trees inside a cell
PAIRS = 1 << 21      # letters compared at once
HOME, SAME, SHORTER = 0, 1, 2
NEAR = "word string, n_near bigint, best_n bigint, best string"


# ------------------------------------------------------------------ words

def noisy(run: Column, key: Column, every: int) -> Column:
    """``run`` without one code point where the crc32 of ``<key>:<run>`` is a multiple of ``every``."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
                  ).otherwise(run)


def count_words(docs: DataFrame, min_length: int = 6, min_count: int = 5, drop_every: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of the words with at least ``min_length`` code points and ``min_count`` occurrences. Only A-Z are
    lower-cased. ``drop_every`` drops a code point of some words by a hash of document and word."""
    text = F.translate(F.col(quoted(text_col)), UPPER, LOWER)
    runs = docs.select(F.col(quoted(id_col)).alias("key"),
                       F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= min_length)
    word = noisy(F.col("run"), F.col("key"), drop_every) if drop_every else F.col("run")
    return (runs.select(word.alias("word")).where(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# ------------------------------------------------------------------ vectors and trees

def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letter number of every code point, length of every word)."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where(points < 0xC0, points - ord("a"), points - 0xC0 + 26), np.fromiter(map(len, words), np.int64, len(words))


def vectors(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Letter counts, one row per word."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    counts = np.bincount(row * N_LETTERS + codes, minlength=len(lengths) * N_LETTERS).reshape(-1, N_LETTERS)
    top = lengths.max(initial=0)
    return counts.astype(np.int8 if top < 64 else np.int16 if top < 16_000 else np.int32)


class Tree:
    """Node of a k-d tree: the box of its points, and either two children or the points themselves."""

    __slots__ = ("high", "left", "low", "right", "rows")

    def __init__(self, points: np.ndarray, rows: np.ndarray, leaf: int):
        mine = points[rows]
        self.low, self.high = mine.min(0), mine.max(0)
        self.left = self.right = None
        self.rows = rows
        if len(rows) <= leaf:
            return
        axis = int(np.argmax(mine.std(0)))
        values = mine[:, axis]
        middle = np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2]
        if middle == self.high[axis]:
            middle -= 1
        below = values <= middle
        if below.all() or not below.any():  # all points alike
            return
        self.rows = None
        self.left, self.right = Tree(points, rows[below], leaf), Tree(points, rows[~below], leaf)

    def reached(self, probes: np.ndarray, rows: np.ndarray, added: int, taken: int) -> np.ndarray:
        """The ``rows`` of ``probes`` for which some vector in the box has at most ``added`` letters more and ``taken``
        less."""
        mine = probes[rows]
        more = np.maximum(self.low - mine, 0).sum(1, dtype=np.int32)
        less = np.maximum(mine - self.high, 0).sum(1, dtype=np.int32)
        return rows[(more <= added) & (less <= taken)]

    def leaves(self, probes: np.ndarray, added: int, taken: int):
        """(leaf, rows of the probes that reach its box)."""
        todo = [(self, np.arange(len(probes)))]
        while todo:
            node, rows = todo.pop()
            rows = node.reached(probes, rows, added, taken)
            if not len(rows):
                continue
            if node.left is None:
                yield node, rows
            else:
                todo += [(node.left, rows), (node.right, rows)]


class Cells:
    """Splits of one length's words into cells, fitted on a sample. Cells tile the whole space, so every word has one."""

    def __init__(self, points: np.ndarray, n_words: int):
        self.axis, self.at, self.child, self.n = [], [], [], 0
        share = n_words / max(len(points), 1)
        self._grow(points, max(SAMPLE_LEAF, int(CELL / share)))

    def _grow(self, points: np.ndarray, leaf: int) -> int:
        node = len(self.axis)
        self.axis.append(-1)
        self.at.append(0)
        self.child.append((0, 0))
        if len(points) > leaf:
            axis = int(np.argmax(points.std(0)))
            values = points[:, axis]
            middle = int(np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2])
            if middle == values.max():
                middle -= 1
            below = values <= middle
            if below.any() and not below.all():
                self.axis[node], self.at[node] = axis, middle
                self.child[node] = (self._grow(points[below], leaf), self._grow(points[~below], leaf))
                return node
        self.child[node] = (self.n, self.n)
        self.n += 1
        return node

    def route(self, probes: np.ndarray, added: int, taken: int) -> tuple[np.ndarray, np.ndarray]:
        """(probe row, cell) for all cells with a vector of at most ``added`` letters more and ``taken`` less."""
        rows_out, cells_out = [], []
        start = np.arange(len(probes))
        # per probe and axis the letters already used up by crossed splits; a split crossed again counts its excess only
        todo = [(0, start, np.zeros((len(probes), 2), np.int32), {})]
        while todo:
            node, rows, used, bounds = todo.pop()
            if not len(rows):
                continue
            axis = self.axis[node]
            if axis < 0:
                rows_out.append(rows)
                cells_out.append(np.full(len(rows), self.child[node][0]))
                continue
            value, at = probes[rows, axis].astype(np.int32), self.at[node]
            low, high = bounds.get(axis, (0, np.iinfo(np.int32).max))
            for side, (lo, hi) in enumerate(((low, min(high, at)), (max(low, at + 1), high))):
                change = np.stack([np.maximum(lo - value, 0) - np.maximum(low - value, 0),
                                   np.maximum(value - hi, 0) - np.maximum(value - high, 0)], 1)
                now = used + change
                ok = (now[:, 0] <= added) & (now[:, 1] <= taken)
                todo.append((self.child[node][side], rows[ok], now[ok], {**bounds, axis: (lo, hi)}))
        if not rows_out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows_out), np.concatenate(cells_out)


def fit_cells(words: DataFrame) -> dict[int, Cells]:
    """Cells of the lengths that have more words than one cell holds. To the driver go about ``SAMPLE`` words and one count
    per length."""
    sizes = words.groupBy(F.char_length("word").alias("l")).agg(F.count(F.lit(1)).alias("k"))
    counts = {r["l"]: r["k"] for r in sizes.where(F.col("k") > CELL).collect()}
    if not counts:
        return {}
    share = min(1.0, SAMPLE / sum(counts.values()))
    sample = words.where(F.char_length("word").isin(*counts)
                         & (F.pmod(F.xxhash64("word"), F.lit(1 << 40)) < int(share * (1 << 40))))
    by_length: dict[int, list[str]] = {}
    for r in sample.select("word").collect():
        by_length.setdefault(len(r["word"]), []).append(r["word"])
    return {k: Cells(vectors(*letters(sorted(w))), counts[k]) for k, w in by_length.items()}


# ------------------------------------------------------------------ routing and searching

ROUTED = "length int, cell int, role int, word string, n bigint"
ROUTED_ARROW = pa.schema([("length", pa.int32()), ("cell", pa.int32()), ("role", pa.int32()), ("word", pa.string()),
                          ("n", pa.int64())])


def _route(words: list[str], n: np.ndarray, cells: dict[int, Cells]):
    """(length, cell, role, row of ``words``) of homes and probes."""
    codes, lengths = letters(words)
    points = vectors(codes, lengths)
    for length in np.unique(lengths).tolist():
        mine = np.flatnonzero(lengths == length)
        for role, of, added, taken in ((HOME, length, 0, 0), (SAME, length, 1, 1), (SHORTER, length + 1, 1, 0)):
            if of in cells:
                rows, cell = cells[of].route(points[mine], added, taken)
                rows = mine[rows]
            else:
                rows, cell = mine, np.zeros(len(mine), np.int64)
            yield np.full(len(rows), of), cell, np.full(len(rows), role), rows


def routed(words: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    def run(batches):
        for batch in batches:
            w, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            if not w:
                continue
            parts = [np.concatenate(x) for x in zip(*_route(w, n, cells), strict=True)]
            rows = pa.array(parts[3])
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)) for p in parts[:3]]
                                             + [batch.column(0).take(rows), batch.column(1).take(rows)], schema=ROUTED_ARROW)
    return words.select("word", "n").mapInArrow(run, ROUTED)


def dealt(rows: DataFrame) -> DataFrame:
    """Routed rows with the chunk they meet in: homes of a cell of k * ``CELL`` words and its probes are dealt into k by k
    chunks by hash. One count per crowded cell goes to the driver (at most one per ``CELL`` words)."""
    size = (rows.where(F.col("role") == HOME).groupBy("length", "cell").agg(F.count(F.lit(1)).alias("size"))
            .where(F.col("size") > 2 * CELL).withColumn("k", F.ceil(F.col("size") / CELL).cast("int"))
            .select("length", "cell", "k"))
    mine = F.pmod(F.xxhash64("word"), F.col("k").cast("bigint")).cast("int")
    others = F.sequence(F.lit(0), F.col("k") - 1)
    split = rows.join(size, ["length", "cell"], "left").withColumn("k", F.coalesce("k", F.lit(1)))
    chunk = F.when(F.col("role") == HOME, F.transform(others, lambda j: mine * F.col("k") + j)).otherwise(
        F.transform(others, lambda i: i * F.col("k") + mine))
    return split.select("length", "cell", F.explode(chunk).alias("chunk"), "role", "word", "n")


class Homes:
    """The homes of one chunk and the tree over them."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        codes, lengths = letters(words)
        self.points = vectors(codes, lengths)
        self.codes = codes.astype(np.uint8).reshape(len(words), -1)
        self.rank = ranked(words, n)
        self.tree = Tree(self.points, np.arange(len(words)), LEAF)

    def near(self, words: list[str], role: int) -> tuple[np.ndarray, np.ndarray]:
        """(probe row, home row) of all near pairs."""
        codes, lengths = letters(words)
        probes, codes = vectors(codes, lengths), codes.astype(np.uint8).reshape(len(words), -1)
        probes = probes.astype(self.points.dtype)
        taken = 1 if role == SAME else 0
        found, homes = [], []
        wait, n_wait = [], 0
        step = max(1, PAIRS // max(self.codes.shape[1], 1))

        def confirm():
            q, p = (np.concatenate(x) for x in zip(*wait, strict=True))
            for i in range(0, len(q), step):
                a, b = q[i:i + step], p[i:i + step]
                ok = one_edit(codes[a], self.codes[b], role)
                found.append(a[ok])
                homes.append(b[ok])

        for leaf, rows in self.tree.leaves(probes, 1, taken):
            own = self.points[leaf.rows]
            block = max(1, PAIRS // (len(own) * N_LETTERS))
            for i in range(0, len(rows), block):
                q = rows[i:i + block]
                diff = own[None] - probes[q][:, None]
                ok = np.abs(diff).sum(2, dtype=np.int32) == (2 if role == SAME else 1)
                a, b = np.nonzero(ok)
                wait.append((q[a], leaf.rows[b]))
                n_wait += len(a)
                if n_wait > step:
                    confirm()
                    wait, n_wait = [], 0
        if n_wait:
            confirm()
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(homes)


def one_edit(a: np.ndarray, b: np.ndarray, role: int) -> np.ndarray:
    """Rows of letters that differ by one replacement (``SAME``), or by one letter more in ``b`` (``SHORTER``)."""
    if role == SAME:
        return (a != b).sum(1) == 1
    width = a.shape[1]
    front, back = a == b[:, :-1], (a == b[:, 1:])[:, ::-1]
    head = np.where(front.all(1), width, np.argmin(front, 1))
    tail = np.where(back.all(1), width, np.argmin(back, 1))
    return head + tail >= width


def ranked(words: list[str], n: np.ndarray) -> np.ndarray:
    """Rank of each word by descending count, then by code points."""
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    out = np.empty(len(words), np.int64)
    out[order] = np.arange(len(words))
    return out


def _best(of: np.ndarray, other: np.ndarray, of_words: list[str], words: list[str], n: np.ndarray, rank: np.ndarray):
    """One row per different ``of``: its word, near words, and the first-ranked of these."""
    order = np.lexsort((rank[other], of))
    of, other = of[order], other[order]
    starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    count = np.diff(np.append(starts, len(of)))
    top = other[starts]
    return pa.RecordBatch.from_arrays(
        [pa.array([of_words[i] for i in of[starts].tolist()], pa.string()), pa.array(count, pa.int64()),
         pa.array(n[top], pa.int64()), pa.array([words[i] for i in top.tolist()], pa.string())],
        names=["word", "n_near", "best_n", "best"])


def _search(batches):
    """Rows sorted by (length, cell, chunk, role): the homes of a chunk come before its probes."""
    chunk, homes, waiting = None, None, ([], [])
    for batch in batches:
        key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], 1)
        if not len(key):
            continue
        edges = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)])).tolist()
        words, n = batch.column(4).to_pylist(), batch.column(5).to_numpy(zero_copy_only=False)
        for lo, hi in zip(edges, [*edges[1:], len(key)], strict=True):
            at, role = tuple(key[lo, :3].tolist()), int(key[lo, 3])
            if at != chunk:
                chunk, homes, waiting = at, None, ([], [])
            if role == HOME:
                waiting[0].extend(words[lo:hi])
                waiting[1].append(n[lo:hi])
                continue
            if homes is None:
                if not waiting[0]:
                    continue
                homes = Homes(waiting[0], np.concatenate(waiting[1]))
            mine, counts = words[lo:hi], n[lo:hi]
            q, p = homes.near(mine, role)
            if len(q):
                yield _best(q, p, mine, homes.words, homes.n, homes.rank)
                if role == SHORTER:
                    yield _best(p, q, homes.words, mine, counts, ranked(mine, counts))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of the words (distinct, with their counts ``n``) that have near words: their number,
    and the most frequent of them."""
    rows = cut(routed(words, fit_cells(words)))
    sorted_rows = (dealt(rows).repartition("length", "cell", "chunk")
                   .sortWithinPartitions("length", "cell", "chunk", "role"))
    parts = sorted_rows.mapInArrow(_search, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("k"), "best"))
    return (parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.k")).alias("best_n"), F.col("b.best").alias("best")))


def forms(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of counted words: a word's form is its most frequent near word if that is
    at least ``ratio`` times as frequent; its root is the last of the forms' chain."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, so that chains of forms end")
    words = cut(words.select("word", "n"))
    found = near_words(words)
    has = F.col("best_n") >= F.col("n") * ratio
    out = cut(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")))
    top = words.agg(F.max("n")).first()[0] or 1
    links = out.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(math.log(top, ratio), 1))) + 1):
        nxt = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = cut(links.join(nxt, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return out.join(links, "word", "left").select("word", "n", "n_near", "form", "form_n",
                                                  F.coalesce("root", "word").alias("root"))
