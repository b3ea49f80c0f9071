"""Benchmark decontamination: pigeonhole edit matching.

A test item of m normalised characters may occur in a document with up to ``k = floor(rate * m)`` edits. It is cut into
k + 1 pieces; at least one of them must then occur unchanged. All pieces go into one Aho-Corasick automaton, every
document is scanned whole, and each hit is verified with Myers' bit-parallel distance (one integer of m bits per
step). The pieces are made by halving, item and budget together, so a hit is verified on the pair of pieces it belongs
to, then on wider ranges, and on the whole item only if all of them stay within their budgets.

Items of any length are matched whole. They are read in blocks of about ``BLOCK_CHARS`` characters, chosen by a hash; a
block's hits are written to the shared folder before the next block is read, so the automaton that goes to the executors
is bounded and the driver holds one block at a time. Documents are scanned once per block.

Normalised means lower case with runs of white space as one blank; positions refer to the normalised document.
Defined cases: null and blank texts and items match nothing; an item shorter than 1 / rate characters must occur
unchanged; repeated items with one id, and rows with one doc_id, give one row per pair; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted, shared_folder

RATE = 0.1
BLOCK_CHARS = 4_000_000
HIT = "array<struct<item_id:bigint,distance:int,match_start:int,match_end:int>>"


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(a: int, b: int, k: int, above: tuple = ()) -> list[tuple[int, int, tuple]]:
    """The k + 1 pieces of range a … b, each with the ranges (a, b, budget) it is nested in, smallest first.

    A range with budget k is halved into budgets that sum to k - 1: within k edits in all, one half stays in its own.
    """
    if k == 0:
        return [(a, b, above)]
    left = (k - 1) // 2
    mid = a + (b - a) * (left + 1) // (k + 1)
    above = ((a, b, k), *above)
    return pieces(a, mid, left, above) + pieces(mid, b, k - 1 - left, above)


def myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Smallest edit distance of the pattern to any part of ``text``, and the (first) end of such a part."""
    ones, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, d = ones, 0, m
    best, at = m, 0
    for j, ch in enumerate(text):
        eq = masks.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & ones
        mh = pv & xh
        if ph & top:
            d += 1
        elif mh & top:
            d -= 1
        ph <<= 1
        pv = (mh << 1 | ~(xv | ph)) & ones
        mv = ph & xv & ones
        if d < best:
            best, at = d, j + 1
    return best, at


def masks_of(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        out[ch] = out.get(ch, 0) | 1 << i
    return out


class Matcher:
    """Search of one block of items in whole texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.parts, self.masks, where = [], {}, {}
        for item_id, text in items:
            p = normal(text)
            if not p:
                continue
            self.parts.append((item_id, p))
            for a, b, above in pieces(0, len(p), int(rate * len(p))):
                where.setdefault(p[a:b], []).append((len(self.parts) - 1, a, b, above))
        self.auto = ahocorasick.Automaton()
        for piece, places in where.items():
            self.auto.add_word(piece, places)
        if where:
            self.auto.make_automaton()
        self.any = bool(where)

    def _masks(self, part: int, a: int, b: int, back: bool = False) -> dict[str, int]:
        key = part, a, b, back
        if key not in self.masks:
            text = self.parts[part][1][a:b]
            self.masks[key] = masks_of(text[::-1] if back else text)
        return self.masks[key]

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best place of every item within its budget."""
        if not text or not self.any:
            return []
        doc = normal(text)
        found: dict[int, tuple[int, int, int]] = {}
        for end, places in self.auto.iter(doc):
            for part, a, b, above in places:
                old = found.get(part)
                if old and (old[0] == 0 or old[1] <= end <= old[2]):
                    continue
                got = self._verify(doc, part, end + 1 - (b - a), a, above)
                if got and (old is None or got < old):
                    found[part] = got
        best: dict = {}
        for part, got in found.items():
            item_id = self.parts[part][0]
            if item_id not in best or got < best[item_id]:
                best[item_id] = got
        return [(i, *got) for i, got in sorted(best.items(), key=lambda x: (x[0] is None, x[0] or 0))]

    def _verify(self, doc: str, part: int, at: int, a: int, above: tuple) -> tuple[int, int, int] | None:
        """Widen an exact piece hit through its nested ranges; each must stay within its own budget."""
        p = self.parts[part][1]
        start, m = at - a, len(p)
        if start >= 0 and doc.startswith(p, start):
            return 0, start, start + m
        k = above[-1][2] if above else 0
        if not above:
            return None
        for lo, hi, budget in above:
            first = max(0, start + lo - budget)
            d, e = myers(self._masks(part, lo, hi), hi - lo, doc[first:start + hi + budget])
            if d > budget:
                return None
        upto = first + e
        _, back = myers(self._masks(part, 0, m, True), m, doc[first:upto][::-1][:m + k])
        return d, upto - back, upto


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """(number of blocks, the blocks): the items in blocks of about ``block_chars`` characters, read one by one; each block is
    small enough to broadcast."""
    items = (benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("bigint"), "text").distinct())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars) or 1

    def read() -> Iterator[list[tuple[int, str]]]:
        for b in range(n):
            rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()
            yield [(r.item_id, r.text) for r in rows]
    return n, read()


def _search(items: list[tuple[int, str]], rate: float):
    @F.pandas_udf(HIT)
    def hits(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Matcher(items, rate)
        for s in parts:
            yield s.map(lambda t: [dict(zip(("item_id", "distance", "match_start", "match_end"), h, strict=True))
                                   for h in m.search(t)])
    return hits


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per (doc_id, item_id) within the budget: the smallest distance and its place."""
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession, "decontaminate")
    n, blocks = item_blocks(benchmark)
    for b, items in enumerate(blocks):
        found = docs.select(F.col(quoted(id_col)).alias("doc_id"),
                            F.explode(_search(items, rate)(F.col(quoted(text_col)))).alias("h")).select("doc_id", "h.*")
        found.write.parquet(f"{folder}/{b}")
    out = spark.read.schema(found.schema).parquet(*[f"{folder}/{b}" for b in range(n)])
    best = F.min(F.struct("distance", "match_start", "match_end")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text",
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` without any match, with their columns. With several blocks the hashes of the matching texts are
    written per block, and the rows that have one go."""
    n, blocks = item_blocks(benchmark, block_chars)
    text = F.col(quoted(text_col))
    hits, h = fresh(docs, "hits", "text_hash")
    if n == 1:
        found = docs.withColumn(hits, F.size(_search(next(blocks), rate)(text)))
        return found.where(F.col(hits) == 0).drop(hits)
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession, "decontaminate")
    digest = F.sha2(text, 256)
    for b, items in enumerate(blocks):
        (docs.select(digest.alias(h), F.size(_search(items, rate)(text)).alias(hits)).where(F.col(hits) > 0)
         .select(h).distinct().write.parquet(f"{folder}/{b}"))
    found = spark.read.schema(f"{quoted(h)} string").parquet(*[f"{folder}/{b}" for b in range(n)]).distinct()
    return docs.withColumn(h, digest).join(found, h, "left_anti").select(*[F.col(quoted(c)) for c in docs.columns])
