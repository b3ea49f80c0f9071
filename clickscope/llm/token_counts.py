"""Token counts per section by offset-mapped attribution.

A document is encoded once, whole (splitting first would change the tokens at the cuts). The tokens' byte lengths give
their spans, the spans become character spans, and a sorted interval join (two binary searches per token) finds the
sections that each token touches. A token that crosses a boundary goes to one section by the rule:

* ``largest``: the section with the largest overlap in characters, the earlier one of equals;
* ``first``: the section in which it starts;
* ``last``: the section in which it ends.

A token that touches no section (separators only) goes to the section before it, or to the first one. Every token is
counted exactly once, so the counts of a document sum to its token count.

Characters count by their first byte: a token that holds only later bytes of a character spans that character.

Defined cases: null and empty texts have one section of no characters and no tokens; repeated rows give repeated
counts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted

RULES = ("largest", "first", "last")
OUT = "section int, char_start int, char_end int, n_tokens bigint"


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def char_index(data: bytes) -> np.ndarray:
    """For every byte position 0 … len: the number of characters that begin before it."""
    starts = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(starts)])


def token_spans(data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of consecutive tokens of the given byte lengths."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    before = char_index(data)
    cont = np.concatenate([(np.frombuffer(data, np.uint8) & 0xC0) == 0x80, [False]])
    first = before[begins] - cont[begins]  # a token that begins inside a character spans it
    return first, np.maximum(before[ends], first + 1)


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines without their line feeds, empty ones included."""
    breaks = np.array([i for i, ch in enumerate(text) if ch == "\n"], np.int64) if "\n" in text else np.zeros(0, np.int64)
    return np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(text)]])


def attribute(first: np.ndarray, last: np.ndarray, starts: np.ndarray, ends: np.ndarray,
              rule: str = "largest") -> np.ndarray:
    """Section number of every token; sections are sorted, disjoint intervals, possibly empty, with gaps allowed."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    full = np.flatnonzero(ends > starts)
    before = np.maximum(np.searchsorted(starts, first, "right") - 1, 0)
    if not len(full) or not len(first):
        return before
    lo = np.searchsorted(ends[full], first, "right")        # first non-empty section that ends after the token begins
    hi = np.searchsorted(starts[full], last, "left") - 1    # last one that begins before the token ends
    out = before
    hit = lo <= hi
    if rule == "first":
        out[hit] = full[lo[hit]]
    elif rule == "last":
        out[hit] = full[hi[hit]]
    else:
        one = hit & (lo == hi)
        out[one] = full[lo[one]]
        for i in np.flatnonzero(hit & (lo < hi)):
            s = full[lo[i]:hi[i] + 1]
            out[i] = s[np.argmax(np.minimum(ends[s], last[i]) - np.maximum(starts[s], first[i]))]
    return out


class Counter:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.size[rank] = len(token)

    def counts(self, text: str, sections=line_sections, rule: str = "largest"):
        """(starts, ends, tokens) of the sections of one whole text."""
        starts, ends = sections(text)
        ids = np.array(self.enc.encode_ordinary(text), np.int64)
        data = text.encode()
        lengths = self.size[ids]
        if lengths.sum() != len(data):
            raise ValueError("tokens don't tile the text: not a byte-level vocabulary")
        first, last = token_spans(data, lengths)
        return starts, ends, np.bincount(attribute(first, last, starts, ends, rule), minlength=len(starts))


def section_tokens(spark: SparkSession, docs: DataFrame, ranks: dict[bytes, int], pattern: str,
                   sections=line_sections, rule: str = "largest", id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document and section: its character range and its tokens. ``sections`` maps a text to the sorted
    starts and ends of its sections. The vocabulary (about a megabyte) goes to the executors as a broadcast variable."""
    shared = spark.sparkContext.broadcast((ranks, pattern))
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def count(batches):
        c = Counter(*shared.value)
        for batch in batches:
            ids, no, lo, hi, n = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                starts, ends, k = c.counts(text or "", sections, rule)
                ids += [doc_id] * len(k)
                no.append(np.arange(len(k)))
                lo.append(starts)
                hi.append(ends)
                n.append(k)
            if ids:
                cols = [pa.array(ids, batch.column(0).type),
                        *[pa.array(np.concatenate(x)).cast(t) for x, t in zip((no, lo, hi, n), types, strict=True)]]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "section", "char_start", "char_end", "n_tokens"])

    out = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string(OUT).fields])
    return rows.mapInArrow(count, out)
