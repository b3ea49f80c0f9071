"""Compression classifier: texts that a dictionary of good text shrinks better than one of bad text are good.

Two zstandard dictionaries are built from labelled text, one per class. A text is compressed whole with both; the
difference of the two sizes, normalised by the length, becomes a probability through a logistic calibration whose
terms are that difference, the mean compression ratio and the log length, with their squares and products (short and
very repetitive texts leave little for either dictionary to show).

Fitting uses a bounded sample: ``DICT_ROWS`` labelled rows per class give dictionary pieces (at most ``PIECES`` pieces
of ``PIECE`` bytes at hashed places of the whole text) and up to ``CALIBRATION_ROWS`` rows of the other
half of the ids calibrate; the halves and the sample are taken by a hash of the id. What reaches the driver is bounded by these numbers. Scoring covers every
row and whole texts.

Defined cases: null and empty texts get the calibrated score of length 0; a null label is no label; an id labelled
more than once counts with its largest label; a label without a document is not used; without labels of both classes
every score is the share of label 1 (0.5 without labels), and ``keep_good`` keeps every row; repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, quoted

DICT_ROWS, CALIBRATION_ROWS = 1500, 6000
DICT_BYTES, PIECE, PIECES, LEVEL = 112 * 1024, 512, 8, 3


@dataclass
class Model:
    good: bytes
    bad: bytes
    mean: list[float]
    scale: list[float]
    weights: list[float]     # the last one is the constant
    constant: float | None = None  # without labels of both classes


def pieces_of(data: bytes) -> list[bytes]:
    """Up to PIECES blocks of PIECE bytes, at places that depend on the whole text."""
    n = -(-len(data) // PIECE)
    if n <= PIECES:
        return [data[i * PIECE:(i + 1) * PIECE] for i in range(n)]
    picked = np.random.default_rng(zlib.crc32(data)).choice(n, PIECES, replace=False)
    return [data[i * PIECE:(i + 1) * PIECE] for i in sorted(picked)]


def train_dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their plain bytes serve as the dictionary
        return b"".join(samples)[:DICT_BYTES]


class Sizer:
    """Sizes of a text under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.both = []
        for d in (good, bad):
            zd = zstandard.ZstdCompressionDict(d)
            zd.precompute_compress(level=LEVEL)
            self.both.append(zstandard.ZstdCompressor(dict_data=zd, level=LEVEL, write_content_size=False,
                                                      write_checksum=False))

    def features(self, texts) -> np.ndarray:
        out = np.zeros((len(texts), 3))
        for i, t in enumerate(texts):
            data = t.encode() if t else b""
            g, b = (len(c.compress(data)) for c in self.both)
            n = max(len(data), 1)
            out[i] = (b - g) / n, (g + b) / 2 / n, np.log(n)
        return out


def _terms(x: np.ndarray) -> np.ndarray:
    d, r, n = x.T
    return np.column_stack([d, r, n, d * d, r * r, d * r, d * n, r * n])


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[list[float], list[float], list[float]]:
    """Logistic regression on scaled terms: Newton steps, halved until the penalised loss falls."""
    t = _terms(x)
    mean, scale = t.mean(0), t.std(0) + 1e-9
    a = np.column_stack([(t - mean) / scale, np.ones(len(t))])
    w = np.zeros(a.shape[1])

    def loss(v):
        z = a @ v
        return np.logaddexp(0, z).sum() - y @ z + ridge / 2 * v @ v

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, a.T @ (y - p) - ridge * w)
        size, before = 1.0, loss(w)
        while size > 1e-6 and loss(w + size * step) > before:
            size /= 2
        if size <= 1e-6 or np.abs(step).max() < 1e-8:
            break
        w += size * step
    return mean.tolist(), scale.tolist(), w.tolist()


def probability(model: Model, x: np.ndarray) -> np.ndarray:
    a = np.column_stack([(_terms(x) - model.mean) / model.scale, np.ones(len(x))])
    return 1 / (1 + np.exp(-np.clip(a @ np.array(model.weights), -30, 30)))


def held_out(id_col: Column) -> Column:
    """Rows that labels are not learnt from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", dict_rows: int = DICT_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> Model:
    ident = F.col(quoted(id_col))
    known = (labels.where(F.col(label_col).isNotNull() & ident.isNotNull() & ~held_out(ident))
             .groupBy(ident.alias("id")).agg(F.max(label_col).cast("int").alias("y"))
             .withColumn("order", F.xxhash64("id")))
    texts = docs.select(ident.alias("id"), F.col(quoted(text_col)).alias("text"))
    # the samples are limited among the ids that have a document
    present = texts.groupBy("id").agg(F.max(F.coalesce(F.length("text") > 0, F.lit(False))).alias("filled"))
    known = cut(known.join(present, "id"))
    samples = []
    for_dict = F.pmod(F.xxhash64("order"), F.lit(2)) == 0
    for y in (1, 0):
        # at most 2 * dict_rows ids: a bounded broadcast
        ids = known.where((F.col("y") == y) & for_dict & F.col("filled")).orderBy("order", "id").limit(2 * dict_rows).select("id")
        got = (texts.join(F.broadcast(ids), "id")
               .select("id", _pieces("text").alias("p")).orderBy(F.xxhash64("id"), "id").limit(dict_rows).collect())
        samples.append([bytes(p) for r in got for p in r.p])
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not samples[0] or not samples[1]:
        total = sum(counts.values())
        return Model(b"", b"", [], [], [], counts.get(1, 0) / total if total else 0.5)
    model = Model(train_dictionary(samples[0]), train_dictionary(samples[1]), [], [], [])
    # the other half of the labelled rows calibrates, with its natural class shares
    ids = known.where(~for_dict).orderBy("order", "id").limit(calibration_rows).select("id", "y")
    rest = texts.join(F.broadcast(ids), "id").select("id", "y", _features(model)("text").alias("x")).collect()
    if len({r.y for r in rest}) < 2:
        return Model(b"", b"", [], [], [], counts.get(1, 0) / sum(counts.values()))
    rest.sort(key=lambda r: r.id)
    model.mean, model.scale, model.weights = calibrate(np.array([r.x for r in rest]),
                                                       np.array([float(r.y) for r in rest]))
    return model


def _pieces(text: str) -> Column:
    @F.pandas_udf("array<binary>")
    def cut_pieces(s: pd.Series) -> pd.Series:
        return s.map(lambda t: pieces_of(t.encode()) if t else [])
    return cut_pieces(text)


def _features(model: Model):
    @F.pandas_udf("array<double>")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizer = Sizer(model.good, model.bad)
        for s in parts:
            yield pd.Series(list(sizer.features(s.tolist())))
    return of


def score(docs: DataFrame, model: Model, out: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` plus the score (a column of that name is replaced)."""
    if model.constant is not None:
        return docs.withColumn(out, F.lit(float(model.constant)))

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizer = Sizer(model.good, model.bad)
        for s in parts:
            yield pd.Series(probability(model, sizer.features(s.tolist())) if len(s) else [], dtype="float64")

    return docs.withColumn(out, scored(F.col(quoted(text_col))))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with their columns; all if the model is a constant."""
    if model.constant is not None:  # nothing was learnt to reject rows by
        return docs
    (s,) = fresh(docs, "score")
    return score(docs, model, s).where(F.col(s) >= threshold).drop(s)
