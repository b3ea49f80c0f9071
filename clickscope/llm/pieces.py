"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is normalised as the model says (a space in front, spaces as U+2581) and cut where no piece of the vocabulary can
reach across: before a space mark that follows another character, and around every character that occurs in no piece of
several characters. The parts ("words") of many texts are encoded at once, each different one once a task: their symbols
lie in one flat array, and a round

1. takes the smallest pair rank of every word (a segmented minimum),
2. merges all its leftmost, non-overlapping occurrences in that word at once,
3. compacts the array and ranks the pairs beside the merged symbols;

words without a pair leave. Merging one pair at a time from the left, as the library does, could see a pair of a new
symbol that ranks as well or better before the next occurrence is due; a word in which a merge would make such a pair
merges its leftmost occurrence only in that round, so the ids are the library's. Pieces of equal score share a rank.

Symbols without a piece become the byte pieces of their UTF-8. Ids are returned as little-endian unsigned 32-bit integers
in one binary value per row (``unpack`` makes an array of them). ``decode`` turns them back: byte pieces are joined,
each byte that is no part of valid UTF-8 becomes U+FFFD, control pieces vanish, one leading space mark is dropped.

The vocabulary (half a megabyte) goes to the tasks with the function; the memory for words seen is bounded by
``CACHE_CHARS`` (afterwards they are encoded anew). Models: BPE with byte fallback, identity normalisation, added space
in front, no user-defined or unused pieces; others are refused.

Defined cases: null and empty texts have no pieces (only the begin and end ids, if asked for) and decode to the empty
text; null ids decode to the empty text; every row is treated alone, so repeated rows give repeated results; an empty
table gives an empty one; all other columns stay, but one with the name of the result (in any case) is replaced by it.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted

MARK = "▁"
NO_RANK = np.iinfo(np.int32).max
CACHE_CHARS = 1 << 22  # characters of different words that a task keeps encoded
SLICE_CHARS = 1 << 20  # characters (or ids) that are worked on at once, one longer text aside
# Kinds of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[0], starts[0]+1, … of consecutive ranges."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Vocabulary:
    """Tables of a model file: symbols are the pieces, then the characters that only occur inside pieces."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        m = pb.ModelProto()
        m.ParseFromString(model)
        norm, train = m.normalizer_spec, m.trainer_spec
        kinds = [p.type for p in m.pieces]
        if (train.model_type != pb.TrainerSpec.BPE or not train.byte_fallback or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces
                or train.treat_whitespace_as_suffix or not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("only BPE models with byte fallback, identity normalisation and a space in front")
        self.kinds = np.array(kinds, np.int8)
        self.pieces = [p.piece for p in m.pieces]
        normal = [i for i, k in enumerate(kinds) if k == NORMAL]
        scores = {s: r for r, s in enumerate(sorted({m.pieces[i].score for i in normal}, reverse=True))}
        self.symbol = {self.pieces[i]: i for i in normal}
        for i in normal:
            for ch in self.pieces[i]:
                self.symbol.setdefault(ch, len(self.pieces) + len(self.symbol))
        keys, ranks, merged = [], [], []
        for i in normal:
            piece = self.pieces[i]
            for k in range(1, len(piece)):
                a, b = self.symbol.get(piece[:k]), self.symbol.get(piece[k:])
                if a is not None and b is not None:
                    keys.append((a << 32) | b)
                    ranks.append(scores[m.pieces[i].score])
                    merged.append(i)
        # symbols of all characters; those outside the vocabulary are numbered below zero and merge with nothing
        self.of_point = -1 - np.arange(0x110000, dtype=np.int64)
        for ch, i in self.symbol.items():
            if len(ch) == 1:
                self.of_point[ord(ch)] = i
        self.single = {i: ch for ch, i in self.symbol.items() if len(ch) == 1}
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.ranks, self.merged = np.array(ranks, np.int32)[order], np.array(merged, np.int64)[order]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in np.flatnonzero(self.kinds == BYTE)}
        self.bos, self.eos = (self.pieces.index(s) for s in (train.bos_piece, train.eos_piece))
        long = [self.pieces[i] for i in normal if len(self.pieces[i]) > 1]
        inside = re.escape("".join(sorted({c for p in long for c in p} - {MARK})))
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in long):
            self.words = re.compile(f"[{MARK}{inside}]+|.", re.S)
        else:
            self.words = re.compile(f"{MARK}*[{inside}]+|{MARK}+|.", re.S)
        surfaces = []
        for i, (piece, kind) in enumerate(zip(self.pieces, kinds, strict=True)):
            if kind == BYTE:
                surfaces.append(bytes([int(piece[3:5], 16)]))
            else:
                text = {CONTROL: "", UNKNOWN: train.unk_surface}.get(kind, piece.replace(MARK, " "))
                surfaces.append(text.encode())
        self.surface_len = np.array([len(s) for s in surfaces], np.int64)
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        self.surfaces = np.frombuffer(b"".join(surfaces), np.uint8)
        self.marked = np.array([k == NORMAL and p.startswith(MARK) for p, k in zip(self.pieces, kinds, strict=True)])

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of symbol pairs; ``NO_RANK`` where the two make no piece."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NO_RANK), np.where(hit, self.merged[at], -1)


@functools.lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _selected(hits: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Leftmost non-overlapping ones of the sorted pair positions ``hits``: every other one of neighbouring hits."""
    new = np.ones(len(hits), bool)
    new[1:] = (hits[1:] != hits[:-1] + 1) | (word[hits[1:]] != word[hits[:-1]])
    run_start = np.maximum.accumulate(np.where(new, np.arange(len(hits)), 0))
    return hits[(np.arange(len(hits)) - run_start) % 2 == 0]


def merge_words(vocab: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge rounds over the words whose symbols lie one after the other in ``symbols`` (all lengths positive).
    Returns the remaining symbols and their number per word."""
    n = len(lengths)
    sym = symbols.astype(np.int64)
    word = np.repeat(np.arange(n), lengths)  # ascending; words that are done leave the arrays
    last = np.ones(len(sym), bool)
    last[:-1] = word[1:] != word[:-1]
    rank = np.full(len(sym), NO_RANK, np.int32)
    into = np.full(len(sym), -1, np.int64)
    inner = np.flatnonzero(~last)
    rank[inner], into[inner] = vocab.pair_ranks(sym[inner], sym[inner + 1])
    done_sym, done_word = [], []
    while len(sym):
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        sizes = np.diff(np.append(starts, len(sym)))
        least = np.minimum.reduceat(rank, starts)
        if (least == NO_RANK).any():
            live = np.repeat(least != NO_RANK, sizes)
            done_sym.append(sym[~live])
            done_word.append(word[~live])
            sym, word, last, rank, into = sym[live], word[live], last[live], rank[live], into[live]
            keep = least != NO_RANK
            least, sizes = least[keep], sizes[keep]
            if not len(sym):
                break
            starts = np.cumsum(sizes) - sizes
        each = np.repeat(least, sizes)
        at = _selected(np.flatnonzero(rank == each), word)
        # Words with several merges: one whose new pairs would rank as well or better merges only its leftmost.
        many = np.zeros(len(at), bool)
        same = word[at[1:]] == word[at[:-1]]
        many[1:] |= same
        many[:-1] |= same
        if many.any():
            first = np.ones(len(at), bool)
            first[1:] = ~same
            m = np.flatnonzero(many)
            p, made, limit = at[m], into[at[m]], rank[at[m]]
            bad = np.zeros(len(m), bool)
            after = np.flatnonzero(~last[p + 1])
            bad[after] |= vocab.pair_ranks(made[after], sym[p[after] + 2])[0] <= limit[after]
            before = np.flatnonzero((p > 0) & (word[p - 1] == word[p]))
            q = p[before]
            touching = np.zeros(len(before), bool)
            ok = m[before] > 0
            touching[ok] = at[m[before[ok]] - 1] == q[ok] - 2
            left = np.where(touching, into[np.maximum(q - 2, 0)], sym[q - 1])
            bad[before] |= vocab.pair_ranks(left, made[before])[0] <= limit[before]
            if bad.any():
                risky = np.zeros(n, bool)
                risky[word[p[bad]]] = True
                drop = np.zeros(len(at), bool)
                drop[m] = risky[word[p]] & ~first[m]
                at = at[~drop]
        sym[at] = into[at]
        last[at] = last[at + 1]
        kept = np.ones(len(sym), bool)
        kept[at + 1] = False
        merged = at - np.arange(len(at))  # positions of the merged symbols once the others are gone
        sym, word, last, rank, into = sym[kept], word[kept], last[kept], rank[kept], into[kept]
        near = np.zeros(len(sym), bool)
        near[merged] = True
        previous = merged[merged > 0] - 1
        near[previous[~last[previous]]] = True
        touched = np.flatnonzero(near)
        rank[touched], into[touched] = NO_RANK, -1
        touched = touched[~last[touched]]
        rank[touched], into[touched] = vocab.pair_ranks(sym[touched], sym[touched + 1])
    if not done_sym:
        return np.zeros(0, np.int64), np.zeros(n, np.int64)
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return sym[order], np.bincount(word, minlength=n)


class _Words(dict):
    """Numbers of different words in order of their first use."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at


class Encoder:
    def __init__(self, vocab: Vocabulary, bos: bool = True, eos: bool = True):
        self.vocab, self.ends = vocab, ([vocab.bos] * bos, [vocab.eos] * eos)
        self._reset()

    def _reset(self) -> None:
        self.words, self.chars = _Words(), 0
        self.flat, self.at, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _add_new(self) -> None:
        new, self.words.new = self.words.new, []
        if not new:
            return
        flat, size = self.encode_words(new)
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, flat])
        self.chars += sum(map(len, new))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and their number per word."""
        v, joined = self.vocab, "".join(words)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        sym, size = merge_words(v, v.of_point[points], np.fromiter(map(len, words), np.int64, len(words)))
        bare = np.flatnonzero((sym < 0) | (sym >= len(v.pieces)))
        if not len(bare):
            return sym.astype(np.uint32), size
        spelled = {s: [v.bytes[b] for b in (v.single[s] if s >= 0 else chr(-1 - s)).encode()]
                   for s in set(sym[bare].tolist())}
        bare_ids = [spelled[s] for s in sym[bare].tolist()]
        counts = np.ones(len(sym), np.int64)
        counts[bare] = [len(x) for x in bare_ids]
        at = np.cumsum(counts) - counts
        ids = np.empty(counts.sum(), np.uint32)
        whole = np.ones(len(sym), bool)
        whole[bare] = False
        ids[at[whole]] = sym[whole]
        ids[ragged(at[bare], counts[bare])] = np.concatenate([np.array(x) for x in bare_ids])
        word = np.repeat(np.arange(len(words)), size)
        return ids, np.bincount(word, counts, minlength=len(words)).astype(np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids per text)."""
        if self.chars > CACHE_CHARS:
            self._reset()
        number, find = self.words.__getitem__, self.vocab.words.findall
        used, n_used = [], []
        for text in texts:
            found = list(map(number, find(MARK + text.replace(" ", MARK)))) if text else []
            used += found
            n_used.append(len(found))
        self._add_new()
        used, n_used = np.array(used, np.int64), np.array(n_used, np.int64)
        size = self.size[used]
        ids = self.flat[ragged(self.at[used], size)]
        bounds = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n_used)])]
        counts = np.diff(bounds)
        bos, eos = self.ends
        out = np.empty(len(ids) + len(texts) * (len(bos) + len(eos)), np.uint32)
        total = counts + len(bos) + len(eos)
        first = np.cumsum(total) - total
        out[ragged(first + len(bos), counts)] = ids
        for i, b in enumerate(bos):
            out[first + i] = b
        for i, e in enumerate(eos):
            out[first + len(bos) + counts + i] = e
        return out, total


def _utf8_repaired(data: bytes) -> str:
    """Text of bytes in which each byte that is no part of valid UTF-8 counts as U+FFFD."""
    out, i = [], 0
    while i < len(data):
        for k in (1, 2, 3, 4):
            try:
                out.append(data[i:i + k].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k = 1
        i += k
    return "".join(out)


def decode_ids(vocab: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of consecutive id lists."""
    size, at = vocab.surface_len[ids], vocab.surface_at[ids]
    # one space mark in front of the first piece that is not a control piece is dropped
    visible = np.flatnonzero(vocab.kinds[ids] != CONTROL)
    ends = np.cumsum(counts)
    starts = ends - counts
    nth = np.searchsorted(visible, starts)
    has = (nth < len(visible)) & (np.append(visible, len(ids))[nth] < ends)
    first = visible[nth[has]]
    first = first[vocab.marked[ids[first]]]
    size, at = size.copy(), at.copy()
    size[first] -= 1
    at[first] += 1
    data = vocab.surfaces[ragged(at, size)].tobytes()
    cut = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], ends])].tolist()
    kind = vocab.kinds[ids]
    # a control piece parts the byte pieces around it, though it has no surface
    parted = np.zeros(len(counts), bool)
    middle = np.flatnonzero((kind[1:] == CONTROL) & (kind[:-1] == BYTE)) + 1
    of = np.searchsorted(ends, middle, "right")
    parted[of[(middle > starts[of]) & (middle < ends[of] - 1)]] = True
    out = []
    for i, runs in enumerate(parted.tolist()):
        raw = data[cut[i]:cut[i + 1]]
        try:
            text = None if runs else raw.decode()
        except UnicodeDecodeError:
            text = None
        if text is None:
            text = _decode_runs(vocab, ids[starts[i]:ends[i]], size[starts[i]:ends[i]], raw)
        out.append(text)
    return out


def _decode_runs(vocab: Vocabulary, ids: np.ndarray, size: np.ndarray, raw: bytes) -> str:
    """A text with invalid or parted bytes: runs of byte pieces are repaired one by one, as pieces around them are whole."""
    kind = vocab.kinds[ids] == BYTE
    edges = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    at = np.concatenate([[0], np.cumsum(size)])
    parts = []
    for lo, hi in zip(edges, np.append(edges[1:], len(ids)), strict=True):
        piece = raw[at[lo]:at[hi]]
        parts.append(_utf8_repaired(piece) if kind[lo] else piece.decode())
    return "".join(parts)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _slices(batch: pa.RecordBatch, weights: np.ndarray):
    """The batch in pieces of at most ``SLICE_CHARS`` weight, one heavier row aside."""
    lo, total = 0, 0
    for i, w in enumerate(weights.tolist()):
        if i > lo and total + w > SLICE_CHARS:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += w
    if lo < batch.num_rows:
        yield batch.slice(lo)


def _with_column(df: DataFrame, source: str, out: str, kind: T.DataType, work) -> DataFrame:
    """``df`` and a column ``out`` that ``work`` makes of the values of ``source``, in Arrow batches."""
    kept = [c for c in df.columns if c.lower() != out.lower()]
    plain = [f"c{i}" for i in range(len(kept) + 1)]  # inside, whatever the names are
    rows = df.select(*[F.col(quoted(c)).alias(p) for c, p in zip([*kept, source], plain, strict=True)])
    schema = T.StructType([*[T.StructField(p, df.schema[c].dataType) for c, p in zip(kept, plain, strict=False)],
                           T.StructField(plain[-1], kind)])

    def run(batches):
        convert = work()
        for batch in batches:
            weights = pa.compute.fill_null(pa.compute.binary_length(batch.column(len(kept))), 0).to_numpy()
            for part in _slices(batch, weights):
                cols = [part.column(i) for i in range(len(kept))]
                made = convert(part.column(len(kept)))
                yield pa.RecordBatch.from_arrays([*cols, made], names=plain)

    return rows.mapInArrow(run, schema).toDF(*kept, out)


def encode(df: DataFrame, model: bytes, text_col: str = "text", out: str = "ids", bos: bool = True,
           eos: bool = True) -> DataFrame:
    """``df`` with the packed ids of every whole text."""
    def work():
        encoder = Encoder(vocabulary(model), bos, eos)

        def convert(texts: pa.Array) -> pa.Array:
            ids, counts = encoder.encode(texts.to_pylist())
            return _binary(ids.astype("<u4"), 4 * np.cumsum(counts))
        return convert
    return _with_column(df, text_col, out, T.BinaryType(), work)


def decode(df: DataFrame, model: bytes, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of the packed ids in ``ids_col``."""
    def work():
        vocab = vocabulary(model)

        def convert(packed: pa.Array) -> pa.Array:
            values = [v or b"" for v in packed.to_pylist()]
            ids = np.frombuffer(b"".join(values), "<u4").astype(np.int64)
            return pa.array(decode_ids(vocab, ids, np.array([len(v) // 4 for v in values], np.int64)), pa.string())
        return convert
    return _with_column(df, ids_col, out, T.StringType(), work)


def n_ids(packed: Column) -> Column:
    """Number of ids in a packed value."""
    return F.coalesce(F.octet_length(packed) / 4, F.lit(0)).cast("bigint")


def unpack(packed: Column) -> Column:
    """Packed ids as an array of integers."""
    at = F.sequence(F.lit(0), F.greatest(n_ids(packed) - 1, F.lit(0)))
    digits = F.hex(packed)
    byte = lambda i, k: F.substring(digits, (8 * i + 2 * k + 1).cast("int"), F.lit(2))
    number = lambda i: F.conv(F.concat(*[byte(i, k) for k in (3, 2, 1, 0)]), 16, 10)
    return F.when(n_ids(packed) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(at, lambda i: number(i).cast("bigint")))
