"""Spelling variants, ranked search and SentencePiece rounds against brute force, whole and messy tables included."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from clickscope.llm import pieces, ranked_search, spelling

from .test_llm import SCHEMA, sample_rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def messy_rows():
    rows = sample_rows()
    clash = [(100 + i, t, "en", "a", 0, "", "", 0) for i, t in enumerate(
        ["Étude ÉTUDE étude letters lettters LETTERS lettérs ×÷×÷×÷×", "a" * 40_000 + " " + "a" * 40_001, "\x00 ▁ \x00",
         "lettered letterer", "9x9x9x-y" * 20])]
    return [*rows, rows[0], rows[7], *clash, *clash[:1] * 5, (None, "letters alone here", "en", "a", 0, "", "", 1),
            (None, None, None, None, 0, "", "", 1)]


@pytest.fixture(scope="module")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA).repartition(3)


# ------------------------------------------------------------------ 11

def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute_words(rows, min_length, min_count, every):
    out = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= min_count}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_forms(words, ratio):
    out = {}
    for w, n in words.items():
        near = sorted(((-k, v) for v, k in words.items() if abs(len(v) - len(w)) < 2 and is_near(w, v)))
        form = near[0][1] if near and -near[0][0] >= ratio * n else None
        out[w] = [n, len(near), form, -near[0][0] if form else None]
    for w in out:
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def got_forms(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.mark.parametrize("min_length,min_count,every,ratio", [(6, 5, 199, 5), (3, 1, 3, 2), (1, 1, 2, 2)])
def test_forms_equal_brute_force_on_a_messy_table(messy, messy_rows, min_length, min_count, every, ratio):
    words = spelling.count_words(messy, min_length, min_count, every)
    expected = brute_words(messy_rows, min_length, min_count, every)
    assert {r["word"]: r["n"] for r in words.collect()} == expected
    assert got_forms(spelling.forms(words, ratio)) == brute_forms(expected, ratio)


def test_crowded_cells_and_anagrams_are_searched_whole(spark, monkeypatch):
    r = random.Random(4)
    words = {"".join(r.choice(["th", "an", "on", "é", "ou", "b"]) for _ in range(r.randrange(2, 5))) for _ in range(1500)}
    words |= {"".join(r.sample("abcdef", 6)) for _ in range(300)}  # one vector, which no split can part
    words |= {w[:3] + "x" + w[4:] for w in list(words)[::3] if len(w) > 4}
    table = {w: r.randrange(1, 200) for w in sorted(words)}
    monkeypatch.setattr(spelling, "CELL", 40)
    monkeypatch.setattr(spelling, "SAMPLE_LEAF", 4)
    monkeypatch.setattr(spelling, "SAMPLE", 400)
    df = spark.createDataFrame(list(table.items()), "word string, n long").repartition(4)
    assert max(c.n for c in spelling.fit_cells(df).values()) > 4
    assert spelling.dealt(spelling.routed(df, spelling.fit_cells(df))).agg(F.max("chunk")).first()[0] > 0
    assert got_forms(spelling.forms(df, 2)) == brute_forms(table, 2)


def test_words_of_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling.forms(spelling.count_words(empty)).collect() == []
    with pytest.raises(ValueError):
        spelling.forms(spelling.count_words(empty), ratio=1)


# ------------------------------------------------------------------ 12

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(rows, items, k):
    docs = [(r[0], collections.Counter(TERM.findall(lower(r[1] or "")))) for r in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = collections.Counter(t for _, c, _ in docs for t in c)
    out = collections.Counter()
    for item_id, text in set(items):
        scored = []
        for doc_id, c, n in docs:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(TERM.findall(lower(text or ""))) if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0))
        for rank, (s, none, doc_id) in enumerate(sorted(scored)[:k], 1):
            out[item_id, rank, None if none else doc_id, -s] += 1
    return out


def items_of(rows):
    texts = [r[1] for r in rows if r[1] and len(r[1]) > 20]
    picked = [(i, " ".join(t.split()[2:14])) for i, t in enumerate(texts[::4])]
    return [*picked, picked[0], (0, "Squane MER"), (90, None), (91, ""), (92, "unseen-term"), (93, texts[0]), (None, "la mer"),
            (94, "lettérs letters 9x9x9x")]


@pytest.mark.parametrize("k", [1, 10])
def test_search_equals_brute_force(spark, messy, messy_rows, monkeypatch, k):
    items = items_of(messy_rows)
    df = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x"))
    expected = brute_search(messy_rows, items, k)
    for block in (ranked_search.BLOCK_CHARS, 300):
        monkeypatch.setattr(ranked_search, "BLOCK_CHARS", block)
        assert collections.Counter(tuple(r) for r in ranked_search.search(spark, messy, df, k).collect()) == expected


def test_search_of_empty_tables(spark, messy):
    no_items = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, "la mer")], "item_id long, text string")
    assert ranked_search.search(spark, messy, no_items).collect() == []
    assert ranked_search.search(spark, spark.createDataFrame([], SCHEMA), items).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_interval_search_over_chunks_with_ties(seed):
    """Carried thresholds and equal scores: few different impacts, ids in no order, chunks of any size."""
    r = np.random.default_rng(seed)
    n_docs, n_terms, k = 700, 12, 5
    held = [np.flatnonzero(r.random(n_terms) < 0.3) for _ in range(n_docs)]
    held = [h if len(h) else np.array([0]) for h in held]
    ids = r.permutation(n_docs)
    tfs = [r.integers(1, 3, len(h)) for h in held]
    lengths = r.integers(1, 4, n_docs) * 10
    weights = r.integers(0, 4, n_terms) * 100
    items = [np.sort(r.choice(n_terms, 4, replace=False)) for _ in range(8)]
    searcher = ranked_search.Searcher(items, weights, n_docs, int(lengths.sum()), k)
    import pyarrow as pa
    edges = [0, *sorted(r.choice(np.arange(1, n_docs), 3, replace=False)), n_docs]
    for lo, hi in zip(edges, edges[1:], strict=False):
        sizes = np.array([len(h) for h in held[lo:hi]])
        searcher.add(pa.array(ids[lo:hi]), lengths[lo:hi], sizes, np.concatenate(held[lo:hi]), np.concatenate(tfs[lo:hi]))
    m = ranked_search.length_norm(lengths, n_docs, int(lengths.sum()))
    for item, top in zip(items, searcher.top, strict=True):
        scores = []
        for d in range(n_docs):
            s = sum(int(weights[t]) * (10 ** 9 * int(f) // (1000 * int(f) + 8 * int(m[d])))
                    for t, f in zip(held[d], tfs[d], strict=True) if t in item)
            scores.append((-s, int(ids[d])))
        assert top == [(-s, i) for s, i in sorted(scores)[:k] if s]


# ------------------------------------------------------------------ 13

def piece_texts():
    r = random.Random(9)
    bits = ["a", "b", "th", "e", " ", "  ", "▁", "\n", "é", "梦", "\x00", "😀", "ing", " a", "ñ", "0", "="]
    out = ["".join(r.choice(bits) for _ in range(r.randrange(60))) for _ in range(400)]
    out += ["".join(r.choice("aab") for _ in range(r.randrange(40))) for _ in range(200)]
    out += [" " * i for i in range(40)] + ["▁" * i + "a" for i in range(20)] + ["ab" * i for i in range(40)]
    out += ["".join(chr(r.choice([r.randrange(1, 0x300), r.randrange(0x3000, 0x9FFF), r.randrange(0x1F300, 0x1F700)]))
                    for _ in range(r.randrange(1, 60))) for _ in range(200)]
    return [*out, "".join(r.choice("abcdefghijklmnopqrstuvwxyz+/0123456789") for _ in range(6000)), "", None]


def test_pieces_equal_the_library(spark, messy_rows):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [*piece_texts(), *[r[1] for r in messy_rows]]
    rows = [(i, t, b"x", 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS binary, `a.b` int").repartition(3)
    model = pieces.read_model(MODEL)
    coded = pieces.decode(pieces.encode(docs, model), model)
    assert coded.columns == ["doc_id", "text", "a.b", "ids", "decoded"]
    out = coded.withColumn("list", pieces.unpack(F.col("ids"))).withColumn("n", pieces.n_ids(F.col("ids"))).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = lib.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert r["list"] == ids and r["n"] == len(ids) and r["a.b"] == 3
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded"] == lib.decode(ids)
    bare = pieces.encode(docs.where("doc_id < 3"), model, bos=False, eos=False, out="packed")
    for r in bare.withColumn("list", pieces.unpack(F.col("packed"))).collect():
        assert r["list"] == lib.encode(r["text"] or "")


def test_decoding_any_ids_equals_the_library():
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    r = random.Random(2)
    lists = [[r.randrange(32_000) if r.random() < 0.5 else r.randrange(262) for _ in range(r.randrange(12))]
             for _ in range(3000)]
    vocab = pieces.vocabulary(pieces.read_model(MODEL))
    flat = np.array([i for x in lists for i in x], np.int64)
    assert pieces.decode_ids(vocab, flat, np.array([len(x) for x in lists])) == [lib.decode(x) for x in lists]


def test_word_memory_is_renewed(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_CHARS", 50)
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = pieces.Encoder(pieces.vocabulary(pieces.read_model(MODEL)))
    for text in ("alpha beta gamma " * 3, "delta " * 30, "words not seen before", "alpha beta"):
        ids, counts = encoder.encode([text])
        assert ids.tolist() == lib.encode(text, add_bos=True, add_eos=True) and counts.tolist() == [len(ids)]
        assert encoder.chars < 120


def test_pieces_of_empty_table_and_null_ids(spark):
    model = pieces.read_model(MODEL)
    empty = spark.createDataFrame([], SCHEMA)
    assert pieces.decode(pieces.encode(empty, model), model).collect() == []
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert pieces.decode(nulls, model).first()["decoded"] == ""
    assert nulls.select(pieces.n_ids(F.col("ids")), pieces.unpack(F.col("ids"))).first()[0] == 0


# ------------------------------------------------------------------ clashing names and text ids, earlier operators

CLASH = "t_node int, t_dim string, t_low int, t_cut string, t_shard int, h int, of_hash string, _t_node int, dims int, node int"


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(f"d{i}", f"Dr Ada Moss {i} wrote to a{i % 3}@b.org or 555-123-4{i:03d}." + " word" * (i % 7), "en", f"s{i % 2}",
             1, "x", 2, "y", 3, 4, "z", 5, 6, 7) for i in range(40)]
    return spark.createDataFrame([*rows, rows[0], rows[0]], f"doc_id string, text string, lang string, source string, {CLASH}")


def test_shards_with_clashing_names_and_text_ids(clashing):
    from clickscope.llm import kd_shards
    out = kd_shards.kd_shards(clashing, leaves=4)
    rows = out.collect()
    assert len(rows) == 42 and set(clashing.columns) < set(out.columns)
    assert all((r["t_node"], r["h"], r["t_shard"], r["of_hash"]) == (1, 4, 3, "z") for r in rows)
    for shard in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(4)]
    assert max(sizes) - min(sizes) < sum(sizes) / 8


def test_surrogates_with_clashing_names(clashing):
    from clickscope.llm import surrogates
    out = surrogates.replace_entities(clashing, key=b"k", found_col="t_cut")
    rows = out.collect()
    assert len(rows) == 42 and all(r["h"] == 4 and r["of_hash"] == "z" for r in rows)
    assert all("Moss" not in r["text"] and "@b.org" not in r["text"] and r["t_cut"] >= 3 for r in rows)


def test_section_tokens_with_text_ids(spark, clashing):
    from clickscope.llm import token_counts
    ranks = token_counts.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = token_counts.section_tokens(spark, clashing, ranks, public_tokenizers.PATTERN)
    assert dict(out.dtypes)["doc_id"] == "string"
    assert {r["doc_id"] for r in out.collect()} == {f"d{i}" for i in range(40)}
