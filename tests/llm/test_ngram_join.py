from __future__ import annotations

import random
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ringledger.llm import ngram_join as module
from ringledger.llm.ngram_join import (
    _block_pairs,
    _folded,
    _WordHashes,
    band_edges,
    bitmap,
    ngram_components,
    ranges_of,
    shingle_set,
    tile_keys,
)
from ringledger.llm.queries import EXPECTED, QUERIES

SPACE = " \t\n\x0b\x0c\r"


def shingles(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in SPACE[1:]:
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(entries, percent=90):
    """Row number: (doc_id, n, component) by comparing all pairs."""
    sets = [shingles(text) for _, text in entries]
    parent = list(range(len(sets)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for n, (doc_id, _) in enumerate(entries):
        if sets[n] and doc_id is not None:
            ids[root(n)].append(doc_id)
    rows = [(d, len(s), min(ids[root(n)], default=None) if s else d) for n, ((d, _), s) in enumerate(zip(entries, sets, strict=True))]
    return sorted(rows, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def frame(spark, entries):
    df = spark.createDataFrame(entries, "doc_id bigint, text string").repartition(3)
    return df.withColumns({c: F.lit("7") for c in ("n", "keys", "digest", "node", "lo", "place", "component_id", "n_shingles")})


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        at = rng.randrange(len(words) or 1)
        words[at : at + 1] = rng.choice([[], [f"x{rng.randrange(10**6)}"], [*words[at : at + 1], f"y{rng.randrange(10**6)}"]])
    return words


@pytest.fixture(scope="module")
def entries():
    """Groups of near copies at all distances, chains of edits, shared passages, short texts, copies and odd rows."""
    rng = random.Random(11)
    texts = []
    for size in (4, 9, 12, 25, 40, 90, 200, 400):
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        texts += [" ".join(edited(rng, base, rng.randrange(1 + size // 20))) for _ in range(14)]
        chain = base
        for _ in range(10):
            chain = edited(rng, chain, max(1, size // 60))
            texts.append("\n".join(chain).upper())
    passage = [f"p{n}" for n in range(60)]
    texts += [" ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 40))]) for _ in range(40)]
    texts += ["a", "A", "a b", "b a", "a\tb ", "a b c", "a b c d", "É b c", "é b c", "", "  \n", None, "a b a b a b a b"]
    rows = [(n, text) for n, text in enumerate(texts)] + [(n + 1000, text) for n, text in enumerate(texts[:200:9])]
    return [*rows, (3, "a b c d"), (3, "entirely other words here"), (None, "a b"), (None, "only this one"), (5000, texts[0]), (5000, texts[0])]


def test_equals_all_pairs(spark, entries):
    df = frame(spark, entries)
    assert result(ngram_components(df)) == brute(entries)
    assert sum(n != c for n, _, c in brute(entries) if n is not None) > 60


def test_another_similarity_and_small_blocks(spark, entries, monkeypatch):
    monkeypatch.setattr(module, "ASKING", 3)
    monkeypatch.setattr(module, "ASKED", 5)
    assert result(ngram_components(frame(spark, entries), percent=70)) == brute(entries, 70)


def test_only_blocks(spark, entries, monkeypatch):
    """Without the pairs of the first rounds the blocks alone find every link."""
    monkeypatch.setattr(module, "_ordered", lambda pairs: pairs.selectExpr("node AS a", "node AS b").where("false"))
    assert result(ngram_components(frame(spark, entries))) == brute(entries)


def test_empty_and_unlinked(spark):
    assert result(ngram_components(frame(spark, []))) == []
    rows = [(1, None), (2, ""), (None, None), (4, "\x0b")]
    assert result(ngram_components(frame(spark, rows))) == sorted([(1, 0, 1), (2, 0, 2), (None, 0, None), (4, 0, 4)], key=repr)


def test_very_long_texts(spark):
    words = [f"w{n}" for n in range(60_000)]
    near = words[:30_000] + ["new"] + words[30_000:]
    rows = [(7, " ".join(words)), (3, " ".join(near)), (5, " ".join(words[:50_000])), (9, "x" * 1_000_000)]
    assert result(ngram_components(frame(spark, rows))) == [(3, 59_999, 3), (5, 49_998, 5), (7, 59_998, 3), (9, 1, 9)]


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_linked_sets_share_a_tile(percent):
    rng = np.random.default_rng(percent)
    for _ in range(400):
        size = int(rng.integers(1, 130))
        one = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
        lost = int(rng.integers(0, size * (100 - percent) // 100 + 1))
        more = rng.integers(0, 1 << 63, int(rng.integers(0, 8))).astype(np.uint64)
        two = np.unique(np.concatenate([rng.permutation(one)[lost:], more]))
        both = len(np.intersect1d(one, two))
        if len(two) and both < max(len(one), len(two)) and 100 * both >= percent * (len(one) + len(two) - both):
            assert set(tile_keys(one, percent)) & set(tile_keys(two, percent))


def test_bands_hold_all_partners():
    edges = band_edges(90)
    for n in (*range(1, 3000), 123_456, 10**9):
        band = max(k for k, e in enumerate(edges) if e <= n)
        largest = 10 * n // 9
        assert largest < edges[band + 2]
        assert (n + largest) * 10 // 190 < ranges_of(band, 90)


def test_bitmaps_never_hide_a_link():
    rng = np.random.default_rng(1)
    for size in (5, 100, 130, 3000):
        one = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
        two = np.unique(np.concatenate([one[size // 25 :], rng.integers(0, 1 << 62, size // 30).astype(np.uint64)]))
        words = min(len(bitmap(one)), len(bitmap(two)))
        differing = np.bitwise_count(_folded(bitmap(one), words) ^ _folded(bitmap(two), words)).sum()
        assert differing <= len(np.setxor1d(one, two))


def test_a_block_compares_only_across_components():
    texts = ["a b c d e f g h i j k l m n", "a b c d e f g h i j k l m n o", "something else altogether is said here"]
    bits = [bitmap(shingle_set(t.encode(), _WordHashes())).tobytes() for t in texts]
    columns = {"node": [1, 2, 3, 1], "root": [1, 2, 3, 1], "n": [12, 13, 4, 12], "bits": [*bits, bits[0]], "asks": [False, False, False, True]}
    for closest in (True, False):
        assert _block_pairs(pa.table(columns), 90, closest).tolist() == [[1, 2]]


def test_closest_names_one_node_of_each_component():
    words = [f"w{n}" for n in range(100)]
    texts = [words, [*words, "x"], [*words, "x", "y"], [*words, "z"], ["far", "away", "from", "here"]]
    bits = [bitmap(shingle_set(" ".join(t).encode(), _WordHashes())).tobytes() for t in texts]
    n = [len(t) - 2 for t in texts]
    columns = {"node": [9, 1, 2, 3, 4, 9], "root": [9, 1, 1, 3, 4, 9], "n": [*n, n[0]], "bits": [*bits, bits[0]], "asks": [False] * 5 + [True]}
    assert _block_pairs(pa.table(columns), 90, closest=True).tolist() == [[9, 1], [9, 3]]
    assert len(_block_pairs(pa.table(columns), 90, closest=False)) == 3


def test_blocks_may_go_over_several_batches():
    bits = [bitmap(shingle_set(f"a b c d e f g h i j k l m n o p q r s t u v w x y z {n % 2}".encode(), _WordHashes())).tobytes() for n in range(30)]
    block = [1] * 4 + [2] * 7 + [3] * 19
    columns = {"block": block, "node": range(30), "root": range(30), "n": [25] * 30, "bits": bits, "asks": [n % 3 == 0 for n in range(30)]}
    rows = pa.table({k: pa.array(v) for k, v in columns.items()})

    def found(size):
        parts = module._pairs_of_blocks(rows.to_batches(max_chunksize=size), 90, False)
        return sorted((a, b) for part in parts for a, b in zip(*(c.to_pylist() for c in part.columns), strict=True))

    assert found(30) == found(1) == found(5) and len(found(30)) > 50
    assert list(module._pairs_of_blocks([], 90, True)) == []


def test_query_equals_its_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    wanted = sorted(duck.sql(EXPECTED["op12_ngram_join"]).fetchall(), key=repr)
    found = QUERIES["op12_ngram_join"](spark, sf_dir)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert result(found) == wanted
