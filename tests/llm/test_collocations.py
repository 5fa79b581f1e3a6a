from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ringledger.llm import collocations as module
from ringledger.llm.collocations import collocations, tile_counts
from ringledger.llm.queries import EXPECTED, QUERIES

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(entries, least=10, part=50, top=2000):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts: dict[str, Counter] = {}
    for _, text, lang in entries:
        of_lang = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                of_lang.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    rows = []
    for lang, f in counts.items():
        n = sum(c for phrase, c in f.items() if len(phrase) == 1)
        longer = Counter()
        for phrase, c in f.items():
            if len(phrase) == 3 and c >= least:
                for inner in (phrase[:2], phrase[1:]):
                    longer[inner] = max(longer[inner], c)
        found = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least or (100 * longer[phrase] >= part * a and longer[phrase]):
                continue
            cuts = [(f[phrase[:k]], f[phrase[k:]], k) for k in range(1, len(phrase))]
            score, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for x, y, k in cuts)
            found.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(rows)


@pytest.fixture(scope="module")
def entries():
    """Words of falling frequency in three languages, with fixed phrases, odd white space and signs between them."""
    rng = random.Random(5)
    words = [f"w{n}" for n in range(60)] + ["É", "ÉA", "x\x1cy", "naïve", "q" * 90]
    weights = [1 / (n + 1) for n in range(len(words))]
    found = [(n, None if n == 3 else "", None) for n in range(5)]
    for n in range(5, 90):
        parts = []
        for _ in range(rng.randrange(120)):
            parts.append(rng.choices(words, weights)[0])
            if rng.random() < 0.1:
                parts.append(rng.choice(["New York", "new YORK city", "w1 w2 w3", "go go go go", "q" * 90 + " É naïve"]))
            parts.append(rng.choice([" ", " ", " ", " ", "\t ", ", ", ". ", "\n", "\r\n", "\x0b", " ! "]))
        found.append((n, "".join(parts), rng.choice(["en", "fr", None, "en"])))
    return found


def frame(spark, entries):
    df = spark.createDataFrame(entries, "doc_id bigint, text string, lang string").repartition(3)
    return df.withColumns({c: F.lit("7") for c in ("word", "key", "phrase", "n", "a", "f", "slot", "cut", "rank")})


def result(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("head", [1 << 18, 40, 0])
def test_equals_brute_force_however_many_words_have_ids(spark, entries, head):
    assert result(collocations(frame(spark, entries), head=head)) == brute(entries)


def test_other_limits_and_small_buffers(spark, entries, monkeypatch):
    wanted = brute(entries, least=3, part=80, top=25)
    assert result(collocations(frame(spark, entries), least=3, part_of_longer=80, top=25, head=25)) == wanted
    assert max(r[1] for r in wanted) == 25


def test_tiles_count_like_a_counter():
    rng = np.random.default_rng(3)
    row = np.concatenate([rng.integers(0, 30, 300_000), rng.integers(0, 1 << 18, 5000), [5000] * 200_000])
    col = np.concatenate([rng.integers(0, 900, 300_000), rng.integers(0, 1 << 18, 5000), [70_000] * 200_000])
    first, second, n = tile_counts(row, col)
    wanted = Counter(zip(row.tolist(), col.tolist(), strict=True))
    assert dict(zip(zip(first.tolist(), second.tolist(), strict=True), n.tolist(), strict=True)) == wanted
    assert sum(map(len, tile_counts(row[:0], col[:0]))) == 0


def test_a_flush_in_between_changes_nothing(entries, monkeypatch):
    import pyarrow as pa

    texts = pa.array([(t or "").encode() for _, t, _ in entries], pa.binary())
    batches = [pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), texts], ["lang", "text"])] * 3
    head = module.Head({"en": [b"w0", b"w1", b"w2"]}, np.full(4, -1, np.int64).view(np.uint64))

    def total():
        counts = Counter()
        for part in module._phrase_counts(batches, head, module.count_pairs):
            _, keys, phrases, n = (part.column(c).to_pylist() for c in range(4))
            for key, phrase, times in zip(keys, phrases, n, strict=True):
                counts[key if phrase is None else phrase] += times
        return counts

    whole = total()
    monkeypatch.setattr(module, "BUFFER", 10)
    assert total() == whole and sum(whole.values()) > 1000


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000
    words = spark.createDataFrame([("en", b"a", big), ("en", b"b", big + 1)], "lang string, word binary, f bigint")
    pair = [("en", b"a b", big - 1, b"a", b"b", b"a", b"b")]
    pairs, none = spark.createDataFrame(pair, module._SPELLED), spark.createDataFrame([], module._SPELLED)
    totals = spark.createDataFrame([("en", 3 * big)], "lang string, n bigint")
    row = module._ranked_phrases(words, pairs, none, totals, 50, 10).first()
    assert row["score"] == 1000000 * (big - 1) ** 2 // (big * (big + 1)) and row["l"] == big


def test_empty_and_null_only(spark):
    assert result(collocations(frame(spark, []))) == []
    assert result(collocations(frame(spark, [(1, None, None), (None, "", "en"), (2, " .,\n ", "en")]))) == []


def test_one_very_long_text_and_a_very_long_word(spark):
    long = [(1, "ab cd " * 200_000 + "z" * 1_000_000, None), (2, "ab cd", None)]
    assert result(collocations(frame(spark, long))) == brute(long)


def test_query_equals_its_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    wanted = duck.sql(EXPECTED["op11_collocations"]).to_arrow_table()
    found = QUERIES["op11_collocations"](spark, sf_dir)
    assert result(found) == sorted(tuple(r[c] for c in COLUMNS) for r in wanted.to_pylist())
    assert len(wanted) > 0 and dict(found.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint" for c in COLUMNS}
