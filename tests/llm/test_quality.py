from __future__ import annotations

import math
import random

import pytest

from ringledger.llm import quality
from tests.conftest import rows
from tests.llm import brute

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def labels_of(spark, *entries):
    return spark.createDataFrame(list(entries), "doc_id bigint, quality int, toxic int")


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    texts: list[str | None] = [None, "", " \n\t ", "one", "a b c", "a a a", "a a a a", "x\x0by\x1cz w", "l\nl\n \nl\r\nl"]
    texts += [" ".join(rng.choices("abc", k=n)) for n in (5, 17, 300)]
    texts += ["\n".join(" ".join(rng.choices(["é", "ß#", "𝒳"], k=4)) for _ in range(50)), "w " * 30_000, "z" * 200_000]
    return texts


def test_rules_match_brute_force(documents):
    texts = odd_texts()
    found = quality.rules(documents(*enumerate(texts)).select("doc_id", "text")).collect()
    assert {r["doc_id"]: tuple(r[n] for n in NAMES) for r in found} == {n: brute.rules(t) for n, t in enumerate(texts)}
    assert all(r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"]) for r in found)


def test_given_documents(spark, sf_dir, small):
    df, texts = small
    found = quality.judged(df, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    assert {r["doc_id"]: tuple(r[n] for n in NAMES) for r in found} == {i: brute.rules(t) for i, t in texts.items()}
    known = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [(known[r["doc_id"]], r["kept"]) for r in found if r["doc_id"] in known and not r["base_failed"]]
    assert all(kept == (label == 1) for label, kept in judged) and len(judged) > 20


def test_ratio_is_the_mean_over_hashed_grams(spark, documents):
    docs = documents((1, "good text good"), (2, "bad ### text"), (3, None))
    ratio = quality.fit_ratio(docs, labels_of(spark, (1, 1, 0), (2, 0, 0), (1, 1, 0), (9, 1, 1), (None, 1, 0)))
    units = {1: ["good", "text", "good"], 2: ["bad", "###", "text"], 3: []}
    hashed = {w: spark.sql(f"SELECT xxhash64('{w}')").first()[0] for w in {w for ws in units.values() for w in ws}}
    size = quality.BUCKETS
    grams = {}
    for doc, words in units.items():
        ones = [hashed[w] % size for w in words]
        pairs = [spark.sql(f"SELECT xxhash64({hashed[a]}L, {hashed[b]}L)").first()[0] % size for a, b in zip(words, words[1:])]  # noqa: B905
        grams[doc] = ones + pairs
    raw, good = [0] * size, [0] * size
    for doc, found in grams.items():
        for g in found:
            raw[g] += 1
            good[g] += doc == 1
    scaled = [r * sum(good) / sum(raw) for r in raw]
    wanted = [math.log((g + 10) / (r + 10)) for g, r in zip(good, scaled, strict=True)]
    assert ratio == pytest.approx(wanted)
    scores = {r["doc_id"]: r["score"] for r in quality.scored(docs, ratio).collect()}
    assert scores == {d: pytest.approx(sum(ratio[g] for g in gs) / len(gs) if gs else 0.0) for d, gs in grams.items()}


def test_without_trusted_documents_every_score_is_zero(spark, documents):
    docs = documents((1, "a b"), (1, "a b"), (None, "c"))
    found = quality.judged(docs, labels_of(spark, (1, 0, 0))).collect()
    assert len(found) == 3 and {r["score"] for r in found} == {0.0}


def test_filter_keeps_columns_and_repeated_rows(spark, documents):
    clean = " ".join(f"word{n}" for n in range(60))
    docs = documents((1, clean), (1, clean), (2, "short"), (None, clean), (3, None))
    kept = quality.quality_filter(docs, labels_of(spark, (1, 1, 0)))
    assert kept.schema == docs.schema
    assert rows(kept.select("doc_id", "row")) == rows(spark.createDataFrame([(1, 7), (1, 7), (None, 7)], "d bigint, r int"))


def test_empty_tables(spark, documents):
    empty = documents((1, "x")).where("false")
    labels = labels_of(spark, (1, 1, 0)).where("false")
    assert quality.judged(empty, labels).count() == 0 and quality.quality_filter(empty, labels).count() == 0


def test_words_of_a_text_beyond_a_million(documents):
    """Numbers that repeat a window only far apart, in a text of 1.2 million words."""
    words = [str(n) for n in range(1_200_000)]
    words[700_000:700_003] = words[5:8]
    words[1_100_000:1_100_004] = words[600_000:600_004]
    text = " ".join(words)
    row = quality.rules(documents((1, text))).first()
    assert (row["n_words"], row["n_repeat_words"]) == (1_200_000, 14)


def test_windows_that_share_half_a_hash_are_told_apart(spark):
    """Texts with few, many and no repeated windows, among them two windows of equal half hashes, are counted by their words."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{n}" for n in range(size)], k=400)) for size in (3, 10, 20, 60, 10_000) for _ in range(4)]
    # Of some 300,000 windows a few pairs agree in the 33 bits that are sorted by first.
    texts.append(" ".join(str(n) for n in range(300_000)) + " 7 8 9")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = {r["id"]: r["n"] for r in df.select("id", quality.repeated_words(quality.words_of(df["text"])).alias("n")).collect()}
    assert found == {n: brute.rules(text)[4] for n, text in enumerate(texts)}
