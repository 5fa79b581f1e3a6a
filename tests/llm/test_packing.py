from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ringledger.llm import packing
from ringledger.llm.packing import Limits, WordTokenizer, conversation_examples, fill, pack_documents

PATH = __import__("public_tokenizers").path("word_bpe_49k.json")


def ids_of(texts):
    coded = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*c.ids, 2], "<u4") for c in coded]


ODD = [
    None, "", " \n\t\x0b\x0c\r ", "a", "Don't we'll I'M 's", "x###y!!! ***", "naïve ÉCOLE école école", "  a b", "漢字 かな 123 4५",
    "<|startoftext|> a<|endoftext|>b", "word\x1cword", "İstanbul ΣΑΣ ſ K", "🙂🙂 a🙂b", "é" * 3000, "tokens " * 9000, "á### b×c÷d",
]


def encoded(coder, texts):
    column = pa.array([b"skipped", *((t or "").encode() for t in texts)], pa.binary()).slice(1)
    ids, bounds = coder.encode(column)
    return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_words_code_like_texts():
    coder = WordTokenizer(PATH)
    wanted = [ids[:-1].tobytes() for ids in ids_of(ODD)]
    for _ in range(2):
        assert encoded(coder, ODD) == wanted
    assert encoded(coder, ODD[::-1]) == wanted[::-1]


def test_a_small_memory_of_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "MAX_KNOWN", 10)
    coder, wanted = WordTokenizer(PATH), [ids[:-1].tobytes() for ids in ids_of(ODD)]
    for n in range(len(ODD)):
        assert encoded(coder, ODD[n : n + 3]) == wanted[n : n + 3]


def test_random_texts_code_like_the_tokenizer():
    rng = random.Random(6)
    parts = ["a", "b", "don't", "'s", "É", "é", "ß", "×", "÷", "e\u0301", ",", ".", "!?", "#", "*", "(", ")", "-", "'", "|", "<|endoftext|>", "7", "٣", " ", " ", "\t", "\x0b", "\x1c", "\u00a0", "\u2003", "漢", "🙂", "\ufeff"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(4000)]
    assert encoded(WordTokenizer(PATH), texts) == [ids[:-1].tobytes() for ids in ids_of(texts)]


def check(rows, ids, limits):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and len(part) == r["length"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    for doc, found in pieces.items():
        end = 0
        for start, length in sorted(found):
            assert start == end and length > 0
            end += length
        assert end == len(ids[doc])
    assert pieces.keys() == ids.keys()
    for found in sequences.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= limits.tokens and len(found) <= limits.segments
    return sequences


def test_documents_of_all_kinds(documents):
    docs = documents(*enumerate(ODD))
    for limits in (Limits(), Limits(tokens=64, segments=3, loss_tokens=64)):
        rows = pack_documents(docs, PATH, limits).collect()
        check(rows, dict(enumerate(ids_of(ODD))), limits)


def test_repeated_rows_and_null_ids(documents):
    docs = documents((1, "a b"), (1, "a b"), (None, "a b"))
    rows = pack_documents(docs, PATH).collect()
    assert sorted((r["doc_id"] or 0, r["start"], r["length"]) for r in rows) == [(0, 0, 3), (1, 0, 3), (1, 0, 3)]
    assert sorted(r["offset"] for r in rows) == [0, 3, 6]
    assert pack_documents(docs.where("false"), PATH).count() == 0


def test_given_documents_leave_little_padding(spark, sf_dir, small):
    from ringledger.llm.queries import QUERIES

    _, texts = small
    rows = QUERIES["op2_pack_documents"](spark, sf_dir).collect()
    sequences = check(rows, dict(zip(texts, ids_of(texts.values()), strict=True)), Limits())
    tokens = sum(r["length"] for r in rows)
    assert 1 - tokens / (4096 * len(sequences)) < 0.03


def test_fill_respects_every_limit():
    rng = np.random.default_rng(2)
    demand = np.stack([rng.integers(1, 50, 500), np.ones(500), rng.integers(0, 30, 500)], axis=1).astype(float)
    for limits in ([100, 7, 60], [100, 500, 1000], [1000, 3, 1000]):
        bins, places = fill(demand, np.array(limits, float))
        used = np.stack([np.bincount(bins, demand[:, k]) for k in range(3)], axis=1)
        assert (used <= limits).all()
        least = (demand.sum(axis=0) / limits).max()
        assert len(used) <= 1.1 * least + 2
        for b in range(len(used)):
            assert sorted(places[bins == b]) == list(range((bins == b).sum()))


def test_fill_gives_what_fits_nowhere_a_bin_of_its_own():
    bins, _ = fill(np.array([[5.0, 1, 0], [200, 1, 0], [5, 1, 0]]), np.array([100.0, 10, 100]))
    assert bins[0] == bins[2] != bins[1]


def test_dot_product_chooses_what_matches_the_room():
    # After the first example little of the second resource is left, so the one that needs less of it follows.
    demand = np.array([[6.0, 8.0], [3.0, 1.0], [1.0, 2.0]])
    bins, places = fill(demand, np.array([10.0, 10.0]))
    assert bins.tolist() == [0, 0, 1] and places.tolist() == [0, 1, 0]


def test_conversations(spark):
    turns = [(1, 0, "user", "hello there"), (1, 1, "assistant", "hi"), (2, 0, "user", None), (None, 0, "assistant", "x")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string")
    found = {r["conv_id"]: (r["tokens"], r["segments"], r["loss_tokens"]) for r in conversation_examples(df, PATH).collect()}
    one, two = (len(i) for i in ids_of(["hello there", "hi"]))
    assert found == {1: (one + two, 1, two), 2: (1, 1, 0), None: (2, 1, 2)}


@pytest.mark.parametrize("n", [0, 1])
def test_fill_small(n):
    bins, places = fill(np.ones((n, 3)), np.ones(3))
    assert bins.tolist() == places.tolist() == [0] * n
