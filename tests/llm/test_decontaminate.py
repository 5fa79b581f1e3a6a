from __future__ import annotations

import random

from ringledger.llm import decontaminate
from ringledger.llm.decontaminate import bits_of, find_leaks, myers, normalised, pieces, without_leaks
from tests.llm import brute


def test_myers_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(400):
        pattern = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 120)))
        found = myers(bits_of(pattern), len(pattern), text, len(pattern))
        assert (found[0] if found else len(pattern)) == brute.edit_distance_to_any_part(pattern, text)


def test_pieces():
    for n in (24, 39, 40, 200, 399):
        item = "".join(random.Random(n).choices("abcdef ", k=n))
        found = pieces(item)
        assert len(found) == n // 20 + 1 and "".join(p for _, p in found) == item
        assert all(item[at : at + len(p)] == p for at, p in found)


def items_of(spark, *entries):
    return spark.createDataFrame(list(entries), "item_id bigint, text string")


def word(rng):
    return "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))


def test_edited_passages_match_brute_force(spark, documents, monkeypatch):
    rng = random.Random(5)
    items = [" ".join(word(rng) for _ in range(rng.randint(6, 40))) for _ in range(12)]
    texts = []
    for _ in range(60):
        passage = list(rng.choice(items))
        for _ in range(rng.choice([0, 0, 3, 8, 15, 40])):
            at = rng.randrange(len(passage))
            passage[at : at + rng.randint(0, 1)] = rng.choice(["", "z", "zz"])
        around = [" ".join(word(rng) for _ in range(rng.randint(0, 30))) for _ in range(2)]
        texts.append(f"{around[0]}, {''.join(passage).upper()}!\n{around[1]}")
    wanted = {}
    for n, text in enumerate(texts):
        for k, item in enumerate(items):
            distance = brute.edit_distance_to_any_part(normalised(item), normalised(text))
            if distance <= len(normalised(item)) // 20:
                wanted[n, k] = distance
    docs, bench = documents(*enumerate(texts)), items_of(spark, *enumerate(items))
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in find_leaks(docs, bench).collect()} == wanted
    assert len(wanted) > 20 and max(wanted.values()) > 1
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)  # several blocks
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in find_leaks(docs, bench).collect()} == wanted
    assert {r["doc_id"] for r in without_leaks(docs, bench).collect()} == set(range(60)) - {n for n, _ in wanted}


def test_rows_of_all_kinds(spark, documents):
    item = "the quick brown fox jumps over the lazy dog"
    docs = documents((1, f"x {item} y {item}"), (1, item), (None, item.upper()), (2, None), (3, ""), (4, "clean words"), (5, "w " * 100_000 + item))
    bench = items_of(spark, (1, item), (1, item), (2, None), (3, ""), (4, "lazy dog"), (None, item + "!"))
    found = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in find_leaks(docs, bench).collect()), key=repr)
    assert found == sorted([(d, i, 0) for d in (1, 1, None, 5) for i in (1, 1, 4, None)], key=repr)
    kept = without_leaks(docs, bench)
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4]


def test_short_items_match_whole_words(spark, documents):
    texts = ["The cat.", "concatenate", "cat", "a cats", "wildcat", "the cat-flap", "scat cat", "one two three four fivX", "one two three four five", "xone two three four five"]
    docs = documents(*enumerate(texts))
    bench = items_of(spark, (1, "cat"), (2, "Cat flap!"), (3, "one two three four five"), (4, "é"), (5, "!?"))
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in find_leaks(docs, bench).collect()}
    # 23 characters may have one edit, also one that takes a space away.
    assert found == {(0, 1): 0, (2, 1): 0, (5, 1): 0, (5, 2): 0, (6, 1): 0, (7, 3): 1, (8, 3): 0, (9, 3): 1}
    places = {(r["doc_id"], r["item_id"]): (r["near"], r["end"]) for r in find_leaks(docs, bench).collect()}
    assert places[0, 1] == (3, 7) and places[2, 1] == (0, 3) and places[8, 3][1] == 23
    assert {r["doc_id"] for r in without_leaks(docs, bench.where("item_id = 1")).collect()} == {1, 3, 4, 7, 8, 9}


def test_rules_are_the_same_on_both_sides_of_the_word_limit(spark, documents):
    """Items of 23 and 24 characters within longer words: only the longer one is a passage of its own."""
    short, long = "abcdefghij klmnopqrst uv", "abcdefghij klmnopqrst uvw"
    assert len(short) == 24 and len(long) == 25
    docs = documents((1, f"xx{short}yy"), (2, f"xx{short[:-1]}yy"), (3, short[:-1]))
    found = {(r["doc_id"], r["item_id"]) for r in find_leaks(docs, items_of(spark, (1, short), (2, short[:-1]))).collect()}
    assert (1, 1) in found and (2, 2) not in found and (3, 2) in found


def test_a_worker_builds_an_automaton_once():
    block = ("name", [(1, "the quick brown fox jumps over it")])
    first = decontaminate.Searcher.of(block)
    assert decontaminate.Searcher.of(("name", [])) is first and decontaminate.Searcher.of(("other", [])) is not first


def test_empty_tables(spark, documents):
    docs, bench = documents((1, "some words that are long enough to count")), items_of(spark, (1, "x" * 50))
    assert find_leaks(docs.where("false"), bench).count() == 0 and find_leaks(docs, bench.where("false")).count() == 0
    assert without_leaks(docs, bench.where("false")).count() == 1


def test_given_documents(spark, sf_dir, small):
    from ringledger.llm.queries import QUERIES

    _, texts = small
    items = {r["item_id"]: normalised(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    exact = {(d, i) for d, t in texts.items() for i, item in items.items() if item in normalised(t)}
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in QUERIES["op6_benchmark_leaks"](spark, sf_dir).collect()}
    assert exact and {pair for pair, distance in found.items() if distance == 0} == exact
