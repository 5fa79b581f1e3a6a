"""Spelling variants: words one insertion, deletion or replacement apart, and the usual form of each.

Near words are found by pivotal grams. Bigrams are ranked from rare to common by how many words have them. A word's
gram prefix holds its three rarest bigrams (and any as common as the third); two of these that do not overlap, the
cheapest by dynamic programming, are its pivots. One edit breaks at most one of two disjoint bigrams. So of two near
words, the one whose prefix ends earlier in the ranking has a pivot that the other one's prefix holds.

Position limits: the edit lies on one side of that pivot, so the other side is the same in both words, and on the side
with the edit one half is the same too. Pivots and prefix grams are filed under a pivot's place together with such a
side, and with a half of the other side where the first is short. Only words that agree in this are compared.

What workers hold is bounded: bigrams of 90 letters at most, counts of ``COUNTED_WORDS`` words at a time.

Rows of every kind: a null text has no words, a null doc_id counts as the empty text, rows repeat as often as they occur;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import stored
from ringledger.llm.components import merged, spread_join

#: Fixed values of the contract: letters, the least length and count of a word, every how many-th run loses a letter.
RUN = re.compile("[A-Za-zÀ-ÿ]{7,}")
LETTERS = 7
LEAST = 2
SLIP = 31
#: How many times more frequent a form is than its variant.
USUAL = 10

COUNTED_WORDS = 300_000
#: A side of a pivot that is at least so long is not told apart further by half of the other side.
LONG_SIDE = 6

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(doc_id: str, text: str) -> Iterator[str]:
    """The runs of a text in lower case, some of them with a letter lost, of at least ``LETTERS`` letters."""
    runs = RUN.findall(text.encode().translate(_LOWER).decode())
    for run, h in zip(runs, map(crc32, map(str.encode, runs), repeat(crc32(f"{doc_id}:".encode()))), strict=True):
        if h % SLIP:
            yield run
        elif len(run) > LETTERS:
            at = h % len(run)
            yield run[:at] + run[at + 1 :]


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def flushed() -> pa.RecordBatch:
        words, n = pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())
        counts.clear()
        return pa.RecordBatch.from_arrays([words, n], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts.update(words_of(doc_id, text))
        if len(counts) > COUNTED_WORDS:
            yield flushed()
    yield flushed()


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """word and n, for words that occur at least ``least`` times."""
    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = named.mapInArrow(_word_counts, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


# -- pivots and prefixes ------------------------------------------------------------------


def gram_prefix(ranks: list[int]) -> list[int]:
    """Places of the three rarest bigrams of a word, given the ranks of all, and of those as common as the third."""
    last = sorted(ranks)[2]
    return [place for place, rank in enumerate(ranks) if rank <= last]


def pivots(places: list[int], costs: list[int]) -> tuple[int, int]:
    """Two of the ascending places, at least two apart, whose costs have the least sum."""
    best: tuple[int, int, int] | None = None  # the cheapest two so far
    single: tuple[int, int] | None = None  # the cheapest place that leaves room for the next one
    waiting: list[tuple[int, int]] = []
    for place, cost in zip(places, costs, strict=True):
        while waiting and waiting[0][0] <= place - 2:
            earlier, its_cost = waiting.pop(0)
            single = min(filter(None, (single, (its_cost, earlier))))
        if single:
            best = min(filter(None, (best, (single[0] + cost, single[1], place))))
        waiting.append((place, cost))
    assert best, "three places hold two that are apart"
    return best[1], best[2]


def pivot_keys(word: str, p: int) -> Iterator[str]:
    """What another word has in common with this one if the pivot at ``p`` outlives the edit between them.

    The edit lies to the right, so that the word agrees up to the pivot, or to the left, so that it agrees from there on.
    """
    size = len(word)
    yield from _right_keys(word, p, (size - p - 2) // 2, 0)
    yield from _left_keys(word, p, p // 2, 0)


def prefix_keys(word: str, q: int) -> set[str]:
    """All ``pivot_keys`` of words one edit away whose pivot is the bigram at ``q`` here."""
    keys = set()
    for more in (-1, 0, 1):  # how much longer this word is than the other one
        rest = len(word) - more - q - 2
        if rest >= 0:
            keys.update(_right_keys(word, q, rest // 2, more))
        if q >= more:
            keys.update(_left_keys(word, q, (q - more) // 2, more))
    return keys


def _right_keys(word: str, p: int, half: int, more: int) -> Iterator[str]:
    """The edit lies right of the bigram at ``p``: in the second half there, or in the first ``half`` letters."""
    left = p + 2
    if left >= LONG_SIDE:
        yield f"a{word[:left]}"
        return
    yield f"b{p} {word[: left + half]}"
    if half:
        yield f"c{word[:left]} {word[left + half + more :]}"


def _left_keys(word: str, p: int, half: int, more: int) -> Iterator[str]:
    """The edit lies left of the bigram at ``p``: after the first ``half`` letters there, or within them."""
    if len(word) - p >= LONG_SIDE:
        yield f"d{word[p:]}"
        return
    yield f"e{word[:half]} {word[p:]}"
    if half:
        yield f"f{len(word) - p} {word[half + more :]}"


def _grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            counts.update({word[i : i + 2] for i in range(len(word) - 1)})
    yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["gram", "n"])


def _filed(batches: Iterable[pa.RecordBatch], often: dict[str, int], by_pivots: bool) -> Iterator[pa.RecordBatch]:
    """A row per key of every word, by its pivots or by its gram prefix."""
    rank = {gram: n for n, gram in enumerate(sorted(often, key=lambda g: (often[g], g)))}
    for batch in batches:
        rows, keys = [], []
        for row, word in enumerate(batch.column("word").to_pylist()):
            grams = [word[i : i + 2] for i in range(len(word) - 1)]
            places = gram_prefix([rank[g] for g in grams])
            if by_pivots:
                found = [k for p in pivots(places, [often[grams[p]] for p in places]) for k in pivot_keys(word, p)]
            else:
                found = set().union(*(prefix_keys(word, q) for q in places))
            rows += repeat(row, len(found))
            keys += map(xxhash.xxh64_intdigest, found)
        filed = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.uint64()).view(pa.int64()), *filed.columns], ["key", *filed.schema.names])


def near_words(words: DataFrame) -> DataFrame:
    """Pairs (a, n_a, b, n_b) of different words that are one edit apart, each pair once, a before b."""
    grams = words.mapInArrow(_grams, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    often = {r["gram"]: r["n"] for r in grams.collect()}  # at most one row per pair of letters
    sent = words.sparkSession.sparkContext.broadcast(often)

    def filed(name: str, by_pivots: bool) -> DataFrame:
        rows = words.mapInArrow(lambda b: _filed(b, sent.value, by_pivots), "key bigint, word string, n bigint")
        return rows.select("key", F.col("word").alias(name), F.col("n").alias(f"n_{name}"))

    met = filed("r", True).join(merged(filed("s", False)), "key").where("r != s AND abs(length(r) - length(s)) <= 1")
    near = met.where(F.levenshtein("r", "s", 1) == 1)
    first = F.least(F.struct(F.col("r").alias("w"), F.col("n_r").alias("n")), F.struct(F.col("s").alias("w"), F.col("n_s").alias("n")))
    last = F.greatest(F.struct(F.col("r").alias("w"), F.col("n_r").alias("n")), F.struct(F.col("s").alias("w"), F.col("n_s").alias("n")))
    pairs = near.select(first.alias("a"), last.alias("b")).distinct()
    return pairs.select(F.col("a.w").alias("a"), F.col("a.n").alias("n_a"), F.col("b.w").alias("b"), F.col("b.n").alias("n_b"))


def spelling_forms(words: DataFrame, usual: int = USUAL) -> DataFrame:
    """word, n, n_near, form, form_n and root of every row of (word, n).

    ``form`` is the most frequent near word (the first in code-point order of several) if it is at least ``usual``
    times as frequent; ``root`` follows forms to the last one.
    """
    pairs = stored(near_words(words), "near-words")
    both = pairs.selectExpr("inline(array(struct(a AS word, b AS other, n_b AS m), struct(b AS word, a AS other, n_a AS m)))")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    known = words.join(merged(best), "word", "left")
    has_form = -F.col("best.m") >= usual * F.col("n")
    formed = stored(
        known.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(has_form, F.col("best.other")).alias("form"),
            F.when(has_form, -F.col("best.m")).alias("form_n"),
        ),
        "forms",
    )
    # Forms grow in frequency, so chains are short; each round doubles what is followed of them.
    roots = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        followed = spread_join(roots, merged(onward), "root", "left")
        followed = stored(followed.select("word", F.coalesce("onward", "root").alias("root"), "onward"), "roots")
        roots = followed.drop("onward")
        if followed.where("onward IS NOT NULL").isEmpty():
            break
    named = formed.join(merged(roots), "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``spelling_forms`` of the words of documents."""
    return spelling_forms(stored(word_counts(docs), "words"))
