"""Collocations: phrases whose parts occur together far more often than their frequencies would have it.

Counting is by direct address. Words get ids by falling frequency, so that pairs of frequent words lie in few square
tiles of the (first, second) plane: a tile that is hit often is counted with one dense ``bincount``, all others
together as sorted coordinates with counts. Frequent pairs are then ranked in turn, and (pair, word) is the plane
in which phrases of three words are counted by the same function.

What is sent to the workers has a fixed bound: ids for the ``HEAD`` most frequent words and pairs of all languages
together, and a bitmap that tells which others may be frequent enough to matter. Phrases with a word outside the head
are counted too, under their own text; the bitmap only saves counting those that can't reach the threshold. The result
does not depend on these bounds.

Workers hand on counts, not occurrences, and Spark adds them up by phrase, so no task gets a tile as a whole.

Rows of every kind: a null text has no words, a null language is ``und``; words of any length count, repeated rows count
as often as they occur; an empty table gives no rows; further columns are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringledger.llm.common import stored
from ringledger.llm.components import spread_join

LEAST = 10  # occurrences of a candidate
PART_OF_LONGER = 50  # a candidate goes if a longer one around it has this many per cent of its occurrences
TOP = 2000  # phrases reported for a language

#: Words, and pairs of words, with ids of their own: 2^18, all languages together, and words of up to 64 bytes.
HEAD = 1 << 18
ID_BITS = 18
HEAD_BYTES = 64
#: A tile has 2^10 by 2^10 cells and is counted densely from this many hits on.
TILE_BITS = 10
DENSE = 1 << 17
#: Phrases a worker counts at a time, and words it holds counts of.
BUFFER = 1 << 20
COUNTED_WORDS = 300_000
#: Bits of the bitmap per entry, and at most.
BITS_PER_ENTRY = 16
MOST_BITS = 1 << 28

_BREAK = b"\xff"  # in no UTF-8 text
_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 10 + b" "
)
_COUNTS = "lang string, key bigint, phrase binary, n bigint"


def tokens_of(texts: Iterable[bytes]) -> list[bytes]:
    """The words of texts in order, with a break between pieces."""
    plain = _BREAK.join(texts).translate(_PLAIN)
    return plain.replace(_BREAK, b" " + _BREAK + b" ").split()


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        texts.setdefault(lang, []).append(text)
    yield from texts.items()


def _rows(schema: str, *columns: Iterable) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, and of all words of a language under the null word; a word may come several times."""
    counts: dict[str, Counter] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for lang, of_word in counts.items():
            of_word.pop(_BREAK, None)
            total = sum(of_word.values())
            if total:
                words = [None, *of_word]
                yield _rows("lang string, word binary, f bigint", [lang] * len(words), words, [total, *of_word.values()])
        counts.clear()

    for batch in batches:
        for lang, texts in _by_language(batch):
            counts.setdefault(lang, Counter()).update(tokens_of(texts))
        if sum(map(len, counts.values())) > COUNTED_WORDS:
            yield from flushed()
    yield from flushed()


# -- bitmaps --------------------------------------------------------------------------


def _mixed(key: np.ndarray, lang: str) -> np.ndarray:
    h = key.astype(np.uint64) ^ np.uint64(xxhash.xxh64_intdigest(lang))
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xD6E8FEB86659FD93), (32, 1)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h


def _hash(text: bytes, lang: str) -> int:
    return xxhash.xxh64_intdigest(text, seed=xxhash.xxh64_intdigest(lang))


def _bits(h: np.ndarray, size: int) -> np.ndarray:
    """Three places in a bitmap of ``size`` bits, a power of two, for every hash."""
    return np.stack([(h >> np.uint64(shift)) & np.uint64(size - 1) for shift in (0, 18, 36)]).astype(np.int64)


def _set_bits(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    words = np.zeros(size // 64, np.uint64)
    for batch in batches:
        for lang in set(langs := batch.column("lang").to_pylist()):
            mine = [n for n, other in enumerate(langs) if other == lang]
            keys, phrases = (batch.column(c).take(pa.array(mine)) for c in ("key", "phrase"))
            texts = [_hash(p, lang) for p in phrases.to_pylist() if p is not None]
            h = np.concatenate([_mixed(keys.drop_null().to_numpy(zero_copy_only=False), lang), np.array(texts, np.uint64)])
            places = _bits(h, size).ravel()
            np.bitwise_or.at(words, places >> 6, np.uint64(1) << (places & 63).astype(np.uint64))
    slots = np.flatnonzero(words)
    yield _rows("slot bigint, word bigint", slots, words[slots].view(np.int64))


def bitmap(entries: DataFrame) -> np.ndarray:
    """A bitmap of the entries (lang, key, phrase): at most ``MOST_BITS`` bits, whatever their number."""
    size, wanted = 64, min(MOST_BITS, BITS_PER_ENTRY * entries.count())
    while size < wanted:
        size *= 2
    parts = entries.select("lang", "key", "phrase").mapInArrow(lambda b: _set_bits(b, size), "slot bigint, word bigint")
    found = parts.groupBy("slot").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(size // 64, np.uint64)
    words[found["slot"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return words


def _may_hold(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    places = _bits(h, 64 * len(words))
    return ((words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)).all(axis=0)


# -- counting by tiles ----------------------------------------------------------------


def tile_counts(row: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cells (row, col) and how often each occurs; both are ids below 2^18."""
    side = ID_BITS - TILE_BITS
    tile = (row >> TILE_BITS) << side | col >> TILE_BITS
    hits = np.bincount(tile, minlength=1)
    cells, counts, sparse = [], [], np.ones(len(row), bool)
    for t in np.flatnonzero(hits >= DENSE):
        inside = tile == t
        low = (1 << TILE_BITS) - 1
        dense = np.bincount((row[inside] & low) << TILE_BITS | col[inside] & low)
        cell = np.flatnonzero(dense)
        first = (t >> side << TILE_BITS) + (cell >> TILE_BITS)
        cells.append(first << ID_BITS | (t & (1 << side) - 1) << TILE_BITS | cell & low)
        counts.append(dense[cell])
        sparse &= ~inside
    cell, n = np.unique(row[sparse] << ID_BITS | col[sparse], return_counts=True)
    cells, counts = np.concatenate([*cells, cell]), np.concatenate([*counts, n])
    return cells >> ID_BITS, cells & (1 << ID_BITS) - 1, counts


@dataclass
class Head:
    """What workers know of words or pairs: per language the frequent ones by rank, and a bitmap of the others."""

    entries: dict[str, list] = field(default_factory=dict)
    others: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint64))


class _Numbers:
    """Ids of a language's words. Words outside the head that may be frequent get ids from 2^18 on for the time being."""

    def __init__(self, head: Head, lang: str):
        self.lang, self.others = lang, head.others
        self.ids = {word: n for n, word in enumerate(head.entries.get(lang, ()))} | {_BREAK: -1}
        self.some = bool(head.others.any())
        self.tail: dict[bytes, int] = {}
        self.kept: list[np.ndarray] = []

    def add(self, texts: list[bytes]) -> int:
        tokens = tokens_of(texts)
        ids = np.fromiter(map(self.ids.get, tokens, repeat(-2)), np.int64, len(tokens))
        if self.some:
            unknown = np.flatnonzero(ids == -2)
            words = [tokens[n] for n in unknown]
            if new := list(set(words) - self.tail.keys()):
                may = _may_hold(self.others, np.array([_hash(w, self.lang) for w in new], np.uint64))
                for word, frequent in zip(new, may, strict=True):
                    self.tail[word] = (1 << ID_BITS) + len(self.tail) if frequent else -1
            ids[unknown] = [self.tail[w] for w in words]
        self.kept += [ids, np.array([-1])]
        return len(tokens)

    def taken(self) -> tuple[np.ndarray, list[bytes]]:
        """All ids since the last time, -1 where no phrase goes on, and the words behind ids from 2^18 on."""
        ids = np.concatenate([*self.kept, [-1, -1]])
        words = list(self.tail)
        self.kept, self.tail = [], {}
        return ids, words


def _phrase_counts(batches: Iterable[pa.RecordBatch], words: Head, count) -> Iterator[pa.RecordBatch]:
    """``count`` of every language's ids, about ``BUFFER`` words of all languages at a time."""
    numbers: dict[str, _Numbers] = {}
    held = 0
    for batch in batches:
        for lang, texts in _by_language(batch):
            if lang not in numbers:
                numbers[lang] = _Numbers(words, lang)
            held += numbers[lang].add(texts)
        if held > BUFFER:
            yield from _counted(numbers, count)
            held = 0
    yield from _counted(numbers, count)


def _counted(numbers: dict[str, _Numbers], count) -> Iterator[pa.RecordBatch]:
    for lang, of_lang in numbers.items():
        if of_lang.kept:
            ids, tail = of_lang.taken()
            for keys, phrases, n in count(lang, ids, tail, list(of_lang.ids)):
                yield _rows(_COUNTS, [lang] * len(n), keys, phrases, n)


def _texts(columns: list[np.ndarray], head: list[bytes], tail: list[bytes]) -> list[bytes]:
    def word(n: int) -> bytes:
        return head[n] if n < 1 << ID_BITS else tail[n - (1 << ID_BITS)]

    return [b" ".join(map(word, ids)) for ids in zip(*(c.tolist() for c in columns), strict=True)]


def _distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows and how often each occurs."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.diff(np.append(first, len(order)))


def count_pairs(lang: str, ids: np.ndarray, tail: list[bytes], head: list[bytes]) -> Iterator[tuple]:
    """Pairs of words: those of the head as ``first << 18 | second``, others as text."""
    one, two = ids[:-1], ids[1:]
    goes = (one >= 0) & (two >= 0)
    one, two = one[goes], two[goes]
    known = (one | two) < 1 << ID_BITS
    first, second, n = tile_counts(one[known], two[known])
    yield first << ID_BITS | second, [None] * len(n), n
    pairs, n = _distinct(one[~known], two[~known])
    yield [None] * len(n), _texts(pairs, head, tail), n


class CountTriples:
    """Three words both of whose pairs may be frequent; the first pair's rank and the third word address a cell."""

    def __init__(self, pairs: Head):
        self.pairs = pairs
        self.ranks: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def _ranked(self, lang: str, key: np.ndarray) -> np.ndarray:
        """The rank of every pair of head words, -1 outside the head of pairs."""
        if lang not in self.ranks:
            keys = np.array(self.pairs.entries.get(lang, []), np.int64)
            order = np.argsort(keys)
            self.ranks[lang] = np.append(keys[order], -1), np.append(order, -1)
        keys, ranks = self.ranks[lang]
        place = np.searchsorted(keys[:-1], key)
        return np.where(keys[place] == key, ranks[place], -1)

    def __call__(self, lang: str, ids: np.ndarray, tail: list[bytes], head: list[bytes]) -> Iterator[tuple]:
        one, two = ids[:-1], ids[1:]
        both = (one >= 0) & (two >= 0)
        known = both & ((one | two) < 1 << ID_BITS)
        rank = np.full(len(one), -1)
        key = one[known] << ID_BITS | two[known]
        rank[known] = self._ranked(lang, key)
        frequent = rank >= 0
        unranked = np.flatnonzero(known & ~frequent)
        frequent[unranked] = _may_hold(self.pairs.others, _mixed(one[unranked] << ID_BITS | two[unranked], lang))
        texts = np.flatnonzero(both & ~known)
        pair, back = np.unique(one[texts] << 32 | two[texts], return_inverse=True)
        hashes = [_hash(p, lang) for p in _texts([pair >> 32, pair & 0xFFFFFFFF], head, tail)]
        frequent[texts] = _may_hold(self.pairs.others, np.array(hashes, np.uint64))[back]

        start = np.flatnonzero(frequent[:-1] & frequent[1:])
        a, b, c, r = ids[start], ids[start + 1], ids[start + 2], rank[start]
        in_head = (a | b | c) < 1 << ID_BITS
        tiled = in_head & (r >= 0)
        first, third, n = tile_counts(r[tiled], c[tiled])
        pair = np.array(self.pairs.entries.get(lang, [0]), np.int64)[first] if len(n) else first
        yield pair << ID_BITS | third, [None] * len(n), n
        loose = in_head & (r < 0)
        key, n = np.unique((a[loose] << ID_BITS | b[loose]) << ID_BITS | c[loose], return_counts=True)
        yield key, [None] * len(n), n
        triples, n = _distinct(a[~in_head], b[~in_head], c[~in_head])
        yield [None] * len(n), _texts(triples, head, tail), n


def _spelled(batches: Iterable[pa.RecordBatch], words: Head, length: int) -> Iterator[pa.RecordBatch]:
    """Frequent phrases with their words as text, however they were counted."""
    for batch in batches:
        langs, keys, phrases, n = (batch.column(c).to_pylist() for c in ("lang", "key", "phrase", "n"))
        parts = []
        for lang, key, phrase in zip(langs, keys, phrases, strict=True):
            if phrase is None:
                ids = [key >> ID_BITS * place & (1 << ID_BITS) - 1 for place in reversed(range(length))]
                parts.append([words.entries[lang][i] for i in ids])
            else:
                parts.append(phrase.split(b" "))
        columns = [langs, [b" ".join(p) for p in parts], n, [p[0] for p in parts], [p[-1] for p in parts]]
        columns += [[b" ".join(p[:-1]) for p in parts], [b" ".join(p[1:]) for p in parts]]
        yield _rows(_SPELLED, *columns)


_SPELLED = "lang string, phrase binary, a bigint, first binary, last binary, but_last binary, but_first binary"


def _level(n: str) -> Column:
    """Whole steps of a count: fine enough, and a few thousand at most."""
    return F.when(F.col(n) < 1024, F.col(n)).otherwise(1024 + F.floor(64 * F.log2(F.col(n).cast("double")))).cast("long")


def _split(counts: DataFrame, eligible: Column, n: str, most: int) -> tuple[DataFrame, DataFrame]:
    """The most frequent of the eligible rows, at most ``most``, and all other rows; nothing is sorted for it."""
    levels = counts.where(eligible).groupBy(_level(n).alias("level")).count().collect()
    held, least = 0, None
    for row in sorted(levels, reverse=True):
        held += row["count"]
        if held > most:
            break
        least = row["level"]
    inside = eligible & (_level(n) >= least) if least is not None else F.lit(False)
    return counts.where(inside), counts.where(~inside)


def _head(top: DataFrame, name: str, n: str) -> Head:
    rows = top.select("lang", F.col(name).alias("entry"), F.col(n).alias("n")).toArrow().to_pylist()
    head = Head()
    for row in sorted(rows, key=lambda r: (r["lang"], -r["n"], r["entry"])):
        head.entries.setdefault(row["lang"], []).append(row["entry"])
    return head


def collocations(
    docs: DataFrame, least: int = LEAST, part_of_longer: int = PART_OF_LONGER, top: int = TOP, head: int = HEAD
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the foremost ``top`` phrases of two and three words per language.

    A phrase that occurs a times is cut where a² / (l r) is least, l and r being the occurrences of its parts; its
    score is that in millionths, rounded down. A pair of which ``part_of_longer`` per cent of the occurrences lie
    in one phrase of three words is left out. Ties in the score go by a, then by the phrase's bytes.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    counted = texts.mapInArrow(word_counts, "lang string, word binary, f bigint")
    counted = counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))
    counted = stored(counted.where((F.col("f") >= least) | F.col("word").isNull()), "word-counts")
    totals = counted.where("word IS NULL").select("lang", F.col("f").alias("n"))
    words = counted.where("word IS NOT NULL")

    top_words, rare = _split(words, F.octet_length("word") <= HEAD_BYTES, "f", head)
    known = _head(top_words, "word", "f")
    known.others = bitmap(rare.select("lang", F.lit(None).cast("long").alias("key"), F.col("word").alias("phrase")))
    sent = spark.sparkContext.broadcast(known)

    def phrases(count, length: int, label: str) -> tuple[DataFrame, DataFrame]:
        found = texts.mapInArrow(lambda b: _phrase_counts(b, sent.value, count()), _COUNTS)
        found = found.groupBy("lang", "key", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        found = stored(found, label)
        return found, found.mapInArrow(lambda b: _spelled(b, sent.value, length), _SPELLED)

    found, pairs = phrases(lambda: count_pairs, 2, "pair-counts")
    top_pairs, rare = _split(found, F.col("key").isNotNull(), "n", head)
    ranked = _head(top_pairs, "key", "n")
    ranked.others = bitmap(rare)
    sent_pairs = spark.sparkContext.broadcast(ranked)
    _, triples = phrases(lambda: CountTriples(sent_pairs.value), 3, "triple-counts")
    return _ranked_phrases(stored(words, "words"), stored(pairs, "pairs"), stored(triples, "triples"), totals, part_of_longer, top)


def _looked_up(left: DataFrame, counts: DataFrame, column: str, entry: str, n: str, name: str) -> DataFrame:
    """``left`` with how often its ``column`` occurs; every part of a frequent phrase is itself frequent."""
    found = counts.select(F.struct("lang", F.col(entry).alias("part")).alias("slot"), F.col(n).alias(name))
    return spread_join(left.withColumn("slot", F.struct("lang", F.col(column).alias("part"))), found, "slot").drop("slot")


def _cut(k: int, left: str, right: str) -> Column:
    """One way to cut a phrase, ordered by score and place. The products need more than 64 bits."""
    score = F.expr(f"CAST((CAST(a AS DECIMAL(38,0)) * a * 1000000) DIV (CAST({left} AS DECIMAL(38,0)) * {right}) AS BIGINT)")
    return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))


def _ranked_phrases(
    words: DataFrame, pairs: DataFrame, triples: DataFrame, totals: DataFrame, part_of_longer: int, top: int
) -> DataFrame:
    around = triples.selectExpr("lang", "a", "explode(array(but_last, but_first)) AS phrase")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    around = around.select(F.struct("lang", F.col("phrase").alias("part")).alias("slot"), "longer")
    kept = spread_join(pairs.withColumn("slot", F.struct("lang", F.col("phrase").alias("part"))), around, "slot", "left")
    kept = kept.where(F.col("longer").isNull() | (100 * F.col("longer") < part_of_longer * F.col("a"))).drop("slot")
    kept = _looked_up(_looked_up(kept, words, "first", "word", "f", "l"), words, "last", "word", "f", "r")
    kept = kept.select("lang", "phrase", "a", _cut(1, "l", "r").alias("cut"))

    long = _looked_up(_looked_up(triples, words, "first", "word", "f", "l1"), pairs, "but_first", "phrase", "a", "r1")
    long = _looked_up(_looked_up(long, pairs, "but_last", "phrase", "a", "l2"), words, "last", "word", "f", "r2")
    long = long.select("lang", "phrase", "a", F.least(_cut(1, "l1", "r1"), _cut(2, "l2", "r2")).alias("cut"))

    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.unionByName(long).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        F.decode("phrase", "UTF-8").alias("phrase"),
        "a",
        "cut.l",
        "cut.r",
        "n",
        "cut.score",
    )
