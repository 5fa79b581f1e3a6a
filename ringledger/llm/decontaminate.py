"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may differ from a passage of a document by up to k = n // ``CHARS_PER_EDIT`` edits. Cut
into k + 1 pieces, at least one piece is left untouched by k edits, so every such passage holds one piece exactly.
One automaton over the pieces of many items finds all exact hits in one pass over a text; each hit places its item
in the text, and Myers' bit-parallel edit distance, carried over the window around it, decides. Both sides are
compared in lower case with runs of anything but letters and digits as one space.

Items are a query set: they are dealt over blocks of about ``BLOCK_CHARS`` characters, one block at a time is sent
to the executors, and every document is read against every block. So what is broadcast is bounded whatever the
benchmark's size, and so is the automaton, which a worker process builds once per block. There is no shuffle.

Defined results: null or empty texts and items match nothing. An item of fewer than ``WORDWISE_CHARS`` normalised
characters matches from the beginning of a word to the end of one only, as it might lie within longer words by
chance. Equal items each match; an item is reported once per document, at its best match, ties to the first. Repeated rows and null ids get results of their own. Only id and
text are read on both sides. Texts are searched whole.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHARS_PER_EDIT = 20
WORDWISE_CHARS = 24
#: An automaton takes about 60 bytes per character of its items.
BLOCK_CHARS = 1_000_000

_GAP = re.compile(r"[\W_]+")

Block = tuple[str, list[tuple[object, str]]]


def normalised(text: str | None) -> str:
    return _GAP.sub(" ", text.lower()).strip() if text else ""


def budget_of(item: str) -> int:
    """Edits allowed; the spaces that ``Searcher`` puts around a short item don't count."""
    return len(item.strip()) // CHARS_PER_EDIT


def pieces(item: str) -> list[tuple[int, str]]:
    """(position, piece) of the item's budget-plus-one pieces, of equal length but for one character."""
    parts = budget_of(item) + 1
    cuts = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def myers(pattern_bits: dict[str, int], m: int, window: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of the pattern to any substring of the window, and the substring's end; None beyond ``most``."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, most + 1, -1
    for at, c in enumerate(window):
        eq = pattern_bits.get(c, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
        if score < best:
            best, end = score, at + 1
    return (best, end) if best <= most else None


def bits_of(pattern: str) -> dict[str, int]:
    bits: dict[str, int] = defaultdict(int)
    for at, c in enumerate(pattern):
        bits[c] |= 1 << at
    return dict(bits)


class Searcher:
    """Automaton over the pieces of a block of items."""

    _last: tuple[str, Searcher] | None = None

    @classmethod
    def of(cls, block: Block) -> Searcher:
        """The searcher of the block this process had last, or a new one."""
        if cls._last is None or cls._last[0] != block[0]:
            cls._last = None  # before the next one is built
            cls._last = block[0], cls(block[1])
        return cls._last[1]

    def __init__(self, items: list[tuple[int, str]]):
        # A short item begins and ends with the space around its words.
        items = [(i, f" {text} " if len(text) < WORDWISE_CHARS else text) for i, text in items]
        self.items = items
        self.bits = [bits_of(item) for _, item in items]
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, item) in enumerate(items):
            for at, piece in pieces(item):
                owners[piece].append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, found in owners.items():
            self.automaton.add_word(piece, (len(piece), found))
        if owners:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, distance, start of the searched window, end of the match) of every item in the normalised text."""
        if not len(self.automaton):
            return []
        text = f" {text} "
        places: dict[int, set[int]] = defaultdict(set)
        for last, (size, found) in self.automaton.iter(text):
            for number, at in found:
                places[number].add(last + 1 - size - at)
        out = []
        for number, starts in places.items():
            item = self.items[number][1]
            budget, best = budget_of(item), None
            done = -1
            for start in sorted(starts):
                # Windows of places within the budget of each other overlap: one search covers a run of them.
                low, high = max(0, start - budget), start + len(item) + budget
                if high <= done:
                    continue
                found = myers(self.bits[number], len(item), text[low:high], budget)
                done = high
                if found and (best is None or found[0] < best[0]):
                    best = (found[0], low, low + found[1])
            if best:
                # Places are told without the space in front of the text, and the text's end without the one behind it.
                out.append((number, best[0], max(0, best[1] - 1), min(best[2] - 1, len(text) - 2)))
        return out


def _blocks(items: DataFrame) -> Iterator[Block]:
    """The items, normalised, in blocks of bounded size, each with a name of its own."""
    slim = items.select("item_id", F.col("text").cast("string").alias("text"))
    size = slim.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // BLOCK_CHARS))
    for block in range(n):
        part = slim if n == 1 else slim.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        found = [(r["item_id"], normalised(r["text"])) for r in part.collect()]
        yield uuid.uuid4().hex, [(i, text) for i, text in found if text]


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, distance, and the place in the normalised text."""
    spark = docs.sparkSession
    slim = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    schema = T.StructType(
        [slim.schema["doc_id"], T.StructField("item_id", items.schema["item_id"].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("distance", "near", "end")]
    )
    item_type = items.select("item_id").limit(0).toArrow().schema.field(0).type
    results = None
    for block in _blocks(items):
        shared = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searcher = Searcher.of(shared.value)
            for batch in batches:
                owner, rows = [], []
                for at, text in enumerate(batch.column(1).to_pylist()):
                    for found in searcher.matches(normalised(text)):
                        owner.append(at)
                        rows.append(found)
                numbers = list(zip(*rows, strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner, pa.int64())),
                        pa.array([searcher.items[k][0] for k in numbers[0]], item_type),
                        *(pa.array(c, pa.int64()) for c in numbers[1:]),
                    ],
                    names=schema.names,
                )

        found = slim.mapInArrow(search, schema)
        results = found if results is None else results.unionByName(found)
    return results


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns as they were; one pass per block and no shuffle."""
    at = docs.columns.index(text)
    for block in _blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searcher = Searcher.of(shared.value)
            for batch in batches:
                stays = [not searcher.matches(normalised(value)) for value in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(stays, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
