"""Near-duplicate documents by BagMinHash: weighted MinHash of multisets of five-word shingles.

A shingle that occurs w times has weight w. Weights are discretised at the integers and grouped into dyadic
intervals (0,1], (1,2], (2,4], (4,8], ... Each shingle has a Poisson process per interval, seeded by both, whose
points carry a time, a slot of the signature and a level within the interval; a text sees the points whose level
its weight reaches. Each slot keeps its first point. Two texts agree in a slot with probability equal to their
weighted Jaccard similarity, sum of least over sum of greatest weights. Points are generated in order of time and
only up to the time by which all slots are expected to be filled, which costs one number per shingle and a fixed
number per signature; a text with slots left empty goes on to twice the time.

Signatures are banded; texts that share a band are candidates, and ``banding.linked`` says which of them are compared.
A candidate pair is dropped if signatures agree in so few slots that similarity 0.8 is out of the question, and
else decided by the exact multisets.

Defined results: equal texts are one text from the start. A text of fewer than five words is one shingle. A text
without words (null, empty) is in a class of its own, whatever others there are. The class id is the least id in
the class, null only if all are null; repeated rows are in one class. Other columns than id and text are not read.
Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.banding import linked
from ringledger.llm.common import stored
from ringledger.llm.components import lookup_join, spread_join

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 30
ROWS = 5
SLOTS = BANDS * ROWS
#: Slots that must agree for a pair to be verified; at similarity 0.8 that many do but for one pair in a million.
LEAST_AGREEING = 96

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _times(k: int, constant: np.uint64) -> np.uint64:
    return np.uint64(k * int(constant) % (1 << 64))


def shingles(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the text's distinct shingles, ascending, and how often each occurs."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    mixed = np.full(n, len(words) if len(words) < SHINGLE else SHINGLE, np.uint64)
    for k in range(min(SHINGLE, len(words))):
        mixed = _mix(mixed * _GOLD + hashes[k : k + n])
    return np.unique(mixed, return_counts=True)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` 32-bit values per non-empty multiset."""
    out = np.zeros((len(sets), slots), np.uint32)
    todo, patience = np.arange(len(sets)), 3.0
    while len(todo):
        part = [sets[k] for k in todo]
        weight = np.array([c.sum() for _, c in part], float)
        until = (np.log(slots) + patience) / weight
        best, name = _first_points(part, until, slots)
        full = np.isfinite(best).all(axis=1)
        out[todo[full]] = name[full]
        todo, patience = todo[~full], 2 * patience + np.log(slots)
    return out


def _first_points(sets: list[tuple[np.ndarray, np.ndarray]], until: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Time and name of each slot's first point among those up to ``until``, per multiset."""
    owner = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    element = np.concatenate([h for h, _ in sets])
    count = np.concatenate([c for _, c in sets])
    best, name = np.full(len(sets) * slots, np.inf), np.zeros(len(sets) * slots, np.uint32)
    low, width, interval = 0, 1, 0
    while len(element):  # one dyadic interval of weights at a time, for the elements that reach it
        seed = _mix(element + _times(interval, _M2))
        live, time, step = np.arange(len(element)), np.zeros(len(element)), 0
        while len(live):
            step += 1
            draw = _mix(seed[live] + _times(step, _GOLD))
            time = time - np.log(((draw >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / (slots * width)
            on = time <= until[owner[live]]
            live, time, draw = live[on], time[on], draw[on]
            second = _mix(draw ^ _M1)
            slot = ((second >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
            level = low + 1 + (second & np.uint64(0xFFFFFFFF)) % np.uint64(width)
            seen = level <= count[live] if width > 1 else np.ones(len(live), bool)
            key = owner[live[seen]] * slots + slot[seen].astype(np.int64)
            at = time[seen]
            np.minimum.at(best, key, at)
            wins = best[key] == at
            name[key[wins]] = (draw[seen][wins] >> np.uint64(16)).astype(np.uint32)
        low, width, interval = low + width, low + width, interval + 1
        keep = count > low
        element, owner, count = element[keep], owner[keep], count[keep]
    return best.reshape(len(sets), slots), name.reshape(len(sets), slots)


def band_hashes(signs: np.ndarray) -> np.ndarray:
    """One 64-bit value per row and band."""
    cut = signs.reshape(len(signs), BANDS, ROWS).astype(np.uint64)
    mixed = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(signs), BANDS)).copy()
    for k in range(ROWS):
        mixed = _mix(mixed * _GOLD + cut[:, :, k])
    return mixed.view(np.int64)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _signed(texts: DataFrame) -> DataFrame:
    """key, signature and bands of every row (key, text) that has a word."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t) for t in part.column("text").to_pylist()]
                worded = [k for k, s in enumerate(sets) if len(s[0])]
                sets = [sets[k] for k in worded]
                signs = signatures(sets)
                bands = band_hashes(signs)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(pa.array(worded, pa.int64())),
                        pa.array([row.tobytes() for row in signs], pa.binary()),
                        pa.array(list(bands), pa.list_(pa.int64())),
                    ],
                    names=["key", "signature", "bands"],
                )

    return texts.mapInArrow(sign, "key binary, signature binary, bands array<long>")


def _agreeing(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose signatures agree in enough slots."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, SLOTS) for c in ("sign_a", "sign_b")
            )
            enough = (one == two).sum(axis=1) >= LEAST_AGREEING
            yield batch.select(["a", "b"]).filter(pa.array(enough))

    one = signed.select(F.col("key").alias("a"), F.col("signature").alias("sign_a"))
    two = signed.select(F.col("key").alias("b"), F.col("signature").alias("sign_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "sign_a", "sign_b")
    return both.mapInArrow(keep, "a binary, b binary")


def _verified(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose texts have similarity ``SIMILARITY`` or more."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, held, near = None, None, []
            for a, one, two in zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "text_b")), strict=True):
                if a != last:  # an end or a middle of a band meets many others in a row
                    last, held = a, shingles(one)
                near.append(weighted_jaccard(held, shingles(two)) >= SIMILARITY)
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    one = contents.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    two = contents.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(keep, "a binary, b binary")


def _parts(contents: DataFrame) -> DataFrame:
    """key, part and weight: the texts' shingles and their counts."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                sets = [shingles(t) for t in rows.column("text").to_pylist()]
                owner = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("key").take(pa.array(owner)),
                        pa.array(np.concatenate([h for h, _ in sets]).view(np.int64)),
                        pa.array(np.concatenate([c for _, c in sets]).astype(np.int64)),
                    ],
                    names=["key", "part", "weight"],
                )

    return contents.select("key", "text").mapInArrow(spell, "key binary, part long, weight long")


def _against(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """key, the weight ``shared`` with its centre, and ``rest``, what it has more often; of pairs (key, centre)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, centre, shared, rest = None, None, [], []
            for at, one, two in zip(*(batch.column(c).to_pylist() for c in ("centre", "text", "text_centre")), strict=True):
                if at != last:
                    last, centre = at, shingles(two)
                part, count = shingles(one)
                place = np.minimum(np.searchsorted(centre[0], part), len(centre[0]) - 1)
                there = np.where(centre[0][place] == part, centre[1][place], 0)
                shared.append(int(np.minimum(count, there).sum()))
                more = count > there
                rest.append([{"part": p, "excess": e} for p, e in zip(part[more].view(np.int64).tolist(), (count - there)[more].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(shared, pa.int64()), pa.array(rest, rest_type)], names=["key", "shared", "rest"]
            )

    one = contents.select("key", "text")
    two = contents.select(F.col("key").alias("centre"), F.col("text").alias("text_centre"))
    both = pairs.join(one, "key").join(two, "centre").select("key", "centre", "text", "text_centre")
    rest_type = pa.list_(pa.struct([("part", pa.int64()), ("excess", pa.int64())]))
    return both.mapInArrow(compare, "key binary, shared long, rest array<struct<part:long,excess:long>>")


def linked_texts(texts: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every text key that is linked to another one; ``texts`` has key and text (binary)."""
    signed = _signed(texts).groupBy("key").agg(*[F.first(c).alias(c) for c in ("signature", "bands")])
    signed = stored(signed, "signatures")

    def fetch(keys: DataFrame) -> DataFrame:
        wanted = lookup_join(texts, stored(keys, "wanted-texts"), "key", "left_semi")
        return wanted.groupBy("key").agg(F.first("text").alias("text"))

    def near(pairs: DataFrame, contents: DataFrame) -> DataFrame:
        return _verified(stored(_agreeing(pairs, signed), "agreeing"), contents)

    members = signed.select("key", F.explode("bands").alias("band"))
    return linked(members, fetch, near, _parts, _against, SIMILARITY)


def classes(docs: DataFrame) -> DataFrame:
    """The rows of (row, doc_id, text) as row, doc_id and ``class_key``; null for a text without words."""
    keyed = docs.select("row", "doc_id", text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).rlike(r"[^ \t\n\x0B\f\r]").alias("worded"))
    texts = docs.select(text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    known = linked_texts(texts).select(F.col("node").alias("key"), "root")
    return keyed.join(known, "key", "left").select(
        "row", "doc_id", F.when(F.col("worded"), F.coalesce("root", "key")).alias("class_key")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id and class_size."""
    placed = classes(docs.select("doc_id", docs["text"].cast("string").alias("text"), F.lit(0).alias("row")))
    placed = stored(placed.drop("row"), "classes")
    sizes = placed.where("class_key IS NOT NULL").groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    joined = spread_join(placed.where("class_key IS NOT NULL"), sizes, "class_key").select("doc_id", "class_id", "class_size")
    alone = placed.where("class_key IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return joined.unionByName(alone)


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near copies, all columns as they were: of each class the row with the least id stays.

    Rows are told apart by their place, so the table must be read from files, or be ``stored``.
    """
    names = [F.col(f"`{n}`") for n in docs.columns]
    rows = docs.select(F.struct(*names).alias("_row"), F.monotonically_increasing_id().alias("row"))
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    placed = stored(classes(slim).where("class_key IS NOT NULL"), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")
    first = placed.groupBy("class_key").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    goes = spread_join(placed, first, "class_key").where(F.col("row") != F.col("first.row")).select("row")
    return rows.join(goes, "row", "left_anti").select(*[F.col(f"_row.`{n}`").alias(n) for n in docs.columns])
