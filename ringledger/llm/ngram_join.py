"""Documents whose sets of three-word shingles have a Jaccard similarity of at least 0.9, linked into components.

Texts with the same set are one node. Nodes lie in bands by the size of their set, so narrow that only equal and
neighbouring bands can link. Each pair of bands is dealt into tiles: hash space is cut into one range more than two
linked sets can have shingles that only one of them holds, so they agree on a whole range; its number and contents name
the tile. (A set with an empty range could agree on that alone, so it is also filed under its least hashes, as many as
two such sets need to share one.) Sets of one tile are the only ones compared, and none that link are missed.

Every set has a bitmap, as wide as its band asks for, in which each shingle flips one bit. The bits in which two
bitmaps differ are no more than the shingles only one set holds, which bounds the overlap from above; only what passes
is intersected.

A group of m near copies fills the same tiles m times. All pairs are not needed to tell its components: the node that
shares tiles with most others is in the middle of its group, and every node first meets the most central one of its
tiles, then those of all tiles that still hold several components. What is left is compared in blocks of
fixed size, by bitmaps, in the worker: nodes outside a tile's largest component against all of the tile. At first only the
closest node of every other component leaves the worker; where that one turns out not to link, all that may.

Rows of every kind: a null, empty or blank text has no shingles, links with nothing and stays alone; rows with the same
doc_id and different texts count apart; a null doc_id stays null and never names a component unless it has no other.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import stored
from ringledger.llm.components import components, lookup_join, spread_join

WORDS = 3
PERCENT = 90

#: Words whose hashes a worker remembers.
MEMORY = 200_000
#: Bits of a bitmap per shingle, and its width at least and at most.
BITS_PER_SHINGLE = 2
LEAST_BITS, MOST_BITS = 256, 1 << 16
#: Nodes of a block: those in question, and those they are compared with.
ASKING, ASKED = 256, 2048

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[3]
    h = (h ^ (h >> np.uint64(29))) * _ODD[3]
    return h ^ (h >> np.uint64(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: bytes, hashes: dict[bytes, int]) -> np.ndarray:
    """The distinct shingles of a text as ascending hashes."""
    words = text.translate(_LOWER).split()
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(w) < WORDS:
        return _mix((w * np.array(_ODD[1 : 1 + len(w)])).sum(keepdims=True) ^ np.uint64(len(w))) if len(w) else w
    return np.unique(_mix(sum(w[k : len(w) - WORDS + 1 + k] * _ODD[k] for k in range(WORDS))))


# -- bands and tiles --------------------------------------------------------------------


@cache
def band_edges(percent: int) -> list[int]:
    """The least size of every band: linked sets lie in the same band or in neighbouring ones."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(100 * edges[-1] // percent + 1)
    return edges


@cache
def ranges_of(band: int, percent: int) -> int:
    """Into how many ranges the sets of a band and the next one are cut: at least one has no difference."""
    edges = band_edges(percent)
    both = edges[band + 1] + edges[band + 2] - 2
    return both * (100 - percent) // (100 + percent) + 1


def tile_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """The tiles of a set, in the bands it may share with smaller and with larger ones."""
    n = len(hashes)
    band = bisect_right(band_edges(percent), n) - 1
    mixed = _mix(hashes + _ODD[1])
    keys = []
    for low in (band - 1, band):
        ranges = ranges_of(low, percent) if low >= 0 else 1
        if ranges == 1:
            continue  # only equal sets can link
        part = ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        start = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        name = (part[start] << np.uint64(20)) + np.uint64(low)
        keys.append(_mix(np.add.reduceat(mixed, start) + _mix(name)))
        if len(start) < ranges:
            prefix = hashes[: n - -(-percent * n // 100) + 1]
            keys.append(_mix(prefix + _mix(np.array([low], np.uint64) + _ODD[2])))
    return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


def bitmap_bits(n: int) -> int:
    bits = LEAST_BITS
    while bits < min(MOST_BITS, BITS_PER_SHINGLE * n):
        bits *= 2
    return bits


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Each shingle flips a bit, told by its last bits, so that halves of a bitmap can be laid over each other."""
    bits = bitmap_bits(len(hashes))
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps of the same sets, ``words`` words wide."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _may_link(n_a: np.ndarray, n_b: np.ndarray, differing: np.ndarray, percent: int) -> np.ndarray:
    """Whether the overlap can be large enough, given the bits that differ."""
    most = np.minimum((n_a + n_b - differing) // 2, np.minimum(n_a, n_b))
    return 100 * most >= percent * (n_a + n_b - most)


# -- work in the workers ------------------------------------------------------------------


def _record(fields: list[tuple[str, pa.DataType, Iterable]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for _, kind, values in fields], [name for name, _, _ in fields])


def _signed(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        sets = [shingle_set(text, hashes) for text in batch.column("text").to_pylist()]
        keys = [tile_keys(s, percent) if len(s) else np.zeros(0, np.int64) for s in sets]
        ends = np.cumsum([0, *map(len, keys)])
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
        digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
        sizes = pa.array([len(s) for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, digests, listed], ["doc_id", "n", "digest", "keys"])


def _contents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets and bitmaps of the texts that belong to the node they were fetched for."""
    hashes = _WordHashes()
    for batch in batches:
        found = []
        for node, digest, text in zip(*(batch.column(c).to_pylist() for c in ("node", "digest", "text")), strict=True):
            s = shingle_set(text, hashes)
            if xxhash.xxh3_128_digest(s.tobytes()) == digest:
                found.append((node, len(s), bitmap(s).tobytes(), s.tobytes()))
        nodes, sizes, bits, sets = zip(*found, strict=True) if found else [()] * 4
        fields = [("node", pa.int64(), nodes), ("n", pa.int64(), sizes), ("bits", pa.binary(), bits), ("hashes", pa.binary(), sets)]
        yield _record(fields)


def _linked_pairs(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = []
        columns = (batch.column(c).to_pylist() for c in ("a", "b", "bits_a", "bits_b", "hashes_a", "hashes_b"))
        for a, b, bits_a, bits_b, one, two in zip(*columns, strict=True):
            bits_a, bits_b = np.frombuffer(bits_a, np.uint64), np.frombuffer(bits_b, np.uint64)
            words = min(len(bits_a), len(bits_b))
            differing = int(np.bitwise_count(_folded(bits_a, words) ^ _folded(bits_b, words)).sum())
            n_a, n_b = len(one) // 8, len(two) // 8
            if not _may_link(n_a, n_b, differing, percent):
                continue
            one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
            place = np.searchsorted(two, one)
            place[place == n_b] = 0
            both = int((two[place] == one).sum())
            if 100 * both >= percent * (n_a + n_b - both):
                pairs.append((a, b))
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        yield _record([("a", pa.int64(), a), ("b", pa.int64(), b)])


def _block_pairs(block: pa.Table, percent: int, closest: bool) -> np.ndarray:
    """Pairs of an asking and an asked node of different components that may link, by their bitmaps.

    With ``closest`` an asking node names only one node of a component, the most similar by the bound.
    """
    bits = [np.frombuffer(b, np.uint64) for b in block.column("bits").to_pylist()]
    words = min(map(len, bits))
    bits = np.stack([_folded(b, words) for b in bits])
    node, root, n = (block.column(c).to_numpy() for c in ("node", "root", "n"))
    asks = block.column("asks").to_numpy()
    asked = np.flatnonzero(~asks)
    pairs = [np.zeros((0, 2), np.int64)]
    for one in np.flatnonzero(asks):
        others = asked[root[asked] != root[one]]
        differing = np.bitwise_count(bits[others] ^ bits[one]).sum(axis=1, dtype=np.int64)
        may = _may_link(n[one], n[others], differing, percent)
        others, differing = others[may], differing[may]
        if closest and len(others):
            order = np.argsort(differing / (n[one] + n[others]), kind="stable")
            others = others[order[np.unique(root[others[order]], return_index=True)[1]]]
        if len(others):
            pairs.append(np.stack([np.full(len(others), node[one]), node[others]], axis=1))
    return np.concatenate(pairs)


def _pairs_of_blocks(batches: Iterable[pa.RecordBatch], percent: int, closest: bool) -> Iterator[pa.RecordBatch]:
    """``_block_pairs`` of the blocks in a partition whose rows are sorted by block; one block is held at a time."""
    held: pa.Table | None = None
    for batch in (*batches, None):
        if batch is not None:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
        if held is None or not len(held):
            continue
        block = held.column("block").to_numpy()
        starts = np.append(0, np.flatnonzero(block[1:] != block[:-1]) + 1)
        ends = np.append(starts[1:], len(block))
        whole = len(starts) if batch is None else len(starts) - 1  # the last one may go on in the next batch
        found = [_block_pairs(held.slice(a, b - a), percent, closest) for a, b in zip(starts[:whole], ends[:whole], strict=True)]
        held = held.slice(starts[-1])
        if found:
            pairs = np.concatenate(found)
            yield _record([("a", pa.int64(), pairs[:, 0]), ("b", pa.int64(), pairs[:, 1])])


# -- the join --------------------------------------------------------------------------------


def _links(pairs: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link."""

    def side(name: str) -> DataFrame:
        return contents.select(F.col("node").alias(name), F.col("bits").alias(f"bits_{name}"), F.col("hashes").alias(f"hashes_{name}"))

    both = spread_join(spread_join(pairs, side("b"), "b"), side("a"), "a")
    return stored(both.mapInArrow(lambda batches: _linked_pairs(batches, percent), "a bigint, b bigint"), "links")


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members, with the ``root`` of their component, of tiles that hold several components."""
    placed = spread_join(members, found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stored(placed.select(*members.columns, "root"), "placed")
    split = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key")
    return stored(spread_join(placed, split, "key", "left_semi"), "open-members")


def _hub_pairs(open_: DataFrame) -> DataFrame:
    """(hub, node): the most central node of every tile, and those of its nodes that lie in another component."""
    hubs = open_.groupBy("key").agg(F.max(F.struct("renown", "node", "root")).alias("hub"))
    return spread_join(open_, hubs, "key").where("root != hub.root").select("hub", "node")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("hub.node", "node").alias("a"), F.greatest("hub.node", "node").alias("b")).distinct()


def _blocks(open_: DataFrame, contents: DataFrame, percent: int, closest: bool) -> DataFrame:
    """Pairs (a, b) of open tiles that may link: a asks, a node outside its tile's largest component, b is any other.

    Only nodes with ``asks`` do so, if there is such a column. A block has a tile, a part of those who ask and a part
    of those who are asked.
    """
    roots = open_.groupBy("key", "root").agg(F.count("*").alias("n"))
    sizes = roots.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("total"))
    sized = spread_join(open_, sizes, "key")
    sized = spread_join(sized, contents.select("node", "n", "bits"), "node")
    asking, asked = F.expr(f"CAST((total - most) DIV {ASKING} + 1 AS INT)"), F.expr(f"CAST(total DIV {ASKED} + 1 AS INT)")
    i, j = F.pmod(F.xxhash64("node", F.lit(1)), asking).cast("int"), F.pmod(F.xxhash64("node", F.lit(2)), asked).cast("int")
    columns = ("node", "root", "n", "bits")
    may_ask = F.col("root") != F.col("main")
    if "asks" in open_.columns:
        may_ask &= F.col("asks")
    ask = sized.where(may_ask).select(
        "key", i.alias("i"), F.explode(F.sequence(F.lit(0), asked - 1)).alias("j"), F.lit(True).alias("asks"), *columns
    )
    answer = sized.select("key", F.explode(F.sequence(F.lit(0), asking - 1)).alias("i"), j.alias("j"), F.lit(False).alias("asks"), *columns)
    rows = ask.unionByName(answer).withColumn("block", F.xxhash64("key", "i", "j"))
    rows = rows.repartition("block").sortWithinPartitions("block").select("block", "asks", *columns)
    return rows.mapInArrow(lambda batches: _pairs_of_blocks(batches, percent, closest), "a bigint, b bigint").distinct()


def ngram_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    ``component_id`` is the least doc_id reachable over links: pairs whose shingle sets share at least ``percent`` per
    cent of their union.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    signed = texts.mapInArrow(lambda b: _signed(b, percent), f"doc_id {kind}, n bigint, digest binary, keys array<bigint>")
    rows = stored(signed, "signed")

    # One node per distinct set; its number is fixed by being written.
    nodes = rows.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("lo"), F.any_value("keys").alias("keys"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    filed = nodes.select("node", F.explode("keys").alias("key"))
    shared = filed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n"))
    shared = stored(shared.where("lo != hi").select("key", "n"), "shared-tiles")
    members = stored(spread_join(filed, shared, "key"), "members")
    renown = members.groupBy("node").agg(F.sum("n").alias("renown"))
    members = stored(spread_join(members.drop("n"), renown, "node"), "members")

    wanted = stored(spread_join(nodes.drop("keys"), members.select("node").distinct(), "node", "left_semi"), "wanted")
    contents = _fetched(texts, wanted)
    first = _hub_pairs(members.withColumn("root", F.col("node"))).groupBy("node").agg(F.max("hub").alias("hub"))
    tried = stored(_ordered(first), "pairs")
    links = _links(tried, contents, percent)
    found = components(links)
    open_ = _open(members, found)
    if not open_.isEmpty():
        more = _links(stored(_ordered(_hub_pairs(open_)).join(tried, ["a", "b"], "left_anti"), "pairs"), contents, percent)
        if not more.isEmpty():
            links = links.unionByName(more)
            found = components(links)
            open_ = _open(members, found)
        nearest = stored(_blocks(open_, contents, percent, closest=True), "pairs")
        more = _links(nearest, contents, percent)
        failed = stored(nearest.join(more, ["a", "b"], "left_anti").select(F.col("a").alias("node")).distinct(), "asking-again")
        if not failed.isEmpty():
            found = components(links.unionByName(more))
            open_ = spread_join(_open(members, found), failed.withColumn("asks", F.lit(True)), "node", "left")
            rest = _blocks(open_.withColumn("asks", F.coalesce("asks", F.lit(False))), contents, percent, closest=False)
            more = stored(more.unionByName(_links(stored(rest, "pairs"), contents, percent)), "links")
        if not more.isEmpty():
            found = components(links.unionByName(more))

    placed = spread_join(nodes.select("digest", "node", "lo"), found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("lo").alias("component_id"))
    named = stored(spread_join(placed, least, "root").select("digest", "component_id"), "components-of-sets")
    joined = spread_join(rows.select("doc_id", "n", "digest"), named, "digest", "left")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _fetched(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Contents of the wanted nodes, made again from their texts; only keys are sent to where the texts are."""
    place = F.xxhash64("doc_id")  # also for a null; who meets by chance is told by the digest
    sought = wanted.select(F.xxhash64("lo").alias("place"), "node", "digest")
    found = lookup_join(texts.select(place.alias("place"), "text"), stored(sought, "sought"), "place")
    made = found.mapInArrow(_contents, "node bigint, n bigint, bits binary, hashes binary")
    once = made.groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("bits").alias("bits"), F.any_value("hashes").alias("hashes"))
    return stored(once, "contents")
