"""From bands of signatures to classes: which pairs to compare, and the components of those that are near."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringledger.llm.common import stored
from ringledger.llm.components import components, lookup_join, spread_join


#: Keys of a band that all others in it are compared with before the exact last step.
PIVOTS = 1


#: Within bands of at most so many keys a sift sees all pairs of different components, in the join that lists them.
SIFTED_BAND = 512
#: So many of them for each key of the band are compared at once.
PAIRS_A_KEY = 4


class Sift(NamedTuple):
    """What tells, without contents, that two keys are not near: a row of words a key, and a test of two rows.

    ``words`` has key and further columns; ``test`` names each of these with ``_a`` and ``_b`` behind it.
    """

    words: DataFrame
    test: Column


def linked(
    members: DataFrame | Sequence[DataFrame],
    fetch: Callable[[DataFrame], DataFrame],
    near: Callable[[DataFrame, DataFrame], DataFrame],
    parts: Callable[[DataFrame], DataFrame],
    against: Callable[[DataFrame, DataFrame], DataFrame],
    similarity: float,
    sift: Sift | None = None,
) -> DataFrame:
    """``node`` and ``root`` of every key that is near another one.

    ``members`` has key and band, or is several such tables without a band in common. A key stands for a multiset of parts, and two keys are near if the weight of the parts
    they share is at least ``similarity`` times that of their union. ``fetch`` gives the contents of keys, a row per
    key; ``near`` takes pairs (a, b) and contents, and returns the pairs that are near; ``parts`` takes contents and
    returns key, part, weight; ``against`` takes pairs (key, centre) and contents, and returns key, the ``shared``
    weight, and ``rest``, an array of (part, excess) with the parts of which the key has more than the centre. With a
    ``sift``, pairs that it does not let through are not compared.

    All pairs of a band would be quadratic in a group of copies. Instead, and always leaving out pairs already
    in one component:

    1. Every key is compared with the least and the greatest key of its bands. With a sift, so are the pairs that it lets
       through in bands of at most ``SIFTED_BAND`` keys, unless they are more than ``PAIRS_A_KEY`` times the band's keys.
    2. In bands that still hold several components, keys leave that cannot be near any other, as less than
       ``similarity`` of their weight occurs in any other key at all. The others are compared with the centre of
       their group, the key whose parts occur in most other keys, and then with ``PIVOTS`` keys of each band, every
       one the foremost of a component that has not had its turn in this band.
    3. Two keys of one group that have no part of their rests in common share at most what both share with the
       centre. So the pairs that are left are those for which that is enough, found within bands, and those that
       have a part of their rests in common, found by that part: one of the rarest, as a few would not be enough.

    No link within a band is lost, and in a group of copies hardly a pair is left for the last step.
    """
    shared = _shared(members) if isinstance(members, DataFrame) else reduce(DataFrame.unionByName, map(_shared_dealt, members))
    contents = stored(fetch(shared.select("key").distinct()), "contents")
    star = (
        shared.select(F.explode(F.array("least", "greatest")).alias("end"), "key")
        .where("end != key")
        .select(F.least("end", "key").alias("a"), F.greatest("end", "key").alias("b"))
        .distinct()
    )
    tried = stored(star, "star-pairs")
    edges = stored(near(_sifted(tried, sift), contents), "links")
    found = stored(components(edges), "components")

    open_ = _open(shared.select("band", "key"), found, compared=2)
    if sift is not None and not open_.isEmpty():
        pairs, dense = _within_bands(open_, sift)
        pairs = _new_pairs(pairs, tried)
        more = stored(near(pairs, contents), "links")
        edges, tried = edges.unionByName(more), tried.unionByName(pairs)
        found = stored(components(edges), "components")
        open_ = _open(lookup_join(open_.select("band", "key"), dense, "band"), found)
    if open_.isEmpty():
        return found
    open_ = _with_centres(open_, contents, parts, similarity)
    centred = open_.select("key", "root", "centre").distinct()
    placed = against(centred.select("key", "centre"), contents)
    placed = stored(centred.join(placed, "key"), "against-centres")
    to_centre = centred.join(centred.select(F.col("key").alias("centre"), F.col("root").alias("centre_root")), "centre")
    to_centre = _new_pairs(to_centre.where("root != centre_root").selectExpr("key AS key_a", "centre AS key_b"), tried)
    more = stored(near(_sifted(to_centre, sift), contents), "links")
    edges, tried = edges.unionByName(more), tried.unionByName(to_centre)
    found = stored(components(edges), "components")

    open_ = _open(open_.drop("root"), found)
    pivots = None
    for _ in range(PIVOTS):
        fresh = open_
        if pivots is not None:
            used = pivots.join(open_.select("band", F.col("key").alias("pivot"), "root"), ["band", "pivot"]).select("band", "root").distinct()
            fresh = open_.join(used, ["band", "root"], "left_anti")
        best = F.max_by(F.struct(F.col("key").alias("pivot"), F.col("root").alias("pivot_root")), F.struct("renown", "key"))
        now = stored(fresh.groupBy("band").agg(best.alias("best")).select("band", "best.*"), "pivots")
        to_pivot = open_.join(now, "band").where("root != pivot_root").selectExpr("key AS key_a", "pivot AS key_b")
        to_pivot = _new_pairs(to_pivot, tried)
        more = stored(near(_sifted(to_pivot, sift), contents), "links")
        edges, tried = edges.unionByName(more), tried.unionByName(to_pivot)
        pivots = now.select("band", "pivot") if pivots is None else pivots.unionByName(now.select("band", "pivot"))
        if not more.isEmpty():
            found = stored(components(edges), "components")
            open_ = _open(open_.drop("root"), found)

    open_ = stored(open_.drop("renown").join(placed.select("key", "shared"), "key"), "open-members")
    names = ("key", "root", "weight", "common", "centre", "shared")
    one = open_.select("band", *[F.col(c).alias(f"{c}_a") for c in names])
    two = open_.select("band", *[F.col(c).alias(f"{c}_b") for c in names])
    most = F.when(F.col("centre_a") == F.col("centre_b"), F.least("shared_a", "shared_b")).otherwise(F.least("common_a", "common_b"))
    enough = most * (1 + similarity) >= similarity * (F.col("weight_a") + F.col("weight_b")) - 1e-6
    apart = (F.col("root_a") != F.col("root_b")) & (F.col("key_a") < F.col("key_b"))
    within = one.join(two, "band").where(apart & enough).select("key_a", "key_b")

    roots = open_.select("key", "root", "weight").distinct()
    rest = placed.drop("root").join(roots, "key").selectExpr("centre", "key", "root", "weight", "shared", "inline(rest)")
    rest = stored(rest, "rests")
    # What a key must share of its rest with a near one that is no smaller, or with any near one. Of its parts, ordered
    # from rare to common, the last ones that carry less than this need not be looked at: who shares only those can't
    # be near.
    as_smaller = F.greatest(F.lit(1), F.ceil(2 * similarity / (1 + similarity) * F.col("weight") - F.col("shared") - 1e-6))
    as_larger = F.greatest(F.lit(1), F.ceil(similarity * F.col("weight") - F.col("shared") - 1e-6))
    rest = rest.withColumn("slot", F.struct("centre", "part"))
    often = rest.groupBy("slot").agg(F.count("*").alias("n"))
    rest = spread_join(rest, often, "slot").withColumn("carried", _carried()).where(F.col("carried") >= as_larger)
    names = ("key", "root", "weight", "shared", "carried")
    rest = stored(rest.select("centre", "part", "n", *names, (F.col("carried") >= as_smaller).alias("small")), "rare-rests")
    # Parts that the very same keys have show the same pairs, so the rarest of them, by the order above, is enough; keys
    # are told by two sums.
    holders = [F.count("*"), F.sum(F.xxhash64("key", "small").cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit(1), "key", "small"))]
    often = rest.groupBy("centre", "part").agg(
        F.min("n").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"), *[h.alias(f"holders_{k}") for k, h in enumerate(holders)]
    )
    often = often.where("lo != hi").groupBy("centre", *[f"holders_{k}" for k in range(3)]).agg(F.min_by("part", F.struct("n", "part")).alias("part"))
    rest = stored(rest.join(often.select("centre", "part"), ["centre", "part"]), "rests-to-compare")
    one = rest.where("small").select("centre", "part", *[F.col(c).alias(f"{c}_a") for c in names])
    two = rest.select("centre", "part", *[F.col(c).alias(f"{c}_b") for c in names])
    no_larger = (F.col("weight_a") < F.col("weight_b")) | ((F.col("weight_a") == F.col("weight_b")) & (F.col("key_a") < F.col("key_b")))
    alike = (F.col("root_a") != F.col("root_b")) & no_larger & (F.col("weight_a") >= similarity * F.col("weight_b") - 1e-6)
    # Seen from the rarest part that two keys share, they share no more than what either carries from there on.
    most = F.least("shared_a", "shared_b") + F.least("carried_a", "carried_b")
    enough = most * (1 + similarity) >= similarity * (F.col("weight_a") + F.col("weight_b")) - 1e-6
    by_rest = one.join(two, ["centre", "part"]).where(alike & enough).select("key_a", "key_b")

    last = _new_pairs(within.unionByName(by_rest), tried)
    more = stored(near(_sifted(last, sift), contents), "links")
    return found if more.isEmpty() else stored(components(edges.unionByName(more)), "components")


def _ends(members: DataFrame) -> DataFrame:
    return members.groupBy("band").agg(F.min("key").alias("least"), F.max("key").alias("greatest")).where("least != greatest")


def _shared(members: DataFrame) -> DataFrame:
    """The members of bands that have several keys, with the ``least`` and ``greatest`` of them."""
    return stored(lookup_join(members.select("band", "key"), stored(_ends(members), "band-ends"), "band"), "bands")


def _shared_dealt(members: DataFrame) -> DataFrame:
    """The same, for members that are far more than the memory of all tasks holds keys of: they are shuffled once.

    A band's ends are found where its members have been dealt to, and meet them there; most bands have but one.
    """
    dealt = members.select("band", "key").repartition("band")
    return stored(dealt.join(_ends(dealt).hint("shuffle_hash"), "band"), "bands")


def _carried() -> Column:
    """The excess of a key's part and of all its parts that are no rarer.

    Summed from the common end: Spark sums a frame that reaches to the last row anew for every row, which is quadratic.
    """
    return F.sum("excess").over(Window.partitionBy("key").orderBy(F.desc("n"), F.desc("part")).rowsBetween(Window.unboundedPreceding, 0))


def _sided(words: DataFrame, side: str) -> DataFrame:
    return words.select(*[F.col(c).alias(f"{c}_{side}") for c in words.columns])


def _sifted(pairs: DataFrame, sift: Sift | None) -> DataFrame:
    """The pairs (a, b) that the sift lets through."""
    if sift is None:
        return pairs
    one, two = (_sided(sift.words, side).withColumnRenamed(f"key_{side}", side) for side in "ab")
    return stored(pairs.join(one, "a").join(two, "b").where(sift.test).select("a", "b"), "sifted-pairs")


def _within_bands(open_: DataFrame, sift: Sift) -> tuple[DataFrame, DataFrame]:
    """Pairs (key_a, key_b) of different components that the sift lets through, and the bands that need more than that."""
    sizes = stored(open_.groupBy("band").agg(F.count("*").alias("n")), "band-sizes")
    few = lookup_join(open_, sizes.where(F.col("n") <= SIFTED_BAND).select("band"), "band")
    few = stored(few.join(sift.words, "key"), "band-words")
    one, two = (_sided(few, side).withColumnRenamed(f"band_{side}", "band") for side in "ab")
    # Both sides are dealt by the band alone: no band here is large.
    pairs = one.join(two, "band").where((F.col("key_a") < F.col("key_b")) & (F.col("root_a") != F.col("root_b")) & sift.test)
    pairs = stored(pairs.select("band", "key_a", "key_b"), "sifted-pairs")
    many = pairs.groupBy("band").agg(F.count("*").alias("pairs")).join(sizes, "band", "right")
    dense = many.where((F.col("n") > SIFTED_BAND) | (F.col("pairs") > PAIRS_A_KEY * F.col("n"))).select("band")
    dense = stored(dense, "dense-bands")
    return pairs.join(dense, "band", "left_anti").select("key_a", "key_b"), dense


def _new_pairs(pairs: DataFrame, before: DataFrame) -> DataFrame:
    each = pairs.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b")).distinct()
    return stored(each.join(before, ["a", "b"], "left_anti"), "pairs")


def _with_centres(open_: DataFrame, contents: DataFrame, parts: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """The members of open bands that can be near another one, with weight, ``common`` weight and ``centre``.

    The centre is the key of greatest renown, the mean number of keys that have its parts, among those that are
    connected over bands in a few steps; so the keys of a group nearly all have the same one.
    """
    kept = stored(contents.join(open_.select("key").distinct(), "key", "left_semi"), "open-contents")
    part = stored(parts(kept), "parts")
    often = part.groupBy("part").agg(F.count("*").alias("n")).where("n > 1")
    weights = (
        spread_join(part, often, "part", "left")
        .groupBy("key")
        .agg(
            F.sum("weight").alias("weight"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("weight")).otherwise(0)).alias("common"),
            (F.sum(F.col("weight") * F.coalesce("n", F.lit(1))) / F.sum("weight")).alias("renown"),
        )
        .where(F.col("common") >= similarity * F.col("weight") - 1e-6)
    )
    open_ = spread_join(open_, stored(weights, "weights"), "key")
    open_ = stored(open_.withColumn("best", F.struct("renown", F.col("key").alias("centre"))), "open-members")
    centres = open_.groupBy("key").agg(F.max("best").alias("best"))
    for _ in range(3):
        now = open_.select("band", "key").join(stored(centres, "centres"), "key")
        of_band = now.groupBy("band").agg(F.max("best").alias("best"))
        centres = spread_join(open_.select("band", "key"), of_band, "band").groupBy("key").agg(F.max("best").alias("best"))
    return stored(open_.drop("best").join(centres.select("key", "best.centre"), "key"), "centred")


def _open(members: DataFrame, found: DataFrame, compared: int = 1) -> DataFrame:
    """The members, with ``root``, of bands whose keys lie in different components.

    Bands of up to ``compared`` keys are not among them: of two keys that are all of a band, the ends have been compared.
    """
    known = found.select(F.col("node").alias("key"), "root")
    placed = stored(members.join(known, "key", "left").withColumn("root", F.coalesce("root", "key")), "placed")
    split = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"))
    split = stored(split.where((F.col("lo") != F.col("hi")) & (F.col("n") > compared)).select("band"), "split-bands")
    return stored(lookup_join(placed, split, "band"), "open-bands")
