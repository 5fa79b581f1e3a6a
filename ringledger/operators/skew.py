"""Joining facts to one value row per key when some keys hold very many facts.

A lookup made by grouping on the keys is already dealt by them, and Spark then neither moves it again for the join
nor may split a hot key's facts, as that would undo the grouping's layout. With one more join column, a hash of the
keys, both sides are dealt anew for the join alone, and AQE splits every partition of facts that is too big, for any
number of hot keys and without a list of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MIXED = "_mixed_keys"


def _mixed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # A small number is enough, and its bytes compress: the rows are dealt by the keys as well.
    return df.withColumn(_MIXED, F.pmod(F.hash(*keys), F.lit(16)))


def left_lookup(facts: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join ``facts`` to ``lookup``, which has one row per key. NULL keys match nothing."""
    return _mixed(facts, keys).join(_mixed(lookup, keys), [*keys, _MIXED], "left").drop(_MIXED)


def rows_of_keys(facts: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The facts whose key is in ``lookup``; NULL keys are equal to each other."""
    left, right = _mixed(facts, keys), _mixed(lookup.select(*keys), keys)

    def same(key: str) -> Column:
        return left[key].eqNullSafe(right[key])

    on = reduce(lambda a, b: a & b, map(same, keys), left[_MIXED] == right[_MIXED])
    return left.join(right, on, "left_semi").drop(_MIXED)
