"""The inputs of all tables: three raw feeds, their load logs, and the seeds."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from inspect import signature

from pyspark.sql import DataFrame

from ringledger.window import Span

Provider = DataFrame | Callable[[], DataFrame]


class Inputs:
    """Named inputs, each a DataFrame or a function that makes one when first used.

    A function for a raw feed may take a ``span``; a run then reads the days it needs only.
    """

    def __init__(
        self,
        raw: Mapping[str, Provider],
        loads: Mapping[str, Provider],
        seeds: Mapping[str, Provider],
    ):
        self._providers = {"raw": raw, "loads": loads, "seeds": seeds}
        self._made: dict[tuple[str, str], DataFrame] = {}

    def _get(self, group: str, name: str) -> DataFrame:
        if (group, name) not in self._made:
            provider = self._providers[group][name]
            self._made[group, name] = provider if isinstance(provider, DataFrame) else provider()
        return self._made[group, name]

    def raw(self, dataset: str) -> DataFrame:
        return self._get("raw", dataset)

    def raw_days(self, dataset: str, span: Span) -> DataFrame:
        """The raw feed, read for the days of ``span`` only if its provider can do that."""
        provider = self._providers["raw"][dataset]
        takes_span = not isinstance(provider, DataFrame) and "span" in signature(provider).parameters
        return provider(span) if takes_span else self.raw(dataset)

    def loads(self, dataset: str) -> DataFrame:
        return self._get("loads", dataset)

    def seed(self, name: str) -> DataFrame:
        return self._get("seeds", name)

    @property
    def seed_names(self) -> list[str]:
        return list(self._providers["seeds"])
