"""The sixteen tables: how each is computed, keyed and partitioned.

A model reads its inputs through a ``Reader`` and gets the days to compute, and the
window of the run or ``None``. The same definition thus serves a lazy plan over the
raw data (``LazyTables``) and a run over stored tables (``plans.runs``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from typing import Protocol

from pyspark.sql import DataFrame

from ringledger.operators import scorecard as cards
from ringledger.operators.callbacks import CALLBACK_DAYS, callback_pairs, repeat_flags
from ringledger.operators.enrich import enrich_calls, enrich_surveys, enrich_tickets
from ringledger.operators.latest import LOADED, latest_version, version_columns
from ringledger.operators.resolution import resolved_unless_flagged
from ringledger.schemas import DATASETS
from ringledger.sources.inputs import Inputs
from ringledger.window import EVERYTHING, RunWindow, Span, days_of_month


class Reader(Protocol):
    # The callback period of everything that is computed without a window.
    callback_days: int
    # Whether tables are stored, so that one may be computed from what it was before.
    stores: bool

    def raw(self, dataset: str, span: Span) -> DataFrame: ...

    def loads(self, dataset: str) -> DataFrame: ...

    def seed(self, name: str) -> DataFrame: ...

    def table(self, name: str, span: Span) -> DataFrame:
        """Rows of a model's table whose partition day lies in ``span``."""
        ...


Days = frozenset[date]
Build = Callable[[Reader, Span, RunWindow | None], DataFrame]


@dataclass(frozen=True)
class Model:
    """A table: how it is computed for a span of days, and which span a run recomputes.

    ``span`` gives the days for a window and for the days on which the tables it is computed from have just
    changed. If ``whole_days``, these days are computed completely and replace what was there; otherwise the rows
    are merged by key.
    """

    name: str
    layer: str
    keys: tuple[str, ...]
    day: str  # the column whose date partitions the table
    build: Build
    span: Callable[[RunWindow, Days], Span]
    whole_days: bool = True
    hidden: tuple[str, ...] = ()
    version: tuple[str, ...] = ()
    # Keys whose rows go before the merge, besides those that are computed anew.
    gone: Callable[[Reader, Span], DataFrame] | None = None
    # Where the days that are computed are not those that are replaced.
    replaces: Callable[[Span], Span] | None = None


def _window_days(window: RunWindow, changed: Days) -> Span:
    return window.days if window.narrow else window.days.and_days(changed)


def _revisable_days(window: RunWindow, changed: Days) -> Span:
    return window.revisable if window.narrow else window.revisable.and_days(changed)


def _scorecard_days(window: RunWindow, changed: Days) -> Span:
    return window.scorecard_days if window.narrow else window.scorecard_days.and_days(changed)


def _scorecard_months(window: RunWindow, changed: Days) -> Span:
    if window.narrow:
        return window.scorecard_months
    return window.scorecard_months.and_days(day for one in changed if one for day in days_of_month(one))


def _staging(dataset_name: str) -> Model:
    dataset = DATASETS[dataset_name]

    def build(source: Reader, span: Span, window: RunWindow | None) -> DataFrame:
        return latest_version(source.raw(dataset_name, span), source.loads(dataset_name), dataset, loaded=True)

    return Model(
        f"stg_{dataset_name}",
        "staging",
        (dataset.key,),
        dataset.event_ts,
        build,
        lambda window, changed: window.days,
        whole_days=False,
        hidden=LOADED,
        version=tuple(version_columns(dataset)),
    )


def _mart(staging: str, enrich: Callable[..., DataFrame]) -> Build:
    def build(source: Reader, span: Span, window: RunWindow | None) -> DataFrame:
        return enrich(source.table(staging, span), source.seed("agents"), source.seed("customers"))

    return build


def _tickets(operator: Callable[..., DataFrame]) -> Build:
    """What follows from the callbacks of the tickets in the span."""

    def build(source: Reader, span: Span, window: RunWindow | None) -> DataFrame:
        days = source.callback_days if window is None else window.callback_days
        callbacks = EVERYTHING if window is None else window.callbacks_of(span)
        return operator(source.table("mart_crm", callbacks), originals=span, callbacks=callbacks, callback_days=days)

    return build


def _resolved(tickets: DataFrame, **spans: Span) -> DataFrame:
    return resolved_unless_flagged(repeat_flags(tickets, **spans))


def _daily(mart: str, summarise: Callable[..., DataFrame]) -> Build:
    def build(source: Reader, span: Span, window: RunWindow | None) -> DataFrame:
        return summarise(source.table(mart, span), source.seed("agent_assignments"), source.seed("managers"))

    return build


DAILY = ("daily_agent_call_metrics_source", "daily_agent_crm_metrics_source", "daily_agent_survey_metrics_source")


def _scorecard(**shape: bool) -> Build:
    def build(source: Reader, span: Span, window: RunWindow | None) -> DataFrame:
        # A narrow run knows no other days than its own.
        if shape.get("monthly") and source.stores and not (window and window.narrow):
            levels = {name: value for name, value in shape.items() if name != "monthly"}
            return cards.monthly_scorecard(source.table("monthly_parts", span), **levels)
        return cards.scorecard(*[source.table(name, span) for name in DAILY], **shape)

    return build


def _card(name: str, keys: tuple[str, ...], **shape: bool) -> Model:
    monthly = shape.get("monthly", False)
    span = _scorecard_months if monthly else _scorecard_days
    return Model(name, "core", keys, keys[-1], _scorecard(**shape), span)


def _changed_days(window: RunWindow, changed: Days) -> Span:
    """Exactly the days on which the daily tables have changed in this run."""
    return Span(window.start, window.start).and_days(changed)


def _months_of(days: Span) -> Span:
    first = {day.replace(day=1) for day in days.listed_days()}
    return Span(days.start, days.start).and_days(first)


def _month_parts(source: Reader, span: Span, window: RunWindow | None) -> DataFrame:
    fresh = cards.month_parts(*[source.table(name, span) for name in DAILY])
    if window is None:
        return fresh
    try:
        stored = source.table("monthly_parts", _months_of(span))
    except LookupError:  # the first run
        return fresh
    return cards.with_days_replaced(stored, fresh, span)


def _survey_ids(source: Reader, span: Span) -> DataFrame:
    return source.table("stg_surveys", span).select("survey_id")


# In dependency order. Surveys are staged by the day of the answer and from the
# mart on by the day they were sent, which is the day they count for.
MODELS: tuple[Model, ...] = (
    _staging("calls"),
    _staging("crm"),
    _staging("surveys"),
    Model("mart_calls", "mart", ("call_id",), "start_ts", _mart("stg_calls", enrich_calls), _window_days),
    Model("mart_crm", "mart", ("crm_id",), "created_ts", _mart("stg_crm", enrich_tickets), _window_days),
    # Answers of one day belong to surveys of several, so these rows are found by key.
    Model(
        "mart_surveys",
        "mart",
        ("survey_id",),
        "sent_ts",
        _mart("stg_surveys", enrich_surveys),
        _window_days,
        whole_days=False,
        gone=_survey_ids,
    ),
    Model(
        "mart_crm_callbacks",
        "mart",
        ("original_crm_id", "callback_crm_id"),
        "original_created_ts",
        _tickets(callback_pairs),
        RunWindow.originals,
    ),
    Model("mart_first_call_resolution", "mart", ("crm_id",), "fcr_date", _tickets(_resolved), RunWindow.originals),
    Model(
        "daily_agent_call_metrics_source",
        "core",
        ("agent_id", "call_date"),
        "call_date",
        _daily("mart_calls", cards.daily_calls),
        _window_days,
    ),
    Model(
        "daily_agent_crm_metrics_source",
        "core",
        ("agent_id", "call_date"),
        "call_date",
        _daily("mart_first_call_resolution", cards.daily_resolution),
        _revisable_days,
    ),
    Model(
        "daily_agent_survey_metrics_source",
        "core",
        ("agent_id", "survey_date"),
        "survey_date",
        _daily("mart_surveys", cards.daily_surveys),
        _revisable_days,
    ),
    _card("daily_agent_metrics", ("agent_id", "call_date")),
    _card("daily_agent_manager_metrics", ("agent_id", "manager_id", "call_date"), by_manager=True),
    _card("monthly_agent_metrics", ("agent_id", "call_month"), monthly=True),
    _card("monthly_agent_manager_metrics", ("agent_id", "manager_id", "call_month"), by_manager=True, monthly=True),
    _card("monthly_manager_metrics", ("manager_id", "call_month"), by_agent=False, by_manager=True, monthly=True),
)

# Kept beside the sixteen tables, so that a run needs no more than the changed days of a month.
STATE = Model(
    "monthly_parts",
    "state",
    ("agent_id", "manager_id", "call_month"),
    "call_month",
    _month_parts,
    _changed_days,
    replaces=_months_of,
)
WRITTEN = (*MODELS[:-3], STATE, *MODELS[-3:])
BY_NAME = {model.name: model for model in WRITTEN}


class LazyTables:
    """Every table as one lazy plan over the inputs; nothing is stored."""

    stores = False

    def __init__(self, inputs: Inputs, callback_days: int = CALLBACK_DAYS):
        self.inputs = inputs
        self.callback_days = callback_days
        self._built: dict[str, DataFrame] = {}

    def raw(self, dataset: str, span: Span = EVERYTHING) -> DataFrame:
        return span.keep(self.inputs.raw(dataset), DATASETS[dataset].event_ts)

    def loads(self, dataset: str) -> DataFrame:
        return self.inputs.loads(dataset)

    def seed(self, name: str) -> DataFrame:
        return self.inputs.seed(name)

    def table(self, name: str, span: Span = EVERYTHING) -> DataFrame:
        if name not in self._built:
            model = BY_NAME[name]
            self._built[name] = model.build(self, EVERYTHING, None).drop(*model.hidden)
        return span.keep(self._built[name], BY_NAME[name].day)

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)
