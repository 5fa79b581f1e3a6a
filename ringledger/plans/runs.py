"""Building the tables: a full refresh, or one run window after another."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ringledger.operators.callbacks import CALLBACK_DAYS
from ringledger.operators.quality import Check, check_report
from ringledger.operators.upsert import UPDATED, WriteInfo, StoredTable
from ringledger.plans.checks import CHECKS
from ringledger.plans.models import BY_NAME, DAILY, WRITTEN, Model
from ringledger.schemas import DATASETS
from ringledger.sources.inputs import Inputs
from ringledger.streaming.ingest import EVENT_DAY
from ringledger.window import EVERYTHING, RunWindow, Span


#: A seed of more bytes than this in memory is never broadcast, however few its files have.
SENT_SEED = 10 << 20


class ChecksFailed(RuntimeError):
    """Some expectations on the tables just written do not hold."""

    def __init__(self, failures: list[Row]):
        self.failures = failures
        listed = "; ".join(f"{r['table_name']}: {r['check_name']} {r['subject']} ({r['failing_rows']})" for r in failures)
        super().__init__(f"{len(failures)} checks failed: {listed}")


class StoredTables:
    """Reads raw inputs and stored tables, and writes the latter in dependency order.

    Seeds are stored too, in the layer ``ref``, when they are first read; ``store_seeds`` brings in new ones.
    """

    stores = True

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        inputs: Inputs,
        layers: Mapping[str, str] | None = None,
        callback_days: int = CALLBACK_DAYS,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.inputs = inputs
        self.callback_days = callback_days
        # A layer that is not listed is stored under its own name.
        self._folders = layers or {}
        self._seeds: dict[str, DataFrame] = {}
        self._lock = Lock()
        self._stored = {
            m.name: StoredTable(
                spark, f"{self._layer(m.layer)}/{m.name}", m.keys, m.day, version=m.version, hidden=m.hidden
            )
            for m in WRITTEN
        }

    def _layer(self, layer: str) -> str:
        return f"{self.root}/{self._folders.get(layer, layer)}"

    def stored(self, name: str) -> StoredTable:
        return self._stored[name]

    # -- Reader ----------------------------------------------------------------

    def raw(self, dataset: str, span: Span = EVERYTHING) -> DataFrame:
        rows = self.inputs.raw_days(dataset, span)
        # Ingested tables are partitioned by event day; pruning needs that column.
        for column in (DATASETS[dataset].event_ts, EVENT_DAY):
            if column in rows.columns:
                rows = span.keep(rows, column)
        return rows

    def loads(self, dataset: str) -> DataFrame:
        return self.inputs.loads(dataset)

    def seed(self, name: str) -> DataFrame:
        with self._lock:  # tables are written side by side
            if name not in self._seeds:
                self.store_seeds([name])
            return self._seeds[name]

    def store_seeds(self, names: Iterable[str] | None = None) -> None:
        """Write seeds as they are now into the layer ``ref``, a folder per version, and read them from there.

        Spark would size a seed by its files, which hold a customer in a byte or two, and send millions of rows through the
        driver. So its rows are measured while they are written.
        """
        for name in self.inputs.seed_names if names is None else names:
            seed = self.inputs.seed(name)
            folder = f"{self._layer('ref')}/{name}/version={uuid.uuid4().hex[:12]}"
            seen = Observation()
            seed.observe(seen, _bytes_of_rows(seed).alias("bytes")).write.parquet(folder)
            stored = self.spark.read.schema(seed.schema).parquet(folder)
            self._seeds[name] = stored.hint("merge") if (seen.get["bytes"] or 0) > SENT_SEED else stored

    def table(self, name: str, span: Span = EVERYTHING) -> DataFrame:
        return self.stored(name).read(span).drop(UPDATED)

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    # -- writing ---------------------------------------------------------------

    def _each(self, only: Iterable[str] | None, write: Callable[[Model], WriteInfo]) -> list[WriteInfo]:
        """Write the wanted tables, each as soon as those it is computed from are written.

        Small tables would otherwise leave most of a cluster idle in turn.
        """
        wanted = [model for model in WRITTEN if only is None or model.name in set(only)]
        done: dict[str, Future[WriteInfo]] = {}

        def after(parents: list[Future[WriteInfo]], model: Model) -> WriteInfo:
            for parent in parents:
                parent.result()
            return write(model)

        with ThreadPoolExecutor(max(len(wanted), 1)) as pool:
            for model in wanted:
                parents = [done[name] for name in PARENTS[model.name] if name in done]
                done[model.name] = pool.submit(after, parents, model)
        return [future.result() for future in done.values()]

    def _window(self, window: RunWindow) -> RunWindow:
        if window.callback_days != self.callback_days:
            raise ValueError(f"the tables have callbacks within {self.callback_days} days, the window {window.callback_days}")
        return window

    def refresh(self, only: Iterable[str] | None = None, checks: str = "skip") -> list[WriteInfo]:
        """Recompute tables from everything there is."""
        done = self._each(only, lambda m: self.stored(m.name).replace(m.build(self, EVERYTHING, None)))
        self._checked(done, checks)
        return done

    def run(self, window: RunWindow, only: Iterable[str] | None = None, checks: str = "skip") -> list[WriteInfo]:
        """Recompute what ``window`` may change, and what follows from records that moved to another day.

        A corrected record may leave a day far outside the window. The tables computed from that day are then
        recomputed for it too, each of them for the days on which one of its parents has changed in this run.
        ``checks`` says what to do with the expectations on the written tables: "skip" them, "report" failures as
        a warning, or "stop" with ``ChecksFailed``.
        """
        window = self._window(window)
        changed: dict[str, frozenset] = {}

        def write(model: Model) -> WriteInfo:
            dirty = frozenset().union(*(changed.get(parent, ()) for parent in PARENTS[model.name]))
            span, table = model.span(window, dirty), self.stored(model.name)
            rows = model.build(self, span, window)
            if model.replaces:
                info = table.replace_days(rows, model.replaces(span))
            elif model.whole_days and not window.narrow:
                info = table.replace_days(rows, span)
            elif model.gone and not window.narrow:
                info = table.upsert(rows, model.gone(self, span))
            else:
                info = table.upsert(rows)
            changed[model.name] = frozenset(info.days)
            return info

        done = self._each(only, write)
        self._checked(done, checks)
        return done

    def _checked(self, done: list[WriteInfo], checks: str) -> None:
        if checks == "skip":
            return
        written = {info.table for info in done}
        failing = self.check([c for c in CHECKS if c.table in written]).where("failing_rows > 0").collect()
        if failing and checks == "stop":
            raise ChecksFailed(failing)
        if failing:
            warnings.warn(str(ChecksFailed(failing)), stacklevel=3)

    def check(self, checks: Iterable[Check] = CHECKS) -> DataFrame:
        """The expectations on seeds and tables, counted over what is stored now."""
        seeds = self.inputs.seed_names
        return check_report(checks, lambda name: self.seed(name) if name in seeds else self[name])


def _bytes_of_rows(df: DataFrame) -> Column:
    """About how many bytes all rows have in memory: eight for each and each of its values, and the values as text."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    return F.sum(reduce(Column.__add__, texts, F.lit(8 * (1 + len(texts)))).cast("bigint"))


# What each table is computed from.
PARENTS: dict[str, tuple[str, ...]] = {
    "stg_calls": (),
    "stg_crm": (),
    "stg_surveys": (),
    "mart_calls": ("stg_calls",),
    "mart_crm": ("stg_crm",),
    "mart_surveys": ("stg_surveys",),
    "mart_crm_callbacks": ("mart_crm",),
    "mart_first_call_resolution": ("mart_crm",),
    "daily_agent_call_metrics_source": ("mart_calls",),
    "daily_agent_crm_metrics_source": ("mart_first_call_resolution",),
    "daily_agent_survey_metrics_source": ("mart_surveys",),
    "daily_agent_metrics": DAILY,
    "daily_agent_manager_metrics": DAILY,
    "monthly_parts": DAILY,
    "monthly_agent_metrics": ("monthly_parts",),
    "monthly_agent_manager_metrics": ("monthly_parts",),
    "monthly_manager_metrics": ("monthly_parts",),
}


def lineage(*names: str) -> list[str]:
    """The tables named and everything upstream of them."""
    needed: list[str] = []
    pending = list(names)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.append(name)
            pending += PARENTS[name]
    return needed
