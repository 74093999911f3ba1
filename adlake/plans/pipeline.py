"""Pipeline: bronze -> silver -> gold -> KPI -> report, lazily or through saved tables."""

from __future__ import annotations

from collections.abc import Container, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from adlake.operators.gold import DIMS, FACTS, GOLD_INPUTS, MONTH_KEY, build_gold, by_month
from adlake.operators.kpi import KPI_INPUTS, KPI_NAMES, kpi, metric_roas
from adlake.operators.layer import LazyLayer, prefetch
from adlake.operators.report import BEST_WORST, TRUNCATED_KPIS, report
from adlake.operators.silver import SILVER_INPUTS, build_silver
from adlake.operators.spec import SILVER_TABLES
from adlake.plans.catalog import OUTCOME_SCHEMA, create_database, save_tables
from adlake.session import ensure_checkpoint_dir
from adlake.sources.fixtures import BronzeFixtures

# KPI tables each report reads (all ten when absent).
REPORT_INPUTS = {
    "account_totals": ("kpi_1_summary",), "benchmark_bands": ("kpi_1_summary",),
    "zero_conversion": ("kpi_1_summary",), "by_status": ("kpi_1_summary",), "currency": ("kpi_1_summary",),
    "zero_conv_spend_share": ("kpi_1_summary",), "best_vs_worst": ("kpi_2_cpl_ranking",),
    "best_vs_worst_kpis": tuple(dict.fromkeys(k for k, *_ in BEST_WORST)),
    "truncated": ("kpi_7_adgroup_efficiency",),
    **{f"truncated_{k}": (k,) for k in TRUNCATED_KPIS},
}

MAX_CONCURRENT_JOBS = 8
REPORTS = ("account_totals", "truncated", *[f"truncated_{k}" for k in TRUNCATED_KPIS], "sample_flags", "benchmark_bands",
           "zero_conversion", "best_vs_worst", "best_vs_worst_kpis", "by_status", "currency", "zero_conv_spend_share",
           "markdown", "pack")


@dataclass
class Lakehouse:
    """All layers over one bronze mapping, each table built on first use.

    In-memory composition gives one optimizable plan per query (Catalyst
    prunes columns across layers); ``run`` below writes each layer instead.
    """

    bronze: Mapping[str, DataFrame]
    _silver: LazyLayer | None = field(default=None, init=False)
    _gold: LazyLayer | None = field(default=None, init=False)
    _kpis: LazyLayer | None = field(default=None, init=False)
    _saved_kpis: LazyLayer | None = field(default=None, init=False)

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> "Lakehouse":
        return cls(BronzeFixtures(spark, sf_dir))

    @property
    def silver(self) -> LazyLayer:
        if self._silver is None:
            self._silver = build_silver(self.bronze)
        return self._silver

    @property
    def gold(self) -> LazyLayer:
        if self._gold is None:
            self._gold = build_gold(self.silver)
        return self._gold

    @property
    def kpis(self) -> LazyLayer:
        if self._kpis is None:
            self._kpis = LazyLayer(self._build_kpi, KPI_NAMES)
        return self._kpis

    def _build_kpi(self, name: str) -> DataFrame:
        """Build one KPI plan; its gold (and their silver) inputs are built concurrently first."""
        inputs = KPI_INPUTS[name]
        prefetch(self.silver, sorted({s for g in inputs for s in GOLD_INPUTS[g] if s in self.silver}))
        prefetch(self.gold, list(inputs))
        return kpi(name, self.gold)

    @property
    def saved_kpis(self) -> LazyLayer:
        """KPI tables computed once and written to the shared checkpoint folder.

        The report layer reads each KPI table several times (counts, header,
        numbered rows); a reliable checkpoint cuts the lineage so that the KPI
        plan runs once and a lost executor re-reads files instead.
        """
        if self._saved_kpis is None:
            self._saved_kpis = LazyLayer(lambda n: self._checkpoint(self.kpis[n]), KPI_NAMES)
        return self._saved_kpis

    @staticmethod
    def _checkpoint(df: DataFrame) -> DataFrame:
        ensure_checkpoint_dir(df.sparkSession)  # the session's shared folder; set only if unset
        return df.checkpoint(eager=True)

    def roas(self) -> DataFrame:
        return metric_roas(self.silver, self.gold)

    def materialize_kpis(self, names: tuple[str, ...] = KPI_NAMES) -> None:
        """Build and checkpoint several KPI tables concurrently.

        Each KPI job is small (a few narrow stages); submitting them from a
        thread pool lets the scheduler run them side by side instead of
        leaving most task slots idle between sequential jobs, and overlaps the
        driver-side plan construction of the KPIs as well.
        """
        todo = [n for n in names if not dict.__contains__(self.saved_kpis, n)]
        if len(todo) <= 1:
            for n in todo:
                self.saved_kpis[n]
            return
        # create the layer objects here; each worker then builds its KPI plan
        # (shared tables are planned once, under per-table locks) and runs the
        # checkpoint job.  Only the KPI tables, aggregates all, are checkpointed.
        _ = (self.silver, self.gold, self.kpis)
        saved = self.saved_kpis
        with ThreadPoolExecutor(max_workers=min(MAX_CONCURRENT_JOBS, len(todo))) as pool:
            list(pool.map(lambda n: saved[n], todo))

    def report(self, name: str) -> DataFrame:
        self.materialize_kpis(REPORT_INPUTS.get(name, KPI_NAMES))
        return report(name, self.saved_kpis)


def _blocked(inputs: Iterable[str], have: Container[str], what: str, causes: Mapping[str, str | None]) -> tuple[str, str] | None:
    """Why a table cannot be built (class of cause, text), or None.  The class says whether something above it failed in this
    run (``failed_input``) or only was not there (``missing_input``)."""
    gone = [n for n in inputs if n not in have]
    if not gone:
        return None
    absent = all(causes.get(n) in (None, "missing_input") for n in gone)
    return "missing_input" if absent else "failed_input", f"needs {what} {', '.join(gone)}"


def run(spark: SparkSession, bronze: Mapping[str, DataFrame], silver_db: str = "adlake_silver",
        gold_db: str = "adlake_gold", analytics_db: str = "adlake_analytics", fmt: str = "parquet",
        partition_by: Mapping[str, list[str]] | None = None, facts_by_month: bool = False,
        reports: Sequence[str] = REPORTS) -> DataFrame:
    """Materialize every layer as tables; each layer reads the previous one's files.

    Writing a layer cuts the lineage (a lost executor re-reads files instead of
    recomputing from bronze).  A layer reads only tables that *this* run saved: a
    table whose input failed or is missing is ``skipped`` with the cause, and a
    table left by an earlier run is never used.  Every planned table has one outcome row
    (database, table, status, class of cause, error).  ``partition_by`` names partition columns by table;
    ``facts_by_month`` partitions the facts by the month of their date key, so that a period reads its own files only.
    """
    outcomes: list[tuple[str, str, str, str | None, str | None]] = []
    partition_by = dict(partition_by or {})

    def save(db: str, frames: Mapping[str, DataFrame], names: Sequence[str], why) -> tuple[dict[str, DataFrame], dict[str, str | None]]:
        create_database(spark, db)
        blocked = {n: cause for n in names if (cause := why(n)) is not None}
        got = save_tables(db, frames, names, blocked, fmt, partition_by)
        outcomes.extend((db, *o) for o in got)
        return {n: spark.table(f"{db}.{n}") for n, status, *_ in got if status == "ok"}, {n: cause for n, _, cause, _ in got}

    silver, causes = save(silver_db, build_silver(bronze), SILVER_TABLES, lambda n: _blocked(SILVER_INPUTS[n], bronze, "bronze", {}))
    stars = build_gold(silver)
    if facts_by_month:
        partition_by |= {n: [MONTH_KEY] for n in FACTS if n not in partition_by}
        stars = LazyLayer(lambda n, plain=stars: by_month(plain[n], n), [*DIMS, *FACTS])
    gold, below = save(gold_db, stars, [*DIMS, *FACTS], lambda n: _blocked(GOLD_INPUTS[n], silver, "silver", causes))
    kpis, below = save(analytics_db, LazyLayer(lambda n: kpi(n, gold), KPI_NAMES), KPI_NAMES, lambda n: _blocked(KPI_INPUTS[n], gold, "gold", below))
    errors = {t: f"{s}: {e}" for db, t, s, _, e in outcomes if db == analytics_db and s != "ok"}

    def build_report(table: str) -> DataFrame:
        return report(table.removeprefix("report_"), kpis, errors)

    def why_not(table: str) -> tuple[str, str] | None:
        name = table.removeprefix("report_")
        if name in ("pack", "markdown"):  # these say which KPI failed
            return None
        if name == "sample_flags":
            return None if kpis else _blocked(KPI_NAMES, kpis, "KPI", below)
        return _blocked(REPORT_INPUTS.get(name, KPI_NAMES), kpis, "KPI", below)

    tables = [f"report_{r}" for r in reports]
    save(analytics_db, LazyLayer(build_report, tables), tables, why_not)
    return spark.createDataFrame(outcomes, f"db string, {OUTCOME_SCHEMA}")
