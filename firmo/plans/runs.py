"""One run of the layers: staging -> raw -> bronze -> marts (survey §3A).

Staging, raw and mart layers are written as tables into the shared checkpoint
folder, bronze stays a set of views, as in the reference's project layout.
Written tables also cut the lineage: a lost executor costs a re-read, not a
recomputation from the sources.  ``staged`` keeps one run per session and
source folder, so serving queries read the mart table instead of rebuilding it;
its raw and mart tables are written when a query first reads them, so that a
query over the staging tables does not wait for tables it never reads.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from firmo.params import DEFAULT, RunParams
from firmo.plans import layers as LY
from firmo.session import remove_path, scratch_path
from firmo.sources import adapter
from firmo.sources.sinks import materialize_layer


@dataclass
class Run:
    """The written staging tables of a run; each further table is written under
    ``root`` on first use, once."""
    stg_primary: DataFrame
    stg_secondary: DataFrame
    params: RunParams = DEFAULT
    root: str = ""
    _made: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _lock: threading.RLock = field(default_factory=threading.RLock, repr=False, compare=False)

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._lock:
            if name not in self._made:
                self._made[name] = materialize_layer(self.stg_primary.sparkSession, build(), "table", name, self.root)
            return self._made[name]

    @property
    def raw_dim(self) -> DataFrame:
        return self._table("raw_dim_companies", lambda: self.layers().raw_dim)

    @property
    def raw_fct(self) -> DataFrame:
        return self._table("raw_fct_company_metrics", lambda: self.layers().raw_fct)

    @property
    def mart(self) -> DataFrame:
        return self._table("unified_companies",
                           lambda: LY.unified_companies(self.bronze_dim, self.bronze_fct, self.params))

    @property
    def bronze_dim(self) -> DataFrame:
        return LY.bronze_dim_companies(self.raw_dim, self.params)

    @property
    def bronze_fct(self) -> DataFrame:
        return LY.bronze_fct_company_metrics(self.raw_fct, self.params)

    @property
    def founders(self) -> DataFrame:
        return LY.bronze_dim_founder(self.stg_primary, self.stg_secondary, self.params)

    def build(self) -> Run:
        """Write all tables that are not written yet."""
        for _ in (self.raw_dim, self.raw_fct, self.mart):
            pass
        return self

    def layers(self) -> LY.Layers:
        """Lazy layers over the staging tables (to rebuild raw/mart from staging)."""
        return LY.Layers(self.stg_primary, self.stg_secondary, self.params)


def load_staging(spark: SparkSession, sf_dir: str, root: str | None = None, p: RunParams = DEFAULT) -> Run:
    """Write the staging tables from the given tables."""
    root = root or scratch_path(spark, "run")
    stg_p = materialize_layer(spark, adapter.stg_primary(spark, sf_dir), "table", "stg_primary", root)
    stg_s = materialize_layer(spark, adapter.stg_secondary(spark, sf_dir), "table", "stg_secondary", root)
    return Run(stg_p, stg_s, p, root)


def build_layers(spark: SparkSession, sf_dir: str, root: str | None = None, p: RunParams = DEFAULT) -> Run:
    """Load staging from the given tables, build and write raw and mart tables."""
    return load_staging(spark, sf_dir, root, p).build()


SOURCES = ("customer", "nation", "orders", "supplier")
_RUNS: dict[tuple, tuple[tuple, Run]] = {}
_LOCK = threading.Lock()


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Times and sizes of the source tables: a run is good as long as they hold."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for t in SOURCES:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        fs = p.getFileSystem(conf)
        out.append((fs.getFileStatus(p).getModificationTime(), fs.getContentSummary(p).getLength()))
    return tuple(out)


def staged(spark: SparkSession, sf_dir: str, p: RunParams = DEFAULT) -> Run:
    """The run of this session for ``sf_dir``: staging is written on first use, and again (the old
    tables removed) when a source table has changed."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), p)
    now = _state(spark, sf_dir)
    with _LOCK:
        state, run = _RUNS.get(key, (None, None))
        if run is None or state != now:
            old, run = run, load_staging(spark, sf_dir, p=p)
            _RUNS[key] = (now, run)
            if old is not None:
                remove_path(spark, old.root)
    return run
