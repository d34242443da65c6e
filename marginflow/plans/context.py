"""Workspace: the raw sources of one run plus memoised derived models.

Every model is built once per workspace, so a plan that uses a relation
twice references the same logical subtree and Spark reuses its exchanges.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from marginflow.operators.cleansing import CLEANSERS
from marginflow.sources import testdata
from marginflow.sources.readers import conform, read_raw
from marginflow.sources.sinks import Dealing, deal, materialize

# Dealings of a query that may go through exchanges (which take 2 to 4 times the disk of files).
MOST_EXCHANGES = 4


class Workspace:
    def __init__(self, spark: SparkSession, raw_builders: dict[str, Callable[[], DataFrame]],
                 state: Callable[[], tuple] = tuple):
        self.spark = spark
        self._raw_builders = raw_builders
        self._memo: dict[str, DataFrame] = {}
        self._seeded: dict[str, DataFrame] = {}
        self._state_of, self._state = state, state()
        # the operational tables that are seeded are bucketed by (client_id, report_date)
        self.co_located = False
        # how facts are dealt out to their lookups in bucketed tables, if they are
        self.dealing: Dealing | None = None
        # facts dealt out through exchanges so far, with the workspaces made from this one
        self._exchanged = [0]

    # -- construction -----------------------------------------------------
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, dealing: Dealing | None = None) -> "Workspace":
        t = testdata.TestTables(spark, sf_dir)
        builders = {name: (lambda n=name, fn=fn: conform(n, fn(t))) for name, fn in testdata.BUILDERS.items()}
        out = cls(spark, builders, t.state)
        out.dealing, t.deal = dealing, out.dealt
        return out

    @classmethod
    def from_sources(cls, spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> "Workspace":
        return cls(spark, {name: (lambda n=name, p=path: read_raw(spark, n, p, fmt))
                           for name, path in paths.items()})

    def fresh(self) -> "Workspace":
        """The same raw sources, nothing derived from them yet."""
        out = Workspace(self.spark, self._raw_builders, self._state_of)
        out.dealing, out._exchanged = self.dealing, self._exchanged
        return out

    def staged(self, models: dict[str, Callable[["Workspace"], DataFrame]]) -> "Workspace":
        """A workspace in which ``models`` (in this order, each from the ones
        before) are computed once and read from files of the shared folder:
        what uses one of them twice scans a table twice, not its inputs."""
        out = self.fresh()
        out._memo = {k: v for k, v in self._memo.items() if k.startswith(("raw:", "cl:"))}
        for name, model in models.items():
            rows = model(out)
            # dealt out by client before they were summed
            stored = out.dealt(rows, "client_id", name, keep=True, placed=True) if out.dealing else materialize(self.spark, rows, name)
            out._seeded["model:" + name] = out._memo["model:" + name] = stored
        return out

    def dealt(self, df: DataFrame, key: str, name: str, keep: bool = False, placed: bool = False) -> DataFrame:
        """``df``, dealt out by ``key`` if this workspace deals (the facts of a
        model then meet a lookup without a shuffle of their own); else as it is.
        ``keep``: it is read more than once.  ``placed``: it is dealt out by the key already."""
        if not self.dealing:
            return df
        if not (self.dealing.fits or keep or placed):
            self._exchanged[0] += 1
            keep = self._exchanged[0] > MOST_EXCHANGES
        return deal(self.spark, df, key, replace(self.dealing, keep=keep, placed=placed), name)

    @property
    def state(self) -> tuple:
        """(modification time, length) of the raw files when this workspace was made."""
        return self._state

    def stale(self) -> bool:
        """The raw files changed since this workspace was made."""
        return self._state_of() != self._state

    # -- access -----------------------------------------------------------
    def _get(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def raw(self, name: str) -> DataFrame:
        return self._get("raw:" + name, self._raw_builders[name])

    def cl(self, name: str) -> DataFrame:
        return self._get("cl:" + name, lambda: CLEANSERS[name](self.raw(name)))

    def model(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self._get("model:" + key, build)

    def stored(self, key: str) -> bool:
        """The relation was seeded (it is read from a table)."""
        return key in self._seeded

    def seed(self, key: str, df: DataFrame) -> None:
        """Replace a relation (e.g. by its materialised table).  Whatever may
        have been derived from the old one is built anew."""
        self._seeded[key] = df
        self._memo = {k: v for k, v in self._memo.items() if k.startswith("raw:")} | self._seeded
