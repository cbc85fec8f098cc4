"""A small registry of datasets: views, append flows, upserts and materialised tables, run in order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..sources.storage import ParquetTable
from .rules import Checked, Expectation, expect


@dataclass
class Dataset:
    name: str
    build: Callable[[Pipeline], DataFrame]
    kind: str  # view, table or upsert
    expectations: tuple[Expectation, ...] = ()
    partition: Sequence[str] = ()
    sort: Sequence[str] = ()
    keys: Sequence[str] = ()
    sequence: Callable | None = None


@dataclass
class Pipeline:
    """Datasets by name. Reading one inside another makes it run first; a cycle is an error.

    A view is not stored; a table is recomputed in full; an upsert keeps the winner of each key.  Flows
    that append to one target are united before it is built.
    """

    spark: SparkSession
    root: str
    datasets: dict[str, Dataset] = field(default_factory=dict)
    flows: dict[str, list[Callable[[Pipeline], DataFrame]]] = field(default_factory=dict)
    log: list[dict] = field(default_factory=list)
    _built: dict[str, DataFrame] = field(default_factory=dict)
    _open: list[str] = field(default_factory=list)

    def view(self, name: str, *expectations: Expectation):
        return self._declare(name, "view", expectations)

    def table(self, name: str, *expectations: Expectation, partition: Sequence[str] = (), sort: Sequence[str] = ()):
        return self._declare(name, "table", expectations, partition=partition, sort=sort)

    def upsert(self, name: str, keys: Sequence[str], sequence: Callable, *expectations: Expectation, partition: Sequence[str] = ()):
        return self._declare(name, "upsert", expectations, partition=partition, keys=keys, sequence=sequence)

    def append_flow(self, target: str):
        def add(f: Callable[[Pipeline], DataFrame]):
            self.flows.setdefault(target, []).append(f)
            return f

        return add

    def _declare(self, name: str, kind: str, expectations: tuple[Expectation, ...], **options):
        def add(f: Callable[[Pipeline], DataFrame]):
            if name in self.datasets:
                raise ValueError(f"{name} is declared twice")
            self.datasets[name] = Dataset(name, f, kind, expectations, **options)
            return f

        return add

    def read(self, name: str) -> DataFrame:
        """A dataset of this pipeline, built first if need be."""
        if name not in self._built:
            self._build(name)
        return self._built[name]

    def store(self, name: str) -> ParquetTable:
        d = self.datasets[name]
        return ParquetTable(self.spark, f"{self.root}/{name}", d.partition, d.sort)

    def _source(self, name: str) -> DataFrame:
        flows = self.flows.get(name)
        if not flows:
            return self.datasets[name].build(self)
        out = flows[0](self)
        for f in flows[1:]:
            out = out.unionByName(f(self))
        return out

    def _build(self, name: str) -> None:
        from ..operators.dedup import upsert_winner

        if name in self._open:
            raise ValueError("a cycle: " + " > ".join([*self._open, name]))
        if name not in self.datasets:
            raise KeyError(name)
        d = self.datasets[name]
        self._open.append(name)
        try:
            df = self._source(name)
            if d.kind == "upsert":
                df = upsert_winner(df, d.keys, d.sequence())
            checked: Checked | None = expect(df, name, *d.expectations) if d.expectations else None
            df = checked.df if checked else df
            if d.kind == "view":
                self._built[name] = df
                return
            # Written aside and checked; only then published under the dataset's name.
            aside = ParquetTable(self.spark, f"{self.root}/_staged/{name}", d.partition, d.sort)
            aside.replace(df) if d.partition else df.write.mode("overwrite").parquet(aside.path)
            if checked:
                self.log += checked.verify()
            final = self.store(name)
            staged = aside.read()
            final.replace(staged) if d.partition else staged.write.mode("overwrite").parquet(final.path)
            self._built[name] = final.read()
        finally:
            self._open.pop()

    def run(self, *names: str) -> dict[str, DataFrame]:
        """Builds the named datasets, or all; each run starts afresh."""
        self._built.clear()
        self.log.clear()
        return {n: self.read(n) for n in names or self.datasets}

    def expectation_log(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(x["dataset"], x["name"], x["kind"], x["passed_records"], x["failed_records"]) for x in self.log],
            "dataset string, name string, kind string, passed_records long, failed_records long",
        )
