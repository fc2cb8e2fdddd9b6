"""The reports kept up to date: partial aggregates of each committed batch, merged when asked for.

A refresh reads the entries that the log of an ingest has got since the last one, aggregates the
purchases of their batches, and stores counts and sums in one commit that carries the version it
has come to. So a batch is scanned once, a refresh that fails adds nothing, and one that runs
again adds nothing twice. A compaction of the lines adds no purchases, whatever it rewrites.

Sums are exact decimals and counts are whole, so merged partials equal one pass over all lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions import exact_money, ip_to_long
from tillscope.operators import count_by
from tillscope.plans import reports
from tillscope.sinks.commits import CommitLog, commit_id, read_folders
from tillscope.sinks.files import layout_columns
from tillscope.sources.files import parse_purchases

#: Stored aggregates that are merged into one when there are more.
MOST_PARTS = 32

_COUNTS = "name STRING, category STRING, cnt BIGINT"
_SPENT = "ip STRING, spent DECIMAL(38,6)"


def _sum_spent(rows: DataFrame, spent) -> DataFrame:
    return rows.groupBy("ip").agg(F.sum(spent).cast("decimal(38,6)").alias("spent"))


@dataclass(frozen=True)
class KeptReports:
    """Aggregates in the folder `store`, of the purchases that one sink of an ingest holds."""

    spark: SparkSession
    store: str
    log: str
    sink: str
    layout: str = "dt"

    @property
    def _commits(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.store}/log")

    def _parts(self, kind: str, folders: list[str]) -> DataFrame:
        schema = _COUNTS if kind == "counts" else _SPENT
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.store}/{kind}/{f}" for f in folders])

    def _merged(self, folders: list[str]) -> tuple[DataFrame, DataFrame]:
        counts = self._parts("counts", folders).groupBy("name", "category").agg(F.sum("cnt").alias("cnt"))
        return counts, _sum_spent(self._parts("spent", folders), "spent")

    def _write(self, counts: DataFrame, spent: DataFrame, name: str) -> None:
        counts.write.parquet(f"{self.store}/counts/{name}")
        spent.write.parquet(f"{self.store}/spent/{name}")

    def refresh(self) -> int:
        """Take in what has been committed since; the number of batches.

        What a batch wrote is read here first, so lines may be vacuumed once they have been
        taken in, not before.
        """
        state = self._commits.state()
        after = state.batches.get(self.log, -1)
        entries = CommitLog(self.spark, self.log).entries(after)
        new = [entry for _, entry in entries if entry["batch"] is not None and entry["add"].get(self.sink)]
        if not new:
            return 0
        folders = [f for entry in new for f in entry["add"][self.sink]]
        lines = read_folders(self.spark, self.sink, folders, list(layout_columns(self.layout)))
        purchases = parse_purchases(lines.select("value")).select("name", "category", "price", "ip")
        purchases.persist(StorageLevel.MEMORY_AND_DISK)
        name = commit_id(entries[-1][0])
        try:
            self._write(count_by(purchases, "name", "category"), _sum_spent(purchases, exact_money("price")), name)
        finally:
            purchases.unpersist()
        if not self._commits.commit({"parts": [name]}, writer=self.log, batch=entries[-1][0]):
            return 0  # another refresh was faster, and has the same batches
        self._merge(self._commits.state().live["parts"])
        return len(new)

    def _merge(self, folders: list[str]) -> None:
        if len(folders) > MOST_PARTS:
            name = commit_id("merged")
            self._write(*self._merged(folders), name)
            self._commits.commit({"parts": [name]}, remove={"parts": folders})

    def aggregates(self) -> tuple[DataFrame, DataFrame]:
        """Counts by (name, category), and ip, ip_long and money spent, of all that was taken in."""
        counts, spent = self._merged(self._commits.state().live.get("parts", []))
        return counts, spent.withColumn("ip_long", ip_to_long("ip"))

    def top_categories(self, k: int | None = 10) -> DataFrame:
        counts, _ = self.aggregates()
        return reports.rank_categories(counts.groupBy("category").agg(F.sum("cnt").alias("cnt")), k)

    def top_products(self, k: int | None = 10) -> DataFrame:
        return reports.rank_products(self.aggregates()[0], k)

    def top_products_per_category(self, k: int = 10) -> DataFrame:
        return reports.rank_products_per_category(self.aggregates()[0], k)

    def top_ips(self, k: int | None = 10) -> DataFrame:
        return reports.rank_ips(self.aggregates()[1], k)
