"""Report tables kept up to date load by load, and what the registered queries read from them."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upcharts.operators.movement import delta_histogram
from upcharts.operators.windows import maintain_windows, read_windows
from upcharts.plans.warehouse import warehouse
from upcharts.session import fresh_path
from upcharts.sources import history as loads
from upcharts.sources import table


@dataclass(frozen=True)
class Maintained:
    """Where the history, the window results and the weekly delta histograms are stored."""

    history: str
    windows: str
    deltas: str

    def load(self, rows: DataFrame, load: str | None = None) -> list[date]:
        """Append new weeks and bring the other tables up to date; the debut weeks measured again.

        The weeks come from the load's own counts. Every step may be repeated after a crash.
        """
        spark = rows.sparkSession
        written = loads.append_history(rows, self.history, load=load)
        named = load if written is None else written.load
        loaded = [r["chart_date"] for r in table.load_counts(spark, self.history, named).collect()]
        return self.refresh(spark, loaded)

    def refresh(self, spark: SparkSession, loaded: list[date]) -> list[date]:
        history = loads.read_history(spark, self.history)
        span = F.col("chart_date").between(F.lit(min(loaded)), F.lit(max(loaded))) & F.col("chart_date").isin(loaded)
        table.write_load(delta_histogram(history.where(span)), self.deltas, replace=True, hide=loaded)
        return maintain_windows(history, self.windows, loaded, table.live_weeks(spark, self.history))

    def window_results(self, spark: SparkSession) -> DataFrame:
        return read_windows(spark, self.windows)

    def delta_histograms(self, spark: SparkSession) -> DataFrame:
        return table.read_live(spark, self.deltas, "chart_date date, genre string, value bigint, freq bigint")


def new_tables(spark: SparkSession) -> Maintained:
    return Maintained(*[fresh_path(spark, name) for name in ("kept_history", "kept_windows", "kept_deltas")])


_built: dict[tuple[str, str], Maintained] = {}


def maintained(spark: SparkSession, sf_dir: str, parts: int = 3) -> Maintained:
    """The tables of this application for ``sf_dir``, filled by ``parts`` loads on first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        history = warehouse(spark, sf_dir).history
        weeks = sorted(r[0] for r in history.select("chart_date").distinct().collect())
        tables = new_tables(spark)
        size = -(-len(weeks) // parts)
        for at in range(0, len(weeks), size):
            first, last = weeks[at], weeks[min(at + size, len(weeks)) - 1]
            tables.load(history.where(F.col("chart_date").between(F.lit(first), F.lit(last))))
        _built[key] = tables
    return _built[key]
