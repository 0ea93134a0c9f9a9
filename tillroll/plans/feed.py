"""Sales files to the event stream."""

import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.pos_mapping import map_sales_to_pos
from tillroll.sources.csv import first_sales_files, read_sales_csv
from tillroll.sources.events import send_events


@dataclass(frozen=True)
class Sent:
    """What was sent, how long that took, and the rows that could not be mapped."""

    rows: int
    seconds: float
    rejects: DataFrame

    @property
    def rows_per_second(self) -> float | None:
        return round(self.rows / self.seconds, 2) if self.seconds else None


def send_sales(
    spark: SparkSession,
    csv_path: str,
    limit: int | None = None,
    kind: str = "kafka",
    reading: Mapping[str, str] | None = None,
    **options: str,
) -> Sent:
    """Map sales files in file order and send the events; rows are counted while they go.

    All rows are sent unless `limit` says otherwise. It counts rows of the input; only the first
    files that hold so many are read and numbered. `reading` are options for the CSV reader.
    """
    started = time.perf_counter()
    reading = dict(reading or {})
    paths = csv_path if limit is None else first_sales_files(spark, csv_path, limit, **reading)
    rows = read_sales_csv(spark, paths, indexed=True, **reading)
    events, rejects = map_sales_to_pos(rows, limit=limit)
    counted = Observation("sent")
    send_events(events.observe(counted, F.count(F.lit(1)).alias("rows")), kind, **options)
    rows = counted.get["rows"]
    return Sent(rows, round(time.perf_counter() - started, 2), rejects)
