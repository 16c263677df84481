"""Control tables: watermarks per source table, batch runs, and load audit."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import BATCH_RUNS, RAW_LOAD_RUNS, WATERMARKS
from tidemark.sources.store import TableStore

# Fixed value: watermark of a table that was never extracted.
FIRST_WATERMARK = datetime(1970, 1, 1)

WATERMARK_KEY = ["pipeline_name", "source_table"]
RUN_KEY = ["batch_id", "pipeline_name", "source_table"]


class ControlState:
    """A few rows per source table; each step is one small upsert for all tables."""

    def __init__(self, store: TableStore, pipeline_name: str = "daily_batch"):
        self.store = store
        self.pipeline_name = pipeline_name

    def _frame(self, rows: Iterable[Mapping], schema: T.StructType) -> DataFrame:
        """Rows given as mappings; times travel as text so the host time zone cannot shift them."""
        text = T.StructType(
            [
                T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
                for f in schema
            ]
        )

        def plain(value):
            return value.isoformat(sep=" ") if isinstance(value, datetime) else value

        tuples = [tuple(plain(row.get(f.name)) for f in schema) for row in rows]
        df = self.store.spark.createDataFrame(tuples, text)
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    def _rows(self, name: str, schema: T.StructType, batch_id: str | None = None) -> list[dict]:
        """Rows of the pipeline, of one batch where the table has one: one per source table."""
        if not self.store.exists(name):
            return []
        as_text = [
            F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in schema
        ]
        stamps = [f.name for f in schema if isinstance(f.dataType, T.TimestampType)]
        rows = []
        mine = self.store.read(name).where(F.col("pipeline_name") == self.pipeline_name)
        if batch_id is not None:
            mine = mine.where(F.col("batch_id") == batch_id)
        for row in mine.select(*as_text).collect():
            data = row.asDict()
            data.update({c: datetime.fromisoformat(data[c]) for c in stamps if data[c]})
            rows.append(data)
        return rows

    def watermark_rows(self) -> dict[str, dict]:
        return {row["source_table"]: row for row in self._rows("etl_watermarks", WATERMARKS)}

    def last_success(self, table: str, known: dict[str, dict] | None = None) -> datetime:
        known = self.watermark_rows() if known is None else known
        return known[table]["last_success_watermark"] if table in known else FIRST_WATERMARK

    def _update_watermarks(self, tables: Iterable[str], changes: Mapping[str, Mapping], now: datetime) -> None:
        known = self.watermark_rows()
        rows = []
        for table in tables:
            row = known.get(table) or {
                "pipeline_name": self.pipeline_name,
                "source_table": table,
                "last_success_watermark": FIRST_WATERMARK,
                "status": "not_started",
                "row_count": 0,
                "created_at": now,
            }
            rows.append({**row, **changes[table], "updated_at": now})
        self.store.merge("etl_watermarks", self._frame(rows, WATERMARKS), WATERMARK_KEY)

    def started(
        self, batch_id: str, extract_date: date, windows: Mapping[str, tuple[datetime, datetime]], now: datetime
    ) -> None:
        """Open the runs of a batch; a rerun of the same batch resets its rows."""
        runs = [
            {
                "batch_id": batch_id,
                "pipeline_name": self.pipeline_name,
                "source_table": table,
                "extract_date": extract_date,
                "last_success_watermark": lower,
                "current_run_watermark": upper,
                "row_count": 0,
                "status": "extract_running",
                "started_at": now,
            }
            for table, (lower, upper) in windows.items()
        ]
        self.store.merge("etl_batch_runs", self._frame(runs, BATCH_RUNS), RUN_KEY)
        changes = {
            table: {
                "current_run_watermark": upper,
                "last_run_at": now,
                "status": "extract_running",
                "row_count": 0,
                "error_message": None,
            }
            for table, (_, upper) in windows.items()
        }
        self._update_watermarks(windows, changes, now)

    def finished(
        self,
        batch_id: str,
        results: Mapping[str, Mapping],
        now: datetime,
    ) -> None:
        """Record `uri`, `row_count`, `status` and `error_message` of each table's extract."""
        open_runs = {
            row["source_table"]: row
            for row in self._rows("etl_batch_runs", BATCH_RUNS, batch_id)
            if row["source_table"] in results
        }
        runs = [{**open_runs[t], "error_message": None, **results[t], "finished_at": now} for t in results]
        self.store.merge("etl_batch_runs", self._frame(runs, BATCH_RUNS), RUN_KEY)
        changes = {
            t: {"error_message": None, **{k: v for k, v in r.items() if k != "uri"}} for t, r in results.items()
        }
        self._update_watermarks(results, changes, now)

    def advance(
        self, mode: str, upper: datetime, row_counts: Mapping[str, int], now: datetime, status: str = "success"
    ) -> bool:
        """Move the watermark after everything passed; `preserve` leaves it alone."""
        if mode not in ("advance", "preserve"):
            raise ValueError(f"unknown watermark mode {mode}")
        if mode == "preserve":
            return False
        changes = {
            table: {
                "last_success_watermark": upper,
                "current_run_watermark": upper,
                "last_run_at": now,
                "status": status,
                "row_count": count,
                "error_message": None,
            }
            for table, count in row_counts.items()
        }
        self._update_watermarks(row_counts, changes, now)
        return True

    def audit_load(self, rows: Iterable[Mapping]) -> None:
        self.store.append("raw_load_runs", self._frame(rows, RAW_LOAD_RUNS))


