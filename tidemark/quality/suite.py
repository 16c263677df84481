"""Run checks, record every result, and block on failed ERROR checks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.quality.checks import FAILED, Check, Tables, failing
from tidemark.schemas import QUALITY_RESULTS


# Outcomes in the result table; the id is day, name and eight hex digits.
PASS, FAIL, ERROR, SKIPPED = "pass", "fail", "error", "skipped"


class DataQualityError(RuntimeError):
    def __init__(self, names: Sequence[str], results: DataFrame):
        super().__init__(f"{len(names)} blocking check(s) did not pass: {', '.join(names)}")
        self.names = list(names)
        self.results = results


def select_checks(checks: Sequence[Check], names: Sequence[str] | None) -> list[Check]:
    """The named checks, or all; an unknown name is an error."""
    wanted = set(names or ())
    absent = wanted.difference(c.name for c in checks)
    if absent:
        raise ValueError(f"no check is called {sorted(absent)}")
    return [c for c in checks if not wanted or c.name in wanted]


def counts_frame(checks: Sequence[Check], tables: Tables) -> DataFrame:
    """(check_name, failed_row_count) of all checks as one query.

    Row checks of one table share a single scan.
    """
    parts = []
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        if check.predicate is not None:
            by_table.setdefault(check.target_table, []).append(check)
        else:
            parts.append(check.failures(tables).select(F.lit(check.name).alias("check_name"), FAILED))
    for table, group in by_table.items():
        one_row = tables[table].agg(*[failing(c.predicate()).alias(f"c{i}") for i, c in enumerate(group)])
        pairs = F.array(
            *[
                F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias(FAILED))
                for i, c in enumerate(group)
            ]
        )
        parts.append(one_row.select(F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts)


def _broken(check: Check, tables: Tables) -> str | None:
    """Why a check cannot be planned (a missing table or column, a wrong type); None if it can. Starts no job."""
    try:
        check.failures(tables)
    except (AnalysisException, KeyError) as problem:
        return str(problem)
    return None


def _count_all(checks: Sequence[Check], tables: Tables) -> dict[str, tuple[int, str | None]]:
    """Counts of all checks by one query over those that can be planned; what fails while it runs is raised."""
    problems = {check.name: _broken(check, tables) for check in checks}
    sound = [check for check in checks if problems[check.name] is None]
    counts = {row["check_name"]: row[FAILED] for row in counts_frame(sound, tables).collect()} if sound else {}
    return {name: (-1, why) if why is not None else (int(counts[name] or 0), None) for name, why in problems.items()}


def _result(check: Check, count: int, message: str | None, at: datetime, batch_id: str | None, day: date) -> dict:
    outcome = ERROR if count < 0 else FAIL if count else PASS
    return {
        "check_id": "_".join((day.isoformat(), check.name, uuid.uuid4().hex[:8])),
        "check_name": check.name,
        "status": outcome,
        "failed_row_count": count,
        "error_message": message,
        "severity": check.severity,
        "check_type": check.check_type,
        "target_dataset": check.target_dataset,
        "target_table": check.target_table,
        "batch_id": batch_id,
        "checked_at": at,
        "execution_date": day,
    }


def run(
    spark: SparkSession,
    checks: Sequence[Check],
    tables: Tables,
    batch_id: str | None = None,
    execution_date: date | None = None,
    checked_at: datetime | None = None,
    names: Sequence[str] | None = None,
    raise_on_failure: bool = True,
    skipped: Mapping[str, str] | None = None,
) -> DataFrame:
    """Result rows of every check; those in `skipped` (name to reason) are not evaluated. Raises `DataQualityError` after all have run.

    A WARN check never fails the suite; an ERROR check does if it fails or
    cannot be evaluated (count -1).
    """
    chosen = select_checks(checks, names)
    at = checked_at or datetime.now(timezone.utc)
    skipped = skipped or {}
    counts = _count_all([c for c in chosen if c.name not in skipped], tables)
    counts |= {c.name: (0, skipped[c.name]) for c in chosen if c.name in skipped}
    found = [_result(c, *counts[c.name], at, batch_id, execution_date or at.date()) for c in chosen]
    for result in found:
        if result["check_name"] in skipped:
            result["status"] = SKIPPED
    rows = [tuple(result[column] for column in QUALITY_RESULTS.names) for result in found]
    results = spark.createDataFrame(rows, QUALITY_RESULTS)
    blocking = [r["check_name"] for r in found if r["severity"] == "ERROR" and r["status"] not in (PASS, SKIPPED)]
    if blocking and raise_on_failure:
        raise DataQualityError(blocking, results)
    return results
