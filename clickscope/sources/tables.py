"""Table scans, the optional time-range filter and schema conformance."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickscope.schemas import VISIT_ACTION


def read_table(spark: SparkSession, name_or_path: str, database: str | None = None) -> DataFrame:
    """A catalog table (optionally in ``database``) or a Parquet path.

    Nothing is read here: column pruning and filters applied later by the
    caller are pushed into the scan by Catalyst.
    """
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    qualified = f"{database}.{name_or_path}" if database else name_or_path
    return spark.table(qualified)


def load_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared test table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def visits_in_range(visits: DataFrame, start: str | None = None, end: str | None = None,
                    date_col: str | None = None) -> DataFrame:
    """Keep actions with ``start <= action_time <= end``; a missing bound is skipped.

    The comparison is on text, as in the original jobs: a date-only ``end``
    such as ``'2019-12-31'`` excludes every action on that day after
    midnight, because ``'2019-12-31 08:00:00' > '2019-12-31'``.

    When the table is laid out with ``partitionBy(date_col)`` pass
    ``date_col``: the implied bounds on the day are added so the scan
    prunes partitions (Catalyst cannot derive them from ``action_time``).
    """
    cond: Column | None = None

    def _and(c: Column) -> None:
        nonlocal cond
        cond = c if cond is None else cond & c

    if start is not None:
        _and(F.col("action_time") >= F.lit(start))
        if date_col:
            _and(F.col(date_col) >= F.lit(start[:10]))
    if end is not None:
        _and(F.col("action_time") <= F.lit(end))
        if date_col:
            _and(F.col(date_col) <= F.lit(end[:10]))
    return visits if cond is None else visits.where(cond)


# Columns whose null makes a row undecodable as a visit action.
_REQUIRED = [f.name for f in VISIT_ACTION.fields if not f.nullable]


def conform_visits(visits: DataFrame, required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Cast the known columns to the visit-action schema.

    Returns ``(good, quarantine)``; quarantined rows keep their raw values. A row whose required column is null (or
    does not cast) goes to quarantine instead of silently failing a later
    predicate such as ``click_category_id != -1`` (null there is neither a
    click nor a non-click). Columns not in the schema are kept as they are.

    ``required`` names the columns to check (default: every non-nullable
    column of the schema). A query passes the columns it reads, e.g.
    :data:`clickscope.operators.category.REQUIRED`: a null in a column the
    query never reads cannot change its result, and checking it would force
    the scan to read that column, defeating column pruning.
    """
    present = set(visits.columns)
    cols = []
    for c in visits.columns:
        field = next((f for f in VISIT_ACTION.fields if f.name == c), None)
        cols.append(F.col(c).try_cast(field.dataType).alias(c) if field else F.col(c))
    required = [c for c in (required if required is not None else _REQUIRED) if c in present]
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).try_cast(VISIT_ACTION[c].dataType).isNull()
    return visits.where(~bad).select(*cols), visits.where(bad)
