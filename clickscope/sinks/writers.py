"""Batch result sinks.

Both writers run on the executors, one writer task per partition; the
driver only plans. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def overwrite_table(df: DataFrame, table: str, database: str | None = None,
                    fmt: str | None = None, partition_by: list[str] | None = None,
                    path: str | None = None, cluster_by: list[str] | None = None,
                    files: int | None = None) -> str:
    """Replace a catalog table with ``df`` (drop-and-recreate semantics).

    Returns the qualified table name. Without ``path`` the table is managed
    (stored in the warehouse folder); with ``path`` its files go there.
    ``partition_by`` lays the table out by those columns (e.g. ``["date"]``
    for the visit-action table, so date filters prune folders).
    ``cluster_by`` deals the rows into ranges of those columns (``files`` of them, or by
    size) and sorts each, so that a bound on them skips the row groups of other ranges.
    """
    name = f"{database}.{table}" if database else table
    if cluster_by:
        df = (df.repartitionByRange(files, *cluster_by) if files else df.repartitionByRange(*cluster_by)).sortWithinPartitions(
            *(partition_by or []), *cluster_by)
    w = df.write.mode("overwrite")
    if fmt:
        w = w.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def append_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
                password: str | None = None, driver: str | None = None,
                batch_size: int = 1000, num_partitions: int | None = None,
                properties: dict[str, str] | None = None) -> None:
    """Append ``df`` to a JDBC table: one connection per partition, batched inserts.

    Columns are matched by name. ``num_partitions`` caps the number of
    concurrent connections the database sees (the frame is coalesced, no
    shuffle). The JDBC driver jar must be on the cluster classpath.
    """
    props = dict(properties or {})
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver is not None:
        props["driver"] = driver
    props.setdefault("batchsize", str(batch_size))
    if num_partitions:
        df = df.coalesce(num_partitions)
    df.write.jdbc(url, table, mode="append", properties=props)
