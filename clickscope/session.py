"""SparkSession construction and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package expects. AQE coalesces the tiny
# post-aggregation shuffles and splits skewed join partitions at run time,
# also where the split needs one more (partially aggregated) shuffle after
# the join, as in the admitted-clicks count.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "clickscope",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster leave ``master`` unset and let spark-submit decide; the
    cluster's own ``spark.checkpoint.dir`` is kept.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


# Fallback shared folder per application, used only when the session names none.
_LOCAL_SHARED: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set to a folder every executor can reach; a
    machine-local one would lose results, so it is an error if it is not.
    Only under a local master one folder per application is created. It is
    remembered here rather than written into the session, because Spark
    refuses runtime changes of that core setting. It is also set as the
    context's RDD checkpoint folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        path = _LOCAL_SHARED.get(app)
        if path is None:
            path = _LOCAL_SHARED.setdefault(app, tempfile.mkdtemp(prefix="clickscope-"))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(path, "rdd"))
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared folder for one run's output."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
