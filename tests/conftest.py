import os
import sys
import tempfile

# Small matrices: threads that wait for one another cost more than they save beside Spark's tasks.
for _name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
    os.environ.setdefault(_name, "1")

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from clickscope.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tests set their own shared folder; on a cluster it comes from the cluster.
    s = build_session("local[4]", app_name="clickscope-tests", shuffle_partitions=4,
                      extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="clickscope-test-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
