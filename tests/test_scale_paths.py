"""Rules of the session and of the round trip."""

import os
import subprocess
import sys

from orderlens.plans.roundtrip import RoundTrip

from .conftest import ROOT, SF_SMALL

_SUBMITTED = """
import sys; sys.path.insert(0, {root!r})
from orderlens.session import build_session, checkpoint_dir
spark = build_session()
print("partitions", spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.master)
spark.stop()
"""


def test_a_submitted_setting_survives(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(_SUBMITTED.format(root=ROOT))
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.sql.shuffle.partitions=4000 "
                                               "--conf spark.ui.enabled=false pyspark-shell")
    from pyspark.find_spark_home import _find_spark_home

    submit = os.path.join(_find_spark_home(), "bin", "spark-submit")
    out = subprocess.run([submit, "--master", "local[2]", "--conf", "spark.sql.shuffle.partitions=4000",
                          "--conf", "spark.ui.enabled=false", str(script)],
                         env=env | {"PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable},
                         capture_output=True, text=True, timeout=180)
    assert "partitions 4000 local[2]" in out.stdout, out.stdout + out.stderr[-2000:]


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    from orderlens.session import checkpoint_dir

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_round_trip_is_built_once_and_closed(spark):
    trip = RoundTrip()
    first, again = trip(spark, SF_SMALL), trip(spark, SF_SMALL)
    assert first is again
    assert os.path.exists(first.out_dir.removeprefix("file:"))
    trip.close(spark)
    assert not os.path.exists(first.out_dir.removeprefix("file:"))
    assert trip(spark, SF_SMALL) is not first
    trip.close(spark)
