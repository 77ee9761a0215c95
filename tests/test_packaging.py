"""Queries run from any working directory, their Python workers included."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry", "{repo}/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", entry.queries()["e21_correlation_pvalues"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_a_query_with_python_workers_runs_elsewhere(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]


def test_checkpoint_folder_must_be_named_on_a_cluster():
    from quarry.session import ensure_checkpoint_dir

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

        def getConf(self):  # noqa: N802
            return {}

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()  # noqa: N815

    try:
        ensure_checkpoint_dir(Session())
    except ValueError as e:
        assert "spark.checkpoint.dir" in str(e)
    else:
        raise AssertionError("a machine-local folder was used on a cluster")
