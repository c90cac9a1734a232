"""Executors need the installed libraries, but not this package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Workers start in a folder from which the package cannot be found; only the driver knows the way.
PROGRAM = f"""
import sys
from pyspark.sql import SparkSession

spark = (
    SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
    .config("spark.sql.session.timeZone", "UTC").getOrCreate()
)


def missing(batches):
    import importlib.util

    for batch in batches:
        assert importlib.util.find_spec("stayledger") is None
        yield batch


spark.range(4).mapInArrow(missing, "id long").collect()
sys.path.insert(0, {REPO!r})
import corpus_pipeline
from stayledger.llm import queries as llm

for name, query in {{**llm.queries(), **corpus_pipeline.queries()}}.items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("done", name, flush=True)
"""


def test_all_queries_run_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS")}
    run = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    done = [line.split()[1] for line in run.stdout.splitlines() if line.startswith("done ")]
    assert run.returncode == 0, f"after {done}: {run.stderr[-3000:]}"
    assert len(done) == 14
