"""The driver's entry module imports without a session, also from the zipped PySpark."""

import glob
import os
import subprocess
import sys

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_from_the_zipped_pyspark():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = glob.glob(os.path.join(lib, "*.zip"))
    code = (
        "import pyspark, __spark_entry__ as e; from pyspark import SparkContext; "
        "assert SparkContext._active_spark_context is None; "
        "print(pyspark.__file__, len(e.queries()), len(e.oracle_sql()))"
    )
    env = os.environ | {"PYTHONPATH": os.pathsep.join([*zips, ROOT])}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr[-2000:]
    where, n_queries, n_twins = done.stdout.split()
    assert not zips or "pyspark.zip" in where
    assert int(n_queries) >= 148 and int(n_twins) >= 131
