"""Python workers import the library even when the driver found it only
through ``sys.path`` (entry file loaded by path, another working directory)."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
ent = importlib.util.module_from_spec(spec)
spec.loader.exec_module(ent)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
qs = ent.queries()
print("copy", qs["file_copy"](spark, "/root/testdata/sf0.001").count())
print("udf", qs["udf_filter"](spark, "/root/testdata/sf0.001").count())
from sparkwright.functions.udfs import register_all
register_all(spark)
print("udtf", spark.sql("SELECT items FROM VALUES ('[1,2,3]') t(s), "
                        "LATERAL explode_json_array(s)").count())
"""


def test_workers_import_library_from_any_cwd():
    cwd = tempfile.mkdtemp(prefix="sw-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env,
                         capture_output=True, text=True, timeout=600)
    lines = {l.split()[0]: int(l.split()[1]) for l in out.stdout.splitlines()
             if l.split() and l.split()[0] in ("copy", "udf", "udtf")}
    assert lines.get("copy", 0) > 0 and lines.get("udf", 0) > 0 and lines.get("udtf") == 3, \
        out.stdout[-2000:] + out.stderr[-3000:]
