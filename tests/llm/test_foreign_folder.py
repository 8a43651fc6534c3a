import os
import subprocess
import sys
from pathlib import Path


ROOT = Path(__file__).resolve().parents[2]
CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {folder!r}).getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__
for name, f in __spark_entry__.queries().items():
    if name.startswith("op") or name == "pipeline":
        print("ROWS", name, f(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_workers_need_nothing_of_the_package(tmp_path):
    """Executors in another folder, with nothing of this package on their path, run every query."""
    home = os.environ | {"PYTHONPATH": os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p).resolve() != ROOT), "PYSPARK_PYTHON": sys.executable}
    said = subprocess.run([sys.executable, "-c", CODE.format(root=str(ROOT), folder=str(tmp_path / "shared"))], cwd=tmp_path, env=home, capture_output=True, text=True, timeout=900)
    rows = [line.split() for line in said.stdout.splitlines() if line.startswith("ROWS")]
    assert said.returncode == 0 and len(rows) == 11, said.stderr[-2000:]
    assert all(int(n) > 0 for _, name, n in rows if name != "op3_decontaminate")
