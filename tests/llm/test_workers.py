"""Workers need no copy of this package: queries run where it cannot be imported."""

import os
import subprocess
import sys

import __spark_entry__ as entry

CODE = """
import sys
sys.path.insert(0, {root!r})
from tidemark.session import get_spark
from tidemark.llm import queries
spark = get_spark("far", master="local[2]", shuffle_partitions=2, conf={{"spark.checkpoint.dir": {path!r}, "spark.sql.warehouse.dir": {path!r} + "/w"}})
for name in ("op8_top_k", "op11_hard_negatives", "op12_whitening", "op13_pii"):
    assert queries.RUNS[name](spark, {sf!r}).count() > 0, name
"""


def test_queries_run_without_the_package_on_workers(sf, tmp_path):
    code = CODE.format(root=os.path.dirname(entry.__file__), path=str(tmp_path / "shared"), sf=sf)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
