"""Executor Python must find the package even when the job starts outside the repo folder
(as on a cluster): run the stemmer UDF and the facet numbering from a scratch folder."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import functions as F
from snapfacet.session import local_session
from snapfacet.operators import text_index as X
from snapfacet.operators import facets as FC
spark = local_session(cores=2, shuffle_partitions=2)
words = spark.createDataFrame([("running",), ("connections",)], "w string")
print(sorted(r[0] for r in words.select(X.porter_stem(F.col("w"))).collect()))
vals = spark.createDataFrame([("b",), ("a",)], "value string")
print([(r["value"], r["position"]) for r in FC.selected_first(vals, ["b"]).collect()])
"""


def test_executor_python_outside_repo():
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="snapfacet-cwd-"), capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.startswith("[")]
    assert lines == ["['connect', 'run']", "[('b', 1), ('a', 2)]"]
