"""Operators whose models travel to workers that cannot import the package."""

import os
import subprocess
import sys

from conftest import SF001

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from tabml.llm import decontaminate, language, linear, quality
from tabml.session import build_session

spark = build_session("local[2]", app="no-package", shuffle_partitions=2)

def importable(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("tabml") is not None])], names=["x"])

assert not spark.range(1).mapInArrow(importable, "x boolean").first().x, "the workers can import the package"
docs = spark.read.parquet("{data}/documents.parquet")
labels = spark.read.parquet("{data}/labels.parquet")
bench = spark.read.parquet("{data}/benchmark.parquet")
n = docs.count()
assert decontaminate.contamination(docs, bench).count() == n
assert quality.score(docs, quality.fit(docs, labels, F.lit(True)), ["doc_id"]).count() == n
assert language.predict(docs, language.fit(docs, F.lit(True)), ["doc_id"]).count() == n
print("whole")
"""


def test_models_travel_by_value(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = dict(os.environ)
    path = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.abspath(p) != repo]
    env["PYTHONPATH"] = os.pathsep.join(path)
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, data=SF001)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "whole" in done.stdout, done.stderr[-3000:]
