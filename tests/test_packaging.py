"""Python workers get what they need when the package is installed or sent with --py-files."""

import os
import subprocess
import sys
import zipfile
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SCRIPT = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.addPyFile(sys.argv[1])
from tallyward.operators import enrich, search
rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "k INT, v ARRAY<DOUBLE>")
hits = search.similarity_topk(rows, "k", "v", rows.select(F.col("k").alias("q"), F.col("v").alias("qv")), "q", "qv", 1)
assert sorted((r.q, r.k) for r in hits.collect()) == [(1, 1), (2, 2)]
asked = enrich.ask_model(rows, F.col("k").cast("string"), enrich.offline_text, "answer")
assert [r.answer for r in asked.orderBy("k").collect()] == ["Answer to: 1", "Answer to: 2"]
print("done")
"""


def test_search_and_enrichment_from_another_folder(tmp_path):
    archive = tmp_path / "tallyward.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in (ROOT / "tallyward").rglob("*.py"):
            z.write(f, f.relative_to(ROOT))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    ran = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(archive)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert ran.stdout.strip().endswith("done"), ran.stderr[-2000:]
