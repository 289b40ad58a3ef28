"""Queries on workers that lack this repository."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[1])
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")

def found(rows):
    import importlib.util
    yield from ([importlib.util.find_spec("tourney") is not None] for _ in rows)

assert spark.range(1).rdd.mapPartitions(found).collect() == [[False]]
import __spark_entry__ as registry
for name, query in registry.queries().items():
    if name.startswith("op") or name == "pipeline":
        assert query(spark, "/root/testdata/sf0.001").count() > 0, name
        print("ran", name)
"""


def test_functions_and_objects_travel_with_their_code(tmp_path):
    shared, elsewhere = tmp_path / "shared", tmp_path / "elsewhere"
    shared.mkdir()
    elsewhere.mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    kept = [p for p in os.environ.get("PYTHONPATH", "").split(":") if p and REPO not in {Path(p), *Path(p).parents}]
    env |= {"PYTHONPATH": ":".join(kept)} if kept else {}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(shared)],
        cwd=elsewhere, env=env, capture_output=True, text=True, timeout=600,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") == 14


def test_core_queries_stay_without_an_optional_package():
    """The package is there, but something that it needs is not."""
    script = (
        f"import sys; sys.path.insert(0, {str(REPO)!r}); sys.modules['zstandard'] = None\n"
        "import __spark_entry__ as r\n"
        "print(len(r.queries()), any(n.startswith('op') for n in r.queries()))"
    )
    done = subprocess.run(
        [sys.executable, "-c", script], capture_output=True, text=True, timeout=120
    )
    count, optional = done.stdout.split()
    assert int(count) >= 36 and optional == "False", done.stderr[-2000:]
