"""The code reaches Python workers from any folder, and the entry module stands without its optional parts."""

import os
import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[1]


def run(code, folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_python_workers_find_the_package_from_another_folder(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as entry
print("rows", len(entry.queries()["xml_record"](spark, "/root/testdata/sf0.001").collect()))
"""
    assert "rows" in run(code, tmp_path)


def test_entry_without_the_training_text_operators(tmp_path):
    shutil.copytree(ROOT / "flowops", tmp_path / "flowops", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES), set(e.oracle_sql()) == set(e.ORACLES))"
    assert run(code, tmp_path).strip() == "True True"
