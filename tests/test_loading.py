"""The entry module works when loaded by file path from another folder,
after the session already exists (Python workers never import the package)."""

import subprocess
import sys
import tempfile
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

SCRIPT = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()
spark.sparkContext.setLogLevel('ERROR')
import importlib.util
spec = importlib.util.spec_from_file_location('entry_by_path', r'{REPO / "__spark_entry__.py"}')
e = importlib.util.module_from_spec(spec); spec.loader.exec_module(e)
print('ROWS', e.entry(spark).count())
print('CLEAN', e.queries()['clean'](spark, '/root/testdata/sf0.001').count())
"""


def test_entry_by_path_from_other_folder():
    cwd = tempfile.mkdtemp(prefix="threadlens-cwd-")   # a fresh, empty folder (kept)
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, capture_output=True,
                         text=True, timeout=600)
    lines = {ln.split()[0]: int(ln.split()[1]) for ln in out.stdout.splitlines()
             if ln.startswith(("ROWS", "CLEAN"))}
    assert lines.get("ROWS", 0) > 0 and lines.get("CLEAN", 0) > 0, out.stderr[-2000:]
