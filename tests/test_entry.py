"""The entry module without the folders that are not part of the core."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NEEDED = ("__spark_entry__.py", "corpus_pipeline.py", "tastemill")


def _queries(folder):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def test_the_core_stands_alone(tmp_path):
    skip = shutil.ignore_patterns("llm", "__pycache__")
    for name in NEEDED:
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=skip)
        elif os.path.exists(source):
            shutil.copy(source, tmp_path / name)
    count, sql, pipeline = _queries(tmp_path)
    assert int(count) >= 211 and int(sql) >= 200 and pipeline == "False"
