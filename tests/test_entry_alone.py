"""The library without its optional document subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_optional_subpackage(tmp_path):
    shutil.copytree(f"{ROOT}/workpulse", tmp_path / "workpulse", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 39 and set(e.oracle_sql()) <= set(q); assert 'pipeline' not in q"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env, timeout=120)
