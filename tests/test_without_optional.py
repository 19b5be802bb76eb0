"""The library without its optional subpackage, and run from a folder of its own."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_optional_folders(tmp_path):
    shutil.copytree(f"{ROOT}/ledgerloom", tmp_path / "ledgerloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), any(n.startswith('op1') for n in q))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    count, optional = said.stdout.split()
    assert int(count) >= 120 and optional == "False"
