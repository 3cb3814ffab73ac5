"""The entry without its optional parts: a copy of the repository lacks them."""
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), set(o) <= set(q), any(k.startswith('op') or k == 'pipeline' for k in q))"


@pytest.mark.parametrize("gone", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_imports_without_training_data_operators(tmp_path, gone):
    shutil.copytree(os.path.join(ROOT, "clinloom"), tmp_path / "clinloom", ignore=shutil.ignore_patterns("__pycache__", *gone))
    for name in {"__spark_entry__.py", "corpus_pipeline.py"}.difference(gone):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, covered, training = out.stdout.split()
    assert int(n) >= 85 and covered == "True" and training == "False"
