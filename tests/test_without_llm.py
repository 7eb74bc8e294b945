"""The library without its subpackage for training text."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]


def test_the_rest_works_alone(tmp_path):
    for name in ("__spark_entry__.py", "watchsieve"):
        at = ROOT / name
        if at.is_dir():
            shutil.copytree(at, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(at, tmp_path / name)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'x1_person_match' in q and set(s) <= set(q) and not any(n.startswith('op') or n == 'pipeline' for n in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ":".join(p for p in sys.path if p and Path(p).resolve() != ROOT)})
    assert not done.returncode, done.stderr
