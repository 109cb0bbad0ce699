import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert all(map(callable, q.values())) and all(isinstance(x, str) for x in s.values()) and set(s) <= set(q); print(len(q), sum(n == 'pipeline' or n.startswith('op') and n[2].isdigit() for n in q))"


@pytest.mark.parametrize("gone", [[], ["leafmill/llm"], ["corpus_pipeline.py"], ["leafmill/llm", "corpus_pipeline.py"]])
def test_entry_with_and_without_the_optional_parts(tmp_path, gone):
    if not (ROOT / "leafmill/llm").is_dir() or not (ROOT / "corpus_pipeline.py").is_file():
        pytest.skip("the optional parts are absent already")
    for name in ("leafmill", "__spark_entry__.py", "corpus_pipeline.py"):
        copy = shutil.copytree if (ROOT / name).is_dir() else shutil.copy
        copy(ROOT / name, tmp_path / name)
    for name in gone:
        at = tmp_path / name
        shutil.rmtree(at) if at.is_dir() else at.unlink()
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    total, optional = map(int, out.stdout.split())
    assert total > 50 and optional == (11 if not gone else 10 if gone == ["corpus_pipeline.py"] else 0)
