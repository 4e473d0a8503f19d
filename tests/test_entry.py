"""The entry without its optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') or n == 'pipeline' for n in {**e.queries(), **e.oracle_sql()}))"


@pytest.mark.parametrize("gone", [("corposcope/llm",), ("corposcope/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_without_the_optional_parts(tmp_path, gone):
    left = [p for p in ("__spark_entry__.py", "corpus_pipeline.py", "corposcope") if p not in gone and (ROOT / p).exists()]
    for part in left:
        source, skipped = ROOT / part, ["__pycache__"] + [g.split("/")[1] for g in gone if "/" in g]
        if source.is_dir():
            shutil.copytree(source, tmp_path / part, ignore=shutil.ignore_patterns(*skipped))
        else:
            shutil.copy(source, tmp_path / part)
    found = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    count, extra = found.stdout.split()
    assert int(count) > 100
    if (ROOT / "corposcope/llm").exists():
        assert extra == str("corposcope/llm" not in gone)
