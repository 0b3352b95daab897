"""Without the optional part the rest imports, lists its queries and runs."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
PROBE = "import __spark_entry__ as e, bench; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()))"


def test_without_the_optional_part(tmp_path):
    at = tmp_path / "repo"
    shutil.copytree(REPO, at, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache"))
    assert not (at / "granary" / "llm").exists() and not (at / "tests" / "llm").exists()
    for keep in (True, False):  # corpus_pipeline.py may stay behind or go too
        if not keep:
            (at / "corpus_pipeline.py").unlink(missing_ok=True)
        said = subprocess.run([sys.executable, "-c", PROBE], cwd=at, capture_output=True, text=True, timeout=120, check=False)
        assert said.returncode == 0, said.stderr
        n, m, any_op = said.stdout.split()
        assert int(n) == int(m) > 20 and any_op == "False"


def test_an_empty_folder_left_behind_is_not_the_optional_part(tmp_path):
    at = tmp_path / "repo"
    shutil.copytree(REPO, at, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache"))
    (at / "granary" / "llm" / "__pycache__").mkdir(parents=True)
    said = subprocess.run([sys.executable, "-c", PROBE], cwd=at, capture_output=True, text=True, timeout=120, check=False)
    assert said.returncode == 0 and said.stdout.split()[2] == "False", said.stderr
