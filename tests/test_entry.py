"""What the entry module takes in: the optional subpackage, if it is there."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def copied(tmp_path, **options):
    for name in ("tallywire", "registry"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, **options)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    return tmp_path


def run(folder):
    return subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": str(folder)})


def test_without_the_subpackage_the_other_queries_are_there(tmp_path):
    done = run(copied(tmp_path, ignore=shutil.ignore_patterns("llm", "__pycache__")))
    assert done.returncode == 0, done.stderr[-1000:]
    n_queries, n_sql = map(int, done.stdout.split())
    assert n_queries == n_sql > 60
    # A folder that an interpreter left behind is no package.
    (tmp_path / "tallywire" / "llm" / "__pycache__").mkdir(parents=True)
    assert run(tmp_path).returncode == 0


def test_a_broken_import_is_not_taken_for_absence(tmp_path):
    folder = copied(tmp_path, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (folder / "tallywire" / "llm").mkdir()
    (folder / "tallywire" / "llm" / "__init__.py").write_text("")
    (folder / "tallywire" / "llm" / "queries.py").write_text("import no_such_module\n")
    done = run(folder)
    assert done.returncode != 0 and "no_such_module" in done.stderr
