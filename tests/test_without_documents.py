"""The library without the operators on documents: a copy that lacks them imports and keeps all other queries."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_import_without_documents(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "*.json", ".pytest_cache", "spark-warehouse"))
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True, check=True).stdout.splitlines()
    queries, sql = (set(x.split()) for x in out[-2:])
    of_documents = {q for q in entry.queries() if q == "pipeline" or (q.startswith("op") and q[2].isdigit())}
    assert queries == set(entry.queries()) - of_documents and sql == set(entry.oracle_sql()) - of_documents
    used = subprocess.run(["grep", "-rlE", r"riskloom\.llm|corpus_pipeline", "riskloom", "tests", "tools", "bench.py"], cwd=copy, capture_output=True, text=True).stdout.split()
    assert set(used) <= {"tests/test_without_documents.py"}
