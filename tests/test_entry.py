"""The driver's entry points with and without the optional subpackage."""

import os
import re
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(folder):
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, check=True)
    queries, oracles = (set(line.split()) for line in done.stdout.strip().split("\n")[-2:])
    assert oracles <= queries
    return queries


def test_queries_load_without_the_optional_parts(tmp_path):
    for left_out in ((), ("corpus_pipeline.py",), ("fleetpulse/llm", "tests/llm"), ("fleetpulse/llm", "corpus_pipeline.py")):
        copy = tmp_path / f"copy{len(list(tmp_path.iterdir()))}"
        hidden = {os.path.join(ROOT, x) for x in left_out}

        def skip(folder, entries):
            return [x for x in entries if os.path.join(folder, x) in hidden or x in (".git", "__pycache__", ".pytest_cache")]

        shutil.copytree(ROOT, copy, ignore=skip)
        found = names(copy)
        assert "daily_stats" in found
        llm = os.path.isdir(os.path.join(ROOT, "fleetpulse/llm")) and "fleetpulse/llm" not in left_out
        assert any(re.match(r"op\d+_", x) for x in found) == llm
        assert ("pipeline" in found) == (llm and os.path.exists(copy / "corpus_pipeline.py"))
