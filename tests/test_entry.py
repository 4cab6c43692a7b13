"""The base queries register whatever the optional subpackage lacks."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def registered(block):
    code = f"import sys; sys.modules[{block!r}] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), sum(k.startswith('op') for k in q), 'pipeline' in q, len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
    return done.stdout.split()


def test_a_missing_library_takes_only_the_optional_queries():
    base, ops, pipeline, sql = registered("ahocorasick")
    assert int(base) >= 129 and (ops, pipeline) == ("0", "False") and int(sql) >= 129
    assert registered("corpus_pipeline")[2] == "False"
