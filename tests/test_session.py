"""The shared folder, and the package on its way to workers."""

import os
import subprocess
import sys

from tributary import session


def test_cleanup_deletes_what_was_materialized(spark):
    table = session.materialize(spark.range(5), "kept")
    folder = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert table.count() == 5 and os.path.isdir(folder)
    before = session._made.pop(spark.sparkContext.applicationId)
    session._made[spark.sparkContext.applicationId] = before[-1:]
    assert session.cleanup(spark) == 1 and not os.path.exists(folder) and session.cleanup(spark) == 0


def test_workers_find_the_package_from_elsewhere(tmp_path):
    """A Python operator runs although the driver starts outside the repository."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as entry\nfrom tributary.session import local_session\n"
        "print('rows', entry.queries()['throttle_sliding'](local_session(2, '1g'), '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 1000" in out.stdout, out.stderr[-800:]
