"""The package on executors that do not have it."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
    import sys
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession
    from wayfare.cluster import ship
    from wayfare.functions.fixed import RATING_CODES

    def known(batches):
        # a worker finds the module in what was shipped: the driver's path is not its own
        import wayfare.functions.fixed as fixed
        assert ".zip" in fixed.__file__, fixed.__file__
        for batch in batches:
            yield batch.assign(code=[fixed.RATING_CODES[i] for i in batch["id"]])

    spark = (
        SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false")
        .config("spark.executor.memory", "512m").config("spark.driver.host", "127.0.0.1").getOrCreate()
    )
    ship(spark)
    rows = spark.range(5).mapInPandas(known, "id long, code string").collect()
    assert sorted(r.code for r in rows) == sorted(RATING_CODES)
    spark.stop()
    print("shipped")
"""


def test_queries_run_from_another_folder(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(textwrap.dedent(SCRIPT.format(root=ROOT)))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0 and "shipped" in done.stdout, done.stderr[-2000:]
