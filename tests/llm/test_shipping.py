"""Queries on executors that do not have the package: a session started from an empty folder."""

from __future__ import annotations

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import os, sys
sys.path.insert(0, {repo!r})  # of the driver alone
from feedlens.session import build_session
from pyspark.sql import functions as F
spark = build_session("shipping", "local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
                      "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": {shared!r}}})
spark.sparkContext.setLogLevel("ERROR")

@F.udf("boolean")
def has_package(_):
    import importlib.util
    return importlib.util.find_spec("feedlens") is not None

assert not spark.range(4).select(has_package("id").alias("x")).where("x").count(), "the workers see the package"
from feedlens.llm.queries import QUERIES
from feedlens.plans.catalog import QUERIES as OTHERS
for name, query in {{**QUERIES, "translate_udf": OTHERS["translate_udf"], "scan_search_queries": OTHERS["scan_search_queries"]}}.items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


def test_queries_run_where_the_package_is_not_installed(tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO, shared=str(tmp_path / "shared"))],
        cwd=empty, env=env, capture_output=True, text=True, timeout=1500,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    ran = [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")]
    assert {"pipeline", "op2_lattice_likelihood", "op10_pack_bin_slack", "op13_vector_codes", "translate_udf"} <= set(ran)
