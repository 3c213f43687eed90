"""What a cluster needs: the package on the executors, and no folder of one machine."""

from __future__ import annotations

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from tastemill import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
from __spark_entry__ import queries
for name in ("I1_item_similarity_decay", "L1_max_inner_product", "K2_personal_rank"):
    print("ROWS", name, queries()[name](spark, {sf!r}).count())
"""


def test_workers_find_the_package_from_another_folder(sf, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT, sf=sf)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    rows = [line.split()[2] for line in run.stdout.splitlines() if line.startswith("ROWS")]
    assert len(rows) == 3 and all(int(r) > 0 for r in rows), run.stderr[-1500:]


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://host"])
def test_no_folder_of_one_machine_on_a_cluster(master):
    settings: dict[str, str] = {}
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default), set=settings.__setitem__)
    spark = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(spark)
    settings["spark.checkpoint.dir"] = "hdfs://shared"
    assert session.shared_dir(spark) == "hdfs://shared"
