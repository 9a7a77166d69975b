"""Session helpers: shared scratch folder, fixed row layouts."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from rowcast.runtime import Layout, checkpoint_root, clear_scratch, discard, laid_out, scratch_path


def test_checkpoint_root_reads_the_session_setting(spark):
    root = checkpoint_root(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")
    assert root.removeprefix("file:").startswith(configured.removeprefix("file:"))
    assert spark.sparkContext.getCheckpointDir() is not None
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)


UNSET_SCRIPT = r"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
sc = spark.sparkContext
assert sc.getConf().get("spark.checkpoint.dir", None) is None
assert sc.getCheckpointDir() is None
from rowcast.runtime import checkpoint_root, scratch_path
root = checkpoint_root(spark)
assert sc.getCheckpointDir() is not None and scratch_path(spark, "x").startswith(root)
import __spark_entry__ as E
assert E.queries()["csv_scan_infer"](spark, "/root/testdata/sf0.001").count() == 200
print("UNSET-OK")
"""


def test_checkpoint_root_when_the_setting_is_absent():
    """A session without spark.checkpoint.dir (an empty conf folder hides
    the image's spark-defaults.conf): a folder is chosen and registered."""
    import os
    import subprocess
    import sys
    import tempfile

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="empty-conf-"))
    out = subprocess.run([sys.executable, "-c", UNSET_SCRIPT.format(repo=repo)],
                         capture_output=True, text=True, timeout=300, env=env)
    assert "UNSET-OK" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("master_url", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]"])
def test_checkpoint_root_requires_the_setting_on_a_cluster(master_url):
    """On a cluster a driver-local folder is not shared with the executors,
    so an unset spark.checkpoint.dir is an error there, not a fallback."""

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Context:
        master = master_url
        registered = None

        def getCheckpointDir(self):
            return self.registered

        def getConf(self):
            return _Conf()

        def setCheckpointDir(self, path):  # pragma: no cover - must not be reached
            self.registered = path

    class _Session:
        sparkContext = _Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session())
    assert _Session.sparkContext.registered is None


def test_scratch_is_deleted_on_request_only_and_nothing_else_is(spark, scratch):
    one, two = scratch_path(spark, "a"), scratch_path(spark, "b")
    for path in (one, two, f"{scratch}/own"):
        spark.range(3).write.parquet(path)
    discard(spark, one)
    assert spark.read.parquet(two).count() == 3
    with pytest.raises(ValueError, match="not a scratch path"):
        discard(spark, f"{scratch}/own")
    clear_scratch(spark)
    assert spark.read.parquet(f"{scratch}/own").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(two)
    clear_scratch(spark)


def _places(df):
    return df.rdd.glom().collect()


def test_a_layout_places_rows_by_their_values_alone(spark):
    rows = spark.range(0, 500, numPartitions=3).select((F.col("id") % 97).alias("k"), "id")
    layout = Layout(5, ["k"])
    one = _places(laid_out(rows, layout))
    assert one == _places(laid_out(rows.repartition(11), layout)) and len(one) == 5
    assert laid_out(rows, None) is rows
    assert sum(map(len, _places(laid_out(rows, Layout(4))))) == 500


TREES_SCRIPT = r"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master(sys.argv[1]).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
from rowcast.operators.learners import fit, make_learner
from rowcast.plans.jobs import prepared
from rowcast.runtime import Layout
li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
    "l_quantity", "l_extendedprice", "l_tax", (F.col("l_returnflag") == "R").cast("int").alias("y"))
shapes = [li.coalesce(1), li.repartition(7, F.rand(3))]
for kind, params in (("rf", dict(numTrees=8)), ("gbt", dict(maxIter=4))):
    trees = []
    for rows in shapes:
        data = prepared(rows, "y", ["l_quantity", "l_extendedprice", "l_tax"], layout=Layout(4)).persist()
        trees.append(fit(make_learner(kind, "y", **params), data).toDebugString.split("\n", 1)[1])
    assert trees[0] == trees[1], kind
    import hashlib
    print("TREES", kind, hashlib.sha256(trees[0].encode()).hexdigest())
"""


def test_a_layout_gives_equal_trees_from_any_input_layout_and_core_count():
    """The same forest and boosted trees from two partitionings, on two and on
    eight cores (separate processes)."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    seen = []
    for master in ("local[2]", "local[8]"):
        out = subprocess.run([sys.executable, "-c", TREES_SCRIPT.format(repo=repo), master],
                             capture_output=True, text=True, timeout=300)
        lines = [x for x in out.stdout.split("\n") if x.startswith("TREES")]
        assert len(lines) == 2, out.stderr[-2000:]
        seen.append(lines)
    assert seen[0] == seen[1]
