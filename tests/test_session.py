import re
import time
from types import SimpleNamespace

import pytest

from claimweave.session import clear_staging, run_together, stage, staging_root


def fake_session(setting=None, checkpoint_dir=None, master="local[2]"):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint_dir)
    settings = {"spark.checkpoint.dir": setting, "spark.sql.warehouse.dir": "file:/warehouse"}
    conf = SimpleNamespace(get=lambda key, default=None: settings[key] or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_named_folder_is_used():
    assert staging_root(fake_session("hdfs:///shared/")) == "hdfs:///shared"
    assert staging_root(fake_session(None, "hdfs:///old")) == "hdfs:///old"


def test_only_local_sessions_do_without_the_setting():
    assert staging_root(fake_session()) == "file:/warehouse/staging"
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        staging_root(fake_session(master="yarn"))


def test_staged_tables_keep_schema_and_rows(spark):
    df = spark.range(5).selectExpr("id", "array(struct(id AS a, 'x' AS b)) AS nested")
    staged = stage(df, "t")
    assert staged.dtypes == df.dtypes
    assert sorted(map(str, staged.collect())) == sorted(map(str, df.collect()))
    assert stage(df.where("false"), "empty").count() == 0


def test_what_a_staged_table_shuffled_does_not_stay(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return set(re.findall(r"shuffle_\d+_", files.getAllFiles().mkString(" ")))

    before, key = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    wide = spark.range(5000).selectExpr("md5(string(id)) AS x").groupBy("x").count()
    tables = run_together(spark, lambda: stage(wide, "a"), lambda: stage(wide, "b"))
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(key) == setting
    assert [t.count() for t in tables] == [5000, 5000]


def test_staged_tables_can_be_cleared(spark):
    staged = stage(spark.range(3), "gone")
    assert staged.count() == 3
    clear_staging(spark)
    with pytest.raises(Exception, match="exist|not found|NOT_EXIST"):
        spark.read.parquet(staged.inputFiles()[0]).count()


def test_steps_run_side_by_side_and_errors_surface(spark):
    assert run_together(spark, lambda: spark.range(3).count(), lambda: "b") == [3, "b"]
    with pytest.raises(ZeroDivisionError):
        run_together(spark, lambda: 1 / 0)
