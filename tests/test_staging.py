"""Staged tables: where they go and what they keep."""

import os
from types import SimpleNamespace

import pytest

from tillsight.functions.staging import release, stage, staging_root


def session(master, setting=None, context_dir=None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: context_dir)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context)


def test_the_shared_folder_is_used():
    assert staging_root(session("yarn", "hdfs://x/ck/")) == "hdfs://x/ck"
    assert staging_root(session("yarn", None, "hdfs://y/ck")) == "hdfs://y/ck"


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_root(session("yarn"))


def test_a_local_session_keeps_one_folder_of_its_own():
    assert staging_root(session("local[2]")) == staging_root(session("local[2]"))


def test_a_released_table_is_deleted_and_others_stay(spark, t):
    one, two = stage(t.clean.limit(5), "one"), stage(t.clean.limit(5), "two")
    files = one.inputFiles()
    release(one)
    release(spark.range(3).toDF("x"))
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files) and two.count() == 5


def test_staged_table_keeps_schema_and_pushdown(spark, t):
    df = stage(t.clean.limit(50), "probe")
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in t.clean.schema]
    plan = df.where("CustomerID > 5").select("Quantity")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Quantity:decimal(12,3),CustomerID:bigint>" in plan
    assert "GreaterThan(CustomerID,5)" in plan
