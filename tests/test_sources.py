import os

import pytest
from pyspark.errors import AnalysisException

from churnloom.prepare import prepare_splits, write_train_test
from churnloom.schema import LOG_COLUMNS
from churnloom.session import cut_lineage, run_folder, scratch_path, shared_dir
from churnloom.sources.activity_log import activity_log
from churnloom.sources.log_files import read_log, read_table, write_table
from conftest import DATA

SF = f"{DATA}/sf0.001"


def test_json_round_trip_keeps_every_value(spark):
    log = activity_log(spark, SF)
    path = write_table(log, scratch_path(spark, "t"))
    assert sorted(map(str, read_log(spark, path).collect())) == sorted(map(str, log.collect()))


def test_existing_path_is_an_error(spark, make_log):
    path = write_table(make_log({}), scratch_path(spark, "t"))
    with pytest.raises(AnalysisException):
        write_table(make_log({}), path)


def test_user_filter_reaches_the_json_scan(spark, make_log):
    from churnloom.operators.clean import known_users

    path = write_table(make_log({}), scratch_path(spark, "t"))
    plan = known_users(read_log(spark, path)).select("page")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(userId), Not(EqualTo(userId,))]" in plan
    assert "ReadSchema: struct<userId:string,page:string>" in plan


def test_only_wanted_lookups_are_planned(spark):
    plan = activity_log(spark, SF, ["userId", "ts"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "customer" not in plan
    assert activity_log(spark, SF).columns == LOG_COLUMNS


def test_batch_job(spark):
    log = write_table(activity_log(spark, SF), scratch_path(spark, "log"))
    paths = write_train_test(spark, log, scratch_path(spark, "a"), scratch_path(spark, "b"), ["nr_home"])
    sizes = {name: read_table(spark, p, "json").count() for name, p in paths.items()}
    assert sum(sizes.values()) == 15 and sizes["train"] > sizes["test"]
    made = prepare_splits(spark, log)
    assert sum(df.count() for df in made.values()) == 15 and list(made) == ["train", "validation", "test"]


def test_shared_folder_is_read_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert spark.sparkContext.getCheckpointDir() is not None


def test_run_folder_is_empty_after_a_run_and_after_a_failure(spark):
    result = scratch_path(spark, "result")
    with run_folder(spark) as outer:
        held = cut_lineage(spark.range(5), "kept")
        with run_folder(spark) as inner:
            assert inner.startswith(outer) and scratch_path(spark, "x").startswith(inner)
            cut_lineage(held, "more").count()
        assert not os.path.exists(inner) and len(os.listdir(outer)) == 1
        held.write.parquet(result)
    assert not os.path.exists(outer) and spark.read.parquet(result).count() == 5
    with pytest.raises(ZeroDivisionError):
        with run_folder(spark) as failed:
            cut_lineage(spark.range(5))
            assert os.listdir(failed)
            1 / 0
    assert not os.path.exists(failed)
    assert not scratch_path(spark, "x").startswith(failed)
