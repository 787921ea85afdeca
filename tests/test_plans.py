"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry
from asterism import session

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["jon_1_date_lookup", "jon_4_round_join_hot_keys", "agg_1_count_by_key_date", "agg_2_sum_by_key",
                                  "fct_1_fact_company_growth", "fct_2_fact_investments", "id_1_surrogate_dense_bag",
                                  "val_3_fk_rule", "snk_3_upsert_columns", "prf_1_profile_table", "dim_6_dim_relationship"])
def test_no_cross_join_and_no_single_task_window(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Window" not in text and "PythonUDF" not in text and "InPandas" not in text


def test_aggregates_combine_before_the_shuffle(spark):
    for name in ("agg_2_sum_by_key", "agg_9_one_row_per_key"):
        assert "partial_" in plan(entry.queries()[name](spark, FOLDER))


def test_presence_join_is_dropped(spark):
    assert "Join" not in plan(entry.queries()["jon_3_dim_presence_join"](spark, FOLDER))


def test_only_needed_columns_are_read(spark):
    text = plan(entry.queries()["src_3_jdbc_projected"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_scratch_folder_is_the_cluster_s(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.scratch_folder(spark)
    assert folder.startswith(named) if named else "asterism-" in folder
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
