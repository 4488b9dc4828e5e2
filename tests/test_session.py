import os

from parlance.session import new_folder, shared_folder, size_shuffles, sized_for


def test_shared_folder_is_the_configured_one(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "x").startswith(folder + "/x-")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert spark.sparkContext.getCheckpointDir()


def test_shuffles_follow_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
        assert size_shuffles(spark, 100 * 10**12) == 186265
        assert spark.conf.get("spark.sql.shuffle.partitions") == "186265"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shuffles_of_a_job_fit_its_input(spark, small):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_for(spark.read.parquet(f"{small}/documents.parquet")):
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_nothing_runs_in_python(spark, small):
    """No plan of a registered query has a Python worker in it."""
    from workload.queries import REGISTRY

    for name, query in REGISTRY.items():
        if name in ("transcript", "user_report", "token_table", "heuristic_tokens", "feedback_answers", "profile_parse"):
            plan = query(spark, small)._jdf.queryExecution().executedPlan().toString()
            assert "EvalPython" not in plan and "InPandas" not in plan, name
    assert os.path.isdir(small)
