import os

import pytest

from riskweave.llm import scratch


def test_tables_of_the_application_can_be_cleared(spark):
    path = scratch.new_folder(spark, "t")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:").replace("//", "/")
    assert spark.sparkContext.applicationId in path and os.path.isdir(local)
    held = scratch.store(spark.range(5), "u").collect()
    scratch.clear(spark)
    assert len(held) == 5 and not os.path.exists(local)


def test_no_folder_of_this_machine_on_a_cluster(spark):
    from riskweave.session import own_folder

    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        own_folder(Session())
