import pytest

from hitloom.llm import common


@pytest.fixture(autouse=True)
def shared_folder(spark):
    """Every operator keeps its intermediates below the session's checkpoint folder."""
    assert common.work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
