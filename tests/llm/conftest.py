import pytest


@pytest.fixture(autouse=True, scope="session")
def shared_folder(spark, tmp_path_factory):
    """The folder that a cluster would name; set for these tests only where it is unset."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
