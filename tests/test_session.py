"""The shared work folder comes from the session; a local one is named only where none is set."""

from orderlens.session import local_session, shared_dir


def test_shared_dir_is_the_sessions_checkpoint_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_dir(spark)
    if configured:
        assert path == configured.rstrip("/")
    assert spark.sparkContext.getCheckpointDir()


def test_local_session_keeps_an_existing_folder(spark):
    before = (spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir())
    again = local_session("*", shuffle_partitions=8)
    assert again.sparkContext is spark.sparkContext
    assert (again.conf.get("spark.checkpoint.dir", None), again.sparkContext.getCheckpointDir()) == before
