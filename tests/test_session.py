from unittest.mock import MagicMock

import pytest

from registria.session import checkpointed


def frame(master, folder=None, current=None):
    df = MagicMock()
    context = df.sparkSession.sparkContext
    context.master, context.getCheckpointDir.return_value = master, current
    df.sparkSession.conf.get.side_effect = lambda key, default=None: folder or default
    return df, context


def test_cluster_needs_a_shared_folder():
    df, context = frame("spark://host:7077")
    with pytest.raises(ValueError):
        checkpointed(df)
    context.setCheckpointDir.assert_not_called()


def test_the_session_names_the_folder():
    df, context = frame("yarn", "hdfs:///checkpoints")
    checkpointed(df)
    context.setCheckpointDir.assert_called_once_with("hdfs:///checkpoints")
    df, context = frame("yarn", "hdfs:///other", current="hdfs:///already")
    checkpointed(df)
    context.setCheckpointDir.assert_not_called()


def test_checkpoints_go_to_that_folder(spark):
    checkpointed(spark.range(3)).count()
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()
