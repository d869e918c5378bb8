import os

from mediafeat import session as S


def test_scratch_of_this_process_can_be_cleared(spark):
    path = S.scratch_path(spark, "t_clear")
    spark.range(3).write.parquet(path)
    folder = os.path.dirname(S.local_path(path))
    assert os.path.isdir(S.local_path(path))
    S.clear_scratch()
    assert not os.path.exists(folder)
    again = S.scratch_path(spark, "t_clear")
    spark.range(3).write.parquet(again)
    assert spark.read.parquet(again).count() == 3
