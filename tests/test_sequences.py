import pytest

from mediafeat.operators import sequences as S

T = 3


def _frames(spark):
    rows = []
    for vid, n in ((1, 0), (2, T - 1), (3, T), (4, T + 1)):
        rows += [(vid, s, float(10 * vid + s)) for s in range(n)]
    rows.append((0, 0, 1.0))  # a video with one step so id 1 (no steps) is absent
    return spark.createDataFrame(rows, "id long, step int, v double")


def test_assembly_order_and_length(spark):
    df = S.assemble_sequences(_frames(spark), "id", ["step"], "v", T, "seq")
    got = {r["id"]: (list(r["seq"]), r["n_steps"]) for r in df.collect()}
    assert got[4] == ([40.0, 41.0, 42.0], 4)
    assert got[2] == ([20.0, 21.0], 2)
    assert 1 not in got


def test_policies(spark):
    seq = S.assemble_sequences(_frames(spark), "id", ["step"], "v", T, "seq")
    drop = {r["id"] for r in S.fix_length(seq, "seq", T, "drop").collect()}
    assert drop == {3, 4}
    pad = {r["id"]: (list(r["seq"]), r["true_len"]) for r in S.fix_length(seq, "seq", T, "pad").collect()}
    assert pad[2] == ([20.0, 21.0, 0.0], 2)
    assert pad[4] == ([40.0, 41.0, 42.0], 3)
    with pytest.raises(Exception):
        S.fix_length(seq, "seq", T, "error").collect()


def test_step_count_mismatch_goes_to_quarantine(spark):
    from mediafeat.sources.tables import quarantine
    df = spark.createDataFrame([(1, [[1.0]] * 3, [[2.0]] * 2), (2, [[1.0]] * 2, [[2.0]] * 2)],
                               "id long, rgb array<array<double>>, audio array<array<double>>")
    good, bad = quarantine(df, [("step_count_mismatch", S.step_count_mismatch("rgb", "audio"))])
    assert [r["id"] for r in good.collect()] == [2]
    assert [(r["id"], r["reason"]) for r in bad.collect()] == [(1, "step_count_mismatch")]


def test_duplicate_video_ids_multiply_unless_deduplicated(spark):
    from mediafeat.operators.assemble import frame_video_join
    frames = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "id long, step int")
    video = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b")], "id long, name string")
    assert frame_video_join(frames, video).count() == 5          # Q9: multiplicity kept
    assert frame_video_join(frames, video, dedup_video=True).count() == 3


def test_pooling(spark):
    df = spark.createDataFrame([(1, [[1.0, 4.0], [3.0, 2.0]])], "id long, s array<array<double>>")
    r = S.pool_sequence(df, "s", 2).first()
    assert list(r["pool_mean"]) == [2.0, 3.0]
    assert list(r["pool_max"]) == [3.0, 4.0]
    assert list(r["pool_first"]) == [1.0, 4.0]
    assert list(r["pool_last"]) == [3.0, 2.0]
    # fwd weights (0.5, 1) favour the last step; bwd weights (1, 0.5) the first
    assert list(r["pool_fwd"]) == pytest.approx([(0.5 * 1 + 3) / 1.5, (0.5 * 4 + 2) / 1.5])
    assert list(r["pool_bwd"]) == pytest.approx([(1 + 0.5 * 3) / 1.5, (4 + 0.5 * 2) / 1.5])


def test_first_steps_uses_group_limit(spark):
    df = S.first_steps(_frames(spark), "id", ["step"], T)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
