"""Monitoring queries on tables whose user ids go beyond a SMALLINT."""

import datetime as dt

import pytest

from trawl.plans import queries_monitor as QM

HOUR = dt.datetime(2024, 5, 1, 7, 30)


def _events(spark, path, users):
    rows = [(i, HOUR, u, kind, float(10 * i + j)) for i, u in enumerate(users) for j, kind in enumerate(("view", "click"))]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double") \
        .write.parquet(str(path / "events.parquet"))
    return str(path)


@pytest.mark.parametrize("users", [[5, 32768, 90_000, 3_000_000_000], [7, -40_000]])
def test_ids_beyond_a_smallint(spark, tmp_path, users):
    sf_dir = _events(spark, tmp_path, users)
    want = sorted(users, key=lambda u: -users.index(u))  # values rise with the position
    for query, first in ((QM.q_top_tasks, 1), (QM.q_top_tasks_sum, 0)):
        got = query(spark, sf_dir).orderBy("rank").collect()
        assert [(r.task_id, r.metric) for r in got] == [(u, 10.0 * users.index(u) + first) for u in want]
    got = QM.q_two_level_top(spark, sf_dir).collect()
    assert {(r.task_id, r.event_type): r.rank for r in got} == \
        {(u, kind): rank for u in users for kind, rank in (("click", 1), ("view", 2))}


def test_small_ids_keep_the_type_of_the_sql(spark, tmp_path):
    sf_dir = _events(spark, tmp_path, [0, 32767, None])
    got = QM.q_top_tasks(spark, sf_dir)
    assert dict(got.dtypes)["task_id"] == "smallint"
    assert {r.task_id for r in got.collect()} == {0, 32767, None}
