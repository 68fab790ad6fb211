"""Frames stored on the way to another one."""

import os

import pytest

from gridmill.session import shared_folder, stored, stored_alone


def folders(spark):
    base = shared_folder(spark).removeprefix("file://")
    return {d for d in os.listdir(base) if os.path.isdir(f"{base}/{d}")} if os.path.isdir(base) else set()


def test_steps_go_once_their_result_is_written(spark):
    def inner():
        return stored(spark.range(4), "deep").selectExpr("id * 2 id")

    def make():
        first = stored(spark.range(10), "step")
        return first.join(stored_alone(spark, inner, "nested"), "id").selectExpr("id + 1 id")

    before = folders(spark)
    frame = stored_alone(spark, make, "result")
    (left,) = folders(spark) - before
    assert left.startswith("result-") and "steps" not in left
    assert sorted(r[0] for r in frame.collect()) == [1, 3, 5, 7]
    later = stored(spark.range(1), "later")
    assert later.count() == 1 and len(folders(spark) - before) == 2


def test_steps_go_when_the_result_fails(spark):
    def make():
        stored(spark.range(3), "step")
        raise ValueError("no result")

    before = folders(spark)
    with pytest.raises(ValueError, match="no result"):
        stored_alone(spark, make, "result")
    assert folders(spark) == before
    stored(spark.range(1), "later")
    (left,) = folders(spark) - before
    assert left.startswith("later-")


def test_an_empty_result_is_read_back(spark):
    assert stored_alone(spark, lambda: stored(spark.range(3), "step").filter("id < 0"), "result").count() == 0
    assert stored_alone(spark, lambda: spark.range(2), "result").count() == 2
