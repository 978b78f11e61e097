import pytest
from pyspark.sql import functions as F

from geoferry import current_state, upsert

SCHEMA = "k string, status string, note string"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def contents(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_update_insert_and_null_keys(spark):
    target = frame(spark, ("a", "Pending", "x"), ("b", "Pending", "y"), (None, "Pending", "z"))
    source = frame(spark, ("a", "Complete", None), ("c", "Failed", "w"), (None, "Complete", "v"))
    assert contents(upsert(target, source, ["k"])) == contents(
        frame(spark, ("a", "Complete", None), ("b", "Pending", "y"), (None, "Pending", "z"), ("c", "Failed", "w"), (None, "Complete", "v"))
    )


def test_only_some_columns_are_updated(spark):
    target, source = frame(spark, ("a", "Failed", "first")), frame(spark, ("a", "Success", "second"), ("b", "Success", "new"))
    assert contents(upsert(target, source, ["k"], ["status"])) == [("a", "Success", "first"), ("b", "Success", "new")]


def test_twice_is_once(spark):
    target, source = frame(spark, ("a", "1", "x"), ("b", "1", "x")), frame(spark, ("b", "2", None), ("c", "2", "y"))
    once = upsert(target, source, ["k"])
    assert contents(upsert(once, source, ["k"])) == contents(once)


def test_two_source_rows_for_one_target_row_raise(spark):
    target, source = frame(spark, ("a", "1", "x")), frame(spark, ("a", "2", "x"), ("a", "3", "x"))
    with pytest.raises(Exception, match="two or more source rows"):
        # Even where no value of the source is needed.
        upsert(target, source, ["k"]).count()


def test_unmatched_copies_are_all_added(spark):
    target, source = frame(spark, ("a", "1", "x")), frame(spark, ("b", "2", "x"), ("b", "2", "x"))
    assert contents(upsert(target, source, ["k"])) == [("a", "1", "x"), ("b", "2", "x"), ("b", "2", "x")]


def test_target_rows_that_share_a_key_stay_apart(spark):
    target, source = frame(spark, ("a", "1", "x"), ("a", "1", "y")), frame(spark, ("a", "2", "z"))
    assert contents(upsert(target, source, ["k"], ["status"])) == [("a", "2", "x"), ("a", "2", "y")]


def test_empty_sides(spark):
    some, none = frame(spark, ("a", "1", "x")), frame(spark, ("a", "1", "x")).limit(0)
    assert contents(upsert(none, some, ["k"])) == contents(upsert(some, none, ["k"])) == [("a", "1", "x")]


def test_state_of_a_log_is_that_of_the_merges(spark):
    steps = [
        frame(spark, ("a", "Pending", "x"), ("b", "Pending", "y")),
        frame(spark, ("a", "Failed", "why"), (None, "Pending", "z")),
        frame(spark, ("a", "Complete", None), ("c", "Pending", None), (None, "Complete", None)),
    ]
    for updated in (None, ["status"], ["note"]):
        merged, log = steps[0], steps[0].withColumn("seq", F.lit(0))
        for number, step in enumerate(steps[1:], 1):
            merged = upsert(merged, step, ["k"], updated)
            log = log.unionByName(step.withColumn("seq", F.lit(number)))
        state = current_state(log, ["k"], "seq", updated)
        assert state.columns == merged.columns and contents(state) == contents(merged)


def test_null_may_count_as_a_key(spark):
    log = frame(spark, (None, "Failed", "x"), (None, "Success", None)).withColumn("seq", F.monotonically_increasing_id())
    assert current_state(log, ["k"], "seq", null_is_a_key=True).count() == 1
    assert current_state(log, ["k"], "seq").count() == 2
