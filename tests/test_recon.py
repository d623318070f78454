"""Reconciliation on small fixed inputs."""

import pytest

from rowloom.operators import recon
from tests.helpers import frame, plan_of, same


@pytest.fixture
def wells(spark):
    """Readings of wells: equal, one value off, two values off, and one that only the right side has."""
    schema = "site int, bore string, operator string, depth int, rock string"
    left = frame(
        spark, schema, (11, "n", "Ida", 90, "chalk"), (11, "s", "Ida", 64, "clay"), (12, "n", "Ole", 71, "marl")
    )
    right = frame(
        spark,
        schema,
        (11, "n", "Ida", 90, "chalk"),
        (11, "s", "Ida", 66, "clay"),
        (12, "n", "Olaf", 71, "shale"),
        (13, "w", "Una", 15, "peat"),
    )
    return left, right


WELL = ["site", "bore"]


def test_wide(wells, join_path):
    wide = recon.reconcile_wide(*wells, WELL)
    assert wide.columns == [*WELL, "operator_mismatch", "depth_mismatch", "rock_mismatch"]
    same(wide, [(11, "s", None, "64 vs 66", None), (12, "n", "Ole vs Olaf", None, "marl vs shale")])
    same(recon.reconcile_presence(*wells, WELL), [(13, "w", "Una", 15, "peat", "right", "right_only")])


def test_wide_shows_nulls(spark, join_path):
    left = frame(spark, "k int, v string, w string", (1, None, None), (2, "a", None))
    right = frame(spark, "k int, v string, w string", (1, "b", None), (2, None, None))
    same(recon.reconcile_wide(left, right, ["k"]), [(1, "null vs b", None), (2, "a vs null", None)])


@pytest.fixture
def actives(spark):
    """Meters by a key of three columns; inactive ones differ but do not count."""
    schema = "region string, street string, meter string, reading int, tariff string, active_in string"
    left = frame(
        spark,
        schema,
        ("east", "elm", "m1", 17, "day", "Y"),
        ("east", "elm", "m2", 18, "day", "Y"),
        ("east", "oak", "m1", 19, "night", "Y"),
        ("west", "fir", "m4", 20, "day", "N"),
        ("west", "ash", "m5", 21, "day", "Y"),
    )
    right = frame(
        spark,
        schema,
        ("east", "elm", "m1", 17, "day", "Y"),
        ("east", "elm", "m2", 28, "night", "Y"),
        ("east", "oak", "m1", 19, "flat", "Y"),
        ("west", "fir", "m4", 99, "day", "N"),
        ("west", "yew", "m6", 22, "flat", "Y"),
    )
    return tuple(recon.active_rows(side, "active_in") for side in (left, right))


KEYS = ["region", "street", "meter"]


def test_long(actives, join_path):
    same(
        recon.reconcile_long(*actives, KEYS, ["reading", "tariff"]),
        [
            ("east", "elm", "m2", "reading", "18", "28"),
            ("east", "elm", "m2", "tariff", "day", "night"),
            ("east", "oak", "m1", "tariff", "night", "flat"),
        ],
    )


def test_presence(actives, join_path):
    same(
        recon.reconcile_presence(*actives, KEYS),
        [
            ("west", "ash", "m5", 21, "day", "Y", "left", "left_only"),
            ("west", "yew", "m6", 22, "flat", "Y", "right", "right_only"),
        ],
    )


def test_presence_of_repeated_and_null_keys(spark, join_path):
    left = frame(spark, "k int, v int", (1, 1), (1, 2), (2, 1), (2, 2), (None, 1), (3, 1))
    right = frame(spark, "k int, w int", (2, 9), (None, 8), (3, 7))
    same(
        recon.reconcile_presence(left, right, ["k"]),
        [
            (1, 1, None, "left", "left_only"),
            (1, 2, None, "left", "left_only"),
            (2, 1, None, "left", "repeated_key"),
            (2, 2, None, "left", "repeated_key"),
            (2, None, 9, "right", "repeated_key"),
            (None, 1, None, "left", "left_only"),
            (None, None, 8, "right", "right_only"),
        ],
    )


def test_a_table_agrees_with_itself(wells, join_path):
    left, keys = wells[0], WELL
    assert recon.reconcile_wide(left, left, keys).isEmpty()
    assert recon.reconcile_long(left, left.selectExpr("*"), keys, ["operator", "rock"]).isEmpty()
    assert recon.reconcile_presence(left, left, keys).isEmpty()
    assert recon.reconcile_rows(left, left).isEmpty()


def test_long_unfolds_one_join(actives, spark):
    plan = plan_of(recon.reconcile_long(*actives, KEYS, ["reading", "tariff"], unique_keys=True))
    assert plan.count("Join") == 1 and plan.count("Generate") == 1


def test_rows(spark):
    schema = "a int, b string"
    source = frame(spark, schema, (1, "x"), (1, "x"), (2, None), (3, "z"), (4, None), (4, None))
    target = frame(spark, schema, (1, "x"), (2, None), (3, "y"))
    same(recon.missing_rows(source, target), [(3, "z"), (4, None)])
    same(recon.reconcile_rows(source, target), [(3, "z", "TARGET"), (4, None, "TARGET"), (3, "y", "SOURCE")])
    assert plan_of(recon.reconcile_rows(source, target)).count("Exchange") == 1


def test_rows_without_equal_keep_copies(spark, join_path):
    schema = "a int, b string"
    source = frame(spark, schema, (1, "x"), (1, "x"), (2, None), (4, None), (4, None))
    target = frame(spark, schema, (1, "x"), (1, "x"), (2, None), (3, "y"))
    same(recon.rows_without_equal(source, target), [(4, None), (4, None)])
    same(recon.rows_without_equal(source, target, on=["a"]), [(4, None), (4, None)])
