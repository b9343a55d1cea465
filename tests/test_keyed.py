"""Keyed tables against a plain dictionary: batches, repeats, versions, crashes."""

import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from millrace.session import entries, path_exists
from millrace.streaming import KeyedTable
from millrace.streaming.keyed import BATCH

SHAPE = "Name STRING, Horsepower BIGINT, at INT"


def table(spark, path, **options):
    options = {"order_by": ["at"], "buckets": 4} | options
    return KeyedTable(spark, str(path), ["Name"], spark.createDataFrame([], SHAPE).schema, **options)


def frame(spark, values):
    return spark.createDataFrame(values, SHAPE)


def newest(batches):
    """By order, nulls oldest, then by batch."""
    best = {}
    for number, batch in enumerate(batches):
        for name, power, at in batch:
            rank = (at is not None, at or 0, number)
            if name not in best or rank > best[name][0]:
                best[name] = (rank, (name, power, at))
    return sorted((row for _, row in best.values()), key=repr)


def test_the_newest_row_per_key(spark, tmp_path):
    keyed = table(spark, tmp_path / "t")
    keyed.write(frame(spark, [("a", 1, 1), ("a", 2, 5), ("b", 3, 1)]), 0)
    keyed.write(frame(spark, [("a", 9, 4), ("b", None, 2), ("c", 7, 1)]), 1)
    expected = [("a", 2, 5), ("b", None, 2), ("c", 7, 1)]
    assert rows(keyed.rows()) == expected
    keyed.write(frame(spark, [("a", 9, 4), ("b", None, 2), ("c", 7, 1)]), 1)  # repeated after a crash
    assert rows(keyed.rows()) == expected
    assert keyed.compact() == 1 and rows(keyed.rows()) == expected
    keyed.write(frame(spark, [("a", 9, 4), ("b", None, 2), ("c", 7, 1)]), 1)  # repeated after a version
    assert rows(keyed.rows()) == expected and keyed.compact() == 1


def test_later_batch_wins_without_an_order(spark, tmp_path):
    with pytest.raises(ValueError, match="order_by"):
        table(spark, tmp_path / "t", order_by=[])
    keyed = table(spark, tmp_path / "t", order_by=[], unique=True)
    for compacted in (False, True):
        keyed.write(frame(spark, [("x", 1, 9), ("y", 1, None)]), 2 * compacted)
        keyed.write(frame(spark, [("x", None, 1)]), 2 * compacted + 1)
        assert rows(keyed.rows()) == [("x", None, 1), ("y", 1, None)]
        keyed.compact()
        assert rows(keyed.rows()) == [("x", None, 1), ("y", 1, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_batches_and_versions_equal_a_dictionary(spark, tmp_path, seed):
    draw, batches, keyed = random.Random(seed), [], table(spark, tmp_path / "t")
    for number in range(5):
        names = draw.sample([None, *"abcdefgh"], draw.randint(0, 6))
        batches.append([(n, draw.randint(0, 99), draw.choice([None, 1, 2, 3])) for n in names])
        keyed.write(frame(spark, batches[-1]), number)
        if draw.random() < 0.5:
            keyed.compact()
            if draw.random() < 0.5:
                keyed.vacuum()
        assert rows(keyed.rows()) == newest(batches)
    for name in (None, "a", "zz"):
        assert rows(keyed.lookup(name)) == [r for r in newest(batches) if r[0] == name]


def test_unfinished_batches_are_not_seen(spark, tmp_path):
    keyed = table(spark, tmp_path / "t")
    keyed.write(frame(spark, [("a", 1, 1)]), 0)
    keyed.write(frame(spark, [("a", 2, 2)]), 1)
    (tmp_path / "t" / "log" / f"{BATCH}=1" / "_SUCCESS").unlink()
    assert rows(keyed.rows()) == [("a", 1, 1)]
    keyed.compact()
    keyed.write(frame(spark, [("a", 2, 2)]), 1)
    assert rows(keyed.rows()) == [("a", 2, 2)]


def test_a_version_that_was_not_published_has_no_effect(spark, tmp_path, monkeypatch):
    import millrace.streaming.keyed as module

    keyed = table(spark, tmp_path / "t")
    keyed.write(frame(spark, [("a", 1, 1)]), 0)

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(module, "move_path", lost)
        with pytest.raises(OSError, match="driver lost"):
            keyed.compact()
    assert rows(keyed.rows()) == [("a", 1, 1)] and keyed.state().version == 0
    assert keyed.compact() == 1 and rows(keyed.rows()) == [("a", 1, 1)]


def test_two_versions_at_once(spark, tmp_path, monkeypatch):
    """The second to publish fails and changes nothing."""
    import millrace.streaming.keyed as module

    keyed, move, first = table(spark, tmp_path / "t"), module.move_path, [True]
    keyed.write(frame(spark, [("a", 1, 1)]), 0)

    def slow(session, source, target):
        if first.pop():
            first.append(False)
            keyed.compact()
        move(session, source, target)

    monkeypatch.setattr(module, "move_path", slow)
    with pytest.raises(OSError, match="cannot move"):
        keyed.compact()
    assert keyed.state().version == 1 and rows(keyed.rows()) == [("a", 1, 1)]


def test_untouched_buckets_stay(spark, tmp_path):
    keyed = table(spark, tmp_path / "t")
    keyed.write(frame(spark, [(c, 1, 1) for c in "abcdefghij"]), 0)
    keyed.compact()
    before = keyed.state().buckets
    keyed.write(frame(spark, [("a", 2, 2)]), 1)
    keyed.compact()
    assert sum(v != before[b] for b, v in keyed.state().buckets.items()) == 1
    keyed.vacuum()
    assert not entries(spark, str(tmp_path / "t" / "log")) and len(rows(keyed.rows())) == 10
    assert path_exists(spark, str(tmp_path / "t" / "base"))


def test_another_layout_is_refused(spark, tmp_path):
    table(spark, tmp_path / "t").write(frame(spark, [("a", 1, 1)]), 0)
    with pytest.raises(ValueError, match="was made with"):
        table(spark, tmp_path / "t", order_by=["Horsepower"])
    assert rows(table(spark, tmp_path / "t", buckets=9).rows()) == [("a", 1, 1)]  # the stored number holds


@pytest.mark.parametrize("order", [["at"], []])
def test_payloads_are_not_aggregated(spark, tmp_path, order):
    keyed = table(spark, tmp_path / "t", order_by=order, unique=not order)
    for number in range(2):
        keyed.write(frame(spark, [("a", 1, number)]), number)
        if not number:
            keyed.compact()
    plan = keyed.rows()._jdf.queryExecution().executedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate(" in line]
    assert aggregates and not any("Horsepower" in line for line in aggregates)
    if not order:
        assert "SortAggregate" not in plan


def test_an_empty_table(spark, tmp_path):
    keyed = table(spark, tmp_path / "t")
    assert rows(keyed.rows()) == [] and keyed.compact() == 0
    keyed.write(frame(spark, []), 0)
    assert rows(keyed.rows()) == []
    keyed.compact()
    assert rows(keyed.rows()) == [] and keyed.rows().columns == ["Name", "Horsepower", "at"]
    assert keyed.rows().agg(F.count("at")).first()[0] == 0
