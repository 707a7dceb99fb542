"""The halving search on known functions, and on fits."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from footfall.models import learners, tuning
from footfall.models.prepare import FeatureNames
from footfall.models.search import REDUCTION, Trial, halving_search, resource_at, suggest

SPACE = {
    "trees": ("int", 90, 900, 90),
    "rate": ("log", 0.001, 1.0),
    "share": ("float", 0.0, 1.0),
    "bins": ("log_int", 16, 256),
    "kind": ("choice", "a", "b", "c"),
}


def hill(settings, amount):
    """Greatest at rate 0.05, share 0.7, kind b; more trees help all alike."""
    miss = abs(math.log(settings["rate"] / 0.05)) / 5 + abs(settings["share"] - 0.7) + 0.3 * (settings["kind"] != "b")
    return 1 - miss - 10 / amount


def test_values_stay_in_their_ranges_and_repeat():
    done = []
    for number in range(60):
        settings = suggest(SPACE, done, number, 1)
        assert settings == suggest(SPACE, done, number, 1)
        assert settings["trees"] in range(90, 901, 90) and settings["kind"] in "abc"
        assert 0.001 <= settings["rate"] <= 1 and 0 <= settings["share"] <= 1
        assert 16 <= settings["bins"] <= 256 and isinstance(settings["bins"], int)
        done.append(Trial(number, settings, [1], [hill(settings, 100)]))


def test_learning_beats_blind_draws():
    def found(learns):
        best = []
        for seed in range(12):
            done = []
            for number in range(60):
                settings = suggest(SPACE, done if learns else [], number, seed)
                done.append(Trial(number, settings, [1], [hill(settings, 1000)]))
            best.append(max(t.scores[0] for t in done))
        return sum(best) / len(best)

    assert found(True) > found(False) + 0.03


def test_brackets_spend_a_third_and_keep_the_best():
    spent = []

    def evaluate(settings, amount):
        spent.append(amount / settings["trees"])
        return hill(settings, amount)

    trials = halving_search(SPACE, evaluate, "trees", 100, seed=3)
    assert len(trials) == 100 and {t.number for t in trials} == set(range(100))
    assert sum(spent) < 0.4 * len(trials)
    assert [len(t.scores) for t in trials] == sorted((len(t.scores) for t in trials), reverse=True)
    full = [t for t in trials if len(t.scores) == 3]
    assert all(t.resources[-1] == t.settings["trees"] for t in full)
    assert trials[0].scores[-1] == max(t.scores[-1] for t in full)
    assert trials == halving_search(SPACE, evaluate, "trees", 100, seed=3, parallel=1)


def test_nan_loses_and_small_searches_work():
    trials = halving_search(SPACE, lambda s, a: math.nan if s["kind"] != "b" else 0.5, "trees", 9, seed=5)
    assert trials[0].settings["kind"] == "b" or all(t.settings["kind"] != "b" for t in trials)
    assert len(halving_search(SPACE, hill, "trees", 1, seed=5)[0].scores) == 3
    assert halving_search(SPACE, hill, "trees", 0, seed=5) == []
    assert [resource_at(900, r, 3, REDUCTION) for r in range(3)] == [100, 300, 900]


@pytest.mark.parametrize("partitions", [2])
def test_fits_do_not_depend_on_partitions(spark, partitions):
    rows = spark.range(300).select(
        "id",
        *[((F.col("id") * p % 97) / 97).alias(f"x{p}") for p in (31, 53, 71)],
        ((F.col("id") * 31 % 97 + F.col("id") * 53 % 97 + F.col("id") % 7 * 9) > 110).cast("int").alias("label"),
        (F.col("id") % 5 == 0).alias("is_validation"),
    )
    names = FeatureNames.of(["x31", "x53", "x71"])
    learner = learners.boosted_trees(validation_flag="is_validation")
    space = {**tuning.BOOSTING_SPACE, "n_estimators": ("int", 4, 8, 4), "max_depth": ("int", 2, 4, 1)}

    def found(n):
        dealt = rows.repartition(n, F.col("id") % 11)
        return tuning.search_boosting(learner, names, dealt, "id", space, trials=4, rungs=2, reduction=2)

    one, other = found(1), found(partitions)
    assert one == other and one[0].scores[-1] > 0.6
    table = tuning.search_table(rows, one).collect()
    assert sum(r.is_best for r in table) == len(one[0].scores) and len(table) == 4 + 2
