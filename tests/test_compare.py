"""Comparison operators on rows that the generated results never hold: missing cells, ties, few points, constant coverage."""

import pytest

from tokscope.operators import compare

ROWS = [  # model, lang, fertility, bytes_per_token, coverage, nsl
    ("a", "x", 1.0, 4.0, 0.5, 1.0), ("a", "y", 2.0, 3.0, 0.5, 0.9), ("a", "z", 9.0, 2.0, 0.5, 0.8),
    ("b", "x", 1.0, 5.0, 0.1, 1.2), ("b", "y", 4.0, 3.0, 0.2, 0.9), ("c", "x", 3.0, 4.5, 0.3, None),
]


@pytest.fixture(scope="module")
def results(spark):
    return spark.createDataFrame(
        [(m, g, g.upper(), f, b, c, n, 0.1, "Good") for m, g, f, b, c, n in ROWS],
        "model string, lang_code string, lang_name string, fertility double, bytes_per_token double, vocab_coverage double, nsl double, "
        "continuation_rate double, grade string")


def test_pivot_has_null_where_a_cell_is_missing(results):
    got = {r.lang_code: (r.a, r.b, r.c) for r in compare.pivot_metric(results, "fertility").collect()}
    assert got == {"x": (1.0, 1.0, 3.0), "y": (2.0, 4.0, None), "z": (9.0, None, None)}


def test_ties_are_all_best_and_nulls_never(results):
    best = {(r.metric, r.lang_code, r.model) for r in compare.best_per_language(results).collect() if r.is_best}
    assert {m for q, g, m in best if (q, g) == ("fertility", "x")} == {"a", "b"}
    assert {m for q, g, m in best if (q, g) == ("fertility", "z")} == {"a"}
    assert {m for q, g, m in best if (q, g) == ("nsl", "x")} == {"a"}


def test_trend_needs_three_points_and_a_slope_needs_two_coverages(results):
    got = {r.model: r.slope for r in compare.trend(results).collect()}
    assert got == {"a": None}


def test_boxplot_of_few_points(results):
    got = {r.model: (r.q1, r.median, r.q3, r.n_outliers) for r in compare.boxplot(results).collect()}
    assert got["c"] == (3.0, 3.0, 3.0, 0) and got["a"] == (1.5, 2.0, 5.5, 0)


def test_summary_ranks_ties_by_name(results):
    tied = compare.combine(results.where("model = 'c'"), results.where("model = 'c'").replace("c", "d", "model"))
    got = [(r["rank"], r.model, r.n_langs) for r in compare.model_summary(tied).orderBy("rank").collect()]
    assert got == [(1, "c", 1), (2, "d", 1)]


def test_normalised_scores_use_all_rows(results):
    got = {(r.model, r.metric): r.score for r in compare.normalised_scores(results).collect()}
    assert got[("c", "fertility")] == pytest.approx(1 - 2 / 8, abs=1e-6)
