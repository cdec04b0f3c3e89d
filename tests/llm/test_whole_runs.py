"""Runs of line hashes: batches anti-join them in bucket order, and what is frequent equals a plain count."""

import random
from collections import Counter

from ticklore.llm.line_dedup import KEY, LineRuns, merge_anti


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_levels(spark):
    rng, runs, total = random.Random(4), LineRuns(spark, min_docs=5, fanout=3), Counter()
    for batch in range(8):
        seen = Counter(min(int(rng.expovariate(0.02)), 400) for _ in range(300))
        seen[7] += 2  # a key of every batch, and one of more than min_docs at once
        seen[1000 + batch] = 6
        total.update(seen)
        held = {r.h1 for level in runs.levels for run in level for r in run.collect()}
        settled = {r.h1 for run in runs.settled for r in run.collect()}
        before = [len(level) for level in runs.levels]
        runs.add(spark.createDataFrame([(k, -k, n) for k, n in seen.items()], "h1 long, h2 long, n long"))
        if before and before[0] < 2:  # not compacted since
            assert {r.h1 for r in runs.levels[0][-1].collect()} == set(seen) - held - settled
            assert {r.h1 for r in runs.tallies[0][-1].collect()} == set(seen) & held - settled
    assert {r.h1 for r in runs.frequent().collect()} == {k for k, n in total.items() if n >= 5}
    assert len(runs.levels) == 2 and len(runs.levels[1]) == 2 and len(runs.levels[0]) == 2


def test_runs_are_read_in_order(spark):
    runs = LineRuns(spark, min_docs=5, fanout=9)
    for batch in range(3):
        runs.add(spark.range(1000 * batch, 1000 * batch + 1500).selectExpr("id AS h1", "-id AS h2", "1L AS n"))
    first, second, third = runs.levels[0]
    plan = plan_of(merge_anti(merge_anti(third, first), second))
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and "Sort [" not in plan
    assert third.count() == 1000 and KEY == ["h1", "h2"]
