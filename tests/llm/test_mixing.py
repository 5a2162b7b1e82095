import re
from collections import defaultdict

import pytest
from tests.llm.helpers import awkward, documents, empty

from ledgerline.llm import mixing


def fill(sizes, weights, epochs, total):
    """Round by round, as the method is told."""
    clamped = {}
    while True:
        rest = total - sum(clamped.values())
        weight = sum(w for s, w in weights.items() if s not in clamped)
        share = {s: w * rest / weight for s, w in weights.items() if s not in clamped}
        above = [s for s in share if share[s] > epochs * sizes[s]]
        if not above:
            return {**share, **clamped}
        for s in above:
            clamped[s] = epochs * sizes[s]


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 1000, "c": 50}, {"a": 1, "b": 1, "c": 10000, "d": 2}, {"a": 5, "b": 5, "c": 5}, {"a": 0, "b": 9, None: 4},
    {f"s{k:02}": (k * 37) % 101 for k in range(20)},
])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s))
    expected = fill(sizes, {s: k % 3 + 1 for k, s in enumerate(order)}, 3, sum(sizes.values()))
    for source in sizes:
        assert found[source] == pytest.approx(expected[source], abs=1e-6)


def test_near_target(spark):
    rows = mixing.with_repeats(documents(spark)).select("source", "mix.*").collect()
    taken, most, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    for source in target:
        assert abs(taken[source] - target[source]) <= most[source]


def test_same_mix_when_cells_are_not_broadcast(spark, monkeypatch):
    show = lambda: sorted(str(r) for r in mixing.with_repeats(documents(spark)).select("doc_id", "mix").collect())
    small = show()
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 0)
    assert show() == small


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = mixing.with_repeats(df, into="m").collect()
    assert len(rows) == df.count() and set(rows[0].asDict()) == {*df.columns, "m"}
    assert all(r["m"]["taken"] == r["m"]["repeats"] * r["m"]["size"] for r in rows)
    assert mixing.with_repeats(empty(spark)).count() == 0
    runs = [sorted(str(r) for r in mixing.with_repeats(df).select("doc_id", "mix").collect()) for _ in range(2)]
    assert runs[0] == runs[1]


def test_no_python(spark):
    plan = mixing.with_repeats(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
