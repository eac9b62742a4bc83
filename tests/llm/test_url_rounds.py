"""Rounds of ranks that one task does take nothing through the driver."""

import pytest

from weirflow.llm import url_graph


def test_rounds_of_a_small_graph_broadcast_nothing(spark, monkeypatch):
    plans = []
    write = url_graph.write_table

    def noted(df, name):
        if name == "url-ranks":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(url_graph, "write_table", noted)
    edges = spark.createDataFrame([("a.org", "b.org"), ("b.org", "c.org"), ("c.org", "a.org"), ("d.org", "c.org")], "src string, dst string")
    seeds = spark.createDataFrame([("trust", "a.org", 1.0), ("distrust", "c.org", 1.0)], "kind string, host string, weight double")
    ranks = {r["host"]: (r["trust"], r["distrust"]) for r in url_graph.propagate(edges, seeds).collect()}
    # On the cycle a -> b -> c -> a trust falls by the damping with each step; distrust goes backwards, half of c's to d.
    whole = 1 + 0.85 + 0.85**2
    assert [ranks[f"{h}.org"][0] for h in "abc"] == pytest.approx([1 / whole, 0.85 / whole, 0.85**2 / whole])
    assert ranks["d.org"][1] == pytest.approx(ranks["b.org"][1])
    assert plans and not any("Broadcast" in p or "Exchange" in p for p in plans)
