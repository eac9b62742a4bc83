import random

import pandas as pd
from helpers import docs_of, prose
from weirflow.llm import bpe, common


class Task:
    number = 1

    def taskAttemptId(self):
        return self.number


def test_a_step_that_makes_nothing_lets_go_of_what_other_stages_left(monkeypatch):
    task = Task()
    monkeypatch.setattr(common.TaskContext, "get", staticmethod(lambda: task))
    monkeypatch.setitem(common.worker_store("things"), "of a stage before", (object(), 0))
    common.made_once("own", object)
    common.let_go()
    assert set(common.worker_store("things")) == {"own"}
    task.number = 2
    common.let_go()
    assert not common.worker_store("things")


def test_words_met_by_a_task_go_with_it(spark):
    def held(batches):
        for _ in batches:
            pass
        things = [thing for thing, _ in common.worker_store("things").values()]
        words = [len(t.recent.young) for t in things if hasattr(t, "recent")]
        tables = [len(getattr(t, name)) for t in things for name in ("_follows", "_ends", "_made") if hasattr(t, name)]
        yield pd.DataFrame({"things": [len(things)], "kept": [sum(words + tables)]})

    rng = random.Random(7)
    docs = docs_of(common.prepared(spark), [prose(rng, 200) for _ in range(80)]).repartition(4)
    digests = bpe.token_digests(docs)
    first = sorted(digests.collect())
    found = docs.select("doc_id").mapInPandas(held, "things long, kept long").collect()
    assert max(r.things for r in found) > 0  # some of these are workers that have encoded
    assert max(r.kept for r in found) == 0
    assert sorted(digests.collect()) == first  # and a worker that comes back gives the same
