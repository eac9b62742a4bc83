from weirflow.llm import common


class Task:
    number = 1

    def taskAttemptId(self):
        return self.number


def test_a_worker_lets_go_of_what_earlier_tasks_left(monkeypatch):
    task, made = Task(), []
    monkeypatch.setattr(common.TaskContext, "get", staticmethod(lambda: task))
    monkeypatch.setitem(common.worker_store("things"), "of a stage before", (object(), 0))
    make = lambda name: common.made_once(name, lambda: made.append(name) or name)
    assert [make("a"), make("b"), make("a")] == ["a", "b", "a"]
    assert set(common.worker_store("things")) == {"a", "b"}
    task.number = 2  # the next task of the stage uses the same things
    assert [make("a"), make("b")] == ["a", "b"] and made == ["a", "b"]
    task.number = 3
    make("c")
    assert set(common.worker_store("things")) == {"c"}
