"""What Python workers hold between tasks: one owner's things, dropped by tasks of others."""

from collections.abc import Iterator

import pyarrow as pa

from rankflow.llm import workers
from rankflow.llm.workers import kept, lean


def test_one_owner_at_a_time():
    made = []

    def make() -> int:
        made.append(1)
        return len(made)

    workers.drop_kept()
    assert [kept("a", make), kept("a", make), kept("b", make), kept("a", make)] == [1, 1, 2, 3]
    list(lean(iter, keeps=True)([0]))
    assert kept("a", make) == 3
    assert list(lean(iter)([1, 2])) == [1, 2]
    assert kept("a", make) == 4
    workers.drop_kept()


def test_tasks_of_one_worker(spark):
    """A task that keeps nothing drops what the worker's own module holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = len(workers._kept)
        kept("here", lambda: 0)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([held] * batch.num_rows, pa.int64())], ["held"])

    rows = spark.range(0, 8, 1, 1)
    first = rows.mapInArrow(lean(count), "held bigint").collect()
    assert {r.held for r in first} == {0} and len(first) == 8
    for _ in range(3):
        assert {r.held for r in rows.mapInArrow(lean(count), "held bigint").collect()} == {0}
    again = [rows.mapInArrow(lean(count, keeps=True), "held bigint").collect()[0].held for _ in range(12)]
    assert max(again) == 1


def test_memory_is_given_back_after_an_error():
    def broken(batches):
        yield 1
        raise ValueError("no")

    task = lean(broken)([])
    assert next(task) == 1
    try:
        next(task)
    except ValueError:
        pass
    else:
        raise AssertionError
