from pathlib import Path

import numpy as np

from weftline.llm.common import freeing, tasks_for


def resident():
    """MB of this process that are in memory."""
    return int(Path("/proc/self/statm").read_text().split()[1]) / 256


def test_workers_give_memory_back():
    kept = []

    def run(batches):
        some = [np.ones(8000) for _ in range(3000)]
        kept.append(some[-1])
        yield from batches

    before = resident()
    assert list(freeing(run)(iter("ab"))) == ["a", "b"]
    assert resident() - before < 90


def test_tasks_follow_rows(spark):
    least = 2 * spark.sparkContext.defaultParallelism
    assert [tasks_for(spark, n, 10) for n in (0, 10 * least, 10 * least + 1)] == [least, least, least + 1]
