import tracemalloc

import numpy as np
import pyarrow as pa

from catchflow.llm import common, packing, suffix_dedup
from catchflow.llm.common import text_bytes

LENGTH, ROUTES = 100, 3


def _peak(make) -> float:
    """MB that Python and numpy hold at most while ``make`` runs."""
    tracemalloc.start()
    try:
        make()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def _chunk(mb: float):
    """A chunk whose texts repeat passages of each other, and the anchors that the corpus has twice."""
    rng = np.random.default_rng(5)
    passages = rng.integers(97, 123, (400, 500), np.uint8)
    texts = [passages[rng.integers(0, 400, 8)].tobytes().decode() for _ in range(int(mb * 250))]
    names = [f"{i:032x}" for i in range(len(texts))]
    left = pa.table({"chunk": pa.array([0] * len(texts), pa.int32()), "md5": names, "text": texts})
    buf, offs = text_bytes(pa.array(texts))
    h = np.unique(np.concatenate([suffix_dedup.anchor_runs(b, o, LENGTH)[3] for _, _, b, o in common.blocks(buf, offs)]))
    route = (h >> np.uint64(31)) % np.uint64(ROUTES)
    lists = [(h[route == r] & np.uint64(0x7FFFFFFF)).astype("<u4").tobytes() for r in range(ROUTES)]
    right = pa.table({"chunk": pa.array([0] * (ROUTES + len(texts)), pa.int32()), "kind": pa.array([1] * ROUTES + [0] * len(texts), pa.int32()),
                      "number": pa.array([*range(ROUTES), *range(len(texts))], pa.int64()),
                      "data": pa.array([*lists, *[m.encode() for m in names]], pa.binary())})
    return left, right


def test_a_chunk_takes_little_memory_beside_its_texts():
    left, right = _chunk(4)
    assert _peak(lambda: suffix_dedup._runs_of(ROUTES, LENGTH)(left, right)) < 90
    out = suffix_dedup._runs_of(ROUTES, LENGTH)(left, right)
    batches = out.combine_chunks().to_batches()
    assert _peak(lambda: list(suffix_dedup._suffix_task(LENGTH)(iter(batches)))) < 60


def test_groups_come_back_and_freed_memory_goes(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    t = pa.table({"a": [1, 2]})
    assert common.trimmed_groups(lambda x, y: pa.concat_tables([x, y]))(t, t).to_pydict() == {"a": [1, 2, 1, 2]}
    assert len(calls) == 1


def test_all_tasks_of_dedup_and_packing_give_memory_back(spark, monkeypatch):
    made = []

    def noted(run):
        made.append(run)
        return run
    for module in (suffix_dedup, packing):
        monkeypatch.setattr(module, "trimmed", noted)
    monkeypatch.setattr(suffix_dedup, "trimmed_groups", noted)
    docs = spark.createDataFrame([(i, "some words " * 20 + str(i)) for i in range(4)], "doc_id long, text string")
    suffix_dedup.remove_repeats(docs)
    assert len(made) == 6
    packing.pack_documents(docs, 64)
    assert len(made) == 8
