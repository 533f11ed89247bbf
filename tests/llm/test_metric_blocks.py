import numpy as np
from brute import vector_links
from test_joins_and_dedup import key, vectors

from catchflow.llm import metric_join


def test_blocks_are_cut_at_the_cell_however_far_apart_pivots_are(spark, monkeypatch):
    seen, dealer = [], metric_join._dealer
    monkeypatch.setattr(metric_join, "_dealer", lambda cells, count_only: (seen.append(dict(cells.blocks)), dealer(cells, count_only))[1])
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    exact = [(r[0], [None if x is None else float(np.float32(x)) for x in r[1]] if r[1] is not None else None, r[2]) for r in rows]
    got = metric_join.link_embeddings(df, cell=10, pivots=2).collect()
    assert key((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == key(vector_links(exact))
    assert sum(seen[-1].values()) >= 9  # over 130 distinct vectors; without it one block holds a label
