import shutil

import numpy as np
import pyarrow as pa
import pytest
from brute import near_groups, repeats
from llm_rows import DOC, SF, tricky_rows
from test_tokens_packing_files import library_ids

import corpus_pipeline
from catchflow.llm import mixing, toxicity
from catchflow.llm.common import keep_table
from catchflow.llm.quality_classifier import held_out


def stages(spark, docs, sf):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(keep_table(stage(spark, out[-1], sf), "test-stage"))
    return out


@pytest.fixture(scope="module")
def whole(spark):
    return stages(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)


def test_each_stage_equals_a_plain_version(spark, whole):
    docs, calm, single, cut, mixed, packed = [w.collect() for w in whole]
    names = whole[0].columns
    assert all(w.columns == names for w in whole[1:5])
    # toxicity: the network's own scores decide
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    net = toxicity.fit(whole[0], labels.where(~held_out(5, 0)))
    buf = [r["text"].encode() for r in docs]
    logits = toxicity.document_logits(net, np.frombuffer(b"".join(buf), np.uint8), np.append(0, np.cumsum([len(b) for b in buf])))
    assert sorted(r["doc_id"] for r in calm) == sorted(r["doc_id"] for r, s in zip(docs, net.score(logits)) if s < 0.5)
    # one document of each group of near-duplicates
    groups = near_groups([(r["doc_id"], r["text"]) for r in calm], percent=80, k=5)
    assert sorted(r["doc_id"] for r in single) == sorted({c for _, _, c in groups})
    # later copies of repeated strings
    want = {i: kept.decode("utf-8", "ignore") for i, _, _, _, kept in repeats(sorted((r["doc_id"], r["text"]) for r in single))}
    assert {r["doc_id"]: r["text"] for r in cut} == want and all(r["n_chars"] == len(r["text"]) for r in cut)
    # copies
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_documents(whole[3]).collect()}
    got = {}
    for r in mixed:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
        assert r["text"] == want[r["doc_id"]]
    assert got == {k: v for k, v in copies.items() if v}
    # every id of every copy is packed
    assert sum(r["length"] for r in packed) == sum(len(library_ids("word_bpe_49k.json", r["text"], 1)) for r in mixed)


def test_run_equals_the_stages(spark, whole):
    def ids(rows):  # where a leftover is cut depends on the order of equal lengths; what is packed doesn't
        total = {}
        for r in rows:
            k = (r["doc_id"], r["doc_tokens"])
            total[k] = total.get(k, 0) + r["length"]
        return total
    assert ids(corpus_pipeline.run(spark, SF).collect()) == ids(whole[5].collect())


def test_tricky_and_empty_tables_pass_through(spark, tricky_clash, none, tmp_path):
    shutil.copy(f"{SF}/labels.parquet", tmp_path / "labels.parquet")
    for docs, rows in ((tricky_clash, len(tricky_rows())), (none, 0)):
        out = stages(spark, docs, str(tmp_path))
        assert all(w.columns == docs.columns and [f.dataType for f in w.schema] == [f.dataType for f in docs.schema] for w in out[1:5])
        n = [w.count() for w in out]
        assert n[0] == rows and (n[-1] > 0) == (rows > 0)
    assert spark.createDataFrame([], DOC).columns == none.columns


def test_texts_go_to_python_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    try:
        for now, then in (("10000", 1000), ("0", 1000), ("200", 200)):
            spark.conf.set(name, now)
            corpus_pipeline.small_batches(spark)
            sizes = spark.range(0, 2500, 1, 1).mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"id": [b.num_rows]}) for b in it), "id long").collect()
            assert max(r["id"] for r in sizes) == then
    finally:
        spark.conf.set(name, was)
