import glob

import pytest
from llm_rows import DOC
from pyspark.sql import functions as F

import corpus_pipeline
from catchflow.llm import common, graph, suffix_dedup
from catchflow.llm.common import keep_table, marks, parted


def shuffled(df) -> set[str]:
    """Names of the columns that the plan of ``df`` shuffles."""
    found, open_ = set(), [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            open_.append(node.initialPlan())
            continue
        if name == "Exchange":
            out = node.output()
            found |= {out.apply(i).name() for i in range(out.size())}
        kids = node.children()
        open_ += [kids.apply(i) for i in range(kids.size())]
    return found


def rows(spark, n=60):
    """Texts that come twice, nearly twice and once, with ids that come twice, and null ones."""
    out = []
    for i in range(n):
        body = " ".join(f"w{i}x{j}" for j in range(60))
        out.append((i if i % 7 else None, body + ("" if i % 3 else " tail"), "en", "s", i))
        if i % 4 == 0:
            out.append((1000 + i % 8, body, "de", "t", i))
    return spark.createDataFrame(out + [(5, "short", "en", "s", 1), (6, "short", "en", "s", 2), (7, None, "en", "s", 3)], DOC)


@pytest.fixture
def kept(spark):
    """The names of the tables written since."""
    def there() -> set[str]:
        return set(glob.glob(f"{common.shared_path(spark, '').removeprefix('file:').rsplit('/', 1)[0]}/*"))
    common.prepare(spark)
    before = there()
    return lambda: sorted(f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in there() - before)


@pytest.mark.parametrize("bits", (1, 18))
def test_parted_rows_are_all_rows_and_no_key_is_surely_none(spark, monkeypatch, bits):
    monkeypatch.setattr(common, "WORD_BITS", bits)
    df = spark.createDataFrame([(i, f"t{i}") for i in range(2000)] + [(None, "n")], "k long, text string")
    for keys in (range(0, 2000, 9), []):
        found = parted(df, "k", marks(spark.createDataFrame([(i,) for i in keys], "k long"), "k"))
        sure, maybe = ([r["k"] for r in x.collect()] for x in found)
        assert sorted(map(str, sure + maybe)) == sorted(map(str, [*range(2000), None]))
        assert set(keys) <= set(maybe) and (bits == 1 or len(maybe) < 240)
        assert "text" not in shuffled(found[0])


def test_ngram_stage_shuffles_no_text_that_stays_and_drops_its_tables(spark, kept):
    docs = keep_table(rows(spark), "stage-disk-docs")
    out = corpus_pipeline.ngram_join_stage(spark, docs, "")
    text = f"c_{docs.columns.index('text')}"
    assert out._jdf.queryExecution().optimizedPlan().children().size() == 2  # those that stay, and those that may go
    stay = out._jdf.queryExecution().optimizedPlan().children().apply(0).toString()
    assert "LeftSemi" not in stay and "LeftAnti" not in stay and text in stay
    assert not {"group-texts", "edges-large"} & set(kept()) and {"pipeline-rows", "pipeline-gone"} <= set(kept())
    assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert out.count() == 62 and out.where("text IS NULL").count() == 1


def test_graph_keeps_its_last_edges_alone(spark, kept):
    path = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").repartition(7)
    assert {tuple(r) for r in graph.components(path).collect()} == {(i, 0) for i in range(301)}
    assert kept() == ["edges"]


def test_what_is_left_of_texts_is_not_shuffled(spark):
    docs = rows(spark).withColumn("at", F.lit("2024-01-01").cast("timestamp"))
    out = suffix_dedup.remove_repeats(docs, with_text=True, as_text=True)
    assert "r_kept" not in shuffled(out)
    got = sorted(map(str, (tuple(r) for r in out.select("doc_id", "lang", "source", "n_chars", "at", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())))
    slim = suffix_dedup.remove_repeats(docs).select("doc_id", "lang", "source", "n_chars", "at", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(map(str, (tuple(r) for r in slim.collect())))
