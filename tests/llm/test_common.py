import numpy as np
import pyarrow as pa
from brute import WORD
from hypothesis import given, settings
from hypothesis import strategies as st

from catchflow.llm import common

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("ab é中\t\n\x0b\r 　\x1c"), max_size=30)), max_size=20)


@settings(max_examples=120, deadline=None)
@given(TEXTS, st.integers(1, 40), st.booleans())
def test_blocks_hold_the_same_words(texts, size, wide):
    col = pa.array(["skipped", *texts], pa.large_string() if wide else pa.string())[1:]
    buf, offs = common.text_bytes(col)
    got = []
    for lo, hi, b, o in common.blocks(buf, offs, size):
        starts, ends, doc = common.words(b, o)
        rows = [[] for _ in range(hi - lo)]
        for s, e, d in zip(starts, ends, doc):
            rows[d].append(b[s:e].tobytes().decode())
        got += rows
    assert got == [WORD.findall(t or "") for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=12), max_size=30))
def test_equal_spans_have_equal_hashes(parts):
    buf = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64) if parts else np.zeros(0, np.int64)
    h = common.span_hashes(buf, ends - np.array([len(p) for p in parts], np.int64), ends) if parts else []
    assert len(set(zip(parts, map(int, h)))) == len(set(parts)) == len(set(map(int, h)))


def test_offsets_equal_plain_sums(spark):
    rng = np.random.default_rng(4)
    rows = [(k, int(o), int(rng.integers(0, 9))) for k in ("a", "b", None) for o in rng.choice(5000, 40, replace=False)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    for block in (7, 1024):
        got = {(r["k"], r["o"]): r["before"] for r in common.running_offsets(df, ["k"], "o", "v", "before", block).collect()}
        assert got == {(k, o): sum(x for j, p, x in rows if j == k and p < o) for k, o, _ in rows}
    assert common.running_offsets(df.limit(0), ["k"], "o", "v", "before").count() == 0


def test_trimmed_gives_all_rows_and_frees_memory():
    import numpy as np
    import pyarrow as pa
    from catchflow.llm import common

    def run(batches):
        for b in batches:
            pa.array(np.arange(1 << 20))  # Arrow's pool holds on to what it frees
            yield b
    batches = [pa.RecordBatch.from_pydict({"a": [i, i + 1]}) for i in range(3)]
    assert [b.to_pydict() for b in common.trimmed(run)(iter(batches))] == [b.to_pydict() for b in batches]
