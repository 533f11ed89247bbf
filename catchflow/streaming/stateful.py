"""Stateful ingest (ST2): a time step's cells may arrive in any number of pieces (A1 over a stream).

Raster rows land as files, in any split: half of a step's cells today and the rest tomorrow, analysis variables first
and forecast pieces later. The rows meet the static coverage, each task adds its rows up per (catchment, time, variable)
before the shuffle, and a state per (catchment, time) keeps sums and counts. A step is emitted once: as soon as every
variable has all cells of the catchment, or when the watermark passes it, with NULL for what is incomplete (the poisoning
rule). An emitted step leaves a mark until the watermark passes, so a piece that comes again can't emit it twice; rows
behind the watermark are dropped.

A cell's value for a time and variable is expected once. The state is a few numbers for each open (catchment, time) and
lives in the query's checkpoint, so a lost executor or a restart resumes it; output batches are overwritten by retries.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.forcing import prepare_coverage
from ..session import ship_package

_PIECES = "basin_id string, divide_id string, ms bigint, variable int, s double, c double, n bigint, seen bigint, n_cells bigint"
_STATE = "done boolean, n_cells bigint, seen array<bigint>, n array<bigint>, s array<double>, c array<double>"
_KEYS = ["basin_id", "divide_id", "ms", "variable"]  # time as milliseconds since 1970 (UTC)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (keys, value, coverage, n_cells) -> one row for each key of an Arrow batch."""
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        have = pc.is_valid(t["value"])
        t = t.append_column("p", pc.multiply(t["value"], t["coverage"])).append_column("w", pc.if_else(have, t["coverage"], pa.scalar(0.0)))
        g = t.group_by(_KEYS).aggregate([("p", "sum"), ("w", "sum"), ("value", "count"), ("coverage", "count"), ("n_cells", "max")])
        g = g.select([*_KEYS, "p_sum", "w_sum", "value_count", "coverage_count", "n_cells_max"]).rename_columns([*_KEYS, "s", "c", "n", "seen", "n_cells"])
        yield from g.combine_chunks().to_batches()


def _keeper(variables: list[str]):
    """The state's update: pieces of one (basin, catchment, time) -> its row once it's complete, or late."""
    def run(key, pieces, state: GroupState):
        import pandas as pd
        basin, divide, ms = key
        if divide is None:
            return  # cells of no catchment: they only move the watermark

        def row(n_cells, n, s, c, complete: bool) -> pd.DataFrame:
            means = {v: [s[i] / c[i] if n[i] == n_cells and c[i] else None] for i, v in enumerate(variables)}
            out = pd.DataFrame({"basin_id": [basin], "divide_id": [divide], "ms": [ms], **means, "complete": [complete]})
            return out.astype({v: "float64" for v in variables})

        if state.hasTimedOut:
            done, n_cells, _, n, s, c = state.get
            state.remove()
            if not done:
                yield row(n_cells, n, s, c, False)
            return
        k = len(variables)
        done, n_cells, seen, n, s, c = state.get if state.exists else (False, 0, [0] * k, [0] * k, [0.0] * k, [0.0] * k)
        seen, n, s, c = list(seen), list(n), list(s), list(c)
        for p in pieces:
            for v, ps, pc_, pn, pseen, cells in p[["variable", "s", "c", "n", "seen", "n_cells"]].itertuples(index=False):
                seen[v] += int(pseen)
                n[v] += int(pn)
                s[v] += 0.0 if ps is None or ps != ps else float(ps)
                c[v] += float(pc_)
                n_cells = max(n_cells, int(cells))
        if not done and min(seen) >= n_cells:
            done = True
            yield row(n_cells, n, s, c, True)
        state.update((done, n_cells, seen, n, s, c))
        state.setTimeoutTimestamp(max(int(ms), state.getCurrentWatermarkMs() + 1))
    return run


def ingest_pieces(spark: SparkSession, src: str, schema: T.StructType | str, cov: DataFrame, variables: list[str], out: str, checkpoint: str,
                  delay: str = "2 days", max_files_per_trigger: int | None = None):
    """Start (and wait for) an ``availableNow`` run over the files in ``src`` not processed yet.

    ``src`` holds Parquet files of ``time, iy, ix, variable, value``. ``out`` gets ``basin_id, divide_id, time``, the
    variables' coverage-weighted means, and ``complete``. ``delay`` is how long a step waits for its pieces, in the
    archive's own time.
    """
    ship_package(spark)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    static = prepare_coverage(cov).select("basin_id", "divide_id", "iy", "ix", "coverage", "n_cells")
    index = F.array_position(F.array(*[F.lit(v) for v in variables]), F.col("variable")).cast("int") - 1
    utc = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("time").cast("timestamp_ntz"))
    rows = (reader.parquet(src).withColumn("ms", utc).withColumn("variable", index).where("variable >= 0").join(static, ["iy", "ix"], "left")
            .select(*_KEYS, "value", "coverage", "n_cells"))
    # a cell without a catchment has no coverage to add; its time still counts for the watermark
    pieces = rows.mapInArrow(_add_up, _PIECES).withColumn("time", F.timestamp_millis("ms")).withWatermark("time", delay)
    result = "basin_id string, divide_id string, ms bigint, " + ", ".join(f"`{v}` double" for v in variables) + ", complete boolean"
    emitted = (pieces.groupBy("basin_id", "divide_id", "ms")
               .applyInPandasWithState(_keeper(variables), result, _STATE, "append", GroupStateTimeout.EventTimeTimeout))
    when = F.timestamp_add("MICROSECOND", F.col("ms") * 1000, F.lit("1970-01-01").cast("timestamp_ntz")).alias("time")
    emitted = emitted.select("basin_id", "divide_id", when, *variables, "complete")

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = emitted.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
