"""Tabular series sources (S5-S9, S11): explicit schemas, ids from file paths, never inferred."""

from __future__ import annotations

import csv
import io
import os
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..schemas import NEXUS_SERIES, clean_doubles


def scan_series(spark: SparkSession, paths: str | list[str], schema: T.StructType | str, time_col: str,
                fmt: str = "yyyy-MM-dd HH:mm:ss", on_bad_time: str = "error", header: bool = True,
                with_path: bool = False, recursive: bool = False) -> DataFrame:
    """S5 + D4: headered CSV with the time column read as text and parsed strictly or leniently.

    Partition folders (``key=value``) become columns; ``recursive`` reads files in any sub-folder
    instead (no partition columns); ``with_path`` adds ``source_path``.
    """
    reader = spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.csv(paths)
    if with_path:
        df = df.withColumn("source_path", F.col("_metadata.file_path"))
    parsed = S.parse_time(time_col, fmt, strict=(on_bad_time == "error"))
    return clean_doubles(df.withColumn(time_col, parsed))


def scan_nexus(spark: SparkSession, root: str, on_bad_time: str = "error") -> DataFrame:
    """Headerless ``index, datetime, value`` files; the nexus id comes from ``nex-<id>_output`` in the path."""
    df = (spark.read.schema(NEXUS_SERIES).option("header", False).option("mode", "FAILFAST").option("recursiveFileLookup", "true")
          .csv(root).withColumn("_path", F.col("_metadata.file_path")))
    nid = F.regexp_extract("_path", _NEXUS_ID, 1)
    out = df.select(nid.alias("nex_id"), "index",
                    S.parse_time("datetime", strict=(on_bad_time == "error")).alias("datetime"), "value")
    return clean_doubles(out)


_HELD = 1 << 22  # characters of lines that leave a task at a time
_NEXUS_ID = r"nex-([^_/]+)_output"


def scan_nexus_values(spark: SparkSession, root: str) -> DataFrame:
    """``nex_id, index, value`` of :func:`scan_nexus`, for folders of so many files that no driver can hold their list.

    Tasks list the folders, level by level, into a written table, and read the files in it, each as a whole: no name of a
    file reaches the driver. Hidden and compressed files, blank lines and lines that aren't ``index, datetime, value``
    are treated as Spark's reader treats them when ``datetime`` isn't asked for. What Python can't list (a pattern, a
    single file, a file system that ``pyarrow.fs`` doesn't know, nothing at all) goes to :func:`scan_nexus`.
    """
    from ..session import ship_package, written
    if not _listable(root):
        return scan_nexus(spark, root).select("nex_id", "index", "value")
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entry = "path string, folder boolean"
    level, files = spark.createDataFrame([("", True)], entry), None
    while level is not None:
        found = written(level.select("path").repartition(n, "path").mapInArrow(_lister(root), entry), "nexus-files")
        here = found.where("NOT folder").select("path")
        files = here if files is None else files.union(here)
        below = found.where("folder")
        level = below if below.limit(1).count() else None
    lines = files.repartition(n, "path").mapInArrow(_line_reader(root), "nex_id string, line string")
    z = F.from_csv("line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in NEXUS_SERIES), {"mode": "FAILFAST"})
    return clean_doubles(lines.select("nex_id", z.alias("z")).select("nex_id", "z.index", "z.value"))


def _listable(root: str) -> bool:
    from pyarrow import fs as pafs
    from .chunks import file_system
    if not isinstance(root, str) or re.search(r"[*?\[\]{}\\]", root):
        return False
    try:
        fs, base = file_system(root)
        return fs.get_file_info(base.rstrip("/") or "/").type == pafs.FileType.Directory
    except (pa.ArrowException, OSError, ValueError):
        return False


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _lister(root: str):
    """Folders (paths below ``root``) -> what is in them, 10,000 names at a time."""
    def entries(fs, folder: str) -> Iterator[tuple[str, bool]]:
        from pyarrow import fs as pafs
        if isinstance(fs, pafs.LocalFileSystem):  # a name at a time, however many there are
            with os.scandir(folder) as found:
                yield from ((x.name, x.is_dir()) for x in found)
        else:
            yield from ((i.base_name, i.type == pafs.FileType.Directory) for i in fs.get_file_info(pafs.FileSelector(folder)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .chunks import file_system
        fs, base = file_system(root)

        def batch(held):
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.string()), pa.array([x[1] for x in held], pa.bool_())], names=["path", "folder"])

        for b in batches:
            for below in b.column("path").to_pylist():
                held = []
                for name, folder in entries(fs, f"{base.rstrip('/')}/{below}"):
                    if not _hidden(name):
                        held.append((f"{below}/{name}" if below else name, folder))
                    if len(held) >= 10_000:
                        yield batch(held)
                        held = []
                yield batch(held)
    return run


def _uri(path: str) -> str:
    """``path`` with characters escaped as in Spark's ``_metadata.file_path``."""
    return re.sub(r"[^A-Za-z0-9/_!.~'()*,;:$&+=@-]", lambda m: quote(m[0], safe="") if m[0] < "\x80" or not m[0].isprintable() else m[0], path)


def _three(line: str) -> str:
    """A line with more or fewer than three values as one with three."""
    values = (next(csv.reader([line], escapechar="\\"), []) + ["", ""])[:3]
    out = io.StringIO()
    csv.writer(out, lineterminator="", escapechar="\\", doublequote=False).writerow(values)
    return out.getvalue()


def _line_reader(root: str):
    """Paths of files below ``root`` -> (nex_id, line) of their lines that aren't blank."""
    blank = "".join(map(chr, range(33)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .chunks import file_system
        fs, base = file_system(root)
        ids, lines, held = [], [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(lines, pa.string())], names=["nex_id", "line"])

        for b in batches:
            for below in b.column("path").to_pylist():
                path = f"{base.rstrip('/')}/{below}"
                m = re.search(_NEXUS_ID, _uri(path))
                nid = m[1] if m else ""
                with fs.open_input_stream(path) as f, io.TextIOWrapper(f, "utf-8-sig", "replace", newline=None) as text:
                    while some := text.readlines(_HELD):
                        for line in some:
                            line = line.rstrip("\n")
                            if line.count(",") != 2 or '"' in line:
                                if not line.strip(blank):
                                    continue
                                line = _three(line)
                            ids.append(nid)
                            lines.append(line)
                            held += len(line) + len(nid)
                        if held >= _HELD:
                            yield batch()
                            ids, lines, held = [], [], 0
        if ids:
            yield batch()
    return run


def scan_routed(spark: SparkSession, path: str, time_col: str = "Time", value_col: str = "flow") -> DataFrame:
    """Routed-flow array table (one row per feature, arrays over time) -> long rows with ``time_idx``."""
    df = spark.read.parquet(path)
    keys = [c for c in df.columns if c not in (time_col, value_col)]
    z = df.select(*keys, F.posexplode(F.arrays_zip(F.col(time_col).alias("t"), F.col(value_col).alias("v"))).alias("time_idx", "z"))
    return clean_doubles(z.select(*keys, F.col("time_idx").cast("int"), F.col("z.t").alias("time"), F.col("z.v").alias(value_col)))


def scan_reference(spark: SparkSession, path: str) -> DataFrame:
    """Reference forcing ``basin, date, total_precipitation`` (Parquet long table)."""
    return clean_doubles(spark.read.parquet(path))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S9."""
    return spark.read.parquet(path)


def scan_daily_basin_files(spark: SparkSession, root: str, schema: T.StructType | str, time_col: str = "time",
                           id_pattern: str = r"basin_id=([^/]+)") -> DataFrame:
    """S11 + U5: every daily file of every basin in one read; the basin id is parsed from the path
    (exact match on the parsed id, not a substring test)."""
    df = (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("recursiveFileLookup", "true").csv(root)
          .withColumn("basin_id", F.regexp_extract(F.col("_metadata.file_path"), id_pattern, 1)))
    return clean_doubles(df.withColumn(time_col, S.parse_time(time_col)))


def scan_raster_table(spark: SparkSession, path: str, years: tuple[int, int] | None = None,
                      extent: tuple[int, int, int, int] | None = None, tile: int = 64,
                      variables: list[str] | None = None) -> DataFrame:
    """S1 on the partitioned raster table: ``years = (begin, end)`` with the end exclusive, and an optional
    cell ``extent = (iy0, iy1, ix0, ix1)`` (inclusive). Both become literal predicates: partition
    filters on ``year``/``ty``/``tx`` and pushed filters on ``iy``/``ix``."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.filter((F.col("year") >= years[0]) & (F.col("year") < years[1]))
    if extent is not None:
        iy0, iy1, ix0, ix1 = extent
        df = df.filter(F.col("ty").between(iy0 // tile, iy1 // tile) & F.col("tx").between(ix0 // tile, ix1 // tile)
                       & F.col("iy").between(iy0, iy1) & F.col("ix").between(ix0, ix1))
    cols = ["time", "iy", "ix"] + (variables or [c for c in df.columns if c not in ("time", "iy", "ix", "year", "ty", "tx")])
    return df.select(*cols)
