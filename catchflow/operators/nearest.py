"""Nearest covered feature (J3, G2, W2) by a packed two-level tree of bounding boxes.

Covered features are packed by sort-tile-recursion: quantiles of the box centres' x give slabs, quantiles of y within
a slab give leaves of about ``LEAF`` features. The slabs (about ``sqrt(n / LEAF)`` of them) are the upper level and go
along as a literal; the leaves of a slab are one array in one row.

Nested basins hold the same catchments again, so features of equal rings are one shape on either side: of covered ones
the smallest ``source_id``, then ``source_basin``, stands for its shape, and a shape in need is searched once for all
features that have it. A shape in need is answered in a fixed number of steps, whatever the distances:

1. a first bound from one member of the leaf its own centre falls into (vertex to vertex, so never too small);
2. the slabs whose box comes within the bound, then the leaves within those (equi-join on the slab);
3. best first: of its nearest leaf the member with the nearest box, whose exact distance tightens the bound;
4. of all leaves whose box is nearer than that bound, the members whose own box is.

Exact polygon distances are computed for the members of steps 3 and 4 alone, and their pairs are dealt evenly over
tasks. Every join is an equi-join on slab, leaf or shape, so far-away features and clusters spread over tasks and no
feature meets all others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..session import written

LEAF = 64
FOUND = "basin_id string, divide_id string, source_basin string, source_id string, dist double"


def has_geometry(rings: str | Column) -> Column:
    """Whether there is at least one vertex; null and empty rings have no place."""
    return F.coalesce(F.exists(rings, lambda r: F.size(r["pts"]) > 0), F.lit(False))


def box_distance(a: Column, b: Column) -> Column:
    """Distance between two boxes: no polygon in one is nearer to any in the other."""
    dx = F.greatest(F.lit(0.0), a["xmin"] - b["xmax"], b["xmin"] - a["xmax"])
    dy = F.greatest(F.lit(0.0), a["ymin"] - b["ymax"], b["ymin"] - a["ymax"])
    return F.sqrt(dx * dx + dy * dy)


def _within(bound: Column) -> Column:
    """The bound, wide enough for the rounding of box and polygon distances."""
    return bound * (1 + 1e-9) + 1e-12


def _band(value: Column, cuts: Column) -> Column:
    """How many cuts are at or below the value."""
    return F.size(F.filter(cuts, lambda c: c <= value))


def _cuts(column: str, parts: int) -> Column:
    """The inner quantiles for ``parts`` bands (approximate: they balance the tree and decide nothing else)."""
    if parts < 2:
        return F.array().cast("array<double>")
    return F.percentile_approx(column, F.array(*[F.lit(i / parts) for i in range(1, parts)]), F.lit(10_000))


def pack_tree(covered: DataFrame, leaf: int = LEAF) -> tuple[DataFrame, DataFrame, list, list]:
    """``covered`` (mid, source_basin, source_id, src_rings, src_bb) -> members with their leaf, a row a slab with its leaves,
    the slabs' cuts and the slabs' boxes (both of about ``sqrt(n / leaf)`` entries)."""
    n = covered.count()
    slabs = max(1, math.ceil(math.sqrt(n / leaf)))
    bands = max(1, math.ceil(n / (slabs * leaf)))
    c = covered.withColumn("cx", (F.col("src_bb.xmin") + F.col("src_bb.xmax")) / 2).withColumn("cy", (F.col("src_bb.ymin") + F.col("src_bb.ymax")) / 2)
    x_cuts = c.agg(_cuts("cx", slabs).alias("cuts")).first()["cuts"] or []
    c = c.withColumn("slab", _band(F.col("cx"), F.lit(x_cuts) if x_cuts else F.array().cast("array<double>")))
    y_cuts = c.groupBy("slab").agg(_cuts("cy", bands).alias("y_cuts"))
    c = written(c.join(y_cuts, "slab").withColumn("leaf", _band(F.col("cy"), F.col("y_cuts"))).drop("cx", "cy"), "nearest-members")
    first = F.element_at(F.filter(F.flatten(F.transform("src_rings", lambda r: r["pts"])), lambda p: p.isNotNull()), 1)
    box = F.struct(*[f(f"src_bb.{k}").alias(k) for f, k in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))])
    leaves = c.groupBy("slab", "leaf").agg(box.alias("box"), F.min(F.struct("source_id", "source_basin", first.alias("pt")))["pt"].alias("pt"))
    tree = written(leaves.groupBy("slab").agg(F.collect_list(F.struct("leaf", "box", "pt")).alias("leaves"))
                   .join(y_cuts, "slab"), "nearest-tree")
    boxes = tree.select("slab", F.explode("leaves").alias("l")).groupBy("slab").agg(
        F.min("l.box.xmin").alias("xmin"), F.min("l.box.ymin").alias("ymin"), F.max("l.box.xmax").alias("xmax"), F.max("l.box.ymax").alias("ymax")).collect()
    return c, tree, x_cuts, boxes


def nearest(missing: DataFrame, covered: DataFrame, leaf: int = LEAF) -> DataFrame:
    """``missing`` (basin_id, divide_id, rings) and ``covered`` (the same) -> the nearest covered feature of each.

    Output ``basin_id, divide_id, source_basin, source_id, dist``; ties go to the smallest ``source_id``, then
    ``source_basin``. Features without geometry on either side take no part (see :func:`has_geometry`); without covered
    features there are no rows.
    """
    spark = missing.sparkSession
    shape = [F.xxhash64("rings").alias("rings_hash"), "rings"]  # the hash first: few long arrays are compared
    src = (covered.where(has_geometry("rings")).groupBy(*shape)
           .agg(F.min(F.struct(F.col("divide_id").alias("source_id"), F.col("basin_id").alias("source_basin"))).alias("s"))
           .select(F.monotonically_increasing_id().alias("mid"), "s.source_basin", "s.source_id", F.col("rings").alias("src_rings"), geo.bbox(F.col("rings")).alias("src_bb")))
    asked = missing.where(has_geometry("rings")).select("basin_id", "divide_id", *shape)
    need = asked.select("rings_hash", "rings").distinct().select(F.monotonically_increasing_id().alias("shape"), "rings_hash", "rings", geo.bbox(F.col("rings")).alias("bb"))
    members, tree, x_cuts, boxes = pack_tree(written(src, "nearest-covered"), leaf)
    if not boxes:  # nothing to copy from: no feature can be filled
        return spark.createDataFrame([], FOUND)
    # 1. the bound from the leaf that the feature's own centre falls into; any leaf would do
    cx, cy = (F.col("bb.xmin") + F.col("bb.xmax")) / 2, (F.col("bb.ymin") + F.col("bb.ymax")) / 2
    filled = sorted(b["slab"] for b in boxes)
    own = F.coalesce(F.array_max(F.filter(F.lit(filled), lambda s: s <= _band(cx, F.lit(x_cuts) if x_cuts else F.array().cast("array<double>")))), F.lit(filled[0]))
    need = written(need.withColumn("own", own).withColumn("cy", cy), "nearest-need")
    mine = F.element_at(F.sort_array(F.transform("leaves", lambda x: F.struct(F.abs(x["leaf"] - _band(F.col("cy"), F.col("y_cuts"))).alias("off"), x["leaf"].alias("leaf"), x["pt"].alias("pt")))), 1)
    start = F.element_at(F.filter(F.flatten(F.transform("rings", lambda r: r["pts"])), lambda p: p.isNotNull()), 1)
    bounded = (need.join(tree, need["own"] == tree["slab"]).withColumn("pt", mine["pt"]).withColumn("start", start)
               .withColumn("bound", F.sqrt(F.pow(F.col("pt.x") - F.col("start.x"), F.lit(2.0)) + F.pow(F.col("pt.y") - F.col("start.y"), F.lit(2.0))))
               .select("shape", "bb", "bound"))
    # 2. slabs, then leaves within the bound
    level = F.array(*[F.struct(F.lit(b["slab"]).alias("slab"), F.struct(*[F.lit(float(b[k])).alias(k) for k in ("xmin", "ymin", "xmax", "ymax")]).alias("box")) for b in boxes])
    near_slabs = F.filter(level, lambda s: box_distance(s["box"], F.col("bb")) <= _within(F.col("bound")))
    hit = bounded.select("shape", "bb", "bound", F.explode(F.transform(near_slabs, lambda s: s["slab"])).alias("slab")).join(tree.select("slab", "leaves"), "slab")
    low = F.filter(F.transform("leaves", lambda x: F.struct(box_distance(x["box"], F.col("bb")).alias("low"), x["leaf"].alias("leaf"))),
                   lambda x: x["low"] <= _within(F.col("bound")))
    hits = written(hit.select("shape", "bb", "bound", "slab", F.inline(low)), "nearest-leaves")
    boxed = members.select("slab", "leaf", "mid", "src_bb")

    def measured(pairs: DataFrame) -> DataFrame:
        """``pairs`` (shape, mid) -> the nearest member of each shape; the distances are dear, so no task gets more than its share."""
        both = (pairs.join(members.select("mid", "source_basin", "source_id", "src_rings"), "mid").join(need.select("shape", "rings"), "shape")
                .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shape", "mid"))
        exact = geo.with_polygon_distance(both.select("shape", "rings", "source_basin", "source_id", "src_rings"), "rings", "src_rings", "dist")
        return exact.groupBy("shape").agg(F.min(F.struct("dist", "source_id", "source_basin")).alias("b"))

    # 3. the member of the nearest leaf whose box is nearest
    best_leaf = hits.groupBy("shape").agg(F.min(F.struct("low", "slab", "leaf", "bb")).alias("b")).select("shape", "b.slab", "b.leaf", "b.bb")
    best = (best_leaf.join(boxed, ["slab", "leaf"]).groupBy("shape").agg(F.min(F.struct(box_distance(F.col("src_bb"), F.col("bb")).alias("low"), "mid")).alias("m"))
            .select("shape", "m.mid"))
    first = written(measured(best), "nearest-first")
    # 4. what is as near as that
    near = (hits.join(first.select("shape", F.col("b.dist").alias("d0")), "shape", "left")
            .withColumn("bound", F.least("bound", F.coalesce("d0", "bound"))).where(F.col("low") <= _within(F.col("bound")))
            .join(boxed, ["slab", "leaf"]).where(box_distance(F.col("src_bb"), F.col("bb")) <= _within(F.col("bound")))
            .select("shape", "mid"))
    found = (first.union(measured(near)).groupBy("shape").agg(F.min("b").alias("b"))
             .join(need.select("shape", "rings_hash", "rings"), "shape").select("rings_hash", "rings", "b"))
    return (asked.join(found, ["rings_hash", "rings"]).groupBy("basin_id", "divide_id").agg(F.min("b").alias("b"))
            .select("basin_id", "divide_id", F.col("b.source_basin").alias("source_basin"), F.col("b.source_id").alias("source_id"), F.col("b.dist").alias("dist")))
