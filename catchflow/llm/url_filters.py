"""URL filters: rules first, then trust and distrust spread over the host graph.

Rules are (action, host, path): one fits its host and all subdomains if the url's path starts with the rule's;
the longest wins, at equal length a block. Pages that no rule fits get their host's verdict:

* Nodes are the pages' hosts, the hosts they link to, and the parent domains of both. Edges are links with a
  host (``http://host/`` or ``//host/``) between different hosts, weighted by the pages that have them, and one edge each way between a host and its
  parent domain (a page's relative links stay on its host and add nothing).
* Trust is personalised PageRank along the edges from the hosts of pages that a rule allows; distrust is the same
  against the edges from the hosts of pages that a rule blocks. Seeds weigh by such pages. Mass of hosts without
  edges returns to the seeds, which only scales the result, so both are normalised at the end.
* A host is blocked if its distrust is above ``ratio`` times its trust.

Results in edge cases: a null url, or one without ``://``, has an empty host and path; no rule fits it, it is no
node, and it is allowed. Null html has no links. Repeated rows count as pages of their own. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_table, prepare

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def host_of(url):
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host):
    """A host and its parent domains."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules whose host covers ``host``, the longest first."""
    each = hosts.select("host", F.explode(_suffixes(F.col("host"))).alias("rule_host"))
    size = F.length("rule_host") + F.length("rule_path")
    rule = F.struct((-size).alias("order"), (F.col("action") != "block").alias("soft"), "rule_host", "rule_path", "action")
    return each.join(rules, "rule_host").groupBy("host").agg(F.sort_array(F.collect_list(rule)).alias("rules"))


def rule_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``pages`` (with host, path) plus ``rule`` (as host and path) and ``verdict``, null where none fits."""
    spark = pages.sparkSession
    table = spark.createDataFrame(rules, "action string, rule_host string, rule_path string")
    per_host = host_rules(pages.select("host").where("host <> ''").distinct(), table)
    out = pages.join(per_host, "host", "left")
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    first = F.try_element_at(fits, F.lit(1))
    return (out.withColumn("_first", first).withColumn("rule", F.concat(F.col("_first.rule_host"), F.col("_first.rule_path")))
            .withColumn("verdict", F.col("_first.action")).drop("_first", "rules"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts, from links of ``pages`` (host, html) and from parent domains."""
    links = (pages.select("host", F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all("html", F.lit(_LINK), 1),
        lambda u: F.translate(F.regexp_extract(u, "^[^/]*//([^/?#]*)", 1), UPPER, LOWER)))).alias("dst"))
        .where("dst <> '' AND dst <> host").groupBy(F.col("host").alias("src"), "dst")
        .agg(F.count("*").cast("double").alias("weight")))
    links = keep_table(links, "host-links")
    hosts = (pages.select("host").where("host <> ''").distinct().union(links.select("dst")).distinct())
    up = (hosts.select(F.explode(_suffixes(F.col("host"))).alias("src")).distinct()
          .withColumn("dst", F.regexp_extract("src", r"^[^.]*\.(.+)$", 1)).where("dst <> ''"))
    both = up.select("src", "dst").union(up.select("dst", "src")).withColumn("weight", F.lit(1.0))
    return links.union(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, change: float = 1e-4, keep_every: int = 6) -> DataFrame:
    """Personalised PageRank for several kinds of mass at once, until it stands still.

    ``edges`` (kind, src, dst, weight), ``seeds`` (kind, host, mass); returns (kind, host, score), summing to 1
    for each kind that has seeds. The state is written every ``keep_every`` steps, so no plan grows, and compared with
    the one before: the steps end when no kind's scores have moved by more than ``change`` in sum. Each step moves at
    most ``damping`` times what the last one did, so that always comes.
    """
    total = edges.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    moves = keep_table(edges.join(total, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("share")), "host-moves")
    mass = seeds.groupBy("kind").agg(F.sum("mass").alias("all"))
    start = keep_table(seeds.join(mass, "kind").where("all > 0").select("kind", "host", (F.col("mass") / F.col("all")).alias("score")), "host-seeds")
    state, moved = start, 1.0
    while moved > change:
        before = state
        for _ in range(keep_every):
            sent = (moves.join(state.withColumnRenamed("host", "src"), ["kind", "src"])
                    .select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("score")))
            state = (sent.union(start.withColumn("score", F.col("score") * (1 - damping))).groupBy("kind", "host")
                     .agg(F.sum("score").alias("score")))
        state = keep_table(state, "host-state")
        both = state.union(before.withColumn("score", -F.col("score"))).groupBy("kind", "host").agg(F.abs(F.sum("score")).alias("off"))
        moved = both.groupBy("kind").agg(F.sum("off").alias("off")).agg(F.max("off")).first()[0] or 0.0
    norm = state.groupBy("kind").agg(F.sum("score").alias("all"))
    return state.join(norm, "kind").select("kind", "host", (F.col("score") / F.col("all")).alias("score"))


def filter_pages(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, ratio: float = 1.0, damping: float = 0.85,
                 change: float = 1e-4) -> DataFrame:
    """``pages`` (page_id, url, html) -> page_id, host, path, rule, verdict, trust, distrust."""
    prepare(pages.sparkSession)
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    judged = keep_table(rule_verdicts(p.select("page_id", "host", "path"), rules), "page-rules")
    edges = keep_table(host_edges(p.select("host", "html").where("host <> ''")), "host-edges")
    kinds = (edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight")
             .union(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")))
    seeds = (judged.where("verdict IS NOT NULL")
             .groupBy(F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
             .agg(F.count("*").cast("double").alias("mass")))
    scores = spread(kinds, seeds, damping, change)
    wide = scores.groupBy("host").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k)
                                        for k in ("trust", "distrust")])
    out = judged.join(wide, "host", "left").fillna(0.0, ["trust", "distrust"])
    verdict = F.coalesce("verdict", F.when(F.col("distrust") > ratio * F.col("trust"), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")


PAGE_SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                            T.StructField("html", T.StringType())])


def op4_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all pages."""
    return filter_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")
