"""URL filters: rules by host and path, and per-host path templates judged by their labelled urls."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ANY, REST = "*", "**"
DEPTH = 8
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: Iterable[Rule]) -> tuple[Column, Column]:
    """The rule (host and path as one string) that fits, and its verdict; null without one.

    ``rules`` are (verdict, host, path); the longest that fits wins.
    """
    rule = verdict = F.lit(None).cast("string")
    for says, of, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        rule = F.when(fits, F.lit(of + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def templates(paths: DataFrame, *, common: float = 0.02, least: int = 5, depth: int = DEPTH) -> DataFrame:
    """``host``, ``path`` and the path's ``template``, an array of segments and wildcards.

    The tree of a host is walked from the root, one level a step. Under a node a segment
    keeps its name if at least ``least`` urls and a share of ``common`` of the node's have
    it; all others are the wildcard ``*``. A path deeper than ``depth`` ends in ``**``.
    ``paths`` has one row per host and path with the number of urls ``n``.
    """
    names = F.split(F.regexp_replace("path", "^/", ""), "/")
    rows = paths.select(
        "host",
        "path",
        "n",
        F.when(F.size(names) > depth, F.concat(F.slice(names, 1, depth), F.array(F.lit(REST)))).otherwise(names).alias("_names"),
        F.array().cast("array<string>").alias("_done"),
    )
    levels = rows.agg(F.max(F.size("_names"))).first()[0] or 0
    for level in range(levels):
        node = rows.where(F.size("_names") > level).withColumn("_name", F.get("_names", F.lit(level)))
        each = node.groupBy("host", "_done", "_name").agg(F.sum("n").alias("_n"))
        whole = each.groupBy("host", "_done").agg(F.sum("_n").alias("_all"))
        kept = each.join(whole, ["host", "_done"]).where((F.col("_n") >= least) & (F.col("_n") >= common * F.col("_all")))
        kept = kept.select("host", "_done", "_name", F.lit(True).alias("_kept"))
        named = rows.withColumn("_name", F.get("_names", F.lit(level))).join(kept, ["host", "_done", "_name"], "left")
        grown = F.when(F.size("_names") <= level, F.col("_done")).otherwise(
            F.concat("_done", F.array(F.when(F.col("_kept") | (F.col("_name") == REST), F.col("_name")).otherwise(ANY)))
        )
        rows = saved(named.select("host", "path", "n", "_names", grown.alias("_done")), "templates")
    return rows.select("host", "path", F.col("_done").alias("template"))


def judged(counts: DataFrame, *, purity: float, prior: float, similar: float) -> DataFrame:
    """Merge branches that are alike, and judge each template by its labelled urls.

    ``counts`` has ``host``, ``template``, ``blocks`` and ``allows``. Templates that differ
    in one name of their last named place are branches of one node. Of these, branches with
    labels whose share of blocked urls is within ``similar`` standard errors of the node's
    are merged with it; others, and those without labels, stand alone. A template is
    rejected if ``(blocks + prior / 2) / (labelled + prior)`` reaches ``purity``.
    """
    named = F.transform("template", lambda s, i: F.when(~s.isin(ANY, REST), i + 1).otherwise(F.lit(0)))
    last = F.coalesce(F.array_max(named), F.lit(0))
    branch = F.transform("template", lambda s, i: F.when(i + 1 == F.col("_last"), F.lit(ANY)).otherwise(s))
    rows = counts.withColumn("_last", last).withColumn("_node", branch)
    rows = rows.withColumn("_labelled", F.col("blocks") + F.col("allows"))
    nodes = rows.groupBy("host", "_node").agg(F.sum("blocks").alias("_b"), F.sum("_labelled").alias("_l"))
    share = F.try_divide("_b", "_l")
    error = F.sqrt(F.try_divide(F.greatest(share * (1 - share), F.lit(0.01)), F.col("_labelled")))
    alike = (F.col("_labelled") > 0) & (F.abs(F.try_divide("blocks", "_labelled") - share) <= similar * error)
    rows = rows.join(nodes, ["host", "_node"]).withColumn("_alike", F.coalesce(alike, F.lit(False)))
    group = F.when(F.col("_alike"), F.col("_node")).otherwise(F.col("template"))
    rows = rows.withColumn("branch", F.concat_ws("/", group)).withColumn("merged", F.col("_alike"))
    sums = rows.groupBy("host", "branch", "merged").agg(F.sum("blocks").alias("_b"), F.sum("_labelled").alias("_l"))
    score = (F.col("_b") + prior / 2) / (F.col("_l") + prior)
    sums = sums.select("host", "branch", "merged", score.alias("purity"), (score >= purity).alias("rejected"))
    return rows.select("host", "template", "branch", "merged").join(sums, ["host", "branch", "merged"]).drop("merged")


def judge_urls(
    pages: DataFrame,
    rules: Iterable[Rule],
    key: str = "page_id",
    url: str = "url",
    *,
    purity: float = 0.9,
    prior: float = 2.0,
    similar: float = 2.0,
    common: float = 0.02,
    least: int = 5,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per page: ``key``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity``.

    Pages that a rule fits get its verdict; their labels teach the templates of their host.
    Other pages are blocked if their template is rejected and allowed otherwise. The tree is
    built on distinct paths with counts, so that a host with very many pages weighs as much
    as its paths; sums are pre-aggregated before every shuffle.

    A null url and one without ``://`` have an empty host and path and share the template of
    that host; nothing is labelled there, so they are allowed. Repeated rows and null keys
    are judged alike and all returned; other columns are ignored; an empty table gives no
    rows.
    """
    parts = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, says = ruled(F.col("host"), F.col("path"), rules)
    parts = parts.select("*", rule.alias("rule"), says.alias("_says"))
    paths = parts.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.sum((F.col("_says") == "block").cast("bigint")).alias("_blocks"),
        F.sum((F.col("_says") == "allow").cast("bigint")).alias("_allows"),
    )
    paths = saved(paths, "paths")
    placed = templates(paths.select("host", "path", "n"), common=common, least=least, depth=depth)
    counts = paths.join(placed, ["host", "path"]).groupBy("host", "template").agg(
        F.sum(F.coalesce("_blocks", F.lit(0))).alias("blocks"), F.sum(F.coalesce("_allows", F.lit(0))).alias("allows")
    )
    verdicts = placed.join(judged(counts, purity=purity, prior=prior, similar=similar), ["host", "template"])
    verdicts = verdicts.select("host", "path", "branch", "purity", "rejected")
    joined = parts.join(verdicts, ["host", "path"], "left")
    learned = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        key,
        "host",
        "path",
        "rule",
        F.coalesce("_says", learned).alias("verdict"),
        F.concat(F.lit("/"), F.col("branch")).alias("template"),
        "purity",
    )
