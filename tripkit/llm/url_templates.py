"""Judge URLs by fixed rules and, beyond these, by a tree of path templates with labelled purity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import saved
from tripkit.llm.revisits import LOWER, UPPER

DEPTH = 8  # path segments with a level of their own in the tree; the rest of a longer path is one segment
WILDCARD, REST = "*", "<rest>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered. Path: then up to ``?``, ``#`` or
    the end. Both empty for null and without ``://``."""
    part = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of ``rules`` (``host/path``, verdict) that fits, and its verdict; null if none fits.

    A rule fits its host and all subdomains when the path starts with the rule's path, from its first slash on.
    The rules are a short list that becomes part of the plan.
    """
    rule = verdict = None
    for text, said in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        rule = F.when(fits, text).otherwise(rule if rule is not None else F.lit(None).cast("string"))
        verdict = F.when(fits, said).otherwise(verdict if verdict is not None else F.lit(None).cast("string"))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def path_segments(path: Column) -> Column:
    """Non-empty path segments with numbers, dates, hexadecimal and opaque ids replaced by a name of their class."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    kinds = [
        (r"^\d{4}-\d{2}-\d{2}", "<date>"),
        (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", "<uuid>"),
        (r"^\d+(?=$|[^0-9A-Za-z])", "<num>"),
        (r"^[0-9a-f]{8,}(?=$|[^0-9A-Za-z])", "<hex>"),
        (r"^(?=[^.]*\d)[0-9A-Za-z_-]{20,}", "<id>"),
    ]

    def general(x: Column) -> Column:
        out = x
        for pattern, name in reversed(kinds):
            out = F.when(x.rlike(pattern), F.regexp_replace(x, pattern, name)).otherwise(out)
        return out

    short = F.transform(F.slice(parts, 1, DEPTH), general)
    return F.when(F.size(parts) > DEPTH, F.concat(short, F.array(F.lit(REST)))).otherwise(short)


def template_tree(
    spark: SparkSession, urls: DataFrame, min_support: int = 5, z: float = 2.58
) -> DataFrame:
    """Template of each distinct (``host``, ``segments``): columns ``host``, ``segments``, ``template``, ``labelled``, ``bad``.

    ``urls`` has ``host``, ``segments`` and ``bad`` (0, 1 or null for no label). The tree is built level by level over
    the counts of distinct paths. Children of a node become one wildcard if they are seen fewer than ``min_support`` times, or if
    their rate of bad labels is within ``z`` standard errors of the median rate of the node's children; the others keep
    their name, however many siblings they have. ``z`` holds for one test; it rises with the number of children tested in
    the node, so that chance names no more children of wide nodes.
    """
    counts = urls.groupBy("host", "segments").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    tree = saved(spark, counts.withColumn("template", F.lit("")), "url-tree")
    deepest = tree.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(1, deepest + 1):
        here = F.try_element_at("segments", F.lit(level))
        known = tree.withColumn("segment", here)
        sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
        children = known.filter("segment IS NOT NULL").groupBy("host", "template", "segment").agg(*sums)
        rate = F.when((F.col("labelled") > 0) & (F.col("n") >= min_support), F.try_divide("bad", "labelled"))
        nodes = children.groupBy("host", "template").agg(
            F.count(rate).alias("tests"), F.percentile_approx(rate, 0.5, 1000).alias("usual")
        )
        judged = children.join(nodes, ["host", "template"]).withColumn("named", _differs(min_support, z))
        named = judged.filter("named").select("host", "template", "segment", F.lit(True).alias("named"))
        label = F.when(F.col("named"), F.col("segment")).otherwise(WILDCARD)
        grown = F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), label))
        tree = saved(
            spark,
            known.join(named, ["host", "template", "segment"], "left")
            .select("host", "segments", "n", "labelled", "bad", grown.alias("template")),
            "url-tree",
        )
    return tree


def _differs(min_support: int, z: float) -> Column:
    labelled, usual = F.col("labelled"), F.col("usual")
    expected = (usual * labelled + 1) / (labelled + 2)  # never 0 or 1, so a few odd labels prove nothing
    error = F.sqrt(expected * (1 - expected) / F.nullif(labelled, F.lit(0)))
    gap = F.abs(F.col("bad") / F.nullif(labelled, F.lit(0)) - usual)
    bound = F.sqrt(z * z + 2 * F.log(F.greatest("tests", F.lit(1))))  # a normal tail falls like exp(-z^2 / 2): its chance over the tests
    return F.coalesce((F.col("n") >= min_support) & (gap > error * bound), F.lit(False))


def judge_urls(
    spark: SparkSession,
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    labels: DataFrame,
    threshold: float = 0.5,
    weight: float = 5.0,
    **tree_options,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``purity`` for every row of ``pages``.

    ``labels``: ``page_id``, ``bad`` (0 or 1; null is no label; several labels of a page count as bad if one is).
    A rule decides where one fits. Else the page's template does: it is blocked when its share of bad labels,
    smoothed with ``weight`` labels at its host's share, which is smoothed likewise towards the share of all labels,
    reaches ``threshold``. Null URLs and URLs without ``://`` share the empty host. Without labels nothing beyond the
    rules is blocked. Repeated rows are judged each.
    """
    host, path = host_and_path(F.col("url"))
    rule, said = longest_rule(F.col("host"), F.col("path"), rules)
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("segments", path_segments(F.col("path")))
    marks = labels.filter("bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    tree = template_tree(spark, urls.join(marks, "page_id", "left"), **tree_options)
    share = tree.agg(F.try_divide(F.sum("bad"), F.sum("labelled"))).first()[0] or 0.0
    sums = [F.sum(c).alias(c) for c in ("labelled", "bad")]
    smooth = lambda towards: (F.col("bad") + weight * towards) / (F.col("labelled") + weight)
    hosts = tree.groupBy("host").agg(*sums).select("host", smooth(F.lit(share)).alias("host_share"))
    templates = tree.groupBy("host", "template").agg(*sums).join(hosts, "host").select("host", "template", smooth(F.col("host_share")).alias("purity"))
    judged = tree.select("host", "segments", "template").join(templates, ["host", "template"])
    verdict = F.coalesce(said, F.when(F.col("purity") >= threshold, "block").otherwise("allow"))
    return urls.join(judged, ["host", "segments"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "template", "purity"
    )
