"""URL filter by a tree of path templates per host.

Every host has a tree: its root is the host, a level is a segment of the path.  Runs of digits
are a wildcard in their segment.  Going down, at each node,

* segments are variable unless a value has ``SUPPORT`` urls and ``SHARE`` percent of the node's:
  all variable ones become the wildcard ``*``, so a node has at most 100 / SHARE + 1 branches;
* branches that are statistically alike are merged and go on as one: of like form (most of their
  urls end here, or do not) and on the same side of the rest of the node's labelled purity
  (two-proportion test at 5 %: purer, fouler, or no different).

A url's template is its way down the tree.  A template's purity, the share of good labelled urls,
is smoothed by its host's, and that by all hosts'; templates under ``MIN_PURITY`` are rejected.
Rules on hosts and paths go first.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskline.llm.common import staged

#: (verdict, host, path); a rule fits its host and all subdomains.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SUPPORT = 3
SHARE = 1
#: Levels of the tree; what lies deeper is one wildcard ``**``.
LEVELS = 8
#: Chi-square of one degree of freedom at 5 %.
DIFFERENT = 3.84
#: Labelled urls that the smoothing counts for.
PRIOR = 4.0
MIN_PURITY = 0.6

_URL = "://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def shape_of(path: Column) -> Column:
    """The path with ``#`` for each run of digits."""
    return F.regexp_replace(path, "[0-9]+", "#")


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null without one."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _level(tree: DataFrame, k: int, support: int, share: int) -> DataFrame:
    """``tree`` with the templates of all urls that have a k-th segment one segment longer.
    ``node_n``: urls that go on below the row's node."""
    node, merged = Window.partitionBy("host", "template"), Window.partitionBy("host", "template", "side", "leaf")
    going = tree.where(F.size("parts") >= k).withColumn("child", F.col("parts")[k - 1])
    children = going.groupBy("host", "template", "child").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("labelled").alias("labelled"),
        F.sum(F.when(F.size("parts") == k, F.col("n")).otherwise(0)).alias("ends"), F.max("node_n").alias("node_n"),
    )
    fixed = (F.col("n") >= support) & (100 * F.col("n") >= share * F.col("node_n"))
    children = children.withColumn("value", F.when(fixed, F.col("child")).otherwise(F.lit("*")))
    # The branches of a node are few, so windows over them are small.
    good, labelled = F.col("good").cast("double"), F.col("labelled").cast("double")
    all_good, all_labelled = F.sum(good).over(node), F.sum(labelled).over(node)
    gap = good * (all_labelled - labelled) - (all_good - good) * labelled
    spread = labelled * (all_labelled - labelled) * all_good * (all_labelled - all_good)
    branches = (
        children.groupBy("host", "template", "value")
        .agg(*[F.sum(c).alias(c) for c in ("n", "good", "labelled", "ends")])
        .withColumn("side", F.when(gap * gap * all_labelled > DIFFERENT * spread, F.signum(gap)).otherwise(F.lit(0.0)))
        .withColumn("leaf", 2 * F.col("ends") >= F.col("n"))
        .withColumn("alike", F.array_sort(F.collect_set("value").over(merged)))
        .withColumn("below", F.sum(F.col("n") - F.col("ends")).over(merged))
    )
    name = F.when(F.size("alike") == 1, F.col("value")).otherwise(F.concat(F.lit("{"), F.array_join("alike", "|"), F.lit("}")))
    names = children.select("host", "template", "child", "value").join(branches.select("host", "template", "value", name.alias("name"), "below"), ["host", "template", "value"])
    longer = going.join(names.select("host", "template", "child", "name", "below"), ["host", "template", "child"]).select(
        "host", "shape", "parts", "n", "good", "labelled", F.concat("template", F.lit("/"), "name").alias("template"), F.col("below").alias("node_n")
    )
    return longer.unionByName(tree.where(F.size("parts") < k))


def templates(urls: DataFrame, labelled: DataFrame | None = None, url_col: str = "url", good_col: str = "good", support: int = SUPPORT, share: int = SHARE, levels: int = LEVELS) -> DataFrame:
    """(host, shape, template, n, good, labelled): the template of each shape of path, with the
    shape's urls and its labelled ones.  ``labelled`` has urls with a boolean ``good``."""
    def shapes(df, n, good, known):
        path = path_of(F.col(url_col))
        return df.select(host_of(F.col(url_col)).alias("host"), shape_of(path).alias("shape"), n.alias("n"), good.alias("good"), known.alias("labelled"))

    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    seen = shapes(urls, one, none, none)
    if labelled is not None:
        seen = seen.unionByName(shapes(labelled.where(F.col(good_col).isNotNull()), none, F.col(good_col).cast("long"), one))
    parts = F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(F.split(F.expr("substring(shape, 2)"), "/"))
    tree = seen.groupBy("host", "shape").agg(*[F.sum(c).alias(c) for c in ("n", "good", "labelled")]).withColumn("parts", parts)
    hosts = tree.groupBy("host").agg(F.sum(F.when(F.size("parts") > 0, F.col("n")).otherwise(0)).alias("node_n"))
    tree = staged(tree.withColumn("template", F.lit("")).join(hosts, "host"), "tree")
    done = 0
    # Below a node of fewer than ``support`` urls all segments are variable: no level is needed.
    while done < levels and not tree.where((F.size("parts") > done) & (F.col("node_n") >= support)).isEmpty():
        done += 1
        tree = staged(_level(tree, done, support, share), f"tree{done}")
    rest = F.concat(F.repeat(F.lit("/*"), F.greatest(F.lit(0), F.least(F.size("parts"), F.lit(levels)) - done)), F.when(F.size("parts") > levels, "/**").otherwise(""))
    return tree.select("host", "shape", F.concat("template", rest).alias("template"), "n", "good", "labelled")


def purities(shapes: DataFrame, prior: float = PRIOR) -> DataFrame:
    """(host, template, labelled, purity) of the result of :func:`templates`."""
    sums = [F.sum(c).alias(c) for c in ("good", "labelled")]
    everything = shapes.agg(*sums).first()
    base = ((everything["good"] or 0) + 1.0) / ((everything["labelled"] or 0) + 1.0)
    per = shapes.groupBy("host", "template").agg(*sums)
    hosts = per.groupBy("host").agg(((F.sum("good") + prior * base) / (F.sum("labelled") + prior)).alias("host_purity"))
    return per.join(hosts, "host").select("host", "template", "labelled", ((F.col("good") + prior * F.col("host_purity")) / (F.col("labelled") + prior)).alias("purity"))


def judge(urls: DataFrame, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", good_col: str = "good", rules=RULES, min_purity: float = MIN_PURITY, **how) -> DataFrame:
    """One row per row of ``urls``: the id, host, path, rule, verdict, template, purity.

    Null urls and those without ``://`` have empty host and path and are one template.  Repeated
    rows count each.  Without labelled urls every template is pure.  Other columns are ignored.
    """
    shapes = templates(urls, labelled, url_col, good_col, **how)
    known = shapes.select("host", "shape", "template").join(purities(shapes), ["host", "template"])
    rows = urls.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("shape", shape_of(F.col("path"))).join(known, ["host", "shape"])
    own = F.when(F.col("purity") < min_purity, "block").otherwise("allow")
    return rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)).select(
        id_col, "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"), "template", "purity"
    )
