"""URL filters: fixed rules first, then a path-template tree per host.

Every url is a path from its host down a tree of path segments; what counts is different urls, so that pages seen
again change nothing. Top down, a segment becomes a wildcard when it looks like an identifier, or when it is variable:
its node has at least ``MIN_CHILDREN`` effective children (the inverse of the probability that two of
the node's urls share their child, which doesn't shift when the node is seen more often), except children whose labelled
urls differ significantly from those of the others. Bottom up, a branch whose labelled urls don't differ
significantly from those of all branches beside it is merged into the wildcard there.
What remains are templates such as ``host/en/*``; a template is rejected when the
smoothed share of good urls among its labelled urls is below ``MIN_PURITY``. A url is labelled if one of its pages
is, and good if all its labelled pages are. Levels that fewer than ``MIN_CHILDREN`` urls of any host reach are
wildcards, so one very long url adds no level to the work.

All of it is grouping and joining of distinct (host, path) rows: counts are
pre-aggregated, so a host that holds a third of all urls is one row for each distinct
path or template before it meets any other, and joins to it are split by adaptive execution.

Defined results: a null url, or one without ``://``, has empty host and path, no rule,
and is judged like any other template (host '' without segments); templates without labelled pages get the
overall share of good pages as their purity; without any label everything is
allowed; repeated rows are judged each; an empty table gives an empty result; other
columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.common import written

#: Levels of the tree in one plan; deeper trees are written in between. No effect on results.
LEVELS = 4
MIN_CHILDREN = 20
#: Two-sided 95 % point of the normal distribution (fixed value).
Z = 1.96
SMOOTHING, MIN_PURITY = 10.0, 0.5
#: Digits, a UUID, a long hexadecimal number, or a date, each with an optional extension.
IDENTIFIER = r"^([0-9]+|[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9a-fA-F]{16,}|[0-9]{4}-[0-9]{2}-[0-9]{2})(\.[A-Za-z0-9]{1,5})?$"
#: (rule, verdict): host/path-prefix; fixed by the caller's contract.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (null: none) and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # the last to fit is the longest
        r_host, r_path = text.split("/", 1)
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith("/" + r_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _segments(path: Column) -> Column:
    """All segments of a path, identifiers as '*'."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""),
                       lambda s: F.when(s.rlike(IDENTIFIER), F.lit("*")).otherwise(s))


def _at(segments: str, depth: int) -> Column:
    return F.get(segments, F.lit(depth))


def _wild(segments: str, depth: int) -> Column:
    """The segments with '*' at ``depth``."""
    return F.transform(F.col(segments), lambda s, i: F.when(i == depth, F.lit("*")).otherwise(s))


def _differs(good: Column, n: Column, all_good: Column, all_n: Column) -> Column:
    """Whether a branch's share of good urls differs significantly from that of the others beside it."""
    other_n = all_n - n
    share, other = F.try_divide(good, n), F.try_divide(all_good - good, other_n)
    p = F.try_divide(all_good, all_n)
    error = F.sqrt(p * (1 - p) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), other_n)))
    return F.coalesce(F.abs(share - other) > Z * error, F.lit(False))


def _generalise(nodes: DataFrame, depth: int) -> DataFrame:
    """Wildcards at ``depth`` below the variable nodes, but for the children that differ from the others."""
    prefix = F.slice("segs", 1, depth) if depth else F.array().cast("array<string>")
    keyed = nodes.withColumn("prefix", prefix).withColumn("child", _at("segs", depth))
    children = keyed.where(F.col("child") != "*").groupBy("host", "prefix", "child").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("g"), F.sum("labelled").alias("m"))
    variable = (children.groupBy("host", "prefix")
                .agg(F.sum("n").alias("all_n"), F.sum(F.col("n") * F.col("n")).alias("squares"),
                     F.sum("g").alias("all_g"), F.sum("m").alias("all_m"))
                .where(F.col("all_n") * F.col("all_n") >= MIN_CHILDREN * F.col("squares"))
                .select("host", "prefix", "all_g", "all_m", F.lit(True).alias("variable")))
    apart = (children.join(variable, ["host", "prefix"])
             .where(_differs(F.col("g"), F.col("m"), F.col("all_g"), F.col("all_m")))
             .select("host", "prefix", "child", F.lit(True).alias("apart")))
    wild = F.col("variable") & F.col("apart").isNull()
    return (keyed.join(variable.select("host", "prefix", "variable"), ["host", "prefix"], "left")
            .join(apart, ["host", "prefix", "child"], "left")
            .withColumn("segs", F.when(wild & F.col("child").isNotNull(), _wild("segs", depth)).otherwise(F.col("segs")))
            .drop("prefix", "child", "variable", "apart"))


def _depth(nodes: DataFrame) -> int:
    """Levels that ``MIN_CHILDREN`` urls of some host reach."""
    sizes = nodes.groupBy("host", F.size("segs").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    deeper = Window.partitionBy("host").orderBy(F.desc("d"))
    return sizes.withColumn("reach", F.sum("n").over(deeper)).where(F.col("reach") >= MIN_CHILDREN).agg(F.max("d")).first()[0] or 0


def _merge(templates: DataFrame, depth: int) -> DataFrame:
    """(host, tmpl, now, good, labelled): templates that differ at ``depth`` alone share a wildcard
    there, but those whose share of good pages differs from the others' significantly."""
    t = templates.withColumn("wide", F.when(F.size("now") > depth, _wild("now", depth)).otherwise(F.col("now")))
    per = t.groupBy("host", "wide", "now").agg(F.sum("good").alias("g"), F.sum("labelled").alias("n"))
    pool = per.groupBy("host", "wide").agg(F.sum("g").alias("pool_g"), F.sum("n").alias("pool_n"))
    differs = _differs(F.col("g"), F.col("n"), F.col("pool_g"), F.col("pool_n"))
    kept = per.join(pool, ["host", "wide"]).where(differs).select("host", "now", F.lit(True).alias("apart"))
    return (t.join(kept, ["host", "now"], "left")
            .withColumn("now", F.when(F.col("apart"), F.col("now")).otherwise(F.col("wide"))).drop("apart", "wide"))


def path_templates(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, path, template, purity). ``urls``: (page_id, host, path); ``labels``: (page_id,
    good 0/1). One row for each distinct host and path."""
    evidence = labels.where("page_id is not null").groupBy("page_id").agg(F.min("good").cast("long").alias("good"))
    spread = urls.withColumn("page_id", F.coalesce(F.col("page_id"), -F.abs(F.xxhash64("path")) - 1))
    nodes = (spread.join(evidence, "page_id", "left").groupBy("host", "path")
             .agg(F.coalesce(F.min("good"), F.lit(0)).alias("good"), (F.count("good") > 0).cast("long").alias("labelled"))
             .withColumn("segs", _segments(F.col("path"))))
    nodes = written(nodes, "url-nodes")
    depth = _depth(nodes)
    nodes = nodes.withColumn("segs", F.transform("segs", lambda x, i: F.when(i >= depth, F.lit("*")).otherwise(x)))
    for d in range(depth):
        nodes = _generalise(nodes, d)
        if d % LEVELS == LEVELS - 1 and d + 1 < depth:
            nodes = written(nodes, "url-nodes")
    nodes = written(nodes.withColumnRenamed("segs", "tmpl"), "url-nodes")
    templates = written(nodes.groupBy("host", "tmpl").agg(F.sum("good").alias("good"), F.sum("labelled").alias("labelled"))
                        .withColumn("now", F.col("tmpl")), "url-templates")
    for d in reversed(range(depth)):
        templates = _merge(templates, d)
        if d and d % LEVELS == 0:
            templates = written(templates, "url-templates")
    templates = written(templates, "url-templates")
    overall = templates.agg(F.try_divide(F.sum("good"), F.sum("labelled"))).first()[0]
    prior = 1.0 if overall is None else float(overall)
    merged = templates.groupBy("host", "now").agg(F.sum("good").alias("g"), F.sum("labelled").alias("n")).withColumn(
        "purity", (F.col("g") + F.lit(SMOOTHING * prior)) / (F.col("n") + F.lit(SMOOTHING)))
    judged = templates.select("host", "tmpl", "now").join(merged.select("host", "now", "purity"), ["host", "now"])
    return nodes.select("host", "path", "tmpl").join(judged, ["host", "tmpl"]).select(
        "host", "path", F.concat(F.col("host"), F.lit("/"), F.array_join("now", "/")).alias("template"), "purity")


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity): one row per page."""
    url = F.col(url_col)
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    by_tree = F.when(F.col("purity") < MIN_PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(path_templates(urls, labels), ["host", "path"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, by_tree).alias("verdict"), "template", "purity")
