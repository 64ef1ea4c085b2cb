"""URL filter: host and path rules, else a path-template tree per host judged by labelled pages.

Per host, paths are read segment by segment. A segment that looks like a number, an id or a hash, or
that has too many siblings of too little support, becomes a wildcard; what follows it is then
counted together. Sibling branches whose shares of good labels do not differ statistically are merged,
deepest first, and a template whose smoothed share of good labels is low, by itself or against the corpus, is rejected. Work is done
on distinct paths with counts; a hot host is many rows of grouped sums and of joins that adaptive
execution splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmweave.session import stage

WILD = "*"
VARIABLE = r"^([0-9]+|[0-9a-fA-F]{8,}|[0-9a-fA-F]{8}-[0-9a-fA-F-]{27}|(?=[^.]*[0-9]{4}).+)(\.[A-Za-z0-9]{1,5})?$"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest of ``(verdict, host, path)`` rules that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for judged, on, below in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(below)
        name = F.when(fits, F.lit(on + below)).otherwise(name)
        verdict = F.when(fits, F.lit(judged)).otherwise(verdict)
    return name, verdict


def templates(paths: DataFrame, max_children: int = 16, min_support: float = 8.0) -> DataFrame:
    """``(host, path, n, good, bad)`` rows with ``template``, an array of segments.

    At each level the children of one node are counted together. A node of over ``max_children`` kinds
    with fewer than ``min_support`` pages a kind on average is variable. Paths are followed to their ends; those of a
    node of at most ``max_children`` paths, below which nothing can be variable, are finished at once.
    """
    shape = lambda s: F.when(s.rlike(VARIABLE), F.lit(WILD)).otherwise(s)
    segments = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), shape)
    rows = stage(paths.withColumn("segments", segments).withColumn("template", F.array().cast("array<string>")), "paths")
    columns, done, level = [c for c in rows.columns if c != "segments"], [], 0
    while True:
        crowds = rows.groupBy("host", "template").agg(F.count("*").alias("paths")).where(F.col("paths") > max_children)
        crowded = crowds.select("host", "template", F.lit(True).alias("crowded"))
        rows = rows.withColumn("child", F.get("segments", F.lit(level)))
        kinds = rows.where(F.col("child").isNotNull() & (F.col("child") != WILD)).groupBy("host", "template", "child").agg(F.sum("n").alias("n"))
        fans = kinds.groupBy("host", "template").agg(F.count("*").alias("kinds"), F.sum("n").alias("n"))
        broad = fans.where((F.col("kinds") > max_children) & (F.col("n") < min_support * F.col("kinds"))).select("host", "template", F.lit(True).alias("broad"))
        child = F.when(F.col("broad"), F.lit(WILD)).otherwise(F.col("child"))
        rest = F.slice("segments", level + 1, F.size("segments"))
        grown = F.when(F.col("child").isNull(), F.col("template")).when(F.col("crowded"), F.concat("template", F.array(child))).otherwise(F.concat("template", rest))
        known = rows.join(crowded, ["host", "template"], "left").join(broad, ["host", "template"], "left")
        known = stage(known.withColumn("open", F.coalesce("crowded", F.lit(False)) & (F.size("segments") > level + 1)).withColumn("template", grown).drop("child", "broad", "crowded"), "paths")
        done.append(known.where("not open").select(*columns))
        rows, level = known.where("open").drop("open"), level + 1
        if rows.isEmpty():
            return reduce(DataFrame.union, done)


def merged(nodes: DataFrame, z: float = 1.96) -> DataFrame:
    """``(host, template, good, bad)`` with ``merged``: sibling branches of like label shares share a wildcard.

    From the deepest level up, a branch is held against all its siblings together by the two-sample
    test of shares; branches without labels differ from nothing. Only templates of one host and length can be
    siblings, so where these have no two labelled ones, or labels of one kind, all is merged at once.
    """
    rows = nodes.withColumn("size", F.size("template"))
    labelled = F.count_if(F.col("good") + F.col("bad") > 0)
    mixed = rows.groupBy("host", "size").agg(labelled.alias("m"), F.sum("good").alias("g"), F.sum("bad").alias("b")).where("m > 1 and g > 0 and b > 0")
    rows = rows.join(mixed.select("host", "size", F.lit(True).alias("mixed")), ["host", "size"], "left")
    rows = stage(rows.withColumn("merged", F.when(F.col("mixed"), F.col("template")).otherwise(F.transform("template", lambda s: F.lit(WILD)))), "branches")
    alone, rows = rows.where("mixed is null").drop("size", "mixed"), rows.where("mixed").drop("size", "mixed")
    depth = rows.agg(F.max(F.size("template"))).first()[0] or 0
    for level in reversed(range(depth)):
        here = F.get("merged", F.lit(level))
        wild = F.concat(F.slice("merged", 1, level), F.array(F.lit(WILD)), F.slice("merged", level + 2, F.size("merged")))
        rows = rows.withColumns({"branch": here, "parent": F.when(here.isNotNull(), wild)})
        own = rows.where("branch is not null").groupBy("host", "parent", "branch").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
        all_of = own.groupBy("host", "parent").agg(F.sum("g").alias("tg"), F.sum("b").alias("tb"))
        n, m = F.col("g") + F.col("b"), F.col("tg") + F.col("tb") - F.col("g") - F.col("b")
        pooled = F.col("tg") / F.nullif(F.col("tg") + F.col("tb"), F.lit(0))
        gap = F.abs(F.col("g") / F.nullif(n, F.lit(0)) - (F.col("tg") - F.col("g")) / F.nullif(m, F.lit(0)))
        differs = gap > z * F.sqrt(pooled * (1 - pooled) * (1 / F.nullif(n, F.lit(0)) + 1 / F.nullif(m, F.lit(0))))
        apart = own.join(all_of, ["host", "parent"]).where(differs).select("host", "parent", "branch", F.lit(True).alias("apart"))
        kept = F.col("branch").isNull() | F.coalesce("apart", F.lit(False))
        rows = stage(rows.join(apart, ["host", "parent", "branch"], "left").withColumn(
            "merged", F.when(kept, F.col("merged")).otherwise(F.col("parent"))).drop("branch", "parent", "apart"), "branches")
    return rows.union(alone.select(*rows.columns))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], min_purity: float = 0.5, weight: float = 10.0, max_excess: float = 2.0, **tree) -> DataFrame:
    """``(page_id, url, label)`` rows with ``host``, ``path``, ``rule``, ``template``, ``purity`` and ``verdict``.

    ``label`` is 1 for good, 0 for bad and null where unknown. The share of good labels of a template
    is smoothed towards that of all labels with the weight of ``weight`` pages; a template below
    ``min_purity`` is rejected (block), and so is one whose smoothed share of bad labels is over ``max_excess`` times
    that of all labels. A null url, or one without ``://``, has empty host and path and is
    judged like any template; without any labels all are allowed. Rows that repeat count as often as
    they occur and all come back.
    """
    rows = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    good, bad = F.coalesce(F.sum("label"), F.lit(0)).cast("long"), F.coalesce(F.sum(1 - F.col("label")), F.lit(0)).cast("long")
    paths = templates(rows.groupBy("host", "path").agg(F.count("*").alias("n"), good.alias("good"), bad.alias("bad")), **tree)
    nodes = merged(paths.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    by = nodes.groupBy("host", "merged").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    all_good, all_bad = nodes.agg(F.sum("good"), F.sum("bad")).first()
    prior = all_good / (all_good + all_bad) if all_good or all_bad else 1.0
    purity = (F.col("g") + weight * prior) / (F.col("g") + F.col("b") + weight)
    shares = by.select("host", "merged", purity.alias("purity"))
    text = F.concat(F.lit("/"), F.array_join("merged", "/")).alias("template_text")
    judged = paths.join(nodes.select("host", "template", "merged"), ["host", "template"]).join(shares, ["host", "merged"]).select("host", "path", text, "purity")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    low = (F.col("purity") < min_purity) | (1 - F.col("purity") > max_excess * (1 - prior))
    own = F.when(low, "block").otherwise("allow")
    return rows.join(judged, ["host", "path"]).select(
        "page_id", "url", "host", "path", name.alias("rule"), F.col("template_text").alias("template"), "purity", F.coalesce(verdict, own).alias("verdict"))
