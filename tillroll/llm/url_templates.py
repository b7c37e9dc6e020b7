"""URL filter by a tree of path templates.

Rules judge the urls they fit.  For the rest, a tree of templates is learned per host: segment by
segment, numbers and the rare values of crowded nodes become wildcards, unless their share of
blocked pages differs from that of their siblings by more than chance explains; templates of a host
that differ in one segment only and whose shares of blocked pages can't be told apart are merged;
and a template is blocked if its purity, the share of blocked pages with those that no rule judges at
the prior, smoothed towards that of its host and this towards a prior, reaches a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.shared import staged

#: Host, path, verdict.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
#: Different segments up to which a node isn't crowded, and the share of a crowded node's pages that a segment needs to stand for itself.
CROWDED = 8
SHARE = 0.05
#: Segments that the tree tells apart; what lies deeper counts as one wildcard.
DEPTH = 8
#: Pages' worth of weight that the level above has, the share of blocked pages to expect where no rule
#: judges, and the purity from which a template is blocked.
WEIGHT = 10.0
PRIOR = 0.25
PURITY = 0.7
#: Standard errors within which two shares of blocked pages count as the same.
ERRORS = 1.96

NUMBER = r"^[0-9a-fA-F-]*[0-9][0-9a-fA-F-]*(\.[A-Za-z]{1,5})?$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Number of the longest rule that fits; NULL if none does."""
    out = F.lit(None).cast("int")
    for k, (on, below, _) in sorted(enumerate(rules), key=lambda r: len(r[1][0] + r[1][1])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(below)
        out = F.when(fits, k).otherwise(out)
    return out


def _chosen(number: Column, values: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]).cast("array<string>"), number)


def _apart(blocked: Column, pages: Column, others_blocked: Column, others: Column) -> Column:
    """Whether two shares of blocked pages differ by more than chance explains."""
    pooled = (blocked + others_blocked + 1) / (pages + others + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / pages + 1 / F.nullif(others, F.lit(0))))
    return F.abs(blocked / pages - others_blocked / F.nullif(others, F.lit(0))) > ERRORS * error


def _expected(n: Column, judged: Column, blocked: Column) -> Column:
    """Blocked pages, those that no rule judges at the prior."""
    return blocked + PRIOR * (n - judged)


def templates(paths: DataFrame, depth: int = DEPTH) -> DataFrame:
    """paths (host, path, n, judged, blocked) with template: the segments of the path, variable ones as wildcards."""
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    rows = staged(paths.withColumn("parts", parts).withColumn("template", F.lit("").cast("string")).withColumn("last", F.lit(0)), "paths")
    deepest = min(depth, rows.agg(F.max(F.size("parts"))).first()[0] or 0)
    for level in range(deepest):
        here = rows.where(F.size("parts") > level).withColumn("part", F.get("parts", F.lit(level)))
        # Segments of a node, from which those that stand for themselves are chosen: the frequent ones and those unlike their siblings.
        expected = _expected(F.sum("n"), F.sum("judged"), F.sum("blocked"))
        children = here.groupBy("host", "template", "part").agg(F.sum("n").alias("n"), expected.alias("bad"))
        nodes = children.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("n").alias("all"), F.sum("bad").alias("all_bad"))
        unlike = F.coalesce(_apart(F.col("bad"), F.col("n"), F.col("all_bad") - F.col("bad"), F.col("all") - F.col("n")), F.lit(False))
        named = children.join(nodes, ["host", "template"]).where(
            unlike | ~F.col("part").rlike(NUMBER) & ((F.col("children") <= CROWDED) | (F.col("n") >= SHARE * F.col("all")))
        ).select("host", "template", "part", F.lit(True).alias("named"))
        rows = rows.withColumn("part", F.get("parts", F.lit(level))).join(named, ["host", "template", "part"], "left")
        there, own = F.col("part").isNotNull(), F.coalesce("named", F.lit(False))
        rows = rows.withColumn("last", F.when(there & own, level + 1).otherwise(F.col("last")))
        rows = rows.withColumn("template", F.when(there, F.concat("template", F.lit("/"), F.when(own, F.col("part")).otherwise("*"))).otherwise(F.col("template")))
        rows = staged(rows.drop("part", "named"), "level")
    deep = F.when(F.size("parts") > depth, "/**").otherwise("")
    return rows.withColumn("template", F.concat("template", deep))


def merged(found: DataFrame) -> DataFrame:
    """host, template, n, judged, blocked with `branch`: the first of the templates it is merged with, and `merged`, their number.

    Templates of a host that are the same but for their last named segment are put in order of
    their share of blocked pages; a new branch begins where the share differs from that before by
    more than chance explains.  Templates without judged pages show no share and stay alone.
    """
    siblings = found.groupBy("host", "template").agg(F.max("last").alias("last"), F.sum("n").alias("n"), F.sum("judged").alias("judged"), F.sum("blocked").alias("blocked"))
    cut = F.split("template", "/")
    shape = F.array_join(F.transform(cut, lambda p, i: F.when((i == F.col("last")) & (F.col("last") > 0), "?").otherwise(p)), "/")
    siblings = siblings.withColumn("shape", shape).withColumn("share", F.col("blocked") / F.nullif(F.col("judged"), F.lit(0)))
    own = F.when(F.col("judged") == 0, F.col("template")).otherwise("")
    line = Window.partitionBy("host", "shape", "own").orderBy("share", "template")
    siblings = siblings.withColumn("own", own)
    b, j = F.lag("blocked").over(line), F.lag("judged").over(line)
    pooled = (F.col("blocked") + b + 1) / (F.col("judged") + j + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("judged") + 1 / j))
    apart = F.when(F.col("judged") > 0, F.coalesce(F.abs(F.col("share") - b / j) > ERRORS * error, F.lit(True))).otherwise(True)
    siblings = siblings.withColumn("apart", apart.cast("int"))
    siblings = siblings.withColumn("group", F.sum("apart").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    together = Window.partitionBy("host", "shape", "own", "group")
    return siblings.withColumn("branch", F.min("template").over(together)).withColumn("merged", F.count("*").over(together)).select(
        "host", "template", "branch", "merged", "n", "judged", "blocked"
    )


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, branch and purity of every page row.

    NULL urls, and those without `://`, have an empty host and path and no rule; they are one
    template like any other.  Repeated rows each count as a page.  Without any page that a rule
    judges all purities are the prior, below the threshold: allowed.  Other columns are ignored.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parsed = parsed.withColumn("number", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = _chosen(F.col("number"), [v for _, _, v in rules])
    paths = parsed.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("number").alias("judged"), F.count(F.when(by_rule == "block", 1)).alias("blocked")
    )
    placed = staged(templates(paths).select("host", "path", "template", "last", "n", "judged", "blocked"), "templates")
    leaves = staged(merged(placed), "merged")
    hosts = leaves.groupBy("host").agg(F.sum("n").alias("pages"), _expected(F.sum("n"), F.sum("judged"), F.sum("blocked")).alias("bad"))
    # Pages that no rule judges count at the prior, so a few blocked branches don't condemn their host, nor a few blocked pages their branch.
    hosts = hosts.select("host", ((F.col("bad") + WEIGHT * PRIOR) / (F.col("pages") + WEIGHT)).alias("of_host"))
    branches = leaves.groupBy("host", "branch").agg(F.sum("n").alias("pages"), _expected(F.sum("n"), F.sum("judged"), F.sum("blocked")).alias("bad")).join(hosts, "host")
    branches = branches.select("host", "branch", ((F.col("bad") + WEIGHT * F.col("of_host")) / (F.col("pages") + WEIGHT)).alias("purity"))
    known = placed.select("host", "path", "template").join(leaves.select("host", "template", "branch"), ["host", "template"]).join(branches, ["host", "branch"])
    out = parsed.join(known, ["host", "path"])
    rule = _chosen(F.col("number"), [h + p for h, p, _ in rules])
    verdict = F.coalesce(by_rule, F.when(F.col("purity") >= PURITY, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "template", "branch", "purity")
