"""URL filters by host rules and a path-template tree, with DataFrame functions only.

Rules name a host and a path prefix; the longest that fits decides.  Its verdicts label the pages that it fits.  For each
host the path segments form a tree: runs of digits in a segment become ``#``, and where a node has many
children the rare ones become ``*``.  Sibling branches with the same spread of pages over their sub-templates are merged, unless
the labelled block rate of a branch departs from the rest by more than chance.  A merged template is rejected where most of
its pages are labelled and its smoothed block rate is high; pages no rule fits follow their template.

Everything is summed per template before it is joined, so that a host with very many pages is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._jobs import written

# The rules (verdict, host, path prefix).
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
DEPTH = 3  # levels that the SQL for comparison writes out; the operator goes as deep as the paths do
MAX_CHILDREN = 32
MIN_SHARE_PERCENT = 2
SMOOTHING = 10
PURITY_PERCENT = 90
LABELLED_PERCENT = 50


def _host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _rule(host: Column, path: Column, rules: tuple) -> tuple[Column, Column]:
    fits = [(F.concat(F.lit("."), host).endswith(f".{h}") & path.startswith(p), h + p, verdict) for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))]
    first = lambda k: F.coalesce(*[F.when(f, F.lit((rule, verdict)[k])) for f, rule, verdict in fits]) if fits else F.lit(None).cast("string")
    return first(0), first(1)


def _wildcards(tree: DataFrame) -> DataFrame:
    """tree with ``path``, the segments of shape with * for rare children, level by level.

    Only nodes with more than MAX_CHILDREN templates below can have so many children, so the levels end where there are none.
    """
    segments = F.filter(F.split("shape", "/"), lambda s: s != "")
    tree = tree.withColumns({"seg": segments, "path": F.array().cast("array<string>"), "open": F.lit(True)})
    k = 0
    while True:
        parent = ["host", "path"]
        crowd = tree.where("open").groupBy(*parent).agg(F.count("*").alias("templates")).where(F.col("templates") > MAX_CHILDREN).select(*parent, F.lit(True).alias("crowded"))
        tree = written(tree.join(crowd, parent, "left").withColumn("open", F.col("open") & F.coalesce("crowded", F.lit(False))).drop("crowded"))
        if tree.where("open").isEmpty():
            break
        here = F.coalesce(F.get("seg", F.lit(k)), F.lit(""))
        live = tree.where("open").select(*parent, here.alias("child"), "n")
        child = live.groupBy(*parent, "child").agg(F.sum("n").alias("pages"))
        family = child.groupBy(*parent).agg(F.count("*").alias("children"), F.sum("pages").alias("all"))
        rare = child.join(family, parent).where((F.col("children") > MAX_CHILDREN) & (100 * F.col("pages") < MIN_SHARE_PERCENT * F.col("all")))
        rare = rare.select(*parent, "child", F.lit(True).alias("rare"), F.lit(True).alias("open"))
        name = F.when(F.col("rare"), "*").otherwise(F.col("child"))
        tree = tree.withColumn("child", here).join(rare, [*parent, "child", "open"], "left").withColumn("path", F.when(F.col("open") & (name != ""), F.concat("path", F.array(name))).otherwise(F.col("path")))
        tree = written(tree.withColumn("open", F.col("open") & (name != "")).drop("child", "rare"))
        k += 1
    # the levels that no wildcard can reach keep their segments
    settled = F.col("path")
    return written(tree.withColumn("path", F.concat(settled, F.slice("seg", F.size(settled) + 1, F.lit(2**31 - 1)))).drop("seg", "open"))


def judged(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages (page_id, url, ...).

    A url that is null or has no ``://`` has an empty host and path, fits no rule and is allowed unless its template (the empty path of
    the empty host) is rejected, which no rule can bring about.  Repeated rows are judged one by one; an empty table gives an
    empty result; other columns are ignored.
    """
    host, path = _host_and_path(F.col("url"))
    base = pages.select(F.col("page_id").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = _rule(F.col("host"), F.col("path"), rules)
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    shapes = F.transform(segments, lambda s: F.regexp_replace(s, "[0-9]+", "#"))
    base = base.withColumns({"rule": rule, "ruled": verdict, "shape": F.coalesce(F.array_join(shapes, "/"), F.lit(""))})
    key = ["host", "shape"]
    one = lambda c: F.sum(c.cast("long"))
    tree = base.groupBy(*key).agg(F.count("*").alias("n"), one(F.coalesce(F.col("ruled") == "block", F.lit(False))).alias("blocked"), one(F.col("ruled").isNotNull()).alias("labelled"))
    tree = _wildcards(written(tree))  # templates: few beside the pages, and read many times
    # branches below a host's first level: the spread of their pages over sub-templates, in tenths
    tree = tree.withColumn("t0", F.coalesce(F.get("path", F.lit(0)), F.lit("")))
    below = F.array_join(F.slice("path", 2, 2**31 - 1), "/")
    sub = tree.groupBy("host", "t0", below.alias("below")).agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"))
    sub = written(sub)
    branch = sub.groupBy("host", "t0").agg(F.sum("n").alias("all"), F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
    spread = (
        sub.join(branch.select("host", "t0", "all"), ["host", "t0"])
        .select("host", "t0", F.concat_ws(":", "below", F.floor((20 * F.col("n") + F.col("all")) / (2 * F.col("all"))).cast("string")).alias("part"), F.floor((20 * F.col("n") + F.col("all")) / (2 * F.col("all"))).alias("tenths"))
        .where("tenths > 0")
        .groupBy("host", "t0")
        .agg(F.array_join(F.sort_array(F.collect_list("part")), "|").alias("spread"))  # at most ten parts, by their tenths
    )
    branch = branch.join(spread, ["host", "t0"], "left")
    like = Window.partitionBy("host", "spread")
    branch = branch.withColumns({"bs": F.sum("b").over(like), "ls": F.sum("l").over(like)})
    pool = (F.col("bs") + 0.5) / (F.col("ls") + 1)
    apart = (F.col("l") > 0) & (F.abs(F.col("b") - pool * F.col("l")) > 2 * F.sqrt(F.col("l") * pool * (1 - pool)) + 1)
    branch = written(branch.withColumn("merged", F.when(apart, F.col("t0"))))  # null: with its like
    named = sub.join(branch.select("host", "t0", "spread", "merged"), ["host", "t0"])
    templates = named.groupBy("host", "spread", "merged", "below").agg(F.sum("n").alias("n"), F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
    bad = templates.where((100 * F.col("l") >= LABELLED_PERCENT * F.col("n")) & (100 * (2 * F.col("b") + SMOOTHING) >= PURITY_PERCENT * 2 * (F.col("l") + SMOOTHING)))
    bad = named.join(
        bad.select(F.col("host").alias("h"), F.col("spread").alias("sp"), F.col("merged").alias("m"), F.col("below").alias("bl")),
        (F.col("host") == F.col("h")) & F.col("spread").eqNullSafe(F.col("sp")) & F.col("merged").eqNullSafe(F.col("m")) & (F.col("below") == F.col("bl")), "left_semi",
    ).select("host", "t0", "below")
    rejected = tree.withColumn("below", below).join(bad, ["host", "t0", "below"], "left_semi").select(*key, F.lit(True).alias("rejected"))
    return base.join(rejected, key, "left").select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"))
