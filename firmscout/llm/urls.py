"""URL filters by path-template trees.

The paths of a host form a tree of segments. From the root down, a branching where most rows have a child of their own
is a variable part and becomes one wildcard; the rest keep their segments. Branches of one host with the same form
whose labelled share of bad pages does not differ by more than chance are then merged. A template is rejected if its
share of good labels, smoothed towards that of all pages, is too low. Rules on hosts and paths go first.

All steps are joins and aggregates on (host, template so far); counts are summed within tasks before the shuffle, and
a join brings one small row per branching back to the pages, which adaptive execution splits for a hot host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import picked, staged

#: Segments looked at one by one; what follows is one last segment.
DEPTH = 8
#: A branching is variable from so many children on, if there is a child for every ten rows, or a thousand children.
LEAST_CHILDREN, ROWS_PER_CHILD, MANY_CHILDREN = 10, 10, 1000
#: Two-sided five per cent.
Z = 1.96
#: Labels that the share of all pages counts for, and the purity below which a template is rejected.
SMOOTHING, LEAST_PURITY = 10.0, 0.5


def host_of(url: Column) -> Column:
    """What stands between ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; equally long ones by code point. Rules are ``host/path``."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        domain, _, rest = name.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule = F.when(fits, name).otherwise(rule)
        verdict = F.when(fits, rules[name]).otherwise(verdict)
    return rule, verdict


def templates(urls: DataFrame, depth: int) -> DataFrame:
    """``urls`` with ``template``: the path with its variable segments as ``*``; needs ``host`` and ``path``."""
    # A branch is written as its segments, each with a slash in front; a segment * cannot be taken for the wildcard.
    parts = F.filter(F.split("path", "/", -1), lambda s: s != "")
    parts = F.transform(parts, lambda s: F.when(s == "*", "%2A").otherwise(s))
    tail = F.array(F.array_join(F.slice("_s", depth, F.greatest(F.size("_s"), F.lit(1))), "/"))
    out = urls.withColumn("_s", parts).withColumn(
        "_s", F.when(F.size("_s") > depth, F.concat(F.slice("_s", 1, depth - 1), tail)).otherwise(F.col("_s"))
    )
    out = out.withColumn("template", F.lit(""))
    for level in range(depth):
        if level:
            out = staged(out)  # each level reads the one above twice
        child = F.get("_s", F.lit(level))
        counts = out.where(child.isNotNull()).groupBy("host", "template", child.alias("_c")).agg(F.count("*").alias("_n"))
        kinds = counts.groupBy("host", "template").agg(F.count("*").alias("_d"), F.sum("_n").alias("_n"))
        many = (F.col("_d") * ROWS_PER_CHILD >= F.col("_n")) | (F.col("_d") >= MANY_CHILDREN)
        wild = kinds.where((F.col("_d") >= LEAST_CHILDREN) & many).select("host", "template", F.lit(True).alias("_w"))
        step = F.when(child.isNull(), "").when(F.col("_w"), "/*").otherwise(F.concat(F.lit("/"), child))
        out = out.join(wild, ["host", "template"], "left").withColumn("template", F.concat("template", step)).drop("_w")
    return out.drop("_s")


def purity(pages: DataFrame, good: float) -> DataFrame:
    """``host, template, purity`` from pages with ``host``, ``template`` and ``bad`` (0, 1 or null without a label).

    ``good`` is the share of good ones among all labels.
    """
    labelled = [F.count("bad").alias("l"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b")]
    branches = pages.groupBy("host", "template").agg(*labelled)
    # The form of a template is its wildcards and how many segments it has.
    form = F.regexp_replace("template", r"/(?!\*(/|\z))[^/]*", "/x")
    branches = branches.withColumn("form", form)
    whole = branches.groupBy("host", "form").agg(F.sum("l").alias("al"), F.sum("b").alias("ab"))
    branches = branches.join(whole, ["host", "form"])
    rest = F.col("al") - F.col("l")
    share = F.col("ab") / F.col("al")
    gap = F.abs(F.col("b") / F.col("l") - (F.col("ab") - F.col("b")) / rest)
    error = F.sqrt(share * (1 - share) * (1 / F.col("l") + 1 / rest))
    # Without labels on either side nothing tells the branch from the others of its form.
    own = F.when((F.col("l") > 0) & (rest > 0), gap > Z * error).otherwise(False)
    branches = branches.withColumn("_own", own)
    merged = branches.where("NOT _own").groupBy("host", "form").agg(F.sum("l").alias("ml"), F.sum("b").alias("mb"))
    branches = branches.join(merged, ["host", "form"], "left")
    n = F.when(F.col("_own"), F.col("l")).otherwise(F.col("ml"))
    bad = F.when(F.col("_own"), F.col("b")).otherwise(F.col("mb"))
    smooth = (n - bad + SMOOTHING * good) / (n + SMOOTHING)
    return branches.select("host", "template", smooth.alias("purity"))


def judge(pages: DataFrame, rules: dict[str, str], depth: int = DEPTH) -> DataFrame:
    """``page_id, host, path, rule, verdict, template`` for every row of ``pages`` (``page_id, url, bad``).

    ``bad`` is a page's label: 1, 0 or null. A null url, or one without ``://``, has an empty host and path and the
    template of all such pages. Repeated rows count and are judged each; extra columns are ignored; no rows give none.
    """
    parts = picked(pages, "page_id", "url", "bad").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "bad")
    segments = F.size(F.filter(F.split("path", "/", -1), lambda s: s != ""))
    longest, labels, bad = parts.agg(F.max(segments), F.count("bad"), F.sum("bad")).first()
    named = templates(parts, min(depth, max(1, longest or 0)))
    found = named.join(purity(named, 1 - bad / labels if labels else 1.0), ["host", "template"])
    rule, ruled = rule_for(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("purity") < LEAST_PURITY, "block").otherwise("allow")
    return found.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, learned).alias("verdict"), "template"
    )
