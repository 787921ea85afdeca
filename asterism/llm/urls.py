"""URL filter by a tree of path templates, with DataFrame functions only.

Per host, paths are laid out as a tree of segments, level by level. A segment stays as it is if
enough of its parent's rows have it; all others become the wildcard ``*``. Of the branches that
stay, those whose labels do not differ from the rest of their parent's (two-proportion test) are
merged into the wildcard as well. A template's purity is the smoothed share of its labelled rows
that are bad; templates above a threshold are rejected. Rules for hosts and paths come first.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Rows, and share of its parent's rows, that a segment needs to be a branch of its own.
LEAST_ROWS = 5
LEAST_SHARE = 0.02
#: Standard errors that two branches' labels differ by if they are not alike.
DIFFERENT = 1.96
#: Weight, in labelled rows, of the share of bad labels everywhere.
PRIOR_ROWS = 10.0
#: Purity from which a template is rejected.
REJECTED = 0.5
#: Levels of the tree, each a round, unless others are asked for; what lies deeper is the last level's rest.
LEVELS = 6
WILDCARD = "*"

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the path, A-Z in lower case; else empty."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What stands between the host and the query or fragment; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule], value: str = "rule") -> Column:
    """The longest of the rules ``(verdict, host/path)`` that fits, or its verdict; else null."""
    found = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        found = F.when(fits, F.lit(rule if value == "rule" else verdict)).otherwise(found)
    return found


def _grown(rows: DataFrame, level: int, levels: int) -> DataFrame:
    """The tree's rows with their template grown by one level."""
    segment = F.col("segments")[level] if level < levels - 1 else F.array_join(F.slice("segments", level + 1, 1 << 30), "/")
    rows = rows.withColumn("segment", F.when(F.size("segments") > level, segment))
    node = ["host", "template"]
    bad, labelled = F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")
    branches = rows.where("segment is not null").groupBy(*node, "segment").agg(F.sum("n").alias("n"), labelled, bad)
    # Reduced to rows per branch; branches too small to stay are counted in, then left out.
    parents = branches.groupBy(*node).agg(*[F.sum(x).alias(f"all_{x}") for x in ("n", "labelled", "bad")])
    large = branches.where(F.col("n") >= LEAST_ROWS).join(parents, node).where(F.col("n") >= LEAST_SHARE * F.col("all_n"))
    rest_labelled, rest_bad = F.col("all_labelled") - F.col("labelled"), F.col("all_bad") - F.col("bad")
    pooled = F.col("all_bad") / F.col("all_labelled")
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / rest_labelled))
    apart = F.abs(F.col("bad") / F.col("labelled") - rest_bad / rest_labelled)
    different = F.when((F.col("labelled") > 0) & (rest_labelled > 0) & (error > 0), apart > DIFFERENT * error)
    kept = large.where(F.coalesce(different, F.lit(False))).select(*node, "segment", F.lit(True).alias("own"))
    found = rows.join(kept, [*node, "segment"], "left")
    step = F.when(F.col("segment").isNull(), F.lit("")).otherwise(
        F.concat(F.lit("/"), F.when(F.col("own"), F.col("segment")).otherwise(F.lit(WILDCARD)))
    )
    return found.withColumn("template", F.concat("template", step)).drop("segment", "own")


def templates(pages: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``host``, ``path`` and ``template`` of the distinct hosts and paths of ``pages``.

    ``pages`` has ``host``, ``path`` and ``bad`` (1, 0, or null without a label). The segments from the last of
    ``levels`` on are one.
    """
    rows = pages.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    rows = rows.withColumn("segments", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("template", F.lit(""))
    rows = materialize(rows, "url-paths")
    deepest = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(min(deepest, levels)):
        rows = materialize(_grown(rows, level, levels), "url-tree")
    return rows.select("host", "path", "template", "labelled", "bad")


def judged(pages: DataFrame, rules: list[Rule], url: str = "url", bad: str = "bad", levels: int = LEVELS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``template``, ``purity`` and ``verdict``.

    ``bad`` is 1 or 0 where a row has a label, else null. A null url, or one without ``://``, has an
    empty host and path, and so the template of all such rows. Without any label, purity is 0
    and every template allowed. Repeated rows count as often as they occur and get equal verdicts.
    Columns with the new names are replaced; an empty table gives an empty one.
    """
    new = ["host", "path", "rule", "template", "purity", "verdict"]
    own = [name for name in pages.columns if name not in (*new, "_bad")]
    rows = pages.select(*own, F.col(bad).cast("long").alias("_bad"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    tree = templates(rows.select("host", "path", F.col("_bad").alias("bad")), levels)
    total = tree.agg(F.sum("bad"), F.sum("labelled")).first()
    prior = (total[0] or 0) / total[1] if total[1] else 0.0
    node = ["host", "template"]
    shares = tree.groupBy(*node).agg(((F.sum("bad") + PRIOR_ROWS * prior) / (F.sum("labelled") + PRIOR_ROWS)).alias("purity"))
    of_path = tree.select("host", "path", "template").join(shares, node)
    host, path = F.col("host"), F.col("path")
    found = rows.drop("_bad").join(of_path, ["host", "path"], "left")
    judged_by_tree = F.when(F.col("purity") >= REJECTED, "block").otherwise("allow")
    return found.select(
        *own, "host", "path", matching_rule(host, path, rules).alias("rule"), "template", "purity",
        F.coalesce(matching_rule(host, path, rules, "verdict"), judged_by_tree).alias("verdict"),
    )
