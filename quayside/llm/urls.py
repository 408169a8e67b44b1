"""URL filters by a tree of path templates per host.

A url gives its host and the segments of its path. Segments that look variable (numbers, long
identifiers) become wildcards by their shape; segments that take many values below the same parent,
each seldom, become one wildcard too. Siblings whose share of blocked urls does not differ from that
of all siblings together are merged into one branch. What remains is a tree of templates per host.
Segments that all urls below a node share are one step, so a step is a real choice between branches,
and the tree is as deep as its paths have choices.

Labels are the urls that a rule list decides. The blocked share of every template is smoothed
towards its parent's, that of the host towards the overall share. Urls that no rule decides are
evidence of neither kind: each weighs a little towards the overall share, so that a branch of which
only the blocked urls are labelled does not look pure. A template whose smoothed share is high and
that has labels of its own is rejected. A url that a rule fits keeps the rule's verdict.

All counting is grouped sums over the table of distinct shapes, which is far smaller than the urls.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.text import LOWER, UPPER, cut

#: Verdict, host and path. The longest rule that fits decides.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Different values below one parent that make a segment variable, if they are that many per url.
VALUES, SPREAD = 16, 0.5
#: Standard errors by which a branch may differ from its siblings and still be merged with them.
SIMILAR = 1.96
#: Urls' worth of weight that a parent's share has in its child's.
STRENGTH = 10.0
#: Weight of an unlabelled url, counted as the overall share.
UNLABELLED = 0.1
#: A template is rejected from this share on, if it has so many labels of its own.
REJECT, OWN_LABELS = 0.9, 5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls where none does.

    A rule list is short and given with the code, so it is one expression over the row.
    """
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name = verdict = F.lit(None).cast("string")
    for says, domain, prefix in reversed(longest):
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(prefix))
        name = F.when(fits, F.lit(domain + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def shape_of(path: Column) -> Column:
    """The segments of a path by shape, joined by ``/``: digits and long identifiers are wildcards."""
    def shape(s: Column) -> Column:
        return F.when(F.length(s) >= 32, F.lit("{long}")).otherwise(F.regexp_replace(s, "[0-9]+", "{n}"))

    return F.array_join(F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), shape), "/")


def smooth(n: Column, bad: Column, labelled: Column, prior: Column, overall: Column) -> Column:
    """Blocked share of n urls of which some are labelled, `bad` of them as blocked."""
    free = F.lit(UNLABELLED) * (n - labelled)
    return (bad + F.lit(STRENGTH) * prior + free * overall) / (labelled + F.lit(STRENGTH) + free)


def _common(low: Column, high: Column) -> Column:
    """Length of the common prefix of two arrays. With the least and the greatest array of a group it
    is that of them all."""
    same = F.transform(F.sequence(F.lit(0), F.size(low)), lambda i: F.coalesce(F.get(low, i) == F.get(high, i), F.lit(False)))
    return (F.array_position(same, False) - 1).cast("int")


def templates(urls: DataFrame) -> DataFrame:
    """The tree: per host and shape the template it belongs to, its smoothed blocked share and how
    many urls with labels it has (own).

    `urls` has host, shape and seed (true blocked, false allowed, null unlabelled). Each round goes
    one choice of branches down; shapes at their end leave. There are as many rounds as the path with
    most choices has.
    """
    leaves = cut(urls.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("seed").alias("m"),
        F.sum(F.when(F.col("seed"), 1).otherwise(0)).alias("b"),
    ), "url-shapes")
    bad, labelled = leaves.agg(F.sum("b"), F.sum("m")).first()
    overall = F.lit(((bad or 0) + 1) / ((labelled or 0) + 2))
    hosts = leaves.groupBy("host").agg(*[F.sum(c).alias(f"_h{c}") for c in "nmb"])
    rest = F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(F.split("shape", "/"))
    tree = leaves.join(hosts, "host").select(
        "host", "shape", "n", "m", "b", rest.alias("rest"), F.lit("").alias("template"),
        smooth(F.col("_hn"), F.col("_hb"), F.col("_hm"), overall, overall).alias("purity"))
    at = ["host", "template"]
    done: list[DataFrame] = []
    while True:
        around = tree.groupBy(*at).agg(
            F.min("rest").alias("_low"), F.max("rest").alias("_high"), *[F.sum(c).alias(f"_all_{c}") for c in "nmb"])
        around = around.select(*at, _common(F.col("_low"), F.col("_high")).alias("_k"), *[f"_all_{c}" for c in "nmb"])
        here = tree.join(around, at).withColumn("_next", F.coalesce(F.get("rest", F.col("_k")), F.lit("")))
        nodes = here.groupBy(*at, "_next", "_all_n", "_all_m", "_all_b").agg(F.sum("m").alias("_m"), F.sum("b").alias("_b"))
        values = nodes.groupBy(*at).agg(F.count(F.lit(1)).alias("_values"))
        p = F.col("_all_b") / F.col("_all_m")
        error = F.sqrt(p * (1 - p) / F.col("_m"))
        variable = (F.col("_values") >= VALUES) & (F.col("_values") >= SPREAD * F.col("_all_n"))
        alike = (F.col("_m") > 0) & (F.abs(F.col("_b") / F.col("_m") - p) <= SIMILAR * error)
        name = F.when(F.col("_next") == "", F.lit("")).when(variable, F.lit("/*")).when(alike, F.lit("/+")).otherwise(
            F.concat(F.lit("/"), "_next"))
        named = nodes.join(values, at).select(*at, "_next", name.alias("_name"))
        skipped = F.transform(F.slice("rest", 1, F.col("_k")), lambda s: F.concat(F.lit("/"), s))
        moved = here.join(named, [*at, "_next"]).select(
            "host", "shape", "n", "m", "b", "purity",
            F.expr("slice(rest, _k + 2, greatest(size(rest) - _k - 1, 0))").alias("rest"), (F.col("_next") == "").alias("ended"),
            F.concat("template", F.array_join(skipped, ""), "_name").alias("template"))
        pooled = moved.groupBy(*at).agg(*[F.sum(c).alias(f"_{c}") for c in "nmb"])
        tree = cut(moved.join(pooled, at).withColumns({
            "purity": smooth(F.col("_n"), F.col("_b"), F.col("_m"), F.col("purity"), overall), "own": F.col("_m"),
        }).drop("_n", "_m", "_b"), "url-tree")
        done.append(tree.where("ended").select("host", "shape", "template", "purity", "own"))
        tree = tree.where("not ended").drop("ended", "own")
        if tree.isEmpty():
            return reduce(DataFrame.unionByName, done)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, reject: float = REJECT) -> DataFrame:
    """The verdict on every url.

    Returns per row of `pages`: page_id, host, path, rule (null if none fits), verdict, template,
    purity (smoothed blocked share) and own_labels (urls of the template that a rule decides).

    A null url, or one without ``://``, has an empty host and path and is judged by the template of
    those; paths of any depth and length are read whole; repeated rows are judged alike and each
    returned; a null page_id is kept; no rows give no rows. Other columns are not looked at.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "_says": says, "shape": shape_of(F.col("path"))})
    tree = templates(rows.withColumn("seed", F.col("_says") == "block"))
    rejected = (F.col("purity") >= reject) & (F.col("own") >= OWN_LABELS)
    verdict = F.coalesce("_says", F.when(rejected, F.lit("block")).otherwise(F.lit("allow")))
    return rows.join(tree, ["host", "shape"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity", F.col("own").alias("own_labels"))
