"""URL filters by a tree of path templates.

Rules come first: a rule ``host/path`` fits its host and all subdomains where the url's path
starts with its path, and the longest one decides. Urls without a rule are judged by a tree
of path templates that learns from labelled urls.

The tree is grown per host, one path segment at a time, over the distinct paths. Under each
node, segments that are frequent stay literal branches; the many rare ones are generalised
to the wildcard ``*``. A literal branch that is statistically similar to the rest (shares of
rejected labels and of numeric next segments differ by less than ``Z`` standard errors, and
both or neither carry labels) is merged into the wildcard. A finished template is rejected
when its labelled purity, the share of rejected urls among its labelled ones smoothed towards
one half, reaches ``PURITY``: at least three labelled urls, nearly all of them rejected.

All work is DataFrame expressions: each level is two aggregations and a join on (host,
template so far, segment), so a hot host is spread over its segments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import checkpointed, small_partitions

DEPTH = 5
# A segment stays literal with this many urls and this share of its node's.
LEAST_URLS, LEAST_SHARE = 5, 0.05
Z = 1.96
# Rejected and accepted urls added to each template's, and the purity that rejects.
PRIOR, PURITY = 2.0, 0.7
WILDCARD = "*"

Rule = tuple[str, str, str]  # host, path, allow or block


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(part(1), upper, upper.lower()), part(2)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct ``(rule, verdict)`` of the longest fitting rule, else null; of equal rules the first."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(reversed(rules), key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _similar(rest_n: Column, n: Column, rest_hits: Column, hits: Column) -> Column:
    """Whether two shares differ by less than ``Z`` standard errors of their pooled share."""
    pooled = (hits + rest_hits + 1) / (n + rest_n + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest(n, F.lit(1)) + 1 / F.greatest(rest_n, F.lit(1))))
    gap = F.abs(hits / F.greatest(n, F.lit(1)) - rest_hits / F.greatest(rest_n, F.lit(1)))
    return gap < Z * error


def templates(paths: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(host, path, template)`` with counts, from distinct ``(host, path, n, labelled, rejected)``.

    ``n`` counts urls, ``labelled`` those with a label and ``rejected`` those labelled so.
    Segments beyond ``depth`` count as one.
    """
    pieces = F.split(F.regexp_replace("path", "^/", ""), "/", depth)
    tree = checkpointed(paths.withColumns({"pieces": pieces, "template": F.lit("")}))
    for level in range(depth):
        piece = F.get("pieces", F.lit(level))
        following = F.get("pieces", F.lit(level + 1))
        node = tree.where(piece.isNotNull()).select(
            "host", "template", piece.alias("piece"), "n", "labelled", "rejected",
            F.when(following.rlike("[0-9]"), F.col("n")).otherwise(0).alias("numeric"),
        )
        counts = ["n", "labelled", "rejected", "numeric"]
        branches = checkpointed(node.groupBy("host", "template", "piece").agg(*[F.sum(c).alias(c) for c in counts]))
        whole = branches.groupBy("host", "template").agg(*[F.sum(c).alias(f"all_{c}") for c in counts])
        b = branches.join(whole, ["host", "template"])
        rest = {c: F.col(f"all_{c}") - F.col(c) for c in counts}
        frequent = (F.col("n") >= LEAST_URLS) & (F.col("n") >= LEAST_SHARE * F.col("all_n"))
        same_labels = ((F.col("labelled") > 0) == (rest["labelled"] > 0)) & (
            (F.col("labelled") == 0) | _similar(rest["labelled"], F.col("labelled"), rest["rejected"], F.col("rejected"))
        )
        merged = (rest["n"] > 0) & same_labels & _similar(rest["n"], F.col("n"), rest["numeric"], F.col("numeric"))
        literal = b.where(frequent & ~merged).select("host", "template", "piece", F.lit(True).alias("literal"))
        token = F.when(F.col("literal"), F.col("piece")).when(F.col("piece").isNotNull(), F.lit(WILDCARD))
        tree = checkpointed(
            tree.withColumn("piece", piece).join(checkpointed(literal), ["host", "template", "piece"], "left")
            .withColumn("template", F.when(token.isNull(), F.col("template")).otherwise(F.concat_ws("/", "template", token)))
            .select("host", "path", "n", "labelled", "rejected", "pieces", "template")
        )
    return tree.drop("pieces")


def judged_templates(tree: DataFrame) -> DataFrame:
    """``(host, template, labelled, purity, blocked)`` of every template of ``templates``."""
    counted = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("rejected").alias("rejected"))
    purity = (F.col("rejected") + PRIOR) / (F.col("labelled") + 2 * PRIOR)
    return counted.select("host", "template", "labelled", purity.alias("purity"), (purity >= PURITY).alias("blocked"))


def judged(pages: DataFrame, rules: Sequence[Rule], labels: DataFrame | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` of every url.

    ``labels`` has ``(url, rejected 0/1)``; where it is not given, the urls that a rule
    decides are the labelled ones. A null or broken url has the empty host and path, and is
    judged by the template of those. Repeated rows are judged each.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    urls = small_partitions(pages.select("page_id", "url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    urls = checkpointed(urls.withColumn("r", rule_for(F.col("host"), F.col("path"), rules)))
    if labels is None:
        marked = urls.withColumn("rejected", F.when(F.col("r.verdict") == "block", 1).when(F.col("r").isNotNull(), 0))
    else:
        host, path = host_and_path(F.col("url").cast("string"))
        marked = urls.select("host", "path", F.lit(None).cast("int").alias("rejected")).unionByName(
            labels.select(host.alias("host"), path.alias("path"), F.col("rejected").cast("int"))
        )
    paths = marked.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("rejected").alias("labelled"), F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected")
    )
    tree = templates(paths)
    verdicts = checkpointed(judged_templates(tree))
    by_path = tree.select("host", "path", "template").join(verdicts, ["host", "template"])
    verdict = F.coalesce("r.verdict", F.when(F.col("blocked"), "block").otherwise("allow"))
    return urls.join(checkpointed(by_path), ["host", "path"]).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "template", "purity"
    )
