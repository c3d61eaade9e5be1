r"""URL filter: fixed rules, and a tree of path templates for what no rule covers.

Per host the paths make a tree of segments. Level by level, a segment that few of its parent's pages
have is generalised to its shape: runs of digits become ``#``, other variable words ``*``. What is
left is a template, like ``/en/#.html``. A page is labelled if a rule covers it. Sibling templates whose blocked share
does not differ from what they have together by a two-proportion test are merged, and a template is
rejected if its blocked share, smoothed towards that of all labelled pages, is ``PURITY`` or more.

Only DataFrame functions: pages are first summed up by host and path, and all later steps work on
those sums. Each level is a grouping with partial aggregation and a shuffled join, which Spark can
split where one host holds a third of all pages.

Defined cases: a null url, or one without ``://``, has an empty host and path; paths deeper than
``DEPTH`` segments keep the rest as one ``**``; without labelled pages nothing is rejected; repeated
rows are judged each; other columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable

#: Host and path beginning, in one string, and the verdict.
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
DEPTH = 8
MIN_PAGES = 5
MIN_SHARE = 0.02
SMOOTHING = 4.0
PURITY = 0.8
SAME = 1.96


def host_and_path(url: str) -> list[Column]:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), ascii_uppercase, ascii_lowercase)
    return [
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(url, parts, 2), F.lit("")).alias("path"),
    ]


def matched(rules: list[tuple[str, str]]) -> list[Column]:
    """The longest rule that fits host and path, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: len(r[0])):
        host, slash, path = text.partition("/")
        at_host = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = at_host & F.col("path").startswith(slash + path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return [rule.alias("rule"), verdict.alias("ruled")]


def templates(paths: DataFrame, depth: int) -> DataFrame:
    """``paths`` (host, path, pages, ...) with the template of each path."""
    rest = F.slice("segments", depth + 1, F.greatest(F.size("segments") - depth, F.lit(0)))
    grown = (
        paths.withColumn("segments", F.split(F.expr("ltrim('/', path)"), "/", -1))
        .withColumn("template", F.lit(""))
        .withColumn("deeper", F.size(rest) > 0)
    )
    deepest = grown.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(min(depth, deepest)):
        grown = grown.withColumn("segment", F.get("segments", F.lit(level)))
        children = (
            grown.filter("segment IS NOT NULL")
            .groupBy("host", "template", "segment")
            .agg(F.sum("pages").alias("own"))
        )
        parents = children.groupBy("host", "template").agg(F.sum("own").alias("whole"))
        literal = (
            children.join(parents, ["host", "template"])
            .filter((F.col("own") >= MIN_PAGES) & (F.col("own") >= MIN_SHARE * F.col("whole")))
            .select("host", "template", "segment", F.lit(True).alias("literal"))
        )
        shape = F.when(
            F.col("segment").rlike("[0-9]"), F.regexp_replace("segment", "[0-9]+", "#")
        ).when(F.col("segment") == "", F.lit("")).otherwise(F.lit("*"))
        step = F.when(F.col("literal"), F.col("segment")).otherwise(shape)
        grown = durable(
            grown.join(literal, ["host", "template", "segment"], "left").withColumn(
                "template",
                F.when(F.col("segment").isNull(), F.col("template")).otherwise(
                    F.concat_ws("/", "template", step)
                ),
            ).drop("segment", "literal"),
            "tree",
        )
    ends = F.when(F.col("deeper"), F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return grown.withColumn("template", ends).drop("segments", "deeper")


def judged_templates(paths: DataFrame, purity: float) -> DataFrame:
    """Verdict of each host's templates from the labelled pages in them."""
    sums = [F.sum(c).alias(c) for c in ("labelled", "blocked")]
    total = paths.agg(*sums).first()
    prior = (total["blocked"] or 0) / max(total["labelled"] or 0, 1)
    own = paths.groupBy("host", "template").agg(*sums)
    own = own.withColumn("parent", F.regexp_replace("template", "/[^/]*$", ""))
    pooled = own.groupBy("host", "parent").agg(
        F.sum("labelled").alias("n"), F.sum("blocked").alias("k")
    )
    rate, p = F.col("blocked") / F.col("labelled"), F.col("k") / F.col("n")
    error = F.sqrt(p * (1 - p) * (1 / F.col("labelled") + 1 / F.col("n")))
    alike = F.when(F.col("labelled") > 0, F.abs(rate - p) <= SAME * error).otherwise(False)
    own = own.join(pooled, ["host", "parent"]).withColumn("alike", alike)
    merged = own.filter("alike").groupBy("host", "parent").agg(
        F.sum("labelled").alias("n_alike"), F.sum("blocked").alias("k_alike")
    )
    n = F.when(F.col("alike"), F.col("n_alike")).otherwise(F.col("labelled"))
    k = F.when(F.col("alike"), F.col("k_alike")).otherwise(F.col("blocked"))
    smoothed = (k + SMOOTHING * F.lit(prior)) / (n + SMOOTHING)
    return own.join(merged, ["host", "parent"], "left").select(
        "host",
        "template",
        smoothed.alias("blocked_share"),
        F.when((n > 0) & (smoothed >= purity), "block").otherwise("allow").alias("learned"),
    )


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]] = RULES,
    depth: int = DEPTH,
    purity: float = PURITY,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template`` for each row of ``pages``."""
    parsed = pages.select("page_id", *host_and_path("url")).select("*", *matched(rules))
    paths = parsed.groupBy("host", "path").agg(
        F.count("*").alias("pages"),
        F.count("ruled").alias("labelled"),
        F.count_if(F.col("ruled") == "block").alias("blocked"),
    )
    grown = durable(templates(durable(paths, "paths"), depth), "templates")
    verdicts = grown.join(judged_templates(grown, purity), ["host", "template"]).select(
        "host", "path", "template", "learned"
    )
    return parsed.join(verdicts, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", "learned").alias("verdict"),
        "template",
    )


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
