"""URL filter by a path-template tree, with DataFrame functions only.

Level by level, from the host down, each branch point (host and template so far) decides about its segments:
* variable ones become the wildcard: where most segments of a branch point are rare (fewer than REPEATS pages each, VARIETY or more of
  them), every segment below SHARE of its pages does;
* branches that are statistically similar are merged into it: those whose share of bad labels lies within Z standard
  errors of their siblings' common share, or that have fewer than LABELS labels.
Below DEPTH levels a path ends in `/**`. A template's purity is its share of good labels, smoothed towards its host's, which is
smoothed towards the share of all. Templates below PURITY are rejected. Rules decide first: of those that fit, the longest.

Counts are grouped sums (combined in each task before the shuffle) joined back on whole keys, so a hot host is spread over
its segments, and adaptive execution may split what is left. The only values that reach the driver are two label totals.

Defined results: a null url, or one without `://`, has an empty host and path and is judged as such; a page without label counts for
the tree only; of several labels of a page the worst counts; repeated rows are judged alike; without labels nothing is rejected.
"""
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.frames import pick
from lectern.session import fresh_path

DEPTH = 3
VARIETY, REPEATS, SHARE = 16, 8, 0.05
Z, LABELS = 3.0, 20
SMOOTH, PURITY = 10.0, 0.5
WILD = "*"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (`host/path`) that fits; null if none does."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, start = rule.partition("/")
        fits.append(F.when(((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}"), F.lit(rule)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def _segment(level: int) -> Column:
    return F.coalesce(F.get("segments", F.lit(level)), F.lit("$"))


def _generalised(rows: DataFrame) -> DataFrame:
    """rows with the next segment `part` of `template` made a wildcard where the tree says so, and the level appended."""
    branch, child = ["host", "template"], ["host", "template", "part"]
    children = rows.groupBy(*child).agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.sum("bad").alias("bads"))
    points = children.groupBy(*branch).agg(F.count("*").alias("kinds"), F.sum("n").alias("all_n"), F.sum("labelled").alias("all_labelled"),
                                           F.sum("bads").alias("all_bads"))
    share = F.coalesce(F.col("all_bads") / F.nullif("all_labelled", F.lit(0)), F.lit(0.0))
    error = F.sqrt(share * (1 - share) / F.greatest("labelled", F.lit(1)))
    variable = (F.col("kinds") >= VARIETY) & (F.col("all_n") < REPEATS * F.col("kinds")) & (F.col("n") < SHARE * F.col("all_n"))
    similar = (F.col("labelled") < LABELS) | (F.abs(F.coalesce("bads", F.lit(0)) / F.greatest("labelled", F.lit(1)) - share) <= Z * error)
    merged = (F.col("kinds") > 1) & (F.col("part") != "$") & (variable | similar)
    names = children.join(points, branch).select(*child, F.when(merged, F.lit(WILD)).otherwise(F.col("part")).alias("_named"))
    return (rows.join(names, child).withColumn("template", F.when(F.col("_named") == "$", F.col("template"))
                                               .otherwise(F.concat("template", F.lit("/"), "_named"))).drop("_named"))


def templates(pages: DataFrame) -> DataFrame:
    """pages (page_id, host, path, bad: 1, 0 or null) with `template`; each level is staged in the shared folder."""
    spark, path = pages.sparkSession, fresh_path(pages.sparkSession, "url-tree")
    rows = pages.withColumn("segments", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("template", F.lit(""))
    for level in range(DEPTH):
        _generalised(rows.withColumn("part", _segment(level))).drop("part").write.parquet(f"{path}/{level}")
        rows = spark.read.parquet(f"{path}/{level}")
    tail = F.when(F.size("segments") > DEPTH, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return rows.withColumn("template", tail).drop("segments")


def judged(pages: DataFrame, labels: DataFrame, rules: dict[str, str]) -> DataFrame:
    """pages (page_id, url) and labels (page_id, bad) to (page_id, host, path, rule, verdict, template, purity)."""
    host, path = host_and_path(F.col("url"))
    worst = pick(labels, "page_id", "bad").filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    rows = templates(pick(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path")).join(worst, "page_id", "left"))
    total = rows.agg(F.count("bad"), F.coalesce(F.sum("bad"), F.lit(0))).first()
    good_of_all = (total[0] - total[1] + SMOOTH) / (total[0] + SMOOTH)
    hosts = rows.groupBy("host").agg(F.count("bad").alias("_labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("_bads"))
    hosts = hosts.select("host", ((F.col("_labelled") - F.col("_bads") + SMOOTH * good_of_all) / (F.col("_labelled") + SMOOTH)).alias("_prior"))
    kinds = rows.groupBy("host", "template").agg(F.count("bad").alias("_labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("_bads")).join(hosts, "host")
    purity = kinds.select("host", "template", ((F.col("_labelled") - F.col("_bads") + SMOOTH * F.col("_prior")) / (F.col("_labelled") + SMOOTH)).alias("purity"))
    rule = rule_for(F.col("host"), F.col("path"), rules)
    verdict = F.element_at(F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]), F.col("rule")) if rules else F.lit(None).cast("string")
    return (rows.join(purity, ["host", "template"]).withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(verdict, F.when(F.col("purity") < PURITY, "block").otherwise("allow")))
            .select("page_id", "host", "path", "rule", "verdict", "template", "purity"))
