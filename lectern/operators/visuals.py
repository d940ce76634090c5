"""Rendered visuals: work list, coverage, card lint. Cards and pages are HTML texts."""
from pyspark.sql import Column, DataFrame, functions as F

from lectern import vocab
from lectern.functions import fences as fn
from lectern.functions.text import literal_array, visual_slug
from lectern.operators.drafts import parse_visuals

CARD = r'(?s)<div class="viz">(.*?)</div>\s*</body>'


def visual_worklist(drafts: DataFrame) -> DataFrame:
    visuals, _ = parse_visuals(drafts)
    kind = visual_slug(F.coalesce(F.nullif("type", F.lit("")), F.lit("diagram")))
    asset = F.format_string("%s/v%02d-%s", F.col("stem"), F.col("n"), kind)
    return visuals.select("course_id", "stem", "n", "type", "title", asset.alias("asset_id"))


def render_coverage(worklist: DataFrame, assets: DataFrame) -> DataFrame:
    """assets(course_id, stem, file): a spec is rendered when its own PNG exists."""
    pngs = (assets.filter(F.col("file").rlike(r"\.png\z"))
            .select("course_id", F.concat_ws("/", "stem", F.regexp_replace("file", r"\.png\z", "")).alias("asset_id"))
            .distinct().withColumn("done", F.lit(1)))
    return (worklist.join(pngs, ["course_id", "asset_id"], "left").groupBy("course_id", "stem")
            .agg(F.count("*").alias("total"), F.count("done").alias("rendered")))


def asset_choice(assets: DataFrame) -> DataFrame:
    """One shipped file per spec number: WebP before PNG; the last WebP, else the first PNG, by name."""
    named = (assets.withColumn("n", F.regexp_extract("file", r"\Av(\d+)-.*\.(?:png|webp)\z", 1).try_cast("int"))
             .filter("n is not null"))
    webp = F.endswith("file", F.lit(".webp"))
    return (named.groupBy("course_id", "stem", "n")
            .agg(F.coalesce(F.max(F.when(webp, F.col("file"))), F.min(F.when(~webp, F.col("file")))).alias("file")))


def spec_render_mismatch(drafts: DataFrame, assets: DataFrame) -> DataFrame:
    """Only drafts that have renders at all; a spec is any exact ```visual line."""
    rendered = asset_choice(assets).groupBy("course_id", "stem").agg(F.count("*").alias("rendered"))
    specs = drafts.select("course_id", "stem", F.size(F.filter(
        fn.fences(F.col("md")), lambda f: f == "```visual")).cast("bigint").alias("specs"))
    return specs.join(rendered, ["course_id", "stem"]).filter("specs <> rendered")


def card_body(html: Column, pattern: str = CARD) -> Column:
    return F.regexp_extract(html, pattern, 1)


def css_lint(pages: DataFrame, banned=tuple(vocab.FORBIDDEN_CSS), pattern: str | None = CARD) -> DataFrame:
    """pages(page_id, html). Without a card pattern the whole page is read with its comments removed."""
    text = card_body(F.col("html"), pattern) if pattern else F.regexp_replace("html", r"(?s)<!--.*?-->", "")
    read = pages.select("page_id", text.alias("text"))
    return read.select("page_id", F.explode_outer(F.filter(literal_array(list(banned)), lambda b: F.contains("text", b))).alias("css")).filter("css is not null")


def density_class(pages: DataFrame, pattern: str = CARD) -> DataFrame:
    text = card_body(F.col("html"), pattern)
    for p, to in [(r"(?s)<style.*?</style>", ""), (r"(?s)<!--.*?-->", ""), (r"<[^>]+>", " "), (r"\s+", " ")]:
        text = F.regexp_replace(text, p, to)
    size = F.length(F.trim(text))
    return pages.select("page_id", size.cast("bigint").alias("chars"),
                        F.when(size > 600, 1).when(size < 345, 3).otherwise(2).cast("bigint").alias("density"))
