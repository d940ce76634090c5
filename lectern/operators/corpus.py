"""Profiles and routing over the content corpus: catalogs, forms, lengths, phrases."""
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lectern import vocab
from lectern.functions import fences as fn
from lectern.functions.text import strip
from lectern.operators import blocklist
from lectern.operators.flags import HARD, flag


def phrase_sweep(text_fields: DataFrame, phrases: DataFrame | blocklist.PhraseIndex) -> DataFrame:
    """text_fields(course_id, field, subject, text) x phrases(phrase): where a retired phrase still stands."""
    return blocklist.hits(text_fields, ["course_id", "field", "subject"], "text", phrases)


def draft_blocklist(drafts: DataFrame, phrases: DataFrame | blocklist.PhraseIndex) -> DataFrame:
    hits = blocklist.hits(drafts, ["course_id", "stem"], "md", phrases)
    return flag(hits, "drafts", "blocklist", HARD, F.col("stem"), F.col("phrase"))


def catalog_duplicates(catalog: DataFrame) -> DataFrame:
    return (catalog.filter("url is not null").groupBy("url").agg(F.count("*").alias("n"), F.count_distinct("form").alias("forms"))
            .filter("n > 1"))


def catalog_cube(catalog: DataFrame) -> DataFrame:
    """Entries per form and year, with both margins; 'all' marks a margin."""
    cube = catalog.cube("form", "year").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    in_margin = [F.col("g").bitwiseAND(bit) > 0 for bit in (2, 1)]
    return cube.select(F.when(in_margin[0], "all").otherwise(F.col("form")).alias("form"),
                       F.when(in_margin[1], "all").otherwise(F.coalesce(F.col("year").cast("string"), F.lit("unknown"))).alias("year"), "n")


def exact_medians(values: DataFrame, key: str, value: str, width: int = 256) -> DataFrame:
    """(key, median) of whole numbers, with no task holding a key's rows: counts per value, then per bucket of `width` values; only the buckets that
    hold the middle ranks are looked into. Nulls are left out; the median of two middle values is their mean."""
    counts = (values.filter(F.col(value).isNotNull()).groupBy(key, F.col(value).cast("bigint").alias("_v")).agg(F.count("*").alias("_n"))
              .withColumn("_b", F.floor(F.col("_v") / width)))

    def before(*within: str):
        return Window.partitionBy(key, *within[:-1]).orderBy(within[-1]).rowsBetween(Window.unboundedPreceding, -1)

    buckets = counts.groupBy(key, "_b").agg(F.sum("_n").alias("_bn"))
    ranked = (buckets.withColumn("_start", F.coalesce(F.sum("_bn").over(before("_b")), F.lit(0)))
              .join(counts.groupBy(key).agg(F.sum("_n").alias("_all")), key)
              .withColumn("_lo", F.expr("(_all - 1) div 2")).withColumn("_hi", F.expr("_all div 2")))
    middle = ranked.filter("(_lo >= _start AND _lo < _start + _bn) OR (_hi >= _start AND _hi < _start + _bn)").select(key, "_b", "_start", "_lo", "_hi")
    placed = counts.join(middle, [key, "_b"]).withColumn("_at", F.col("_start") + F.coalesce(F.sum("_n").over(before("_b", "_v")), F.lit(0)))

    def at(rank: str):
        return F.max(F.when((F.col(rank) >= F.col("_at")) & (F.col(rank) < F.col("_at") + F.col("_n")), F.col("_v")))
    return placed.groupBy(key).agg(((at("_lo") + at("_hi")) / 2).alias("median"))


def corpus_profile(pieces: DataFrame) -> DataFrame:
    """pieces(form, words, code_lines, prose_lines): size of each form."""
    sizes = pieces.groupBy("form").agg(
        F.count("*").alias("pieces"), F.sum("words").cast("bigint").alias("total_words"), F.round(F.avg("words"), 2).alias("mean_words"),
        F.min("words").cast("bigint").alias("min_words"),
        F.max("words").cast("bigint").alias("max_words"), F.sum("code_lines").cast("bigint").alias("code_lines"),
        F.sum("prose_lines").cast("bigint").alias("prose_lines"))
    return sizes.join(exact_medians(pieces, "form", "words").withColumnRenamed("median", "median_words"), "form", "left")


def pieces(drafts: DataFrame, form_column: str) -> DataFrame:
    """Words and code/prose lines of each draft, for `corpus_profile` and `length_band`."""
    cut = drafts.select("course_id", "stem", F.col(form_column).alias("form"), fn.segments(F.col("md")).alias("segs"))

    def lines(parity):
        inner = F.transform("segs", lambda s, i: F.when(i % 2 == parity, F.size(F.filter(
            F.split(s, "\n", -1), lambda x: strip(x) != ""))).otherwise(0).cast("bigint"))
        return fn.total(inner)

    words = fn.total(F.transform("segs", lambda s, i: F.when(i % 2 == 0, fn.word_count(s)).otherwise(0).cast("bigint")))
    return cut.select("course_id", "stem", "form", words.alias("words"), lines(1).alias("code_lines"), lines(0).alias("prose_lines"))


def bands_table(spark: SparkSession, bands=tuple(vocab.LENGTH_BANDS)) -> DataFrame:
    return spark.createDataFrame(list(bands), "form string, lo bigint, hi bigint")


def length_band(pieces: DataFrame, bands: DataFrame) -> DataFrame:
    """Pieces outside the word band of their form."""
    judged = pieces.join(bands, "form").withColumn("verdict", F.when(F.col("words") < F.col("lo"), "short")
                                                   .when(F.col("words") > F.col("hi"), "long"))
    return judged.filter("verdict is not null").select("course_id", "stem", "form", F.col("words").cast("bigint").alias("words"), "verdict")


def fitting_forms(pieces: DataFrame, bands: DataFrame, width: int = 500) -> DataFrame:
    """Every form whose band holds the word count: a range join as an equi-join on buckets of `width` words."""
    cells = bands.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    return (pieces.withColumn("cell", F.floor(F.col("words") / width)).drop("form").join(cells, "cell")
            .filter("words between lo and hi").select("course_id", "stem", "words", "form"))


def route_form(asks: DataFrame, column: str = "ask") -> DataFrame:
    """The first keyword rule that matches; null leaves the choice to a person."""
    low = F.lower(column)
    rules = [F.when(low.rlike(pattern), F.lit(form)) for form, pattern in vocab.FORM_KEYWORDS]
    return asks.withColumn("form", F.coalesce(*rules))
