"""Files of a course tree. Content is read only where it is needed; listings take paths and sizes alone."""
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern import schemas
from lectern.functions.text import is_json, strip

DRAFT_PATH = r"([^/]+)/lessons/drafts/(m\d+-l\d[^/]*)\.md\z"
ASSET_PATH = r"([^/]+)/lessons/assets/([^/]+)/([^/]+)\z"


def _texts(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), "value"))


def _listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
            .load(path).select("path", "length"))


def read_drafts(spark: SparkSession, root: str) -> DataFrame:
    return parse_drafts(_texts(spark, root, "*.md"))


def parse_drafts(texts: DataFrame) -> DataFrame:
    """Lesson drafts only: covers and other pages do not carry a lesson stem."""
    return (texts.withColumn("course_id", F.regexp_extract("path", DRAFT_PATH, 1)).filter("course_id <> ''")
            .select("course_id", F.regexp_extract("path", DRAFT_PATH, 2).alias("stem"), F.col("value").alias("md")))


def read_blocklist(spark: SparkSession, path: str) -> DataFrame:
    return parse_blocklist(spark.read.text(path))


def parse_blocklist(lines: DataFrame) -> DataFrame:
    """lines(value): trimmed, lower case, without blanks and # comments."""
    return (lines.select(F.lower(strip(F.col("value"))).alias("phrase"))
            .filter((F.col("phrase") != "") & ~F.startswith("phrase", F.lit("#"))).distinct())


def read_challenge_files(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """files(course_id, path) of the challenge folders and test_files(course_id, path, value)."""
    where = r"([^/]+)/(challenges/.+)\z"
    files = parse_paths(_listing(spark, root), where)
    tests = _texts(spark, root, "tests.json")
    return files, parse_paths(tests, where, "value")


def parse_paths(listing: DataFrame, pattern: str, *more: str) -> DataFrame:
    """Course and path inside the course, from full paths."""
    return (listing.withColumn("course_id", F.regexp_extract("path", pattern, 1)).filter("course_id <> ''")
            .select("course_id", F.regexp_extract("path", pattern, 2).alias("path"), *more))


def test_cases(test_files: DataFrame) -> DataFrame:
    """The cases of well-formed test files: (course_id, path, case_id, input, expected)."""
    arrays = test_files.filter(is_json(F.col("value")) & F.col("value").rlike(r"\A\s*\["))
    return (arrays.select("course_id", "path", F.explode(F.from_json("value", schemas.TEST_CASES)).alias("t"))
            .select("course_id", "path", F.col("t.id").alias("case_id"), "t.input", F.col("t.expectedOutput").alias("expected")))


def read_assets(spark: SparkSession, root: str) -> DataFrame:
    return parse_assets(_listing(spark, root))


def parse_assets(listing: DataFrame) -> DataFrame:
    """assets(course_id, stem, file, n, bytes): n is the spec number of a rendered visual, else null."""
    file = F.regexp_extract("path", ASSET_PATH, 3)
    return (listing.withColumn("course_id", F.regexp_extract("path", ASSET_PATH, 1)).filter("course_id <> ''")
            .select("course_id", F.regexp_extract("path", ASSET_PATH, 2).alias("stem"), file.alias("file"),
                    F.regexp_extract(file, r"\Av(\d+)-.*\.(png|webp|html)\z", 1).try_cast("int").alias("n"),
                    F.col("length").alias("bytes")))


def read_diagnostics(spark: SparkSession, path: str, dialect: str) -> DataFrame:
    return parse_diagnostics(spark.read.text(path), dialect)


# Lines of compiler logs.
TS_LINE = r"^(?:[^/\s]+/)?b(\d+)\.tsx?\((\d+),(\d+)\):\s*(error TS\d+:.*)"
CARGO_SUMMARY = r"^(could not compile|aborting due to)"
CARGO_MESSAGE = ("reason STRING, message STRUCT<level: STRING, message: STRING, code: STRUCT<code: STRING>, "
                 "spans: ARRAY<STRUCT<is_primary: BOOLEAN, label: STRING>>>")


def parse_diagnostics(lines: DataFrame, dialect: str) -> DataFrame:
    """lines(value, …) -> the other columns, block (TypeScript only), msg. Summaries are dropped."""
    rest = [c for c in lines.columns if c != "value"]
    if dialect == "ts":
        line = strip(F.col("value"))
        return (lines.withColumn("msg", F.regexp_extract(line, TS_LINE, 4)).filter("msg <> ''")
                .select(*rest, F.regexp_extract(line, TS_LINE, 1).cast("int").alias("block"), "msg"))
    # The array is a barrier: without it every use of a field would parse the line again.
    parsed = (lines.filter(F.contains("value", F.lit("compiler-message")))
              .select(*rest, F.explode(F.array(F.from_json("value", CARGO_MESSAGE))).alias("j"))
              .filter("j.reason = 'compiler-message' and j.message.level = 'error'"))
    text = strip(F.coalesce("j.message.message", F.lit("")))
    code = F.col("j.message.code.code")
    head = F.when(F.coalesce(code, F.lit("")) != "", F.concat(F.lit("error["), code, F.lit("]: "), text)).otherwise(
        F.concat(F.lit("error: "), text))
    labels = F.filter("j.message.spans", lambda s: s["is_primary"] & (F.coalesce(s["label"], F.lit("")) != ""))
    primary = F.get(labels, F.lit(0))["label"]
    return (parsed.filter((text != "") & ~text.rlike(CARGO_SUMMARY))
            .select(*rest, F.when(primary.isNotNull(), F.concat(head, F.lit(" — "), primary)).otherwise(head).alias("msg")))


def read_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Exemplar catalogs: the folder names the form."""
    texts = _texts(spark, root, "catalog.md")
    return parse_catalog(texts.select(F.regexp_extract("path", r"([^/]+)/catalog\.md\z", 1).alias("form"), F.col("value").alias("md")))


def parse_catalog(texts: DataFrame) -> DataFrame:
    """texts(form, md) -> catalog(form, n, title, author, url, year, note), from numbered lists or pipe tables."""
    entries = F.filter(F.split(F.concat(F.lit("\n"), "md"), r"\n(?=\d+\.\s)|\n(?=\|)|\n(?=#)", -1),
                       lambda e: e.rlike(r"\A(\d+\.\s|\|\s*\d+\s*\|)"))
    rows = texts.select("form", F.explode(entries).alias("e"))
    e = F.regexp_replace("e", r"\s+", " ")
    is_row = F.startswith("e", F.lit("|"))
    cells = F.transform(F.split(e, r"\|", -1), strip)
    parts = F.transform(F.split(F.regexp_replace(e, r"\A\d+\.\s*", ""), " — ", -1), strip)

    def pick(row_i: int, list_i: int) -> Column:
        return F.when(is_row, F.get(cells, F.lit(row_i))).otherwise(F.get(parts, F.lit(list_i)))

    number = F.regexp_extract(e, r"\A\|?\s*(\d+)", 1).try_cast("bigint")
    note = F.when(is_row, F.get(cells, F.lit(6))).otherwise(F.array_join(F.slice(parts, 5, 1 << 20), " — "))
    return rows.select(
        "form", number.alias("n"), F.regexp_replace(pick(2, 0), r"\*\*", "").alias("title"), pick(3, 1).alias("author"),
        F.nullif(F.regexp_extract(pick(4, 2), r"(https?://\S+)", 1), F.lit("")).alias("url"),
        F.regexp_extract(pick(5, 3), r"(\d{4})", 1).try_cast("bigint").alias("year"), strip(note).alias("note"))
