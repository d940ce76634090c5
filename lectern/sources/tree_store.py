"""A file tree kept as a table, with the lock of what was generated: plans are applied, hand edits survive, and a run counts once.

<root>/versions/<run>/bucket=<b>/  rows of the buckets that the run has changed: (course_id, path, content, content_sha, lock_sha, edited_by_human)
<root>/versions/<run>.actions/     what the run did with each planned file
<root>/pointers/seq=<n>/           for the n-th change, which folder holds each bucket; one small file, so it appears at once or not at all

Readers follow the last pointer. A run writes its own folder first and the pointer last: if it dies in between, nothing has changed and the same run may be
started again; if it is repeated after that, it finds its name among the pointers and changes nothing. Only buckets with a change are
read in full and rewritten. One writer at a time.
"""
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FILE = ["course_id", "path"]
STATE = "course_id STRING, path STRING, content STRING, content_sha STRING, lock_sha STRING, edited_by_human BOOLEAN"
POINTER = "seq BIGINT, run STRING, bucket INT, folder STRING"
BUCKETS = 64


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/pointers")
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(POINTER).json(f"{root}/pointers/*") if there else spark.createDataFrame([], POINTER)


def _folders(spark: SparkSession, root: str) -> tuple[int, dict[int, str]]:
    """Number of the last change and the folder of each bucket: at most as many rows as there are buckets."""
    rows = _pointers(spark, root)
    last = rows.agg(F.max("seq")).first()[0]
    return (0, {}) if last is None else (last, {r.bucket: r.folder for r in rows.filter(F.col("seq") == last).collect()})  # no folder: no rows yet


def _state(spark: SparkSession, folders) -> DataFrame:
    folders = sorted(f for f in folders if f)
    return spark.read.schema(STATE).parquet(*folders) if folders else spark.createDataFrame([], STATE)


def read_tree(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """files(course_id, path, content) and lock(course_id, path, sha256, edited_by_human) as they stand."""
    state = _state(spark, _folders(spark, root)[1].values())
    return (state.filter("content IS NOT NULL").select(*FILE, "content"),
            state.filter("lock_sha IS NOT NULL").select(*FILE, F.col("lock_sha").alias("sha256"), "edited_by_human"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("course_id"), F.lit(buckets)).cast("int")


def _planned(force: bool):
    """A generated file: written unless a person has edited it since; the lock then names the edited text."""
    edited = F.coalesce(F.col("content_sha") != F.col("lock_sha"), F.lit(False)) & F.lit(not force)
    return lambda given: {
        "content": F.when(~given | edited, F.col("content")).otherwise(F.col("new")),
        "content_sha": F.when(~given | edited, F.col("content_sha")).otherwise(F.col("new_sha")),
        "lock_sha": F.when(given, F.when(edited, F.col("content_sha")).otherwise(F.col("new_sha"))),
        "edited_by_human": F.when(given, edited)}


def _by_hand(given: Column) -> dict[str, Column]:
    """A person's text: the lock stays as it is."""
    return {"content": F.when(given, F.col("new")).otherwise(F.col("content")), "content_sha": F.when(given, F.col("new_sha")).otherwise(F.col("content_sha")),
            "lock_sha": F.col("lock_sha"), "edited_by_human": F.col("edited_by_human")}


def _apply(given: DataFrame, root: str, run: str, buckets: int, rule) -> DataFrame:
    spark = given.sparkSession
    actions = f"{root}/versions/{run}.actions"
    if not _pointers(spark, root).filter(F.col("run") == run).isEmpty():
        return spark.read.parquet(actions)
    seq, folders = _folders(spark, root)
    buckets = len(folders) or buckets
    new = given.select(*[F.col(c).cast("string").alias(c) for c in FILE], F.col("content").alias("new"), F.sha2("content", 256).alias("new_sha"), F.lit(True).alias("given"))
    known = F.coalesce("given", F.lit(False))
    after = rule(known)
    changed = ~(after["content_sha"].eqNullSafe(F.col("content_sha")) & after["lock_sha"].eqNullSafe(F.col("lock_sha"))
                & after["edited_by_human"].eqNullSafe(F.col("edited_by_human")))
    # Only hashes are compared here, so contents of the tree are not read.
    (new.drop("new").join(_state(spark, folders.values()).drop("content"), FILE, "full")
     .select(*FILE, known.alias("given"), F.when(F.coalesce(after["edited_by_human"], F.lit(False)), "skip").otherwise("write").alias("action"),
             F.coalesce(after["lock_sha"], after["content_sha"]).alias("sha256"), F.coalesce(after["edited_by_human"], F.lit(False)).alias("edited_by_human"), changed.alias("changed"))
     .write.mode("overwrite").parquet(actions))
    done = spark.read.parquet(actions)
    touched = sorted(r[0] for r in done.filter("changed").select(_bucket(buckets)).distinct().collect())
    state = _state(spark, [folders[b] for b in touched if folders.get(b)])
    (new.filter(_bucket(buckets).isin(touched)).join(state, FILE, "full").select(*FILE, *[after[c].alias(c) for c in ("content", "content_sha", "lock_sha", "edited_by_human")])
     .filter("content IS NOT NULL OR lock_sha IS NOT NULL").withColumn("bucket", _bucket(buckets)).repartition("bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/versions/{run}"))
    written = {r[0] for r in spark.read.schema(f"{STATE}, bucket INT").parquet(f"{root}/versions/{run}").select("bucket").distinct().collect()} if touched else set()
    where = {**folders, **{b: f"{root}/versions/{run}/bucket={b}" if b in written else None for b in touched}}
    # Every pointer names all buckets, so their number is fixed by a tree's first run.
    rows = [(seq + 1, run, b, where.get(b)) for b in range(buckets)]
    spark.createDataFrame(rows, POINTER).coalesce(1).write.json(f"{root}/pointers/seq={seq + 1}")
    return done


def apply_plan(planned: DataFrame, root: str, run: str, force: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """planned(course_id, path, content) -> actions(course_id, path, action, sha256, edited_by_human) of the planned files, once they are applied.
    A file that a person has edited is skipped unless forced. Files that are planned no more stay, and leave the lock."""
    return _apply(planned, root, run, buckets, _planned(force)).filter("given").drop("given", "changed")


def apply_edits(edits: DataFrame, root: str, run: str, buckets: int = BUCKETS) -> None:
    """edits(course_id, path, content): what people have changed by hand."""
    _apply(edits, root, run, buckets, _by_hand)
