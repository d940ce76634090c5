"""Columns by exact name, so that extra columns (also ones that differ in case only, or repeat a helper's name) disturb nothing."""
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.session import fresh_path


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The first columns of exactly these names, and no others."""
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_c{df.columns.index(n)}").alias(n) for n in names])


def packed(df: DataFrame, *names: str) -> DataFrame:
    """These columns, beside the whole row as the struct `_row`."""
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(F.struct(*flat.columns).alias("_row"), *[F.col(f"_c{df.columns.index(n)}").alias(n) for n in names])


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The rows of `packed` under their own names again."""
    return df.select(*[F.col(f"_row._c{i}") for i in range(len(like.columns))]).toDF(*like.columns)


def keyed(df: DataFrame) -> DataFrame:
    """Rows of `packed` with a number of their own in `_key`, the same for every reader. A Parquet table is numbered by file and place in the
    file and not copied; other rows are staged in the shared folder."""
    spark, path, seed = df.sparkSession, fresh_path(df.sparkSession, "keyed"), 0
    rows = packed(df)
    try:
        rows = rows.select("_row", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_place"))
    except AnalysisException:
        rows.withColumn("_key", F.monotonically_increasing_id()).write.parquet(path)
        return spark.read.parquet(path)
    rows.select("_path").distinct().write.parquet(f"{path}/names")
    names, number = spark.read.parquet(f"{path}/names"), lambda c: F.xxhash64(F.lit(seed), c)
    while not names.groupBy(number("_path")).count().filter("count > 1").isEmpty():
        seed += 1
    # One pair of numbers for each file of the table: the listing that the driver holds anyway is many times larger.
    files = names.select(number("_path").alias("_file"), (F.row_number().over(Window.orderBy(number("_path"))) - 1).cast("bigint").alias("_number"))
    return (rows.withColumn("_file", number("_path")).join(F.broadcast(files), "_file")
            .select("_row", (F.col("_number") * (1 << 40) + F.col("_place")).alias("_key")))


def field(like: DataFrame, name: str) -> Column:
    """The column that `pick` takes, in rows of `packed`."""
    return F.col(f"_row._c{like.columns.index(name)}").alias(name)
