"""Small tables with the awkward cases every operator must take."""

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, block string, size string"


def documents(spark: SparkSession, rows) -> DataFrame:
    """Rows of (doc_id, text, source); the last columns carry names that operators use inside."""
    full = [(i, t, "en", s, None if t is None else len(t), "x", "y", "z") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = " ".join(f"word{i % 977} of the{i % 13}" for i in range(40_000))
COMMON = "a shared passage that stands in many documents of this table and is long enough to matter, " * 3
EDGE = [
    (None, "a text without a number", "s1"),
    (1, None, "s1"),
    (2, "", "s2"),
    (3, " \t\n ", None),
    (4, "one", "s1"),
    (5, COMMON + "five", "s1"),
    (6, COMMON + "six", "s2"),
    (7, COMMON + "five", "s1"),
    (8, LONG, "s3"),
    (9, "Ünïcode 文字 🙂 <|endoftext|> ́mark", None),
    (10, "twice the same row", "s2"),
    (10, "twice the same row", "s2"),
]


def edge(spark: SparkSession) -> DataFrame:
    return documents(spark, EDGE)


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, EDGE).where("false")


def on_disk(df: DataFrame, folder: str) -> DataFrame:
    """A table that rereads alike."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)
