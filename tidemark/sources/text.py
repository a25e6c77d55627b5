"""Line and document sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .containers import register


def _parsed(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Rows of JSON lines (``value``); blank and malformed ones are skipped."""
    struct = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    marked = T.StructType([*struct.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.filter(F.col("value").rlike(r"\S")).select(F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.filter(F.col("r._bad").isNull()).select("r.*").drop("_bad")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines, plain or gzip by suffix; blank and malformed lines are skipped."""
    return _parsed(spark.read.text(path), schema)


def read_salvaged(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines of a file or folder; a gzip file that breaks off or is broken keeps every line that could be unpacked."""
    register(spark)
    return _parsed(spark.read.format("lines").load(path).select("value"), schema)


def read_jsonl_strict(spark: SparkSession, path: str, schema: T.StructType | str, required: tuple[str, ...] = ()) -> DataFrame:
    """JSON lines; malformed lines, values of another type and nulls in ``required`` columns raise when rows are read, an empty file at once."""
    lines = spark.read.text(path)
    listed = spark.createDataFrame([(f,) for f in lines.inputFiles()], "file string")
    empty = listed.join(lines.select(F.input_file_name().alias("file")).distinct(), "file", "left_anti").limit(1).collect()
    if empty:
        raise ValueError(f"empty file {empty[0].file}")
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    for name in required:
        message = F.lit(f"missing or malformed {name}")
        df = df.withColumn(name, F.when(F.col(name).isNull(), F.raise_error(message).cast(df.schema[name].dataType)).otherwise(F.col(name)))
    return df


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that hold one JSON value each, pretty-printed arrays included."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """``row`` elements of an XML dump of posts."""
    schema = "_Id bigint, _PostTypeId int, _ParentId bigint, _Title string, _Body string, _Tags string"
    posts = spark.read.format("xml").option("rowTag", "row").schema(schema).load(path)
    return posts.select(*[F.col(c).alias(c[1:]) for c in posts.columns])


def answers_with_questions(posts: DataFrame, order: str = "Id") -> DataFrame:
    """Answers joined to their question, if that came earlier."""
    q = posts.filter("PostTypeId = 1").select(F.col("Id").alias("ParentId"), F.col("Title").alias("question"), F.col(order).alias("_q"))
    return posts.filter("PostTypeId = 2").join(q, "ParentId").filter(F.col("_q") < F.col(order)).select("Id", "ParentId", "question", F.col("Body").alias("answer"))


def peek(df: DataFrame, n: int, text: str) -> DataFrame:
    """The first ``n`` records, whether each has token tags, and its keys if it is a JSON object."""
    return df.limit(n).withColumns({"has_tokens": F.col(text).rlike(r"<[a-z0-9_]+_[0-9]+>"), "keys": F.json_object_keys(text)})


def peek_files(lines: DataFrame, n: int) -> DataFrame:
    """Of every file (``path``, ``line``, ``value``) the first ``n`` JSON records: their ``keys`` with types, as one schema, how many they are and whether any has tokens."""
    first = lines.filter(F.col("line") < n).withColumn("v", F.try_parse_json("value"))
    tokens = F.bool_or(F.col("value").rlike(r"<[a-z0-9_]+_[0-9]+>"))
    return first.groupBy("path").agg(F.schema_of_variant_agg("v").alias("keys"), F.count("*").alias("records"), tokens.alias("has_tokens"))


def partition_of(index: Column, parts: int, how: str, total: int | None = None) -> Column:
    """The part of the i-th file: ``modulo`` (also stride slices) or ``contiguous`` blocks of ceil(total / parts)."""
    if how == "modulo":
        return F.pmod(index, F.lit(parts))
    if not total:
        raise ValueError("contiguous parts need the total number of files")
    return F.least(F.floor(index / F.lit(-(-total // parts))), F.lit(parts - 1))


def valid_fps(fps: Column) -> Column:
    """Frame rates in (0, 240], to six places; others null."""
    return F.when((fps > 0) & (fps <= 240), F.bround(fps, 6))


def with_video_id(df: DataFrame) -> DataFrame:
    """``video_id`` from the file's name where a row lacks it."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.jsonl?(\.gz)?)?$", 1)
    return df.withColumn("video_id", F.coalesce("video_id", name))
