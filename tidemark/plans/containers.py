"""Queries over containers: tables written into archives and record files, and read back by the sources."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_path
from ..sources import archives
from ..sources import text as text_sources
from .registry import Tables, query
from .tracks import FR, K_SQL, KIND_SQL, fr, k_of, kind_of

#: Compressed bytes of a file that the capped scan reads, and records of a file that are whole in them.
CAP, WHOLE = 1 << 15, 100
#: Events of one file.
OF_FILE = 256
#: Bytes of one archive: a tar is read by one task, and one inside another as one row.
SHARD_BYTES = 16 << 20

_FILES = f"WITH e AS (SELECT *, row_number() OVER (PARTITION BY event_id // {OF_FILE} ORDER BY event_id) AS n FROM events)"


def _gzip(text: str) -> bytes:
    pack = zlib.compressobj(wbits=zlib.MAX_WBITS | 16)
    return pack.compress(text.encode()) + pack.flush()


def _empty_gzip(size: int) -> bytes:
    """A gzip member of ``size`` bytes that holds nothing: its header has an extra field."""
    body = zlib.compressobj(wbits=-zlib.MAX_WBITS).flush() + bytes(8)
    extra = size - 12 - len(body)
    return b"\x1f\x8b\x08\x04" + bytes(6) + extra.to_bytes(2, "little") + bytes(extra) + body


def _in_files(t: Tables, record: Column, between: str) -> DataFrame:
    """Files of OF_FILE events each: ``member``, the text of the first WHOLE records, half of the next one, and the rest."""
    files = t.events.groupBy(F.floor(F.col("event_id") / OF_FILE).alias("file")).agg(F.array_sort(F.collect_list(F.struct("event_id", record.alias("r")))).alias("r"))  # OF_FILE rows at most
    r = F.transform("r", lambda x: x.r)
    following = F.coalesce(F.get(r, F.lit(WHOLE)), F.lit(""))
    half = F.floor(F.length(following) / 2).cast("int")
    later = F.array_join(F.slice(r, WHOLE + 2, OF_FILE), between)
    return files.select(F.concat(F.lit("events-"), "file").alias("name"), F.array_join(F.slice(r, 1, WHOLE), between).alias("first"), F.substr(following, F.lit(1), half).alias("half"), F.concat(F.substr(following, half + 1), F.when(later != "", F.concat(F.lit(between), later)).otherwise("")).alias("later"))


def _written(files: DataFrame, path: str) -> None:
    archives.register(files.sparkSession)
    files.write.format("each_file").mode("append").save(path)


@query(f"{_FILES} SELECT event_id, {KIND_SQL} AS kind, {K_SQL} AS k FROM e WHERE n <= {WHOLE}")
def q124_capped_scan(t: Tables) -> DataFrame:
    """The records of pretty-printed gzip arrays within the first CAP compressed bytes of each file; the cap cuts a record after its nested objects."""
    path = new_path(t.spark, "capped")
    inner = F.struct(k_of().alias("k"), F.struct(F.lit("{").alias("s"), F.array(F.struct("event_id")).alias("a")).alias("deeper"))
    record = F.to_json(F.struct(inner.alias("inner"), kind_of().alias("kind"), "event_id"), {"pretty": "true"})

    @F.pandas_udf("binary")
    def packed(first: pd.Series, half: pd.Series, later: pd.Series) -> pd.Series:
        def one(a: str, b: str, c: str) -> bytes:
            head = _gzip("[" + a + (",\n" + b if b else ""))
            return head + _empty_gzip(CAP - len(head)) + _gzip(c + "]")

        return pd.Series([one(*x) for x in zip(first, half, later, strict=True)])

    _written(_in_files(t, record, ",\n").select(F.concat("name", F.lit(".json.gz")).alias("member"), packed("first", "half", "later").alias("content")), path)
    r = archives.capped_json(t.spark, path, CAP).select(F.from_json("record", "event_id bigint, kind string, inner struct<k: bigint>").alias("r"))
    return r.select("r.event_id", "r.kind", "r.inner.k")


def _broken_lines(t: Tables) -> DataFrame:
    """Gzip JSON lines of which the second half breaks off, read back."""
    path = new_path(t.spark, "broken")
    shown = F.when(F.col("event_type") == "view", F.concat(F.lit("<seed2_"), k_of(), F.lit(">"))).otherwise("plain")
    record = F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "'), "event_type", F.lit('": '), k_of(), F.lit(', "t": "'), shown, F.lit('"}'))

    @F.pandas_udf("binary")
    def packed(first: pd.Series, half: pd.Series, later: pd.Series) -> pd.Series:
        return pd.Series([_gzip(a + "\n") + _gzip(b + c)[:12] for a, b, c in zip(first, half, later, strict=True)])

    _written(_in_files(t, record, "\n").select(F.concat("name", F.lit(".jsonl.gz")).alias("member"), packed("first", "half", "later").alias("content")), path)
    return archives.read(t.spark, "lines", path)


@query(f"{_FILES} SELECT event_id, n - 1 AS line FROM e WHERE n <= {WHOLE}")
def q135_salvaged_lines(t: Tables) -> DataFrame:
    """Lines of gzip files that break off: all that could be unpacked whole."""
    return _broken_lines(t).select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "line")


@query(f"""{_FILES}, k AS (SELECT event_id // {OF_FILE} AS file, unnest([event_type || ': BIGINT', 'event_id: BIGINT', 't: STRING']) AS key, event_type = 'view' AS has FROM e WHERE n <= 5)
SELECT file, 'OBJECT<' || string_agg(DISTINCT key, ', ' ORDER BY key) || '>' AS keys, count(*) // 3 AS records, bool_or(has) AS has_tokens FROM k GROUP BY file""")
def q135b_peek(t: Tables) -> DataFrame:
    """The first five records of every file: the keys of all of them with their types, and whether any has tokens."""
    name = F.regexp_extract("path", r"events-(\d+)", 1).cast("bigint")
    return text_sources.peek_files(_broken_lines(t), 5).select(name.alias("file"), "keys", "records", "has_tokens")


@query("SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE doc_id % 2 = 0 AND text IS NOT NULL")
def q136_tar_members(t: Tables) -> DataFrame:
    """Texts in packed tars inside tars; the filter on names is answered by the source."""
    inner, outer = new_path(t.spark, "inner"), new_path(t.spark, "outer")
    archives.register(t.spark)
    name = F.concat(F.lit("texts/"), "doc_id", F.when(F.col("doc_id") % 2 == 0, ".txt").otherwise(".bin"))
    t.documents.filter("text is not null").select(name.alias("member"), F.encode("text", "utf-8").alias("content")).write.format("tar").option("suffix", ".tar.gz").option("shard_bytes", SHARD_BYTES).mode("append").save(inner)
    shards = archives.read(t.spark, "each_file", inner).select(F.concat(F.lit("shards/"), "member").alias("member"), "content")
    shards.write.format("tar").option("shard_bytes", SHARD_BYTES).mode("append").save(outer)
    m = archives.tar_members(t.spark, outer, ".txt")
    return m.select(F.regexp_extract("member", r"texts/(\d+)\.txt$", 1).cast("bigint").alias("doc_id"), F.md5("content").alias("text_md5"))


@query("SELECT lang AS category, lpad((doc_id % 50)::VARCHAR, 3, '0') AS seq_id, count(*) AS members, sum(strlen(coalesce(text, '')))::BIGINT AS bytes FROM documents GROUP BY ALL")
def q137_zip_members(t: Tables) -> DataFrame:
    """Members of zip files by category and sequence in their names."""
    path = new_path(t.spark, "zip")
    archives.register(t.spark)
    name = F.concat_ws("/", "lang", F.lpad((F.col("doc_id") % 50).cast("string"), 3, "0"), F.concat("doc_id", F.lit(".txt")))
    t.documents.select(name.alias("member"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("content")).write.format("zip").option("shard_bytes", SHARD_BYTES).mode("append").save(path)
    m = archives.zip_members(t.spark, path, r"^(\w+)/(\d+)/")
    return m.groupBy("category", "seq_id").agg(F.count("*").alias("members"), F.sum(F.octet_length("content")).alias("bytes"))


@query("SELECT doc_id, lang, CASE WHEN doc_id % 5 <> 0 THEN md5(coalesce(text, '')) END AS media_md5 FROM documents")
def q138_webdataset_pairs(t: Tables) -> DataFrame:
    """Records of line shards with the media of the tar shard of the same name; a fifth of the media is missing."""
    path = new_path(t.spark, "webdataset")
    archives.register(t.spark)
    d = t.documents.select("doc_id", "lang", "text")
    dealt = d.repartition(4 * d.rdd.getNumPartitions(), "doc_id")  # both sides get the same shards, and their number grows with the input
    record = F.to_json(F.struct("doc_id", "lang", F.concat("doc_id", F.lit(".png")).alias("media")))
    dealt.select(record.alias("value")).write.format("lines").option("suffix", ".jsonl.gz").mode("overwrite").save(f"{path}/records")
    media = dealt.filter("doc_id % 5 <> 0").select(F.concat(F.lit("media/"), "doc_id", F.lit(".png")).alias("member"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("content"))
    media.write.format("tar").option("suffix", ".wds").mode("overwrite").save(f"{path}/media")
    r = archives.read(t.spark, "lines", f"{path}/records").select(F.regexp_extract("path", r"([^/]+)\.jsonl\.gz$", 1).alias("shard"), F.from_json("value", "doc_id bigint, lang string, media string").alias("r")).select("shard", "r.*")
    return archives.webdataset_pairs(r, archives.tar_members(t.spark, f"{path}/media")).select("doc_id", "lang", F.md5("content").alias("media_md5"))


@query("SELECT vec_id, len(embedding) AS d, round(embedding[1]::DOUBLE, 6) AS first, round(embedding[-1]::DOUBLE, 6) AS last, (SELECT count(*) FROM embeddings) AS total FROM embeddings")
def q139_npy_rows(t: Tables) -> DataFrame:
    """Vectors as arrays on disk, read by ranges of rows, and the rows that the headers name."""
    path = new_path(t.spark, "npy")
    archives.register(t.spark)
    halves = lambda e: F.array((F.col("vec_id") % 65536).cast("double"), F.floor(F.col("vec_id") / 65536).cast("double"), e)
    values = F.concat(F.slice(halves(F.lit(0.0)), 1, 2), F.col("embedding").cast("array<double>"))
    t.embeddings.select(values.alias("values")).write.format("npy").mode("append").save(path)
    total = archives.npy_shapes(t.spark, path).agg(F.sum(F.get("shape", F.lit(0))).alias("total"))
    v = lambda k: F.get("values", F.lit(k))
    rows = archives.read(t.spark, "npy", path, split_bytes=1 << 20).select((v(0) + v(1) * 65536).cast("bigint").alias("vec_id"), (F.size("values") - 2).cast("bigint").alias("d"), F.round(v(2), 6).alias("first"), F.round(F.element_at("values", -1), 6).alias("last"))
    return rows.crossJoin(F.broadcast(total))  # one row


@query(f"{FR} SELECT user_id, f, {KIND_SQL} AS kind, {K_SQL} AS k, round(value::FLOAT::DOUBLE, 3) AS value FROM fr")
def q140_sequence_examples(t: Tables) -> DataFrame:
    """Frames of each user as SequenceExamples of at most 64 steps in framed records, read back by byte ranges."""
    path = new_path(t.spark, "tfrecord")
    archives.register(t.spark)
    steps = fr(t).select("user_id", F.floor(F.col("f") / 64).alias("part"), F.struct("f", k_of().alias("k"), kind_of().alias("kind"), F.col("value").cast("double").alias("value")).alias("s"))

    @F.pandas_udf("binary")
    def coded(user: pd.Series, f: pd.Series, k: pd.Series, kind: pd.Series, value: pd.Series) -> pd.Series:
        def one(u: int, f: list, k: list, kind: list, value: list) -> bytes:
            single = lambda kind, xs: [[kind(x)] for x in xs]
            return archives.coded_example({"user_id": [int(u)]}, {"k": single(int, k), "kind": single(str, kind), "value": single(float, value), "f": single(int, f)})

        return pd.Series([one(*x) for x in zip(user, f, k, kind, value, strict=True)])

    examples = steps.groupBy("user_id", "part").agg(F.array_sort(F.collect_list("s")).alias("s"))  # 64 rows at most
    of_step = lambda name: F.transform("s", lambda x: x[name])  # noqa: E731  arrays of numbers, no row of Python's for each step
    examples.select(coded("user_id", *map(of_step, ("f", "k", "kind", "value"))).alias("content")).write.format("tfrecord").mode("append").save(path)
    features = archives.sequence_examples(t.spark, path).withColumn("v", F.get("values", F.lit(0)))
    of = lambda name, kind: F.max(F.when(F.col("name") == name, F.col("v"))).cast(kind).alias(name)
    users = features.filter("list = -1").groupBy("path", "record").agg(of("user_id", "bigint"))
    frames = features.filter("list >= 0").groupBy("path", "record", "list").agg(of("f", "bigint"), of("kind", "string"), of("k", "bigint"), of("value", "double"))
    return frames.join(users, ["path", "record"]).select("user_id", "f", "kind", "k", F.round("value", 3).alias("value"))


@query(f"SELECT event_id, {K_SQL} AS k, {KIND_SQL} AS kind, {K_SQL} + event_id AS last, 3::BIGINT AS fields FROM events")
def q141_message_trees(t: Tables) -> DataFrame:
    """Events as messages, walked without their schema into VARIANT trees."""
    path = new_path(t.spark, "messages")
    archives.register(t.spark)

    @F.pandas_udf("binary")
    def coded(event: pd.Series, k: pd.Series, kind: pd.Series) -> pd.Series:
        def one(e: int, n: int, name: str) -> bytes:
            return archives.message([(1, e), (2, archives.message([(1, n), (2, name.encode())])), (3, n), (3, n + e)])

        return pd.Series([one(int(e), int(n), x) for e, n, x in zip(event, k, kind, strict=True)])

    t.events.select(coded("event_id", k_of(), kind_of()).alias("content")).write.format("tfrecord").mode("append").save(path)
    at = lambda where, kind: F.variant_get("tree", where, kind)
    trees = archives.message_trees(archives.read(t.spark, "tfrecord", path, verify="true"))
    number_of = F.size(F.json_object_keys(F.to_json("tree"))).cast("bigint")
    return trees.select(at("$['1'][0]", "bigint").alias("event_id"), at("$['2'][0]['1'][0]", "bigint").alias("k"), at("$['2'][0]['2'][0]", "string").alias("kind"), at("$['3'][1]", "bigint").alias("last"), number_of.alias("fields"))
