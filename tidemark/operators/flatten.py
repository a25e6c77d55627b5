"""Merging side streams into token streams, and flattening these to training text.

Blocks are rows here: (track, pos, kind, payload).  The fold of
``functions.tokens.fold_stream`` gives the same text for one short stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tokens import parse_blocks, wrapped


def explode_blocks(streams: DataFrame, track: str, stream: str) -> DataFrame:
    """Streams to rows (track, pos, kind, payload)."""
    return streams.select(track, F.explode(parse_blocks(F.col(stream))).alias("b")).select(track, F.col("b.pos").cast("bigint").alias("pos"), "b.kind", "b.payload")


def merge_side(blocks: DataFrame, side: DataFrame, track: str, kind: str) -> DataFrame:
    """Insert one block of ``kind`` after the i-th avc_lm block for each row (track, chunk = i, payload) of ``side``."""
    return merge_sides(blocks, side.withColumnRenamed("payload", kind), track)


def merge_sides(blocks: DataFrame, sides: DataFrame, track: str) -> DataFrame:
    """Insert side streams by chunk; ``sides`` has ``track``, ``chunk`` and any of ``agent``, ``snac``, ``speech`` and ``caption``.

    Agent, snac and speech go behind the i-th avc_lm block, in this order, a
    caption goes before the i-th cosmos block, if there are both that and an
    i-th avc_lm block.  A null or empty entry inserts nothing.  A track that
    has blocks of a kind already gets no more of it, so merging twice changes
    nothing.  One window by track numbers the blocks, one join brings what
    they get.
    """
    after = [k for k in ("agent", "snac", "speech") if k in sides.columns]
    kinds = [*after, *(["caption"] if "caption" in sides.columns else [])]
    all_of = Window.partitionBy(track)
    so_far = all_of.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda kind: F.coalesce(F.sum((F.col("kind") == kind).cast("bigint")).over(so_far), F.lit(0))
    has = lambda kind: F.max((F.col("kind") == kind).cast("int")).over(all_of)
    chunk = F.when(F.col("kind") == "avc_lm", before("avc_lm")).when(F.col("kind") == "cosmos", before("cosmos"))
    b = blocks.withColumns({"_chunk": chunk, "_avc": F.sum((F.col("kind") == "avc_lm").cast("bigint")).over(all_of), **{f"_has_{k}": has(k) for k in kinds}})
    joined = b.join(sides.select(track, F.col("chunk").cast("bigint").alias("_chunk"), *[F.col(k).alias(f"_new_{k}") for k in kinds]), [track, "_chunk"], "left")

    def new(kind: str, at: str, shift: float) -> F.Column:
        there = (F.col("kind") == at) & (F.col(f"_has_{kind}") == 0) & (F.coalesce(F.col(f"_new_{kind}"), F.lit("")) != "")
        if kind == "caption":
            there = there & (F.col("_chunk") < F.col("_avc"))
        return F.when(there, F.struct((F.col("pos") + shift).cast("double").alias("pos"), F.lit(kind).alias("kind"), F.col(f"_new_{kind}").alias("payload")))

    own = F.struct(F.col("pos").cast("double").alias("pos"), F.col("kind").alias("kind"), F.col("payload").alias("payload"))
    rows = F.array(own, *[new(k, "avc_lm", 0.25 * (i + 1)) for i, k in enumerate(after)], *[new(k, "cosmos", -0.125) for k in kinds if k == "caption"])
    return joined.select(track, F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("b")).select(track, "b.pos", "b.kind", "b.payload")


def serialise(blocks: DataFrame, track: str) -> DataFrame:
    """(track, stream): the blocks as one text again."""
    text = F.concat(F.lit("<"), F.col("kind"), F.lit(">"), F.col("payload"), F.lit("</"), F.col("kind"), F.lit(">"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", text.alias("text"))))
    return blocks.groupBy(track).agg(F.array_join(F.transform(ordered, lambda x: x.text), " ").alias("stream"))


def flatten_blocks(blocks: DataFrame, track: str) -> DataFrame:
    """(track, text): each avc_lm block writes the last caption, seed2 and cosmos since the one before, in that order; agent and audio blocks are written where they stand.

    The segment of a block is the number of avc_lm blocks before it, so a
    segment ends with its avc_lm block, and windows and aggregates by track do
    the work of a state machine in one exchange.  Blocks after the last avc_lm
    are not written unless they are of a kind written at once.
    """
    w = Window.partitionBy(track).orderBy("pos")
    seg = F.coalesce(F.sum((F.col("kind") == "avc_lm").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    direct = F.coalesce(*[F.when(F.col("kind") == k, wrapped(F.col("payload"), k)) for k in ("agent", "snac", "listen", "speak")], F.when(F.col("kind") == "speech", F.concat(F.lit("<speech> "), F.trim("payload"), F.lit(" </speech>"))))
    held = ["caption", "seed2", "cosmos"]
    last = [F.max_by("payload", F.when(F.col("kind") == k, F.col("pos"))).alias(k) for k in held]
    pieces = F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("pos", "piece"))))
    b = blocks.select(track, "pos", "kind", "payload", seg.alias("seg"), direct.alias("piece"))
    s = b.groupBy(track, "seg").agg(F.max((F.col("kind") == "avc_lm").cast("int")).alias("ends"), pieces.alias("direct"), *last)
    texts = [F.concat(F.lit("<caption> "), F.trim("caption"), F.lit(" </caption>")), wrapped(F.col("seed2"), "seed2"), wrapped(F.col("cosmos"), "cosmos")]
    flush = F.when(F.col("ends") == 1, F.filter(F.array(*texts), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))
    s = s.select(track, "seg", F.concat(F.transform("direct", lambda x: x.piece), flush).alias("pieces"))
    ordered = F.array_sort(F.collect_list(F.struct("seg", "pieces")))
    out = s.groupBy(track).agg(F.flatten(F.transform(ordered, lambda x: x.pieces)).alias("pieces"))
    return out.filter(F.size("pieces") > 0).select(track, F.array_join("pieces", " ").alias("text"))
