"""Further operators on token streams and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sampling import hash_uniform, keep_at_rate
from ..functions.tokens import KINDS, family_ids, fold_stream, parse_blocks, words
from .asof import nearest_grid

#: Tokens of one cosmos block.
BLOCK_SIZES = (200, 896)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def header_of(text: Column) -> Column:
    """What stands before the first block tag."""
    return _strip(F.regexp_extract(text, "(?s)^(.*?)(?:<(?:" + "|".join(KINDS) + ")>|$)", 1))


def headed_flatten(text: Column) -> Column:
    """A record's header and its flattened video blocks, joined by a space; null if it has no block that is written.

    Agent and audio blocks are left out, unclosed blocks and text between
    blocks too.
    """
    video = F.filter(parse_blocks(text), lambda b: b.kind.isin("caption", "seed2", "cosmos", "avc_lm"))
    pieces = fold_stream(video)
    return F.when(F.size(pieces) > 0, F.concat_ws(" ", F.nullif(header_of(text), F.lit("")), F.array_join(pieces, " ")))


def chunk_timing(blocks: DataFrame, agent: DataFrame, track: str, start: Column, width: int = 8, fps: float = 30.0) -> DataFrame:
    """One row per avc_lm block (track, pos, kind, payload rows): chunk number, frame, seconds and what the chunk has.

    ``has_seed2`` looks between this avc_lm block and the one before;
    ``has_agent`` at the nearest multiple of ``width`` of the chunk's frame,
    or one step beside it, in ``agent`` (track, window_id).  ``start`` is the
    track's first frame.
    """
    w = Window.partitionBy(track).orderBy("pos")
    b = blocks.withColumn("seg", F.coalesce(F.sum((F.col("kind") == "avc_lm").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    c = b.groupBy(track, F.col("seg").cast("bigint").alias("chunk_idx")).agg(F.max((F.col("kind") == "avc_lm").cast("int")).alias("_avc"), F.max((F.col("kind") == "seed2").cast("int")).alias("_seed"))
    c = c.filter("_avc = 1").withColumn("abs_frame", start + F.col("chunk_idx") * width)
    near = nearest_grid(F.col("abs_frame"), width)
    spread = c.select(track, "chunk_idx", F.explode(F.array(near, near - width, near + width)).alias("window_id"))
    hit = spread.join(agent.select(track, "window_id").distinct(), [track, "window_id"], "left_semi").select(track, "chunk_idx").distinct().withColumn("_hit", F.lit(True))
    out = c.join(hit, [track, "chunk_idx"], "left")
    return out.select(track, "chunk_idx", "abs_frame", F.bround(F.col("abs_frame") / fps, 4).alias("start_sec"), F.bround((F.col("abs_frame") + width) / fps, 4).alias("end_sec"), (F.col("_seed") == 1).alias("has_seed2"), F.lit(True).alias("has_avc_lm"), F.coalesce("_hit", F.lit(False)).alias("has_agent"))


def legacy_flatten(stream: Column, rates: dict[str, float], key: Column) -> Column:
    """Every block as ``<kind_N>`` tokens, each block dropped at its kind's rate; an array of pieces."""
    blocks = F.filter(parse_blocks(stream), lambda b: F.coalesce(*[F.when(b.kind == k, keep_at_rate(r, key, b.pos, k)) for k, r in rates.items()], F.lit(True)))
    return F.transform(blocks, lambda b: F.array_join(F.transform(words(b.payload), lambda w: F.concat(F.lit("<"), b.kind, F.lit("_"), w, F.lit(">"))), " "))


def interleave(chunks: Column, pieces: Column) -> Column:
    """Text chunks set among token pieces at even places: chunk i before piece int(i * n / max(1, k - 1))."""
    k, n = F.size(chunks), F.size(pieces)
    at = lambda i: F.floor(i * n / F.greatest(k - 1, F.lit(1)))
    keyed = F.concat(F.transform(chunks, lambda c, i: F.struct(at(i).alias("p"), F.lit(0).alias("o"), i.alias("i"), c.alias("v"))), F.transform(pieces, lambda p, i: F.struct(i.cast("bigint").alias("p"), F.lit(1).alias("o"), i.alias("i"), p.alias("v"))))
    return F.transform(F.array_sort(keyed), lambda x: x.v)


def swap_some(items: Column, rate: float, key: Column) -> Column:
    """max(1, int(n * rate)) swaps of two places drawn by hash; none at rate 0 or under two items."""
    if rate <= 0:
        return items
    n = F.size(items)
    swaps = F.greatest(F.lit(1), F.floor(n * rate).cast("int"))

    def step(acc: Column, s: Column) -> Column:
        a = F.floor(hash_uniform(key, s, "a") * n).cast("int")
        b = F.floor(hash_uniform(key, s, "b") * n).cast("int")
        return F.transform(acc, lambda x, i: F.when(i == a, F.get(acc, b)).when(i == b, F.get(acc, a)).otherwise(x))

    return F.when(n < 2, items).otherwise(F.aggregate(F.sequence(F.lit(1), swaps), items, step))


#: Letters whose upper case is more than one letter, though there is one capital.
_LETTERS = "ß" + "".join(c for c in map(chr, range(0x1F80, 0x1FFD)) if len(c.upper()) > 1 and len(c.title()) == 1 and c.title() != c)
_CAPITALS = "ẞ" + "".join(c.title() for c in _LETTERS[1:])


def _capital(letter: Column) -> Column:
    """The capital of one letter, which is one letter too; the letter itself if it has none."""
    upper = F.upper(letter)
    return F.when(F.length(upper) == 1, upper).otherwise(F.translate(letter, _LETTERS, _CAPITALS))


def replace_words(text: DataFrame, key: str, column: str, synonyms: DataFrame, rate: float) -> DataFrame:
    """Words of more than five letters replaced at ``rate`` by their entry in ``synonyms`` (word, synonym), the first letter's case kept."""
    w = text.select(key, F.posexplode(words(F.col(column))).alias("i", "w")).join(synonyms.withColumnRenamed("word", "_w"), F.lower("w") == F.col("_w"), "left")
    use = F.col("synonym").isNotNull() & (F.length("w") > 5) & (hash_uniform(F.col(key), F.col("i"), "syn") < rate)
    first = F.substring("w", 1, 1)
    capital = F.concat(_capital(F.substring("synonym", 1, 1)), F.expr("substring(synonym, 2)"))
    cased = F.when(first == _capital(first), capital).otherwise(F.col("synonym"))
    new = w.withColumn("w", F.when(use, cased).otherwise(F.col("w")))
    joined = new.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda x: x.w), " ").alias(column))
    return text.drop(column).join(joined, key, "left")


def nth_block(text: Column, family: str, n: int) -> Column:
    """Ids of the n-th block of a family, n from 0; other sizes than BLOCK_SIZES raise for cosmos."""
    body = F.get(F.regexp_extract_all(text, F.lit(f"(?s)<{family}>(.*?)</{family}>"), 1), F.lit(n))
    ids = family_ids(body, family)
    if family != "cosmos":
        return ids
    return F.when(F.size(ids).isin(*BLOCK_SIZES) | ids.isNull(), ids).otherwise(F.raise_error(F.concat(F.lit("cosmos block of "), F.size(ids).cast("string"))))


def slices(ids: Column, size: int) -> Column:
    """Whole slices of ``size`` ids and the number left over."""
    n = F.floor(F.size(ids) / size).cast("int")
    cut = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(ids, i * size + 1, size))).otherwise(F.slice(F.array(ids), 1, 0))
    return F.struct(cut.alias("slices"), (F.size(ids) - n * size).alias("left_over"))


def spans(text: Column, tag: str) -> Column:
    """Texts of a wrapper; the last may be unclosed."""
    return F.transform(F.regexp_extract_all(text, F.lit(f"(?s)<{tag}>(.*?)(?:</{tag}>|$)"), 1), _strip)


def conversation_parts(text: Column) -> Column:
    """Prompt, reasoning and answer around ``ASSISTANT:`` and ``</think>``."""
    prompt = F.trim(F.regexp_replace(F.substring_index(text, "ASSISTANT:", 1), r"^\s*USER:", ""))
    rest = F.regexp_extract(text, r"(?s)ASSISTANT:(.*)$", 1)
    think = F.regexp_extract(rest, r"(?s)^\s*(?:<think>)?(.*?)</think>", 1)
    return F.struct(prompt.alias("prompt"), F.trim(think).alias("think"), F.trim(F.regexp_extract(rest, r"(?s)(?:.*</think>)?(.*)$", 1)).alias("answer"))


def fill_placeholders(text: Column, media: Column) -> Column:
    """``<image_k>`` replaced by its file in a JSON map, unknown ones kept."""
    m = F.from_json(media, "map<string,string>")
    return F.aggregate(F.map_entries(F.coalesce(m, F.create_map().cast("map<string,string>"))), text, lambda acc, e: F.replace(acc, F.concat(F.lit("<"), e.key, F.lit(">")), e.value))


def strip_outer(text: Column, tag: str = "caption") -> Column:
    """Text without one outer wrapper and without placeholders."""
    inner = F.regexp_replace(text, f"(?s)^\\s*<{tag}>(.*)</{tag}>\\s*$", "$1")
    return F.trim(F.regexp_replace(inner, r"<image_\d+>", ""))


def window_shift(windows: DataFrame, track: str, least: float = 1e-6) -> DataFrame:
    """Distance from the last frame of one window to the first of the next, and windows that do not move at all.

    ``states`` are arrays over frames of number arrays.
    """
    w = Window.partitionBy(track).orderBy("window_id")
    last = F.lag(F.element_at("states", -1)).over(w)
    distance = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    return windows.select(track, "window_id", distance(last, F.get("states", F.lit(0))).alias("shift"), (distance(F.get("states", F.lit(0)), F.element_at("states", -1)) < least).alias("frozen"))


def second_chunks(frame: Column, fps: int = 30, width: int = 8) -> Column:
    """Chunk of a frame when buffers of ``width`` are also flushed at each full second."""
    per = -(-fps // width)
    return F.floor(frame / fps) * per + F.floor((frame % fps) / width)


def share_tokens(ids: Column, frames: int) -> Column:
    """Tokens dealt over frames: len // frames each, the rest to the last."""
    each = F.floor(F.size(ids) / frames).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(frames - 1)), lambda i: F.slice(ids, i * each + 1, F.when(i == frames - 1, F.size(ids)).otherwise(each)))


def last_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One ``value`` per key, the last by ``order``."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def pick_one(rows: DataFrame, order: str, text: str, marker: str, seed: str, among: int = 1000) -> DataFrame:
    """One row drawn by hash from those of the first ``among`` that hold ``marker``: a sampling operator."""
    return rows.orderBy(order).limit(among).filter(F.contains(text, F.lit(marker))).orderBy(hash_uniform(F.col(order), seed)).limit(1)


def question_answers(media: DataFrame, key: str) -> DataFrame:
    """Question and answer text from a JSON map of file to caption, the question's wording drawn by hash."""
    wordings = F.array(*[F.lit(x) for x in ("What does {} show?", "Describe {}.", "What can be seen in {}?")])
    e = media.select(key, F.explode(F.map_entries(F.from_json("media", "map<string,string>"))).alias("e"))
    ask = F.get(wordings, F.floor(hash_uniform(F.col(key), F.col("e.key")) * 3).cast("int"))
    return e.select(key, F.concat(F.lit("USER: "), F.replace(ask, F.lit("{}"), F.col("e.key")), F.lit(" ASSISTANT: "), F.col("e.value")).alias("text"))


def rate_histogram(rates: DataFrame, fps: str) -> DataFrame:
    """Rows per frame rate, rounded to whole numbers; rates outside (0, 240] are left out."""
    rounded = F.bround(F.when((F.col(fps) > 0) & (F.col(fps) <= 240), F.col(fps)))
    return rates.groupBy(rounded.alias(fps)).agg(F.count("*").alias("n")).filter(F.col(fps).isNotNull())
