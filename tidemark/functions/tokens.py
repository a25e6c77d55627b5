"""Column builders for interleaved token streams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The block kinds of a stream.
KINDS = ("seed2", "cosmos", "avc_lm", "agent", "snac", "listen", "speak", "caption", "speech")
#: Ids below these limits are valid.
VOCAB_LIMIT = {"seed2": 8192, "cosmos": 64000, "avc_lm": 8192, "agent": 256}
#: Codec band offsets.
CODEC_L0, CODEC_L1A, CODEC_L1B = 128266, 132362, 144650
CODEC_L2 = (136458, 140554, 148746, 152842)
CODEC_BAND = 4096

_BLOCK = "(?s)<(" + "|".join(KINDS) + r")>(.*?)</\1>"


def parse_blocks(stream: Column) -> Column:
    """The blocks of a stream in document order: array of (pos, kind, payload)."""
    whole = F.regexp_extract_all(stream, F.lit(_BLOCK), 0)  # one pass; tags are cut off by length
    kind = lambda b: F.substring_index(F.substr(b, F.lit(2)), ">", 1)
    payload = lambda b: F.substr(b, F.length(kind(b)) + 3, F.length(b) - 2 * F.length(kind(b)) - 5)
    return F.transform(whole, lambda b, i: F.struct(i.alias("pos"), kind(b).alias("kind"), payload(b).alias("payload")))


def words(text: Column) -> Column:
    """White-space separated words; none for empty text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def atomic_tokens(payload: Column, family: str) -> Column:
    """``<family_N>`` for every all-digit entry of a payload."""
    return F.transform(F.filter(words(payload), lambda w: w.rlike("^[0-9]+$")), lambda w: F.concat(F.lit(f"<{family}_"), w, F.lit(">")))


def wrapped(payload: Column, family: str) -> Column:
    """A block with atomic tokens between its tags, or null if it has none."""
    inner = atomic_tokens(payload, family)
    return F.when(F.size(inner) > 0, F.concat(F.lit(f"<{family}> "), F.array_join(inner, " "), F.lit(f" </{family}>")))


def family_ids(text: Column, family: str) -> Column:
    """The ids of ``<family_N>`` tokens in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(f"<{family}_([0-9]+)>"), 1), lambda x: x.cast("bigint"))


def family_count(text: Column, family: str) -> Column:
    return F.regexp_count(text, F.lit(f"<{family}_[0-9]+>")).cast("bigint")


def over_limit_count(text: Column) -> Column:
    """Tokens of the families in VOCAB_LIMIT whose id is at or over the limit."""
    out = F.lit(0).cast("bigint")
    for family, limit in VOCAB_LIMIT.items():
        ids = F.regexp_extract_all(text, F.lit(f"<{family}_([0-9]+)>"), 1)
        out = out + F.size(F.filter(ids, lambda x: F.coalesce(x.try_cast("bigint") >= limit, F.lit(True)))).cast("bigint")  # noqa: B023
    return out


def wrapped_count(text: Column, wrapper: str, family: str) -> Column:
    """Tokens of a family inside the wrapper's blocks."""
    blocks = F.regexp_extract_all(text, F.lit(f"(?s)<{wrapper}>(.*?)</{wrapper}>"), 1)
    return F.aggregate(blocks, F.lit(0).cast("bigint"), lambda n, b: n + F.regexp_count(b, F.lit(f"<{family}_[0-9]+>")))


def speech_split(text: Column) -> Column:
    """Codec tokens (total, listen, speak, orphan): orphans stand in neither wrapper."""
    total, listen, speak = family_count(text, "snac"), wrapped_count(text, "listen", "snac"), wrapped_count(text, "speak", "snac")
    return F.struct(total.alias("total"), listen.alias("listen"), speak.alias("speak"), (total - listen - speak).alias("orphan"))


def plain_word_count(text: Column) -> Column:
    """Words that are not tokens in angle brackets."""
    return F.size(F.filter(words(text), lambda w: ~w.rlike("^<[^>]+>$"))).cast("bigint")


def rename_family(text: Column, old: str, new: str) -> Column:
    return F.regexp_replace(text, f"<{old}_([0-9]+)>", f"<{new}_$1>")


def classify_token(token: Column) -> Column:
    """The family of a token by its start; ``text`` if none fits."""
    out = None
    for family, pattern in (
        ("seed2", "^<seed2_[0-9]+>"),
        ("cosmos", "^<cosmos_[0-9]+>"),
        ("avc_lm", "^<avclm_[0-9]+>"),
        ("snac", "^<snac_[0-9]+>"),
        ("agent", "^<(fps|joint|x|y|z|t)_"),
        ("marker", "^</?[a-z_0-9]+>$"),
    ):
        out = F.when(token.rlike(pattern), family) if out is None else out.when(token.rlike(pattern), family)
    return out.otherwise("text")


def tags_balanced(text: Column, family: str) -> Column:
    return F.regexp_count(text, F.lit(f"<{family}>")) == F.regexp_count(text, F.lit(f"</{family}>"))


def agent_errors(text: Column, joints: tuple[str, ...], most_frame: int = 7) -> Column:
    """Faults of an agent text: (no_fps, missing joints, coordinates over 255, frame numbers over ``most_frame``)."""
    over = lambda pattern, most: F.size(F.filter(F.regexp_extract_all(text, F.lit(pattern), 1), lambda v: v.try_cast("bigint") > most)).cast("bigint")
    found = F.array_intersect(F.regexp_extract_all(text, F.lit("<([a-z_]+)>"), 1), F.array(*[F.lit(j) for j in joints]))
    return F.struct((F.regexp_count(text, F.lit("<fps_[0-9]+>")) == 0).alias("no_fps"), (F.lit(len(joints)) - F.size(found)).cast("bigint").alias("missing"), over("<[a-z0-9_]+_[xyz]_([0-9]+)>", 255).alias("bad_coord"), over("<[a-z0-9_]+_t_([0-9]+)>", most_frame).alias("bad_t"))


def strict_count(found: Column, expected: Column, name: Column) -> Column:
    """``found``, or an error that names the record if it isn't ``expected``."""
    message = F.concat(name, F.lit(": found "), found.cast("string"), F.lit(" blocks, expected "), expected.cast("string"))
    return F.when(found == expected, found).otherwise(F.raise_error(message).cast("bigint"))


def fold_stream(blocks: Column) -> Column:
    """Flatten a parsed stream to an array of rendered pieces, as one native fold.

    Captions, seed2 and cosmos blocks wait, a later one replacing an earlier;
    an avc_lm block flushes them in that order and is dropped itself; other
    kinds are written at once; what waits at the end is dropped.  Suits short
    streams; ``operators.flatten`` has the set-based form for long ones.
    """
    null = F.lit(None).cast("string")
    start = F.struct(F.array().cast("array<string>").alias("out"), null.alias("caption"), null.alias("seed2"), null.alias("cosmos"))

    def step(acc: Column, b: Column) -> Column:
        held = [acc.caption, acc.seed2, acc.cosmos]
        text = F.concat(F.lit("<caption> "), F.trim(b.payload), F.lit(" </caption>"))
        now = {"caption": text, "seed2": wrapped(b.payload, "seed2"), "cosmos": wrapped(b.payload, "cosmos")}
        flush = b.kind == "avc_lm"
        waits = b.kind.isin(*now)
        direct = F.coalesce(*[F.when(b.kind == k, wrapped(b.payload, k)) for k in ("agent", "snac", "listen", "speak")], F.concat(F.lit("<"), b.kind, F.lit("> "), F.trim(b.payload), F.lit(" </"), b.kind, F.lit(">")))
        added = F.when(flush, F.filter(F.array(*held), lambda x: x.isNotNull())).when(waits, F.array().cast("array<string>")).otherwise(F.array(direct))
        return F.struct(F.concat(acc.out, added).alias("out"), *[F.when(flush, null).when(b.kind == k, v).otherwise(acc[k]).alias(k) for k, v in now.items()])

    return F.aggregate(blocks, start, step, lambda acc: acc.out)


def pack_listen(l0: Column, l1a: Column, l1b: Column) -> Column:
    """Three codec ids a frame, each in its band."""
    n = F.size(l0)
    frames = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array(F.get(l0, i) + CODEC_L0, F.get(l1a, i) + CODEC_L1A, F.get(l1b, i) + CODEC_L1B))
    return F.when(n > 0, F.flatten(frames)).otherwise(F.array().cast("array<bigint>"))


def pack_speak(l0: Column, l1: Column, l2: Column) -> Column:
    """Seven codec ids a frame in the order L0, L1a, two of L2, L1b, two of L2; l1 has two and l2 four entries a frame."""
    n = F.size(l0)

    def frame(i: Column) -> Column:
        at = lambda a, k, m: F.get(a, i * m + k)
        return F.array(F.get(l0, i) + CODEC_L0, at(l1, 0, 2) + CODEC_L1A, at(l2, 0, 4) + CODEC_L2[0], at(l2, 1, 4) + CODEC_L2[1], at(l1, 1, 2) + CODEC_L1B, at(l2, 2, 4) + CODEC_L2[2], at(l2, 3, 4) + CODEC_L2[3])

    return F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(0), n - 1), frame))).otherwise(F.array().cast("array<bigint>"))


def unpack_codec(ids: Column, offsets: tuple[int, ...]) -> Column:
    """Ids back to (value, valid) with the band offsets repeating; valid if the value is inside the band."""
    bands = F.array(*[F.lit(o) for o in offsets])
    value = lambda x, i: x - F.get(bands, i % len(offsets))
    return F.transform(ids, lambda x, i: F.struct(value(x, i).alias("value"), ((value(x, i) >= 0) & (value(x, i) < CODEC_BAND)).alias("valid")))


LISTEN_BANDS = (CODEC_L0, CODEC_L1A, CODEC_L1B)
SPEAK_BANDS = (CODEC_L0, CODEC_L1A, CODEC_L2[0], CODEC_L2[1], CODEC_L1B, CODEC_L2[2], CODEC_L2[3])
