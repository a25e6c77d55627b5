"""Queries over stream records, poses, files and streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, tokens
from ..functions.numeric import pchip
from ..functions.tokens import words
from ..operators import corpus, flatten, pose, poseframes, records, windows
from ..operators import streams as stream_ops
from ..session import new_path
from ..sources import sinks
from ..sources import text as text_sources
from ..streaming import incremental, manifest, ordered
from .documents import UNIFORM_SQL, WORDS_SQL
from .records import side_streams
from .registry import ORACLE_SQL, QUERIES, Tables, query
from .tracks import FR, K_SQL, KIND_SQL, fr, k_of, kind_of, streams


def _chunk_streams(t: Tables) -> DataFrame:
    """One token stream per user and eight frames."""
    block = F.concat(F.lit("<"), kind_of(), F.lit("> "), k_of(), F.lit(" "), F.floor("value"), F.lit(" </"), kind_of(), F.lit(">"))
    s = fr(t).groupBy("user_id", F.floor(F.col("f") / 8).alias("chunk"))
    return s.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", block.alias("b")))), lambda x: x.b), " ").alias("stream"))


_BLOCKS = f"{FR}, b AS (SELECT user_id, f // 8 AS chunk, f, f % 8 AS pos, {KIND_SQL} AS kind, {K_SQL} AS k, CAST(floor(value) AS BIGINT) AS v FROM fr)"


@query(f"""{_BLOCKS} SELECT user_id, chunk, coalesce(string_agg('<' || kind || '_' || k || '> <' || kind || '_' || v || '>', ' ' ORDER BY pos) FILTER (kind <> 'cosmos' OR {UNIFORM_SQL.format("(user_id || ':' || chunk) || '|' || pos || '|cosmos'")} > 0.5), '') AS pieces FROM b GROUP BY ALL""")
def q100_legacy_flatten(t: Tables) -> DataFrame:
    """Every block as tokens, half of the cosmos blocks dropped by hash."""
    key = F.concat(F.col("user_id"), F.lit(":"), F.col("chunk"))
    pieces = stream_ops.legacy_flatten(F.col("stream"), {"cosmos": 0.5}, key)
    return _chunk_streams(t).select("user_id", "chunk", F.array_join(pieces, " ").alias("pieces"))


@query()
def q101_merge_twice(t: Tables) -> DataFrame:
    """Side streams merged twice change nothing: the rows of q88."""
    once = flatten.serialise(flatten.merge_sides(flatten.explode_blocks(streams(t), "user_id", "stream"), side_streams(t), "user_id"), "user_id")
    return flatten.serialise(flatten.merge_sides(flatten.explode_blocks(once, "user_id", "stream"), side_streams(t), "user_id"), "user_id")


ORACLE_SQL["q101_merge_twice"] = ORACLE_SQL["q88_four_way_merge"]


@query(f"""{_BLOCKS}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id, chunk ORDER BY pos) AS n FROM b WHERE kind = 'seed2'), c AS (SELECT DISTINCT user_id, chunk FROM b)
SELECT c.user_id, c.chunk, k AS first_id, CASE WHEN k IS NOT NULL THEN 2 ELSE -1 END AS ids FROM c LEFT JOIN n ON n.user_id = c.user_id AND n.chunk = c.chunk AND n.n = 2""")
def q102_nth_block(t: Tables) -> DataFrame:
    """The second seed2 block of each chunk."""
    atomic = F.array_join(F.transform(tokens.parse_blocks(F.col("stream")), lambda b: F.coalesce(F.when(b.kind == "seed2", tokens.wrapped(b.payload, "seed2")), F.lit(""))), " ")
    d = _chunk_streams(t).select("user_id", "chunk", stream_ops.nth_block(atomic, "seed2", 1).alias("ids"))
    return d.select("user_id", "chunk", F.get("ids", F.lit(0)).alias("first_id"), F.coalesce(F.size("ids"), F.lit(-1)).alias("ids"))


@query("""WITH o AS (SELECT conv_id, list(text ORDER BY turn) AS o FROM conversations GROUP BY conv_id) SELECT conv_id, trim(o[1], ' ' || chr(9) || chr(10) || chr(13)) AS prompt, CASE WHEN conv_id % 2 = 0 THEN 'step ' || conv_id ELSE '' END AS think, length(trim(o[len(o)])) AS answer_chars FROM o""")
def q103_conversation_parts(t: Tables) -> DataFrame:
    """Prompt, reasoning and answer of chat texts."""
    o = t.conversations.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s.text).alias("o"))
    think = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit(" <think>step "), "conv_id", F.lit("</think>"))).otherwise("")
    chat = F.concat(F.lit("USER: "), F.get("o", F.lit(0)), F.lit("\nASSISTANT:"), think, F.lit(" "), F.element_at("o", -1))
    p = o.select("conv_id", stream_ops.conversation_parts(chat).alias("p"))
    return p.select("conv_id", F.btrim("p.prompt", F.lit(" \t\n\r")).alias("prompt"), "p.think", F.length("p.answer").cast("bigint").alias("answer_chars"))


@query(f"""{_BLOCKS} SELECT user_id, chunk, count(*) FILTER (kind = 'caption') AS captions, coalesce(string_agg(k || ' ' || v, '|' ORDER BY pos) FILTER (kind = 'caption'), '') AS texts, CASE WHEN count(*) >= 1000 THEN printf('%.2fK', count(*) / 1000.0) ELSE count(*)::VARCHAR END AS shown FROM b GROUP BY ALL""")
def q104_spans(t: Tables) -> DataFrame:
    """The captions of each chunk, and its blocks as a readable number."""
    s = F.col("stream")
    d = _chunk_streams(t).withColumn("c", stream_ops.spans(s, "caption"))
    return d.select("user_id", "chunk", F.size("c").cast("bigint").alias("captions"), F.array_join("c", "|").alias("texts"), text.human_count(F.size(tokens.parse_blocks(s)).cast("bigint")).alias("shown"))


@query(f"""WITH e AS (SELECT event_id, CAST(floor({UNIFORM_SQL.format("event_id || '|1|a'")} * 8) AS BIGINT) AS a, CAST(floor({UNIFORM_SQL.format("event_id || '|1|b'")} * 8) AS BIGINT) AS b FROM events)
SELECT event_id, array_to_string(list_transform(range(8), lambda i: CASE WHEN i = a THEN b WHEN i = b THEN a ELSE i END), ' ') AS items FROM e""")
def q105_swaps(t: Tables) -> DataFrame:
    """One swap of two places drawn by hash in eight items."""
    items = F.array(*[F.lit(str(i)) for i in range(8)])
    return t.events.select("event_id", F.array_join(stream_ops.swap_some(items, 0.1, F.col("event_id")), " ").alias("items"))


_PLACE = UNIFORM_SQL.format("conv_id || ':' || turn || '|' || (s + 1) || '|{}'")


@query(f"""WITH RECURSIVE c AS (SELECT conv_id, turn, string_split(text, ' ') AS l FROM conversations WHERE text IS NOT NULL),
r AS (SELECT conv_id, turn, l, 0 AS s, greatest(1, CAST(floor(len(l) * 0.02::DOUBLE) AS INT)) AS m FROM c UNION ALL
SELECT conv_id, turn, [CASE i WHEN a THEN l[b + 1] WHEN b THEN l[a + 1] ELSE l[i + 1] END for i in range(len(l))], s + 1, m FROM (SELECT *, CAST(floor({_PLACE.format("a")} * len(l)) AS BIGINT) AS a, CAST(floor({_PLACE.format("b")} * len(l)) AS BIGINT) AS b FROM r WHERE s < m AND len(l) >= 2) x)
SELECT conv_id, turn, md5(array_to_string(l, ' ')) AS text_md5 FROM r WHERE s = m OR len(l) < 2""")
def q105b_swapped_words(t: Tables) -> DataFrame:
    """Two words in a hundred of every turn swapped with others, one after the other."""
    key = F.concat_ws(":", "conv_id", "turn")
    c = t.conversations.filter("text is not null")
    return c.select("conv_id", "turn", F.md5(F.array_join(stream_ops.swap_some(F.split("text", " ", -1), 0.02, key), " ")).alias("text_md5"))


@query("""SELECT conv_id, turn, md5(trim(replace(text, '<', '')) || CASE WHEN role = 'user' THEN ' /media/' || conv_id || '-' || turn || '.png' ELSE ' <image_' || turn || '>' END) AS filled_md5, md5(trim(replace(text, '<', ''))) AS caption_md5 FROM conversations WHERE text IS NOT NULL""")
def q107b_media_of_turns(t: Tables) -> DataFrame:
    """Captions of all turns with their placeholders filled from the conversation's media map, which has the user's images alone; and without wrapper and placeholders."""
    c = t.conversations.filter("text is not null").withColumn("plain", F.trim(F.replace("text", F.lit("<"), F.lit(""))))
    image = F.concat(F.lit("image_"), "turn")
    user = F.col("role") == "user"
    media = c.filter(user).groupBy("conv_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(image, F.concat(F.lit("/media/"), "conv_id", F.lit("-"), "turn", F.lit(".png")))))).alias("media"))
    wrapped = F.concat(F.lit("<caption>"), "plain", F.lit(" <"), image, F.lit("></caption>"))
    filled = stream_ops.fill_placeholders(F.concat("plain", F.lit(" <"), image, F.lit(">")), F.col("media"))
    return c.join(media, "conv_id", "left").select("conv_id", "turn", F.md5(filled).alias("filled_md5"), F.md5(F.trim(stream_ops.strip_outer(wrapped))).alias("caption_md5"))


@query(f"""SELECT conv_id, 'USER: ' || CASE CAST(floor({UNIFORM_SQL.format("conv_id || '|clip.mp4'")} * 3) AS BIGINT) WHEN 0 THEN 'What does clip.mp4 show?' WHEN 1 THEN 'Describe clip.mp4.' ELSE 'What can be seen in clip.mp4?' END || ' ASSISTANT: ' || count(*) || ' turns' AS text FROM conversations GROUP BY conv_id""")
def q106_question_answers(t: Tables) -> DataFrame:
    """Questions in a wording drawn by hash, from a media map."""
    c = t.conversations.groupBy("conv_id").agg(F.count("*").alias("n"))
    media = F.to_json(F.create_map(F.lit("clip.mp4"), F.concat("n", F.lit(" turns"))))
    return stream_ops.question_answers(c.select("conv_id", media.alias("media")), "conv_id")


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'view of ' || page_id ELSE 'plain ' || page_id END AS text, '/media/' || page_id || '.png and <image_2>' AS placed FROM pages""")
def q107_wrappers_and_placeholders(t: Tables) -> DataFrame:
    """An outer wrapper and placeholders taken off; placeholders filled from a media map."""
    body = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit(" <caption>view of "), "page_id", F.lit(" <image_1></caption>"))).otherwise(F.concat(F.lit("plain "), "page_id"))
    media = F.to_json(F.create_map(F.lit("image_1"), F.concat(F.lit("/media/"), "page_id", F.lit(".png"))))
    return t.pages.select("page_id", stream_ops.strip_outer(body).alias("text"), stream_ops.fill_placeholders(F.lit("<image_1> and <image_2>"), media).alias("placed"))


@query(f"""{FR}, b AS (SELECT user_id, f // 7 AS frame, list({K_SQL} * 41 % 5000 ORDER BY f) AS l FROM fr GROUP BY ALL HAVING count(*) = 7)
SELECT user_id, frame, array_to_string([l[1] + 128266, l[2] + 132362, l[4] + 136458, l[5] + 140554, l[3] + 144650, l[6] + 148746, l[7] + 152842], ' ') AS ids, len(list_filter(l, lambda x: x < 4096)) AS valid FROM b""")
def q108_speak_codec(t: Tables) -> DataFrame:
    """Seven codes a frame in their bands, and how many are inside them."""
    g = fr(t).groupBy("user_id", F.floor(F.col("f") / 7).alias("frame")).agg(F.transform(F.array_sort(F.collect_list(F.struct("f", (k_of() * 41 % 5000).alias("v")))), lambda x: x.v).alias("l")).filter(F.size("l") == 7)
    g = g.withColumn("ids", tokens.pack_speak(F.slice("l", 1, 1), F.slice("l", 2, 2), F.slice("l", 4, 4)))
    valid = F.filter(tokens.unpack_codec(F.col("ids"), tokens.SPEAK_BANDS), lambda x: x.valid)
    return g.select("user_id", "frame", F.array_join("ids", " ").alias("ids"), F.size(valid).cast("bigint").alias("valid"))


@query(f"""{_BLOCKS}, l AS (SELECT user_id, chunk, list(k ORDER BY pos) AS l FROM b GROUP BY ALL)
SELECT user_id, chunk, concat_ws('|', array_to_string(l[1:len(l) // 3], ','), array_to_string(l[len(l) // 3 + 1:2 * (len(l) // 3)], ','), array_to_string(l[2 * (len(l) // 3) + 1:], ',')) AS shared FROM l""")
def q109b_shared_tokens(t: Tables) -> DataFrame:
    """The numbers of a chunk dealt over three frames, what is left to the last."""
    c = fr(t).groupBy("user_id", F.floor(F.col("f") / 8).alias("chunk")).agg(F.transform(F.array_sort(F.collect_list(F.struct("f", k_of().alias("k")))), lambda x: x.k).alias("l"))
    return c.select("user_id", "chunk", F.array_join(F.transform(stream_ops.share_tokens(F.col("l"), 3), lambda x: F.array_join(x, ",")), "|").alias("shared"))


@query(f"""{_BLOCKS} SELECT user_id, chunk, count(*) // 3 AS slices, count(*) % 3 AS left_over, 'doc ' || user_id AS header FROM b GROUP BY ALL""")
def q109_slices_and_header(t: Tables) -> DataFrame:
    """Whole slices of three blocks, what is left over, and the text before the first block."""
    d = _chunk_streams(t).withColumn("s", stream_ops.slices(F.transform(tokens.parse_blocks(F.col("stream")), lambda b: b.kind), 3))
    header = stream_ops.header_of(F.concat(F.lit("doc "), "user_id", F.lit(" \n "), "stream"))
    return d.select("user_id", "chunk", F.size("s.slices").cast("bigint").alias("slices"), F.col("s.left_over").cast("bigint").alias("left_over"), header.alias("header"))


@query(f"""WITH t AS ({ORACLE_SQL["q01_merge_flatten"]}), w AS (SELECT user_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS nr FROM t),
m AS (SELECT *, last_value(CASE WHEN regexp_full_match(w, '</?(caption|speech)>') THEN w END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM w),
k AS (SELECT user_id, CASE WHEN regexp_full_match(w, '</?caption>') THEN 'caption' WHEN regexp_full_match(w, '</?speech>') THEN 'speech' WHEN before = '<caption>' THEN 'caption' WHEN before = '<speech>' THEN 'speech' WHEN regexp_matches(w, '^(</?seed2>|<seed2_)') THEN 'seed2' WHEN regexp_matches(w, '^(</?cosmos>|<cosmos_)') THEN 'cosmos' ELSE 'agent' END AS kind FROM m)
SELECT user_id, kind, count(*) AS n FROM k GROUP BY ALL""")
def q130_token_modes(t: Tables) -> DataFrame:
    """Words of each flattened stream by kind, captions and speech by what they stand in."""
    return corpus.token_modes(QUERIES["q01_merge_flatten"](t.spark, t.sf_dir), "user_id", "text")


@query(f"""SELECT event_id, event_type = 'click' AS no_fps, CASE WHEN event_type = 'signup' THEN 2 ELSE 0 END AS missing, CASE WHEN event_type = 'purchase' THEN 2 ELSE 0 END AS bad_coord, CASE WHEN event_type = 'error' AND {K_SQL} % 16 > 7 THEN 1 ELSE 0 END AS bad_t FROM events""")
def q131_agent_errors(t: Tables) -> DataFrame:
    """Faults of agent texts: no frame rate, missing joints, coordinates and frames out of range."""
    e, k = F.col("event_type"), k_of()
    joints = F.concat(*[F.lit(f" <{j}> <{j}_t_0> <{j}_x_255> </{j}>") for j in pose.JOINTS[2:]])
    two = F.when(e == "signup", "").otherwise(F.concat(*[F.lit(f" <{j}> </{j}>") for j in pose.JOINTS[:2]]))
    extra = F.when(e == "purchase", " <nose_x_256> <nose_z_300>").when(e == "error", F.concat(F.lit(" <nose_t_"), k % 16, F.lit(">"))).otherwise("")
    body = F.concat(F.when(e == "click", "").otherwise("<fps_30>"), joints, two, extra)
    return t.events.select("event_id", tokens.agent_errors(body, pose.JOINTS).alias("e")).select("event_id", "e.*")


@query(f"""{_BLOCKS} SELECT user_id, count(*) FILTER (kind = 'avc_lm') AS blocks FROM b GROUP BY user_id""")
def q132_strict_counts(t: Tables) -> DataFrame:
    """Blocks of each stream, counted in its text; a count that differs from the expected one would raise."""
    expected = t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("expected"))
    found = F.size(F.filter(tokens.parse_blocks(F.col("stream")), lambda b: b.kind == "avc_lm")).cast("bigint")
    d = streams(t).join(expected, "user_id")
    return d.select("user_id", tokens.strict_count(found, F.col("expected"), F.col("user_id").cast("string")).alias("blocks"))


@query(f"""{_BLOCKS}, s AS (SELECT *, coalesce(sum(CASE WHEN kind = 'avc_lm' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, chunk ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM b),
g AS (SELECT user_id, chunk, seg, max_by('<caption> ' || k || ' ' || v || ' </caption>', pos) FILTER (kind = 'caption') AS c, max_by('<seed2> <seed2_' || k || '> <seed2_' || v || '> </seed2>', pos) FILTER (kind = 'seed2') AS s2,
 max_by('<cosmos> <cosmos_' || k || '> <cosmos_' || v || '> </cosmos>', pos) FILTER (kind = 'cosmos') AS co FROM s GROUP BY ALL HAVING bool_or(kind = 'avc_lm'))
SELECT user_id, chunk, 'doc ' || user_id || ' ' || string_agg(concat_ws(' ', c, s2, co), ' ' ORDER BY seg) FILTER (coalesce(c, s2, co) IS NOT NULL) AS text FROM g GROUP BY user_id, chunk HAVING count(*) FILTER (coalesce(c, s2, co) IS NOT NULL) > 0""")
def q133_headed_flatten(t: Tables) -> DataFrame:
    """Header and flattened video blocks of each chunk's record; records without any are left out."""
    text_of = stream_ops.headed_flatten(F.concat(F.lit("doc "), "user_id", F.lit("\n "), "stream"))
    return _chunk_streams(t).select("user_id", "chunk", text_of.alias("text")).filter("text is not null")


@query(f"""{FR}, w AS (SELECT user_id, f AS window_id, count(*) OVER s AS n, count(*) FILTER (event_type = 'error') OVER s AS missing FROM fr WINDOW s AS (PARTITION BY user_id ORDER BY f ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)) SELECT user_id, window_id FROM w WHERE n = 8 AND missing = 0 AND window_id % 2 = 0""")
def q134_whole_windows(t: Tables) -> DataFrame:
    """Every second window of eight frames without a missing value."""
    d = fr(t).withColumn("x", F.coalesce(F.when(F.col("event_type") != "error", F.col("value")), F.lit(float("nan"))))
    w = windows.sliding(d, "user_id", 8, "x")
    return w.filter(records.whole_window(F.col("window_id"), F.col("states"), 2, 8)).select("user_id", "window_id")


# Poses: component c of a vector stands for coordinate c % 3 of joint c // 3, and the vectors of a label in order for frames.

_FACTORS = (0.004, 0.05, 1.0)


def _frames(t: Tables) -> DataFrame:
    xyz = F.array(*[F.get("embedding", F.lit(c)).cast("double") * F.lit(_FACTORS[c // 3 % 3]) for c in range(51)])
    return poseframes.pose_frames(t.embeddings, F.col("label"), "vec_id", xyz)


def _windows(t: Tables) -> DataFrame:
    return poseframes.pose_windows(_frames(t))


_NAMES = "[" + ", ".join(f"'{n}'" for n in pose.JOINTS) + "]"
_POINTS = f"""WITH fr AS (SELECT label::VARCHAR AS track, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS f FROM embeddings),
p AS (SELECT track, f, j, embedding[3 * j + 1]::DOUBLE * [{", ".join(map(repr, _FACTORS))}][j % 3 + 1] AS x, embedding[3 * j + 2]::DOUBLE * [{", ".join(map(repr, _FACTORS))}][j % 3 + 1] AS y, embedding[3 * j + 3]::DOUBLE * [{", ".join(map(repr, _FACTORS))}][j % 3 + 1] AS z FROM fr, range(17) r(j)),
w AS (SELECT track, f // 8 * 8 AS win, f % 8 AS i, j, x, y, z FROM p WHERE (track, f // 8) IN (SELECT (track, f // 8) FROM fr GROUP BY ALL HAVING count(*) = 8))"""
_CODE = "CAST(least(greatest(round_even(({} + 2) / 4 * 255, 0), 0), 255) AS BIGINT)"


def _joint_sql(axis: str) -> str:
    return f"'<' || name || '_{axis}_' || {_CODE.format(axis)} || '>'"


@query(f"""{_POINTS}, b AS (SELECT *, lag(x) OVER o - 2 * x + lead(x) OVER o AS bx, lag(y) OVER o - 2 * y + lead(y) OVER o AS by_, lag(z) OVER o - 2 * z + lead(z) OVER o AS bz FROM w WINDOW o AS (PARTITION BY track, win, j ORDER BY i)),
c AS (SELECT *, sqrt(bx * bx + by_ * by_ + bz * bz) AS bend FROM b), t AS (SELECT track, win, j, CASE WHEN max(bend) < 0.005 THEN 2 WHEN max(bend) < 0.05 THEN 4 ELSE 8 END AS points FROM c GROUP BY ALL)
SELECT track, win AS window_id, j AS joint, any_value(points) AS points FROM t GROUP BY ALL""")
def q110_pose_tiers(t: Tables) -> DataFrame:
    """Control points of every joint in every window of eight frames."""
    w = poseframes.window_tokens(_windows(t))
    return w.select("track", "window_id", F.posexplode("cp_counts").alias("joint", "points"))


@query(f"""{_POINTS}, b AS (SELECT *, lag(x) OVER o - 2 * x + lead(x) OVER o AS bx, lag(y) OVER o - 2 * y + lead(y) OVER o AS by_, lag(z) OVER o - 2 * z + lead(z) OVER o AS bz, {_NAMES}[j + 1] AS name FROM w WINDOW o AS (PARTITION BY track, win, j ORDER BY i)),
c AS (SELECT *, sqrt(bx * bx + by_ * by_ + bz * bz) AS bend FROM b), t AS (SELECT *, CASE WHEN max(bend) OVER g < 0.005 THEN 2 WHEN max(bend) OVER g < 0.05 THEN 4 ELSE 8 END AS points, row_number() OVER (PARTITION BY track, win, j ORDER BY bend DESC NULLS LAST, i DESC) AS rank FROM c WINDOW g AS (PARTITION BY track, win, j)),
s AS (SELECT track, win, j, '<' || name || '> ' || string_agg('<' || name || '_t_' || i || '> ' || {_joint_sql("x")} || ' ' || {_joint_sql("y")} || ' ' || {_joint_sql("z")}, ' ' ORDER BY i) || ' </' || name || '>' AS piece FROM t WHERE i IN (0, 7) OR rank <= points - 2 GROUP BY track, win, j, name)
SELECT track, win AS window_id, md5('<fps_30> ' || string_agg(piece, ' ' ORDER BY j)) AS token_md5 FROM s GROUP BY ALL""")
def q111_pose_tokens(t: Tables) -> DataFrame:
    """Control-point tokens of every window of eight frames."""
    return poseframes.window_tokens(_windows(t)).select("track", "window_id", F.md5("token_str").alias("token_md5"))


@query(f"""{_POINTS} SELECT track, win AS window_id, md5('<fps_30> ' || string_agg('<joint_' || j || '_x_' || {_CODE.format("x")} || '> <joint_' || j || '_y_' || {_CODE.format("y")} || '> <joint_' || j || '_z_' || {_CODE.format("z")} || '>', ' ' ORDER BY i, j)) AS token_md5 FROM w GROUP BY ALL""")
def q112_dense_pose_tokens(t: Tables) -> DataFrame:
    """Every coordinate of every window as a token."""
    return poseframes.window_text(_windows(t), pose.dense_tokens).select("track", "window_id", F.md5("token_str").alias("token_md5"))


def _source(k: int) -> str:
    return f"CASE WHEN c{k}[3] >= 0.02 THEN c{k} END"


_COCO = ", ".join(f"[embedding[{3 * k + 1}]::DOUBLE, embedding[{3 * k + 2}]::DOUBLE, abs(embedding[{3 * k + 3}]::DOUBLE)] AS c{k}" for k in range(17))
_MID = "CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN [{a}[1] + ({b}[1] - {a}[1]) * 0.5, {a}[2] + ({b}[2] - {a}[2]) * 0.5] END"
_MAPPED = ", ".join(f"({_source(src)})[1:2] AS j{k}" for k, src in pose.FROM_COCO.items())


@query(f"""WITH e AS (SELECT vec_id, {_COCO} FROM embeddings), s AS (SELECT vec_id, {", ".join(f"{_source(k)} AS s{k}" for k in (0, 5, 6, 11, 12))}, {_MAPPED} FROM e),
m AS (SELECT *, {_MID.format(a="s11", b="s12")} AS j0, {_MID.format(a="s5", b="s6")} AS j8 FROM s), q AS (SELECT *, {_MID.format(a="j0", b="j8")} AS j7, CASE WHEN s0 IS NOT NULL AND j8 IS NOT NULL THEN [s0[1] + 0.8::DOUBLE * (s0[1] - j8[1]), s0[2] + 0.8::DOUBLE * (s0[2] - j8[2])] END AS j10 FROM m),
u AS (SELECT vec_id, unnest(range(17)) AS joint, unnest([{", ".join(f"j{k}" for k in range(17))}]) AS xy FROM q)
SELECT vec_id, joint, round(xy[1], 6) AS x, round(xy[2], 6) AS y FROM u WHERE xy IS NOT NULL""")
def q113_joint_mapping(t: Tables) -> DataFrame:
    """The other joint order mapped to ours, with derived joints; joints of low confidence are missing."""
    at = lambda c: F.get("embedding", F.lit(c)).cast("double")
    points = F.array(*[F.array(at(3 * k), at(3 * k + 1), F.abs(at(3 * k + 2))) for k in range(17)])
    d = t.embeddings.select("vec_id", F.posexplode(pose.map_joints(points, 0.02)).alias("joint", "p")).filter("p is not null")
    return d.select("vec_id", F.col("joint").cast("bigint").alias("joint"), F.round(F.get("p", F.lit(0)), 6).alias("x"), F.round(F.get("p", F.lit(1)), 6).alias("y"))


def _bone_sql() -> str:
    """Joint by joint from the pelvis out, parents first."""
    ctes = ["n0 AS (SELECT track, f, [0.0::DOUBLE, 0.0, 0.0] AS q0, ps FROM a)"]
    for i, (parent, child, length) in enumerate(pose.BONES):
        d = [f"(ps[{child + 1}][{k}] - ps[{parent + 1}][{k}])" for k in (1, 2, 3)]
        norm = f"(sqrt({d[0]} * {d[0]} + {d[1]} * {d[1]} + {d[2]} * {d[2]}) + 1e-8::DOUBLE)"
        ctes.append(f"n{i + 1} AS (SELECT *, [" + ", ".join(f"q{parent}[{k}] + {d[k - 1]} / {norm} * {length}::DOUBLE" for k in (1, 2, 3)) + f"] AS q{child} FROM n{i})")
    joints = ", ".join(f"q{k}" for k in range(17))
    return f"""{_POINTS}, a AS (SELECT track, f, list([x, y, z] ORDER BY j) AS ps FROM p GROUP BY ALL), {", ".join(ctes)},
u AS (SELECT track, f, unnest(range(17)) AS joint, unnest([{joints}]) AS q FROM n{len(pose.BONES)}) SELECT track, f, joint, round(q[1], 5) AS x, round(q[2], 5) AS y, round(q[3], 5) AS z FROM u"""


@query(_bone_sql())
def q114_normalised_poses(t: Tables) -> DataFrame:
    """Poses with the pelvis at the origin and bones of fixed lengths."""
    d = poseframes.map_frames(_frames(t), pose.normalise).select("track", "f", "xyz", F.explode(F.sequence(F.lit(0), F.lit(16))).alias("joint"))
    return d.select("track", "f", F.col("joint").cast("bigint").alias("joint"), *[F.round(F.get("xyz", 3 * F.col("joint") + k), 5).alias(n) for k, n in enumerate("xyz")])


_TIERED = f"""{_POINTS}, b AS (SELECT *, lag(x) OVER o - 2 * x + lead(x) OVER o AS bx, lag(y) OVER o - 2 * y + lead(y) OVER o AS by_, lag(z) OVER o - 2 * z + lead(z) OVER o AS bz FROM w WINDOW o AS (PARTITION BY track, win, j ORDER BY i)),
c AS (SELECT *, sqrt(bx * bx + by_ * by_ + bz * bz) AS bend FROM b), tiers AS (SELECT *, max(bend) OVER g AS most, CASE WHEN max(bend) OVER g < 0.005 THEN 2 WHEN max(bend) OVER g < 0.05 THEN 4 ELSE 8 END AS points, row_number() OVER (PARTITION BY track, win, j ORDER BY bend DESC NULLS LAST, i DESC) AS rank FROM c WINDOW g AS (PARTITION BY track, win, j))"""


def _coded(axis: str) -> str:
    return f"{_CODE.format(axis)} / 255.0::DOUBLE * 4 - 2"


def _curve_sql(knots: str, key: str, steps: str) -> str:
    """CTEs from ``knots`` (key, t, y) to ``curve`` (key, pos, y): the monotone cubic at the places of ``steps`` (pos)."""
    end = lambda h0, h1, d0, d1: f"CASE WHEN ((2 * {h0} + {h1}) * {d0} - {h0} * {d1}) / ({h0} + {h1}) * {d0} <= 0 THEN 0 WHEN {d0} * {d1} <= 0 AND abs(((2 * {h0} + {h1}) * {d0} - {h0} * {d1}) / ({h0} + {h1})) > 3 * abs({d0}) THEN 3 * {d0} ELSE ((2 * {h0} + {h1}) * {d0} - {h0} * {d1}) / ({h0} + {h1}) END"
    o = f"(PARTITION BY {key} ORDER BY t)"
    return f"""k1 AS (SELECT *, (lead(t) OVER {o} - t)::DOUBLE AS h, (lead(y) OVER {o} - y) / (lead(t) OVER {o} - t) AS d, lead(y) OVER {o} AS y1, count(*) OVER (PARTITION BY {key}) AS many FROM {knots}),
k2 AS (SELECT *, lag(h) OVER {o} AS hp, lag(d) OVER {o} AS dp, lag(h, 2) OVER {o} AS hpp, lag(d, 2) OVER {o} AS dpp, lead(h) OVER {o} AS hn, lead(d) OVER {o} AS dn FROM k1),
k3 AS (SELECT *, CASE WHEN many < 3 THEN 0 WHEN hp IS NULL THEN {end("h", "hn", "d", "dn")} WHEN h IS NULL THEN {end("hp", "hpp", "dp", "dpp")} WHEN dp * d > 0 THEN (3 * h + 3 * hp) / ((2 * h + hp) / dp + (h + 2 * hp) / d) ELSE 0 END AS m FROM k2),
k4 AS (SELECT *, lead(m) OVER {o} AS m1 FROM k3),
curve AS (SELECT {key}, pos, CASE WHEN many = 1 THEN y WHEN many = 2 THEN y + d * (pos - t) ELSE (1 + 2 * ((pos - t) / h)) * (1 - (pos - t) / h) ** 2 * y + (pos - t) / h * (1 - (pos - t) / h) ** 2 * h * m + ((pos - t) / h) ** 2 * (3 - 2 * ((pos - t) / h)) * y1 + ((pos - t) / h) ** 2 * ((pos - t) / h - 1) * h * m1 END AS y FROM k4, {steps} WHERE many = 1 OR (h IS NOT NULL AND pos >= t AND (pos < t + h OR (hn IS NULL AND pos = t + h))))"""


@query(f"""{_TIERED}, knots AS (SELECT track, win, j, i AS t, unnest([0, 1, 2]) AS axis, unnest([{_coded("x")}, {_coded("y")}, {_coded("z")}]) AS y FROM tiers WHERE i IN (0, 7) OR rank <= points - 2),
steps AS (SELECT step, step / 2.0::DOUBLE AS pos FROM range(15) r(step)), {_curve_sql("knots", "track, win, j, axis", "steps")}
SELECT track, win AS window_id, j AS joint, CAST(pos * 2 AS BIGINT) AS step, round(max(y) FILTER (axis = 0), 6) + 0.0::DOUBLE AS x, round(max(y) FILTER (axis = 1), 6) + 0.0::DOUBLE AS y, round(max(y) FILTER (axis = 2), 6) + 0.0::DOUBLE AS z FROM curve GROUP BY ALL""")
def q118_decoded_poses(t: Tables) -> DataFrame:
    """Tokens decoded at twice the frame rate: every joint on the monotone cubic through its two, four or eight points."""
    d = poseframes.decoded(poseframes.window_tokens(_windows(t)), times=2)
    return d.select("track", "window_id", "joint", "step", *[F.round(c, 6).alias(c) for c in "xyz"])


@query(f"""{_POINTS}, counts AS (SELECT n, CASE WHEN n = 1 THEN [0::BIGINT] ELSE list_distinct(list_transform(range(n), lambda k: CAST(round_even(k * 7 / (n - 1)::DOUBLE, 0) AS BIGINT))) END AS kept FROM range(1, 9) r(n)),
knots AS (SELECT n, track, win, j, i AS t, unnest([0, 1, 2]) AS axis, unnest([{_coded("x")}, {_coded("y")}, {_coded("z")}]) AS y FROM w, counts WHERE list_contains(kept, i)),
steps AS (SELECT k::DOUBLE AS pos FROM range(8) r(k)), {_curve_sql("knots", "n, track, win, j, axis", "steps")},
e AS (SELECT n, track, win, j, avg(abs(curve.y - CASE axis WHEN 0 THEN w.x WHEN 1 THEN w.y ELSE w.z END)) AS error FROM curve JOIN w USING (track, win, j) WHERE w.i = pos GROUP BY ALL)
SELECT n AS count, count(*) AS samples, round(avg(error), 6) AS mean, round(quantile_cont(error, 0.95), 6) AS high FROM e GROUP BY n""")
def q117b_control_point_sweep(t: Tables) -> DataFrame:
    """Mean and 95th percentile of the error that one to eight evenly spaced coded points leave, over all joints and windows."""
    r = poseframes.sweep_report(_windows(t))
    return r.select("count", "samples", F.round("mean", 6).alias("mean"), F.round("high", 6).alias("high"))


@query(f"""{_TIERED}, s AS (SELECT track, win, j, bool_and(points = 2) AS straight, bool_and(points = 2) AND {" AND ".join(f"max({_CODE.format(c)}) FILTER (i = 0) = max({_CODE.format(c)}) FILTER (i = 7)" for c in "xyz")} AS static FROM tiers GROUP BY ALL)
SELECT count(DISTINCT (track, win)) AS windows, count(*) FILTER (straight) AS straight, count(*) FILTER (static) AS static FROM s""")
def q117c_static_joints(t: Tables) -> DataFrame:
    """Joints on a line, and those of them whose coded ends agree, so that one point would do."""
    return poseframes.static_joints(_windows(t))


@query(f"""{_POINTS}, a AS (SELECT *, x - first(x) OVER g AS rx, y - first(y) OVER g AS ry, z - first(z) OVER g AS rz, first(x) OVER g AS ax, first(y) OVER g AS ay, first(z) OVER g AS az FROM w WINDOW g AS (PARTITION BY track, win, j ORDER BY i)),
s AS (SELECT *, max(greatest(abs(rx), abs(ry), abs(rz))) OVER (PARTITION BY track, win) + 1e-6::DOUBLE AS scale FROM a), u AS (SELECT *, rx / scale AS nx, ry / scale AS ny, rz / scale AS nz FROM s),
d AS (SELECT *, sqrt((nx - lag(nx) OVER o) ** 2 + (ny - lag(ny) OVER o) ** 2 + (nz - lag(nz) OVER o) ** 2) AS step, sqrt((lag(nx) OVER o - 2 * nx + lead(nx) OVER o) ** 2 + (lag(ny) OVER o - 2 * ny + lead(ny) OVER o) ** 2 + (lag(nz) OVER o - 2 * nz + lead(nz) OVER o) ** 2) AS bend FROM u WINDOW o AS (PARTITION BY track, win, j ORDER BY i)),
f AS (SELECT track, win, i, avg(bend) AS bend, CASE WHEN i > 0 THEN greatest(avg(step), 1e-5::DOUBLE) ELSE 0 END AS step FROM d GROUP BY track, win, i),
r AS (SELECT *, row_number() OVER (PARTITION BY track, win ORDER BY bend DESC NULLS LAST, i DESC) AS rank, sum(step) OVER (PARTITION BY track, win ORDER BY i) / sum(step) OVER (PARTITION BY track, win) AS arc FROM f),
k AS (SELECT track, win, i, arc FROM r WHERE i IN (0, 7) OR rank <= 2),
picks AS (SELECT track, win, string_agg(i::VARCHAR, ',' ORDER BY i) AS kept, list(arc ORDER BY i) AS arcs FROM k GROUP BY track, win),
m AS (SELECT track, win, string_agg(concat_ws(',', CAST(floor((least(greatest(nx, -1), 1) + 1) * 127.5::DOUBLE) AS BIGINT), CAST(floor((least(greatest(ny, -1), 1) + 1) * 127.5::DOUBLE) AS BIGINT), CAST(floor((least(greatest(nz, -1), 1) + 1) * 127.5::DOUBLE) AS BIGINT)), ',' ORDER BY i, j) AS motion FROM d SEMI JOIN k USING (track, win, i) GROUP BY track, win),
h AS (SELECT track, win, CAST(round_even(least(max(scale), 2) / 2 * 255, 0) AS BIGINT) AS scale, string_agg(concat_ws(',', {", ".join(f"CAST(round_even((least(greatest(a{c}, -2), 2) + 2) / 4 * 255, 0) AS BIGINT)" for c in "xyz")}), ',' ORDER BY j) AS anchor FROM s WHERE i = 0 GROUP BY track, win)
SELECT track, win AS window_id, kept, round(arcs[2], 6) AS arc_2, round(arcs[3], 6) AS arc_3, md5(scale || ',' || anchor || ',' || motion) AS tokens_md5 FROM picks JOIN m USING (track, win) JOIN h USING (track, win)""")
def q112b_legacy_packages(t: Tables) -> DataFrame:
    """Windows as packages of 256 numbers: scale, anchor and four frames, with their places along the arc."""
    w = poseframes.window_packages(_windows(t))
    arc = lambda k: F.round(F.get("arc", F.lit(k)), 6).alias(f"arc_{k + 1}")
    return w.select("track", "window_id", F.array_join("kept", ",").alias("kept"), arc(1), arc(2), F.md5(F.array_join("tokens", ",")).alias("tokens_md5"))


def _distance(a: str, b: str) -> str:
    return f"sqrt(({a}[1] - {b}[1]) * ({a}[1] - {b}[1]) + ({a}[2] - {b}[2]) * ({a}[2] - {b}[2]) + ({a}[3] - {b}[3]) * ({a}[3] - {b}[3]))"


@query(f"""{_POINTS}, a AS (SELECT track, f, list([x, y, z] ORDER BY j) AS ps FROM p GROUP BY ALL),
d AS (SELECT track, f, {_distance("ps[1]", "ps[9]")} + 1e-6::DOUBLE AS torso, {_distance("ps[15]", "ps[12]")} AS shoulders, greatest({", ".join(_distance(f"ps[{c + 1}]", f"ps[{p + 1}]") for p, c, _ in pose.BONES)}) AS longest, list_median([{", ".join(_distance(f"ps[{k + 1}]", "ps[1]") for k in range(1, 17))}]) AS middle FROM a)
SELECT track, f, shoulders / torso < {pose.SHOULDER_RATIO[0]} OR shoulders / torso > {pose.SHOULDER_RATIO[1]} OR longest > {pose.LONGEST_BONE} * torso OR middle < {pose.NEAREST_MEDIAN} * torso AS implausible FROM d""")
def q119_implausible_poses(t: Tables) -> DataFrame:
    """Frames that no body can make."""
    d = poseframes.frame_flags(_frames(t), pose.implausible)
    return d.select("track", "f", F.col("flag").alias("implausible"))


@query(f"""{_POINTS}, a AS (SELECT track, max(abs(x)) FILTER (j = 0) AS mx, max(abs(y)) FILTER (j = 0) AS my, max(abs(z)) FILTER (j = 0) AS mz FROM p GROUP BY track),
c AS (SELECT p.track, greatest(mx, my, mz) >= 1e-4 AS moved, max(greatest(abs(p.x - CASE WHEN greatest(mx, my, mz) >= 1e-4 THEN r.x ELSE 0 END), abs(p.y - CASE WHEN greatest(mx, my, mz) >= 1e-4 THEN r.y ELSE 0 END), abs(p.z - CASE WHEN greatest(mx, my, mz) >= 1e-4 THEN r.z ELSE 0 END))) AS far FROM p JOIN a ON a.track = p.track JOIN p r ON r.track = p.track AND r.f = p.f AND r.j = 0 GROUP BY ALL)
SELECT track, far > 2 AS out_of_range, round(far, 6) AS far FROM c""")
def q119b_input_guard(t: Tables) -> DataFrame:
    """Tracks centred on the pelvis if they are not, and whether a coordinate is out of the coded range."""
    guarded = poseframes.guarded(_frames(t))
    return guarded.groupBy("track").agg(F.max(F.array_max(F.transform("xyz", lambda v: F.abs(v)))).alias("far")).select("track", (F.col("far") > 2).alias("out_of_range"), F.round("far", 6).alias("far"))


def _rest() -> list[float]:
    """A standing body: every bone down or up, the hips and shoulders to the side."""
    at = {0: (0.0, 0.0, 0.0)}
    for parent, child, length in pose.BONES:
        side = {1: 1, 14: 1, 4: -1, 11: -1}.get(child, 0)
        way = (side, 0, 0) if side else (0, 1 if child in (2, 3, 5, 6, 12, 13, 15, 16) else -1, 0.1)
        at[child] = tuple(a + w * length for a, w in zip(at[parent], way, strict=True))
    return [round(v + 1.0, 6) for j in range(17) for v in at[j]]


# Bodies that move with the vectors: some frames shaken, some moved away, some without a pelvis; coordinates missing here and there, and for longer.
_SHAKEN, _AWAY, _ROOTLESS = "CASE WHEN vec_id % 7 = 0 THEN 1.5D ELSE 0.1D END", "CASE WHEN vec_id % 13 = 0 THEN 0.6D ELSE 0.0D END", "vec_id % 29 = 0"
_MISSING = "(vec_id * 31 + {c}) % 53 = 0 OR ({c} BETWEEN 24 AND 26 AND vec_id // 80 % 5 = 1)"


def _bodies(t: Tables, confidence: Column | None = None) -> DataFrame:
    def value(c: int, rest: float):
        moved = F.lit(rest) + F.get("embedding", F.lit(c)).cast("double") * F.expr(_SHAKEN) + F.expr(_AWAY)
        missing = F.expr(_MISSING.format(c=c).replace("//", "DIV"))
        return F.when(F.expr(_ROOTLESS), F.lit(0.0)).when(~missing, moved)

    xyz = F.array(*[value(c, r) for c, r in enumerate(_rest())])
    return poseframes.pose_frames(t.embeddings, F.col("label"), "vec_id", xyz, **({} if confidence is None else {"confidence": confidence}))


_BODIES = f"""WITH fr AS (SELECT vec_id, label::VARCHAR AS track, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS f FROM embeddings),
raw AS (SELECT track, f, c, CASE WHEN {_ROOTLESS} THEN 0.0::DOUBLE WHEN NOT ({_MISSING.format(c="c")}) THEN {[*_rest()]}[c + 1]::DOUBLE + embedding[c + 1]::DOUBLE * {_SHAKEN.replace("D ", "::DOUBLE ")} + {_AWAY.replace("D ", "::DOUBLE ")} END AS v FROM fr, range(51) r(c)),
n AS (SELECT track, count(*) AS n, greatest(2, CAST(round_even(count(*) / 24.0::DOUBLE * 30, 0) AS BIGINT)) AS m FROM fr GROUP BY track),
g AS (SELECT track, n, m, unnest(range(m)) AS f FROM n), i AS (SELECT *, least(f * (n - 1) // (m - 1), n - 2) AS k FROM g),
u AS (SELECT i.track, i.f, m, a.c, CASE WHEN i.f * (n - 1) = k * (m - 1) THEN a.v WHEN i.f * (n - 1) = (k + 1) * (m - 1) THEN b.v ELSE a.v + (b.v - a.v) * ((i.f * (n - 1) - k * (m - 1)) / (m - 1)::DOUBLE) END AS v FROM i JOIN raw a ON a.track = i.track AND a.f = i.k JOIN raw b ON b.track = i.track AND b.f = i.k + 1 AND b.c = a.c),
ends AS (SELECT *, last(CASE WHEN v IS NOT NULL THEN {{'f': f, 'v': v}} END IGNORE NULLS) OVER (PARTITION BY track, c ORDER BY f) AS lo, first(CASE WHEN v IS NOT NULL THEN {{'f': f, 'v': v}} END IGNORE NULLS) OVER (PARTITION BY track, c ORDER BY f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi FROM u),
filled AS (SELECT track, f, c, CASE WHEN v IS NOT NULL OR coalesce(hi.f, m) - coalesce(lo.f, -1) - 1 > 5 THEN v WHEN lo IS NULL THEN hi.v WHEN hi IS NULL THEN lo.v ELSE lo.v + (hi.v - lo.v) / (hi.f - lo.f) * (f - lo.f) END AS v FROM ends),
s AS (SELECT track, f, list_transform(range(17), lambda j: vs[3 * j + 1:3 * j + 3]) AS ps FROM (SELECT track, f, list(v ORDER BY c) AS vs FROM filled GROUP BY track, f))"""


def _clean_sql() -> str:
    """The steps of cleaning as CTEs over frames, 24 to 30 a second."""
    bones, named = [], ["n0 AS (SELECT track, f, out, bad, ps, [0.0::DOUBLE, 0.0, 0.0] AS q0 FROM m)"]
    for i, (parent, child, length) in enumerate(pose.BONES):
        d = [f"(ps[{child + 1}][{k}] - ps[{parent + 1}][{k}])" for k in (1, 2, 3)]
        norm = f"(sqrt({d[0]} * {d[0]} + {d[1]} * {d[1]} + {d[2]} * {d[2]}) + 1e-8::DOUBLE)"
        named.append(f"n{i + 1} AS (SELECT *, [" + ", ".join(f"q{parent}[{k}] + {d[k - 1]} / {norm} * {length}::DOUBLE" for k in (1, 2, 3)) + f"] AS q{child} FROM n{i})")
    bones = ", ".join(named)
    unit = lambda v: f"(CASE WHEN {v} IS NOT NULL THEN list_transform({v}, lambda c: c / (sqrt(list_sum(list_transform({v}, lambda e: e * e))) + 1e-8::DOUBLE)) END)"
    less = lambda a, b: f"[q[{a + 1}][1] - q[{b + 1}][1], q[{a + 1}][2] - q[{b + 1}][2], q[{a + 1}][3] - q[{b + 1}][3]]"
    leg = lambda hip, knee, ankle: f"(coalesce(-(q[{ankle + 1}][2] - q[1][2]) > {pose.FOOT_MARGIN} * span, false) OR coalesce((t{hip}[2] * c{hip}[3] - t{hip}[3] * c{hip}[2]) * hips[1] + (t{hip}[3] * c{hip}[1] - t{hip}[1] * c{hip}[3]) * hips[2] + (t{hip}[1] * c{hip}[2] - t{hip}[2] * c{hip}[1]) * hips[3] < {pose.BEND_LEAST}, false) OR coalesce(t{hip}[1] * c{hip}[1] + t{hip}[2] * c{hip}[2] + t{hip}[3] * c{hip}[3] < 0, false))"
    laid = lambda j, hip, far: f"[q[{hip + 1}][k] + spine[k] * {far}::DOUBLE for k in [1, 2, 3]]"
    moved = {5: (4, 0.45), 6: (4, 0.9), 2: (1, 0.45), 3: (1, 0.9)}
    joints = ", ".join(f"CASE WHEN w{moved[j][0]} THEN {laid(j, *moved[j])} ELSE q[{j + 1}] END" if j in moved else f"q[{j + 1}]" for j in range(17))
    return f"""{_BODIES},
d AS (SELECT *, {_distance("ps[1]", "ps[9]")} + 1e-6::DOUBLE AS torso, {_distance("ps[15]", "ps[12]")} AS shoulders, greatest({", ".join(_distance(f"ps[{c + 1}]", f"ps[{p + 1}]") for p, c, _ in pose.BONES)}) AS longest, list_median([{", ".join(_distance(f"ps[{k + 1}]", "ps[1]") for k in range(1, 17))}]) AS middle FROM s),
o AS (SELECT track, f, ps, coalesce(shoulders / torso < {pose.SHOULDER_RATIO[0]} OR shoulders / torso > {pose.SHOULDER_RATIO[1]}, false) OR coalesce(longest > {pose.LONGEST_BONE} * torso, false) OR coalesce(middle < {pose.NEAREST_MEDIAN} * torso, false) AS out FROM d),
m AS (SELECT track, f, out, ps, coalesce({_distance("(CASE WHEN NOT out THEN ps[1] END)", "(lag(CASE WHEN NOT out THEN ps[1] END) OVER (PARTITION BY track ORDER BY f))")} > {pose.PELVIS_JUMP}, false) OR (NOT out AND coalesce(ps[1] = [0.0::DOUBLE, 0.0, 0.0], false)) AS bad FROM o),
{bones}, v AS (SELECT track, f, bad, unnest(range(17)) AS j, unnest([{", ".join(f"CASE WHEN NOT bad AND NOT (out AND {k} > 0) AND q{k}[1] IS NOT NULL THEN q{k} END" for k in range(17))}]) AS q FROM n{len(pose.BONES)}),
l AS (SELECT track, max(f) AS last FROM v GROUP BY track),
e AS (SELECT v.*, last, first(q) OVER (PARTITION BY track, j ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS q_first, last(q) OVER (PARTITION BY track, j ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS q_last, {", ".join(f"lag(q, {k}) OVER t AS b{k}, lead(q, {k}) OVER t AS a{k}" for k in (1, 2))} FROM v JOIN l USING (track) WINDOW t AS (PARTITION BY track, j ORDER BY f)),
near AS (SELECT track, f, bad, j, q, list_filter([CASE WHEN f < 2 THEN q_first ELSE b2 END, CASE WHEN f < 1 THEN q_first ELSE b1 END, q, CASE WHEN f + 1 > last THEN q_last ELSE a1 END, CASE WHEN f + 2 > last THEN q_last ELSE a2 END], lambda x: x IS NOT NULL) AS around FROM e),
sm AS (SELECT track, f, bad, j, CASE WHEN q IS NOT NULL THEN [list_sum([x[c] for x in around]) / len(around) for c in [1, 2, 3]] END AS q FROM near),
reach AS (SELECT track, f, avg(sqrt((q[1] - r[1]) ** 2 + (q[2] - r[2]) ** 2 + (q[3] - r[3]) ** 2)) AS reach FROM (SELECT *, max(q) FILTER (j = 0) OVER (PARTITION BY track, f) AS r FROM sm) GROUP BY ALL), span AS (SELECT track, median(reach) AS span FROM reach GROUP BY track),
sp AS (SELECT *, [(q[c] - (lag(q) OVER t)[c]) * 30 for c in [1, 2, 3]] AS v FROM sm JOIN span USING (track) WINDOW t AS (PARTITION BY track, j ORDER BY f)),
ac AS (SELECT *, [(v[c] - (lag(v) OVER t)[c]) * 30 for c in [1, 2, 3]] AS a FROM sp WINDOW t AS (PARTITION BY track, j ORDER BY f)),
kept AS (SELECT track, f, bad, span, j, CASE WHEN coalesce(sqrt(v[1] ** 2 + v[2] ** 2 + v[3] ** 2) / span > {pose.MOST_SPEED}, false) OR coalesce(sqrt(a[1] ** 2 + a[2] ** 2 + a[3] ** 2) / span > {pose.MOST_ACCELERATION}, false) THEN NULL ELSE q END AS q FROM ac),
fr2 AS (SELECT track, f, any_value(bad) AS bad, any_value(span) AS span, list(q ORDER BY j) AS q FROM kept GROUP BY track, f),
legs AS (SELECT *, {unit(less(4, 1))} AS hips, {unit(less(0, 8))} AS spine, {", ".join(f"{unit(less(hip + 1, hip))} AS t{hip}, {unit(less(hip + 2, hip + 1))} AS c{hip}" for hip in (1, 4))} FROM fr2),
wrong AS (SELECT *, {", ".join(f"{leg(hip, hip + 1, hip + 2)} AS w{hip}" for hip in (1, 4))} FROM legs),
fin AS (SELECT track, f, CASE WHEN bad OR span IS NULL OR span = 0 THEN [] ELSE [x for x in [{joints}] if x IS NOT NULL AND x[1] IS NOT NULL AND x[2] IS NOT NULL AND x[3] IS NOT NULL] END AS q FROM wrong)
SELECT track, f, len(q) AS joints, round(coalesce(list_sum([x[1] + x[2] + x[3] for x in q]), 0), 4) AS total FROM fin"""


@query(_clean_sql())
def q115_cleaned_poses(t: Tables) -> DataFrame:
    """Raw tracks resampled, filled and cleaned in blocks with a halo: joints left of every frame, and the sum of their coordinates."""
    c = poseframes.cleaned(_bodies(t), src_fps=24.0, size=64)
    joints = F.filter(F.transform(F.sequence(F.lit(0), F.lit(16)), lambda j: F.slice("xyz", 3 * j + 1, 3)), lambda p: F.forall(p, lambda v: v.isNotNull()))
    total = F.aggregate(F.flatten(joints), F.lit(0.0), lambda acc, v: acc + v)
    return c.select("track", "f", F.size(joints).cast("bigint").alias("joints"), F.round(total, 4).alias("total"))


def _mocap_sql() -> str:
    """Gating, filling, centring and bone lengths."""
    named = ["n0 AS (SELECT track, f, ps, [0.0::DOUBLE, 0.0, 0.0] AS q0 FROM s)"]
    for i, (parent, child, length) in enumerate(pose.BONES):
        d = [f"((ps[{child + 1}][{k}] - ps[1][{k}]) - (ps[{parent + 1}][{k}] - ps[1][{k}]))" for k in (1, 2, 3)]
        norm = f"(sqrt({d[0]} * {d[0]} + {d[1]} * {d[1]} + {d[2]} * {d[2]}) + 1e-8::DOUBLE)"
        named.append(f"n{i + 1} AS (SELECT *, [" + ", ".join(f"q{parent}[{k}] + {d[k - 1]} / {norm} * {length}::DOUBLE" for k in (1, 2, 3)) + f"] AS q{child} FROM n{i})")
    gated = _BODIES[: _BODIES.index("n AS (SELECT track")]
    filled = _BODIES[_BODIES.index("ends AS (") :]
    return f"""{gated}u AS (SELECT raw.track, raw.f, raw.c, m, CASE WHEN abs(embedding[c // 3 + 20]::DOUBLE) * 5 >= 0.3 THEN v END AS v FROM raw JOIN fr USING (track, f) JOIN (SELECT track, count(*) AS m FROM fr GROUP BY track) USING (track)),
{filled}, {", ".join(named)}, j AS (SELECT track, f, [x for x in [{", ".join(f"q{k}" for k in range(17))}] if x[1] IS NOT NULL] AS q FROM n{len(pose.BONES)})
SELECT track, f, len(q) AS joints, round(list_sum([x[1] + x[2] + x[3] for x in q]), 4) AS total FROM j"""


@query(_mocap_sql())
def q115b_mocap_poses(t: Tables) -> DataFrame:
    """Motion capture gated by confidence, filled and given fixed bone lengths, without noise tests."""
    confidence = F.array(*[F.abs(F.get("embedding", F.lit(j + 19)).cast("double")) * 5 for j in range(17)])
    c = poseframes.cleaned_mocap(_bodies(t, confidence), size=32)
    joints = F.filter(F.transform(F.sequence(F.lit(0), F.lit(16)), lambda j: F.slice("xyz", 3 * j + 1, 3)), lambda p: F.forall(p, lambda v: v.isNotNull()))
    return c.select("track", "f", F.size(joints).cast("bigint").alias("joints"), F.round(F.aggregate(F.flatten(joints), F.lit(0.0), lambda acc, v: acc + v), 4).alias("total"))


@query("SELECT event_id, abs(value / 30.0::DOUBLE - 1) < 0.05 AS unchanged FROM events")
def q115c_unchanged_rates(t: Tables) -> DataFrame:
    """Frame rates near enough to thirty to be left as they are."""
    return t.events.select("event_id", poseframes.unchanged_rate(F.col("value").cast("double")).alias("unchanged"))


@query(f"""{FR}, n AS (SELECT user_id, count(*) AS n FROM fr GROUP BY user_id), g AS (SELECT fr.user_id, fr.f, min(w) AS w FROM fr JOIN n USING (user_id), LATERAL (SELECT unnest([fr.f // 4 * 4 - 4, fr.f // 4 * 4]) AS w) x WHERE w >= 0 AND w + 8 <= n AND event_type <> 'error' GROUP BY ALL)
SELECT g.user_id::VARCHAR AS track, g.f, round(fr.value + g.w, 6) AS value FROM g JOIN fr ON fr.user_id = g.user_id AND fr.f = g.f""")
def q116_first_window_wins(t: Tables) -> DataFrame:
    """Overlapping windows back to frames, each frame from the first window that has it."""
    d = fr(t).withColumn("p", F.array(F.array(F.when(F.col("event_type") != "error", F.col("value")))))
    w = windows.sliding(d, "user_id", 8, "p").filter("window_id % 4 = 0")
    states = F.transform("states", lambda f: F.transform(f, lambda j: F.transform(j, lambda v: v + F.col("window_id"))))
    out = pose.first_seen(w.select(F.col("user_id").cast("string").alias("track"), "window_id", states.alias("states")))
    return out.select("track", F.col("f").cast("bigint").alias("f"), F.round(F.get("xyz", F.lit(0)), 6).alias("value"))


@query("""SELECT vec_id, round(max(abs(x - y)), 6) AS worst FROM (SELECT vec_id, unnest(embedding[1:16:5])::DOUBLE AS x, unnest(embedding[1:16:5])::DOUBLE AS y FROM embeddings) GROUP BY vec_id""")
def q117_curve_through_points(t: Tables) -> DataFrame:
    """The monotone cubic through four points of each vector meets the points."""
    kept = [0, 5, 10, 15]

    @F.pandas_udf("double")
    def worst(vectors: pd.Series) -> pd.Series:
        return pd.Series([float(np.abs(pchip(np.array(kept), np.asarray(v, float)[kept], np.arange(16))[kept] - np.asarray(v, float)[kept]).max()) for v in vectors])

    return t.embeddings.select("vec_id", F.round(worst("embedding"), 6).alias("worst"))


# Files and streams: written to the shared folder, read back by the operators.


@query(f"""SELECT event_id, event_type, {K_SQL} AS k FROM events""")
def q120_json_lines(t: Tables) -> DataFrame:
    """Events as gzip JSON lines, with broken and blank lines between them, read back."""
    path = new_path(t.spark, "jsonl")
    line = F.to_json(F.struct("event_id", "event_type", k_of().alias("k")))
    broken = F.explode(F.when(F.col("event_id") % 7 == 0, F.array(line, F.lit("{broken"), F.lit(""))).otherwise(F.array(line)))
    t.events.select(broken.alias("value")).write.option("compression", "gzip").text(path)
    return text_sources.read_jsonl(t.spark, path, "event_id bigint, event_type string, k bigint")


@query(f"""SELECT event_id, {K_SQL} AS k FROM events""")
def q120b_strict_json_lines(t: Tables) -> DataFrame:
    """Events as JSON lines, read strictly."""
    path = new_path(t.spark, "strict")
    # a first task without rows leaves an empty file, which the reader takes for an error; partitioned writes make files for rows only
    t.events.select("event_id", k_of().alias("k"), F.lit(0).alias("part")).write.partitionBy("part").json(path)
    return text_sources.read_jsonl_strict(t.spark, path, "event_id bigint, k bigint", ("event_id", "k")).select("event_id", "k")


@query("""WITH q AS (SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 0), a AS (SELECT doc_id, doc_id - 1 AS parent FROM documents WHERE doc_id % 2 = 1)
SELECT a.doc_id AS answer_id, q.lang AS question FROM a JOIN q ON q.doc_id = a.parent""")
def q120c_posts(t: Tables) -> DataFrame:
    """Documents as an XML dump of questions and answers, read back and joined."""
    path = new_path(t.spark, "posts")
    asks = F.col("doc_id") % 2 == 0
    row = F.concat(F.lit('<row Id="'), "doc_id", F.when(asks, F.concat(F.lit('" PostTypeId="1" Title="'), "lang")).otherwise(F.concat(F.lit('" PostTypeId="2" ParentId="'), F.col("doc_id") - 1)), F.lit('" Body="b"/>'))
    rows = t.documents.select(F.floor(F.col("doc_id") / 1000).alias("file"), F.lit(1).alias("at"), row.alias("value"))
    ends = [rows.select("file").distinct().select("file", F.lit(at).alias("at"), F.lit(tag).alias("value")) for at, tag in ((0, "<posts>"), (2, "</posts>"))]
    whole = rows.unionByName(ends[0]).unionByName(ends[1]).repartition("file").sortWithinPartitions("file", "at")
    whole.drop("at").write.partitionBy("file").text(path)
    found = text_sources.answers_with_questions(text_sources.read_posts(t.spark, f"{path}/file=*"))
    return found.select(F.col("Id").alias("answer_id"), "question")


@query("""WITH n AS (SELECT count(*) AS total FROM documents), d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) SELECT doc_id, i % 7 AS by_modulo, least(i // CAST(ceil(total / 7.0) AS BIGINT), 6) AS by_block FROM d, n""")
def q120d_file_parts(t: Tables) -> DataFrame:
    """Files dealt over seven parts, by number and by blocks."""
    total = t.documents.count()
    d = corpus.size_shards(t.documents.select("doc_id", F.lit(1).cast("bigint").alias("one")), "doc_id", "one", 1).withColumnRenamed("shard", "i")
    return d.select("doc_id", text_sources.partition_of(F.col("i"), 7, "modulo").alias("by_modulo"), text_sources.partition_of(F.col("i"), 7, "contiguous", total).alias("by_block"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 24.0 ELSE 30.0 END AS fps FROM documents""")
def q121_shards_with_new_columns(t: Tables) -> DataFrame:
    """Parquet shards, checked for completeness, with a column replaced and a fallback where the lookup has none."""
    path = new_path(t.spark, "shards")
    sinks.write_parquet_shards(t.documents.select("doc_id", F.lit(0.0).alias("fps")), path, 4)
    sinks.check_shards(t.spark, path, 4)
    lookup = t.documents.filter("doc_id % 3 = 0").select("doc_id", F.lit(24.0).alias("fps")).distinct()
    return sinks.replace_columns(t.spark.read.parquet(path), lookup, "doc_id", {"fps": 30.0}).select("doc_id", "fps")


@query("""WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents) SELECT count(*) AS rows, 4 AS files, 'train-00000-of-00004.jsonl.gz' AS first_name FROM d""")
def q122_named_shards(t: Tables) -> DataFrame:
    """Named gzip shards: their number, the first name and all rows."""
    path = new_path(t.spark, "named")
    sinks.write_named_shards(t.documents.select("doc_id", "lang"), path, "train", 4, "doc_id")
    d = t.spark.read.json(path).select("doc_id", F.col("_metadata.file_name").alias("file"))
    return d.agg(F.count("*").alias("rows"), F.countDistinct("file").cast("int").alias("files"), F.min("file").alias("first_name"))


@query("""WITH d AS (SELECT doc_id, n_chars, (sum(n_chars) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - n_chars)::BIGINT // 100000 AS shard FROM documents) SELECT shard, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM d GROUP BY shard""")
def q122b_rolled_shards(t: Tables) -> DataFrame:
    """Shards rolled at a number of characters, written and read back."""
    path = new_path(t.spark, "rolled")
    sinks.write_size_shards(t.documents.select("doc_id", "n_chars"), path, "doc_id", "n_chars", 100_000)
    d = t.spark.read.json(path)
    return d.groupBy(F.col("shard").cast("bigint").alias("shard")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""WITH d AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 150 AS shard FROM documents) SELECT shard, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last, CASE WHEN shard = 5 THEN 'test' ELSE 'train' END AS split FROM d GROUP BY shard""")
def q122c_row_shards(t: Tables) -> DataFrame:
    """Shards of 150 rows, and the split that the shard's name decides."""
    path = new_path(t.spark, "row-shards")
    sinks.write_row_shards(t.documents.select("doc_id", "lang"), path, "doc_id", 150)
    shard = F.regexp_extract(F.col("_metadata.file_path"), r"shard=(\d+)/", 1).cast("bigint")
    files = t.spark.read.schema("doc_id bigint, lang string").json(path).withColumn("shard", shard)
    split = corpus.split_by_shard(F.col("shard"), (5,))
    return files.groupBy("shard").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).withColumn("split", split)


@query("SELECT doc_id, n_chars, 0::BIGINT AS empty_files FROM documents WHERE n_chars > 1000")
def q122d_all_or_nothing(t: Tables) -> DataFrame:
    """Lines that appear at once, and no file at all for an empty result."""
    path, none = new_path(t.spark, "lines"), new_path(t.spark, "none")
    d = t.documents.select("doc_id", "n_chars")
    sinks.write_jsonl_if_any(d.filter("n_chars > 1000"), path)
    empty = 1 if sinks.write_jsonl_if_any(d.filter("n_chars < 0"), none) else 0
    return t.spark.read.schema("doc_id bigint, n_chars bigint").json(path).withColumn("empty_files", F.lit(empty).cast("bigint"))


@query("""SELECT user_id % 3 AS rank, count(*) AS n FROM events GROUP BY ALL""")
def q123_files_by_rank(t: Tables) -> DataFrame:
    """Output by the rank in the input file's name."""
    path = new_path(t.spark, "ranks")
    sinks.write_per_rank(t.events.select("event_id", F.concat(F.lit("part_rank_"), F.col("user_id") % 3, F.lit(".jsonl")).alias("name")), path, "name")
    return t.spark.read.json(path).groupBy(F.col("rank").cast("bigint").alias("rank")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'given' ELSE 'rows' END AS video_id FROM documents""")
def q125_injected_ids(t: Tables) -> DataFrame:
    """Ids from the file's name where a line lacks one."""
    path = new_path(t.spark, "ids")
    given = F.when(F.col("doc_id") % 2 == 0, "given")
    sinks.write_named_shards(t.documents.select("doc_id", given.alias("video_id")), path, "rows", 2, "doc_id")
    d = text_sources.with_video_id(t.spark.read.schema("doc_id bigint, video_id string").json(path))
    return d.select("doc_id", F.regexp_replace("video_id", "-[0-9]+-of-[0-9]+$", "").alias("video_id"))


@query("""SELECT epoch_us(date_trunc('day', ts)) // 86400000000 AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def q126_stream_counts(t: Tables) -> DataFrame:
    """Daily windows by type, counted by a stream that takes the table in three files and then stops."""
    source, out, state = (new_path(t.spark, n) for n in ("stream", "counts", "state"))
    t.events.select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts")).repartition(3).write.parquet(source)
    counts = incremental.windowed_counts(incremental.stream_parquet(t.spark, source, 1), lateness="36500 days")
    incremental.run_available(counts, out, state, mode="update")
    d = t.spark.read.parquet(out)  # an update replaces the counts of earlier batches
    last = d.groupBy("start", "event_type").agg(F.max_by(F.struct("n", "total"), "batch").alias("x"))
    return last.select(F.floor(F.unix_micros("start") / 86400000000).alias("day"), "event_type", "x.n", F.round("x.total", 4).alias("total"))


@query(f"""{FR} SELECT user_id, f // 8 * 8 AS window_id, count(*) FILTER (event_type = 'error') AS absent FROM fr GROUP BY ALL HAVING count(*) = 8 AND count(*) FILTER (event_type = 'error') <= 3""")
def q127_stream_presence(t: Tables) -> DataFrame:
    """Windows with enough frames present, decided by a stream as their last frame comes in; a second run of the same stream takes nothing twice."""
    source, out, state = (new_path(t.spark, n) for n in ("frames", "present", "state"))
    frames = fr(t).select(F.col("user_id").alias("track"), "f", (F.col("event_type") != "error").alias("present"), F.col("ts").cast("timestamp").alias("seen_at"))
    frames.repartitionByRange(3, "seen_at").write.parquet(source)
    for _ in range(2):
        stream = incremental.presence_windows(incremental.stream_parquet(t.spark, source, 1), 8, lateness="36500 days")
        incremental.run_available(stream, out, state)
    return t.spark.read.parquet(out).select(F.col("track").alias("user_id"), "window_id", "absent")


@query(f"""{FR} SELECT user_id, f // 8 * 8 AS window_id, round(sum(value), 6) AS total, arg_min(value, f) AS first_value, count(*) FILTER (event_type = 'error') AS absent FROM fr GROUP BY ALL HAVING count(*) = 8 AND count(*) FILTER (event_type = 'error') <= 3""")
def q127b_ordered_windows(t: Tables) -> DataFrame:
    """Windows of a stream whose frames come in no order: each is given out, with its values in order, when it and all before it are whole."""
    source, out, state = (new_path(t.spark, n) for n in ("frames", "ordered", "state"))
    frames = fr(t).select(F.col("user_id").alias("track"), "f", F.col("value").cast("double").alias("value"), (F.col("event_type") != "error").alias("present"), F.col("ts").cast("timestamp").alias("seen_at"))
    frames.repartition(3, F.xxhash64("f", "track")).write.parquet(source)
    stream = ordered.ordered_windows(incremental.stream_parquet(t.spark, source, 1), 8, lateness="36500 days")
    incremental.run_available(stream, out, state)
    w = t.spark.read.parquet(out)
    return w.select(F.col("track").alias("user_id"), "window_id", F.round(F.aggregate("states", F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.get("states", F.lit(0)).alias("first_value"), "absent")


@query("""SELECT doc_id, lang, n_chars, (SELECT count(*) FROM documents) AS listed FROM documents""")
def q126b_manifest_shards(t: Tables) -> DataFrame:
    """A stream into shards with a manifest, run twice: every row once, and as many as the manifest lists."""
    source, out, state = (new_path(t.spark, n) for n in ("stream", "shards", "state"))
    t.documents.select("doc_id", "lang", "n_chars").repartition(3, "doc_id").write.parquet(source)
    for _ in range(2):
        manifest.run_to_manifest(incremental.stream_parquet(t.spark, source, 1), out, state)
    listed = manifest.read_manifest(t.spark, out).agg(F.sum("rows").alias("listed"))
    return manifest.read_shards(t.spark, out, "doc_id bigint, lang string, n_chars bigint").drop("shard").crossJoin(F.broadcast(listed))  # one row


@query(f"""WITH w AS (SELECT doc_id, text FROM documents WHERE contains(text, 'e')), a AS (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 1000)
SELECT doc_id FROM a WHERE contains(text, 'e') ORDER BY {UNIFORM_SQL.format("doc_id || '|7'")} LIMIT 1""")
def q128_random_pick(t: Tables) -> DataFrame:
    """One of the first thousand documents that hold a marker: a sampling operator."""
    return stream_ops.pick_one(t.documents, "doc_id", "text", "e", "7").select("doc_id")


_SYNONYMS = (("wonder", "marvel"), ("mention", "remark"), ("station", "depot"))


@query(f"""{FR}, w AS (SELECT user_id, f, CASE {K_SQL} % 3 WHEN 0 THEN 'Wonder' WHEN 1 THEN 'mention' ELSE 'station' END AS w FROM fr),
s AS (SELECT user_id, f, w, CASE lower(w) WHEN 'wonder' THEN 'marvel' WHEN 'mention' THEN 'remark' ELSE 'depot' END AS s FROM w)
SELECT user_id, string_agg(CASE WHEN {UNIFORM_SQL.format("user_id || '|' || f || '|syn'")} < 0.15 THEN CASE WHEN w = 'Wonder' THEN upper(s[1]) || s[2:] ELSE s END ELSE w END, ' ' ORDER BY f) AS text FROM s GROUP BY user_id""")
def q129_synonyms(t: Tables) -> DataFrame:
    """Long words replaced by synonyms at a rate, the first letter's case kept."""
    w = fr(t).select("user_id", "f", F.expr(f"CASE get_json_object(props, '$.k') % 3 WHEN 0 THEN 'Wonder' WHEN 1 THEN 'mention' ELSE 'station' END").alias("w"))
    texts = w.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "w"))), lambda x: x.w), " ").alias("text"))
    return stream_ops.replace_words(texts, "user_id", "text", t.spark.createDataFrame(list(_SYNONYMS), "word string, synonym string"), 0.15)


@query(f"""WITH s AS (SELECT DISTINCT lower(w) AS word FROM (SELECT unnest({WORDS_SQL}) AS w FROM benchmark) WHERE length(w) > 5),
w AS (SELECT doc_id, unnest({WORDS_SQL}) AS w, unnest(range(len({WORDS_SQL}))) AS i FROM documents),
n AS (SELECT doc_id, i, CASE WHEN word IS NOT NULL AND length(w) > 5 AND {UNIFORM_SQL.format("doc_id || '|' || i || '|syn'")} < 0.15 THEN CASE WHEN w[1] = upper(w[1]) THEN upper(reverse(word)[1]) || reverse(word)[2:] ELSE reverse(word) END ELSE w END AS w FROM w LEFT JOIN s ON word = lower(w)),
j AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM n GROUP BY doc_id) SELECT doc_id, md5(j.text) AS text_md5 FROM documents LEFT JOIN j USING (doc_id)""")
def q129b_replaced_words(t: Tables) -> DataFrame:
    """Words of whole documents that the benchmark knows, replaced at a rate by their entry in a table (here the word backwards)."""
    known = t.benchmark.select(F.explode(words(F.col("text"))).alias("w")).filter(F.length("w") > 5).select(F.lower("w").alias("word")).distinct()
    d = stream_ops.replace_words(t.documents.select("doc_id", "text"), "doc_id", "text", known.withColumn("synonym", F.reverse("word")), 0.15)
    return d.select("doc_id", F.md5("text").alias("text_md5"))
