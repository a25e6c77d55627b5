"""Queries over tracks: each user's events in order are the frames of a track."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import text, tokens
from ..operators import asof, corpus, flatten, intervals, windows
from ..operators import streams as stream_ops
from .registry import Tables, query

FR = "WITH fr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS f FROM events)"
KIND_SQL = "CASE event_type WHEN 'view' THEN 'seed2' WHEN 'click' THEN 'cosmos' WHEN 'purchase' THEN 'avc_lm' WHEN 'signup' THEN 'caption' ELSE 'agent' END"
K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def by_track() -> WindowSpec:
    return Window.partitionBy("user_id").orderBy("f")


def kind_of() -> Column:
    """The block kind that stands for an event's type."""
    return F.expr(KIND_SQL)


def k_of() -> Column:
    """The number in an event's JSON."""
    return F.get_json_object("props", "$.k").cast("bigint")


def fr(t: Tables) -> DataFrame:
    return windows.frames(t.events)


def streams(t: Tables) -> DataFrame:
    """One token stream per user: a block per event, its payload the event's k and whole value."""
    block = F.concat(F.lit("<"), kind_of(), F.lit("> "), k_of(), F.lit(" "), F.floor("value"), F.lit(" </"), kind_of(), F.lit(">"))
    rows = fr(t).select("user_id", "f", block.alias("block"))
    return rows.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "block"))), lambda x: x.block), " ").alias("stream"))


@query(f"""{FR}, b AS (SELECT user_id, f, {KIND_SQL} AS kind, {K_SQL} AS k, CAST(floor(value) AS BIGINT) AS v FROM fr),
s AS (SELECT *, coalesce(sum(CASE WHEN kind = 'avc_lm' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM b),
fl AS (SELECT user_id, seg, max(f) FILTER (kind = 'avc_lm') AS pos,
  max_by('<caption> ' || k || ' ' || v || ' </caption>', f) FILTER (kind = 'caption') AS c,
  max_by('<seed2> <seed2_' || k || '> <seed2_' || v || '> </seed2>', f) FILTER (kind = 'seed2') AS s2,
  max_by('<cosmos> <cosmos_' || k || '> <cosmos_' || v || '> </cosmos>', f) FILTER (kind = 'cosmos') AS co FROM s GROUP BY ALL),
side AS (SELECT a.user_id, a.f + 0.5 AS pos, '<speech> chunk ' || (row_number() OVER (PARTITION BY a.user_id ORDER BY a.f) - 1) || ' </speech>' AS piece FROM b a WHERE kind = 'avc_lm'),
pieces AS (SELECT user_id, CAST(pos AS DOUBLE) AS pos, concat_ws(' ', c, s2, co) AS piece FROM fl WHERE pos IS NOT NULL
  UNION ALL SELECT user_id, CAST(f AS DOUBLE), '<agent> <agent_' || k || '> <agent_' || v || '> </agent>' FROM b WHERE kind = 'agent'
  UNION ALL SELECT user_id, CAST(pos AS DOUBLE), piece FROM side)
SELECT user_id, string_agg(piece, ' ' ORDER BY pos) AS text FROM pieces WHERE piece <> '' GROUP BY user_id""")
def q01_merge_flatten(t: Tables) -> DataFrame:
    """Parse every user's stream, merge a speech block after each avc_lm by chunk, and flatten."""
    blocks = flatten.explode_blocks(streams(t), "user_id", "stream")
    chunks = fr(t).filter(kind_of() == "avc_lm").groupBy("user_id").agg(F.count("*").alias("n"))
    speech = chunks.select("user_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("chunk")).withColumn("payload", F.concat(F.lit("chunk "), "chunk"))
    return flatten.flatten_blocks(flatten.merge_side(blocks, speech, "user_id", "speech"), "user_id")


@query(f"""{FR}, t AS (SELECT user_id, f, CASE WHEN event_type = 'view' THEN '<seed2_' || {K_SQL} || '>' WHEN event_type = 'click' THEN '<cosmos_' || {K_SQL} || '>' WHEN event_type = 'purchase' THEN '<avclm_' || {K_SQL} || '>' WHEN event_type = 'error' THEN '<x_' || {K_SQL} || '>' ELSE 'word' || {K_SQL} END AS token FROM fr),
c AS (SELECT user_id, CASE WHEN regexp_matches(token, '^<seed2_[0-9]+>') THEN 'seed2' WHEN regexp_matches(token, '^<cosmos_[0-9]+>') THEN 'cosmos' WHEN regexp_matches(token, '^<avclm_[0-9]+>') THEN 'avc_lm' WHEN regexp_matches(token, '^<snac_[0-9]+>') THEN 'snac' WHEN regexp_matches(token, '^<(fps|joint|x|y|z|t)_') THEN 'agent' WHEN regexp_matches(token, '^</?[a-z_0-9]+>$') THEN 'marker' ELSE 'text' END AS family FROM t)
SELECT family, count(*) AS n, count(DISTINCT user_id) AS users, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM c GROUP BY family""")
def q03_family_counts(t: Tables) -> DataFrame:
    """Tokens by family with the share of the total."""
    token = F.concat(F.expr("CASE event_type WHEN 'view' THEN '<seed2_' WHEN 'click' THEN '<cosmos_' WHEN 'purchase' THEN '<avclm_' WHEN 'error' THEN '<x_' ELSE 'word' END"), k_of(), F.when(F.col("event_type") == "signup", "").otherwise(">"))
    c = t.events.select("user_id", tokens.classify_token(token).alias("family"))
    out = c.groupBy("family").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))
    return out.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


@query(f"""{FR}, c AS (SELECT user_id, f // 8 AS idx, epoch_us(min(ts)) / 1e6 AS s, epoch_us(max(ts)) / 1e6 AS e FROM fr GROUP BY ALL),
p AS (SELECT event_id, user_id, epoch_us(ts) / 1e6 + 3600.0 AS tm FROM events)
SELECT event_id, arg_min(c.idx, (CASE WHEN s <= tm AND tm < e THEN 0 ELSE 1 END, CASE WHEN s <= tm AND tm < e THEN 0.0 ELSE abs(s - tm) END, c.idx)) AS chunk FROM p JOIN c USING (user_id) GROUP BY event_id""")
def q06_snap_to_chunk(t: Tables) -> DataFrame:
    """The chunk that holds the time an hour after each event, else the nearest."""
    f = fr(t).withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    c = f.groupBy("user_id", F.floor(F.col("f") / 8).alias("idx")).agg(F.min("at").alias("start"), F.max("at").alias("end"))
    return intervals.snap_rows(f.select("user_id", "event_id", "at"), F.col("at") + 3600.0, c, "user_id").select("event_id", "chunk")


_MINUTE = "CAST(floor((epoch_us(ts) / 1e6 - 1704067200.0) / 60) AS BIGINT)"


def _grid_sql(offsets: list[int]) -> str:
    tries = ", ".join(f"({i}, {o})" for i, o in enumerate(offsets))
    return f"""WITH p AS (SELECT event_id, user_id, {_MINUTE} AS minute, CAST(round_even({_MINUTE} / 8.0, 0) * 8 AS BIGINT) AS base FROM events),
b AS (SELECT user_id, CAST(round_even({_MINUTE} / 8.0, 0) * 8 AS BIGINT) AS w, max(event_id) AS last_id FROM events WHERE event_type = 'click' GROUP BY ALL)
SELECT p.event_id, p.base, arg_min(b.last_id, c.pref) AS hit FROM p CROSS JOIN (VALUES {tries}) c(pref, o) LEFT JOIN b ON b.user_id = p.user_id AND b.w = p.base + c.o GROUP BY p.event_id, p.base"""


def _grid(t: Tables, offsets: list[int]) -> DataFrame:
    minute = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 - 1704067200.0) / 60)
    p = t.events.select("event_id", "user_id", "event_type", asof.nearest_grid(minute, 8).alias("base"))
    b = p.filter("event_type = 'click'").groupBy("user_id", F.col("base").alias("w")).agg(F.max("event_id").alias("hit"))
    found = asof.preferred_lookup(p.drop("event_type"), b, ["user_id"], F.col("base"), offsets, "w", "hit", ["event_id"])
    return found.select("event_id", "base", "hit")


@query(_grid_sql([0, -8, 8]))
def q07_grid_asof(t: Tables) -> DataFrame:
    """The last click on the nearest multiple of 8 minutes, else one step before, else after."""
    return _grid(t, [0, -8, 8])


@query(_grid_sql([0, -16, 16, -32, 32]))
def q08_grid_asof_wide(t: Tables) -> DataFrame:
    """The same with five candidates."""
    return _grid(t, [0, -16, 16, -32, 32])


@query(f"""{FR}, n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id),
m AS (SELECT user_id, i, CASE WHEN i = 29 THEN n - 1 ELSE CAST(round_even(i * ((n - 1) / 29.0::DOUBLE), 0) AS BIGINT) END AS native FROM n, range(30) r(i))
SELECT m.user_id, i, native, fr.event_id FROM m JOIN fr ON fr.user_id = m.user_id AND fr.f = m.native""")
def q10_index_map(t: Tables) -> DataFrame:
    """Each user's events on a grid of 30 slots by the native index of each slot."""
    n = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    m = n.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(29)).cast("array<bigint>")))
    m = m.select("user_id", "i", asof.index_map(F.col("i"), F.col("n"), F.lit(30)).alias("native"))
    return m.join(fr(t).select("user_id", F.col("f").alias("native"), "event_id"), ["user_id", "native"]).select("user_id", "i", "native", "event_id")


@query(f"""{FR} SELECT user_id, f // 8 * 8 AS window_id, round(sum(value), 6) AS total, arg_min(value, f) AS first_value FROM fr GROUP BY ALL HAVING count(*) = 8""")
def q14_tumbling_windows(t: Tables) -> DataFrame:
    """Complete windows of eight frames."""
    w = windows.tumbling(fr(t), "user_id", 8, "value")
    return w.select("user_id", F.col("window_id").cast("bigint").alias("window_id"), F.round(F.aggregate("states", F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.get("states", F.lit(0)).alias("first_value"))


@query(f"""{FR}, w AS (SELECT user_id, f AS window_id, count(*) OVER s AS n, max(value) OVER s AS top, min(value) OVER s AS low FROM fr WINDOW s AS (PARTITION BY user_id ORDER BY f ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING))
SELECT user_id, window_id, top, low FROM w WHERE n = 8""")
def q15_sliding_windows(t: Tables) -> DataFrame:
    """Complete windows of eight frames starting at every frame."""
    return windows.sliding(fr(t), "user_id", 8, "value").select("user_id", "window_id", F.array_max("states").alias("top"), F.array_min("states").alias("low"))


@query(f"""{FR}, d AS (SELECT user_id, f, value, value - lag(value) OVER w AS v1 FROM fr WINDOW w AS (PARTITION BY user_id ORDER BY f)),
a AS (SELECT *, v1 - lag(v1) OVER (PARTITION BY user_id ORDER BY f) AS v2, quantile_cont(value, 0.5) OVER (PARTITION BY user_id) AS span FROM d)
SELECT user_id, f, coalesce(abs(v1) / span > 2.0, false) AS jump, coalesce(abs(v2) / span > 3.0, false) AS jerk FROM a""")
def q16_jumps(t: Tables) -> DataFrame:
    """Frames whose first or second difference is large against the track's median."""
    d = fr(t).withColumn("v1", F.col("value") - F.lag("value").over(by_track())).withColumn("v2", F.col("v1") - F.lag("v1").over(by_track()))
    span = corpus.grouped_percentile(t.events, "user_id", "value", 0.5).withColumnRenamed("percentile", "span")
    d = d.join(span, "user_id")
    big = lambda v, x: F.coalesce(F.abs(F.col(v)) / F.col("span") > x, F.lit(False))
    return d.select("user_id", "f", big("v1", 2.0).alias("jump"), big("v2", 3.0).alias("jerk"))


@query(f"""{FR}, h AS (SELECT user_id, f, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS x FROM fr), n AS (SELECT user_id, max(f) AS last FROM h GROUP BY user_id),
j AS (SELECT h.user_id, h.f, h.x, g.x AS y FROM h JOIN n USING (user_id) CROSS JOIN range(-2, 3) r(o) JOIN h g ON g.user_id = h.user_id AND g.f = least(greatest(h.f + o, 0), n.last))
SELECT user_id, f, CASE WHEN any_value(x) IS NOT NULL THEN round(avg(y), 6) END AS smooth FROM j GROUP BY user_id, f""")
def q17_centred_mean(t: Tables) -> DataFrame:
    """Five-frame mean with repeated ends over frames that are not errors."""
    d = fr(t).withColumn("x", F.expr("CASE WHEN event_type <> 'error' THEN value END"))
    return d.select("user_id", "f", F.round(windows.centred_mean(d, "user_id", "x"), 6).alias("smooth"))


@query(f"""{FR}, h AS (SELECT user_id, f, CASE WHEN event_type IN ('view', 'click', 'error') THEN value END AS x FROM fr),
g AS (SELECT *, last_value(CASE WHEN x IS NOT NULL THEN f END IGNORE NULLS) OVER p AS pf, last_value(x IGNORE NULLS) OVER p AS pv,
 first_value(CASE WHEN x IS NOT NULL THEN f END IGNORE NULLS) OVER n AS nf, first_value(x IGNORE NULLS) OVER n AS nv, max(f) OVER (PARTITION BY user_id) AS last FROM h
 WINDOW p AS (PARTITION BY user_id ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY user_id ORDER BY f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT user_id, f, round(CASE WHEN x IS NOT NULL THEN x WHEN coalesce(nf, last + 1) - coalesce(pf, -1) - 1 <= 2 THEN CASE WHEN pf IS NULL THEN nv WHEN nf IS NULL THEN pv ELSE pv + (nv - pv) * ((f - pf)::DOUBLE / (nf - pf)) END END, 6) AS filled, coalesce(pv, nv) AS held FROM g""")
def q18_gap_fill(t: Tables) -> DataFrame:
    """Null runs of at most two frames interpolated, and the forward-then-backward fill."""
    d = fr(t).withColumn("x", F.expr("CASE WHEN event_type IN ('view', 'click', 'error') THEN value END"))
    d = windows.fill_gaps(d, "user_id", "x", 2)
    return d.select("user_id", "f", F.round("filled", 6).alias("filled"), windows.forward_back_fill(["user_id"], "x").alias("held"))


@query(f"""{FR}, c AS (SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY f) = event_type THEN 0 ELSE 1 END AS c FROM fr),
r AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY f) AS run FROM c)
SELECT user_id, CAST(run AS BIGINT) AS run, event_type, min(f) AS start, count(*) AS length FROM r GROUP BY user_id, run, event_type""")
def q19_runs(t: Tables) -> DataFrame:
    """Contiguous runs of one event type."""
    return windows.runs(fr(t), "user_id", "event_type")


@query(f"""{FR}, h AS (SELECT user_id, f, epoch_us(ts) / 1e6 AS t, event_type = 'error' AS flag FROM fr),
x AS (SELECT *, lag(flag) OVER (PARTITION BY user_id ORDER BY f) <> flag AS flip FROM h)
SELECT user_id, count(*) FILTER (flip) AS flips, count(*) AS n FROM x GROUP BY user_id""")
def q20_flips(t: Tables) -> DataFrame:
    """Flips of the error flag per track; their debounced choice is ``q20b_anchors``."""
    d = fr(t).withColumn("flag", F.col("event_type") == "error")
    d = d.withColumn("flip", F.lag("flag").over(by_track()) != F.col("flag"))
    return d.groupBy("user_id").agg(F.count_if("flip").alias("flips"), F.count("*").alias("n"))


@query(f"""{FR}, h AS (SELECT user_id, f, epoch_us(ts) / 1e6 AS t, event_type = 'error' AS flag FROM fr), x AS (SELECT *, coalesce(lag(flag) OVER (PARTITION BY user_id ORDER BY f) <> flag, false) AS flip FROM h),
a AS (SELECT user_id, list([t] ORDER BY f) FILTER (flip) AS flips, list(t ORDER BY f) AS ts, count(*) AS n FROM x GROUP BY user_id),
k AS (SELECT *, CASE WHEN flips IS NULL THEN []::DOUBLE[] ELSE list_reduce(flips, lambda acc, y: CASE WHEN y[1] - acc[len(acc)] >= 86400.0 THEN list_append(acc, y[1]) ELSE acc END) END AS kept FROM a),
r AS (SELECT user_id, list_reduce([kept, [ts[1]], [ts[n // 4 + 1]], [ts[2 * n // 4 + 1]], [ts[3 * n // 4 + 1]]], lambda acc, y: CASE WHEN len(acc) < 4 AND len(list_filter(acc, lambda z: abs(z - y[1]) < 86400.0)) = 0 THEN list_append(acc, y[1]) ELSE acc END) AS c FROM k)
SELECT user_id, array_to_string(list_transform(list_sort(c), lambda z: CAST(floor(z) AS BIGINT)), ',') AS anchors FROM r""")
def q20b_anchors(t: Tables) -> DataFrame:
    """Debounced anchor times per track: flips a day apart or more, filled up to four."""
    d = fr(t).select("user_id", "f", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"), (F.col("event_type") == "error").alias("flag"))
    flags = d.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("f", "t", "flag"))).alias("flags"))
    anchors = windows.debounced_flips(F.col("flags"), 86400.0)
    return flags.select("user_id", F.array_join(F.transform(anchors, lambda x: F.floor(x)), ",").alias("anchors"))


@query(f"""{FR}, w AS (SELECT user_id, f // 8 * 8 AS window_id FROM fr GROUP BY ALL HAVING count(*) = 8)
SELECT w.user_id, w.window_id, count(*) FILTER (fr.event_type = 'error') AS absent FROM w JOIN fr ON fr.user_id = w.user_id AND fr.f BETWEEN w.window_id AND w.window_id + 7 GROUP BY ALL HAVING count(*) FILTER (fr.event_type = 'error') <= 3""")
def q21_presence_filter(t: Tables) -> DataFrame:
    """Windows with fewer than four error frames."""
    f = fr(t)
    w = windows.tumbling(f, "user_id", 8, "value").select("user_id", F.col("window_id").cast("bigint").alias("window_id"))
    return windows.presence_filter(w, f.withColumn("present", F.col("event_type") != "error"), "user_id", 8)


@query(f"""{FR}, n AS (SELECT user_id, count(*) AS n, greatest(2, CAST(round_even(count(*) / 24.0 * 30, 0) AS BIGINT)) AS m FROM fr GROUP BY user_id),
g AS (SELECT user_id, m, unnest(range(m)) AS i, n FROM n), p AS (SELECT user_id, i, CASE WHEN i = m - 1 THEN (n - 1)::DOUBLE ELSE i * ((n - 1)::DOUBLE / (m - 1)) END AS x, n FROM g)
SELECT p.user_id, p.i, round(a.value + (b.value - a.value) * (x - floor(x)) + 1e-7, 4) AS value FROM p JOIN fr a ON a.user_id = p.user_id AND a.f = floor(x) JOIN fr b ON b.user_id = p.user_id AND b.f = least(floor(x) + 1, n - 1)""")
def q26_resample(t: Tables) -> DataFrame:
    """Each track from 24 to 30 frames a second, linear in normalised time."""
    n = t.events.groupBy("user_id").agg(F.count("*").alias("n")).withColumn("m", F.greatest(F.lit(2), F.rint(F.col("n") / 24.0 * 30).cast("bigint")))
    g = n.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    x = F.when(F.col("i") == F.col("m") - 1, (F.col("n") - 1).cast("double")).otherwise(F.col("i") * ((F.col("n") - 1) / (F.col("m") - 1)))
    g = g.withColumn("x", x).withColumn("lo", F.floor("x")).withColumn("hi", F.least(F.col("lo") + 1, F.col("n") - 1))
    f = fr(t)
    g = g.join(f.select("user_id", F.col("f").alias("lo"), F.col("value").alias("a")), ["user_id", "lo"]).join(f.select("user_id", F.col("f").alias("hi"), F.col("value").alias("b")), ["user_id", "hi"])
    return g.select("user_id", "i", F.round(F.col("a") + (F.col("b") - F.col("a")) * (F.col("x") - F.col("lo")) + 1e-7, 4).alias("value"))


@query(f"""{FR}, s AS (SELECT user_id, min(value) AS lo, max(value) AS hi FROM fr GROUP BY user_id)
SELECT fr.user_id, f, round(f / 30.0::DOUBLE, 6) AS t_seconds, CAST(least(greatest(round_even((value - lo) / (hi - lo) * 639, 0), 0), 639) AS BIGINT) AS px FROM fr JOIN s USING (user_id)""")
def q28_projection(t: Tables) -> DataFrame:
    """Frame time in seconds, and the value projected to pixels with the track's own scale."""
    w = Window.partitionBy("user_id")
    lo, hi = F.min("value").over(w), F.max("value").over(w)
    px = F.least(F.greatest(F.rint((F.col("value") - lo) / (hi - lo) * 639), F.lit(0.0)), F.lit(639.0)).cast("bigint")
    return fr(t).select("user_id", "f", F.round(F.col("f") / 30.0, 6).alias("t_seconds"), px.alias("px"))


@query(f"""{FR}, s AS (SELECT user_id, string_agg('<seed_' || {K_SQL} || '>', ' ' ORDER BY f) AS x FROM fr WHERE event_type = 'view' GROUP BY user_id)
SELECT user_id, regexp_replace(x, '<seed_([0-9]+)>', '<seed2_\\1>', 'g') AS text, CAST(len(regexp_extract_all(x, '<seed_[0-9]+>')) AS BIGINT) AS renamed FROM s""")
def q29_rename(t: Tables) -> DataFrame:
    """A token family renamed, with the number of tokens changed."""
    s = fr(t).filter("event_type = 'view'").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("f", F.concat(F.lit("<seed_"), k_of(), F.lit(">")).alias("x")))).alias("s"))
    x = F.array_join(F.transform("s", lambda r: r.x), " ")
    return s.select("user_id", tokens.rename_family(x, "seed", "seed2").alias("text"), tokens.family_count(x, "seed").alias("renamed"))


@query(f"""{FR}, b AS (SELECT user_id, f // 8 AS chunk, {K_SQL} AS k, CAST(floor(value * 3) AS BIGINT) AS v, event_type FROM fr)
SELECT user_id, chunk, count(*) AS n, count(*) FILTER (k > 90) AS bad_t, count(*) FILTER (v > 255) AS bad_coord, count(*) FILTER (event_type = 'click') <> count(*) FILTER (event_type = 'view') AS unbalanced FROM b GROUP BY ALL""")
def q30_validate(t: Tables) -> DataFrame:
    """Bounds and balance of the tokens of each chunk."""
    b = fr(t).select("user_id", F.floor(F.col("f") / 8).alias("chunk"), k_of().alias("k"), F.floor(F.col("value") * 3).alias("v"), "event_type")
    of = lambda e: F.count_if(F.col("event_type") == e)
    return b.groupBy("user_id", "chunk").agg(F.count("*").alias("n"), F.count_if(F.col("k") > 90).alias("bad_t"), F.count_if(F.col("v") > 255).alias("bad_coord"), (of("click") != of("view")).alias("unbalanced"))


@query(f"""{FR}, g AS (SELECT user_id, f // 3 AS frame, list({K_SQL} * 41 ORDER BY f) AS l FROM fr GROUP BY ALL HAVING count(*) = 3)
SELECT user_id, frame, l[1] + 128266 AS l0, l[2] + 132362 AS l1a, l[3] + 144650 AS l1b, (l[1] < 4096)::INT + (l[2] < 4096)::INT + (l[3] < 4096)::INT AS valid FROM g""")
def q31_codec(t: Tables) -> DataFrame:
    """Three codes packed into their bands and unpacked again; ``valid`` counts those inside the band."""
    g = fr(t).groupBy("user_id", F.floor(F.col("f") / 3).alias("frame")).agg(F.array_sort(F.collect_list(F.struct("f", (k_of() * 41).alias("v")))).alias("s")).filter(F.size("s") == 3)
    one = lambda k: F.array(F.get("s", F.lit(k)).v)
    g = g.withColumn("ids", tokens.pack_listen(one(0), one(1), one(2)))
    back = tokens.unpack_codec(F.col("ids"), tokens.LISTEN_BANDS)
    return g.select("user_id", "frame", *[F.get("ids", F.lit(k)).alias(n) for k, n in enumerate(("l0", "l1a", "l1b"))], F.size(F.filter(back, lambda x: x.valid)).alias("valid"))


@query(f"""SELECT event_id, round(CASE WHEN event_type = 'error' THEN 0.0 ELSE floor(value / 60) * 60 + {K_SQL} % 60 + 0.5 END, 6) AS seconds, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value) AS BIGINT) % 60 * 60 + {K_SQL} % 60 END AS short_seconds FROM events""")
def q32_clock(t: Tables) -> DataFrame:
    """Clock strings made from the events and read back."""
    d = t.events.withColumns({"m": F.floor(F.col("value") / 60), "s": k_of() % 60})
    long = F.when(F.col("event_type") == "error", "bad:time").otherwise(F.format_string("%02d:%02d:%02d.500", F.floor(F.col("m") / 60), F.col("m") % 60, F.col("s")))
    short = F.when(F.col("event_type") == "view", "none").otherwise(F.format_string("%02d:%02d", F.floor("value") % 60, F.col("s")))
    return d.select("event_id", F.round(text.clock_seconds(long), 6).alias("seconds"), text.short_clock_seconds(short).alias("short_seconds"))


@query(f"""SELECT event_type, {K_SQL} % 10 AS bucket, count(*) AS n, sum({K_SQL})::BIGINT AS total, max(len(json_keys(props)))::BIGINT AS n_keys FROM events GROUP BY ALL""")
def q39_json(t: Tables) -> DataFrame:
    """Numbers inside a JSON column."""
    d = t.events.select("event_type", k_of().alias("k"), F.size(F.json_object_keys("props")).cast("bigint").alias("keys"))
    return d.groupBy("event_type", (F.col("k") % 10).alias("bucket")).agg(F.count("*").alias("n"), F.sum("k").alias("total"), F.max("keys").alias("n_keys"))


@query(f"""{FR}, k AS (SELECT user_id, date_trunc('day', ts) AS d, event_type, f, {K_SQL} AS k FROM fr)
SELECT user_id, CAST(d AS DATE) AS day, arg_min(event_type, f) AS first_type, count(*) - 1 AS collisions, string_agg(event_type, ' ' ORDER BY f) AS all_types, count(*) - count(DISTINCT event_type) AS repeats FROM k GROUP BY ALL""")
def q44_dictionaries(t: Tables) -> DataFrame:
    """First-wins and concat-wins dictionaries per user and day."""
    d = fr(t).withColumn("day", F.to_date("ts"))
    keys = ["user_id", "day"]
    first = corpus.first_wins(d, keys, "event_type", "f").withColumnRenamed("event_type", "first_type")
    every = corpus.concat_wins(d, keys, "event_type", "f").withColumnRenamed("event_type", "all_types")
    repeats = d.groupBy(*keys).agg((F.count("*") - F.countDistinct("event_type")).alias("repeats"))
    return first.join(every, keys).join(repeats, keys)


@query("""SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days, count(DISTINCT (user_id, CAST(ts AS DATE))) AS user_days FROM events GROUP BY event_type""")
def q49_distinct(t: Tables) -> DataFrame:
    """Exact distinct counts."""
    d = t.events.withColumn("day", F.to_date("ts"))
    return d.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.countDistinct("day").alias("days"), F.countDistinct("user_id", "day").alias("user_days"))


@query(f"""WITH s AS (SELECT event_type, count(*) AS n, sum({K_SQL}) AS k, date_diff('second', min(ts), max(ts)) AS secs FROM events WHERE event_id % 4 = 0 GROUP BY event_type), a AS (SELECT count(*) AS total, count(*) FILTER (event_id % 4 = 0) AS part FROM events)
SELECT event_type, round(n * (total::DOUBLE / part), 4) AS estimated, round(k * (total::DOUBLE / part), 4) AS estimated_k FROM s, a""")
def q51_extrapolate(t: Tables) -> DataFrame:
    """Counters of a quarter of the rows scaled up by the share read."""
    e = t.events.select("event_type", k_of().alias("k"), (F.col("event_id") % 4 == 0).alias("part"))
    c = e.groupBy("event_type").agg(F.count("*").alias("total"), F.count_if("part").alias("n"), F.sum(F.when(F.col("part"), F.col("k"))).alias("k"))
    w = Window.partitionBy()
    scale = F.sum("total").over(w) / F.sum("n").over(w)
    return c.select("event_type", F.round(F.col("n") * scale, 4).alias("estimated"), F.round(F.col("k") * scale, 4).alias("estimated_k"))


@query("""SELECT CASE event_type WHEN 'view' THEN 'look' WHEN 'click' THEN 'look' ELSE event_type END AS kind, count(*) AS n, round(sum(value), 4) AS total, count(*) FILTER (value > 50) AS kept, round(100.0 * count(*) FILTER (value <= 50) / count(*), 4) AS cut_pct FROM events GROUP BY kind""")
def q56_counters(t: Tables) -> DataFrame:
    """Counters with synonyms merged, and keep/cut shares."""
    kind = F.when(F.col("event_type").isin("view", "click"), "look").otherwise(F.col("event_type"))
    keep = F.col("value") > 50
    return t.events.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.count_if(keep).alias("kept"), F.round(100.0 * F.count_if(~keep) / F.count("*"), 4).alias("cut_pct"))


@query(f"""{FR}, n AS (SELECT user_id, max(f) AS last, max_by(event_id, f) AS tail FROM fr GROUP BY user_id),
g AS (SELECT n.user_id, c.i AS chunk, p.j, least(c.i * 8 + p.j, n.last) AS f, n.last FROM n, LATERAL (SELECT unnest(range(0, n.last // 8 + 1)) AS i) c, range(8) p(j))
SELECT g.user_id, g.chunk, sum(fr.event_id)::BIGINT AS id_sum, count(*) FILTER (g.chunk * 8 + g.j > g.last) AS padded FROM g JOIN fr ON fr.user_id = g.user_id AND fr.f = g.f GROUP BY ALL""")
def q58_padded_chunks(t: Tables) -> DataFrame:
    """The chunk grid of each track with the last chunk padded."""
    d = fr(t).groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("f", "event_id"))), lambda x: x.event_id).alias("ids"))
    c = d.select("user_id", F.size("ids").alias("n"), F.posexplode(windows.padded_chunks(F.col("ids"), 8)).alias("chunk", "ids"))
    return c.select("user_id", F.col("chunk").cast("bigint").alias("chunk"), F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"), F.greatest(F.lit(0), (F.col("chunk") + 1) * 8 - F.col("n")).cast("bigint").alias("padded"))


@query(f"""{FR}, b AS (SELECT user_id, f // 8 AS chunk, f, {KIND_SQL} AS kind, {K_SQL} AS k FROM fr)
SELECT user_id, chunk, bool_or(kind = 'seed2') AS has_seed2, bool_or(kind = 'cosmos') AS has_cosmos, bool_or(kind = 'agent') AS has_agent, count(DISTINCT kind) AS kinds, arg_min(k, f) FILTER (kind = 'cosmos') AS first_cosmos FROM b GROUP BY ALL""")
def q59_chunk_flags(t: Tables) -> DataFrame:
    """Which kinds each chunk has and the first id of its first cosmos block, read from parsed streams."""
    block = F.concat(F.lit("<"), kind_of(), F.lit("> "), k_of(), F.lit(" "), F.floor("value"), F.lit(" </"), kind_of(), F.lit(">"))
    s = fr(t).groupBy("user_id", F.floor(F.col("f") / 8).alias("chunk")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", block.alias("b")))), lambda x: x.b), " ").alias("stream"))
    s = s.withColumn("blocks", tokens.parse_blocks(F.col("stream")))
    has = lambda k: F.exists("blocks", lambda b: b.kind == k)
    first = F.get(F.filter("blocks", lambda b: b.kind == "cosmos"), F.lit(0)).payload
    first_id = F.get(tokens.family_ids(F.array_join(tokens.atomic_tokens(first, "cosmos"), " "), "cosmos"), F.lit(0))
    return s.select("user_id", "chunk", has("seed2").alias("has_seed2"), has("cosmos").alias("has_cosmos"), has("agent").alias("has_agent"), F.size(F.array_distinct(F.transform("blocks", lambda b: b.kind))).cast("bigint").alias("kinds"), first_id.alias("first_cosmos"))


@query(f"""{FR}, t AS (SELECT user_id, f, epoch_us(ts) / 1e6 AS s, value FROM fr), n AS (SELECT user_id, min(s) AS s0, max(s) AS s1 FROM t GROUP BY user_id),
g AS (SELECT user_id, s0, i, s0 + i * 21600.0 AS at FROM n, LATERAL (SELECT unnest(range(0, CAST(floor((s1 - s0) / 21600.0) AS BIGINT) + 1)) AS i) x)
SELECT g.user_id, g.i, round(CASE WHEN b.s IS NULL OR b.s = a.s THEN a.value ELSE a.value + (b.value - a.value) * ((g.at - a.s) / (b.s - a.s)) END, 4) AS value FROM g ASOF JOIN t a ON a.user_id = g.user_id AND a.s <= g.at ASOF LEFT JOIN t b ON b.user_id = g.user_id AND b.s >= g.at""")
def q60_resample_time(t: Tables) -> DataFrame:
    """Each track every six hours of real time, linear between the neighbours."""
    d = t.events.select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("s"), "value")
    n = d.groupBy("user_id").agg(F.min("s").alias("s0"), F.max("s").alias("s1"))
    g = n.withColumn("i", F.explode(F.sequence(F.lit(0), F.floor((F.col("s1") - F.col("s0")) / 21600.0))))
    g = g.select("user_id", "i", (F.col("s0") + F.col("i") * 21600.0).alias("s"))
    both = d.withColumn("i", F.lit(None).cast("bigint")).unionByName(g.withColumn("value", F.lit(None).cast("double")))
    w = Window.partitionBy("user_id").orderBy("s", F.col("i").asc_nulls_first())
    back = Window.partitionBy("user_id").orderBy("s", F.col("i").asc_nulls_last())
    seen = F.when(F.col("i").isNull(), F.struct("s", "value"))
    a = F.last(seen, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    b = F.first(seen, ignorenulls=True).over(back.rowsBetween(0, Window.unboundedFollowing))
    p = both.withColumns({"a": a, "b": b}).filter("i is not null")
    line = F.col("a.value") + (F.col("b.value") - F.col("a.value")) * ((F.col("s") - F.col("a.s")) / (F.col("b.s") - F.col("a.s")))
    exact = F.col("b").isNull() | (F.col("a.s") == F.col("s")) | (F.col("b.s") == F.col("a.s"))
    return p.select("user_id", "i", F.round(F.when(exact, F.col("a.value")).otherwise(line), 4).alias("value"))


@query(f"""{FR} SELECT user_id, count(*) AS found, CAST(ceil(count(*) / 8.0) AS BIGINT) AS expected_chunks, round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS null_share, min(value) AS low, max(value) AS high, max(value) > 200 AS out_of_range FROM fr GROUP BY user_id""")
def q62_quality_summary(t: Tables) -> DataFrame:
    """Share of missing frames, range and flags per track."""
    v = F.col("value")
    return t.events.groupBy("user_id").agg(F.count("*").alias("found"), F.ceil(F.count("*") / 8.0).alias("expected_chunks"), F.round(F.avg((F.col("event_type") == "error").cast("double")), 6).alias("null_share"), F.min(v).alias("low"), F.max(v).alias("high"), (F.max(v) > 200).alias("out_of_range"))


@query(f"""{FR}, c AS (SELECT user_id, f, event_type, CAST(least(greatest(floor(f * 0.4::DOUBLE * 30.0::DOUBLE / 8), 0), 9) AS BIGINT) AS chunk FROM fr)
SELECT user_id, chunk, string_agg(event_type, ' ' ORDER BY f) AS speech, count(*) - 1 AS joined FROM c GROUP BY ALL""")
def q63_anchor_chunks(t: Tables) -> DataFrame:
    """Segments put on the chunk of their start, late ones on the last chunk, texts joined where they meet."""
    d = fr(t).withColumn("chunk", asof.anchor_chunk(F.col("f") * F.lit(0.4), 30.0, 8, F.lit(10)))
    joined = corpus.concat_wins(d, ["user_id", "chunk"], "event_type", "f").withColumnRenamed("event_type", "speech")
    return joined.join(d.groupBy("user_id", "chunk").agg((F.count("*") - 1).alias("joined")), ["user_id", "chunk"])


@query(f"""{FR}, s AS (SELECT *, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM fr),
c AS (SELECT user_id, CAST(seg AS BIGINT) AS chunk_idx, CAST(seg AS BIGINT) * 8 AS abs_frame, bool_or(event_type = 'view') AS has_seed2 FROM s GROUP BY user_id, seg HAVING bool_or(event_type = 'purchase')),
a AS (SELECT DISTINCT user_id, f // 8 * 8 AS w FROM fr WHERE event_type = 'error')
SELECT c.user_id, chunk_idx, abs_frame, round(abs_frame / 30.0::DOUBLE, 4) AS start_sec, round((abs_frame + 8) / 30.0::DOUBLE, 4) AS end_sec, has_seed2, true AS has_avc_lm, EXISTS (SELECT 1 FROM a WHERE a.user_id = c.user_id AND a.w IN (abs_frame, abs_frame - 8, abs_frame + 8)) AS has_agent FROM c""")
def q64_chunk_timing(t: Tables) -> DataFrame:
    """Chunk times and presence flags of every user's stream."""
    blocks = flatten.explode_blocks(streams(t), "user_id", "stream")
    agent = fr(t).filter("event_type = 'error'").select("user_id", (F.floor(F.col("f") / 8) * 8).alias("window_id"))
    return stream_ops.chunk_timing(blocks, agent, "user_id", F.lit(0))


@query(f"""{FR} SELECT user_id, f // 30 * 4 + f % 30 // 8 AS chunk, count(*) AS frames, min(f) AS first_frame FROM fr GROUP BY ALL""")
def q65_second_chunks(t: Tables) -> DataFrame:
    """Chunks of eight frames that also end at each full second."""
    c = stream_ops.second_chunks(F.col("f")).cast("bigint")
    return fr(t).groupBy("user_id", c.alias("chunk")).agg(F.count("*").alias("frames"), F.min("f").alias("first_frame"))


@query(f"""{FR}, w AS (SELECT user_id, f // 8 * 8 AS window_id, arg_min(value, f) AS a, arg_max(value, f) AS b FROM fr GROUP BY ALL HAVING count(*) = 8)
SELECT user_id, window_id, round(abs(a - lag(b) OVER (PARTITION BY user_id ORDER BY window_id)), 6) AS shift, abs(a - b) < 0.05 AS frozen FROM w""")
def q66_window_shift(t: Tables) -> DataFrame:
    """Jump between neighbouring windows, and windows that end where they began."""
    w = windows.tumbling(fr(t), "user_id", 8, "value").withColumn("states", F.transform("states", lambda x: F.array(x)))
    s = stream_ops.window_shift(w, "user_id", 0.05)
    return s.select("user_id", F.col("window_id").cast("bigint").alias("window_id"), F.round("shift", 6).alias("shift"), "frozen")


@query(f"""{FR} SELECT user_id, arg_max(event_type, f) AS last_type FROM fr GROUP BY user_id""")
def q67_last_wins(t: Tables) -> DataFrame:
    """A manifest where the last writer wins."""
    return stream_ops.last_wins(fr(t), "user_id", "event_type", "f").withColumnRenamed("event_type", "last_type")
