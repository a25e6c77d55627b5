"""Queries over nested records, required fields, parallel arrays and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, tokens
from ..operators import asof, corpus, flatten, intervals, records, windows
from ..operators import streams as stream_ops
from .registry import Tables, query
from .tracks import FR, K_SQL, KIND_SQL, fr, k_of, kind_of, streams

_DAY = "(epoch_us({}) / 86400e6)"


def _day(c: str) -> F.Column:
    return F.unix_micros(F.col(c).cast("timestamp")) / 86400e6


@query(f"""WITH l AS (SELECT o_custkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) AS n, {_DAY.format("l_shipdate")} AS s, {_DAY.format("l_shipdate")} + l_quantity - 10 AS e FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT o_custkey AS video_id, l_orderkey AS scene_id, 'scene_' || l_orderkey || '_act_' || n AS activity_id, round(s, 6) AS start, round(e, 6) AS "end" FROM l WHERE e > s AND l_linenumber <> 3""")
def q70_activities(t: Tables) -> DataFrame:
    """Activities of nested records: orders as scenes of a customer, lines as activities; some have half a time range or none."""
    span = F.when(F.col("l_linenumber") == 3, F.array(_day("l_shipdate"))).otherwise(F.array(_day("l_shipdate"), _day("l_shipdate") + F.col("l_quantity") - 10))
    line = t.lineitem.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_extendedprice", span.alias("time_range")).alias("a"))
    scenes = line.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("a")).alias("activities")).join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    videos = scenes.groupBy(F.col("o_custkey").alias("video_id")).agg(F.collect_list(F.struct(F.col("l_orderkey").alias("scene_id"), "activities")).alias("scenes"))
    a = records.explode_activities(videos)
    return a.select("video_id", "scene_id", "activity_id", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang || '_' || doc_id ELSE replace(lower(source || ' Part ' || doc_id), ' ', '_') END AS video_id FROM documents""")
def q71_video_ids(t: Tables) -> DataFrame:
    """Ids from file names, or from titles where the name is empty or null."""
    i = F.col("doc_id") % 3
    name = F.when(i == 0, F.concat("lang", F.lit("_"), "doc_id", F.lit(".mp4"))).when(i == 1, "")
    return t.documents.select("doc_id", records.video_id(name, F.concat("source", F.lit(" Part "), "doc_id")).alias("video_id"))


@query(f"""{FR}, b AS (SELECT user_id, f // 8 AS chunk, {KIND_SQL} AS kind FROM fr) SELECT user_id, chunk, count(*) AS blocks FROM b GROUP BY ALL HAVING bool_or(kind = 'agent')""")
def q72_streams_with_agent(t: Tables) -> DataFrame:
    """Chunk streams that open an agent or audio block."""
    block = F.concat(F.lit("<"), kind_of(), F.lit("> "), k_of(), F.lit(" </"), kind_of(), F.lit(">"))
    s = fr(t).groupBy("user_id", F.floor(F.col("f") / 8).alias("chunk")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", block.alias("b")))), lambda x: x.b), " ").alias("stream"), F.count("*").alias("blocks"))
    return s.filter(records.has_any_block(F.col("stream"))).select("user_id", "chunk", "blocks")


@query(f"""{FR}, n AS (SELECT user_id, count(*) AS n FROM fr GROUP BY user_id) SELECT user_id, f - 4 AS start FROM fr JOIN n USING (user_id) WHERE f - 4 >= 0 AND f - 4 + 7 < n AND (f - 4) % 3 = 0""")
def q73_window_range(t: Tables) -> DataFrame:
    """Every third window of eight frames that lies inside its track."""
    start = F.col("f") - 4
    d = fr(t).withColumn("n", F.count("*").over(Window.partitionBy("user_id")))
    return d.filter(records.window_inside(start, 8, F.col("n")) & (F.pmod(start, F.lit(3)) == 0)).select("user_id", start.alias("start"))


@query(f"""SELECT event_type, count(*) FILTER ({K_SQL} % 7 IN (1, 2, 3, 4, 5)) AS kept, count(*) FILTER ({K_SQL} % 7 NOT IN (1, 2, 3, 4, 5)) AS dropped FROM events GROUP BY event_type""")
def q74_domain_report(t: Tables) -> DataFrame:
    """What a filter on the domain 1 to 5 keeps and drops."""
    return records.keep_report(t.events, (k_of() % 7).isin(1, 2, 3, 4, 5), ["event_type"])


@query("""SELECT lang, count(*) FILTER (coalesce(trim(text) <> '', false) AND quality IS NOT NULL AND toxic IS NOT NULL) AS kept, count(*) FILTER (NOT (coalesce(trim(text) <> '', false) AND quality IS NOT NULL AND toxic IS NOT NULL)) AS dropped FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def q75_required_fields(t: Tables) -> DataFrame:
    """Rows with text and both labels, and how many lack one."""
    return records.keep_report(t.documents.join(t.labels, "doc_id", "left"), records.filled("text", "quality", "toxic"), ["lang"])


@query("""SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND NOT regexp_matches(text, '(?i)(^|[^\\pL0-9_])(tion|there|et|und)([^\\pL0-9_]|$)')""")
def q76_listed_without(t: Tables) -> DataFrame:
    """Listed documents without certain words, in order."""
    d = records.listed_without(t.documents, t.labels.filter("quality = 1"), "doc_id", "text", r"(?i)(^|[^\pL0-9_])(tion|there|et|und)([^\pL0-9_]|$)")
    return d.select("doc_id", "lang")


@query("""WITH c AS (SELECT conv_id, list(role ORDER BY turn) AS roles, list(text ORDER BY turn) AS texts FROM conversations GROUP BY conv_id)
SELECT 'conv_' || conv_id AS record_id, unnest(range(len(roles))) AS at, unnest(roles) AS role, length(unnest(texts)) AS chars FROM c WHERE conv_id % 5 <> 0""")
def q77_parallel_records(t: Tables) -> DataFrame:
    """Records of parallel arrays by entry; rows whose arrays differ in length are left out."""
    of = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("turn", c))), lambda s: s[c])
    c = t.conversations.groupBy("conv_id").agg(of("role").alias("roles"), of("text").alias("texts"))
    c = c.withColumn("roles", F.when(F.col("conv_id") % 5 == 0, F.slice("roles", 1, F.size("roles") - 1)).otherwise(F.col("roles"))).withColumn("stem", F.lit("conv"))
    p = records.parallel_records(c, "stem", "conv_id", ["roles", "texts"])
    return p.select("record_id", F.col("at").cast("bigint").alias("at"), F.col("roles").alias("role"), F.length("texts").cast("bigint").alias("chars"))


@query("""WITH c AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (role = 'assistant' AND text <> '') AS text FROM conversations GROUP BY conv_id) SELECT conv_id, text FROM c WHERE text IS NOT NULL""")
def q77b_joined_spans(t: Tables) -> DataFrame:
    """The non-null spans of each record as paragraphs."""
    spans = F.transform(F.array_sort(F.collect_list(F.struct("turn", F.when(F.col("role") == "assistant", F.col("text")).alias("text")))), lambda s: s.text)
    return t.conversations.groupBy("conv_id").agg(records.joined_spans(spans).alias("text")).filter("text is not null")


@query(f"""{FR}, s AS (SELECT user_id, f, epoch_us(ts) / 1e6 AS a, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY f)) / 1e6 AS b FROM fr) SELECT user_id, f, round(b - a, 3) AS seconds FROM s WHERE b - a >= 3600.0""")
def q78_long_segments(t: Tables) -> DataFrame:
    """Segments between events that are long enough."""
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    d = fr(t).withColumn("a", at).withColumn("b", F.lead("a").over(Window.partitionBy("user_id").orderBy("f")))
    return d.filter(records.long_enough(F.col("a"), F.col("b"), 3600.0)).select("user_id", "f", F.round(F.col("b") - F.col("a"), 3).alias("seconds"))


@query("""SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 3""")
def q79_nth_record(t: Tables) -> DataFrame:
    """The third turn of each conversation."""
    return records.nth_record(t.conversations, "conv_id", "turn", 3).select("conv_id", "turn", "role")


@query("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, list_sort(list(DISTINCT event_type)) AS types FROM events GROUP BY ALL) SELECT user_id, day, types = ['click', 'purchase', 'view'] AS complete FROM d""")
def q80_same_keys(t: Tables) -> DataFrame:
    """Whether each day's counters have exactly three keys."""
    c = t.events.withColumn("day", F.to_date("ts")).groupBy("user_id", "day", "event_type").agg(F.count("*").alias("n"))
    m = c.groupBy("user_id", "day").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return m.select("user_id", "day", records.same_keys(F.col("m"), ("view", "click", "purchase")).alias("complete"))


@query("""SELECT user_id, CAST(count(*) FILTER (event_type = 'click') * 2 + count(*) FILTER (event_type IN ('purchase', 'error')) AS BIGINT) AS total, count(*) FILTER (event_type = 'click') * 2 AS listen, count(*) FILTER (event_type = 'purchase') AS speak, count(*) FILTER (event_type = 'error') AS orphan FROM events GROUP BY user_id""")
def q81_speech_split(t: Tables) -> DataFrame:
    """Codec tokens of each user's stream inside listen, inside speak and outside both."""
    k = k_of()
    block = F.expr("CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 ELSE 0 END")
    piece = F.when(block == 1, F.concat(F.lit("<listen> <snac_"), k, F.lit("> <snac_"), k + 1, F.lit("> </listen>"))).when(block == 2, F.concat(F.lit("<speak> <snac_"), k, F.lit("> </speak>"))).when(block == 3, F.concat(F.lit("<snac_"), k, F.lit(">"))).otherwise("<snac_x>")
    s = fr(t).groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", piece.alias("p")))), lambda x: x.p), " ").alias("text"))
    return s.select("user_id", tokens.speech_split(F.col("text")).alias("s")).select("user_id", "s.*")


@query(f"""SELECT user_id, count(*) FILTER (event_type = 'click') AS bad_json, count(*) FILTER (event_type = 'purchase') AS missing, count(*) FILTER (event_type = 'signup') AS tags, count(*) FILTER (event_type = 'error') + count(*) FILTER (event_type = 'view' AND {K_SQL} * 100 >= 8192) AS vocabulary, count(*) AS lines FROM events GROUP BY user_id""")
def q82_text_errors(t: Tables) -> DataFrame:
    """Errors of JSON lines made from the events: broken, without text, unbalanced, over the vocabulary."""
    k = k_of()
    line = (
        F.when(F.col("event_type") == "click", '{"text": "broken')
        .when(F.col("event_type") == "purchase", F.concat(F.lit('{"id": '), k, F.lit("}")))
        .when(F.col("event_type") == "signup", F.concat(F.lit('{"text": "<agent> <agent_'), k, F.lit('>"}')))
        .when(F.col("event_type") == "error", '{"text": "<cosmos> <cosmos_64000> <cosmos_63999> </cosmos>"}')
        .otherwise(F.concat(F.lit('{"text": "<seed2> <seed2_'), k * 100, F.lit('> </seed2>"}')))
    )
    e = t.events.select("user_id", records.text_errors(line).alias("e"))
    return e.groupBy("user_id").agg(F.count_if("e.bad_json").alias("bad_json"), F.count_if("e.missing").alias("missing"), F.sum("e.tags").alias("tags"), F.sum("e.vocabulary").alias("vocabulary"), F.count("*").alias("lines"))


@query("""SELECT event_id, lpad(event_id::VARCHAR, 11, '0') AS video FROM events WHERE event_type IN ('view', 'click')""")
def q83_embedded_ids(t: Tables) -> DataFrame:
    """Ids of eleven characters in JSON inside JSON."""
    name = F.when(F.col("event_type").isin("view", "click"), F.lpad(F.col("event_id").cast("string"), 11, "0")).when(F.col("event_type") == "error", "short")
    metadata = F.to_json(F.array(F.struct(F.to_json(F.struct(name.alias("id"), F.lit(1).alias("n"))).alias("params")), F.struct(F.lit("").alias("params"))))
    return t.events.select("event_id", F.explode(records.embedded_ids(metadata)).alias("video"))


@query(f"""WITH e AS (SELECT event_type, {K_SQL} % 5 AS n FROM events)
SELECT event_type, 'snac_token' AS field, sum(n)::BIGINT AS n FROM e WHERE n > 0 GROUP BY event_type UNION ALL SELECT event_type, 'avc_tokens', 2 * count(*) FROM e GROUP BY event_type""")
def q84_token_arrays(t: Tables) -> DataFrame:
    """Entries of numeric arrays in any field named as tokens; empty ones, texts and other fields don't count."""
    k = k_of()
    ids = F.when(k % 5 > 0, F.sequence(F.lit(1).cast("bigint"), k % 5)).otherwise(F.array().cast("array<bigint>"))
    record = F.to_json(F.struct(ids.alias("snac_token"), F.array(k, k + 1).alias("avc_tokens"), F.array(F.lit("x")).alias("word_tokens"), F.array(k).alias("tokens_seen"), F.lit("text").alias("text")))
    c = records.token_arrays(t.events.select("event_type", record.alias("record")), "event_type", "record")
    return c.groupBy("event_type", "field").agg(F.sum("n").alias("n"))


_SPLIT = "list_filter(string_split_regex(text, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '')"


@query(f"""WITH d AS (SELECT doc_id, {_SPLIT} AS w FROM documents), e AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS nr FROM d),
g AS (SELECT *, CASE WHEN count(*) OVER r = 3 THEN string_agg(word, ' ') OVER r END AS gram, bool_or(length(word) > 3 AND lower(word) NOT IN ('that', 'this')) OVER r AS telling FROM e WINDOW r AS (PARTITION BY doc_id ORDER BY nr ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
c AS (SELECT *, coalesce(gram IS NOT NULL AND telling AND nr >= min(nr) OVER (PARTITION BY doc_id, gram) + 3, false) AS copy FROM g),
x AS (SELECT *, bool_or(copy) OVER (PARTITION BY doc_id ORDER BY nr ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS gone FROM c)
SELECT doc_id, count(*) AS left_over, sum(length(word))::BIGINT AS chars FROM x WHERE NOT gone GROUP BY doc_id""")
def q85_repeated_ngrams(t: Tables) -> DataFrame:
    """Words left when later copies of three-word grams are dropped."""
    w = corpus.drop_repeated_ngrams(t.documents, "doc_id", "text", 3, ("that", "this"))
    return w.groupBy("doc_id").agg(F.count("*").alias("left_over"), F.sum(F.length("word")).alias("chars"))


def _spoken_sql() -> str:
    out = "text"
    for old, new in text.SPOKEN:
        old, new = old.replace("'", "''"), new.replace("'", "''")
        out = f"replace({out}, '{old}', '{new}')"
    return f"SELECT doc_id, md5(regexp_replace({out}, '^[. ]+', '')) AS text_md5 FROM documents"


@query(_spoken_sql())
def q86_punctuate(t: Tables) -> DataFrame:
    """Texts with full stops for fillers and joints."""
    return t.documents.select("doc_id", F.md5(text.punctuate(F.col("text"))).alias("text_md5"))


@query("""SELECT page_id, '<p> <BOI> <seed2_1> <EOI>  text ' || page_id || ' <img src="http://x.org/missing.png"> and  <BOI> <seed2_2> <EOI>  twice  <BOI> <seed2_2> <EOI> </p>' AS text FROM pages""")
def q87_images_to_tokens(t: Tables) -> DataFrame:
    """Images replaced by their token blocks; those without one stay."""
    page = F.concat(F.lit('<p><img class="c" src="http://x.org/a.png"> text '), "page_id", F.lit(' <img src="http://x.org/missing.png"> and ![alt](b.jpg) twice ![alt](b.jpg)</p>'))
    blocks = F.create_map(F.lit("a.png"), F.lit("<seed2_1>"), F.lit("b.jpg"), F.lit("<seed2_2>"))
    return t.pages.select("page_id", text.images_to_tokens(page, blocks).alias("text"))


def side_streams(t: Tables) -> DataFrame:
    """Agent, audio and speech entries by user and chunk, some missing, some empty."""
    i = F.col("chunk")
    return fr(t).select("user_id", F.col("f").alias("chunk")).select(
        "user_id", "chunk", F.when(i % 2 == 0, F.concat(F.lit("a "), i)).alias("agent"), F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("s "), i)).alias("snac"), F.concat(F.lit("words "), i).alias("speech")
    )


@query(f"""{FR}, b AS (SELECT user_id, f, {KIND_SQL} AS kind, {K_SQL} AS k, CAST(floor(value) AS BIGINT) AS v FROM fr),
n AS (SELECT *, count(*) FILTER (kind = 'avc_lm') OVER (PARTITION BY user_id ORDER BY f ROWS UNBOUNDED PRECEDING) - 1 AS a, count(*) FILTER (kind = 'cosmos') OVER (PARTITION BY user_id ORDER BY f ROWS UNBOUNDED PRECEDING) - 1 AS c, count(*) FILTER (kind = 'avc_lm') OVER (PARTITION BY user_id) AS avcs, bool_or(kind = 'agent') OVER (PARTITION BY user_id) AS had FROM b),
p AS (SELECT user_id, f::DOUBLE AS pos, '<' || kind || '> ' || k || ' ' || v || ' </' || kind || '>' AS piece FROM n
 UNION ALL SELECT user_id, f + 0.25, '<agent>a ' || a || '</agent>' FROM n WHERE kind = 'avc_lm' AND NOT had AND a % 2 = 0
 UNION ALL SELECT user_id, f + 0.5, '<snac>s ' || a || '</snac>' FROM n WHERE kind = 'avc_lm' AND a % 3 <> 0
 UNION ALL SELECT user_id, f + 0.75, '<speech>words ' || a || '</speech>' FROM n WHERE kind = 'avc_lm')
SELECT user_id, string_agg(piece, ' ' ORDER BY pos) AS stream FROM p GROUP BY user_id""")
def q88_four_way_merge(t: Tables) -> DataFrame:
    """Agent, audio and speech blocks merged by chunk behind avc_lm blocks; tracks with agent blocks of their own get no more, empty entries nothing."""
    return flatten.serialise(flatten.merge_sides(flatten.explode_blocks(streams(t), "user_id", "stream"), side_streams(t), "user_id"), "user_id")


@query(f"""{FR}, b AS (SELECT user_id, f, {KIND_SQL} AS kind FROM fr WHERE event_type IN ('view', 'click', 'purchase')),
n AS (SELECT *, count(*) FILTER (kind = 'cosmos') OVER (PARTITION BY user_id ORDER BY f ROWS UNBOUNDED PRECEDING) - 1 AS c, count(*) FILTER (kind = 'avc_lm') OVER (PARTITION BY user_id) AS avcs FROM b)
SELECT user_id, count(*) FILTER (kind = 'cosmos' AND c < avcs) AS captions, count(*) + count(*) FILTER (kind = 'cosmos' AND c < avcs) AS blocks, coalesce(max(f) FILTER (kind = 'cosmos' AND c < avcs) - 0.125, -1)::DOUBLE AS last_at FROM n GROUP BY user_id""")
def q88b_captions_before_cosmos(t: Tables) -> DataFrame:
    """Captions merged before the i-th cosmos block; those without a cosmos or avc_lm block of that number are left out."""
    f = fr(t).filter(F.col("event_type").isin("view", "click", "purchase"))
    blocks = f.select("user_id", F.col("f").alias("pos"), kind_of().alias("kind"), F.lit("1").alias("payload"))
    sides = fr(t).select("user_id", F.col("f").alias("chunk"), F.concat(F.lit("c "), "f").alias("caption"))
    m = flatten.merge_sides(blocks, sides, "user_id")
    new = F.col("kind") == "caption"
    return m.groupBy("user_id").agg(F.count_if(new).alias("captions"), F.count("*").alias("blocks"), F.coalesce(F.max(F.when(new, F.col("pos"))), F.lit(-1.0)).alias("last_at"))


@query("""WITH d AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'), e AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND user_id % 2 = 0) SELECT user_id FROM d WHERE user_id NOT IN (SELECT user_id FROM e)""")
def q89_right_only_keys(t: Tables) -> DataFrame:
    """Keys that only the right side of a join has."""
    of = lambda e: t.events.filter(F.col("event_type") == e)
    return records.left_over_keys(of("purchase"), of("signup").filter("user_id % 2 = 0"), "user_id")


@query("""WITH m AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS shard FROM events GROUP BY user_id) SELECT shard, count(*) AS n, string_agg(user_id::VARCHAR, ' ' ORDER BY user_id) AS keys FROM m WHERE user_id % 3 <> 0 GROUP BY shard""")
def q90_shard_groups(t: Tables) -> DataFrame:
    """What to read from each shard, a key from the shard that was written last."""
    m = t.events.withColumn("order", F.struct("ts", "event_id"))
    g = records.shard_groups(t.events.filter("user_id % 3 <> 0"), m, "user_id", "event_type", "order")
    return g.select(F.col("event_type").alias("shard"), "n", F.array_join("keys", " ").alias("keys"))


@query(f"""{FR}, n AS (SELECT user_id, count(*) AS n, greatest(2, CAST(round_even(count(*) / 24.0 * 30, 0) AS BIGINT)) AS m FROM fr GROUP BY user_id),
g AS (SELECT user_id, n, m, unnest(range(m)) AS i FROM n), x AS (SELECT user_id, i, CASE WHEN i = m - 1 THEN n - 1 ELSE CAST(round_even(i * ((n - 1) / (m - 1)::DOUBLE), 0) AS BIGINT) END AS native FROM g)
SELECT user_id, native, count(*) AS frames, string_agg(i::VARCHAR, ',' ORDER BY i) AS resampled FROM x GROUP BY ALL""")
def q91_fan_out(t: Tables) -> DataFrame:
    """The resampled frames that each native frame gives."""
    n = t.events.groupBy("user_id").agg(F.count("*").alias("n")).withColumn("m", F.greatest(F.lit(2), F.rint(F.col("n") / 24.0 * 30).cast("bigint")))
    return asof.fan_out(n, "user_id", "n", "m").select("user_id", "native", F.size("resampled").cast("bigint").alias("frames"), F.array_join("resampled", ",").alias("resampled"))


@query(f"""WITH e AS (SELECT event_type, user_id % 4 AS category, user_id AS seq, {K_SQL} AS k FROM events), c AS (SELECT category, seq, 'caption ' || max(k) AS caption FROM e WHERE event_type = 'signup' GROUP BY ALL)
SELECT DISTINCT e.category, e.seq, CASE e.category WHEN 0 THEN 'run' WHEN 1 THEN 'jump' WHEN 2 THEN 'walk' ELSE 'sit' END || coalesce(' ' || caption, '') AS text FROM e LEFT JOIN c USING (category, seq)""")
def q92_track_captions(t: Tables) -> DataFrame:
    """Captions by category and sequence joined to tracks; tracks without one keep the category's text."""
    e = t.events.select(F.col("event_type"), (F.col("user_id") % 4).alias("category"), F.col("user_id").alias("seq"), k_of().alias("k"))
    c = e.filter("event_type = 'signup'").groupBy("category", "seq").agg(F.concat(F.lit("caption "), F.max("k")).alias("caption"))
    d = e.select("category", "seq").distinct().join(c, ["category", "seq"], "left")
    return d.select("category", "seq", F.concat_ws(" ", F.expr("CASE category WHEN 0 THEN 'run' WHEN 1 THEN 'jump' WHEN 2 THEN 'walk' ELSE 'sit' END"), "caption").alias("text"))


@query(f"""{FR}, b AS (SELECT user_id, {KIND_SQL} AS kind, epoch_us(ts) / 1e6 AS sec FROM fr), d AS (SELECT user_id, max(sec) - min(sec) AS seconds FROM b GROUP BY user_id)
SELECT kind, count(*) AS tokens, round(count(*) / sum(DISTINCT s.total), 9) AS per_second FROM b, (SELECT sum(seconds) AS total FROM d) s GROUP BY kind""")
def q93_density(t: Tables) -> DataFrame:
    """Tokens per second of each modality over the length of all tracks."""
    d = t.events.select("user_id", kind_of().alias("kind"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    each = d.groupBy("user_id").agg((F.max("at") - F.min("at")).alias("seconds"))
    total = each.agg(F.sum("seconds").alias("seconds"))  # one row
    return d.groupBy("kind").agg(F.count("*").alias("tokens")).crossJoin(F.broadcast(total)).select("kind", "tokens", F.round(F.col("tokens") / F.col("seconds"), 9).alias("per_second"))


@query("""WITH c AS (SELECT source, avg(n_chars) AS mean, count(*) AS n FROM documents WHERE doc_id % 10 = 0 GROUP BY source), a AS (SELECT source, count(*) AS docs FROM documents GROUP BY source)
SELECT source, docs, round(mean * docs / 1000.0 / 3600.0, 6) AS hours FROM a JOIN c USING (source)""")
def q94_benchmark_extrapolation(t: Tables) -> DataFrame:
    """Hours for a corpus from the mean time of a benchmark of some of its records (a thousand characters a second)."""
    part = F.when(F.col("doc_id") % 10 == 0, F.col("n_chars"))
    c = t.documents.groupBy("source").agg(F.avg(part).alias("mean"), F.count("*").alias("docs")).filter("mean is not null")
    return c.select("source", "docs", F.round(F.col("mean") * F.col("docs") / 1000.0 / 3600.0, 6).alias("hours"))


@query("""WITH d AS (SELECT 'documents' AS source, lang AS key FROM documents UNION ALL SELECT 'conversations', role FROM conversations UNION ALL SELECT 'events', event_type FROM events) SELECT source, key, count(*) AS n FROM d GROUP BY ALL""")
def q95_labelled_union(t: Tables) -> DataFrame:
    """Sources one after the other, each row with its source's name."""
    parts = {"documents": t.documents.select(F.col("lang").alias("key"), "doc_id"), "conversations": t.conversations.select(F.col("role").alias("key")), "events": t.events.select(F.col("event_type").alias("key"))}
    return corpus.labelled_union(parts).groupBy("source", "key").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT event_type, round_even(value, 0) AS fps FROM events) SELECT fps, count(*) AS n FROM e WHERE fps > 0 AND fps <= 240 GROUP BY fps""")
def q96_rate_histogram(t: Tables) -> DataFrame:
    """Valid frame rates by whole number."""
    return stream_ops.rate_histogram(t.events.select(F.bround("value").alias("fps")), "fps")


@query(f"""{FR}, h AS (SELECT user_id, f, f % 30 = 0 AS key, f % 3 = 0 AS sampled, f // 24 AS chunk FROM fr),
s AS (SELECT user_id, chunk, list(f ORDER BY f) FILTER (sampled) AS fs FROM h GROUP BY ALL)
SELECT user_id, chunk, (SELECT count(*) FROM h WHERE h.user_id = s.user_id AND h.chunk = s.chunk AND h.key) AS keyframes, array_to_string(list_concat(fs, list_transform(range(8 - len(fs)), lambda x: fs[len(fs)])), ',') AS frames FROM s""")
def q97_sampled_chunks(t: Tables) -> DataFrame:
    """Every third frame, eight to a chunk, the last one repeated; keyframes every 30 frames."""
    return windows.sampled_chunks(fr(t), "user_id", 8, 3, 30).select("user_id", "chunk", "keyframes", F.array_join("frames", ",").alias("frames"))


@query(f"""WITH o AS (SELECT o_orderkey, o_custkey, {_DAY.format("o_orderdate")} AS s FROM orders)
SELECT a.o_orderkey, count(*) AS hits, string_agg(b.o_orderkey::VARCHAR, ' ' ORDER BY b.s, b.o_orderkey) AS speech FROM o a JOIN o b ON a.o_custkey = b.o_custkey WHERE least(a.s + 90, b.s + 20) - greatest(a.s, b.s) >= 0.2 GROUP BY a.o_orderkey""")
def q98_overlapping_speech(t: Tables) -> DataFrame:
    """Speech joined to every activity it overlaps, texts in order of time."""
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("key"), _day("o_orderdate").alias("start"), (_day("o_orderdate") + 90).alias("end"))
    speech = t.orders.select(F.col("o_orderkey").cast("string").alias("said"), F.col("o_orderkey").alias("said_id"), F.col("o_custkey").alias("key"), _day("o_orderdate").alias("r_start"), (_day("o_orderdate") + 20).alias("r_end"))
    p = intervals.overlap_join(o, speech, ["key"], 0.2)
    return p.groupBy("o_orderkey").agg(F.count("*").alias("hits"), F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r_start", "said_id", "said"))), lambda x: x.said), " ")).alias("speech"))


@query(f"""WITH {{0}} SELECT comp AS joint, count(*) AS n, round(100.0 * count(*) FILTER (points = 2) / count(*), 4) AS p2, round(100.0 * count(*) FILTER (points = 4) / count(*), 4) AS p4, round(100.0 * count(*) FILTER (points = 8) / count(*), 4) AS p8 FROM t GROUP BY comp""".replace("{0}", """v AS (SELECT vec_id, embedding, unnest(range(0, len(embedding) // 8)) AS win FROM embeddings),
e AS (SELECT vec_id, win, list_transform(embedding[8 * win + 1:8 * win + 8], lambda x: CAST(round_even(x * 100, 0) AS BIGINT)) AS xs FROM v),
d AS (SELECT vec_id, win, unnest(range(1, 7)) AS i, xs FROM e), t AS (SELECT vec_id, win AS comp, CASE WHEN max(abs(xs[i] - 2 * xs[i + 1] + xs[i + 2])) < 40 THEN 2 WHEN max(abs(xs[i] - 2 * xs[i + 1] + xs[i + 2])) < 55 THEN 4 ELSE 8 END AS points FROM d GROUP BY ALL)"""))
def q99_tiers_by_joint(t: Tables) -> DataFrame:
    """Tier shares of each joint: the windows of a vector stand for joints."""
    from .relational import _window_tiers

    share = lambda p: F.round(100.0 * F.count_if(F.col("points") == p) / F.count("*"), 4).alias(f"p{p}")
    return _window_tiers(t).groupBy(F.col("win").alias("joint")).agg(F.count("*").alias("n"), share(2), share(4), share(8))
