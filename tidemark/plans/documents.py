"""Queries over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, tokens
from ..functions.sampling import hash_uniform, keep_at_rate
from ..operators import corpus, mixture, windows
from .registry import Tables, query

WORDS_SQL = "list_filter(string_split_regex(text, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '')"
UNIFORM_SQL = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


def corpus_turns(t: Tables) -> DataFrame:
    """The texts of each conversation in order."""
    turns = F.array_sort(F.collect_list(F.struct("turn", F.col("text").alias("x"))))
    return t.conversations.groupBy("conv_id").agg(F.transform(turns, lambda s: s.x).alias("o"))


def words_of(t: DataFrame) -> DataFrame:
    return t.withColumn("w", tokens.words(F.col("text")))


@query(f"""WITH d AS (SELECT lang, source, len({WORDS_SQL}) AS n_words, CAST(len(regexp_extract_all(text, '[0-9]+')) AS BIGINT) AS n_numbers FROM documents)
SELECT CASE WHEN grouping(lang) = 1 THEN 'GRAND TOTAL' ELSE lang END AS lang, source, count(*) AS docs, sum(n_words)::BIGINT AS words, sum(n_numbers)::BIGINT AS numbers, round(100.0 * sum(n_words) / max(sum(n_words)) OVER (), 6) AS pct FROM d GROUP BY ROLLUP (lang, source)""")
def q02_inventory(t: Tables) -> DataFrame:
    """Words and numbers by language and source with subtotals, the grand total and percent of it."""
    d = words_of(t.documents).select("lang", "source", F.size("w").cast("bigint").alias("n_words"), F.regexp_count("text", F.lit("[0-9]+")).cast("bigint").alias("n_numbers"))
    r = d.rollup("lang", "source").agg(F.grouping("lang").alias("g"), F.count("*").alias("docs"), F.sum("n_words").alias("words"), F.sum("n_numbers").alias("numbers"))
    total = F.max("words").over(Window.partitionBy())
    return r.select(F.when(F.col("g") == 1, "GRAND TOTAL").otherwise(F.col("lang")).alias("lang"), "source", "docs", "words", "numbers", F.round(100.0 * F.col("words") / total, 6).alias("pct"))


@query("""SELECT conv_id, count(*) AS turns, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id""")
def q11_group_concat(t: Tables) -> DataFrame:
    """Each conversation in one text, turns in order."""
    c = t.conversations.withColumn("line", F.concat("role", F.lit(": "), "text"))
    joined = corpus.concat_wins(c, ["conv_id"], "line", "turn", "\n").withColumnRenamed("line", "text")
    return joined.join(c.groupBy("conv_id").agg(F.count("*").alias("turns")), "conv_id").select("conv_id", "turns", "text")


@query("""SELECT a.conv_id, a.turn, max(u.turn) AS user_turn, arg_max(length(u.text), u.turn) AS user_chars FROM conversations a JOIN conversations u ON u.conv_id = a.conv_id AND u.turn < a.turn AND u.role = 'user' WHERE a.role = 'assistant' GROUP BY a.conv_id, a.turn""")
def q12_parent_child(t: Tables) -> DataFrame:
    """Each assistant turn with the last user turn before it; without one it is left out."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.when(F.col("role") == "user", F.struct("turn", F.length("text").alias("n")))
    d = t.conversations.withColumn("u", F.last(seen, ignorenulls=True).over(w))
    return d.filter("role = 'assistant' and u is not null").select("conv_id", "turn", F.col("u.turn").alias("user_turn"), F.col("u.n").cast("bigint").alias("user_chars"))


@query("""SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q13_anti_join(t: Tables) -> DataFrame:
    """Documents that no label row names: what a resumed run still has to do."""
    return t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id", "lang", "n_chars")


@query(f"""WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents), k AS (SELECT doc_id, w, unnest(range(5)) AS part FROM d)
SELECT doc_id, part, CAST(round_even((part + 1) * len(w) / 5.0::DOUBLE, 0) - round_even(part * len(w) / 5.0::DOUBLE, 0) AS BIGINT) AS n, w[CAST(round_even(part * len(w) / 5.0::DOUBLE, 0) AS BIGINT) + 1] AS first_word FROM k""")
def q22_even_split(t: Tables) -> DataFrame:
    """Each document's words in five even parts."""
    d = words_of(t.documents)
    n = F.size("w")
    p = d.select("doc_id", n.alias("n_all"), "w", F.posexplode(windows.even_split(F.col("w"), 5)).alias("part", "items"))
    start = F.rint(F.col("part") * F.col("n_all") / F.lit(5.0)).cast("int")
    return p.select("doc_id", F.col("part").cast("bigint").alias("part"), F.size("items").cast("bigint").alias("n"), F.get("w", start).alias("first_word"))


@query("""SELECT doc_id, coalesce(length(text) = 0 OR length(regexp_replace(text, '[\\x00-\\x7F]', '', 'g'))::DOUBLE / length(text) > 0.15 OR (length(text) >= 40 AND len(list_distinct(string_split(text, '')))::DOUBLE / length(text) < 0.15), true) AS garbled FROM documents""")
def q33_garbled(t: Tables) -> DataFrame:
    """Garbled texts by foreign characters and by repetition."""
    return t.documents.select("doc_id", text.is_garbled(F.col("text")).alias("garbled"))


@query(f"""WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])[ \\t\\n\\v\\f\\r]+', '\\1' || chr(1), 'g'), chr(1))) AS text FROM documents),
w AS (SELECT doc_id, len({WORDS_SQL}) AS n FROM s), c AS (SELECT doc_id, n, (n + 19) // 20 AS chunks FROM w WHERE n > 0)
SELECT doc_id, sum(chunks)::BIGINT AS chunks, sum(n)::BIGINT AS words, max(least(n, 20))::BIGINT AS longest FROM c GROUP BY doc_id""")
def q34_sentence_chunks(t: Tables) -> DataFrame:
    """Sentences cut into chunks of at most 20 words."""
    c = t.documents.select("doc_id", F.explode(text.sentence_chunks(F.col("text"))).alias("chunk")).withColumn("n", F.size(tokens.words(F.col("chunk"))).cast("bigint"))
    return c.groupBy("doc_id").agg(F.count("*").alias("chunks"), F.sum("n").alias("words"), F.max("n").alias("longest"))


STOP_WORDS = ("the", "of", "and", "that", "in", "is", "to", "de", "la", "der", "die")
_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


@query(f"""WITH w AS (SELECT doc_id, unnest({WORDS_SQL}) AS word, generate_subscripts({WORDS_SQL}, 1) - 1 AS pos FROM documents)
SELECT doc_id, count(*) AS words, count(*) FILTER (lower(word) IN ({_STOP_SQL}) AND {UNIFORM_SQL.format("doc_id || '|' || pos || '|stop'")} <= 0.95) AS dropped FROM w GROUP BY doc_id""")
def q35_stop_words(t: Tables) -> DataFrame:
    """Stop words dropped at a rate of 0.95 by hash of document and place."""
    w = words_of(t.documents).select("doc_id", F.posexplode("w").alias("pos", "word"))
    drop = F.lower("word").isin(*STOP_WORDS) & (hash_uniform(F.col("doc_id"), F.col("pos"), "stop") <= 0.95)
    return w.groupBy("doc_id").agg(F.count("*").alias("words"), F.count_if(drop).alias("dropped"))


@query(f"""WITH b AS (SELECT d.doc_id, unnest([('lang', d.lang), ('source', d.source), ('quality', coalesce(l.quality::VARCHAR, 'none'))]) AS b FROM documents d LEFT JOIN labels l USING (doc_id)),
k AS (SELECT doc_id, b[1] || ': ' || b[2] AS line, {UNIFORM_SQL.format("doc_id || '|' || b[1]")} AS u FROM (SELECT doc_id, [b[1], b[2]] AS b FROM b))
SELECT doc_id, string_agg(line, ' . ' ORDER BY u, line) AS header FROM k GROUP BY doc_id""")
def q36_header(t: Tables) -> DataFrame:
    """Header blocks in hash order."""
    d = t.documents.join(t.labels, "doc_id", "left")
    pairs = [("lang", F.col("lang")), ("source", F.col("source")), ("quality", F.coalesce(F.col("quality").cast("string"), F.lit("none")))]
    blocks = F.array(*[F.struct(hash_uniform(F.col("doc_id"), k).alias("u"), F.concat(F.lit(f"{k}: "), v).alias("line")) for k, v in pairs])
    return d.select("doc_id", F.array_join(F.transform(F.array_sort(blocks), lambda b: b.line), " . ").alias("header"))


@query("""WITH o AS (SELECT conv_id, list(text ORDER BY turn) FILTER (role = 'user') AS q, list(text ORDER BY turn) FILTER (role = 'assistant') AS a FROM conversations GROUP BY conv_id)
SELECT conv_id, array_to_string(list_transform(q[1:26], lambda x, i: chr(CAST(64 + i AS INT)) || '. ' || x), chr(10)) AS options, array_to_string(a, ' -> ') AS chain, 'USER: ' || q[1] || ' [Voice: calm] ASSISTANT:' || chr(10) || a[len(a)] AS chat FROM o""")
def q37_templates(t: Tables) -> DataFrame:
    """The questions of each conversation as lettered options, its answers as a chain, and the first and last of them as a chat turn."""
    of = lambda role: F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("turn", "text")))), lambda s: s.text)
    o = t.conversations.groupBy("conv_id").agg(of("user").alias("q"), of("assistant").alias("a"))
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    return o.select("conv_id", text.lettered_options(some("q")).alias("options"), text.chain(some("a")).alias("chain"), text.chat_turn(F.get("q", F.lit(0)), F.try_element_at("a", F.lit(-1)), F.lit("calm")).alias("chat"))


@query("""WITH o AS (SELECT conv_id, list(text ORDER BY turn) AS o FROM conversations GROUP BY conv_id)
SELECT conv_id, array_to_string(list_transform(o[1:26], lambda x, i: chr(CAST(64 + i AS INT)) || '. ' || x), chr(10)) AS options, array_to_string(o, ' -> ') AS chain, 'USER: ' || o[1] || ' [Voice: calm] ASSISTANT:' || chr(10) || o[len(o)] AS chat FROM o""")
def q37b_whole_templates(t: Tables) -> DataFrame:
    """As q37, over the whole text of every turn."""
    o = corpus_turns(t)
    return o.select("conv_id", text.lettered_options(F.col("o")).alias("options"), text.chain(F.col("o")).alias("chain"), text.chat_turn(F.get("o", F.lit(0)), F.element_at("o", -1), F.lit("calm")).alias("chat"))


@query("""SELECT page_id, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS host, lower(regexp_extract(url, '^[^?#]*/[^/?#]*\\.([A-Za-z0-9]{1,5})(?:[?#]|$)', 1)) AS extension, regexp_extract(regexp_replace(regexp_replace(url, '[^A-Za-z0-9]', '', 'g') || '_seed2', '_seed2$', ''), '^([A-Za-z0-9_-]{11})', 1) AS tube FROM pages""")
def q38_url_parts(t: Tables) -> DataFrame:
    """Host, extension and an 11-character id."""
    u = F.col("url")
    plain = F.concat(F.regexp_replace(u, "[^A-Za-z0-9]", ""), F.lit("_seed2"))
    return t.pages.select("page_id", text.url_host(u).alias("host"), text.url_extension(u).alias("extension"), text.tube_id(plain).alias("tube"))


@query("""SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g'))) AS text_md5, len(regexp_extract_all(html, '<p>'))::BIGINT AS paragraphs FROM pages""")
def q40_strip_tags(t: Tables) -> DataFrame:
    """Pages without tags."""
    return t.pages.select("page_id", F.md5(text.strip_tags(F.col("html"))).alias("text_md5"), F.regexp_count("html", F.lit("<p>")).cast("bigint").alias("paragraphs"))


@query("""SELECT CASE WHEN regexp_matches(text, '[ß-ÿ]') THEN 'latin-1' ELSE 'ascii' END AS script, CASE WHEN regexp_matches(text, '[぀-ヿ]') THEN 'ja' WHEN regexp_matches(text, '[가-힣]') THEN 'ko' WHEN regexp_matches(text, '[一-鿿]') THEN 'zh' ELSE 'other' END AS cjk, count(*) AS n FROM documents GROUP BY ALL""")
def q41_scripts(t: Tables) -> DataFrame:
    """Documents by script."""
    latin = F.when(F.col("text").rlike("[ß-ÿ]"), "latin-1").otherwise("ascii")
    return t.documents.groupBy(latin.alias("script"), text.script_of(F.col("text")).alias("cjk")).agg(F.count("*").alias("n"))


@query(f"""WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents), g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS gram FROM d)
SELECT gram, count(*) AS n, count(DISTINCT doc_id) AS docs FROM g GROUP BY gram HAVING count(*) >= 5""")
def q42_ngrams(t: Tables) -> DataFrame:
    """Three-word grams found five times or more."""
    return corpus.count_ngrams(t.documents, "text", 3).filter("n >= 5")


@query(f"""WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents), g AS (SELECT unnest(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS gram FROM d)
SELECT gram, count(*) AS n FROM g GROUP BY gram HAVING count(*) >= 2""")
def q42b_inner_ngrams(t: Tables) -> DataFrame:
    """Repeated three-word grams, the last of each document left out."""
    return corpus.count_ngrams(t.documents, "text", 3, last=False).filter("n >= 2").select("gram", "n")


@query("""WITH a AS (SELECT DISTINCT doc_id FROM documents), b AS (SELECT DISTINCT doc_id FROM labels UNION SELECT item_id + 100000000 FROM benchmark), c AS (SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b, (SELECT count(*) FROM a JOIN b USING (doc_id)) AS n_both)
SELECT *, round(100.0 * n_both / n_a, 4) AS pct_a, round(100.0 * n_both / n_b, 4) AS pct_b FROM c""")
def q43_set_overlap(t: Tables) -> DataFrame:
    """How far two id sets overlap."""
    b = t.labels.select("doc_id").union(t.benchmark.select((F.col("item_id") + 100000000).alias("doc_id")))
    return corpus.compare_sets(t.documents, b, "doc_id")


@query("""(SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels WHERE quality = 1) EXCEPT SELECT doc_id FROM labels WHERE toxic = 1""")
def q43b_set_operations(t: Tables) -> DataFrame:
    """Good documents without the toxic ones."""
    ids = lambda c: t.labels.filter(c).select("doc_id")
    return t.documents.select("doc_id").intersect(ids("quality = 1")).subtract(ids("toxic = 1"))


@query(f"""SELECT doc_id, {UNIFORM_SQL.format("doc_id || '|cosmos|42'")} > 0.5 AS keeps_half, {UNIFORM_SQL.format("doc_id || '|seed2|42'")} > 0.0 AS keeps_all, false AS keeps_none FROM documents""")
def q45_dropout(t: Tables) -> DataFrame:
    """Independent dropout by hash at rates of a half, none and all."""
    i = F.col("doc_id")
    return t.documents.select("doc_id", keep_at_rate(0.5, i, "cosmos", "42").alias("keeps_half"), keep_at_rate(0.0, i, "seed2", "42").alias("keeps_all"), keep_at_rate(1.0, i, "snac", "42").alias("keeps_none"))


@query(f"""WITH u AS (SELECT source, row_number() OVER (ORDER BY {UNIFORM_SQL.format("source || '|42'")}, source) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM documents))
SELECT d.doc_id, CASE WHEN u.r <= greatest(1, CAST(floor(n * 0.1) AS BIGINT)) THEN 'test' ELSE 'train' END AS split, CASE WHEN d.doc_id % 8 = 5 THEN 'test' ELSE 'train' END AS shard_split FROM documents d JOIN u USING (source)""")
def q46_splits(t: Tables) -> DataFrame:
    """A split by source, and one by named shard."""
    s = corpus.split_units(t.documents, "source", 0.1, "42")
    return t.documents.join(s, "source").select("doc_id", "split", F.when(F.col("doc_id") % 8 == 5, "test").otherwise("train").alias("shard_split"))


@query("""WITH r AS (SELECT lang, unnest(range(CASE WHEN lang = 'en' THEN 1 ELSE 20 END)) AS k, doc_id FROM documents)
SELECT lang, count(*) AS rows, count(DISTINCT doc_id) AS base_rows, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share FROM r GROUP BY lang""")
def q47_oversample(t: Tables) -> DataFrame:
    """Other languages than English twenty times, and the physical share of each."""
    d = t.documents.select("lang", F.col("doc_id").cast("string").alias("id"))
    r = d.filter("lang = 'en'").unionByName(corpus.oversample(d.filter("lang <> 'en'"), "id", 20))
    c = r.groupBy("lang").agg(F.count("*").alias("rows"), F.countDistinct(corpus.base_id(F.col("id"))).alias("base_rows"))
    return c.withColumn("share", F.round(100.0 * F.col("rows") / F.sum("rows").over(Window.partitionBy()), 6))


@query("""SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS row_shard, (sum(n_chars) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - n_chars)::BIGINT // 200000 AS size_shard FROM documents""")
def q48_shards(t: Tables) -> DataFrame:
    """Shards of 100 rows, and of 200,000 characters."""
    d = corpus.size_shards(t.documents.select("doc_id", "n_chars"), "doc_id", "n_chars", 200_000).withColumnRenamed("shard", "size_shard")
    d = corpus.size_shards(d.withColumn("one", F.lit(1).cast("bigint")), "doc_id", "one", 100).withColumnRenamed("shard", "row_shard")
    return d.select("doc_id", "row_shard", "size_shard")


@query("""SELECT doc_id, lang, upper(substr(source, 1, 3)) AS short_source, length(text) AS chars, replace(lower(source), ' ', '_') AS video_id FROM documents WHERE regexp_matches(text, '(?i)(^|[^\\pL0-9_])(tion|theand|there|et|und)([^\\pL0-9_]|$)') AND n_chars >= 100""")
def q53_filters(t: Tables) -> DataFrame:
    """A keyword filter with word boundaries, a length filter and projections."""
    d = t.documents.filter("n_chars >= 100").filter(F.col("text").rlike(r"(?i)(^|[^\pL0-9_])(tion|theand|there|et|und)([^\pL0-9_]|$)"))
    return d.select("doc_id", "lang", F.upper(F.substring("source", 1, 3)).alias("short_source"), F.length("text").cast("bigint").alias("chars"), F.replace(F.lower("source"), F.lit(" "), F.lit("_")).alias("video_id"))


@query(f"""WITH w AS (SELECT lang, unnest({WORDS_SQL}) AS word FROM documents), c AS (SELECT lang, word, count(*) AS n FROM w GROUP BY ALL)
SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM c QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 20""")
def q57_top_words(t: Tables) -> DataFrame:
    """The twenty most frequent words of each language."""
    c = words_of(t.documents).select("lang", F.explode("w").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    ranked = c.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word")).cast("bigint"))
    return ranked.filter("rank <= 20").select("lang", "word", "n", "rank")


@query(f"""SELECT doc_id, {UNIFORM_SQL.format("doc_id || '|pick'")} AS u FROM documents ORDER BY u, doc_id LIMIT 50""")
def q61_hash_sample(t: Tables) -> DataFrame:
    """Fifty documents by hash: a sampling operator."""
    return t.documents.select("doc_id", hash_uniform(F.col("doc_id"), "pick").alias("u")).orderBy("u", "doc_id").limit(50)


@query("""WITH x AS (SELECT conv_id, string_split(string_agg(upper(role) || ': ' || text, ' ' ORDER BY turn), ' ASSISTANT: ') AS p FROM conversations GROUP BY conv_id)
SELECT conv_id, array_to_string(p[:greatest(len(p) - 1, 1)], ' ASSISTANT: ') AS prompt, CASE WHEN len(p) > 1 THEN p[len(p)] ELSE '' END AS answer FROM x""")
def q61b_marker_split(t: Tables) -> DataFrame:
    """Prompt and answer around the last marker."""
    x = corpus.concat_wins(t.conversations.withColumn("x", F.concat(F.upper("role"), F.lit(": "), "text")), ["conv_id"], "x", "turn")
    answer = F.substring_index("x", " ASSISTANT: ", -1)
    there = F.contains("x", F.lit(" ASSISTANT: "))
    prompt = F.substr("x", F.lit(1), F.length("x") - F.length(answer) - 12)
    return x.select("conv_id", F.when(there, prompt).otherwise(F.col("x")).alias("prompt"), F.when(there, answer).otherwise("").alias("answer"))


@query("""SELECT conv_id, split_part(x, ' ASSISTANT: ', 1) AS prompt, CASE WHEN instr(x, ' ASSISTANT: ') > 0 THEN substr(x, instr(x, ' ASSISTANT: ') + 12) ELSE '' END AS answer FROM (SELECT conv_id, string_agg(upper(role) || ': ' || text, ' ' ORDER BY turn) AS x FROM conversations GROUP BY conv_id)""")
def q61c_whole_marker_split(t: Tables) -> DataFrame:
    """As q61b, over the whole text of every turn."""
    x = corpus.concat_wins(t.conversations.withColumn("x", F.concat(F.upper("role"), F.lit(": "), "text")), ["conv_id"], "x", "turn")
    at = F.instr("x", " ASSISTANT: ")
    return x.select("conv_id", F.substring_index("x", " ASSISTANT: ", 1).alias("prompt"), F.when(at > 0, F.expr("substring(x, instr(x, ' ASSISTANT: ') + 12)")).otherwise("").alias("answer"))


@query(f"""WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents)
SELECT doc_id, len(w)::BIGINT AS words, len(list_filter(w, lambda x, i: NOT coalesce(i >= 3 AND x = w[i - 1] AND x = w[i - 2], false)))::BIGINT AS left_over FROM d""")
def q68_collapse_repeats(t: Tables) -> DataFrame:
    """Words without the third and later of equal ones in a row."""
    return words_of(t.documents).select("doc_id", F.size("w").cast("bigint").alias("words"), F.size(text.collapse_triples(F.col("w"))).cast("bigint").alias("left_over"))


#: Target shares in percent; the first language is cut, the last ones are repeated.
SHARES = {"en": 20, "de": 40, "fr": 25, "es": 15}
_SHARES = f"w AS (SELECT unnest({list(SHARES)}) AS lang, unnest({list(SHARES.values())}) AS w)"


@query(f"""WITH {_SHARES}, t AS (SELECT count(*) * 3 // 2 AS total FROM documents), a AS (SELECT lang, total * w // 100 AS q, total * w % 100 AS rest, total FROM w, t),
q AS (SELECT lang, q + CASE WHEN row_number() OVER (ORDER BY rest DESC, lang) <= total - sum(q) OVER () THEN 1 ELSE 0 END AS q FROM a), s AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {UNIFORM_SQL.format("doc_id || '|mixture'")}, doc_id) AS rank FROM documents)
SELECT doc_id, lang, unnest(range(q // n + CASE WHEN rank <= q % n THEN 1 ELSE 0 END)) AS copy FROM r JOIN q USING (lang) JOIN s USING (lang)""")
def q144_mixture(t: Tables) -> DataFrame:
    """Half as many documents again as there are, in given shares of languages, exactly."""
    return mixture.mixture(t.documents.select("doc_id", "lang"), "doc_id", "lang", SHARES, t.documents.count() * 3 // 2)


@query(f"""WITH {_SHARES}, s AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), j AS (SELECT lang, coalesce(n, 0) AS n, w / 100.0::DOUBLE AS target FROM w LEFT JOIN s USING (lang))
SELECT lang, n, round(n / sum(n) OVER (), 6) AS physical, target, round(target / (n / sum(n) OVER ()), 6) AS factor FROM j""")
def q144b_shares(t: Tables) -> DataFrame:
    """Physical and target shares of languages, and how much oftener a row must come."""
    s = mixture.shares(t.documents, "lang", SHARES)
    return s.select("lang", "n", F.round("physical", 6).alias("physical"), "target", F.round("factor", 6).alias("factor"))
