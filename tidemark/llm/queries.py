"""The registered queries of this subpackage: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repetition import repetition_quality

    return repetition_quality(_table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .templates import extract_main_text

    return extract_main_text(_table(spark, sf_dir, "pages"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kmtree import nearest_neighbours

    return nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import best_fit_pack

    return best_fit_pack(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import bpe_round_trip

    return bpe_round_trip(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlmodel import judge_urls

    return judge_urls(_table(spark, sf_dir, "pages"))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ranksync import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pairwise import quality_scores

    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rlz import substring_dedup

    return substring_dedup(_table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_groups

    return simhash_groups(_table(spark, sf_dir, "documents"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectorcodes import compress_vectors

    return compress_vectors(_table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_repetition, op2_main_text, op3_neighbours, op4_minhash, op5_packing, op6_bpe, op7_quality, op8_urls, op9_tokens, op10_substrings, op11_simhash, op12_codes, op13_whitening)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words_sql(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


_GROUPS = f"""WITH RECURSIVE w AS (SELECT doc_id, {_words_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS g FROM s), n AS (SELECT doc_id, len(s) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT r.doc_id, ways.b FROM r JOIN ways ON ways.a = r.c)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id, n.doc_id = min(r.c) AS kept FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n"""

_SPANS = f"""WITH t AS (SELECT doc_id, {_words_sql("text")} AS ws FROM documents),
k AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS pos, unnest(list_transform(range(1, len(ws) - 48), lambda i: md5(array_to_string(ws[i:i + 49], ' ')))) AS h FROM t),
m AS (SELECT h, min(doc_id) AS low FROM k GROUP BY h), d AS (SELECT doc_id, pos FROM k JOIN m USING (h) WHERE low < doc_id),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM t),
c AS (SELECT w.doc_id, w.pos, w.word, max(CASE WHEN d.pos IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY w.doc_id ORDER BY w.pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM w LEFT JOIN d ON d.doc_id = w.doc_id AND d.pos = w.pos),
a AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone = 1) AS g, string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(g, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN a USING (doc_id)"""


def _urls() -> str:
    from .urlmodel import ALPHABET, BACK_OFF, CONTEXTS, DEPTH, HELD_OUT, RULES, SIZE

    by_length = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN ['{v}', '{h}{p}']" for v, h, p in by_length)

    def likelihood(side: str, lower: str) -> str:
        return f"(({side}::DOUBLE + {BACK_OFF} * {lower}) / ({side}_n::DOUBLE + {BACK_OFF}))"

    levels = [f"l0 AS (SELECT c, s, {likelihood('good', repr(1.0 / SIZE))} AS pg, {likelihood('bad', repr(1.0 / SIZE))} AS pb FROM z WHERE c = '')"]
    levels += [f"l{k} AS (SELECT z.c, z.s, {likelihood('good', 'q.pg')} AS pg, {likelihood('bad', 'q.pb')} AS pb FROM z JOIN l{k - 1} q ON q.c = substr(z.c, 2) AND q.s = z.s WHERE length(z.c) = {k})" for k in range(1, DEPTH + 1)]
    every = " UNION ALL ".join(f"SELECT c, s, CAST(round(1000 * (ln(pg) - ln(pb))) AS BIGINT) AS ratio FROM l{k}" for k in range(DEPTH + 1))
    joins = " ".join(f"LEFT JOIN k k{k} ON x.i > {k} AND k{k}.c = substr(x.t, x.i - {k}, {k})" for k in range(DEPTH + 1))
    longest = ", ".join(f"k{k}.c" for k in range(DEPTH, -1, -1))
    mean = lambda v: f"coalesce((sum(score) FILTER (fit[1] = '{v}' AND held))::DOUBLE / nullif(count(*) FILTER (fit[1] = '{v}' AND held), 0), (sum(score) FILTER (fit[1] = '{v}'))::DOUBLE / nullif(count(*) FILTER (fit[1] = '{v}'), 0))"
    return f"""WITH p AS (SELECT page_id, CAST('0x' || substr(md5(coalesce(url, '')), 1, 8) AS BIGINT) % {HELD_OUT} = 0 AS held, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, held, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
f AS (SELECT *, CASE {fits} END AS fit, '^' || regexp_replace(translate(host || path, '{_UPPER}', '{_LOWER}'), '[^a-z0-9/.\\-_]', '~', 'g') || '$' AS t FROM h),
u AS (SELECT fit[1] AS verdict, t, unnest(range(2, length(t) + 1)) AS i FROM f WHERE fit IS NOT NULL AND NOT held),
n AS (SELECT substr(t, i - o, o) AS c, substr(t, i, 1) AS s, count(*) FILTER (verdict = 'allow') AS good, count(*) FILTER (verdict = 'block') AS bad FROM u, range({DEPTH + 1}) r(o) WHERE i > o GROUP BY ALL),
k AS (SELECT c, sum(good) AS good_n, sum(bad) AS bad_n FROM (SELECT c, good, bad FROM n UNION ALL SELECT '', 0, 0) GROUP BY c HAVING (sum(good) + sum(bad)) * {CONTEXTS} >= coalesce((SELECT sum(good + bad) FROM n WHERE c = ''), 0)),
a AS (SELECT unnest(string_split('{ALPHABET}', '')) AS s), z AS (SELECT k.c, a.s, good_n, bad_n, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad FROM k CROSS JOIN a LEFT JOIN n ON n.c = k.c AND n.s = a.s),
{", ".join(levels)}, q AS ({every}),
x AS (SELECT page_id, t, unnest(range(2, length(t) + 1)) AS i FROM f), m AS (SELECT page_id, coalesce({longest}) AS c, substr(x.t, x.i, 1) AS s FROM x {joins}),
y AS (SELECT page_id, CAST(floor(sum(ratio) * 1000.0::DOUBLE / count(*)) AS BIGINT) AS score FROM m JOIN q USING (c, s) GROUP BY page_id),
w AS (SELECT f.*, y.score FROM f JOIN y USING (page_id)), e AS (SELECT {mean("allow")} AS ma, {mean("block")} AS mb FROM w)
SELECT page_id, host, path, fit[2] AS rule, coalesce(fit[1], CASE WHEN ma IS NULL OR mb IS NULL OR score >= (ma + mb) / 2 THEN 'allow' ELSE 'block' END) AS verdict, CASE WHEN ma IS NOT NULL AND mb IS NOT NULL THEN score END AS score FROM w, e"""


def _codes() -> str:
    from .vectorcodes import ENTRIES, PARTS, ROUNDS, SCALE

    distance = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    nearest = lambda k: f"a{k} AS (SELECT p.row, p.j, arg_min(c.e, {{'d': {distance}, 'e': c.e}}) AS e, min({distance}) AS d FROM p JOIN c{k} c USING (j) GROUP BY ALL)"
    mean = lambda k: f"m{k} AS (SELECT j, e, list(q ORDER BY i) AS v FROM (SELECT j, a{k}.e, i, CAST(sum(p.v[i]) - ((sum(p.v[i]) % count(*) + count(*)) % count(*)) AS BIGINT) // count(*) AS q FROM a{k} JOIN p USING (row, j), range(1, (SELECT width FROM d) + 1) r(i) GROUP BY ALL) GROUP BY ALL), c{k + 1} AS (SELECT j, e, coalesce(m{k}.v, c{k}.v) AS v FROM c{k} LEFT JOIN m{k} USING (j, e))"
    steps = ", ".join(f"{nearest(k)}, {mean(k)}" for k in range(ROUNDS))
    return f"""WITH x AS (SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda v: CAST(floor({SCALE} * v::DOUBLE) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
d AS (SELECT CAST(ceil(max(len(v)) / {PARTS}) AS BIGINT) AS width FROM x),
p AS (SELECT row, vec_id, label, j, x.v[j * width + 1:(j + 1) * width] AS v FROM x, d, range({PARTS}) r(j)),
c0 AS (SELECT j, row_number() OVER (PARTITION BY j ORDER BY p.vec_id, x.v) - 1 AS e, p.v FROM p JOIN x USING (row) QUALIFY e < {ENTRIES}),
{steps}, {nearest(ROUNDS)},
o AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY j) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY row),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY j, e)) AS h FROM c{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM x JOIN o USING (row), h"""


ORACLE_SQL: dict[str, str] = {"op4_minhash": _GROUPS, "op8_urls": _urls(), "op10_substrings": _SPANS, "op12_codes": _codes()}
