"""URL filter: rules, and a character language-model ratio where no rule fits.

Two variable-order Markov models are counted from the URLs that the rules accept
and reject.  The order of a context is chosen by count: up to DEPTH symbols, as
long as one symbol in CONTEXTS follows it, so frequent starts get long contexts
and rare ones short ones.  Each context's counts are smoothed with those of the
next shorter one.  A URL that no rule fits is judged by the difference of its
log-likelihoods under the two, divided by its length.  The threshold is
calibrated on rule URLs that the models were not counted from (one in HELD_OUT,
by hash): half-way between the mean scores of the accepted and the rejected.
DataFrame functions only.

Scoring walks an automaton whose states are the contexts: one look-up a symbol
gives the log ratio and the next state.  Log ratios are kept in whole
thousandths, so sums do not depend on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Fixed values: (verdict, host, path start).
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

#: The models' symbols; anything not listed counts as ~.
ALPHABET = "^$~abcdefghijklmnopqrstuvwxyz0123456789/.-_"
SIZE = len(ALPHABET)
#: Longest context, and the share of all symbols that a context must be followed by: of each length there are CONTEXTS at most.
DEPTH, CONTEXTS = 4, 1_000
#: Weight of the shorter context in the smoothing.
BACK_OFF = 4.0
#: One rule URL in so many is kept for calibration.
HELD_OUT = 5
#: States take the low bits of a cell; more than DEPTH * CONTEXTS + 1.
_STATES = 8_192

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path, of the URL in column ``url``; both empty for null or without ``://``."""
    rest = F.expr(f"if(instr(`{url}`, '://') > 0, substring(`{url}`, instr(`{url}`, '://') + 3), '')")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as a struct of verdict and rule, or null."""
    out = None
    for verdict, rule_host, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(start)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + start).alias("rule"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def symbols(host: Column, path: Column) -> Column:
    """The modelled string: host and path in the models' symbols between a start and an end mark."""
    plain = F.translate(F.concat(host, path), UPPER, LOWER)
    return F.concat(F.lit("^"), F.regexp_replace(plain, r"(?s)[^a-z0-9/.\-_]", "~"), F.lit("$"))


def held_out(url: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(url, F.lit(""))), 1, 8), 16, 10).cast("long") % HELD_OUT == 0


def grams(text: str) -> Column:
    """Every symbol after the start mark with each of its contexts of up to DEPTH symbols before it."""
    return F.expr(f"flatten(transform(sequence(2, length({text})), i -> transform(sequence(0, least({DEPTH}, i - 1)), k -> substring({text}, i - k, k + 1))))")


def automaton(counts: DataFrame) -> tuple[list[int], int]:
    """The cells of all states and symbols, ratio * _STATES + next state, and the start state, from counts (``gram``, ``good``, ``bad``).

    There are at most DEPTH * CONTEXTS + 1 states, whatever the input is.
    """
    spark = counts.sparkSession
    split = counts.select(F.expr("left(gram, length(gram) - 1)").alias("context"), F.expr("right(gram, 1)").alias("symbol"), "good", "bad")
    empty = spark.range(1).select(F.lit("").alias("context"), F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("bad"))
    total = split.filter("context = ''").agg(F.coalesce(F.sum(F.col("good") + F.col("bad")), F.lit(0))).first()[0]
    found = split.select("context", "good", "bad").unionByName(empty).groupBy("context").agg(F.sum("good").alias("good_n"), F.sum("bad").alias("bad_n"))
    found = found.filter((F.col("good_n") + F.col("bad_n")) * CONTEXTS >= total)
    states = materialise(found.withColumn("state", F.row_number().over(Window.orderBy(F.length("context"), "context")) - 1), "states")
    cells = states.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SIZE - 1)))).withColumn("symbol", F.substring(F.lit(ALPHABET), F.col("at") + 1, F.lit(1)))
    cells = materialise(cells.join(split, ["context", "symbol"], "left").na.fill(0, ["good", "bad"]), "cells")

    def likelihood(side: str, lower: Column) -> Column:
        return (F.col(side).cast("double") + BACK_OFF * lower) / (F.col(f"{side}_n").cast("double") + BACK_OFF)

    of = lambda k: cells.filter(F.length("context") == k)
    levels = [of(0).withColumns({f"{x}_p": likelihood(x, F.lit(1.0 / SIZE)) for x in ("good", "bad")})]
    for k in range(1, DEPTH + 1):
        lower = levels[-1].select(F.col("context").alias("rest"), "symbol", F.col("good_p").alias("good_q"), F.col("bad_p").alias("bad_q"))
        level = of(k).withColumn("rest", F.expr("substring(context, 2)")).join(lower, ["rest", "symbol"])
        levels.append(level.withColumns({f"{x}_p": likelihood(x, F.col(f"{x}_q")) for x in ("good", "bad")}).drop("rest", "good_q", "bad_q"))
    ratio = F.round(1000 * (F.log("good_p") - F.log("bad_p"))).cast("long")
    out = levels[0].select("state", "at", "context", "symbol", ratio.alias("ratio"))
    for level in levels[1:]:
        out = out.unionByName(level.select("state", "at", "context", "symbol", ratio.alias("ratio")))
    follows = F.concat("context", "symbol")
    for k in range(DEPTH + 1):
        there = states.filter(F.length("context") == k).select(F.col("context").alias(f"c{k}"), F.col("state").alias(f"s{k}"))
        out = out.join(F.broadcast(there), (F.length(follows) >= k) & (F.expr(f"right(concat(context, symbol), {k})") == F.col(f"c{k}")), "left")
    out = out.select("state", "at", (F.col("ratio") * _STATES + F.coalesce(*[F.col(f"s{k}") for k in range(DEPTH, -1, -1)])).alias("cell"))
    start = {r.context: r.state for r in states.filter("context in ('', '^')").collect()}
    return [r.cell for r in out.orderBy("state", "at").collect()], start.get("^", start[""])


def total_ratio(text: str, cells: list[int], start: int) -> Column:
    """The sum of the log ratios of all symbols of column ``text``, in thousandths."""
    table = F.split(F.lit(",".join(map(str, cells))), ",").cast("array<long>")
    codes = F.expr(f"transform(split(substring({text}, 2), ''), c -> instr('{ALPHABET}', c) - 1)")
    low = lambda x: x.bitwiseAND(F.lit(_STATES - 1).cast("long"))
    walked = F.aggregate(codes, F.lit(start).cast("long"), lambda acc, x: acc - low(acc) + F.get(table, (low(acc) * SIZE + x).cast("int")))
    return F.shiftright(walked, _STATES.bit_length() - 1)


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple = RULES) -> DataFrame:
    """Host, path, fitting rule and verdict of every URL; one row per row of ``pages``.

    Null URLs and URLs without ``://`` have an empty host and path, fit no
    rule and are judged by the models as the empty string.  Where the rules
    accept no URL, or reject none, there is nothing to compare: URLs without a
    rule are allowed and ``score`` is null.  Where one side has no held-out
    URL, all of its URLs calibrate it.  Equal URLs get equal verdicts; URLs of
    any length are judged whole; an empty table gives no rows; other columns
    are not read.

    The models' table is of bounded size whatever the input is, so it is taken
    to the driver and sent out as a constant; counting combines before the
    shuffle, and no other step shuffles.
    """
    host, path = host_and_path("url")
    judged = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url")).select("page_id", host.alias("host"), path.alias("path"), held_out(F.col("url")).alias("held"))
    judged = judged.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("text", symbols(F.col("host"), F.col("path")))

    good = F.col("verdict") == "allow"
    taught = judged.filter("fit is not null and not held").select("fit.verdict", F.explode(grams("text")).alias("gram"))
    counts = materialise(taught.groupBy("gram").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad")), "grams")
    scored = judged.withColumn("score", F.floor(total_ratio("text", *automaton(counts)) * 1000.0 / (F.length("text") - 1)))
    threshold = calibrated(scored)
    model, score = F.lit("allow"), F.lit(None).cast("long")
    if threshold is not None:
        model, score = F.when(F.col("score") >= threshold, "allow").otherwise("block"), F.col("score")
    return scored.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), model).alias("verdict"), score.alias("score"))


def calibrated(scored: DataFrame) -> float | None:
    """The threshold half-way between the mean scores of accepted and rejected held-out rule URLs; none if a side has no URL."""
    sums = scored.filter("fit is not null").groupBy("fit.verdict").agg(F.sum("score").alias("total"), F.count("*").alias("n"), F.sum(F.when(F.col("held"), F.col("score"))).alias("held_total"), F.count_if("held").alias("held_n"))
    means = {r.verdict: r.held_total / r.held_n if r.held_n else r.total / r.n for r in sums.collect()}  # two rows
    return (means["allow"] + means["block"]) / 2 if len(means) == 2 else None
