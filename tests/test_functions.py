"""Column builders on literals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import numeric, text, tokens
from tidemark.functions.sampling import hash_uniform, keep_at_rate


def value(spark, column, **inputs):
    df = spark.createDataFrame([tuple(inputs.values()) or (0,)], list(inputs) or ["_"])
    return df.select(column.alias("x")).first().x


STREAM = "<seed2> 1 2 </seed2> <seed2> 3 </seed2> <cosmos> 4 x 5 </cosmos><caption> hi </caption> <avc_lm> 9 </avc_lm> <agent> 7 </agent> <cosmos> 8 </cosmos>"


def test_parse_keeps_order(spark):
    got = value(spark, tokens.parse_blocks(F.lit(STREAM)))
    assert [(b.pos, b.kind) for b in got] == list(enumerate(["seed2", "seed2", "cosmos", "caption", "avc_lm", "agent", "cosmos"]))


def test_fold_overwrites_flushes_and_drops_the_tail(spark):
    got = value(spark, tokens.fold_stream(tokens.parse_blocks(F.lit(STREAM))))
    assert got == ["<caption> hi </caption>", "<seed2> <seed2_3> </seed2>", "<cosmos> <cosmos_4> <cosmos_5> </cosmos>", "<agent> <agent_7> </agent>"]


def test_empty_stream(spark):
    assert value(spark, tokens.fold_stream(tokens.parse_blocks(F.lit("")))) == []


def test_counts_and_renaming(spark):
    t = F.lit("a <seed_1> b <seed_22> <cosmos_3>")
    assert value(spark, tokens.family_count(t, "seed")) == 2
    assert value(spark, tokens.plain_word_count(t)) == 2
    assert value(spark, tokens.rename_family(t, "seed", "seed2")) == "a <seed2_1> b <seed2_22> <cosmos_3>"
    assert value(spark, tokens.family_ids(t, "seed")) == [1, 22]


@pytest.mark.parametrize(("token", "family"), [("<seed2_1>", "seed2"), ("<x_3>", "agent"), ("</agent>", "marker"), ("word", "text"), ("<snac_130000>", "snac")])
def test_classifier(spark, token, family):
    assert value(spark, tokens.classify_token(F.lit(token))) == family


def test_balance(spark):
    assert value(spark, tokens.tags_balanced(F.lit("<agent> </agent>"), "agent")) is True
    assert value(spark, tokens.tags_balanced(F.lit("<agent> "), "agent")) is False


def test_codec_round_trip_and_band_errors(spark):
    arrays = [F.array(*map(F.lit, a)) for a in ([0, 4095], [1, 2, 3, 4], [5, 6, 7, 8, 9, 10, 11, 12])]
    packed = tokens.pack_speak(*arrays)
    assert value(spark, packed)[:7] == [128266, 132362 + 1, 136458 + 5, 140554 + 6, 144650 + 2, 148746 + 7, 152842 + 8]
    back = value(spark, tokens.unpack_codec(packed, tokens.SPEAK_BANDS))
    assert [b.value for b in back][7:] == [4095, 3, 9, 10, 4, 11, 12] and all(b.valid for b in back)
    bad = value(spark, tokens.unpack_codec(F.array(F.lit(128265), F.lit(132362 + 4096), F.lit(144650)), tokens.LISTEN_BANDS))
    assert [b.valid for b in bad] == [False, False, True]
    assert value(spark, tokens.pack_listen(*[F.array().cast("array<bigint>")] * 3)) == []


@pytest.mark.parametrize(("clock", "seconds"), [("00:01:02.500", 62.5), ("bad", 0.0), ("1:2", 0.0), (None, 0.0), ("a:b:c", 0.0)])
def test_clock(spark, clock, seconds):
    assert value(spark, text.clock_seconds(F.lit(clock).cast("string"))) == seconds


@pytest.mark.parametrize(("clock", "seconds"), [("01:30", 90), ("1:00:01", 3601), ("x", None), ("1:2", None)])
def test_short_clock(spark, clock, seconds):
    assert value(spark, text.short_clock_seconds(F.lit(clock))) == seconds


@pytest.mark.parametrize(("t", "bad"), [("", True), (None, True), ("ab" * 20, True), ("ab" * 19 + "a", False), ("aaaaaaaaaaaaaaaaaéé£", False), ("ééa", True), ("plain words here", False)])
def test_garbled(spark, t, bad):
    assert value(spark, text.is_garbled(F.lit(t).cast("string"))) is bad


def test_sentences_are_cut(spark):
    t = "One two. " + " ".join(["w"] * 45) + "! End"
    assert [len(c.split()) for c in value(spark, text.sentence_chunks(F.lit(t)))] == [2, 20, 20, 5, 1]


def test_images_and_tags(spark):
    t = F.lit("<p>A <img src='x.png'> b ![c](y.jpg) <img src=\"x.png\"></p>")
    assert value(spark, text.image_sources(t)) == ["x.png", "y.jpg"]
    assert value(spark, text.strip_tags(F.lit("<p>A  <b>b</b>\n</p>"))) == "A b"


def test_templates(spark):
    assert value(spark, text.lettered_options(F.array(F.lit("x"), F.lit("y")))) == "A. x\nB. y"
    assert value(spark, text.chat_turn(F.lit("hi"), F.lit("yo"), F.lit("calm"))) == "USER: hi [Voice: calm] ASSISTANT:\nyo"
    assert value(spark, text.clean_joins(F.lit("a . b ,  c .."))) == "a. b, c."


@pytest.mark.parametrize(("n", "shown"), [(12, "12"), (1500, "1.50K"), (2_000_000, "2.00M"), (8_290_000_000, "8.29B")])
def test_human_count(spark, n, shown):
    assert value(spark, text.human_count(F.lit(n))) == shown


def test_scripts_and_ids(spark):
    assert value(spark, text.script_of(F.lit("漢字かな"))) == "ja"
    assert value(spark, text.script_of(F.lit("漢字"))) == "zh"
    assert value(spark, text.tube_id(F.lit("dQw4w9WgXcQ_seed2"))) == "dQw4w9WgXcQ"
    assert value(spark, text.url_extension(F.lit("http://a.b/c/d.JPG?x=1"))) == "jpg"


def test_ngrams_and_triples(spark):
    w = F.split(F.lit("a a a b a"), " ")
    assert value(spark, text.ngrams(w, 3)) == ["a a a", "a a b", "a b a"]
    assert value(spark, text.ngrams(F.array(F.lit("a")), 3)) == []
    assert value(spark, text.collapse_triples(w)) == ["a", "a", "b", "a"]


def test_quantise_is_half_even_and_clipped(spark):
    for x in (-3.0, -2.0, 0.0, 0.5 / 255 * 4 - 2, 1.5 / 255 * 4 - 2, 2.0, 9.0):
        assert value(spark, numeric.quantise(F.lit(x))) == int(np.clip(np.rint((x + 2) / 4 * 255), 0, 255))
    assert abs(value(spark, numeric.dequantise(F.lit(200))) - (200 / 255 * 4 - 2)) < 1e-12


def test_control_points_prefer_the_later_of_equals(spark):
    xs = F.array(*[F.lit(float(v)) for v in (0, 1, 0, 1, 0, 1, 0, 0)])
    assert value(spark, numeric.control_points(xs, F.lit(4))) == [0, 4, 5, 7]
    assert value(spark, numeric.control_points(xs, F.lit(2))) == [0, 7]
    assert value(spark, numeric.tier(F.lit(0.0049))) == 2 and value(spark, numeric.tier(F.lit(0.005))) == 4 and value(spark, numeric.tier(F.lit(0.05))) == 8


def test_pchip_is_monotone_and_exact():
    t, y = np.array([0, 2, 3, 7]), np.array([0.0, 1.0, 1.5, 1.6])
    at = np.linspace(0, 7, 71)
    got = numeric.pchip(t, y, at)
    assert np.allclose(numeric.pchip(t, y, t), y) and (np.diff(got) >= -1e-12).all()
    assert np.allclose(numeric.pchip([0, 1, 2], [0, 1, 2], [0.5, 1.5]), [0.5, 1.5])
    assert (numeric.pchip([3], [5.0], at) == 5).all()


def test_hash_uniform_is_fixed(spark):
    assert value(spark, hash_uniform(F.lit("a"))) == 214005177 / 4294967296
    assert value(spark, keep_at_rate(1.0, F.lit("a"))) is False
    assert value(spark, keep_at_rate(0.0, F.lit("a"))) is True


def test_ids_over_the_limit_are_counted(spark):
    t = "<seed2_8191> <seed2_8192> <cosmos_64000> <avc_lm_8191> <agent_256> <agent_99999999999999999999> <other_999999>"
    assert value(spark, tokens.over_limit_count(F.col("t")), t=t) == 4
