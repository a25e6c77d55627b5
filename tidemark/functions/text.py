"""Column builders for text, time strings and web data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tokens import words


def clock_seconds(text: Column) -> Column:
    """``HH:MM:SS.mmm`` in seconds; 0 for anything else."""
    parts = F.split(F.coalesce(text, F.lit("")), ":")
    value = F.get(parts, F.lit(0)).try_cast("double") * 3600 + F.get(parts, F.lit(1)).try_cast("double") * 60 + F.get(parts, F.lit(2)).try_cast("double")
    return F.coalesce(F.when(F.size(parts) == 3, value), F.lit(0.0))


def short_clock_seconds(text: Column) -> Column:
    """``MM:SS`` or ``HH:MM:SS`` in seconds, else null."""
    pattern = r"^(?:(\d+):)?(\d{1,2}):(\d{2})$"
    part = lambda k: F.coalesce(F.regexp_extract(text, pattern, k).try_cast("bigint"), F.lit(0))
    return F.when(text.rlike(pattern), part(1) * 3600 + part(2) * 60 + part(3))


def is_garbled(text: Column, threshold: float = 0.15, least_distinct: float = 0.15) -> Column:
    """Empty, more than ``threshold`` non-ASCII, or 40 characters or more with few distinct ones."""
    n = F.length(text)
    foreign = F.length(F.regexp_replace(text, r"[\x00-\x7F]", "")) / n
    distinct = F.size(F.array_distinct(F.split(text, ""))) / n
    return F.coalesce((n == 0) | (foreign > threshold) | ((n >= 40) & (distinct < least_distinct)), F.lit(True))


def sentence_chunks(text: Column, most: int = 20) -> Column:
    """Sentences (cut after . ! ? and white space), each cut into chunks of at most ``most`` words."""
    sentences = F.filter(F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+"), lambda s: F.trim(s) != "")

    def cut(sentence: Column) -> Column:
        w = words(sentence)
        starts = F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1)), F.lit(most))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, most), " "))

    return F.filter(F.flatten(F.transform(sentences, cut)), lambda c: c != "")


def strip_tags(html: Column) -> Column:
    """Text without tags, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]*>", " "), r"[ \t\n\r\f]+", " "))


def image_sources(text: Column) -> Column:
    """The sources of ``<img>`` tags, then of markdown images, without repeats."""
    tags = F.regexp_extract_all(text, F.lit(r"""<img[^>]*\bsrc=["']([^"']+)["']"""), 1)
    return F.array_distinct(F.concat(tags, F.regexp_extract_all(text, F.lit(r"!\[[^\]]*\]\(([^)\s]+)"), 1)))


def script_of(text: Column) -> Column:
    """The first script found, by code-point range, in fixed order of priority."""
    out = None
    for name, chars in (("ja", "[぀-ヿ]"), ("ko", "[가-힣]"), ("zh", "[一-鿿]"), ("th", "[฀-๿]"), ("jv", "[ꦀ-꧟]")):
        out = F.when(text.rlike(chars), name) if out is None else out.when(text.rlike(chars), name)
    return out.otherwise("other")


def human_count(n: Column) -> Column:
    """K, M or B with two decimals; small numbers as they are."""
    scaled = lambda d, u: F.concat(F.format_string("%.2f", n / d), F.lit(u))
    return F.when(n >= 1e9, scaled(1e9, "B")).when(n >= 1e6, scaled(1e6, "M")).when(n >= 1e3, scaled(1e3, "K")).otherwise(n.cast("string"))


def lettered_options(options: Column) -> Column:
    """``A. first``, ``B. second`` ... one a line; options past Z are left out."""
    return F.array_join(F.transform(F.slice(options, 1, 26), lambda o, i: F.concat(F.char(i + 65), F.lit(". "), o)), "\n")


def chain(answers: Column) -> Column:
    return F.array_join(answers, " -> ")


def chat_turn(user: Column, assistant: Column, voice: Column | None = None) -> Column:
    """``USER: ... [Voice: ...] ASSISTANT:`` and the answer on the next line."""
    parts = [F.concat(F.lit("USER: "), user)]
    if voice is not None:
        parts.append(F.concat(F.lit("[Voice: "), voice, F.lit("]")))
    return F.concat(F.concat_ws(" ", *parts, F.lit("ASSISTANT:")), F.lit("\n"), assistant)


def clean_joins(text: Column) -> Column:
    """Remove the punctuation that composing leaves, in this order."""
    for old, new in ((" .", "."), (" ,", ","), ("..", "."), ("  ", " ")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def url_extension(url: Column) -> Column:
    """The extension of the last path element in lower case, or empty."""
    return F.lower(F.regexp_extract(url, r"^[^?#]*/[^/?#]*\.([A-Za-z0-9]{1,5})(?:[?#]|$)", 1))


def tube_id(name: Column) -> Column:
    """The first 11 characters if they are of [A-Za-z0-9_-], after a ``_seed2`` ending is dropped."""
    return F.regexp_extract(F.regexp_replace(name, "_seed2$", ""), "^([A-Za-z0-9_-]{11})", 1)


def ngrams(w: Column, n: int, last: bool = True) -> Column:
    """All n-grams of an array of words, joined by a space; without ``last``, all but the last one."""
    fewer = n - 1 if last else n
    grams = F.transform(F.sequence(F.lit(1), F.size(w) - fewer), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.when(F.size(w) > fewer, grams).otherwise(F.array().cast("array<string>"))


#: Replacements that turn spoken text into sentences, in this order.
SPOKEN = (
    ("it's", ". It's"), (" sorry", ". Sorry"), (" um ", ". "), (" uh ", ". "), (" ugh ", " . "), (" uhm ", " . "),
    ("Okay", ". "), ("okay", ". "), ("yeah", ". "), ("Yeah", ". "), (" hey ", ". Hey"), (" so ", ". So "),
    (" let's", ". Let's"), (" and ", ". And "), (" I'", ". I'"), (" I am", ". I am"), (" I will", ". I will"),
    (" An", ". An"), (" It", ". It"), (" She", ". She"), (" He", ". He"), (" Th", ". Th"),
    (". And. ", ". And"), (" .", "."), ("..", "."), (",.", "."),
)


def punctuate(text: Column) -> Column:
    """Spoken text with full stops for fillers and joints, none at its start."""
    for old, new in SPOKEN:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.regexp_replace(text, r"^[. ]+", "")


def images_to_tokens(text: Column, blocks: Column) -> Column:
    """Image tags and markdown images replaced by `` <BOI> block <EOI> `` where the map ``blocks`` (file name to block) has their file.

    Each distinct tag is looked up once and replaced everywhere.
    """
    tags = F.array_distinct(F.regexp_extract_all(text, F.lit(r"""(<img[^>]+src="[^">]+"[^>]*>|!\[.*?\]\(.*?\))"""), 1))

    def step(acc: Column, tag: Column) -> Column:
        source = F.coalesce(F.nullif(F.regexp_extract(tag, r"""<img[^>]+src="([^">]+)\"""", 1), F.lit("")), F.regexp_extract(tag, r"!\[.*?\]\((.*?)\)", 1))
        block = F.try_element_at(blocks, F.regexp_extract(source, "([^/]*)$", 1))
        return F.when(block.isNotNull(), F.replace(acc, tag, F.concat(F.lit(" <BOI> "), block, F.lit(" <EOI> ")))).otherwise(acc)

    return F.aggregate(tags, text, step)


def collapse_triples(w: Column) -> Column:
    """Words without those equal to both words before them."""
    return F.filter(w, lambda x, i: ~F.coalesce((i >= 2) & (x == F.get(w, i - 1)) & (x == F.get(w, i - 2)), F.lit(False)))
