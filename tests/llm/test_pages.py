"""Main text and URL verdicts."""

import hashlib
import math
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import templates, urlmodel


def page(article, extra=""):
    return (
        "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t=\"</p>\";</script></head><body><nav><ul><li><a href='/x'>Menu</a></li></ul></nav>"
        f"<!-- ad 1 --><div class=\"ad\">Buy</div><div id='cookie-notice'>We use cookies</div>{article}<aside>Side</aside><section class=comments><p>Nice one</p></section>{extra}<footer>&copy; me</footer></body></html>"
    )


def test_article_without_its_surroundings():
    got = templates.main_texts([page(f"<article><h1>Head {i}</h1><p><b>One &lt;two&gt;<br><p>three\n  four&nbsp;five<ul><li>a<li>b</ul></article>") for i in range(3)])
    assert got == [f"Head {i}\nOne <two>\nthree four five\na\nb" for i in range(3)]


def test_words_that_all_articles_share_stay():
    same = "<article><p>The same words</p><p>every time</p></article>"
    assert templates.main_texts([page(same)] * 5) == ["The same words\nevery time"] * 5


def test_without_an_article_the_template_goes():
    pages = [f"<body><div class=top>Welcome here</div><div class=body><p>text {c}<p>more {c * 2}</div><form>find</form></body>" for c in "abc"]
    assert templates.main_texts(pages) == [f"text {c}\nmore {c * 2}" for c in "abc"]


@pytest.mark.parametrize(("html", "text"), [(None, ""), ("", ""), ("plain < text &lt;", "plain < text <"), ("<p>a</p", "a</p"), ("<div>x<!-- open", "x"), ("<script>never closed", ""), ("<article>" + "<p>w" * 3000, "\n".join(["w"] * 3000))])
def test_broken_pages(html, text):
    assert templates.main_texts([html]) == [text]


def test_classes_keep_order_and_nest():
    pages = [templates.tokens(f"<body><ul>{'<li>x</li>' * n}</ul><p>a</p></body>") for n in (2, 3, 5)]
    fixed, depth = templates.template(pages)
    items = [d for (kind, what, _), d in depth.items() if what == "li"]
    outer = [d for (kind, what, _), d in depth.items() if what == "ul"]
    assert items and outer and items[0] == outer[0] + 1


def test_pages_through_spark(spark):
    rows = [(i, f"http://h{i % 3}.example.com/{i}", page(f"<article><p>text {i}</p></article>")) for i in range(30)]
    rows += [(7, rows[7][1], rows[7][2]), (100, None, None), (101, "no host", ""), (None, "http://h1.example.com/", page("<article>n</article>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as part", "3 as text", "4 as n")
    got = templates.extract_main_text(df, group_pages=4).collect()
    assert len(got) == len(rows)
    assert sorted(repr((r.page_id, r.text, r.n_chars)) for r in got) == sorted(repr((i, t, len(t))) for i, t in [(i, f"text {i}") for i in [*range(30), 7]] + [(100, ""), (101, ""), (None, "n")])
    assert templates.extract_main_text(df.filter("page_id = -1")).count() == 0


def test_words_of_names_drop_no_article():
    pages = [f'<body><div class="layout-with-sidebar"><article><div class="entry-header"><h1>Head {i}</h1></div><section id="form-of-government"><p>text {i}</section><div class="ad">buy {i}</div></article></div></body>' for i in range(4)]
    assert templates.main_texts(pages) == [f"Head {i}\ntext {i}" for i in range(4)]
    assert templates.main_texts(pages[:1]) == ["Head 0\ntext 0"]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 10, 40])
def test_what_articles_share_stays_on_any_number_of_pages(n):
    pages = [page(f"<article><h2>Introduction</h2><p>unique {i}</p><h2>See also</h2><p>All rights of man.</p></article>") for i in range(n)]
    assert templates.main_texts(pages) == [f"Introduction\nunique {i}\nSee also\nAll rights of man." for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_readers_comments_go_on_any_number_of_pages(n):
    inner = ["<div class='comments'><p>first!</p></div>", "<div id='comments-wrapper'><p>nice</p></div>", "<article class=comment>me too</article>", "<ol class='commentlist'><li>so long a comment that it is longer than the text</ol>"]
    pages = [f"<body><article><h1>Head {i}</h1><p>text {i} and more of it, as an article has</p>{''.join(inner)}</article></body>" for i in range(n)]
    assert templates.main_texts(pages) == [f"Head {i}\ntext {i} and more of it, as an article has" for i in range(n)]


def several(n, tag="article"):
    return [f"<html><body><nav><a href=/a>One {i}</a><a>Two</a></nav><div class=x1>buy {'it' * (i % 3)} now</div><div class=wrap><{tag} class=q><h1>Head {i}</h1>{''.join(f'<p>text {i} {k} of some length' for k in range(1 + i % 4))}</{tag}></div><div class=y>me {i}</div></body></html>" for i in range(n)]


def test_the_template_decides_without_tags_and_words(monkeypatch):
    want = ["\n".join([f"Head {i}", *(f"text {i} {k} of some length" for k in range(1 + i % 4))]) for i in range(12)]
    assert templates.main_texts(several(12)) == want
    assert templates.main_texts(several(12, "div")) == want
    assert all(templates.main_text(templates.tokens(p), templates.Template(0, (), set())) != w for p, w in zip(several(12), want, strict=True))
    for name in ("BOILERPLATE", "MAIN", "BOILERPLATE_WORDS", "COMMENT_WORDS", "START_WORDS"):
        monkeypatch.setattr(templates, name, frozenset())
    templates._named.cache_clear()
    assert templates.main_texts(several(12)) == want
    templates._named.cache_clear()


def test_pages_without_the_main_element_of_their_host():
    pages = [*several(6), "<html><body><nav><a>One</a></nav><p>not found</p></body></html>", "loose text"]
    assert templates.main_texts(pages)[-2:] == ["not found", "loose text"]


@pytest.mark.parametrize("piece", ["<div>", "<a ", '<a "', "<a '>\"", "<![CDATA[", "<!--", "<p><table><tr><td><div>", "<div class=ad>", "</div>", "<li>", "<b>", "<", '<a ">"', "<ul><li><p>", "<td>", "x < y "])
def test_broken_markup_takes_time_in_proportion(piece):
    page = (piece * (400_000 // len(piece))) + "end"
    before = time.process_time()
    text = templates.main_texts([page])[0]
    assert time.process_time() - before < 20 and text is not None


def test_spark_gives_what_one_host_at_a_time_gives(spark):
    rows = [(100 * h + i, f"http://h{h}.org/{i}", p) for h, n in enumerate((1, 2, 3, 9, 70)) for i, p in enumerate(several(n, "article" if h % 2 else "section"))]
    rows += [(9000 + i, "http://h4.org/copy", several(3, "article")[2]) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {}
    for h in range(5):
        own = [r for r in rows if f"//h{h}." in r[1]]
        want |= dict(zip([r[0] for r in own], templates.main_texts([r[2] for r in own]), strict=True))
    for n in (5, 64):
        assert {r.page_id: r.text for r in templates.extract_main_text(df, group_pages=n).collect()} == want


def test_template_is_of_all_pages_of_a_host(spark):
    html = lambda c: f"<body><div class=top>Welcome here</div><div class=body><p>text {c}</div></body>"
    rows = [(i, f"http://one.org/{i}", html(i)) for i in range(66)]
    rows += [(100 + i, f"http://two.org/{i}", html("copied" if i < 40 else f"w{i}")) for i in range(60)]
    rows += [(1000 + i, f"http://hot.org/{i}", html(f"h{i}")) for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted((i, h.split("<p>")[1].split("<")[0]) for i, _, h in rows)
    for n in (7, templates.GROUP_PAGES):
        assert sorted((r.page_id, r.text) for r in templates.extract_main_text(df, group_pages=n).collect()) == want


def test_tokens_out_of_order_leave_the_class():
    pages = [templates.tokens(f"<body><i>x</i><b>y</b><p>{k}</p></body>" if k % 2 else f"<body><b>y</b><i>x</i><p>{k}</p></body>") for k in range(4)]
    made = templates._template(pages)
    assert len({c for c, _, _ in made.place.values()}) == 1
    assert {"b", "i"} - {what for kind, what, _ in templates.template(pages)[0] if kind == 0}


URLS = ["http://a.example.com/en/7", "https://www.B.com/en/x?q=1", "http://example.com/en/7abc#t", "http://example.net/de/81", "ftp://x.net/de/9", "http://y.org/es/", "http://z.org", "noscheme/en/", None, "", "http://com/en/", "http://notcom/en/7", "HTTP://Ü.COM/en/", "http://a.example.com/en/6"]


def rule_of(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(h + p, v) for v, h, p in urlmodel.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda r: len(r[0])) if fits else (None, None))


def test_rules_hosts_and_paths(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").selectExpr("*", "1 as host", "2 as score", "3 as codes")
    for r in urlmodel.judge_urls(df).collect():
        host, path, rule, verdict = rule_of(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert urlmodel.judge_urls(df.filter("page_id < 0")).count() == 0


def test_rules_are_those_of_the_contract(spark):
    assert {(h + p, v) for v, h, p in urlmodel.RULES} == {("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")}
    want = {"http://x.net/de/9": "allow", "http://example.net/de/7": "allow", "http://a.example.net/de/8": "block", "http://example.com/en/7": "allow", "http://example.com/en/6": "block", "http://y.org/es/": "block"}
    got = urlmodel.judge_urls(spark.createDataFrame(list(enumerate(want)), "page_id long, url string"))
    assert {(r.page_id, r.verdict) for r in got.collect()} == set(enumerate(want.values()))


def test_model_matches_plain_python(spark):
    urls = [f"http://{h}.{d}/{c}/{n}" for n in (7, 71, 8, 12) for h in ("ab", "cd", "spam-x") for d in ("example.com", "example.net", "other.org") for c in ("en", "de", "fr")]
    got = urlmodel.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    a, weight = urlmodel.ALPHABET, urlmodel.BACK_OFF
    held = {u for u in urls if int(hashlib.md5(u.encode()).hexdigest()[:8], 16) % urlmodel.HELD_OUT == 0}

    def text(url):
        return "^" + "".join(c if c in a[3:] else "~" for c in "".join(rule_of(url)[:2])) + "$"

    counts = {"allow": Counter(), "block": Counter()}
    for u in urls:
        if rule_of(u)[3] and u not in held:
            t = text(u)
            counts[rule_of(u)[3]].update(t[i - k : i + 1] for i in range(1, len(t)) for k in range(min(i, urlmodel.DEPTH) + 1))
    followed = {v: Counter() for v in counts}
    for v, c in counts.items():
        for g, n in c.items():
            followed[v][g[:-1]] += n
    total = sum(followed[v][""] for v in counts)
    known = {c for v in counts for c in followed[v] if sum(followed[x][c] for x in counts) * urlmodel.CONTEXTS >= total}
    assert {len(c) for c in known} == set(range(urlmodel.DEPTH + 1))

    def likelihood(side, context, symbol):
        lower = likelihood(side, context[1:], symbol) if context else 1 / len(a)
        return (counts[side][context + symbol] + weight * lower) / (followed[side][context] + weight)

    def score(url):
        t, out = text(url), 0
        for i in range(1, len(t)):
            context = next(t[i - k : i] for k in range(min(i, urlmodel.DEPTH), -1, -1) if t[i - k : i] in known)
            out += round(1000 * (math.log(likelihood("allow", context, t[i])) - math.log(likelihood("block", context, t[i]))))
        return math.floor(out * 1000 / (len(t) - 1))

    scores = {u: score(u) for u in urls}
    mean = {v: sum(scores[u] for u in held if rule_of(u)[3] == v) / sum(rule_of(u)[3] == v for u in held) for v in counts}
    for r in got:
        url = urls[r.page_id]
        assert r.score == scores[url]
        assert r.verdict == (rule_of(url)[3] or ("allow" if r.score >= sum(mean.values()) / 2 else "block"))
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}


def test_rare_contexts_are_shortened(spark, monkeypatch):
    monkeypatch.setattr(urlmodel, "CONTEXTS", 8)
    counts = [("aab", 9, 9), ("ab", 9, 9), ("b", 9, 9), ("a", 9, 9), ("c", 1, 0), ("bc", 1, 0), ("abc", 1, 0)]
    cells, start = urlmodel.automaton(spark.createDataFrame(counts, "gram string, good long, bad long"))
    states = ["", "a", "aa"]  # "b" and "ab" are followed once in 37 symbols
    assert len(cells) == len(states) * urlmodel.SIZE and start == 0
    at = lambda s, x: cells[s * urlmodel.SIZE + urlmodel.ALPHABET.index(x)] % 8192
    assert (at(0, "a"), at(1, "a"), at(2, "a"), at(2, "b"), at(1, "c")) == (1, 2, 2, 0, 0)


def test_one_sided_rules_allow_the_rest(spark):
    df = spark.createDataFrame([(1, "http://x.org/es/1"), (2, "http://x.org/de/1"), (3, None)], "page_id long, url string")
    assert {(r.page_id, r.verdict, r.score) for r in urlmodel.judge_urls(df).collect()} == {(1, "block", None), (2, "allow", None), (3, "allow", None)}


def brute_classes(pages):
    """Classes by whole occurrence vectors: tokens on half of the distinct pages or more, in an order that all pages keep."""
    distinct = {}
    for page in pages:
        key, seq, _ = templates.features(page)
        if key not in distinct or np.array(seq, np.int64).tobytes() < np.array(distinct[key], np.int64).tobytes():
            distinct[key] = seq
    keys = sorted(distinct)
    places = {}
    for k in keys:
        for at, t in enumerate(distinct[k]):
            places.setdefault(t, {}).setdefault(k, []).append(at)
    by_vector = {}
    for t, on in places.items():
        if len(on) >= templates.SUPPORT * len(keys):
            by_vector.setdefault(tuple(len(on.get(k, ())) for k in keys), []).append(t)
    out = set()
    for members in by_vector.values():
        first = lambda t: next((k, places[t][k][0]) for k in keys if k in places[t])
        ordered = []
        for t in sorted(members, key=first):
            if all(x < y for a in ordered for k in places[t] for x, y in zip(places[a][k], places[t][k], strict=True)):
                ordered.append(t)
        out.add(tuple(ordered))
    return out


PIECES = st.sampled_from(["<div>", "</div>", "<p class='a'>", "</p>", "<ul><li>", "</li></ul>", "home", "about us", "story one", "story two", "<nav>menu</nav>", "<footer>", "</footer>", "x"])


@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=1, max_size=7))
@settings(max_examples=300, deadline=None)
def test_classes_match_brute_force(htmls):
    pages = [templates.tokens(h) for h in htmls]
    made = templates._template(pages)
    classes = {}
    for t, (c, i, size) in made.place.items():
        classes.setdefault(c, {})[i] = t
        assert i < size
    assert {tuple(m[i] for i in sorted(m)) for m in classes.values()} == brute_classes(pages)


def nested(page, place):
    """Depth of each token by looking for the innermost open class it continues."""
    out, stack = [], []
    for t in page:
        if t not in place:
            out.append(-1)
            continue
        c, i, size = place[t]
        level = max((k for k, (d, _) in enumerate(stack) if d == c), default=None)
        if level is None:
            if i:
                out.append(-1)
                continue
            level = len(stack)
        elif 0 < i <= stack[level][1]:
            out.append(-1)
            continue
        stack = stack[:level] + ([(c, i)] if i < size - 1 else [])
        out.append(level)
    return out


@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=3, max_size=7))
@settings(max_examples=200, deadline=None)
def test_nesting_matches_brute_force(htmls):
    pages = [templates.tokens(h) for h in htmls]
    made = templates._template(pages)
    for page in pages:
        seq = templates._hashes(page)
        assert made.depths(seq) == nested(seq, made.place)
