"""Main text of web pages by equivalence-class template deduction.

A token is a tag, comment or text with the path of elements it stands in.  The
template of a host is deduced from all its distinct pages, however they are
dealt over tasks; pages with the same content count once.  Tokens with the
same occurrence vector (how often they occur on each page) form an equivalence
class; a class is valid if it occurs on enough pages, and its tokens keep their
order on all of them (those that break it leave the class).  On a page the
classes nest, one in a gap between two tokens of another; tokens that overlap
are no part of the template there.  What remains between are the slots.

Each slot is judged by the host's pages together.  What counts is text outside
links, by the path of elements that it stands in: from the page down, the main
text is sought in the element that holds at least half of it, as long as that
element belongs to the class of what is once on a page and holds other blocks,
not text of its own.  Slots outside the element found are furniture, and so are
slots in it whose start tag is part of the template and named like furniture.
Tags weigh in: text of menus, footers, forms, scripts and the like counts
nothing and is never kept, text of an article counts more, and the search ends
at an article.  A host's single page is judged in the same way.

Four passes: pages to token hashes, dealt by host, and the text of each path; candidates of blocks of
pages (what occurs on half of a host's pages does so in one of its blocks);
their exact vectors and order over all blocks; pages beside their template.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reach_workers
from .common import materialise

#: Distinct pages of one block; a block also ends at BLOCK_TOKENS tokens.
GROUP_PAGES = 64
BLOCK_TOKENS = 500_000
#: A host is dealt over tasks if it has more pages than this, or than one in HOT_SHARE of all pages if that is more.
HOT_PAGES, HOT_SHARE = 256, 10_000
#: Pages that one task gets on average.
TASK_PAGES = 1_024
#: Share of a host's distinct pages on which a class must occur to be part of the template.
SUPPORT = 0.5
#: Share of the text above it that an element must hold to be searched further; times that text of an article counts.
MAIN_SHARE, MAIN_WEIGHT = 0.5, 4
#: Fewer distinct pages than this tell no template from what a page holds by itself, so every start tag counts as part of it.
LEAST_PAGES = 3

#: Characters of tags and attributes that are remembered from page to page.
LONGEST_KEPT = 200

SCHEMA = "page_id long, url string, text string, n_chars long"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noframes xmp iframe noembed".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img ruby rt rp".split())
BOILERPLATE = frozenset("head script style title noscript template nav footer aside form button select option textarea input iframe object embed svg canvas audio video dialog menu noframes noembed xmp".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars widget widgets related recommended recommendations share sharing social footer header masthead topbar comment comments commentlist disqus replies reply respond form search pagination pager copyright legal toolbar skip".split()
)
#: No label inside an article, as its own header is text.
NOT_IN_MAIN = frozenset(("header", "masthead"))
MAIN = frozenset(("article", "main"))
#: Words of readers' comments, which are no main text even as an article inside an article.
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: Words that say furniture at the start of a longer name too, inside an article.
START_WORDS = COMMENT_WORDS | frozenset("ad ads advert adverts advertisement".split())
NEVER_BY_CLASS = frozenset("html body article main".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}

_TAG_NAME = re.compile(r"/?[A-Za-z][^\s/>]*")
_QUOTE_OR_END = re.compile(r"[\"'>]")
_NAME = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")

Token = tuple  # (kind, what, path, block, inside): kind 0 tag, 1 text


#: Elements within which an open element of each name may be closed by a following one.
_SCOPES = {"p": ("td", "th", "button", "object", "caption"), **SIBLINGS}
_STARTS_SCOPE: dict[str, tuple[str, ...]] = {}
for _name, _stops in _SCOPES.items():
    for _stop in _stops:
        _STARTS_SCOPE[_stop] = (*_STARTS_SCOPE.get(_stop, ()), _name)


@lru_cache(maxsize=50_000)
def _named(name: str, attributes: str) -> tuple[str, bool, tuple[str, ...]]:
    """Of a start tag: its key, whether it starts an article or main text, and the words of its class, id and role."""
    names = {k.lower(): v.strip("\"'") for k, v in _NAME.findall(attributes)} if "=" in attributes else {}
    key = _DIGITS.sub("9", " ".join([name, *(f"{k}={v}" for k, v in sorted(names.items()))]))
    return key, name in MAIN or names.get("role") in ("main", "article"), tuple(x.lower() for v in names.values() for x in v.split())


@lru_cache(maxsize=50_000)
def _path(above: int, key: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{above}>{key}".encode("utf-8", "surrogatepass")) - (1 << 63)


def _token_number(token: tuple[int, str, int]) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(map(str, token)).encode("utf-8", "surrogatepass")) - (1 << 63)


_tag_number = lru_cache(maxsize=50_000)(_token_number)


class Element:
    __slots__ = ("name", "key", "path", "parent", "hard", "main", "starts_main", "label", "chars", "own", "gone")

    def __init__(self, name: str, attributes: str, parent: Element | None):
        self.name, self.parent = name, parent
        self.key, self.starts_main, names = (_named if len(attributes) <= LONGEST_KEPT else _named.__wrapped__)(name, attributes)
        within = parent is not None and parent.main
        #: A number for the path of block elements down to this one.
        self.path = 0 if parent is None else parent.path if name in INLINE else (_path if len(self.key) <= LONGEST_KEPT else _path.__wrapped__)(parent.path, self.key)
        self.main = within or self.starts_main
        self.hard = (parent is not None and parent.hard) or name in BOILERPLATE or (name == "header" and not self.main)
        #: Whether a name says furniture: inside an article one that is such a word, or starts with one of a few, else one that holds one.
        self.label = False
        if names and (within if self.starts_main else name not in NEVER_BY_CLASS):
            if self.main:
                whole = COMMENT_WORDS if self.starts_main else BOILERPLATE_WORDS - NOT_IN_MAIN
                self.label = any(x in whole or (first := _WORDS.match(x)) and first[0] in START_WORDS for x in names)
            else:
                self.label = any(w in BOILERPLATE_WORDS for x in names for w in _WORDS.findall(x))
        #: Characters outside links in it, and of its own blocks' text.
        self.chars = self.own = 0
        self.gone = False


def tokens(page: str) -> list[Token]:
    """The tokens of a page in order.  Blocks are numbered; a raw element's content is one text.

    Takes time in proportion to the page: what is sought to its end without
    success is not sought again, and open elements are counted by name.
    """
    out: list[Token] = []
    stack = [Element("#", "", None)]
    opened: dict[str, int] = defaultdict(int)
    scopes = {name: [0] for name in _SCOPES}
    links = block = at = 0
    last_end, last_quote = page.rfind(">"), {q: page.rfind(q) for q in "\"'"}
    last_comment, last_cdata = page.rfind("-->"), page.rfind("]]>")
    quotes = True

    def text(s: str, raw: bool = False) -> None:
        top = stack[-1]
        if s and not s.isspace():
            out.append((1, s if raw else entities.unescape(s), top.path, block, top))
            if not links and not top.hard:
                top.own += len(s) * (MAIN_WEIGHT if top.main else 1)
        elif s:
            out.append((1, " ", top.path, block, top))

    def push(e: Element) -> None:
        nonlocal links
        stack.append(e)
        opened[e.name] += 1
        links += e.name == "a"
        if e.name in scopes:
            scopes[e.name][-1] += 1
        for name in _STARTS_SCOPE.get(e.name, ()):
            scopes[name].append(0)

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            e = stack.pop()
            out.append((0, "/" + e.key, e.path, block, e))
            opened[e.name] -= 1
            links -= e.name == "a"
            for name in _STARTS_SCOPE.get(e.name, ()):
                scopes[name].pop()
            if e.name in scopes:
                scopes[e.name][-1] -= 1
            e.chars += e.own
            e.parent.chars += e.chars
            if e.name in INLINE:
                e.parent.own += e.own
                e.parent.chars -= e.own

    def innermost(name: str) -> int:
        return next(k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name)

    def tag_end(start: int) -> int:
        """The place of the ``>`` that ends a tag: one outside quotes, or the next one where quotes stay open."""
        nonlocal quotes
        i, near = start, page.find(">", start)
        if '"' not in (inner := page[start:near]) and "'" not in inner:
            return near
        while quotes:
            m = _QUOTE_OR_END.search(page, i)
            if not m:
                break
            if m[0] == ">":
                return m.start()
            if m.start() >= last_quote[m[0]]:
                break
            i = page.index(m[0], m.start() + 1) + 1
            if i > last_end:
                quotes = False
        return page.index(">", start)

    while (start := page.find("<", at)) >= 0 and start < last_end:
        m = _TAG_NAME.match(page, start + 1)
        if not m:
            if page.startswith("<!--", start):
                text(page[at:start])
                at = page.index("-->", start) + 3 if start < last_comment else len(page)
                out.append((0, _DIGITS.sub("9", page[start:at]), stack[-1].path, block, stack[-1]))
            elif page.startswith("<![CDATA[", start) and start < last_cdata:
                text(page[at:start])
                at = page.index("]]>", start) + 3
                text(page[start + 9 : at - 3], raw=True)
            elif page[start + 1] in "!?":
                text(page[at:start])
                at = page.index(">", start) + 1
                out.append((0, _DIGITS.sub("9", page[start:at]), stack[-1].path, block, stack[-1]))
            else:
                text(page[at : start + 1])
                at = start + 1
            continue
        text(page[at:start])
        name = m[0].lower()
        end = tag_end(m.end())
        attributes, at = page[m.end() : end], end + 1
        ends, name = name[0] == "/", name.lstrip("/")
        if name not in INLINE:
            block += 1
        if ends:
            if opened[name]:
                close(innermost(name))
            continue
        if name in CLOSES_P and scopes["p"][-1]:
            close(innermost("p"))
        if name in SIBLINGS and scopes[name][-1]:
            close(innermost(name))
        e = Element(name, attributes, stack[-1])
        out.append((0, e.key, e.path, block, e))
        if name in VOID or attributes.endswith("/"):
            continue
        push(e)
        if name in RAW:
            found = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            text(page[at : found.start() if found else len(page)], raw=True)
            at = found.end() if found else len(page)
            close(len(stack) - 1)
            block += 1
    rest = page[at:]
    text(rest[: rest.find("<!--")] if "<!--" in rest else rest)
    close(1)
    stack[0].chars += stack[0].own
    return out


def path_texts(page: list[Token]) -> dict[int, list[int]]:
    """For every path of blocks that holds text: [the path above, text that counts, such text of its own, times it is there, whether it starts an article]."""
    found: dict[int, list[int]] = {}
    for kind, what, path, _, e in page:
        if kind == 0 and what == e.key and e.chars and e.name not in INLINE:
            row = found.setdefault(path, [e.parent.path, 0, 0, 0, 0])
            row[1] += e.chars
            row[2] += e.own
            row[3] += 1
            row[4] |= int(e.starts_main)
    found[0] = [0, sum(r[1] for p, r in found.items() if r[0] == 0 and p), 0, 1, 0]
    return found


def _hashes(page: list[Token]) -> list[int | None]:
    """A number for every token of a page; none for blanks."""
    seen: dict[tuple, int] = {}
    out: list[int | None] = []
    for kind, what, path, _, _ in page:
        if kind and what == " ":
            out.append(None)
            continue
        token = kind, what.strip() if kind else what, path
        if token not in seen:
            seen[token] = _token_number(token) if kind or len(what) > LONGEST_KEPT else _tag_number(token)
        out.append(seen[token])
    return out


def _has_main(page: list[Token]) -> bool:
    return any(e.main and not e.hard for *_, e in page)


def features(page: list[Token]) -> tuple[int, list[int], dict[int, list[int]]]:
    """What makes a page distinct, its text in the article or outside menus and the like; its token numbers in order; its text by path."""
    inside = _has_main(page)
    content = (what.strip() for kind, what, _, _, e in page if kind and not e.hard and (e.main or not inside))
    key = xxhash.xxh3_64_intdigest("\0".join(x for x in content if x).encode("utf-8", "surrogatepass")) - (1 << 63)
    return key, [h for h in _hashes(page) if h is not None], path_texts(page)


Block = list  # of (key, token numbers), each key once


def candidates(block: Block) -> dict[int, tuple[int, int]]:
    """Tokens on enough of a block's pages, with the least key of a page that has them and their place on it."""
    count: dict[int, int] = defaultdict(int)
    for _, seq in block:
        for t in set(seq):
            count[t] += 1
    found: dict[int, tuple[int, int]] = {}
    for key, seq in sorted(block, key=lambda x: x[0]):
        for at, t in enumerate(seq):
            if count[t] >= SUPPORT * len(block) and t not in found:
                found[t] = key, at
    return found


def vectors(block: Block, wanted: dict[int, tuple[int, int]]) -> tuple[dict[int, list[int]], set[tuple[int, int]]]:
    """Of the wanted tokens: pages and a digest of the occurrence vector, and pairs of equal vector that break the order."""
    pages: list[dict[int, list[int]]] = []
    found: dict[int, list[int]] = {}
    for key, seq in block:
        places: dict[int, list[int]] = defaultdict(list)
        for at, t in enumerate(seq):
            if t in wanted:
                places[t].append(at)
        for t, at in places.items():
            v = found.setdefault(t, [0, 0])
            v[0] += 1
            v[1] ^= hash((key, len(at)))
        pages.append(places)
    alike: dict[tuple, list[int]] = defaultdict(list)
    for t, v in found.items():
        alike[tuple(v)].append(t)
    bad: set[tuple[int, int]] = set()
    for members in alike.values():
        members.sort(key=wanted.__getitem__)
        for places in pages:
            if members[0] not in places:
                continue
            follows = lambda a, b: all(y > x for x, y in zip(places[a], places[b], strict=True))  # noqa: B023, E731
            if not all(follows(a, b) for a, b in pairwise(members)):
                bad |= {(a, b) for i, a in enumerate(members) for b in members[i + 1 :] if not follows(a, b)}
    return found, bad


def main_chain(paths: dict[int, list[int]]) -> list[int]:
    """The paths from a page down to its main text; ``paths`` has [above, text, own text, times, starts an article, pages] of each."""
    chain = [0]
    if 0 not in paths:
        return chain
    below: dict[int, list[int]] = defaultdict(list)
    for path, row in paths.items():
        if path:
            below[row[0]].append(path)
    while below[chain[-1]]:
        here = paths[chain[-1]]
        best = max(below[chain[-1]], key=lambda p: (paths[p][1], p))
        _, text, own, times, article, pages = paths[best]
        once = times == pages and 2 * own <= text
        if text < MAIN_SHARE * here[1] or pages < SUPPORT * paths[0][5] or not (article or (once and not here[4])):
            break
        chain.append(best)
    return chain


class Template:
    """The valid classes of a host, from rows (token, pages, digest, first page, place on it) over its ``total`` distinct pages, and the way to its main text from the texts of ``paths``."""

    def __init__(self, total: int, rows: Iterable[tuple[int, int, int, int, int]], bad: set[tuple[int, int]], paths: dict[int, list[int]] | None = None):
        self.total, self.paths = total, paths or {}
        self.chain = main_chain(self.paths)
        classes: dict[tuple, list[tuple]] = defaultdict(list)
        for t, n, digest, page, at in rows:
            if n >= SUPPORT * total:
                classes[n, digest].append((page, at, t))
        self.place: dict[int, tuple[int, int, int]] = {}  # token: class, place in it, size of it
        for c, members in enumerate(classes.values()):
            ordered: list[int] = []
            for *_, t in sorted(members):
                if not bad or not any((a, t) in bad for a in ordered):
                    ordered.append(t)
            self.place |= {t: (c, i, len(ordered)) for i, t in enumerate(ordered)}

    def depths(self, seq: list[int | None]) -> list[int]:
        """How deep each token of a page is nested; -1 for what is in slots and for tokens that overlap another class."""
        out, open_classes = [], []  # of [class, place of its last token]
        for t in seq:
            c, i, size = self.place.get(t, (-1, 0, 0))
            j = next((j for j in range(len(open_classes) - 1, -1, -1) if open_classes[j][0] == c), None)
            if c < 0 or (j is None and i) or (j is not None and 0 < i <= open_classes[j][1]):
                out.append(-1)
                continue
            j = len(open_classes) if j is None else j
            del open_classes[j:]
            if i < size - 1:
                open_classes.append([c, i])
            out.append(j)
        return out


def add_paths(total: dict[int, list[int]], page: dict[int, list[int]]) -> None:
    """Add a page's texts by path to those of others; the last figure counts pages."""
    for path, (above, text, own, times, article) in page.items():
        row = total.setdefault(path, [above, 0, 0, 0, 0, 0])
        row[1] += text
        row[2] += own
        row[3] += times
        row[4] |= article
        row[5] += 1


def _template(pages: list[list[Token]]) -> Template:
    block: dict[int, list[int]] = {}
    paths: dict[int, list[int]] = {}
    for key, seq, texts in sorted(map(features, pages), key=lambda x: (x[0], np.array(x[1], np.int64).tobytes())):
        if key not in block:
            block[key] = seq
            add_paths(paths, texts)
    rows = list(block.items())
    wanted = candidates(rows)
    found, bad = vectors(rows, wanted)
    return Template(len(rows), ((t, *v, *wanted[t]) for t, v in found.items()), bad, paths)


def template(pages: list[list[Token]]) -> tuple[set[tuple], dict[tuple, int]]:
    """The template tokens (kind, what, path) of all pages of a host, and how deep the class of each is nested."""
    made = _template(pages)
    depth: dict[tuple, int] = {}
    for page in pages:
        for (kind, what, path, _, _), d in zip(page, made.depths(_hashes(page)), strict=True):
            if d >= 0:
                token = kind, what.strip() if kind else what, path
                depth[token] = max(d, depth.get(token, 0))
    return set(depth), depth


def main_text(page: list[Token], made: Template) -> str:
    """What the slots of a page hold that are main text."""
    depths = made.depths(_hashes(page)) if made.total >= LEAST_PAGES else [0 if made.total else -1] * len(page)
    there = {e.path for kind, what, _, _, e in page if kind == 0 and what == e.key}
    main = next((p for p in reversed(made.chain) if p in there), 0)
    above, most = set(made.chain), made.paths[main][1] if main in made.paths else 0
    kept = {0}  # ids of elements in the main text
    blocks: dict[int, list[str]] = {}
    for (kind, what, path, block, e), d in zip(page, depths, strict=True):
        if kind:
            repeated = d >= 0 and made.total >= LEAST_PAGES and not (main in made.paths and made.paths[main][4])  # what articles share is theirs
            if not e.gone and not e.hard and not repeated and (not main or id(e) in kept):
                blocks.setdefault(block, []).append(what)
        elif what == e.key and e.parent is not None:
            weighty = path in made.paths and 2 * made.paths[path][1] >= most
            e.gone = e.parent.gone or (e.label and d >= 0 and path not in above and not (weighty and e.name not in INLINE))
            if path == main or id(e.parent) in kept:
                kept.add(id(e))
    lines = (_SPACE.sub(" ", "".join(parts)).strip() for _, parts in sorted(blocks.items()))
    return "\n".join(x for x in lines if x)


def main_texts(group: list[str | None]) -> list[str]:
    """The main text of all pages of a host."""
    pages = [tokens(p or "") for p in group]
    made = _template(pages)
    return [main_text(p, made) for p in pages]


_CANDIDATE = pa.list_(pa.struct([("token", pa.int64()), ("page", pa.int64()), ("at", pa.int64())]))
_VECTOR = pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64()), ("digest", pa.int64()), ("page", pa.int64()), ("at", pa.int64())]))
_PATH = pa.list_(pa.struct([(n, pa.int64()) for n in ("path", "above", "text", "own", "times", "article", "pages")]))
_PAIR = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


_PATH_COLUMNS = [f.name for f in _PATH.value_type]


def _batch(**columns: tuple[list, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def _templates(base: DataFrame, hot: DataFrame, block_pages: int, tasks: int) -> DataFrame:
    """``host``, ``total`` (distinct pages), ``vectors``, ``bad`` and ``paths`` of every host."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()  # spares copies the way; bounded
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for host, page in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    key, seq, texts = features(tokens(page or ""))
                    if (known := (host, key, hash(tuple(seq)))) not in seen:
                        if len(seen) >= 100_000:
                            seen.clear()
                        seen.add(known)
                        rows.append((host, key, np.array(seq, np.int64).tobytes(), np.array([(p, *r) for p, r in texts.items()], np.int64).tobytes()))
                hosts, keys, seqs, texts = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield _batch(host=(hosts, pa.string()), key=(keys, pa.int64()), seq=(seqs, pa.binary()), texts=(texts, pa.binary()))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, block, size, last = None, [], 0, None
        paths: dict[int, list[int]] = {}

        def flush() -> pa.RecordBatch:
            found = [{"token": t, "page": p, "at": a} for t, (p, a) in candidates(block).items()]
            data = b"".join(np.array(s, np.int64).tobytes() for _, s in block)
            return _batch(host=([place[0]], pa.string()), part=([place[1]], pa.int64()), keys=([[k for k, _ in block]], pa.list_(pa.int64())), sizes=([[len(s) for _, s in block]], pa.list_(pa.int64())), seqs=([data], pa.binary()), found=([found], _CANDIDATE), paths=([[dict(zip(_PATH_COLUMNS, (p, *r), strict=True)) for p, r in paths.items()]], _PATH))

        for batch in batches:
            for host, part, key, seq, texts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block and ((host, part) != place or len(block) >= block_pages or size >= BLOCK_TOKENS):
                    yield flush()
                    block, size, paths = [], 0, {}
                if (host, part, key) == last:
                    continue  # a copy
                place, last = (host, part), (host, part, key)
                block.append((key, np.frombuffer(seq, np.int64).tolist()))
                add_paths(paths, {p: r for p, *r in np.frombuffer(texts, np.int64).reshape(-1, 6).tolist()})
                size += len(block[-1][1])
        if block:
            yield flush()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, keys, sizes, seqs, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cuts = np.split(np.frombuffer(seqs, np.int64), np.cumsum(sizes)[:-1])
                wanted = {x["token"]: (x["page"], x["at"]) for x in found}
                got, bad = vectors([(k, c.tolist()) for k, c in zip(keys, cuts, strict=True)], wanted)
                rows = [{"token": t, "n": n, "digest": d, "page": wanted[t][0], "at": wanted[t][1]} for t, (n, d) in got.items()]
                yield _batch(host=([host], pa.string()), vectors=([rows], _VECTOR), bad=([[{"a": a, "b": b} for a, b in bad]], _PAIR))

    pages = base.select("host", "html").mapInArrow(read, "host string, key long, seq binary, texts binary")
    pages = pages.join(F.broadcast(hot), "host", "left").withColumn("part", F.pmod("key", F.coalesce("parts", F.lit(1)))).select("host", "part", "key", "seq", "texts")
    dealt = pages.repartition(tasks, "host", "part").sortWithinPartitions("host", "part", "key", "seq")
    found = "array<struct<token:long,page:long,at:long>>"
    blocks = materialise(dealt.mapInArrow(gather, f"host string, part long, keys array<long>, sizes array<long>, seqs binary, found {found}, paths array<struct<{', '.join(f'{n}:long' for n in _PATH_COLUMNS)}>>"), "blocks")
    every = blocks.groupBy("host").agg(F.sum(F.size("keys")).alias("total"))
    total = every.filter(F.col("total") >= LEAST_PAGES)
    each = blocks.join(total.select("host"), "host", "left_semi").select("host", F.explode("found").alias("x")).groupBy("host", "x.token").agg(F.min(F.struct("x.page", "x.at")).alias("x"))
    wanted = _at_parts(each.groupBy("host").agg(F.collect_list(F.struct("token", "x.page", "x.at")).alias("found")), hot)
    joined = blocks.drop("found").join(wanted, ["host", "part"]).select("host", "keys", "sizes", "seqs", "found")
    measured = materialise(joined.mapInArrow(measure, "host string, vectors array<struct<token:long,n:long,digest:long,page:long,at:long>>, bad array<struct<a:long,b:long>>"), "vectors")
    v = measured.select("host", F.explode("vectors").alias("v")).groupBy("host", "v.token").agg(F.sum("v.n").alias("n"), F.bit_xor("v.digest").alias("digest"), F.min(F.struct("v.page", "v.at")).alias("x"))
    v = v.join(total, "host").filter(F.col("n") >= SUPPORT * F.col("total"))
    v = v.groupBy("host").agg(F.collect_list(F.struct("token", "n", "digest", "x.page", "x.at")).alias("vectors"))
    bad = measured.select("host", F.explode("bad").alias("x")).groupBy("host").agg(F.collect_set("x").alias("bad"))
    p = blocks.select("host", F.explode("paths").alias("p")).groupBy("host", "p.path").agg(F.min("p.above").alias("above"), *[F.sum(f"p.{n}").alias(n) for n in ("text", "own", "times")], F.max("p.article").alias("article"), F.sum("p.pages").alias("pages"))
    p = p.join(every, "host").filter(F.col("pages") >= SUPPORT * F.col("total"))
    p = p.groupBy("host").agg(F.collect_list(F.struct(*_PATH_COLUMNS)).alias("paths"))
    return every.join(v, "host", "left").join(bad, "host", "left").join(p, "host", "left")


def _at_parts(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Each host's row once for every part of it."""
    return rows.join(F.broadcast(hot), "host", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group_pages: int = GROUP_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row.

    Null and empty pages give an empty text.  Pages without a host (null url)
    are one host.  On hosts of one or two distinct pages every start tag counts
    as template.  Repeated rows are extracted each, pages of any length
    whole; an empty table gives no rows.  Other columns are not read.  ``group_pages`` bounds a block and does not change the result.  One
    shuffle brings the pages to their host's template; before, token numbers
    are shuffled.
    """
    reach_workers(pages.sparkSession)
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    base = base.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1)))
    hosts = base.groupBy("host").agg(F.count("*").alias("n"))
    total = hosts.agg(F.sum("n")).first()[0] or 0
    most, tasks = max(HOT_PAGES, total // HOT_SHARE), max(pages.sparkSession.sparkContext.defaultParallelism, total // TASK_PAGES)
    hot = hosts.filter(F.col("n") > most).select("host", F.ceil(F.col("n") / most).alias("parts"))  # HOT_SHARE rows at most
    made = _at_parts(materialise(_templates(base, hot, group_pages, tasks), "templates"), hot)
    dealt = base.join(F.broadcast(hot), "host", "left").withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("parts", F.lit(1)))).drop("parts")
    dealt = dealt.withColumn("is_page", F.lit(True)).unionByName(made.withColumn("is_page", F.lit(False)), allowMissingColumns=True)
    columns = ["host", "part", "is_page", "page_id", "url", "html", "total", "vectors", "bad", "paths"]
    dealt = dealt.select(*columns).repartition(tasks, "host", "part").sortWithinPartitions("host", "part", "is_page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, now = None, Template(0, (), set())
        for batch in batches:
            rows: list[tuple] = []
            for at in range(0, batch.num_rows, 64):  # pages can be long
                for host, part, is_page, page_id, url, page, n, found, bad, paths in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True):
                    if (host, part) != place:
                        place, now = (host, part), Template(0, (), set())
                    if is_page:
                        rows.append((page_id, url, main_text(tokens(page or ""), now)))
                    else:
                        now = Template(n, (tuple(x.values()) for x in found or ()), {(x["a"], x["b"]) for x in bad or ()}, {p: r for p, *r in (x.values() for x in paths or ())})
            ids, urls, texts = zip(*rows, strict=True) if rows else ((), (), ())
            yield _batch(page_id=(ids, pa.int64()), url=(urls, pa.string()), text=(texts, pa.string()), n_chars=(list(map(len, texts)), pa.int64()))

    return dealt.mapInArrow(run, SCHEMA)
