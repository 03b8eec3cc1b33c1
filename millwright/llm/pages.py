"""Main text of web pages by template deduction.

Pages of one host share a template.  A structural token is an element's place
(its path of block elements with their classes).  Tokens with the same
occurrence vector over the host's pages form an equivalence class; a class is
valid if its tokens nest in one another or in one place of the classes above.
Valid classes nested into each other are the template, and what pages put
between its tokens are the slots.  The slot tree, with how much text each slot
gets, tells where the article is; menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments are known by their
elements and names.  Boxes inside the article whose text is the same on all
pages, though the pages differ, are template too.  What remains of the article's slots is a page's text.

An occurrence vector is never gathered: its digest is a map-side combined
aggregate over pages, so a host with a third of all pages is an ordinary group.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW_KEY, materialize, with_row_key

#: Share of a host's pages on which a token has to occur to be in the template.
MIN_SUPPORT = 0.5
#: Pages from which a host has a template of its own; others go by the one of all pages.
MIN_PAGES = 5
#: Tokens whose paths are longer than this many elements count as their ancestor's.
MAX_DEPTH = 24
ANY_HOST = ""
#: Share of a host's pages that have to have a box inside the article, and marks of different texts among them (of 63),
#: for its constant text to be template; copies of one article have one mark.
STEADY_SUPPORT = 0.9
STEADY_MARKS = 4
#: Share of the article's text up to which constant boxes are left out; more is taken for an article that pages repeat.
STEADY_SHARE = 0.2

# Attributes as the HTML standard reads them: a value without quotes ends at white space or ">".  A quote that never closes is a character.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+" + _VALUE + r")?+)*+)(?:>|\Z)",
    re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(" + _VALUE + r"))?+")
_READ = frozenset(["class", "id", "role", "style", "hidden", "aria-hidden"])
#: A last value without quotes that takes in the slash at the end of its tag.
_OPEN_VALUE = re.compile(r"=\s*[^\s\"'>][^\s>]*\Z")
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

# Elements, by the HTML standard.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math mfrac mi mn mo mover mpadded mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track".split())
_RAW = frozenset("script style textarea title noscript template iframe svg annotation annotation-xml noframes xmp".split())
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol "
    "p pre section table ul".split())
_SAME_LEVEL = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "th", "th": "td", "option": "option"}

# What isn't the article.
_OUT_ELEMENTS = frozenset("head nav footer aside form button select fieldset dialog menu object audio video canvas".split()) | _RAW
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar aside rail widget widgets "
    "footer copyright cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login comment comments commentlist respond disqus replies share sharing social related recommended "
    "toolbar masthead topbar skip form search".split())
_OUT_OUTSIDE = frozenset(["header"])  # an article may have a header of its own
_CONTENT_ELEMENTS = ("article", "main")
#: A class with one of these tells of a state or a layout, as in has-sidebar or menu-open.
_STATES = frozenset("has have with without no not is open opened closed enabled disabled active layout".split())
#: Words that make a name of two a name of the same thing inside an article, as in ad-slot; related-work is no list of related pages.
_PARTS = frozenset(
    "area article articles bar block body bottom box button buttons container content footer global group header holder icon icons "
    "inner item items left link links list main message outer page panel post posts right row section site slot text thread "
    "title top unit wrap wrapper zone".split())
#: Share of a page's text from which a named box or form is taken for the wrapper of it all.
_WRAPS = 0.8


def _attributes(raw: str) -> dict[str, str]:
    known: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        name = m[1].lower()
        if name in _READ and name not in known:  # the first of a name counts
            value = (m[2] or "").lower()
            known[name] = value[1:-1] if value[:1] in ("'", '"') else value
    return known


def _runs(*values: str) -> list[str]:
    """Letter runs of class and id tokens, but for those that tell of a state."""
    tokens = [_NAME.findall(t) for v in values for t in v.split()]
    return [n for t in tokens if not _STATES.intersection(t) for n in t]


def _named_out(*values: str) -> bool:
    """Whether a whole class or id token names what isn't the article: all of its letter runs do, or tell of a part."""
    for token in (t for v in values for t in v.split()):
        runs = set(_NAME.findall(token))
        if runs & _OUT_NAMES and not runs & _STATES and runs <= _OUT_NAMES | _PARTS:
            return True
    return False


def _is_out(tag: str, at: dict[str, str], inside: bool = False) -> bool:
    """Whether an element isn't the article; ``inside`` the article, only a whole name tells."""
    if tag in _OUT_ELEMENTS or at.get("role") in _OUT_ROLES or "hidden" in at or at.get("aria-hidden") == "true":
        return True
    if tag in ("body", "html", "article", "main"):
        return any(n in ("comment", "comments") for n in _runs(at.get("class", "")))
    if "display:none" in at.get("style", "").replace(" ", ""):
        return True
    if inside:
        return _named_out(at.get("class", ""), at.get("id", ""))
    return any(n in _OUT_NAMES for n in _runs(at.get("class", ""), at.get("id", "")))


def _in_article(path: list[str], content: tuple[str, ...]) -> bool:
    """Whether a path lies in an article or main element, or in one of the content nodes."""
    if any(p.split(".")[0] in _CONTENT_ELEMENTS for p in path):
        return True
    joined = "/".join(path) if content else ""
    return any(joined == c or joined.startswith(c + "/") for c in content)


def _end_of_inline(page: str, tag: str, at: int) -> int:
    """Where an inline box that began before ``at`` ends, after boxes of its kind in it; ``at`` if it is left open."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).finditer(page, at):
        depth += -1 if m[1] else 1
        if not depth:
            return m.end()
    return at


def _may_wrap(tag: str, at: dict[str, str]) -> tuple[bool, bool]:
    """Whether a block that is out may hold the article after all: around an article element, and around most of the text.

    A form, or a box that is out by its name alone; a box whose whole name is that of comments and the like
    only around an article element.
    """
    if tag == "form":
        at = {k: v for k, v in at.items() if k not in ("class", "id")}
        return (not _is_out("div", at),) * 2
    plain = {k: v for k, v in at.items() if k not in ("class", "id")}
    if tag in ("body", "html", "article", "main") or _is_out(tag, plain):
        return False, False
    return True, not _OUT_NAMES.intersection(f"{at.get('class', '')} {at.get('id', '')}".split())


def _wrappers(page: str) -> frozenset[int]:
    """Places of the forms and named boxes that hold most of the page's article elements, or of its text if it has none."""
    boxes: dict[int, list] = {}  # place: [around articles, around text, characters in articles, characters]
    total = [0, 0]
    for places, in_article, n in _walk(page, boxes):
        total = [total[0] + n * in_article, total[1] + n]
        for at in places:
            boxes[at][2] += n * in_article
            boxes[at][3] += n
    if total[0]:
        return frozenset(k for k, (a, _, chars, _) in boxes.items() if a and 2 * chars > total[0])
    return frozenset(k for k, (_, b, _, chars) in boxes.items() if b and total[1] and chars >= _WRAPS * total[1])


def _walk(page: str, boxes: dict[int, list]) -> Iterator[tuple[list[int], bool, int]]:
    """(places of the boxes around it, in an article element, characters) of each text that isn't out for good."""
    opened: list[int] = []
    for path, out, _, text in _blocks(page, None, boxes, opened):
        if text is not None and not out and text.strip():
            yield [k for k in opened if k >= 0], any(p.split(".")[0] in _CONTENT_ELEMENTS for p in path), len(text.strip())


def blocks(page: str, content: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], bool, bool, str | None]]:
    """(path, out, head, text) of each text between tags, and (path, out, head, None) where a block begins or ends.

    ``out``: inside something that isn't the article; ``head``: inside a header; ``content``: nodes that hold the article.
    Elements left open end as the standard has it, or with the page.
    """
    return _blocks(page, _wrappers(page), {}, [], content)


def _blocks(page: str, wrappers: frozenset[int] | None, boxes: dict[int, list],
            opened: list[int], content: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], bool, bool, str | None]]:
    """``blocks``, with the boxes at ``wrappers`` not out; None: all that may be wrappers, and ``boxes`` lists them.

    ``opened`` has the place of each open block in ``boxes``, else -1.
    """
    path: list[str] = []   # names of open blocks
    tags: list[str] = []
    out = head = 0         # depth at which the outermost one opened, plus one
    at = 0

    def close(depth: int) -> None:
        nonlocal out, head
        del path[depth:], tags[depth:], opened[depth:]
        out, head = (0 if out > depth else out), (0 if head > depth else head)

    while at < len(page):
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            yield tuple(path), bool(out), bool(head), page[at:end]
        if not m:
            return
        at = m.end()
        if not m[2]:
            continue  # comment, declaration
        tag = m[2].lower()
        if m[1]:
            if tag in tags:
                close(len(tags) - 1 - tags[::-1].index(tag))
            if tag not in _INLINE:
                yield tuple(path), bool(out), bool(head), None
            continue
        if tag in _RAW:
            ended = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = ended.end() if ended else len(page)
            if tag not in ("svg", "annotation", "annotation-xml"):
                yield tuple(path), bool(out), bool(head), None
            continue
        if tag in _INLINE:
            known = _attributes(m[3])
            if _is_out(tag, known) and _is_out(tag, known, _in_article(path, content)):  # an inline box with a name of its own
                at = _end_of_inline(page, tag, at)
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                yield tuple(path), bool(out), bool(head), None
            continue
        if tag in _ENDS_PARAGRAPH and "p" in tags:
            close(len(tags) - 1 - tags[::-1].index("p"))
        if tag in _SAME_LEVEL and tags and tags[-1] in (tag, _SAME_LEVEL[tag]):
            close(len(tags) - 1)
        if tag == "body" and "head" in tags:
            close(tags.index("head"))
        if m[3].endswith("/") and tag not in ("p", "div", "li") and not _OPEN_VALUE.search(m[3]):
            continue
        known = _attributes(m[3])
        tags.append(tag)
        name = ".".join([tag, *sorted(set(_NAME.findall(known.get("class", ""))))])
        path.append(name)
        opened.append(-1)
        if not out and _is_out(tag, known) and _is_out(tag, known, _in_article(path[:-1], content)):
            may = _may_wrap(tag, known) if wrappers is None else (m.start() in wrappers,)
            if not any(may):
                out = len(path)
            elif wrappers is None:
                opened[-1] = m.start()
                boxes[m.start()] = [*may, 0, 0]
        if not head and (tag == "header" or any(n in _OUT_OUTSIDE for n in _runs(
                known.get("class", ""), known.get("id", "")))) and tag not in ("html", "body", "article", "main"):
            head = len(path)
        yield tuple(path), bool(out), bool(head), None


def tokens(page: str) -> dict[str, tuple[int, int, bool, int]]:
    """Path to (occurrences, characters of text directly in it, out, checksum of that text) for each structural token of a page."""
    seen: Counter = Counter()
    chars: Counter = Counter()
    said: Counter = Counter()
    outside = {}
    last = ()
    for path, out, head, text in blocks(page):
        path = path[:MAX_DEPTH]
        key = "/".join(path)
        if text is None:
            if len(path) > len(last) or path != last:
                if len(path) >= len(last):
                    seen[key] += 1
            last = path
        else:
            chars[key] += len(text.strip())
            said[key] = zlib.crc32(text.strip().encode("utf-8", "replace"), said[key])
        outside[key] = outside.get(key, True) and (out or (head and not any(
            p.split(".")[0] in _CONTENT_ELEMENTS for p in path)))
    return {k: (max(1, seen[k]), chars[k], outside[k], said[k]) for k in outside}


# -- the template of a host --------------------------------------------------

def build_template(found: list[tuple[str, int, int, bool]]) -> dict[str, int]:
    """Path to characters, nested: from (path, class digest, characters, out) of a host's frequent tokens.

    A class is valid if the nearest ancestors of its tokens outside the class
    lie in one class; invalid ones go, and with them what only they hold.
    """
    classes = defaultdict(list)
    of = {}
    for path, digest, _, _ in found:
        classes[digest].append(path)
        of[path] = digest

    def above(path: str) -> str | None:
        while "/" in path:
            path = path.rpartition("/")[0]
            if path in of:
                return path
        return None

    valid = {}
    for digest, members in classes.items():
        parents = {of[p] if p is not None else None for p in map(above, members)} - {digest}
        valid[digest] = len(parents) <= 1
    return {path: chars for path, digest, chars, out in found if valid[digest] and not out}


def content_path(found: list[tuple]) -> str | None:
    """The template nodes that hold the article, joined by spaces; None if the template has no text outside of menus and the like.

    All article elements, or main elements; else the lowest node above all
    slots whose text differs between pages (a fifth field of ``found``; all, if
    none does), and from there up as long as no text that is the same on all pages comes in.
    """
    template = build_template([f[:4] for f in found])
    varied = {f[0] for f in found if len(f) < 5 or f[4]}
    under: Counter = Counter()
    fixed: Counter = Counter()
    slots = [p for p, chars in template.items() if chars]
    if not slots:
        return None
    changing = [p for p in slots if p in varied] or slots
    for path in slots:
        at = path
        while at:
            under[at] += template[path]
            fixed[at] += template[path] * (path not in changing)
            at = at.rpartition("/")[0]
    for element in _CONTENT_ELEMENTS:
        named = [p for p in template if p.rpartition("/")[2].split(".")[0] == element and under[p]]
        if any(10 * under[p] >= sum(template.values()) for p in named):
            return " ".join(sorted(named))
    node = changing[0].split("/")
    for path in changing[1:]:
        other = path.split("/")
        node = node[:next((i for i, (x, y) in enumerate(zip(node, other)) if x != y), min(len(node), len(other)))]
    while len(node) > 1 and fixed["/".join(node[:-1])] == fixed["/".join(node)]:
        node.pop()
    return "/".join(node) or None


def steady_slots(found: list[tuple], content: str | None) -> list[str]:
    """Paths below the content nodes whose text is the same on all pages: from (path, class digest, characters, out, varied, steady).

    Headings and boxes without any class below the content node stay, and all stays if
    it were more than a small share of the article.
    """
    if content is None:
        return []
    nodes = content.split(" ")
    below = {path: chars for path, _, chars, out, *_ in found if not out and any(path == c or path.startswith(c + "/") for c in nodes)}
    steady = []
    for path, _, chars, _, _, same in found:
        node = next((c for c in nodes if path.startswith(c + "/")), None)
        if path in below and chars and same and node is not None:
            inner = path[len(node) + 1:].split("/")
            if any("." in p for p in inner) and not any(re.match(r"h[1-6](?:\.|\Z)", p) for p in inner):
                steady.append(path)
    return steady if sum(below[p] for p in steady) <= STEADY_SHARE * sum(below.values()) else []


def extract(page: str | None, content: str | None, steady: frozenset[str] = frozenset()) -> str:
    """Text of the content slots of a page: blocks in page order, joined by one space.

    Text directly in a ``steady`` path is left out.  A page without the template's
    content node goes by its own article or main element, and else by all that isn't left out.
    """
    if not page:
        return ""
    parts: dict[str, list[str]] = {"template": [], "own": [], "all": []}
    here: dict[str, list[str]] = {k: [] for k in parts}

    def end() -> None:
        for k, texts in here.items():
            if texts:
                block = _SPACE.sub(" ", html.unescape("".join(texts))).strip()
                if block:
                    parts[k].append(block)
                texts.clear()

    nodes = tuple(content.split(" ")) if content is not None else ()
    for path, out, head, text in blocks(page, nodes):
        if text is None:
            end()
            continue
        if out:
            continue
        own = any(p.split(".")[0] in _CONTENT_ELEMENTS for p in path)
        if head and not own:
            continue
        joined = "/".join(path)
        if joined in steady:
            continue
        here["all"].append(text)
        if own:
            here["own"].append(text)
        if any(joined == c or joined.startswith(c + "/") for c in nodes):
            here["template"].append(text)
    end()
    return " ".join(parts["template"] or parts["own"] or parts["all"])


# -- the jobs ----------------------------------------------------------------

def templates(pages: DataFrame, html_col: str = "html", min_support: float = MIN_SUPPORT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, content, steady): the content node and steady slots of each host with enough pages, and of all pages as ``ANY_HOST``.

    ``pages`` has the row key, ``host`` and the html.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, host, page in zip(*[c.to_pylist() for c in b.columns]):
                found = tokens(page or "")
                # pages with the same text outside of menus and the like have the same mark
                mark = 1 << zlib.crc32(repr([v[3] for v in found.values() if not v[2]]).encode()) % 63
                found[""] = (1, 0, True, 0)
                rows += [(h, p, key, *v, mark) for p, v in found.items() for h in ({host, ANY_HOST} - {None})]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()))],
                ["host", "path", "key", "n", "chars", "out", "said", "mark"])

    seen = pages.select(ROW_KEY, "host", html_col).mapInArrow(run, "host string, path string, key long, n long, chars long, out boolean, said long, mark long")
    # the digest of a token's occurrence vector
    stats = seen.groupBy("host", "path").agg(
        F.bit_xor(F.xxhash64("key", "n")).alias("digest"), F.count("*").alias("support"),
        F.sum("chars").alias("chars"), F.min("out").alias("out"),
        (F.min("said") < F.max("said")).alias("varied"), F.bit_count(F.bit_or("mark")).alias("marks"))
    stats = materialize(stats, "tokens")
    size = stats.where("path = ''").select("host", F.col("support").alias("pages")).where(
        (F.col("pages") >= min_pages) | (F.col("host") == ANY_HOST))
    kept = stats.where("path <> ''").join(size, "host").where(F.col("support") >= min_support * F.col("pages"))
    # at most (tokens of a page) / min_support rows of a host
    by_host = kept.groupBy("host").agg(F.collect_list(F.struct("path", "digest", "chars", "out", "varied", (
        ~F.col("varied") & (F.col("support") >= STEADY_SUPPORT * F.col("pages")) & (F.col("marks") >= STEADY_MARKS)).alias("steady"))).alias("found"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = [[tuple(f[k] for k in ("path", "digest", "chars", "out", "varied", "steady")) for f in found] for found in b.column(1).to_pylist()]
            content = [content_path([f[:5] for f in found]) for found in every]
            steady = [steady_slots(found, c) for found, c in zip(every, content)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(content, pa.string()), pa.array(steady, pa.list_(pa.string()))],
                                             ["host", "content", "steady"])

    return by_host.mapInArrow(choose, "host string, content string, steady array<string>")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              min_support: float = MIN_SUPPORT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(id_col, url_col, text): the main text of every page, empty if there is none.

    Null and empty html give an empty text.  A null or odd url has no host and
    goes by the template of all pages.  Repeated rows and equal ids stay as
    rows of their own; other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.nullif(host, F.lit("")).alias("host"),
                        F.col(html_col).alias("html"))
    keyed = with_row_key(slim, ["id", "url", "host", "html"])
    chosen = materialize(templates(keyed, "html", min_support, min_pages), "templates")
    general = chosen.where(F.col("host") == ANY_HOST).select("content", "steady").collect()
    general = (general[0].content, frozenset(general[0].steady)) if general else (None, frozenset())
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                content, steady, page = (b.column(i).to_pylist() for i in (2, 3, 4))
                text = [extract(p, *(general if c is None else (c, frozenset(f)))) for p, c, f in zip(page, content, steady)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], ["id", "url", "text"])

    joined = slim.join(chosen.where(F.col("host") != ANY_HOST), "host", "left").select("id", "url", "content", "steady", "html")
    return joined.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
