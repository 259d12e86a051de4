"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of text runs and tags. Words score positive and tags negative, by weights learnt from labelled
pages: pages that mark their content with one `article` or `main` element. Each teaches twice, once with that mark
seen and once with it hidden, so pages without a mark are scored by what marked ones have in common with them. One
scan finds the contiguous region with the highest sum. The region says where the article is, elements say where it
ends: an article that holds most of the region is taken whole, tables, quotes and lists of links included. On pages
without one, the region grows over its neighbours in the same element, and in the elements around it, as long as their
words score positive. What it holds of menus, adverts, forms, comments and the like is left out, known by element,
role, or by a class or id that says nothing else (`comments`, `post-comments`, but not `share-prices`); within an article ids
of headings and of their sections are names of places and tell nothing.

Cases: null and empty pages, and pages without words outside of such parts, give an empty text; unclosed tags end with
what encloses them; repeated pages are extracted one by one; pages are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements by what they do, and words in classes, ids and roles.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noframes noembed xmp".split())
JUNK = frozenset("nav aside footer form script style textarea title iframe noframes noembed noscript template button select option svg canvas object dialog menu head search".split())
CONTENT = frozenset("article main".split())
JUNK_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner banners breadcrumb breadcrumbs byline cc cookie cookies comment comments commentlist "
    "complementary consent contentinfo copyright dialog disqus donate feedback footer footnav gdpr header hidden legal login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup popular privacy promo promoted promotion rail reader related replies reply "
    "recommend recommended respond search share sharing sidebar sidenav signin signup skip skyscraper social sponsor sponsored subscribe subscription tagcloud teaser toolbar "
    "topbar tracking trending warning widget widgets alert".split())
MILD_WORDS = frozenset("header byline reader popular".split())
#: Words that add nothing to a compound name.
PLAIN_WORDS = frozenset(
    "a article area bar block body bottom box center col column container content entry group holder inner item js left links list main module of on outer page panel "
    "post right row section site story the top web wrap wrapper".split())
TEXTS = frozenset("h1 h2 h3 h4 h5 h6 p li section blockquote figure figcaption table td th dt dd".split())
CONTENT_WORDS = frozenset("article body content entry main post story text".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CLOSE = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in RAW}


def is_junk(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of an article. inside: it stands within an article."""
    if name in JUNK or (name == "header" and not inside):
        return True
    if not attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif name not in ("body", "html") and key in ("class", "id", "role") and not (key == "id" and inside and name in TEXTS):
            names = [{w.lower() for w in _NAME.findall(part)} for part in value.split()]
            every = set().union(*names)
            for words in names:
                bad = words & JUNK_WORDS
                if bad and words <= JUNK_WORDS | PLAIN_WORDS and not (bad <= MILD_WORDS and (inside or every & CONTENT_WORDS)):
                    return True
    return False


class Token:
    """A text run (name is None) or a tag, and where it stands. node: the innermost open element."""

    __slots__ = ("name", "text", "words", "junk", "link", "block", "marked", "node")

    def __init__(self, name, text, words, junk, link, block, marked, node):
        self.name, self.text, self.words, self.junk, self.link, self.block, self.marked, self.node = name, text, words, junk, link, block, marked, node


class Node:
    """A block element: the element around it, its tokens and its blocks."""

    __slots__ = ("name", "junk", "parent", "begin", "end", "children")

    def __init__(self, name, junk, parent, begin):
        self.name, self.junk, self.parent, self.begin, self.end, self.children = name, junk, parent, begin, begin, []


def tokens(page: str) -> list[Token]:
    """The page's runs and tags. Comments, declarations and what scripts and styles hold are no tokens."""
    return parsed(page)[0]


def parsed(page: str) -> tuple[list[Token], Node]:
    """The page's tokens, and the element that holds them all."""
    out: list[Token] = []
    root = Node("", False, None, 0)
    stack: list[tuple[str, bool, bool, Node | None]] = []  # open elements: name, within junk, within an article, its node if a block
    link, block, at, size = 0, "body", 0, len(page)

    def run(text: str) -> None:
        if text:
            _, junk, marked, _ = stack[-1] if stack else ("", False, False, None)
            clean = html.unescape(text) if "&" in text else text
            out.append(Token(None, clean, len(clean.split()), junk, link > 0, block, marked, innermost()))

    def innermost() -> Node:
        return next((s[3] for s in reversed(stack) if s[3]), root)

    def leave(k: int, at: int) -> None:
        """Elements from the k-th open one on end before the token `at`."""
        for _, _, _, node in stack[k:]:
            if node:
                node.end = at
        del stack[k:]

    def close(name: str) -> None:
        nonlocal link
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                leave(k, len(out) + 1)
                return
            if stack[k][0] in ("table", "body") and name not in ("table", "body", "html"):
                return

    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            run(page[at:])
            break
        run(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, end = m[2].lower(), bool(m[1])
        _, junk, marked, _ = stack[-1] if stack else ("", False, False, None)
        if end:
            close(name)
            link = max(0, link - 1) if name == "a" else link
        else:
            if name in BLOCKS:
                if stack and stack[-1][0] == "p":
                    leave(len(stack) - 1, len(out))
                if name in ("li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == name:
                    leave(len(stack) - 1, len(out))
                _, junk, marked, _ = stack[-1] if stack else ("", False, False, None)
                block = name
            own = junk or is_junk(name, m[3], marked)
            inside = marked or (name in CONTENT and not own)
            if name == "a":
                link += 1
            if name not in VOID and not m[3].endswith("/") and (name in BLOCKS or own != junk):
                node = None
                if name in BLOCKS:
                    node = Node(name, own, innermost(), len(out))
                    node.parent.children.append(node)
                stack.append((name, own, inside, node))
            junk, marked = own, inside
            if name in RAW:  # its text ends with its own end tag alone
                done = _CLOSE[name].search(page, at)
                at = done.end() if done else size
                close(name)
        out.append(Token(name, "", 0, junk, link > 0, block, marked, innermost()))
        if end and name in BLOCKS:
            block = stack[-1][0] if stack else "body"
    leave(0, len(out))
    root.end = len(out)
    return out, root


def marked_once(found: list[Token]) -> bool:
    """Whether one article holds words, so that the page can teach."""
    runs, inside = 0, False
    for t in found:
        runs += t.marked and not inside
        inside = t.marked
    return runs == 1 and any(t.marked and t.words for t in found)


def feature(t: Token, seen: int) -> str:
    """What a token's weight depends on. seen: 1 if the page marks its content."""
    place = "?" if not seen else "in" if t.marked else "out"
    if t.name is None:
        return f"words {place} {t.block if t.block in BLOCKS else 'other'}{' link' * t.link}"
    return f"tag {place} {t.name if t.name in BLOCKS or t.name in ('a', 'b', 'i', 'br', 'span', 'em', 'strong', 'img') else 'other'}"


#: Words, words of links, and tags that each feature is taken to have met before any page: inside and outside of content.
BEFORE = {"words": (4.0, 1.0), "link": (1.0, 3.0), "tag": (1.0, 2.0)}


def learnt(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Weights from how often a feature was inside and outside of content: positive for words, negative for tags.

    Words are worth their log odds, between -4 and 1; a tag costs between 0.05 and 4, the more the less it is at home
    in content.
    """
    return {name: weigh(name, *n) for name, n in counts.items()}


def weigh(name: str, inside: int = 0, outside: int = 0) -> float:
    """The weight of one feature; without counts, that of one which no page has."""
    words = name.startswith("words")
    a, b = BEFORE["link" if words and name.endswith(" link") else "words" if words else "tag"]
    odds = math.log((inside + a) / (outside + b))
    return max(-4.0, min(1.0, odds)) if words else -max(0.05, min(4.0, 0.5 - odds))


def region(found: list[Token], weights: dict[str, float]) -> tuple[int, int]:
    """First token and one past the last of the highest-scoring stretch; (0, 0) if nothing scores above zero."""
    seen = int(any(t.marked and t.words for t in found))
    best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
    for k, t in enumerate(found):
        if t.junk or (t.name is None and not t.words):
            continue
        name = feature(t, seen)
        weight = weights.get(name)
        if weight is None:
            weight = weigh(name)
        if total <= 0:
            total, start = 0.0, k
        total += weight * max(1, t.words)
        if total > best:
            best, begin, end = total, start, k + 1
    return begin, end


def _units(node: Node) -> list[tuple[int, int]]:
    """The node's blocks, and what stands between them, in order."""
    out, at = [], node.begin
    for child in node.children:
        if child.begin > at:
            out.append((at, child.begin))
        out.append((child.begin, child.end))
        at = child.end
    return out + [(at, node.end)] * (node.end > at)


def whole(found: list[Token], root: Node, begin: int, end: int, weights: dict[str, float]) -> tuple[int, int]:
    """The tokens of the article that the region is in: an element that marks it, or the region with its neighbours."""
    words, scores = [0], [0.0]  # up to each token: words outside of junk, and what they score without tags
    seen = int(any(t.marked and t.words for t in found))
    for t in found:
        own = 0 if t.junk or t.name is not None else t.words
        words.append(words[-1] + own)
        name = feature(t, seen)
        scores.append(scores[-1] + (own * (weights[name] if name in weights else weigh(name)) if own else 0.0))
    held = words[end] - words[begin]
    marks, open_ = [], [root]
    while open_:
        node = open_.pop()
        if node.name in CONTENT and not node.junk and words[node.end] > words[node.begin]:
            marks.append(node)
        open_ += node.children
    picks = {}
    for name in ("article", "main"):
        best, most, every, upto = None, 0, 0, 0
        for node in sorted((n for n in marks if n.name == name), key=lambda n: (n.begin, -n.end)):
            own = words[node.end] - words[node.begin]
            shared = words[min(end, node.end)] - words[max(begin, node.begin)] if held else own
            if shared > most:
                best, most = node, shared
            if node.begin >= upto:
                every, upto = every + own, node.end
        if best and 2 * most > held:
            picks[name] = best, 3 * (words[best.end] - words[best.begin]) < 2 * every
    article, several = picks.get("article", (None, False))
    node = picks.get("main", (article, False))[0] if several or not article else article
    if node:
        return node.begin, node.end
    if not held:
        return 0, 0
    first = next(k for k in range(begin, end) if words[k + 1] > words[k])
    last = next(k for k in range(end - 1, begin - 1, -1) if words[k + 1] > words[k])
    node = found[first].node
    while not (node.begin <= first and last < node.end):
        node = node.parent
    low, high = first, last + 1
    while True:
        units = [(node.begin, node.end)] if not node.children else _units(node)
        a = next(k for k, u in enumerate(units) if u[1] > low)
        b = next(k for k in range(len(units) - 1, -1, -1) if units[k][0] < high)
        while a and scores[units[a - 1][1]] >= scores[units[a - 1][0]]:
            a -= 1
        while b + 1 < len(units) and scores[units[b + 1][1]] >= scores[units[b + 1][0]]:
            b += 1
        low, high = units[a][0], units[b][1]
        if node.parent is None or words[low] > words[node.begin] or words[node.end] > words[high]:
            return low, high
        node = node.parent


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The text of the article: one line per block, words one space apart."""
    found, root = parsed(page or "")
    begin, end = whole(found, root, *region(found, weights), weights)
    lines, runs = [], []

    def finish() -> None:
        line = " ".join("".join(runs).split())
        if line:
            lines.append(line)
        runs.clear()

    for t in found[begin:end]:
        if t.name in BLOCKS:
            finish()
        elif t.name == "br":
            runs.append(" ")
        elif t.name is None and not t.junk:
            runs.append(t.text)
    finish()
    return "\n".join(lines)


def train(pages: DataFrame, page: str = "html", page_id: str = "page_id", most: int = 20_000) -> dict[str, float]:
    """Weights from about `most` pages at most, chosen by a hash of their id; those that mark their content teach."""
    share = min(1.0, most / max(1, pages.count()))
    own = pages.where(F.shiftrightunsigned(F.xxhash64(F.col(page_id)), 32) < int(share * 2**32)).select(F.col(page).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, total = Counter(), Counter()
        for batch in batches:
            for value in batch.column("_html"):
                found = tokens(value.as_py() or "")
                if not marked_once(found):
                    continue
                for t in found:
                    if t.junk or (t.name is None and not t.words):
                        continue
                    for seen in (0, 1):
                        name, n = feature(t, seen), max(1, t.words)
                        total[name] += n
                        inside[name] += n * t.marked
        names = [*total]
        yield pa.record_batch({"name": pa.array(names, pa.string()), "inside": pa.array([inside[n] for n in names], pa.int64()),
                               "outside": pa.array([total[n] - inside[n] for n in names], pa.int64())})

    sums = own.mapInArrow(run, "name string, inside long, outside long").groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    return learnt({r["name"]: (r["inside"], r["outside"]) for r in sums.collect()})  # element names times places: a few hundred at most


def extract(pages: DataFrame, weights: dict[str, float], page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: `page_id`, `url`, `text` and `n_chars`, its code points."""
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(value.as_py(), weights) for value in part.column("_html")]
                yield pa.record_batch({"page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array(texts, pa.string()),
                                       "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    kinds = ", ".join(f"{c} {own.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return own.mapInArrow(run, f"{kinds}, text string, n_chars long")
