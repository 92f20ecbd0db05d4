"""Operator 5: main text of web pages by composite text density.

1. A page is parsed into a tree (end tags that HTML lets authors omit are
   implied; comments, declarations, scripts and styles are dropped).  Menus,
   footers, asides, controls and hidden parts (by element, role or attribute) do
   not count.  Subtrees that are not article by name, and headers, forms and
   dialogs, do not count unless they hold more than a minor share (``MAJOR``,
   ``COMMENTS`` for reader comments) of the page's text outside links, or an
   ``article`` or ``main`` that does so beside the text around them: names like
   ``content has-sidebar`` stand for wrappers of the main text.  Without one in
   them, and with one elsewhere, ``COMMENTS`` is the share of the two.  Of a
   header inside an article only the headings count.  Where less than 1 -
   ``COMMENTS`` of the text would be left, no name is heeded; where none is,
   nothing but scripts, styles and embedded objects is dropped.
2. Every node gets its link-adjusted density: with C characters, T tags, LC
   link characters and LT link tags below it,
   ``C / T * log(C / LC * T / LT) / log(1 + ln(C / (C - LC) * LC + LCb / Cb * C + e))``
   (b is the body; zeros count as one; the 1 keeps the logarithm's base above
   one where a page has no links).
3. The densities of the children are summed; the node with the greatest sum is
   the core.  The threshold is the smallest density on the path from the body
   to the core.
4. If the core lies in an ``article`` or ``main`` element, that element is the
   main text.  Otherwise every subtree met on the way down from the body whose
   density reaches the threshold is.

Blocks are joined in page order by one space, white space inside a block
becomes one space, character references are decoded; nothing else is changed.

Defined results: one row per input row; null or empty html, or a page without
text, has the empty text and 0 characters.  Unclosed tags, comments or quotes
end with the page.  Extra columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
#: Elements without content, elements whose content is not markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Start tags that end an open paragraph.
BLOCK = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search "
    "section summary table ul dt dd tr td th thead tbody tfoot caption option body html "
    "legend".split())
#: Start tag -> the open elements of its kind that it ends, and where the search stops.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
           "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
#: Never main text; not main text where a page has any other, by element and role.
NEVER_TAG = frozenset("head svg math canvas object embed audio video map".split()) | RAW
CHROME_TAG = frozenset("nav footer aside menu search button select input label template "
                       "datalist".split())
CHROME_ROLE = frozenset("navigation banner contentinfo complementary search menu menubar toolbar "
                        "tooltip".split())
#: Not main text as long as it is a minor share, by element, role, and a word of class or id.
SKIP_TAG = frozenset("form fieldset dialog".split())
SKIP_ROLE = frozenset("form alert alertdialog dialog".split())
SKIP_WORD = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead banner footer "
    "sidebar aside rail widget widgets ad ads advert adverts advertisement advertisements "
    "advertising adsense adslot adbox sponsor sponsored promo promotion notice notices cookie "
    "cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup "
    "login register share sharing social related recommended recommendations teaser form search "
    "pagination pager toolbar copyright disclaimer".split())
COMMENT_WORD = frozenset("comment comments commentlist discussion disqus reply replies respond "
                         "feedback".split())
#: Share of the text from which a subtree of such a kind counts; comments may be longer
#: than what they comment on.
MAJOR, COMMENTS = 0.5, 0.9
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
KEEP = frozenset("html body article main".split())
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def _kind(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, float]:
    """Never text; hidden or chrome; share of the text from which it counts."""
    if tag in NEVER_TAG:
        return True, True, 0.0
    if tag in CHROME_TAG:
        return False, True, 0.0
    least = MAJOR if tag in SKIP_TAG or tag == "header" and not in_article else 0.0
    if tag in KEEP or not attrs.strip():
        return False, False, least
    found = {k.lower(): _html.unescape((v or "").strip("\"'")) for k, v in _ATTR.findall(attrs)}
    role = found.get("role", "").lower()
    if role in CHROME_ROLE or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or \
            re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return False, True, 0.0
    if role in SKIP_ROLE:
        least = MAJOR
    if tag in HEADING:
        return False, False, least
    words = {w.lower() for w in _WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    if not COMMENT_WORD.isdisjoint(words):
        least = COMMENTS
    elif not SKIP_WORD.isdisjoint(words):
        least = MAJOR
    return False, False, least


class Page:
    """The tree as parallel lists in page order; node 0 stands for the page."""

    def __init__(self, source: str):
        self.tag, self.parent = ["#page"], [-1]
        self.never, self.skip, self.least = [False], [False], [0.0]
        self.mute = [False]     # in an article's own header, outside its headings
        self.pieces: list[tuple[int, str]] = []      # (node, text); node -1: a break
        self._parse(source)
        self._prune()

    def _open(self, stack: list[int], tag: str, attrs: str) -> None:
        in_article = any(self.tag[i] in ("article", "main") for i in stack)
        never, skip, least = _kind(tag, attrs, in_article)
        top = stack[-1]
        self.tag.append(tag)
        self.parent.append(top)
        self.never.append(never or self.never[top])
        self.skip.append(skip or self.skip[top])
        self.least.append(least)
        self.mute.append(tag == "header" and in_article)
        stack.append(len(self.tag) - 1)

    def _prune(self) -> None:
        """Skip what is not main text by kind, and mute headers, where minor."""
        n, parent, least = len(self.tag), self.parent, self.least
        own = [0] * n
        for node, text in self.pieces:
            if node >= 0:
                own[node] += sum(map(len, text.split()))
        in_link, article = [False] * n, [False] * n
        name = [0] * n          # the nearest named element, or the page
        for i in range(1, n):
            p = parent[i]
            in_link[i] = in_link[p] or self.tag[i] == "a"
            name[i] = i if least[i] else name[p]
            article[i] = article[p] or self.tag[i] in ("article", "main")
        weight = [0 if in_link[i] or self.skip[i] else own[i] for i in range(n)]
        rest = [0] * n          # text in the named elements around, and in no other
        for i in range(n):
            rest[name[i]] += weight[i]
        for i in range(1, n):
            if least[i]:
                rest[i] += rest[name[parent[i]]]
        for i in range(n - 1, 0, -1):
            weight[parent[i]] += weight[i]
        most = [0] * n          # the longest article in the subtree
        for i in range(n - 1, 0, -1):
            if article[i] and not article[parent[i]]:
                most[i] = weight[i]
            most[parent[i]] = max(most[parent[i]], most[i])

        beside = max((most[i] for i in range(n) if article[i] and not name[i]), default=0)

        def minor(i: int, share: float) -> bool:
            inside = 0 if article[i] else most[i]
            if inside and inside >= share * (inside + rest[name[parent[i]]]):
                return False
            if not inside and not article[i] and weight[i] < COMMENTS * (weight[i] + beside):
                return True     # the page has an article elsewhere
            return not weight[i] or weight[i] < share * weight[0]

        bare = list(self.skip)
        for i in range(1, n):
            p = parent[i]
            self.skip[i] = self.skip[i] or self.skip[p] or least[i] > 0 and minor(i, least[i])
            self.mute[i] = self.mute[i] and weight[i] < MAJOR * weight[0] or \
                self.mute[p] and self.tag[i] not in HEADING
        left = [i for i in range(n) if own[i] and not self.skip[i] and not self.mute[i]]
        if sum(own[i] for i in left if not in_link[i]) < (1 - COMMENTS) * weight[0]:
            self.skip, self.mute = bare, [False] * n
            left = [i for i in range(n) if own[i] and not bare[i]]
        if not left:
            self.skip, self.mute = self.never, [False] * n

    def _close_kind(self, stack: list[int], ends: set, stop: set) -> None:
        for at in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[at]]
            if name in ends:
                del stack[at:]
                return
            if name in stop:
                return

    def _parse(self, source: str) -> None:
        stack, at, n = [0], 0, len(source)
        tag = self.tag
        while at < n:
            m = _TOKEN.search(source, at)
            to = m.start() if m else n
            if to > at:
                self.pieces.append((stack[-1], _html.unescape(source[at:to])))
            if not m:
                break
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            block = name in BLOCK or name == "br"
            if block:
                self.pieces.append((-1, " "))
            if m[1]:
                for i in range(len(stack) - 1, 0, -1):
                    if tag[stack[i]] == name:
                        del stack[i:]
                        break
                    # an end tag does not reach out of a table cell or an article
                    if tag[stack[i]] in ("td", "th", "table", "article", "main", "body") and \
                            name not in ("table", "tr", "tbody", "thead", "tfoot", "article",
                                         "main", "body", "html", "section", "div"):
                        break
                continue
            if name in BLOCK:
                self._close_kind(stack, {"p"}, {"table", "button", "object", "td", "th"})
            if name in IMPLIED:
                self._close_kind(stack, *IMPLIED[name])
            if name == "body":
                self._close_kind(stack, {"head"}, set())
            self._open(stack, name, m[3] or "")
            if name in VOID:
                stack.pop()
            elif name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = end.start() if end else n
                # its end tag closes it like any other

    def main_nodes(self) -> set[int]:
        """Roots of the subtrees that hold the main text."""
        n = len(self.tag)
        chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text in self.pieces:
            if node >= 0 and not self.skip[node] and not self.mute[node]:
                chars[node] += sum(map(len, text.split()))
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.tag[i] == "a"
            if in_link[i]:
                links[i] = chars[i]
        for i in range(n - 1, 0, -1):
            if not self.skip[i]:
                p = self.parent[i]
                chars[p] += chars[i]
                links[p] += links[i]
                tags[p] += tags[i] + 1
                link_tags[p] += link_tags[i] + (self.tag[i] == "a")
        body = next((i for i in range(n) if self.tag[i] == "body"), 0)
        if not chars[body]:
            body = 0
        if not chars[body]:
            return set()
        ratio = links[body] / chars[body]
        density, total = [0.0] * n, [0.0] * n
        for i in range(n):
            if chars[i] and not self.skip[i]:
                c, t, lc, lt = chars[i], tags[i] or 1, links[i] or 1, link_tags[i] or 1
                base = 1 + log(c / ((c - links[i]) or 1) * links[i] + ratio * c + e)
                density[i] = c / t * max(0.0, log(c / lc * t / lt)) / log(base)
                if i:
                    total[self.parent[i]] += density[i]
        inside = [False] * n
        for i in range(n):
            inside[i] = i == body or (i > 0 and inside[self.parent[i]])
        core = max((i for i in range(n) if inside[i] and not self.skip[i]),
                   key=lambda i: (total[i], -i), default=body)
        path, i = [core], core
        while i != body:
            i = self.parent[i]
            path.append(i)
        for name in ("article", "main"):
            for i in reversed(path):            # the outermost one
                if self.tag[i] == name:
                    return {i}
        least = min(density[i] for i in path)
        # down from the body: whole subtrees that are dense enough
        return {i for i in range(n) if inside[i] and self.parent[i] in path[1:] + [body]
                and (i in path[:1] or (i not in path and density[i] >= least))} | \
            ({body} if core == body else set())

    def text(self) -> str:
        roots = self.main_nodes()
        if not roots:
            return ""
        inside = [False] * len(self.tag)
        for i in range(len(self.tag)):
            inside[i] = (i in roots or (i > 0 and inside[self.parent[i]])) and not self.skip[i]
        return " ".join("".join(t for i, t in self.pieces
                                if i < 0 or inside[i] and not self.mute[i]).split())


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def _extract(batches):
    for b in batches:
        texts = [main_text(h.as_py()) for h in b.column("html")]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract_html(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page row."""
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
