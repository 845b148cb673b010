"""Main text of web pages by line-block distribution.

Markup is stripped into lines: every block element gives one line of text, and
what can't be content (scripts, styles, navigation, headers, footers, sidebars,
notices, adverts, forms, reader comments) gives blank lines in its place. The
length of the text outside links is summed over sliding windows of lines; a
surge point is where the sum rises from nothing to a block of text, a dive
point where it falls back to nothing, and the lines between them are kept. On
a page that marks its article (article, main, or their roles) only the lines
inside it have a length, and any text there is a surge.

An element that would be left out is kept if it is or encloses the main part, or
the page's articles (for forms any article; for others if no article stands
outside such elements, so reader comments in articles of their own go), or if it
holds more than half of the page's text outside links (marked by class or a
form; not comments, and not nav, aside, footer, header). Such pages are read
twice. Class words count as a whole; headings, and ids of sections inside an
article, mark nothing.

Defined results: NULL and empty pages and pages without content give the empty
string; malformed markup (elements never closed, stray end tags, a page that
breaks off) is read as far as it goes; tables and lists inside the content are
kept; very long pages are read from front to back, twice at most; repeated rows and extra
columns pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3         # lines in a block
SURGE_CHARS = 80   # of a window, where no article is marked

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
NEVER = frozenset("script style noscript template head title nav aside footer form button select option textarea "
                  "iframe svg canvas object video audio menu dialog datalist map applet xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split())
OWN_KIND = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
            "th": ("tr", "table"), "option": ("select",)}

# Names that can be wrapped around content by mistake; a form is often a whole page.
WRAPS = frozenset("nav aside footer header form menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# A word of class, id or role marks an element as something else than content if all its
# hyphen parts are marks or mere places (related-posts; not related-work, has-sidebar).
MARK = re.compile(
    r"ads?|adverts?|advertis\w*|adsense|adslot|adbox|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|"
    r"sidebar\w*|aside|widget\w*|comments?|commentlist|respond|disqus\w*|replies|nav|navbar|navigation|navi|menu\w*|"
    r"breadcrumbs?|footer|foot|masthead|topbar|toolbar|share|sharing|social\w*|related|recommended|newsletter|"
    r"subscribe|subscription|signup|popup|modal|overlay|pagination|pager|login|search|searchbox|complementary|"
    r"contentinfo|form|skiplink")
PLACE = re.compile(
    r"\d*|site|page|main|global|primary|secondary|top|bottom|left|right|header|head|body|inner|outer|box|block|bar|list|"
    r"area|zone|wrap|wrapper|container|holder|section|panel|group|row|col|column|item|items|unit|slot|space|link|links|"
    r"button|buttons|btn|btns|icon|icons|message|text|title|post|posts|article|articles|story|stories|us|this|skip|thread")
# Marks of what is never the page's text, however long it is.
FIRM = re.compile(
    r"comments?|commentlist|respond|disqus\w*|replies|cookies?|consent|gdpr|notices?|newsletter|subscribe|subscription|"
    r"signup|ads?|adverts?|advertis\w*|adsense|adslot|adbox|sponsor\w*|promo\w*")
HEADER_MARKS = frozenset(("site-header", "siteheader", "page-header", "pageheader", "header", "banner"))
MAIN_MARK = re.compile(r"""\brole\s*=\s*["']?(?:main|article)\b""", re.I)
MAIN_ROLE = re.compile(r"""\brole\s*=\s*["']?main\b""", re.I)
ATTR = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>", re.S)


@lru_cache(maxsize=65536)
def marked(word: str) -> tuple[bool, bool]:
    """Whether a word of class, id or role marks other things than content, and whether these never are content."""
    parts = word.split("-")
    if not any(map(MARK.fullmatch, parts)) or not all(MARK.fullmatch(x) or PLACE.fullmatch(x) for x in parts):
        return False, False
    return True, any(map(FIRM.fullmatch, parts))


class Wrapper:
    """An element to leave out: where it began in the counts of the page, and at its end what it holds."""

    def __init__(self, page: Page, name: str, by_name: bool, firm: bool):
        self.name, self.fixed, self.in_main = name, (by_name and name != "form") or firm, page.mains_open > 0
        self.chars, self.articles, self.mains = -page.seen, -page.articles, -page.mains

    def end(self, page: Page) -> None:
        self.chars, self.articles, self.mains = self.chars + page.seen, self.articles + page.articles, self.mains + page.mains

    def spared(self, page: Page) -> bool:
        """Whether leaving it out would take the page's article, its main part or most of its text."""
        if self.mains or self.articles and self.name == "form":
            return True
        if self.articles and not page.free and (self.in_main or not page.mains):
            return True
        return not self.fixed and 2 * self.chars > page.seen


class Page:
    """Lines of one page: text, characters outside links, and inside an article or not.

    Elements numbered in ``spared`` (in the order of their start tags) are not left out.
    """

    def __init__(self, source: str, spared: frozenset[int] = frozenset()):
        self.spare = spared
        self.opened = self.hard = self.seen = 0             # start tags, open elements that never hold content, text outside them
        self.articles = self.mains = self.free = 0          # articles not inside another, main parts, articles in no wrapper
        self.articles_open = self.mains_open = self.wrapped = 0
        self.wrappers: dict[int, Wrapper] = {}
        self.lines: list[tuple[str, int, bool]] = []
        self.stack: list[tuple[str, bool, bool, int, bool]] = []   # name, left out, article, number, never content
        self.out = self.inside = self.links = 0
        self.text: list[str] = []
        self.plain = 0
        self._read(source)
        self._flush()
        for w in [self.wrappers[n] for _, _, _, n, _ in self.stack if n in self.wrappers]:  # never closed
            w.end(self)

    def _flush(self) -> None:
        line = " ".join("".join(self.text).split())
        if line:
            self.lines.append((line, self.plain, self.inside > 0))
        self.text, self.plain = [], 0

    def _gap(self) -> None:
        self._flush()
        self.lines.extend([("", 0, False)] * WINDOW)

    def _add(self, raw: str, decode: bool = True) -> None:
        if raw and not self.hard:
            text = html.unescape(raw) if decode and "&" in raw else raw
            chars = 0 if self.links else sum(map(len, text.split()))
            self.seen += chars
            if not self.out:
                self.text.append(text)
                self.plain += chars

    def _left_out(self, name: str, attrs: str) -> tuple[bool, bool, bool]:
        """Whether an element is left out, whether for its name, and whether it never holds the page's text."""
        if name in NEVER:
            return True, True, False
        if name in ("html", "body", "main"):
            return False, False, False
        if name == "header" and not self.inside:
            return True, True, False
        if not attrs:
            return False, False, False
        found = firm = hidden = False
        for kind, a, b, c in ATTR.findall(attrs):
            kind, value = kind.lower(), (a or b or c).lower()
            if kind == "hidden" or kind == "aria-hidden" and value.strip() == "true" or kind == "style" and NO_DISPLAY.search(value):
                hidden = True
            if kind not in ("class", "id", "role") or name in HEADINGS:
                continue
            for word in value.replace("_", "-").split():
                mark, never = marked(word)
                if kind == "id" and name == "section" and self.inside and not never:
                    continue  # the name of a section of the text
                found = found or mark or (not self.inside and word in HEADER_MARKS)
                firm = firm or never
        return found or hidden, False, firm

    def _open(self, name: str, attrs: str) -> None:
        if name in CLOSES_P and any(x[0] == "p" for x in self.stack):
            self._close("p", ("table", "td", "th", "button", "object"))
        if name in OWN_KIND:
            self._close(name, OWN_KIND[name])
        if name not in INLINE and not self.out:
            self._flush()
        if name in VOID or attrs.endswith("/") and name in ("svg", "path"):
            return
        number = self.opened
        self.opened += 1
        left, by_name, firm = self._left_out(name, attrs)
        left = left and number not in self.spare
        hard = left and name in NEVER and name not in WRAPS
        if left and not hard and not self.hard:
            self.wrappers[number] = Wrapper(self, name, by_name, firm)
            self.wrapped += 1
        content = name in ("article", "main") or bool(attrs and MAIN_MARK.search(attrs))
        if content and not self.hard:
            self._count(name, attrs)
        article = not left and content
        if (left or article) and not self.out:
            self._gap()
        self.stack.append((name, left, article, number, hard))
        self.out += left
        self.hard += hard
        self.inside += article
        self.articles_open += name == "article"
        self.mains_open += name == "main"
        self.links += name == "a"

    def _count(self, name: str, attrs: str) -> None:
        if name == "main" or MAIN_ROLE.search(attrs):
            self.mains += 1
        elif not self.articles_open:
            self.articles += 1
            self.free += not self.wrapped

    def _close(self, name: str, walls: tuple[str, ...] = ()) -> None:
        """Close the innermost open ``name`` and all inside it, unless a wall stands between."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                break
            if self.stack[i][0] in walls:
                return
        else:
            return
        if not self.out and (name not in INLINE):
            self._flush()
        while len(self.stack) > i:
            closed, left, article, number, hard = self.stack.pop()
            if (left or article) and not self.out - left:
                self._gap()
            self.out -= left
            self.inside -= article
            if number in self.wrappers:
                self.wrappers[number].end(self)
                self.wrapped -= 1
            self.hard -= hard
            self.articles_open -= closed == "article"
            self.mains_open -= closed == "main"
            self.links -= closed == "a"

    def _read(self, source: str) -> None:
        at = 0
        for m in iter(lambda: TOKEN.search(source, at), None):
            self._add(source[at:m.start()])
            at = m.end()
            if m["cdata"]:
                self._add(m["cdata"], decode=False)
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                continue
            if m["end"] or m["end2"]:
                if name == "br":
                    self._flush() if not self.out else None
                self._close(name)
                continue
            self._open(name, m["attrs"] or m["attrs2"] or "")
            if name in RAW:
                close = re.compile(rf"</{name}\s*>", re.I).search(source, at)
                at = close.start() if close else len(source)
        self._add(source[at:])


def block_sums(lengths: list[int], window: int = WINDOW) -> list[int]:
    """Sum of the lengths over each window of lines that starts at a line."""
    sums, held = [0] * len(lengths), 0
    for i in range(len(lengths) - 1, -1, -1):
        held += lengths[i] - (lengths[i + window] if i + window < len(lengths) else 0)
        sums[i] = held
    return sums


def regions(lengths: list[int], surge: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Line ranges from a surge to the next dive: text from where the block sums
    rise above nothing to where they are nothing again, if they reach ``surge``."""
    sums = block_sums(lengths, window)
    found, start, peak = [], None, 0
    for i, s in enumerate([*sums, 0]):
        if s and start is None:
            start, peak = i, 0
        if start is not None:
            peak = max(peak, s)
            if not s:
                if peak >= surge:
                    found.append((start, i))
                start = None
    return found


def main_text(source: str | None) -> str:
    """The main text of a page, blocks joined by one space."""
    if not source:
        return ""
    page = Page(source)
    spared = frozenset(n for n, w in page.wrappers.items() if w.spared(page))
    lines = (Page(source, spared) if spared else page).lines
    if any(inside and text for text, _, inside in lines):
        lengths = [len(text) if inside else 0 for text, _, inside in lines]
        keep = regions(lengths, 1)
    else:
        # what was left out parts no region: a heading before an advert belongs to the text after it
        lines = [line for line in lines if line[0]]
        lengths = [plain for _, plain, _ in lines]
        keep = regions(lengths, SURGE_CHARS)
        if not keep:  # a short page: its longest blocks
            keep = regions(lengths, max([1, *block_sums(lengths)]))
        keep = [(keep[0][0], keep[-1][1])] if keep else []   # from the first surge to the last dive
    # a window also takes in empty lines (such as rows of links) next to the text
    keep = [(next(i for i in range(a, b) if lengths[i]), next(i for i in range(b - 1, a - 1, -1) if lengths[i]) + 1) for a, b in keep]
    marked = any(inside for _, _, inside in lines)
    return " ".join(text for a, b in keep for text, _, inside in lines[a:b] if text and (inside or not marked))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Add text and n_chars (code points); any columns of these names are replaced."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype=object)

    text = extracted(F.coalesce(F.col(html_col), F.lit("")))
    return pages.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
