"""Main text of web pages by consensus host paths (operator 4).

Every page scores its containers and names the one that holds its article, as
a generalised path of tags and classes (digits dropped).  Spark counts these
votes per host; the paths that a fair share of a host's pages name win.  All
pages are then read again with their host's winning paths, so a page whose own
score misleads (a short article under long comments) follows its siblings.  A
page without any winning path keeps its own choice.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.llm.common import fresh, stored
from cellwise.llm.urls import host_path

#: A path wins if at least this share of the host's pages votes for it (so at
#: most 1/share paths win).
MIN_SHARE = 0.15

# HTML element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template svg math select object".split())
CONTAINER = frozenset("html body main article section div td center blockquote form".split())
BLOCK = CONTAINER | frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr th caption pre hr figure figcaption "
    "header footer aside nav menu address details summary fieldset dialog head".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT = HEADING | frozenset("p li dt dd td th pre blockquote figcaption".split())
NEVER = frozenset("head nav footer aside menu form button dialog canvas audio video label legend fieldset".split())
#: Start tags that end an open element of the named kinds.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
#: Words of a class, id or role that mark what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu "
    "nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert "
    "popup modal overlay comment comments disqus respond reply replies share sharing social related recommended "
    "newsletter subscribe subscription signup login search widget toolbar pagination pager skip "
    "complementary contentinfo dialog form".split())
#: Of these, what may be long and hold article elements of its own.
TALK_WORDS = frozenset("comment comments disqus respond reply replies cookie cookies consent gdpr".split())
HEAD_WORDS = frozenset("header topbar".split())
#: A class such as no-sidebar describes the layout, not the element.
LAYOUT = frozenset("no has with without is".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


def _attributes(attrs: str) -> dict[str, str]:
    """Attribute names (lower case) and values; of repeated ones the first."""
    found: dict[str, str] = {}
    for name, value in _ATTR.findall(attrs):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def _hidden(attrs: dict[str, str]) -> bool:
    return ("hidden" in attrs or attrs.get("aria-hidden", "").strip().lower() == "true"
            or _NO_DISPLAY.search(attrs.get("style", "")) is not None)


def _marks(attrs: dict[str, str], words: frozenset, all_names: bool = False) -> bool:
    """Whether a name in class, id or role (or all of them) has one of the words."""
    hits = [bool(parts) and parts[0] not in LAYOUT and not words.isdisjoint(parts)
            for key in ("class", "id", "role") if key in attrs
            for parts in map(_WORD.findall, attrs[key].lower().split())]
    return all(hits) and bool(hits) if all_names else any(hits)


def _label(tag: str, attrs: dict[str, str]) -> str:
    """Tag and classes, generalised: digits dropped, classes sorted."""
    names = {_DIGITS.sub("", c) for c in attrs.get("class", "").split()} - {""}
    return ".".join([tag, *sorted(names)])


class Page:
    """The containers of a page and its text blocks outside of what is never
    article (menus, notices, adverts, comments and the like)."""

    def __init__(self, html: str, forms: bool = False, words: bool = True, shown: frozenset = frozenset()):
        self.paths: list[str] = [""]        # container -> generalised path
        self.parents: list[int] = [-1]
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self._forms = forms
        self._words = words
        self._shown = shown   # numbers of elements shown in spite of their class words
        self._asides: list[list] = []  # per element with class words: text, has an article, is talk
        self._plain = False   # an article element outside of them
        self._all = 0         # text outside of links
        self._read(html)

    def wrongly_hidden(self) -> frozenset:
        """Elements with class words that hold the page's article or most of
        its text outside of links."""
        return frozenset(k for k, (size, article, talk) in enumerate(self._asides) if not talk and size and (
            article and not self._plain or 2 * size > self._all))

    def _read(self, html: str) -> None:
        # (tag, container, hidden, link, headings only, asides around, hidden by more than class words)
        stack: list[tuple] = []
        text: list[str] = []
        links = 0
        where, hidden, link, heads, asides, never = 0, False, False, False, (), False

        def end_block():
            nonlocal links
            if text:
                t = " ".join("".join(text).split())
                if t:
                    self.blocks.append((where, t, links))
                text.clear()
                links = 0

        def back():
            return stack[-1][1:] if stack else (0, False, False, False, (), False)

        at, size, low = 0, len(html), None
        for_token = _TOKEN.search
        while at < size:
            m = for_token(html, at)
            stop = m.start() if m else size
            if stop > at and not never and not link:
                held = len(html[at:stop].strip())
                self._all += held
                for k in asides:
                    self._asides[k][0] += held
            if stop > at and not hidden and (not heads or any(e[0] in HEADING for e in stack)):
                piece = unescape(html[at:stop])
                text.append(piece)
                if link:
                    links += len(piece)
            if not m:
                break
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
            if closing:
                if tag in BLOCK:
                    end_block()
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), -1)
                # An end tag never closes a cell or container around it.
                if k >= 0 and (tag in BLOCK or not any(e[0] in BLOCK for e in stack[k + 1:])):
                    del stack[k:]
                    where, hidden, link, heads, asides, never = back()
                continue
            if tag in RAW:
                if not attrs.endswith("/"):
                    if low is None:
                        low = html.lower()
                        if len(low) != size:  # a few capitals grow when lowered
                            low = re.sub("[A-Z]+", lambda x: x[0].lower(), html)
                    at = low.find("</" + tag, at)
                    if at < 0:
                        break
                continue
            if tag == "br":
                text.append(" ")
                continue
            if tag in BLOCK:
                end_block()
                for k in range(len(stack) - 1, -1, -1):
                    open_tag = stack[k][0]
                    if open_tag == "p" or open_tag in ENDS.get(tag, ()):
                        del stack[k:]
                        where, hidden, link, heads, asides, never = back()
                        break
                    if open_tag in CONTAINER or open_tag in ("table", "ul", "ol", "dl"):
                        break
            if tag in VOID or attrs.endswith("/") and tag not in BLOCK:
                continue
            in_article = any(e[0] in ("article", "main") for e in stack)
            named = _attributes(attrs) if attrs else {}
            if tag not in ("html", "body", "main") and named:
                if _hidden(named):
                    hidden = never = True
                # A paragraph of the article may have a class word among others.
                elif self._words and _marks(named, ASIDE_WORDS, in_article and tag in TEXT):
                    hidden = hidden or len(self._asides) not in self._shown
                    asides += (len(self._asides),)
                    self._asides.append([0, False, _marks(named, TALK_WORDS)])
                elif _marks(named, HEAD_WORDS):
                    heads, hidden = True, hidden or not in_article
            if tag in ("article", "main") and not never:
                for k in asides:
                    self._asides[k][1] = True
                self._plain = self._plain or tag == "article" and not asides
            if tag in NEVER and not (tag == "form" and self._forms):
                hidden = never = True
            elif tag == "header":
                # A page header goes; of an article's header the title stays.
                heads, hidden = True, hidden or not in_article
            link = link or tag == "a"
            if tag in CONTAINER:
                self.paths.append(self.paths[where] + ">" + _label(tag, named))
                self.parents.append(where)
                where = len(self.paths) - 1
            stack.append((tag, where, hidden, link, heads, asides, never))
        end_block()

    def choice(self) -> tuple[str, float]:
        """The path of the container that holds the article, and its score.

        From the root down, into the path that holds most of the weight;
        weight is text outside of links, an article element counts threefold.
        """
        n = len(self.paths)
        weight = [0.0] * n
        for c, t, linked in self.blocks:
            w = max(0, len(t) - 2 * linked)
            while c >= 0:
                weight[c] += w
                c = self.parents[c]
        children: dict[str, dict[str, float]] = {}
        total: dict[str, float] = {"": weight[0]}
        for c in range(1, n):
            up, path = self.paths[self.parents[c]], self.paths[c]
            total[path] = total.get(path, 0.0) + weight[c]
            children.setdefault(up, {})[path] = total[path]
        path = ""
        while path in children:
            last = path.rsplit(">", 1)[-1].split(".")[0]
            if last == "article":
                break
            best = max(children[path], key=lambda p: (self._bonus(p) * total[p], p))
            held, bonus = total[best], self._bonus(best)
            rest = total[path] - held
            if not held or held * bonus < 2 * rest:
                break
            path = best
        return path, total[path]

    @staticmethod
    def _bonus(path: str) -> int:
        return 3 if path.rsplit(">", 1)[-1].split(".")[0] in ("article", "main") else 1

    def text(self, path: str) -> str:
        """The blocks inside the containers with this path, in page order."""
        inside = [False] * len(self.paths)
        for c, p in enumerate(self.paths):
            inside[c] = p == path or (c > 0 and inside[self.parents[c]])
        return "\n".join(t for c, t, _ in self.blocks if inside[c])


def read_page(html: str | None) -> Page:
    html = html or ""
    page = Page(html)
    shown = page.wrongly_hidden()
    if shown:
        page = Page(html, shown=shown)
    # Some pages wrap everything in one form, or in an element with class words.
    for forms, words in ((True, True), (False, False), (True, False)):
        if page.blocks:
            break
        page = Page(html, forms, words)
    return page


def extract(html: str | None, paths) -> str:
    """The text under the first of ``paths`` that has any, else under the
    page's own choice."""
    page = read_page(html)
    for p in paths if paths is not None else ():
        found = page.text(p)
        if found:
            return found
    return page.text(page.choice()[0])


def _votes(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_page(h).choice() for h in html], columns=["path", "score"])


def _texts(html: pd.Series, paths: pd.Series) -> pd.Series:
    return pd.Series([extract(h, p) for h, p in zip(html, paths)], dtype=object)


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html",
               min_share: float = MIN_SHARE) -> DataFrame:
    """(host, paths): each host's winning paths, most votes first.

    Only (host, path, score) rows are aggregated, map-side first, so a host
    with a third of all pages is a few rows per task.
    """
    vote = F.pandas_udf(_votes, "path string, score double")
    cast = pages.select(host_path(F.col(f"`{url_col}`").cast("string"))[0].alias("host"),
                        vote(F.col(f"`{html_col}`").cast("string")).alias("v"))
    # Counted twice below; stored, so that pages are read for votes once.
    votes = stored(cast.select("host", "v.path", "v.score").where("score > 0")
                   .groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score")), "path_votes")
    totals = votes.groupBy("host").agg(F.sum("n").alias("all"))
    won = votes.join(totals, "host").where(F.col("n") >= min_share * F.col("all"))
    return stored(won.groupBy("host").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("n", "score", "path")), asc=False),
        lambda x: x["path"]).alias("paths")), "host_paths")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    Null or empty HTML gives an empty text; a null URL or one without a host
    votes with the other hostless pages.  Repeated rows are extracted each; an
    empty table gives an empty result; extra columns are not read.
    """
    winners = host_paths(pages, url_col, html_col)
    host = fresh(pages, "host")
    text = F.pandas_udf(_texts, "string")
    thin = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"),
                        host_path(F.col(f"`{url_col}`").cast("string"))[0].alias(host))
    # The winners are a stored table, so the planner knows their size: a small
    # one is broadcast and the pages stay in place.
    found = thin.join(winners.withColumnRenamed("host", host), host, "left").select(
        "page_id", "url", text(F.col("html"), F.col("paths")).alias("text"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
