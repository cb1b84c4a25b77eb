"""Main text of web pages, by paths that a host's pages agree on.

Every page is read once to find its main container: the smallest one that covers nearly all of the page's text outside links
and outside elements that look like menus, headers, footers, sidebars, notices, adverts, forms or comments, and from there up
to the article or main element it is in and to the page's h1. It votes with its path, tags with classes from the root, digits
generalised. Spark adds the votes up by host and path. The host's winner, if a page has it, is then extracted from the page.
Where it covers clearly less of a page than the page's own main container, the page's own is extracted; what half of the
host's pages have outside their main container does not count for that.

Votes are added up per task before they are shuffled, so a host with a third of all pages is no hot key; winners are one
row a host, stored, and Spark chooses broadcast or a skew-split join by their size.

Defined results: NULL or empty html gives an empty text; pages without a host share one; repeated rows stay apart; a page
whose containers are all boilerplate gives an empty text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.storage import materialize

# Roles of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
DROPPED = frozenset(
    "head nav footer aside form script style noscript template iframe svg math canvas object embed audio video button "
    "select option textarea input dialog menu title".split()
)
CONTAINERS = frozenset("article body center div main section table tbody td tr html".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
BOILERPLATE = frozenset(
    "ad ads adsense advert advertisement advertising advertisements banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices "
    "pagination popup popups promo promoted promotion related respond replies reply search share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: Names that inside an article are also those of its parts: "social-issues", "related-work", "article-header".
LOOSE = frozenset(
    "banner consent cookie cookies footer header login menu menus notice notices related search share sharing social "
    "subscription widget widgets".split()
)
#: Names that say nothing about the text beside others.
NEUTRAL = frozenset(
    "area articles bar block body bottom box btn button buttons container content form group icons inline inner item items "
    "left link links list module outer panel posts right section slot stories text top unit wrap wrapper".split()
)
#: Names in classes of elements whose own header belongs to the text.
ARTICLE = frozenset("article blog content entry main post story text".split())
#: Elements that end at the start of another one.
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
    "tbody": frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]),
}
#: Where the search for an element to end stops.
SCOPE = {"li": frozenset(["ul", "ol", "menu"]), "tr": frozenset(["table"]), "td": frozenset(["table"]), "th": frozenset(["table"]),
         "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "option": frozenset(["select"]), "tbody": frozenset(["table"])}

#: How markup begins, and the rest of a tag. Quotes are quotes only after an equals sign; nothing is tried twice.
_START = re.compile(r"<(?:(!--)|(!\[CDATA\[)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_TAG_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+>""")
#: Elements deeper than this are taken as beside each other, as browsers do.
MAX_DEPTH = 512
_INVISIBLE = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
#: One attribute whole, so that names and values inside the values of others are not taken for attributes.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: Share of a page's text that its main container covers, and share of that below which a host's winner is not used.
COVER = 0.9
CLEARLY_LESS = 0.8
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"[0-9]+")


class Page:
    """Elements and text pieces of a page in order.

    Elements are (parent, tag, class path part, dropped); pieces are (element, number of the block, text). Names in classes
    and ids alone do not drop an article or main element, nor one that holds most of the page's unlinked text, unless all
    its names are those of boilerplate or another article holds text elsewhere.
    """

    def __init__(self, source: str):
        self.parent, self.tag, self.label, self.dropped = [-1], ["#root"], [""], [False]
        self.pieces: list[tuple[int, int, str]] = []
        #: Elements that only their class or id drops: whether all its names are those of boilerplate, and whether they
        #: may be those of a part of an article.
        self._named: dict[int, tuple[bool, bool]] = {}
        self._article: dict[int, bool] = {}
        self._parse(source)
        if self._named:
            self._drop_named()

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        found: dict[str, str] = {}
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        classes = sorted(set(_DIGITS.sub("#", found.get("class", "")).split()))
        names = {t.lower() for t in _TOKEN.findall(f"{found.get('class', '')} {found.get('id', '')}")}
        out = tag in DROPPED or found.get("role", "").lower() in ROLES or "hidden" in found
        out |= found.get("aria-hidden", "").lower() == "true" or bool(_INVISIBLE.search(found.get("style", "")))
        if tag == "header":
            # the page header goes, the heading of an article stays
            out |= not self._in_article(parent)
        elif tag not in ("html", "body", "main", "h1", "p", "b", "i", "em", "strong"):
            if names & BOILERPLATE and not out:
                every = _WORD.findall(f"{found.get('class', '')} {found.get('id', '')}".lower())
                known, others = names & BOILERPLATE, {t for t in names - BOILERPLATE if len(t) > 1}
                loose = known <= LOOSE and (known == {"header"} or not others <= NEUTRAL)
                self._named[len(self.tag)] = BOILERPLATE.issuperset(every), loose
        self.parent.append(parent)
        self.tag.append(tag)
        self.label.append(".".join([tag, *classes]))
        self.dropped.append(out)
        return len(self.tag) - 1

    def _drop_named(self) -> None:
        """Decides on the elements that only a name drops."""
        n = len(self.tag)
        hidden, linked, article, outer = self.hidden(), [False] * n, [False] * n, [False] * n
        below_name = [False] * n
        for i in range(1, n):
            p = self.parent[i]
            linked[i] = linked[p] or self.tag[i] == "a"
            outer[i] = article[p]
            article[i] = article[p] or self.tag[i] in ("article", "main")
            below_name[i] = below_name[p] or i in self._named and not (self.tag[i] in ("article", "main") and not outer[i])
        size, in_article, links, headed = [0] * n, [0] * n, [0] * n, [t == "h1" for t in self.tag]
        for i, _, text in self.pieces:
            if not hidden[i]:
                length = len(text) - text.count(" ") - text.count("\n")
                if linked[i]:
                    links[i] += length
                    continue
                size[i] += length
                in_article[i] += length if article[i] and not below_name[i] else 0
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            size[p] += size[i]
            in_article[p] += in_article[i]
            links[p] += links[i]
            headed[p] |= headed[i]
        for i, (only_boilerplate, loose) in self._named.items():
            if self.tag[i] in ("article", "main") and not outer[i]:
                continue
            if outer[i] and (headed[i] or loose and links[i] <= size[i]):
                continue
            # what is inside an article is measured by it, and an article elsewhere is the article
            spared = not only_boilerplate and 2 * size[i] > size[0] and (outer[i] or in_article[0] == in_article[i])
            self.dropped[i] = not spared

    def _in_article(self, i: int) -> bool:
        above = []
        while i > 0 and i not in self._article:
            above.append(i)
            if self.tag[i] in ("article", "main") or ARTICLE & set(_TOKEN.findall(self.label[i].partition(".")[2].lower())):
                self._article[i] = True
                break
            i = self.parent[i]
        found = self._article.get(i, False)
        # every element is looked at once
        self._article.update(dict.fromkeys(above, found))
        return found

    def _parse(self, source: str) -> None:
        stack, block, at = [0], 0, 0
        opened: Counter[str] = Counter()
        low, last, quotes = None, source.rfind(">"), True

        def cut(k: int) -> None:
            opened.subtract(self.tag[i] for i in stack[k:])
            del stack[k:]

        while True:
            m = _START.search(source, at)
            if m and m[4] and m.start() > last:
                # no tag ends from here on
                m = None
            text = source[at : m.start()] if m else source[at:]
            if text:
                self.pieces.append((stack[-1], block, text))
            if not m:
                return
            if m[4] is None:
                mark = "-->" if m[1] else "]]>" if m[2] else ">"
                end = source.find(mark, m.end())
                if m[2]:
                    self.pieces.append((stack[-1], block, entities.escape(source[m.end() : end if end >= 0 else len(source)])))
                at = end + len(mark) if end >= 0 else len(source)
                continue
            rest = _TAG_REST.match(source, m.end()) if quotes else None
            # a page whose quotes run to its end is read without quotes from there
            quotes = rest is not None
            at = rest.end() if rest else source.find(">", m.end()) + 1
            attributes, tag = source[m.end() : at - 1], m[4].lower()
            if tag in BLOCKS:
                block += 1
            elif tag == "br":
                self.pieces.append((stack[-1], block, " "))
            if m[3]:
                if opened[tag] > 0:
                    cut(next(k for k in range(len(stack) - 1, 0, -1) if self.tag[stack[k]] == tag))
                continue
            ends, scope = CLOSED_BY.get(tag, frozenset()), SCOPE.get(tag, frozenset())
            if tag in BLOCKS and (opened["p"] > 0 or any(opened[t] > 0 for t in ends)):
                for k in range(len(stack) - 1, 0, -1):
                    name = self.tag[stack[k]]
                    if name in ends or (name == "p" and tag not in ends):
                        cut(k)
                        if name != "p" or not ends:
                            break
                    elif name in scope or (name in BLOCKS and not ends):
                        break
            elif tag not in BLOCKS and ends and self.tag[stack[-1]] in ends:
                cut(len(stack) - 1)
            node = self._open(stack[-1], tag, attributes)
            if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
                continue
            if tag in RAW:
                low = low or source.lower()
                end = low.find(f"</{tag}", at) if len(low) == len(source) else -1
                if end < 0:
                    close = re.compile(f"</{re.escape(tag)}", re.I).search(source, at)
                    end = close.start() if close else len(source)
                self.pieces.append((node, block, source[at:end]))
                at = source.find(">", end) + 1 or len(source)
                continue
            if len(stack) < MAX_DEPTH:
                stack.append(node)
                opened[tag] += 1

    def path(self, i: int) -> str:
        parts = []
        while i > 0:
            parts.append(self.label[i])
            i = self.parent[i]
        return "/".join(reversed(parts))

    def hidden(self) -> list[bool]:
        """By element: whether it or one above it is dropped."""
        out = [False]
        for i in range(1, len(self.tag)):
            out.append(self.dropped[i] or out[self.parent[i]])
        return out

    def sizes(self, hidden: list[bool]) -> list[int]:
        """By element: the characters in it outside links, hidden elements and white space."""
        linked, size = [False], [0] * len(self.tag)
        for i in range(1, len(self.tag)):
            linked.append(linked[self.parent[i]] or self.tag[i] == "a")
        for i, _, text in self.pieces:
            if not hidden[i] and not linked[i]:
                size[i] += sum(map(len, text.split()))
        for i in range(len(size) - 1, 0, -1):
            size[self.parent[i]] += size[i]
        return size

    def best(self, hidden: list[bool] | None = None) -> int | None:
        """The main container: the smallest one with nearly all text, or the article around it, with the first h1."""
        hidden = self.hidden() if hidden is None else hidden
        size = self.sizes(hidden)
        if not size[0]:
            return None
        # the containers with so much text are one inside the other, the last one is the smallest
        found = max(i for i in range(len(size)) if size[i] >= COVER * size[0] and (not i or self.tag[i] in CONTAINERS))
        above = self._above(found)
        article = next((i for i in above if self.tag[i] in ("article", "main")), found)
        heading = next((i for i, _, text in self.pieces if not hidden[i] and text.strip() and self._in_h1(i)), None)
        if heading is not None:
            both = set(self._above(heading))
            common = next((i for i in self._above(article) if i in both and self.tag[i] in CONTAINERS), 0)
            if common and self.tag[common] not in ("html", "body"):
                return common
        return article

    def _above(self, i: int) -> list[int]:
        """An element and those it is in, from the inside."""
        out = []
        while i > 0:
            out.append(i)
            i = self.parent[i]
        return out

    def _in_h1(self, i: int) -> bool:
        return any(self.tag[k] == "h1" for k in self._above(i))

    def outside(self, best: int) -> list[str]:
        """Paths of the outermost containers with text that neither are in ``best`` nor hold it."""
        hidden = self.hidden()
        size, chain, skipped, out = self.sizes(hidden), {0, *self._above(best)}, [False], set()
        for i in range(1, len(self.tag)):
            p = self.parent[i]
            new = self.tag[i] in CONTAINERS and size[i] > 0 and i not in chain and not skipped[p]
            skipped.append(skipped[p] or new or i == best)
            if new:
                out.add(self.path(i))
        return sorted(out)

    def text(self, roots: list[int], hidden: list[bool]) -> str:
        """The text of some elements in page order, without what is hidden inside them."""
        chosen = set(roots)
        inside = [0 in chosen]
        for i in range(1, len(self.tag)):
            inside.append(i in chosen or inside[self.parent[i]])
        blocks: dict[int, list[str]] = {}
        for i, block, text in self.pieces:
            if inside[i] and not hidden[i]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join(entities.unescape("".join(b)).split()) for b in blocks.values())
        return "\n\n".join(x for x in lines if x)


def vote(source: str) -> str | None:
    """The path of a page's main container."""
    return ballot(source)[0]


def ballot(source: str) -> tuple[str | None, list[str]]:
    """The path of a page's main container, and the paths of the outermost containers outside it."""
    page = Page(source)
    best = page.best()
    return (page.path(best), page.outside(best)) if best else (None, [])


def main_text(source: str, path: str | None, outside: Sequence[str] = ()) -> str:
    """Text of the elements at ``path``; of the page's main container where those hold none or clearly less.

    Elements at the paths of ``outside`` do not count for the page's main container unless the page has no other text.
    """
    page = Page(source)
    hidden = page.hidden()
    roots = [i for i in range(1, len(page.tag)) if not hidden[i] and page.path(i) == path] if path else []
    own_hidden, size = hidden, page.sizes(hidden)
    if outside:
        holds = {k for i in roots for k in page._above(i)}
        own_hidden = [False]
        for i in range(1, len(page.tag)):
            own_hidden.append(hidden[i] or own_hidden[page.parent[i]] or i not in holds and page.path(i) in outside)
    best = page.best(own_hidden)
    if roots and (best is None or sum(size[i] for i in roots) >= CLEARLY_LESS * page.sizes(own_hidden)[best]):
        text = page.text(roots, hidden)
        if text:
            return text
    if best is None:
        best, own_hidden = page.best(), hidden
    return "" if best is None else page.text([best], own_hidden)


def host(url: Column) -> Column:
    """Lower-case host name of a URL, empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, outside): the container path that most pages of a host vote for; ties go to the smallest path.

    ``outside`` are the paths that at least half of the host's pages have outside their main container, and more pages than
    vote for them.
    """

    @F.pandas_udf("path string, outside array<string>")
    def votes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for htmls in batches:
            yield pd.DataFrame([ballot(h) for h in htmls], columns=["path", "outside"], dtype=object)

    each = pages.select(host(F.col("url")).alias("host"), votes(F.coalesce("html", F.lit(""))).alias("v"))
    told = lambda path, n, out: F.struct(path.alias("path"), F.lit(n).alias("n"), F.lit(out).alias("out"))
    both = F.concat(F.array(told(F.col("v.path"), 1, 0)), F.transform("v.outside", lambda x: told(x, 0, 1)))
    each = each.where(F.col("v.path").isNotNull()).select("host", F.explode(both).alias("x")).select("host", "x.*")
    counts = each.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("out").alias("out"))
    counts = materialize(counts, "path-counts")
    first = F.min(F.when(F.col("n") > 0, F.struct((-F.col("n")).alias("n"), "path")))
    winners = counts.groupBy("host").agg(first["path"].alias("path"), F.sum("n").alias("votes"))
    common = counts.where("out > n").join(winners.select(F.col("host").alias("of"), "votes"), F.col("host") == F.col("of"))
    common = common.where("2 * out >= votes").groupBy(F.col("host").alias("of")).agg(F.sort_array(F.collect_list("path")).alias("outside"))
    return winners.join(common, F.col("host") == F.col("of"), "left").select("host", "path", "outside")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, paths, outside in batches:
            out = [main_text(h, p, () if o is None else set(o)) for h, p, o in zip(htmls, paths, outside)]
            yield pd.Series(out, dtype=object)

    winners = materialize(host_paths(pages), "host-paths").withColumnRenamed("host", "w_host")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host(F.col("url")).alias("host"))
    rows = rows.join(winners, F.col("host") == F.col("w_host"), "left")
    return rows.select("page_id", "url", texts("html", "path", "outside").alias("text"))
