"""Main text of web pages by site style trees.

Pages of one host are merged: elements with the same path of tag names and classes are one style node, compared over the host's
pages. A node's importance has two parts, both entropies: how differently its children are arranged (presentation, 0 where all
pages agree), and how rarely its texts come back (content, 0 where each text stands on all pages, 1 where each stands on one).
Menus, footers and notices repeat over a host; articles do not.

How far the entropies are believed grows with what they were taken from: a node's importance is the mean of 1 (``PRIOR`` times),
that of its host (once per page beyond the first) and that of the same path on all hosts, where a host counts like a page (once
per host beyond the first). So hosts with few pages are judged by the style they share with others. Copies count once: pages of a
host with the same longest text, if it has ``COPY_CHARS`` characters, or else with the same texts; for all hosts likewise.

In a page, the importance of a branch is composed from below: ``(1 - GAMMA**l)`` times the element's presentation and
``GAMMA**l`` times the mean of its ``l`` children, its own text being one of them with the content's importance. A text
is worth the mean over the branches that hold it (without ``html`` and ``body``) and itself, times what its names say beforehand:
``CLUTTER`` in elements that say so (``nav``, ``footer``, ``class="ad"``, ``id="comments"``, ...; a class or id says so as a whole
token, not by a part of it as in ``has-sidebar``) and outside of the article if the page marks one (``article``, ``main``,
``itemprop=articleBody``), ``ARTICLE`` for elements without a class inside of it. Texts worth less than ``LEAST`` are left out. Names weigh more than entropies
because entropies cannot tell a rotating advert from an article. ``names=False`` leaves the judgement to the tree. Forms, scripts,
styles and hidden elements never count. An article inside an element that is clutter for its class, id or role is used if the
page marks none elsewhere.

The statistics are counts per (host, style node, text hash): combined before the shuffle, so that a host with a third of all pages
is no single task's group. Importances are broadcast by host while there are at most ``BROADCAST_NODES`` and ``HOST_NODES`` of one
host; beyond that each page gets those of its own nodes by a join, with the same result.

The text: character references decoded, white space inside a block made one space, blocks in page order joined by a blank
line. Inline elements and ``br`` do not end a block. Defined cases: null and empty pages have an empty text; a null or
malformed url makes the host ``""``; repeated rows are extracted each and count once; an empty table gives an empty one; long
pages and deep nesting take memory in proportion to their length; broken markup is closed like browsers do for paragraphs
and list items. Columns of the input pass through; result names are replaced.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from millrace.llm.common import free_name, without
from millrace.session import stored

LEAST = 0.35
PRIOR = 3
GAMMA = 0.9
CLUTTER, ARTICLE = 0.3, 2.0
COPY_CHARS = 80
BROADCAST_NODES = 200_000
HOST_NODES = 1_000
SAID, NAMED, ALWAYS = 1, 2, 3  # clutter by class, id or role; by its tag; never a text

# fixed values: elements by their role
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe"}  # skipped to their end tag
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr"}
NAMED_TAGS = {"nav", "footer", "aside", "menu"}
LEFT_OUT = {"head", "title", "script", "style", "noscript", "template", "form", "button", "select", "textarea",
            "iframe", "svg", "canvas", "object", "embed", "audio", "video", "dialog", "input", "option", "datalist", "math"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
PARAGRAPH_ENDS = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
                  "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
_CLUTTER = (
    r"ads?|adverts?|advertisements?|advertising|adsense|banners?|sponsor(?:ed|s)?|promos?|promotions?|nav|navbar|navigation|menus?|"
    r"breadcrumbs?|footers?|headers?|masthead|topbar|toolbar|side-?bars?|comments?|commentlist|disqus|respond|replies|reply|cookies?|consent|gdpr|notices?|"
    r"alerts?|popups?|modals?|overlays?|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommended|"
    r"widgets?|pagination|pager|skip-link|copyright|legal|disclaimer")
# whole tokens of class and id: a word of clutter, or a known compound of one
UNWANTED = re.compile(
    rf"(?:{_CLUTTER}|(?:site|global|top|bottom|main|primary|secondary|left|right|mobile)[_-](?:nav|navbar|navigation|menu|side-?bar|footer)|"
    r"(?:site|global|top|page)[_-](?:header|footer|banner)|(?:header|footer|side-?bar|nav|menu)[_-](?:nav|navigation|menu|links|bar|widgets?|inner|left|right)|"
    r"(?:cookie|consent|gdpr|privacy|legal|copyright)s?[_-](?:notice|banner|bar|consent|popup|modal|overlay|message|text|law)|"
    r"(?:google|text|banner|top|side|sponsored)[_-]ads?|ads?[_-](?:banner|box|container|slot|unit|wrapper|block|top|side|bottom)|"
    r"(?:social|share|sharing)[_-](?:share|sharing|links|media|buttons?|icons?|bar)|(?:related|recommended)[_-](?:posts?|articles?|links|stories|content)|"
    r"comments?[_-](?:list|section|area|form|respond|wrapper|box)|comments-area|(?:newsletter|email)[_-](?:signup|form|box|subscribe)|"
    r"(?:login|signup|subscribe)[_-](?:form|box|modal|popup)|skip[_-](?:links?|nav))", re.I)
TITLES = {"entry-header", "post-header", "article-header"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_MARKUP = re.compile(r"""(?s)<(?:!--.*?(?:--!?>|\Z)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|"""
                     r"""([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


class Block(NamedTuple):
    element: int
    text: str
    article: bool
    named: bool   # in an element that says it is clutter
    second: bool  # of an article in such an element


class Page:
    """Text blocks of a page and its elements: parent, style node, arrangement of children. A path is a chain of hashes."""

    def __init__(self):
        self.stack: list[tuple[str, int, int, bool]] = []  # tag, element (-1 above all), left out, in an article
        self.inner: list[int] = []  # depths at which articles in clutter begin
        self.blocks: list[Block] = []
        self.parents, self.nodes, self.arranged, self.root, self.plain = [], [], [], [], []
        self.parts: list[str] = []

    def read(self, html: str) -> None:
        at = 0
        while True:
            mark = html.find("<", at)
            if mark < 0:
                self.text(html[at:])
                break
            found = _MARKUP.match(html, mark)
            if not found:  # a sign, not markup
                self.text(html[at:mark + 1])
                at = mark + 1
                continue
            if mark > at:
                self.text(html[at:mark])
            at = found.end()
            end, start, attributes, odd, odd_attributes = found.groups()
            if end:
                self.end(end.lower())
            elif start or odd:
                tag = (start or odd).lower()
                if tag in RAW:
                    closing = re.compile(rf"(?i)</{tag}[^>]*(?:>|\Z)").search(html, at)
                    at = closing.end() if closing else len(html)
                    continue
                self.start(tag, attributes or odd_attributes or "")
        self.flush()

    def text(self, data: str) -> None:
        if data:
            self.parts.append(unescape(data) if "&" in data else data)

    def flush(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            depth = len(self.stack)
            while depth and self.stack[depth - 1][0] in INLINE:
                depth -= 1
            _, element, out, article = self.stack[depth - 1] if depth else ("", -1, 0, False)
            if out < ALWAYS:
                self.blocks.append(Block(element, text, article, out > 0, bool(self.inner)))

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self.flush()
            closes = CLOSES.get(tag, set()) | ({"p"} if tag in PARAGRAPH_ENDS else set())
            if closes:
                self.close_open(closes)
            # an inline element that was left open ends with its block
            while self.stack and self.stack[-1][0] in INLINE:
                self.pop()
        if tag in VOID:
            return
        given = {}
        if attributes and not attributes.isspace():
            for name, *values in _ATTRIBUTE.findall(attributes):
                given.setdefault(name.lower(), unescape("".join(values)))
        kind = " ".join(sorted(given["class"].lower().split())) if "class" in given else ""
        _, element, out, article = self.stack[-1] if self.stack else ("", -1, 0, False)
        role = given.get("role", "").lower()
        begins = tag in ("article", "main") or role in ("article", "main") or "articlebody" in given.get("itemprop", "").lower()
        if begins and out == SAID:
            out = 0
            self.inner.append(len(self.stack))
        if tag == "header" and not article and not TITLES.intersection(kind.split()):
            out = max(out, SAID)
        if tag in NAMED_TAGS:
            out = max(out, NAMED)
        if tag in LEFT_OUT:
            out = ALWAYS
        if given:
            if not begins and tag not in ("html", "body") and (
                    role in ROLES or any(UNWANTED.fullmatch(x) for x in f"{given.get('class', '')} {given.get('id', '')}".split())):
                out = max(out, SAID)
            if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "").lower():
                out = ALWAYS
        article = article or begins
        if tag not in INLINE and out < ALWAYS:
            node = f"{tag}.{kind}" if kind else tag
            above = 0
            if element >= 0:
                above = self.nodes[element]
                self.arranged[element] = chained(node, self.arranged[element])
            self.parents.append(element)
            self.nodes.append(chained(node, above))
            self.arranged.append(0)
            self.root.append(tag in ("html", "body"))
            self.plain.append(not kind)
            element = len(self.nodes) - 1
        self.stack.append((tag, element, out, article))

    def pop(self) -> None:
        self.stack.pop()
        if self.inner and self.inner[-1] == len(self.stack):
            self.inner.pop()

    def close_open(self, tags: set[str]) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag in tags:
                while len(self.stack) > i:
                    self.pop()
                return
            if tag not in INLINE:
                return

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self.pop()
                return
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return


    def looks(self) -> dict[tuple[int, bool, int], int]:
        """How often the page shows ``(node, is a text, hash)``: per node one arrangement, and every text of its own."""
        arranged: dict[int, int] = {}
        for node, children in zip(self.nodes, self.arranged, strict=True):
            arranged[node] = chained(str(children), arranged.get(node, 0))
        seen = {(node, False, look): 1 for node, look in arranged.items()}
        for block in self.blocks:
            if block.element >= 0:
                key = self.nodes[block.element], True, chained(block.text, 0)
                seen[key] = seen.get(key, 0) + 1
        return seen

    def copy_key(self) -> int:
        """The hash that copies of a page share: of its longest text, or of all if that is short."""
        texts = [b.text for b in self.blocks if not b.named]
        longest = max(texts, key=len, default="")
        return chained(longest if len(longest) >= COPY_CHARS else "\n".join(texts), 0)

    def main_text(self, known: dict[int, tuple[float, float]], names: bool) -> str:
        """The texts worth keeping, by the importances ``node: (presentation, content)`` of style nodes."""
        n = len(self.nodes)
        new = (1.0, 1.0)
        total, children = [0.0] * n, [0] * n
        for element in {b.element for b in self.blocks if b.element >= 0}:
            total[element] += known.get(self.nodes[element], new)[1]
            children[element] += 1
        branch = [0.0] * n
        for i in range(n - 1, -1, -1):  # children come after their parents
            if children[i]:  # branches without a text do not count
                share = GAMMA ** children[i] if self.arranged[i] else 1.0  # a leaf is its text
                branch[i] = (1 - share) * known.get(self.nodes[i], new)[0] + share * total[i] / children[i]
                if self.parents[i] >= 0:
                    total[self.parents[i]] += branch[i]
                    children[self.parents[i]] += 1
        along, depth = [0.0] * n, [0] * n
        for i, up in enumerate(self.parents):
            along[i], depth[i] = (along[up], depth[up]) if up >= 0 else (0.0, 0)
            if not self.root[i]:
                along[i], depth[i] = along[i] + branch[i], depth[i] + 1
        first = any(b.article and not b.named and not b.second for b in self.blocks)
        marked = first or any(b.second for b in self.blocks)
        kept = []
        for b in self.blocks:
            weight = 1.0
            if names:
                inside = b.article and not b.named and not (b.second and first)
                weight = CLUTTER if b.named or (marked and not inside) else ARTICLE if inside and (b.element < 0 or self.plain[b.element]) else 1.0
            worth = 1.0
            if b.element >= 0:
                up = self.parents[b.element]
                above, steps = (along[up], depth[up]) if up >= 0 else (0.0, 0)
                worth = (above + known.get(self.nodes[b.element], new)[1]) / (steps + 1)
            if worth * weight >= LEAST:
                kept.append(b.text)
        return "\n\n".join(kept)


def chained(text: str, before: int) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed=before)


def signed(value: int) -> int:
    return value - 2**63


def parsed(html: str) -> Page:
    page = Page()
    page.read(html)
    return page


LOOK = StructType([StructField("node", LongType()), StructField("text", BooleanType()), StructField("look", LongType()), StructField("n", LongType())])
STYLES = StructType([StructField("copy", LongType()), StructField("looks", ArrayType(LOOK))])


@arrow_udf(STYLES)
def styles_of(html: pa.Array) -> pa.Array:
    """Per page the hash it shares with its copies, and what stands at its style nodes."""
    out = []
    for body in html.to_pylist():
        page = parsed(body)
        out.append({"copy": signed(page.copy_key()), "looks": [{"node": signed(node), "text": text, "look": signed(look), "n": n}
                                                               for (node, text, look), n in page.looks().items()]})
    look = pa.struct([("node", pa.int64()), ("text", pa.bool_()), ("look", pa.int64()), ("n", pa.int64())])
    return pa.array(out, pa.struct([("copy", pa.int64()), ("looks", pa.list_(look))]))


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def page_looks(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, page, copy, looks)`` per page."""
    body = F.coalesce(F.col(html), F.lit(""))
    parts = pages.select(host_of(F.col(url)).alias("host"), F.xxhash64(body).alias("page"), styles_of(body).alias("s"))
    return parts.select("host", "page", "s.copy", "s.looks")


def _counts(places: DataFrame, keys: list[str]) -> DataFrame:
    """``places(keys, text, look, n)``, one row per place that shows a look: the number of places, and how often in all."""
    return places.groupBy(*keys, "text", "look").agg(
        F.count("*").alias("places"), F.sum("n").alias("total"), F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("nlogn"))


def _entropies(counts: DataFrame, keys: list[str], of: DataFrame | None = None) -> DataFrame:
    """``(keys, pages, presentation, content)`` of counted looks; ``content`` is null without texts. ``of`` has the number
    of places of every node; without it a place shows one arrangement, so that they are the places."""
    def log(name: str) -> Column:
        return F.log(F.col(name).cast("double"))

    shape, text = ~F.col("text"), F.col("text")
    sums = counts.groupBy(*keys).agg(
        F.sum(F.when(shape, F.col("places"))).alias("shown"), F.sum(F.when(shape, F.col("places") * log("places"))).alias("same"),
        F.sum(F.when(text, F.col("total"))).alias("texts"), F.sum(F.when(text, F.col("total") * log("total") - F.col("nlogn"))).alias("spread"))
    sums = sums.withColumn("pages", F.col("shown")) if of is None else sums.join(of, keys)
    arranged = F.least(F.lit(1.0), (log("shown") - F.col("same") / F.col("shown")) / log("pages"))
    written = F.when(F.col("texts") > 0, F.greatest(F.lit(0.0), 1 - F.col("spread") / F.col("texts") / log("pages")))
    several = F.col("pages") > 1
    return sums.select(*keys, "pages", F.when(several, arranged).otherwise(1.0).alias("presentation"),
                       F.when(several, written).otherwise(F.when(F.col("texts") > 0, 1.0)).alias("content"))


def _of_hosts(looks: DataFrame) -> DataFrame:
    """One page of each group of copies on a host: ``(host, copy, looks)``."""
    return looks.groupBy("host", "copy").agg(F.min_by("looks", "page").alias("looks"))


def _places(pages: DataFrame) -> DataFrame:
    return pages.select("host", F.explode("looks").alias("l")).select("host", "l.*")


def importance(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, node, pages, presentation, content)`` per style node of a host: its entropies as they are."""
    return _entropies(_counts(_places(_of_hosts(page_looks(pages, url, html))), ["host", "node"]), ["host", "node"])


def weighed(looks: DataFrame) -> DataFrame:
    """``(host, node, presentation, content)``: importances by host, all hosts and ``PRIOR``, without nodes that have 1 in both."""
    hosts = _of_hosts(looks)
    own = _entropies(_counts(_places(hosts), ["host", "node"]), ["host", "node"])
    # a text that several hosts carry counts for the first of them
    once = hosts.groupBy("copy").agg(F.min_by(F.struct("host", "looks"), "host").alias("s")).select("s.*")
    places = _places(once).groupBy("host", "node", "text", "look").agg(F.sum("n").alias("n"))
    among = places.filter(~F.col("text")).groupBy("node").agg(F.count_distinct("host").alias("pages"))
    every = _entropies(_counts(places, ["node"]), ["node"], among).select(
        "node", F.col("pages").alias("hosts"), F.col("presentation").alias("p_all"), F.col("content").alias("c_all"))
    joined = own.join(every, "node", "left")
    mine, others = F.col("pages") - 1, F.coalesce(F.col("hosts") - 1, F.lit(0))

    def mean(own_name: str, all_name: str) -> Column:
        values = PRIOR + mine * F.coalesce(own_name, F.lit(1.0)) + others * F.coalesce(all_name, own_name, F.lit(1.0))
        return F.round(values / (PRIOR + mine + others), 6)

    return joined.select("host", "node", mean("presentation", "p_all").alias("presentation"), mean("content", "c_all").alias("content")) \
        .filter("presentation < 1 or content < 1")


KNOWN = "array<struct<node: bigint, presentation: double, content: double>>"


def _texts(names: bool):
    @arrow_udf(StringType())
    def main_text(html: pa.Array, known: pa.Array) -> pa.Array:
        out = []
        for body, nodes in zip(html.to_pylist(), known.to_pylist(), strict=True):
            given = {x["node"] + 2**63: (x["presentation"], x["content"]) for x in nodes}
            out.append(parsed(body).main_text(given, names))
        return pa.array(out, pa.string())
    return main_text


def extract(pages: DataFrame, url: str = "url", html: str = "html", text: str = "main_text", names: bool = True) -> DataFrame:
    """``pages`` with the main text; ``names=False`` ignores what elements say about themselves."""
    base = without(pages, [text]) if text not in (url, html) else pages
    host, page, known = (free_name(base, n) for n in ("style_host", "style_page", "style_known"))
    looks = stored(page_looks(pages, url, html), "style-looks")
    nodes = stored(weighed(looks), "style-nodes")
    entry = F.struct("node", "presentation", "content")
    sizes = nodes.groupBy("host").count().agg(F.sum("count"), F.max("count")).first()
    body = F.coalesce(F.col(html), F.lit(""))
    keyed = base.withColumns({host: host_of(F.col(url)), page: F.xxhash64(body)})
    if (sizes[0] or 0) <= BROADCAST_NODES and (sizes[1] or 0) <= HOST_NODES:
        found = nodes.groupBy(F.col("host").alias(host)).agg(F.collect_list(entry).alias(known))
        joined = keyed.join(F.broadcast(found), host, "left")
    else:
        own = looks.dropDuplicates(["host", "page"]).select("host", "page", F.explode(F.array_distinct(F.transform("looks", lambda x: x["node"]))).alias("node"))
        found = own.join(nodes, ["host", "node"]).groupBy(F.col("host").alias(host), F.col("page").alias(page)).agg(F.collect_list(entry).alias(known))
        joined = keyed.join(found, [host, page], "left")
    none = F.array().cast(KNOWN)
    return joined.withColumn(text, _texts(names)(body, F.coalesce(F.col(known), none))).drop(host, page, known)
