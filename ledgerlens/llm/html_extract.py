"""Operator 3: main text of web pages by consensus host paths.

1. Each page is cut into blocks of text with the containers around them.
   What is never shown goes at once (by tag, role or style).  Forms, and
   containers named for menus, sidebars, notices, adverts or comments, go
   unless they turn out to hold most of the page's text (a wrapper) or all of
   it; comments go in any case but the last.  A class or id token names such a
   part if each of its words does or tells only its place (``top-menu``, but
   not ``no-sidebar``, ``content-sidebar-wrap`` or ``market-share``).
2. A page scores its containers by their text outside links; the deepest
   container that still holds most of it (a first heading weighs as half the
   text) is chosen, and from there the choice climbs as long as the rest of
   the parent is text of the same article: anything inside an article or main
   element, elsewhere sections and other flow beside it, mostly outside links.
   The choice is named by its generalised path: the tags and classes from the
   root, without numbers.
3. Spark sums the choices per host and path, and ranks each host's paths.
   Only (host, path, votes, score) is shuffled, summed in each task first.
4. Every page is extracted again with its host's winning path; where it has
   none with text, with the host's next path, and else with its own choice.

A block's white space becomes one space, character references are decoded,
and blocks are joined in page order by a line break.  Null and empty html
give an empty text; a null url is the empty host.  Rows are independent, so
repeated rows repeat their results.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import add_column, emit, free_name, rows_of, stage

MOST = 0.8          # share of the text that the chosen container holds
RANKED = 64         # paths kept for a host; pages without any use their own choice
BROADCAST_ROWS = 20_000

_RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<({_RAW})\b(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+>(?:(?!</\1\b).)*+(?:</\1[^>]*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s]*)))?")
_WORD = re.compile(r"[a-z]+")

INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span
    strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
HIDDEN_TAGS = frozenset("""head noscript template svg math canvas object audio video select datalist button nav footer aside menu
    dialog fieldset""".split())
HIDDEN_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# words of classes and ids that name parts beside the article
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
HIDDEN_WORDS = COMMENT_WORDS | frozenset("""ad ads advert adverts advertisement advertisements advertising adsense banner banners sponsor sponsored
    sponsors promo promos promotion sidebar menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent
    gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login
    related recommended recommendations share sharing social widget widgets toolbar pagination pager skip""".split())
# words that tell only where or in what form such a part stands
PLACE_WORDS = frozenset("""top bottom left right main site page post primary secondary global mobile desktop bar box area block container wrapper
    wrap inner outer list section item items slot unit text link links button buttons icon icons form posts articles stories to the""".split())
KEPT_TAGS = frozenset("html body main".split())
FLOW = frozenset("section p ul ol dl blockquote figure table pre details hgroup address".split())
SHOWN, SOFT, REMARK, GONE = range(4)  # what becomes of an element


def _beside(token: str) -> int:
    """Whether a class or id token names a part beside the article."""
    words = _WORD.findall(token)
    if HIDDEN_WORDS.isdisjoint(words) or not PLACE_WORDS.union(HIDDEN_WORDS).issuperset(words):
        return SHOWN
    return REMARK if not COMMENT_WORDS.isdisjoint(words) else SOFT


def _fate(tag: str, attributes: str, inside: bool) -> int:
    """What becomes of an element; ``inside``: below an article or main
    element."""
    if tag in HIDDEN_TAGS or (tag == "header" and not inside):
        return GONE
    fate = SOFT if tag == "form" else SHOWN
    if not attributes or tag in KEPT_TAGS:
        return fate
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in HIDDEN_ROLES):
            return GONE
        if name == "style" and "display:none" in value.replace(" ", ""):
            return GONE
        if name in ("class", "id"):
            for token in value.split():
                fate = max(fate, _beside(token), SOFT if "header" in _WORD.findall(token) and not inside and _WORD.findall(token)[-1] == "header" else SHOWN)
    return fate


def _step(tag: str, attributes: str) -> str:
    """One step of a generalised path: tag and classes without numbers."""
    for name, *values in _ATTRIBUTE.findall(attributes or ""):
        if name.lower() == "class":
            words = sorted({w for w in (re.sub(r"[\d_-]*\d[\w-]*$", "", c) for c in "".join(values).lower().split()) if w})
            return ".".join([tag, *words])
    return tag


class Page:
    """Blocks (text, letters in links, first heading, container) and
    containers (parent, path) of one page."""

    def __init__(self, source: str | None):
        self.parent, self.path, self.tag, self.inside = [-1], [""], [""], [False]
        self.blocks: list[tuple[str, int, bool, int]] = []
        around: list[tuple[int, ...]] = []  # of each block: the parts beside the article that it stands in
        parts_beside: list[int] = []        # their fates
        # tag, container, gone, inside an article, parts beside it
        stack: list[tuple[str, int, bool, bool, tuple[int, ...]]] = [("", 0, False, False, ())]
        parts: list[str] = []
        linked, link, at, source = 0, 0, 0, source or ""

        def close_block():
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    tag, node, _, _, beside = stack[-1]
                    self.blocks.append((text, linked, tag == "h1", node))
                    around.append(beside)
                parts.clear()
            linked = 0

        def add(raw: str):
            nonlocal linked
            if raw and not stack[-1][2]:
                text = entities.unescape(raw) if "&" in raw else raw
                parts.append(text)
                if link:
                    linked += len(text)

        for found in _TAG.finditer(source):
            add(source[at:found.start()])
            at = found.end()
            raw_tag, closing, tag, attributes = found.groups()
            if raw_tag or not tag:  # raw text, comments, declarations
                continue
            tag = tag.lower()
            if tag == "a":
                link = 0 if closing else 1
            if tag in INLINE:
                if closing:
                    if stack[-1][0] == tag:
                        stack.pop()
                elif tag not in VOID and (stack[-1][2] or _fate(tag, attributes, stack[-1][3])):
                    stack.append((tag, stack[-1][1], True, *stack[-1][3:]))
                continue
            close_block()
            if closing:
                if any(s[0] == tag for s in stack):
                    while stack.pop()[0] != tag:
                        pass
                    stack = stack or [("", 0, False, False, ())]
                continue
            if tag in VOID:
                continue
            while stack[-1][0] in INLINE or stack[-1][0] == "p" or stack[-1][0] in CLOSES.get(tag, ()):
                stack.pop()
            if tag == "body":
                while stack[-1][0] not in ("", "html"):
                    stack.pop()
            _, node, gone, inside, beside = stack[-1]
            inside = inside or tag in ("article", "main")
            fate = _fate(tag, attributes, inside)
            gone = gone or fate == GONE
            if not gone and fate:
                beside = (*beside, len(parts_beside))
                parts_beside.append(fate)
            if not gone and tag != "p" and not re.fullmatch("h[1-6]", tag):
                self.parent.append(node)
                self.path.append(f"{self.path[node]}>{_step(tag, attributes)}")
                self.tag.append(tag)
                self.inside.append(inside)
                node = len(self.parent) - 1
            stack.append((tag, node, gone, inside, beside))
        add(source[at:])
        close_block()
        self._leave_out(around, parts_beside)

    def _leave_out(self, around, fates) -> None:
        """Drop the blocks in parts beside the article."""
        if not fates:
            return
        worth = [max(1, len(text) - 2 * linked) for text, linked, _, _ in self.blocks]
        held = [0] * len(fates)
        for beside, w in zip(around, worth):
            for k in beside:
                held[k] += w
        remarks = sum(w for beside, w in zip(around, worth) if any(fates[k] == REMARK for k in beside))
        wrapper = [fate == SOFT and 2 * h > sum(worth) - remarks for fate, h in zip(fates, held)]
        for stays in (lambda k: wrapper[k], lambda k: fates[k] == SOFT, lambda k: True):  # a page with text has some
            kept = [b for b, beside in zip(self.blocks, around) if all(map(stays, beside))]
            if kept:
                break
        self.blocks = kept

    def above(self, node: int):
        while node >= 0:
            yield node
            node = self.parent[node]

    def choice(self) -> tuple[int, float]:
        """The chosen container and its score; the root if there is no text."""
        worth = [max(0, len(text) - 2 * linked) for text, linked, _, _ in self.blocks]
        body = sum(worth)
        score = [0.0] * len(self.parent)
        headed = False
        for (_, _, heading, node), w in zip(self.blocks, worth):
            if heading and not headed:
                w, headed = max(w, body / 2), True
            for k in self.above(node):
                score[k] += w
        best = 0
        for k in range(1, len(score)):  # containers come after their parents
            if self.parent[k] == best and score[k] and score[k] >= MOST * score[0]:
                best = k
        best = self._climbed(best, worth)
        return best, score[best]

    def _climbed(self, best: int, worth: list[int]) -> int:
        """The highest container around ``best`` whose rest is of one article
        with it."""
        while self.parent[best] > 0 and self.tag[self.parent[best]] not in ("html", "body") and self.tag[best] not in ("article", "main"):
            up, rest, outside, flows = self.parent[best], 0, 0, True
            for (text, _, _, node), w in zip(self.blocks, worth):
                chain = list(self.above(node))
                if up in chain and best not in chain:
                    below = chain[chain.index(up) - 1] if chain[0] != up else up
                    flows = flows and (below == up or self.tag[below] in FLOW)
                    rest, outside = rest + len(text), outside + w
            if rest and not (2 * outside >= rest and (flows or self.inside[up])):
                break
            best = up
        return best

    def text(self, paths: list[str] | None) -> str:
        """The text of the first of ``paths`` that has any, or else of the
        page's own choice."""
        chains = None
        for path in paths or ():
            ids = {k for k, p in enumerate(self.path) if p == path}
            if ids:
                chains = chains or [set(self.above(b[3])) for b in self.blocks]
                found = [b[0] for b, chain in zip(self.blocks, chains) if not ids.isdisjoint(chain)]
                if found:
                    return "\n".join(found)
        best = self.choice()[0]
        return "\n".join(b[0] for b in self.blocks if best in self.above(b[3]))


# ------------------------------------------------------------------ Spark

def host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#\\]*)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """host, path, pages, score: each task's pages summed first."""
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("pages", pa.int64()), ("score", pa.float64())])

    def vote(batches):
        held: dict[tuple[str, str], list] = {}
        for at, source in rows_of(batches, "host", "html"):
            page = Page(source)
            best, score = page.choice()
            if score:
                entry = held.setdefault((at, page.path[best]), [0, 0.0])
                entry[0] += 1
                entry[1] += score
                if len(held) >= 50_000:
                    yield from emit(schema, ((h, p, n, s) for (h, p), (n, s) in held.items()))
                    held = {}
        yield from emit(schema, ((h, p, n, s) for (h, p), (n, s) in held.items()))

    return pages.select(host().alias("host"), "html").mapInArrow(vote, "host string, path string, pages long, score double") \
        .groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("score").alias("score"))


def winners(pages: DataFrame) -> DataFrame:
    """host, paths: the host's best paths, most pages first (ties: the higher
    score, then the path's name)."""
    from pyspark.sql.window import Window

    order = Window.partitionBy("host").orderBy(F.desc("pages"), F.desc("score"), "path")
    ranked = votes(pages).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= RANKED)
    listed = ranked.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("rank", "path"))).alias("p"))
    return listed.select("host", F.col("p.path").alias("paths"))


def extract(pages: DataFrame, out: str = "main_text", keep: list[str] | None = None) -> DataFrame:
    """``pages`` (url, html) with a string column ``out``."""
    best = stage(winners(pages), "host_paths")
    at, paths = free_name(pages, "page_host"), free_name(pages, "host_paths")
    best = best.select(F.col("host").alias(at), F.col("paths").alias(paths))
    if best.count() <= BROADCAST_ROWS:  # else a shuffle join; the result is the same
        best = F.broadcast(best)
    keep = pages.columns if keep is None else keep
    joined = pages.withColumn(at, host()).join(best, at, "left")
    return add_column(joined, lambda: lambda sources, paths: [Page(s).text(p) for s, p in zip(sources, paths)],
                      ["html", paths], out, "string", pa.string(), keep)


def extracted(pages: DataFrame) -> DataFrame:
    """The query's columns."""
    got = extract(pages.select("page_id", "url", "html"), keep=["page_id", "url"])
    return got.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
