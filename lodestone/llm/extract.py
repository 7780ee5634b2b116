"""Main text of HTML pages by consensus host paths.

A page is read into a tree of containers.  Each has a path: the chain of tag.class names from the body, generalised (digits
and long hashes in classes don't count) and hashed, so a path has one size at any depth.  Every page scores its containers
and votes, in two ways:

* for one path as its article's: from the body down, always into the child that holds most of the text, with a lower bar for
  `article` and `main`, until a container has prose of its own or no child has most; the vote weighs as much as the text;
* for or against every suspect, a container whose class or id has a word that often names boilerplate: the word itself
  speaks against it, links too; a heading, whole sentences or most of the page's text speak for it, and one that holds all of
  the page's sentences is never against.

Spark sums the votes by host and path, which settles each host's winning paths and its struck ones.  Then each page is
extracted again: the blocks inside the first winning path that occurs in it, without what the host strikes.  A path
without votes of its host goes by the page's own.  Menus, asides, footers, forms, dialogs and hidden parts never count,
whatever the votes.  The page's first heading of the first level belongs to the article wherever it stands before it.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed, empty ones go, and
the rest are joined by one line feed in page order.

A null html is an empty one; a page without text has an empty text.  A null or odd url counts as the host ''.  Rows, also
equal ones, are extracted each on their own; equally good paths go by their hash.  Work is linear in a page's length, and a
page is never cut.  Columns other than page_id, url and html are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm._common import released, small_batches, stored

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
#: Names of elements by how they are treated.
RAW = frozenset(("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "select", "xmp", "noframes", "canvas", "audio", "video"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"))
NEVER = frozenset(("nav", "aside", "footer", "form", "button", "dialog", "menu", "head", "input", "option", "fieldset"))
CONTAINERS = frozenset(("div", "article", "section", "main", "td", "table", "tbody", "center", "ul", "ol", "dl", "blockquote", "header", "figure"))
CLOSES_P = frozenset(("address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"))
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset(("ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "aside", "nav"))
#: Words of classes and ids.  Strong ones name boilerplate wherever they stand, weak ones mostly where no other word does.
STRONG = frozenset(
    (
        "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "navbar", "navigation", "breadcrumb", "breadcrumbs", "sidebar", "masthead", "topbar", "cookie", "cookies", "consent",
        "gdpr", "popup", "newsletter", "subscribe", "subscription", "signup", "login", "comment", "comments", "disqus", "respond", "responses", "replies", "feedback", "discussion", "pagination", "pager",
    )
)
WEAK = frozenset(("ad", "ads", "banner", "nav", "menu", "aside", "widget", "footer", "header", "notice", "alert", "modal", "overlay", "search", "share", "sharing", "social", "related", "recommended", "reply", "toc", "skip", "toolbar", "form", "copyright", "legal", "disclaimer", "hidden"))
NEUTRAL = frozenset(("site", "page", "top", "bottom", "left", "right", "box", "block", "container", "wrap", "wrapper", "list", "item", "items", "section", "area", "inner", "outer", "bar", "links", "link", "global", "row", "col", "the", "my", "js", "c", "l"))
NEVER_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "alert", "dialog", "note"))
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
HASHED = re.compile(r"[0-9a-f]{6,}|[0-9]+")
#: Share of a container's text that its child must hold to be gone into: any one, and an article or main.
MOST, ENOUGH = 0.6, 0.3
#: A host's winning paths, and the suspects whose votes are kept; for others each page's own vote counts.
WINNERS, SUSPECTS, BROADCAST_HOSTS, SALTS = 3, 256, 100_000, 64


def _named(attributes: str) -> tuple[str, float, bool]:
    """The generalised class, what its words and the id's say (0, or less for a suspect), and whether it never counts."""
    name, doubt, never = "", 0.0, False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id"):
            words = WORDS.findall(CAMEL.sub(" ", value).lower())
            if not STRONG.isdisjoint(words):
                doubt = -2.0
            elif not WEAK.isdisjoint(words):
                doubt = min(doubt, -2.0 if all(w in WEAK or w in NEUTRAL for w in words) else -1.0)
            if key == "class" and not name:
                name = "." + "-".join(WORDS.findall(HASHED.sub("", value.lower()))[:4])
        elif key == "role" and value.lower() in NEVER_ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and "display:none" in value.replace(" ", "").lower():
            never = True
    return name, doubt, never


class Page:
    """A page's tree of containers, and its blocks: pieces of text, each with the number of its container."""

    def __init__(self, html: str):
        import xxhash

        self.digest = lambda parent, name: xxhash.xxh3_64_intdigest(f"{parent} {name}") - (1 << 63)
        # By container: the one around it, path, tag, doubt, whether it never counts, and what it holds itself.
        self.parent, self.path, self.tag, self.doubt, self.never = [-1], [0], ["body"], [0.0], [False]
        self.chars, self.links, self.prose, self.heads = [0], [0], [0], [0]
        self.blocks: list[tuple[str, list[tuple[str, int]]]] = []
        stack: list[tuple[str, int]] = [("body", 0)]  # open elements and their containers
        open_: Counter[str] = Counter()
        block: list[tuple[str, int]] = []
        kind = "p"

        def flush():
            nonlocal block, kind
            if block:
                if any(not x.isspace() for x, _ in block):
                    self.blocks.append((kind, block))
                block = []
            kind = "p"

        def close(k: int):
            for tag, _ in stack[k:]:
                open_[tag] -= 1
            del stack[k:]

        def find(tags: tuple[str, ...], past) -> int:
            """The innermost open element with one of the tags, looking past those that may be passed; 0 if there is none."""
            if any(open_[t] for t in tags):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in tags:
                        return k
                    if not past(stack[k][0]):
                        return 0
            return 0

        size, last, at = len(html), html.rfind(">"), 0
        while at < size:
            sign = html.find("<", at)
            if sign < 0 or sign > last:  # no further tag can end
                block.append((html[at:], stack[-1][1]))
                break
            if sign > at:
                block.append((html[at:sign], stack[-1][1]))
                if open_["a"]:
                    self.links[stack[-1][1]] += sign - at
            m = TOKEN.match(html, sign)
            if m is None:  # a sign that begins no tag is text
                block.append(("<", stack[-1][1]))
                at = sign + 1
                continue
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag in RAW or tag in VOID:
                    continue
                k = find((tag,), (lambda t: t not in SCOPES) if tag in INLINE else (lambda t: True))
                if tag not in INLINE and (k or tag == "p"):
                    flush()
                if k:
                    close(k)
                continue
            if tag in RAW:
                if m[3].endswith("/") and tag == "svg":
                    continue
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else size
                continue
            if tag in ("br", "wbr", "img"):
                if tag == "br":
                    block.append((" ", stack[-1][1]))
                continue
            if tag not in INLINE:
                flush()
                if tag in VOID:
                    continue
                if tag in CLOSES_P and (k := find(("p",), lambda t: t in INLINE)):
                    close(k)
                if tag in SELF_CLOSING and (k := find(SELF_CLOSING[tag], lambda t: t not in SCOPES)):
                    close(k)
                if tag in ("html", "body"):
                    continue
                kind = tag
            name, doubt, never = _named(m[3]) if m[3] else ("", 0.0, False)
            never = never or tag in NEVER or tag == "header" and not open_["article"] and not open_["main"]
            inside = stack[-1][1]
            number = inside
            if tag in CONTAINERS or doubt or never:
                number = len(self.path)
                self.parent.append(inside)
                self.path.append(self.digest(self.path[inside], tag + name))
                self.tag.append(tag)
                self.doubt.append(doubt if tag not in ("article", "main") else 0.0)
                self.never.append(never or self.never[inside])
                for own in (self.chars, self.links, self.prose, self.heads):
                    own.append(0)
            stack.append((tag, number))
            open_[tag] += 1
        flush()
        for kind, pieces in self.blocks:
            for text, k in pieces:
                self.chars[k] += len(text)
            self.prose[pieces[0][1]] += sum(len(t) for t, _ in pieces) >= 60
            self.heads[pieces[0][1]] += kind == "h1"

    def _sums(self, own: list[int], gone: list[bool]) -> list[int]:
        """For each container what it and its children hold, without those that are gone."""
        total = list(own)
        for k in range(len(total) - 1, 0, -1):
            if gone[k]:
                total[k] = 0
            else:
                total[self.parent[k]] += total[k]
        return total

    def suspects(self) -> dict[int, float]:
        """container -> its score: less than 0 speaks for boilerplate."""
        chars, links, prose, heads = (self._sums(x, self.never) for x in (self.chars, self.links, self.prose, self.heads))
        found = {}
        for k, doubt in enumerate(self.doubt):
            if doubt and not self.never[k]:
                few_links = links[k] <= 0.3 * chars[k]
                score = doubt + 3 * (heads[k] > 0) + 2 * (prose[k] > 1 and chars[k] >= 0.5 * chars[0]) + 1.5 * (prose[k] > 0 and few_links) - (not few_links)
                found[k] = max(score, 0.5) if few_links and 0 < prose[k] == prose[0] else score
        return found

    def struck(self, suspects: dict[int, float], verdicts: dict[int, bool] | None = None) -> list[bool]:
        """For each container whether it is left out: by the host's verdict on its path, else by the page's own score."""
        gone = list(self.never)
        for k in range(1, len(gone)):
            own = verdicts.get(self.path[k], suspects[k] < 0) if verdicts and k in suspects else suspects.get(k, 0) < 0
            gone[k] = gone[k] or own or gone[self.parent[k]]
        return gone

    def article(self, gone: list[bool]) -> int:
        """The container that holds the article, as this page sees it."""
        worth = self._sums([max(0, c - 2 * n) for c, n in zip(self.chars, self.links, strict=True)], gone)
        children: dict[int, list[int]] = {}
        for k in range(1, len(worth)):
            if worth[k]:
                children.setdefault(self.parent[k], []).append(k)
        at = 0
        while at in children and self.tag[at] not in ("article", "main") and not self.prose[at]:
            best = max(children[at], key=lambda k: (worth[k] * (2 if self.tag[k] in ("article", "main") else 1), -k))
            if worth[best] < (ENOUGH if self.tag[best] in ("article", "main") else MOST) * worth[at]:
                break
            at = best
        return at

    def votes(self) -> list[tuple[int, int, int]]:
        """(path, weight as the article's, votes against it)."""
        suspects = self.suspects()
        gone = self.struck(suspects)
        best = self.article(gone)
        weight = self._sums(self.chars, gone)[best]
        rows = {self.path[best]: [weight, 0]} if weight else {}
        for k, score in suspects.items():
            rows.setdefault(self.path[k], [0, 0])[1] += 1 if score < 0 else -1
        return [(path, a, b) for path, (a, b) in rows.items()]

    def text(self, winners: list[int] = (), verdicts: dict[int, bool] | None = None) -> str:
        """The blocks under the first winning path that occurs here and holds text; else under the page's own choice."""
        gone = self.struck(self.suspects(), verdicts)
        held = self._sums(self.chars, gone)
        wanted: set[int] = set()
        for path in winners:
            wanted = {k for k, p in enumerate(self.path) if p == path and held[k]}
            if wanted:
                break
        wanted = wanted or {self.article(gone)}
        inside = [False] * len(self.path)
        for k in range(len(inside)):
            inside[k] = not gone[k] and (k in wanted or k > 0 and inside[self.parent[k]])
        found: list[str] = []
        heading, has_head = "", False
        for kind, pieces in self.blocks:
            first = kind == "h1" and not found and not heading
            text = "".join(t for t, k in pieces if inside[k] or first and not gone[k])
            if text and (text := " ".join((entities.unescape(text) if "&" in text else text).split())):
                if first and not any(inside[k] for _, k in pieces):
                    heading = text
                else:
                    found.append(text)
                    has_head |= kind == "h1"
        return "\n".join([heading, *found] if heading and found and not has_head else found)


def host(url: F.Column) -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: dict[tuple[str, int], list[int]] = {}
        for h, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for path, won, against in Page(html).votes() if html else ():
                row = rows.setdefault((h, path), [0, 0, 0])
                row[0] += won
                row[1] += against
                row[2] += 1
        keys = list(rows)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), *(pa.array([rows[k][i] for k in keys], pa.int64()) for i in range(3))]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "path", "won", "against", "pages"])
    released()


def host_paths(pages: DataFrame, winners: int = WINNERS, suspects: int = SUSPECTS) -> DataFrame:
    """host, html -> one row per host: its winning paths, best first, and its verdicts on suspects (path, struck)."""
    small_batches(pages.sparkSession, 256)
    votes = pages.select("host", "html").mapInArrow(_votes, "host string, path long, won long, against long, pages long")
    summed = votes.groupBy("host", "path").agg(F.sum("won").alias("won"), F.sum("against").alias("against"), F.sum("pages").alias("pages"))
    best, often = Window.partitionBy("host").orderBy(F.col("won").desc(), "path"), Window.partitionBy("host").orderBy((F.col("against") != 0).desc(), F.col("pages").desc(), "path")
    ranked = summed.withColumns({"k": F.row_number().over(best), "s": F.row_number().over(often)}).filter(f"(k <= {winners} and won > 0) or (s <= {suspects} and against <> 0)")
    won = F.array_sort(F.collect_list(F.when((F.col("k") <= winners) & (F.col("won") > 0), F.struct("k", "path"))))
    struck = F.collect_list(F.when((F.col("s") <= suspects) & (F.col("against") != 0), F.struct("path", (F.col("against") > 0).alias("struck"))))
    return ranked.groupBy("host").agg(F.transform(won, lambda x: x["path"]).alias("paths"), F.array_sort(struck).alias("verdicts"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, htmls, paths, verdicts = (c.to_pylist() for c in batch.columns)
        texts = [Page(h).text(p or [], {v["path"]: v["struck"] for v in vs or ()}) if h else "" for h, p, vs in zip(htmls, paths, verdicts, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    released()


EXTRACTED = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, html -> page_id, url, text, n_chars: one row per page."""
    hosted = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host(F.col("url").cast("string")).alias("host"))
    settled = stored(host_paths(hosted), "hosts")
    if settled.count() <= BROADCAST_HOSTS and (settled.agg(F.sum(F.size("verdicts") * 16 + 64)).first()[0] or 0) <= 32e6:
        joined = hosted.join(F.broadcast(settled), "host", "left")
    else:  # a host's pages are spread
        salted = hosted.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = salted.join(settled.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["host", "salt"], "left")
    return joined.select("page_id", "url", "html", "paths", "verdicts").mapInArrow(_texts, EXTRACTED)
