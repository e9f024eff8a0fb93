"""Main text of web pages by consensus host paths.

First every page scores its containers: blocks give the length of their text without twice that of their links to the
container around them and half of it to the next one out, or to the article element or main landmark that they
stand in. Containers are named by generalised paths: tags with classes and ids, digits replaced, positions left out; a
path is kept as a hash of its parent's hash and its own name. A page's votes are its containers' shares; Spark sums votes by
host and path, and paths with at least ``KEEP`` of a host's best path and ``LEAST`` of its votes win. Then every page is
read again with its host's winning paths: all elements with any of them are extracted, or those of the page's own
winning paths if it has none. The document, html and body hold everything, so that as winners they give only what stands
in them directly, unless one of them is the best that the page has. Where the best is an article element or main landmark,
only winners of that kind are extracted. Equal votes are in order of the path's hash.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, hidden elements and reader comments are
left out everywhere. Elements and roles name them, and so do words of class and id: those in ``MARKS`` on any container,
those in ``HINTS``, which articles use as well, on a container only if at least ``LINKED`` of its text is links or it has
less than ``PART`` of the page's text. Headings are never left out for a class of their own, and paragraphs, quotations and
cells not for a hint. A header element within an article or main landmark is the article's own. Character references are decoded, white space
inside a block becomes one space, blocks are joined in page order by a line feed; nothing else is dropped or capped.

Null html: as empty, text ''. Pages without a host follow their own votes. Very long and deep pages take time in proportion
to their length. Repeated rows stay repeated; an empty table gives an empty table. Columns pass through unless they are
named ``text`` or ``n_chars``.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.llm.common import portions, shared_dir, stored

KEEP, LEAST = 0.3, 0.005
LINKED, PART = 0.4, 0.3
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
DROPPED = frozenset("head nav header footer aside form button select option datalist fieldset menu dialog template svg math object canvas audio video applet map".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
TEXTS = HEADINGS | frozenset("p blockquote pre li td th dt dd figcaption".split())
#: Words of a class or id that mark what isn't the article, and words that articles use as well.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs masthead banner footer "
    "sidebar comments commentlist respond disqus cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login pagination pager toolbar".split()
)
HINTS = frozenset("header side rail widget widgets related recommended share sharing social comment discussion reply replies notice notices alert promo promotion subscription form search hidden skip".split())
MAIN = frozenset("article main".split())
CLOSES = {  # a start tag of the first kind ends an open element of the second kind
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "thead", "tbody"),
}
NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
REST = re.compile(r"[^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+>")
ATTR = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
ENDS = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(text)} if text and not text.isspace() else {}


def left_out(tag: str, a: dict[str, str], main: bool) -> tuple[bool, bool]:
    """Whether an element is left out, and whether it only may be; ``main``: within an article or main landmark."""
    if tag in DROPPED and not (tag == "header" and main):
        return True, False
    if not a or tag in ("html", "body"):
        return False, False
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True, False
    if tag in MAIN or tag in HEADINGS:
        return False, False
    words = {w.lower() for k in ("class", "id") for w in WORDS.findall(a.get(k, ""))}
    return not MARKS.isdisjoint(words), tag not in TEXTS and tag not in INLINE and not HINTS.isdisjoint(words)


def tokens(source: str):
    """(text, None, None, end) and (whether an end tag, name, rest of the tag, end), in order, by forward searches only.
    Where no quotation mark closes, quotation marks aren't regarded from there on."""
    at, end, text, quoted, sections = 0, len(source), 0, True, True
    while (i := source.find("<", at)) >= 0:
        two = source[i + 1 : i + 2]
        if two == "!" or two == "?":
            if source.startswith("<!--", i):
                e = source.find("-->", i + 4)
                stop = end if e < 0 else e + 3
            elif sections and source.startswith("<![CDATA[", i) and (e := source.find("]]>", i + 9)) >= 0:
                yield source[text:i] + source[i + 9 : e], None, None, e + 3
                text = at = e + 3
                continue
            else:
                sections = sections and not source.startswith("<![CDATA[", i)
                e = source.find(">", i)
                if e < 0:
                    break
                stop = e + 1
            if i > text:
                yield source[text:i], None, None, stop
            text = at = stop
            continue
        m = NAME.match(source, i + 1)
        if m is None:
            at = i + 1
            continue
        r = REST.match(source, m.end()) if quoted else None
        if r is not None:
            stop = r.end()
        else:
            e = source.find(">", m.end())
            if e < 0:
                break
            stop, quoted = e + 1, False
        if i > text:
            yield source[text:i], None, None, i
        text = at = stop
        skip = yield bool(m[1]), m[2].lower(), source[m.end() : stop - 1], stop
        if skip is not None:  # raw text ends there
            text = at = skip
            yield None
    if text < end:
        yield source[text:], None, None, end


def name(tag: str, a: dict[str, str]) -> str:
    """Tag with classes and id, digits replaced."""
    words = sorted({re.sub(r"\d+", "0", w.lower()) for w in a.get("class", "").split()})
    mark = re.sub(r"\d+", "0", a.get("id", "").strip().lower())
    return tag + "".join(f".{w}" for w in words) + (f"#{mark}" if mark else "")


def below(path: int, own: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(own, path & (2**64 - 1)) - 2**63


class Page:
    """Containers (path, own name, place of the one around, place of the main one around, whether it may be left out) and
    blocks (container, text, length of links)."""

    def __init__(self, source: str):
        self.paths, self.names, self.around, self.main, self.hinted = [0], [""], [-1], [-1], [False]
        self.blocks: list[tuple[int, str, int]] = []
        stack: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, container, left out
        open_: dict[str, list[int]] = defaultdict(list)  # places in the stack by tag
        solid = [0]  # places in the stack of what isn't inline
        text: list[str] = []
        links, linked = 0, 0

        def flush(container: int) -> None:
            nonlocal links
            if text:
                if body := " ".join("".join(text).split()):
                    self.blocks.append((container, body, links))
                text.clear()
            links = 0

        def close(k: int) -> None:
            nonlocal linked
            for i in range(len(stack) - 1, k - 1, -1):
                tag, container, _ = stack.pop()
                open_[tag].pop()
                if tag == "a":
                    linked -= 1
                elif tag not in INLINE:
                    flush(container)
                if solid[-1] == i:
                    solid.pop()

        def push(tag: str, container: int, out: bool) -> None:
            open_[tag].append(len(stack))
            if tag not in INLINE:
                solid.append(len(stack))
            stack.append((tag, container, out))

        read = tokens(source)
        for closing, tag, rest, at in read:
            if tag is None:
                if not stack[-1][2]:
                    raw = entities.unescape(closing) if "&" in closing else closing
                    text.append(raw)
                    if linked:
                        links += len(raw.strip())
                continue
            if closing:
                k = open_[tag][-1] if open_[tag] else 0
                # an inline end tag doesn't reach over the block around it
                if k and not (tag in INLINE and solid[-1] > k):
                    close(k)
                continue
            if tag in VOID:
                if tag == "hr":
                    flush(stack[-1][1])
                elif tag == "br":
                    text.append(" ")
                continue
            a = attributes(rest)
            parent = stack[-1][1]
            if tag in INLINE:
                linked += tag == "a"
                push(tag, parent, stack[-1][2] or bool(a) and left_out(tag, a, False)[0])
                continue
            flush(parent)
            ended = CLOSES.get(tag, ())
            while len(solid) > 1 and (stack[solid[-1]][0] in ended or stack[solid[-1]][0] == "p"):
                close(solid[-1])
            parent = stack[-1][1]
            if tag in ENDS:
                e = ENDS[tag].search(source, at)
                read.send(e.end() if e else len(source))
                continue
            if rest.endswith("/") and tag in ("svg", "path", "math"):
                continue
            out, hinted = left_out(tag, a, self.main[parent] >= 0)
            own, place = name(tag, a), len(self.paths)
            self.paths.append(below(self.paths[parent], own))
            self.names.append(own)
            self.around.append(parent)
            is_main = tag in MAIN or a.get("role", "").lower() == "main" or "articlebody" in a.get("itemprop", "").lower()
            self.main.append(self.main[parent] if self.main[parent] >= 0 else place if is_main else -1)
            self.hinted.append(hinted)
            push(tag, place, stack[-1][2] or out)
        close(1)
        flush(0)
        if any(self.hinted):
            self._weigh()

    def _weigh(self) -> None:
        """Leaves out containers with a hint that are mostly links or a small part of the page."""
        size, links = [0] * len(self.paths), [0] * len(self.paths)
        for c, body, n in self.blocks:
            size[c] += len(body)
            links[c] += n
        for i in range(len(self.paths) - 1, 0, -1):  # containers stand behind the one around them
            size[self.around[i]] += size[i]
            links[self.around[i]] += links[i]
        out = [False] * len(self.paths)
        for i in range(1, len(self.paths)):
            out[i] = out[self.around[i]] or self.hinted[i] and (links[i] >= LINKED * size[i] or size[i] < PART * size[0])
        self.blocks = [b for b in self.blocks if not out[b[0]]]

    def everything(self, i: int) -> bool:
        """Whether a container is the document, html or body."""
        return re.split(r"[.#]", self.names[i], maxsplit=1)[0] in ("", "html", "body")

    def votes(self) -> dict[int, float]:
        """Each path's share of the page's scores."""
        got: dict[int, float] = defaultdict(float)
        for c, body, links in self.blocks:
            weight = max(0, len(body) - 2 * links)
            if self.main[c] >= 0:
                got[self.paths[self.main[c]]] += 2 * weight
            else:
                outer = self.around[c] if self.around[c] >= 0 else 0
                got[self.paths[outer]] += weight
                if self.around[outer] >= 0:
                    got[self.paths[self.around[outer]]] += weight / 2
        total = sum(got.values())
        return {p: v / total for p, v in got.items()} if total else {}

    def inside(self, at: set[int]) -> list[bool]:
        """Whether each container has one of the paths or is in one that has."""
        out = [False] * len(self.paths)
        for i, p in enumerate(self.paths):
            out[i] = p in at or (i > 0 and out[self.around[i]])
        return out

    def within(self, winners: list[int]) -> list[str]:
        """The blocks of all containers with a winning path, in page order; ``winners`` has the best first."""
        place: dict[int, int] = {}
        for i, p in enumerate(self.paths):
            place.setdefault(p, i)
        won = [p for p in winners if p in place]
        if not won:
            return []
        if self.everything(place[won[0]]):
            held = self.inside({won[0]})
            return [body for c, body, _ in self.blocks if held[c]]
        mains = {self.paths[m] for m in self.main if m >= 0}
        if won[0] in mains:
            won = [p for p in won if p in mains]
        direct, held = set(won), self.inside({p for p in won if not self.everything(place[p])})
        return [body for c, body, _ in self.blocks if held[c] or self.paths[c] in direct or self.paths[max(0, self.around[c])] in direct]

    def text(self, winners: list[int]) -> str:
        blocks = self.within(winners)
        if not blocks:
            own = self.votes()
            least = KEEP * max(own.values(), default=0.0)
            blocks = self.within(sorted((p for p in own if own[p] >= least), key=lambda p: (-own[p], p))) if own else [b for _, b, _ in self.blocks]
        return "\n".join(blocks)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def winning_paths(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """host and paths, the best first; at most 1 / ``LEAST`` paths can win at a host."""
    schema = pa.schema([("host", pa.string()), ("path", pa.int64()), ("votes", pa.float64())])

    def run(batches):
        for whole in batches:
            for b in portions(whole, 1):
                sums: dict[tuple[str, int], float] = defaultdict(float)
                for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    for path, share in Page(source).votes().items():
                        sums[host, path] += share
                yield pa.RecordBatch.from_pydict({"host": [h for h, _ in sums], "path": [p for _, p in sums], "votes": list(sums.values())}, schema=schema)

    votes = pages.select(host_of(F.col(url)).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html")).filter("host <> ''").mapInArrow(run, "host string, path long, votes double")
    votes = stored(votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes")), shared_dir(pages.sparkSession))
    top = votes.groupBy("host").agg(F.max("votes").alias("top"), F.sum("votes").alias("all"))
    kept = votes.join(top, "host").filter((F.col("votes") >= KEEP * F.col("top")) & (F.col("votes") >= LEAST * F.col("all")))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), F.col("path").alias("path"))))
    return kept.groupBy("host").agg(ranked.getField("path").alias("paths"))


def extract(pages: DataFrame, html: str = "html", url: str = "url", columns: tuple[str, ...] | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points); ``columns``: those that pass through, by default all."""
    keep = [c for c in (pages.columns if columns is None else columns) if c not in ("text", "n_chars")]
    winners = stored(winning_paths(pages, html, url), shared_dir(pages.sparkSession)).select(F.col("host").alias("name"), "paths")
    # the input's columns are fields of one, so that none clashes
    given = pages.select(F.struct(F.lit(1).alias("one"), *[F.col(f"`{c}`") for c in keep]).alias("row"), host_of(F.col(url)).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    given = given.join(winners, F.col("host") == F.col("name"), "left").select("row", F.coalesce("paths", F.array().cast("array<bigint>")).alias("paths"), "html")
    schema = T.StructType([given.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for whole in batches:
            for b in portions(whole, 2):
                texts = [Page(h).text(p) for p, h in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["row", "text", "n_chars"])

    return given.mapInArrow(run, schema).select(*[F.col("row").getField(c).alias(c) for c in keep], "text", "n_chars")
