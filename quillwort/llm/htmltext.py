"""Main text of HTML pages, by structure and by site templates.

Pass one hashes the element subtrees of every page and counts, for each host, on how many different pages each
occurs. Pass two deletes the subtrees that recur on many pages of their host, and what the page marks as menu,
header, footer, sidebar, notice, advert, form or comments, and returns the blocks of the rest.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Names of HTML elements by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot"
    " th thead tr ul".split()
)
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre b i em strong a span u code br li td th dd dt figcaption".split())
DROPPED = set(
    "head title script style noscript template nav footer aside form button select textarea input option iframe object"
    " svg canvas math video audio dialog menu".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disqus footer form header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo"
    " promoted promotion related search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: From so many words outside links on, a subtree may be content.
WORDS = 8
#: An opening tag ends these open elements, up to the nearest of the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}), "option": ({"option"}, {"select"})}
WALLS = set("article aside body div footer header li main nav section table td th ul ol form blockquote html".split())


class Node:
    __slots__ = ("tag", "attrs", "items", "digest", "plain", "linked")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.items, self.digest, self.plain, self.linked = tag, attrs, [], None, 0, 0


class Tree(HTMLParser):
    """A tolerant tree of a page; ``items`` of a node are nodes and strings in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]

    def _close(self, tags: set[str], walls: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in walls:
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        elif tag in BLOCK and tag != "br":
            self._close({"p"}, WALLS)
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].items.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in {"div", "p", "article", "section", "main", "b", "i", "span", "a", "script", "style"}:
            self.open.pop()

    def handle_endtag(self, tag):
        if tag == "br":
            self.open[-1].items.append(Node("br", {}))
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in WALLS and tag not in WALLS:
                return

    def handle_data(self, data):
        self.open[-1].items.append(data)


def parse(html: str | None) -> Node:
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def _walk(root: Node) -> list[Node]:
    """Nodes, parents first, without recursion: pages may nest deeply."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(x for x in reversed(node.items) if isinstance(x, Node))
    return out


def hash_subtrees(root: Node) -> list[Node]:
    """Sets the digest of every subtree from its tag, class, text and children; 0 where it has no text.

    Also sets the number of its words in links and outside of them.
    """
    nodes = _walk(root)
    for node in reversed(nodes):
        parts, filled = [node.tag, node.attrs.get("class", "")], False
        plain = linked = 0
        for x in node.items:
            if isinstance(x, Node):
                parts.append(str(x.digest))
                filled |= x.digest != 0
                plain, linked = plain + x.plain, linked + x.linked
            elif x := " ".join(x.split()):
                parts.append("=" + x)
                filled = True
                plain += x.count(" ") + 1
        node.plain, node.linked = (0, plain + linked) if node.tag == "a" else (plain, linked)
        node.digest = int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True) if filled else 0
    return nodes


def wordy(node: Node) -> bool:
    """Whether a subtree reads like content: ``WORDS`` words or more outside links, and no fewer than inside."""
    return node.plain >= WORDS and node.plain >= node.linked


def marked(node: Node, in_article: bool) -> bool:
    """Whether the page itself marks the subtree as something else than main text."""
    if node.tag in DROPPED or node.tag == "header" and not in_article or node.tag == "article" and in_article:
        return True
    a = node.attrs
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in DROPPED_ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True
    named = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{a.get('class', '')} {a.get('id', '')}").lower()))
    return bool(named & DROPPED_WORDS) and node.tag not in {"html", "body", "article", "main"}


def main_text(html: str | None, templates: set[int] | frozenset = frozenset()) -> str:
    """The blocks of the main text, joined by line ends; empty for null or blank pages.

    The main text stands in the outermost article elements, else in main, else in body. Inside article or main
    a recurring subtree goes unless it is prose (paragraphs, headings, list items and their inline markup) or reads
    like content, as articles of one site may well share passages; elsewhere every recurring subtree goes.
    """
    root = parse(html)
    nodes = hash_subtrees(root) if templates else _walk(root)
    tags = {n.tag for n in nodes} | {"main" for n in nodes if n.attrs.get("role") == "main"}
    holder = "article" if "article" in tags else "main" if "main" in tags else ""
    blocks: list[str] = []
    now: list[str] = []

    def end() -> None:
        if text := " ".join("".join(now).split()):
            blocks.append(text)
        now.clear()

    todo: list[tuple[object, bool]] = [(root, not holder)]
    while todo:
        item, inside = todo.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            if inside:
                now.append(item)
        else:
            held = bool(holder) and (item.tag == holder or holder == "main" and item.attrs.get("role") == "main")
            if marked(item, inside and bool(holder)):
                if item.tag in BLOCK and inside:
                    end()
                continue
            if templates and item.digest in templates and not held and not (inside and holder and (item.tag in PROSE or wordy(item))) and (inside or not _holds(item, holder)):
                continue
            within = inside or held
            split = item.tag in BLOCK
            if split:
                end()
                todo.append((None, within))
            todo.extend((x, within) for x in reversed(item.items))
    end()
    return "\n".join(blocks)


def _holds(node: Node, holder: str) -> bool:
    return bool(holder) and any(n.tag == holder or n.attrs.get("role") == holder for n in _walk(node))


def host(url: Column) -> Column:
    """Lower-case host of a URL; null if there is none."""
    got = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(got != "", got)


def templates(
    pages: DataFrame, min_pages: int = 5, share: float = 0.05, url: str = "url", html: str = "html", most_pages: int = 20, most: float = 0.5
) -> DataFrame:
    """Recurring subtrees as (host, hashes): those on ``min_pages`` and ``share`` of the host's different pages.

    Subtrees that read like content have to be on ``most_pages`` and the part ``most`` of them, as pages of one site
    may be near copies of each other or share passages. Copies of a whole page count once, so a page that was fetched often does not become its own template. A host
    has at most the mean number of subtrees of a page divided by ``share`` of them. Pages without a host have none.
    """
    common.small_batches(pages.sparkSession)
    rows = pages.select(host(F.col(f"`{url}`")).alias("host"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html")).filter("host is not null")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, whole, found, content = [], [], [], []
            for h, x in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                nodes = hash_subtrees(parse(x))
                own = {n.digest: wordy(n) for n in nodes[1:]} | {0: False}  # 0 stands for the page
                hosts += [h] * len(own)
                whole += [nodes[0].digest] * len(own)
                found += own
                content += own.values()
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(whole, pa.int64()), pa.array(found, pa.int64()), pa.array(content, pa.bool_())], names=["host", "page", "hash", "content"])

    seen = rows.mapInArrow(hashed, "host string, page long, hash long, content boolean")
    per = seen.distinct().groupBy("host", "hash", "content").agg(F.count(F.lit(1)).alias("n"))
    per = common.store(per.filter((F.col("n") >= min_pages) | (F.col("hash") == 0)), "html-counts")
    totals = per.filter("hash = 0").select("host", F.col("n").alias("pages"))
    least = F.when(F.col("content"), F.greatest(F.lit(most_pages), F.col("pages") * most)).otherwise(F.greatest(F.lit(min_pages), F.col("pages") * share))
    often = per.filter("hash <> 0").join(totals, "host").filter(F.col("n") >= least)
    return often.groupBy("host").agg(F.collect_list("hash").alias("hashes"))


def extract(pages: DataFrame, found: DataFrame | None = None, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in ``out``, which replaces a column of that name.

    Null and empty pages give an empty text; rows that repeat keep a row each; an empty table gives an empty one, and
    pages of any length are parsed whole. Names of other columns do not matter. Pages are joined with the templates of their host, one row each; the
    templates are broadcast after they are counted, and beyond that the join is salted, so that a host with a
    third of the pages does not meet in one task.
    """
    common.small_batches(pages.sparkSession)
    found = common.store(templates(pages, url=url, html=html) if found is None else found, "html-templates")
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), host(F.col(f"`{url}`")).alias("host"))
    if (found.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]) <= 20 * common.BROADCAST_ROWS:
        joined = packed.join(F.broadcast(found), "host", "left")
    else:
        spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
        salt = F.pmod(F.xxhash64(F.col(f"row.`{html}`"), F.col(f"row.`{url}`")), F.lit(16)).cast("int")
        joined = packed.withColumn("salt", salt).join(spread, ["host", "salt"], "left")

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for pages_, hashes in batches:
            yield pd.Series([main_text(x, set(h) if h is not None else frozenset()) for x, h in zip(pages_, hashes, strict=True)])

    kept = [F.col(f"row.`{c}`").alias(c) for c in pages.columns if c != out]
    return joined.select(*kept, text_of(F.col(f"row.`{html}`"), F.col("hashes")).alias(out))
