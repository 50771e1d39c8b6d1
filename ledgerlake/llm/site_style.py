"""Main text of web pages by a site style tree.

The DOMs of the different pages of a host are merged: elements with the same path of tags, classes
and ids are one element node.  Its presentation nodes are the different sequences of children that
pages show there; its content nodes are the clauses and link targets of the text right inside it.
Both carry an entropy-based importance.  An element that looks the same on all pages, or a clause
that stands on all pages, is spread evenly over the site, has the greatest entropy over pages and
no importance; what only one page holds has all of it:

    presentation(E) = 1 - (ln T - H(styles of E)) / ln(T + 2),   T pages hold E
    content(E, f)   = 1 - ln n / ln(M + 2),                      n of the M pages of the host hold f in E
    leaf            = mean of content over its clauses
    E               = (1 - g^l) presentation(E) + g^l mean(children),   l styles of E

The two pages more in the denominators keep a small site from judging on too little evidence.  A
branch is removed where it and everything in it is less important than ``NOISE``.  Elements whose
tag, ARIA role, class or id names them as furniture (menu, advert, form, reader comments, ...) have
no importance from the start: an advert with a new text on every page is not told apart from the
article by entropy.  What is left is the main text, a block a paragraph.

Two jobs: one merges pages (partial counts, one small row a widespread node), one reads every page
again beside the tree of its host.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import as_text, byte_slices, field, ident, map_texts, set_arrow_rows
from ledgerlake.session import cut_lineage

#: Importance below which a branch is noise, and the damping of presentation by styles.
NOISE = 0.05
GAMMA = 0.9
#: Least spread over the host (ln n / ln(M + 2)) of a clause or element that the tree keeps; a less
#: spread one counts as the page's own.
COMMON = 0.9
SLICE_BYTES = 2 << 20

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
# an open element of the first kind ends at the start of the second, inside the third
ENDS_AT = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
           "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
           "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
           "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
           "option": ({"option"}, {"select", "datalist"})}
WITHIN = {"li": {"ul", "ol", "menu", "dir"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}}
# Names of furniture.
TAGS = frozenset("audio button canvas datalist dialog embed footer form head iframe input map menu nav noembed noframes noscript "
                 "object option script select style svg template textarea title video aside".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar "
                  "tablist tooltip".split())
WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion "
                  "banner banners nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer masthead topbar "
                  "cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription "
                  "signup login share sharing social related recommended recommendations comment comments commentlist disqus "
                  "reply replies respond form search searchbox widget widgets pagination pager toolbar copyright skiplink".split())
HEADERS = frozenset("header site-header page-header siteheader pageheader top-header global-header".split())
LANDMARK_TAGS = frozenset(("article", "main"))
STATES = ("no-", "has-", "with-", "without-", "is-", "js-")

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_TAG_ANY = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"[0-9]+")
_CLAUSE = re.compile(r"[.!?;:|·•。！？]+(?:\s|$)|。")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW}
_AFTER_COMMENT = re.compile(r"--!?>")

FURNITURE, FRAGILE, HEADER, LANDMARK = 1, 2, 4, 8


def _hash(*parts) -> int:
    """Signed 64-bit hash, the same in every process."""
    h = xxhash.xxh64_intdigest("\0".join(map(str, parts)))
    return h - (1 << 64) if h >> 63 else h


@lru_cache(1 << 14)
def _look(tag: str, attrs: str) -> tuple[str, int]:
    """Name of an element in the tree, and what its tag and attributes say of it.

    FRAGILE: a form, or named by class or id, which does not count around the article itself.
    """
    flags = FURNITURE if tag in TAGS and tag != "form" else FRAGILE if tag == "form" else 0
    flags |= HEADER if tag == "header" else LANDMARK if tag in LANDMARK_TAGS else 0
    tokens = []
    if attrs.strip(" /\t\r\n"):
        for m in _ATTR.finditer(attrs):
            name = m.group(1).lower()
            value = next((v for v in m.groups()[1:] if v is not None), "")
            if name in ("class", "id"):
                tokens += entities.unescape(value).split()
            elif name == "role":
                role = value.strip().lower()
                flags |= LANDMARK if role in ("main", "article") else HEADER if role == "banner" else FURNITURE if role in ROLES else 0
            elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" \
                    or name == "style" and _HIDDEN.search(value):
                flags |= FURNITURE
            elif name == "itemprop" and value == "articleBody":
                flags |= LANDMARK
    for token in tokens:
        low = token.lower()
        if low in HEADERS:
            flags |= HEADER
        elif not low.startswith(STATES) and any(w.lower() in WORDS for w in _WORDS.findall(token)):
            flags |= FRAGILE
    return tag + "." + ".".join(sorted({_DIGITS.sub("0", t.lower()) for t in tokens})), flags


class Dom:
    """Block elements and text leaves of a page in document order; parents come before children."""

    def __init__(self, html: str):
        self.parent: list[int] = [-1]
        self.key: list[int] = [_hash("root")]
        self.flags: list[int] = [0]
        self.text: dict[int, str] = {}           # leaf -> text, white space collapsed
        self.links: dict[int, list[str]] = {}
        self._names = ["root"]
        self._stack = [0]
        self._open: dict[str, int] = {}
        self._run: list[str] = []
        self._hrefs: list[str] = []
        self._muted: list[str] = []              # open inline elements inside furniture
        self._parse(html)

    def _parse(self, html: str) -> None:
        at, size, tag_at = 0, len(html), _TAG
        while at < size:
            lt = html.find("<", at)
            if lt < 0:
                lt = size
            if lt > at:
                self._say(html[at:lt])
            if lt == size:
                break
            nxt = html[lt + 1:lt + 2]
            if nxt == "!" or nxt == "?":
                if html.startswith("<!--", lt):
                    m = None if html.startswith(("<!-->", "<!--->"), lt) else _AFTER_COMMENT.search(html, lt + 4)
                    at = m.end() if m else html.find(">", lt) + 1 if html.startswith(("<!-->", "<!--->"), lt) else size
                else:
                    gt = html.find(">", lt)
                    at = gt + 1 if gt >= 0 else size
                continue
            m = tag_at.match(html, lt) if nxt == "/" or nxt.isalpha() else None
            if m is None and (nxt == "/" or nxt.isalpha()) and tag_at is _TAG:
                tag_at = _TAG_ANY                # a quote that never ends: from here on, tags end at the first >
                m = tag_at.match(html, lt)
            if m is None:
                self._say("<")
                at = lt + 1
                continue
            at = m.end()
            tag = m.group(2).lower()
            if m.group(1):
                self._end(tag)
                continue
            self._start(tag, m.group(3))
            if tag in RAW:
                end = _RAW_END[tag].search(html, at)
                at = end.end() if end else size
                self._end(tag)
        self._flush()

    def _say(self, text: str) -> None:
        if self._names[-1] == "head" and text.strip():
            self._end("head")
        if not self._muted:
            self._run.append(entities.unescape(text) if "&" in text else text)

    def _flush(self) -> None:
        if self._run:
            text = " ".join("".join(self._run).split())
            if text:
                me = self._add(self._stack[-1], "#", 0)
                self.text[me] = text
                self.links[me] = self._hrefs
            self._run = []
        self._hrefs = []
        self._muted = []

    def _add(self, parent: int, name: str, flags: int) -> int:
        self.parent.append(parent)
        self.key.append(_hash(self.key[parent], name))
        self.flags.append(flags)
        return len(self.parent) - 1

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self._say(" ")
            return
        name, flags = _look(tag, attrs)
        if self._names[-1] == "head" and tag not in HEAD:
            self._end("head")
        if tag in INLINE or (tag in VOID and tag != "hr"):
            if tag in VOID:
                return
            if self._muted or flags & (FURNITURE | FRAGILE):
                if self._muted:
                    self._muted += [tag] if tag == self._muted[0] else []
                else:
                    self._muted = [tag]
            elif tag == "a":
                m = re.search(r"href\s*=\s*[\"']?([^\"'\s>]*)", attrs)
                if m:
                    self._hrefs.append(m.group(1))
            return
        self._flush()
        if tag in CLOSES_P and self._names[-1] == "p":
            self._pop()
        if tag in ENDS_AT:
            ends, inside = ENDS_AT[tag]
            i = len(self._names) - 1
            last = -1
            while i > 0 and self._names[i] not in inside and i >= len(self._names) - 4:
                if self._names[i] in ends:
                    last = i
                i -= 1
            while last > 0 and len(self._names) > last:
                self._pop()
        if tag == "hr":
            return
        if tag == "body":
            while len(self._names) > 1 and self._names[-1] != "html":
                self._pop()
        self._stack.append(self._add(self._stack[-1], name, flags))
        self._names.append(tag)
        self._open[tag] = self._open.get(tag, 0) + 1

    def _pop(self) -> None:
        self._stack.pop()
        self._open[self._names.pop()] -= 1

    def _end(self, tag: str) -> None:
        if tag in INLINE:
            if self._muted and tag == self._muted[-1]:
                self._muted.pop()
            return
        if tag == "br":
            self._say(" ")
            return
        if not self._open.get(tag):
            return
        stop = WITHIN.get(tag, ())
        if stop and self._names[-1] != tag:
            # a stray end tag does not leave its list or table
            i = len(self._names) - 1
            while self._names[i] != tag and self._names[i] not in stop:
                i -= 1
            if self._names[i] != tag:
                return
        self._flush()
        while self._names[-1] != tag:
            self._pop()
        self._pop()

    def furniture(self) -> list[bool]:
        """Nodes that their names, or those around them, mark as furniture."""
        n = len(self.parent)
        holds = [bool(f & LANDMARK and not f & (FURNITURE | FRAGILE)) for f in self.flags]
        for i in range(n - 1, 0, -1):
            # what lies in furniture by tag is no landmark of the page
            if holds[i] and not self.flags[i] & FURNITURE:
                holds[self.parent[i]] = True
        out, inside = [False] * n, [False] * n
        for i in range(1, n):
            up, f = self.parent[i], self.flags[i]
            inside[i] = inside[up] or bool(f & LANDMARK and not f & FRAGILE)
            out[i] = out[up] or bool(f & FURNITURE) or bool(f & FRAGILE and not holds[i]) \
                or bool(f & HEADER and not inside[up] and not holds[i])
        return out

    def clauses(self, leaf: int) -> list[int]:
        """Content nodes of a leaf: its clauses and link targets, numbers folded."""
        text = _DIGITS.sub("0", self.text[leaf].lower())
        parts = [p for p in (x.strip() for x in _CLAUSE.split(text)) if p] or [text]
        parts += ["\1" + _DIGITS.sub("0", h) for h in self.links[leaf]]
        key = self.key[leaf]
        return sorted({_hash(key, p) for p in parts})

    def styles(self) -> dict[int, list[int]]:
        """Element -> keys of its children in order."""
        kids: dict[int, list[int]] = {i: [] for i in range(len(self.parent)) if i not in self.text}
        for i in range(1, len(self.parent)):
            kids[self.parent[i]].append(self.key[i])
        return kids


def merge_rows(dom: Dom) -> list[tuple[int, int]]:
    """A page's part of the tree: (element, style) and (0, content node) pairs, each once; furniture left out."""
    gone = dom.furniture()
    rows = {(dom.key[i], _hash(*kids)) for i, kids in dom.styles().items() if not gone[i] and kids}
    for leaf in dom.text:
        if not gone[leaf]:
            rows.update((0, c) for c in dom.clauses(leaf))
    return sorted(rows)


def main_text(dom: Dom, tree: dict[int, float]) -> str:
    """Blocks of the page that are left without furniture and branches of no importance.

    ``tree``: content node -> importance, element -> presentation importance + 2 times its styles.
    """
    gone = dom.furniture()
    if tree:
        n = len(dom.parent)
        total, count, clean = [0.0] * n, [0] * n, [False] * n     # clean: something in it is important
        noise = [False] * n
        for i in range(n - 1, -1, -1):
            if i in dom.text:
                found = [tree.get(c, 1.0) for c in dom.clauses(i)]
                worth = sum(found) / len(found)
            elif gone[i] or not count[i]:
                worth = 0.0
            else:
                known = tree.get(dom.key[i])
                if known is None:
                    worth = 1.0
                else:
                    styles = int(known // 2)
                    keep = GAMMA ** styles
                    worth = (1 - keep) * (known - 2 * styles) + keep * total[i] / count[i]
            important = clean[i] or worth >= NOISE
            noise[i] = not important
            up = dom.parent[i]
            if up >= 0 and not gone[i]:
                total[up] += worth
                count[up] += 1
                clean[up] = clean[up] or important
        for i in range(1, n):
            gone[i] = gone[i] or noise[i] or gone[dom.parent[i]]
    return "\n\n".join(t for i, t in dom.text.items() if not gone[i])


_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url_col: str):
    """Lower-case host of a URL, '' where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(ident(url_col).cast("string"), _HOST, 1), F.lit("")))


class _Rows:
    """Per page: elements, and styles or content nodes beside them."""

    def __call__(self):
        def run(values: pa.Array):
            found = [merge_rows(Dom(t)) for t in as_text(values)]
            return [[[{"e": e, "x": x} for e, x in rows] for rows in found]]
        return run


def style_trees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, tree): the widespread nodes of each host's tree, pairs of key and importance.

    Equal pages of a host count once.  A host holds at most about one and a half times as many
    entries as an average page has nodes, times M^0.1.
    """
    sites = pages.select(host_of(url_col).alias("host"), ident(html_col).cast("string").alias("html")).where("host <> '' and html <> ''")
    sites = sites.select("host", "html", F.xxhash64("html").alias("h1"), F.hash("html").alias("h2"))
    found = map_texts(sites, "html", _Rows(), [field("rows", "array<struct<e:long,x:long>>")], ["host", "h1", "h2"], SLICE_BYTES)
    # equal pages have equal rows; one of them is kept before any counting
    once = cut_lineage(found.dropDuplicates(["host", "h1", "h2"]), "site-pages")
    size = once.groupBy("host").agg(F.count(F.lit(1)).alias("M"))
    counted = (once.select("host", F.explode("rows").alias("r")).select("host", "r.e", "r.x").groupBy("host", "e", "x")
               .agg(F.count(F.lit(1)).alias("n")))
    counted = cut_lineage(counted, "site-nodes")
    content = (counted.where("e = 0").join(size, "host").withColumn("spread", F.log("n") / F.log(F.col("M") + 2))
               .where(F.col("spread") >= COMMON).select("host", F.col("x").alias("key"), (1 - F.col("spread")).alias("worth")))
    # sums of whole millionths do not depend on the order of rows
    n_ln_n = F.round(F.col("n") * F.log("n") * 1e6).cast("decimal(38,0)")
    shown = (counted.where("e <> 0").groupBy("host", "e")
             .agg(F.sum("n").alias("T"), F.count(F.lit(1)).alias("l"), F.sum(n_ln_n).alias("s")).join(size, "host")
             .where(F.log("T") / F.log(F.col("M") + 2) >= COMMON))
    same = F.col("s").cast("double") / 1e6 / F.col("T") / F.log(F.col("T") + 2)
    shown = shown.select("host", F.col("e").alias("key"), (F.greatest(F.lit(0.0), 1 - same) + 2 * F.col("l")).alias("worth"))
    tree = content.unionByName(shown).groupBy("host").agg(F.sort_array(F.collect_list(F.struct("key", "worth"))).alias("tree"))
    return cut_lineage(tree, "site-trees")


class _Trees:
    """The trees last used by a task, by host."""

    def __init__(self, most: int = 64):
        self.held: dict[str, dict[int, float]] = {}
        self.most = most

    def of(self, host: str, entries: pa.Scalar) -> dict[int, float]:
        if not entries.is_valid:
            return {}
        if host not in self.held:
            if len(self.held) >= self.most:
                self.held.clear()
            flat = entries.values
            self.held[host] = dict(zip(flat.field(0).to_pylist(), flat.field(1).to_pylist(), strict=True))
        return self.held[host]


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the html) with ``text`` and ``n_chars`` (code points).

    Null, empty and text-free pages give an empty text.  A page whose URL is null or names no host
    has no tree: only names mark furniture there, as on hosts with few pages.  Equal pages count
    once in the tree and give equal texts; an empty table gives an empty result; kept columns named
    like the output are replaced.
    """
    spark = pages.sparkSession
    set_arrow_rows(spark)
    keep = [c for c in (keep if keep is not None else pages.columns) if c not in (html_col, "text", "n_chars")]
    trees = style_trees(pages, url_col, html_col).select(F.col("host").alias("__llm_host"), F.col("tree").alias("__llm_tree"))
    rows = pages.select(*[ident(c) for c in keep], ident(html_col).cast("string").alias("__llm_html"),
                        host_of(url_col).alias("__llm_host")).join(trees, "__llm_host", "left")
    at = len(keep)
    rows = rows.select(*[ident(c) for c in keep], "__llm_html", "__llm_host", "__llm_tree")
    schema = T.StructType([rows.schema[c] for c in keep] + [field("text", "string"), field("n_chars", "long")])

    def run(batches):
        held = _Trees()
        for batch in batches:
            for part in byte_slices(batch, at, SLICE_BYTES):
                hosts, trees = part.column(at + 1).to_pylist(), part.column(at + 2)
                texts = [main_text(Dom(t), held.of(hosts[i], trees[i])) if t else ""
                         for i, t in enumerate(as_text(part.column(at)))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=schema.names)

    return rows.mapInArrow(run, schema)
