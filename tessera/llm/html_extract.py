"""Main text of web pages by removing the templates of their site.

Every element subtree gets a hash of its tag, class, texts and children. Spark
counts for each host on how many of its different pages a subtree occurs; those
on at least ``MIN_PAGES`` are the site's template and are deleted, however many
pages the host has: templates rotate, so each may stand on few of them. Copies
and revisions of one article count as one page, so that they do not make its
paragraphs a template: ``SIGNATURES`` min-hashes of the four-word shingles of a
page's long texts are compared within the host, and pages that share one, in
``HOPS`` steps, get one label. The words and tags that mark menus, notices,
forms and the like only add to the templates.

Different articles also share single sentences (licence lines, quotations). So
a paragraph or heading without class or id, and any subtree inside ``article``
or ``main``, must recur on ``MAIN_SHARE`` of the host's articles to be deleted
by itself; it goes with a larger template around it. A page that has such a
main element gives its text only, after the templates are gone.

Each page gets its own templates only: its subtrees meet the recurring ones by
a join on host and subtree, salted by the page for large hosts, and go back to
it by a hash of host and html.

Defined cases: NULL or empty html gives an empty text; a page without a host
has no template; a page cut off in a tag loses that tag only; unclosed and
wrongly nested elements are closed as browsers do; equal rows give equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.frames import ship, staged
from tessera.llm.textnum import SMALL_CHUNK, U64, Chunk, chunks, mix, shingles
from tessera.sources.tables import read_table

MIN_PAGES = 4  # different pages of a host
MIN_MAIN_PAGES, MAIN_SHARE = 10, 0.5
SIGNATURES, HOPS = 4, 2
LONG = 12  # words of a text that goes into the signature; menus, adverts and notices are shorter
PAGES_PER_SALT = 20_000
BROADCAST = 64 << 20  # bytes of the pages' templates; more are joined by shuffle

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z][a-zA-Z0-9-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+")

# HTML's void, raw-text and inline elements, and which open elements a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter q ruby "
                   "rb rp rt s samp small span strike strong sub sup time tt u var wbr "
                   "script style template noscript link meta".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
         "option": {"select"}, "tbody": {"table"}}

# Elements, roles and words of class or id that mark what is not the article.
BOILERPLATE = frozenset("head nav footer aside form button select dialog menu template svg math object audio video canvas "
                        "input fieldset datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
                  "cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup sidebar menu nav "
                  "navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist reply replies "
                  "respond disqus share sharing social related recommended widget toolbar pagination pager copyright "
                  "disclaimer skip login".split())
OUTER_NAMES = NAMES | {"header"}
MAIN = frozenset(["article", "main"])
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())  # texts, if they have no class or id


def _digest(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                          "little", signed=True)


class _Open:
    __slots__ = ("tag", "name", "parts", "start", "junk", "inside")

    def __init__(self, tag, name, start, junk, inside):
        self.tag, self.name, self.parts, self.start, self.junk, self.inside = tag, name, [], start, junk, inside


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text.strip("/ \t\r\n") else {}


def _is_junk(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    if tag in BOILERPLATE or tag == "header" and not inside:
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES or \
            re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True
    words = _SPLIT.split(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower())
    return tag not in ("html", "body") and not (NAMES if inside else OUTER_NAMES).isdisjoint(words)


class Page:
    """One pass over a page. ``templates``: hashes to delete outside and inside of the main element."""

    def __init__(self, source: str, templates: frozenset[int] = frozenset(), main_templates: frozenset[int] = frozenset()):
        self.templates, self.main_templates = templates, main_templates
        self.out: list[str] = []
        self.stack = [_Open("", "", 0, False, False)]
        self.main: list[tuple[int, int]] = []
        self.subtrees: set[tuple[int, bool]] = set()
        self.long: list[str] = []
        self._read(source)

    def _read(self, source: str) -> None:
        at = 0
        while m := _TAG.search(source, at):
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"))
                continue
            if not m[0].endswith(">"):
                break  # the page ends within a tag
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
                continue
            self._start(tag, m[3])
            if tag in RAW and not m[3].endswith("/"):
                close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = close.end() if close else len(source)
                self._pop()
        else:
            if at < len(source):
                self._text(source[at:])
        while len(self.stack) > 1:
            self._pop()

    def _text(self, text: str) -> None:
        text = html.unescape(text)
        self.out.append(text)
        if words := text.split():
            self.stack[-1].parts.append(" ".join(words))
            if len(words) >= LONG and not self.stack[-1].junk:
                self.long += words

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            if tag not in VOID and tag not in CLOSES:
                self._close({"p"}, MAIN | {"div", "section", "td", "li", "body", "blockquote"})
            if tag in CLOSES:
                self._close(CLOSES[tag], SCOPE.get(tag, set()))
            self.out.append(" ")
        if tag in VOID:
            return
        attrs = _attributes(attributes)
        inside = self.stack[-1].inside
        junk = tag in RAW or _is_junk(tag, attrs, inside)
        name = " ".join(f"{attrs.get(k, '')}" for k in ("class", "id"))
        self.stack.append(_Open(tag, name, len(self.out), junk, inside or tag in MAIN and not junk))

    def _close(self, tags: set[str], scope) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i].tag in scope:
                return

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self.out.append(" ")
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                while len(self.stack) > i:
                    self._pop()
                return
            if tag in INLINE and self.stack[i].tag not in INLINE or tag == "p" and self.stack[i].tag in MAIN:
                return

    def _pop(self) -> None:
        e = self.stack.pop()
        parent = self.stack[-1]
        digest = _digest(e.tag, e.name, *map(str, e.parts))
        parent.parts.append(f"\1{digest}")
        strict = e.inside or e.tag in PLAIN and not e.name.strip()
        if e.tag in ("html", "body") or e.tag in MAIN and not e.junk and not parent.inside:
            if e.tag in MAIN:
                self.main.append((e.start, len(self.out)))
        elif e.junk or digest in (self.main_templates if strict else self.templates):
            del self.out[e.start:]
            self.out.append(" " if e.tag not in INLINE else "")
            while self.main and self.main[-1][0] >= e.start:
                self.main.pop()
        elif e.tag not in INLINE and e.parts:
            self.subtrees.add((digest, strict))
        if e.tag not in INLINE:
            self.out.append(" ")

    def text(self) -> str:
        main = " ".join(" ".join("".join(self.out[i:j]).split()) for i, j in self.main).strip()
        return main or " ".join("".join(self.out).split())


def signatures(pages: list[Page], contents: list[int]) -> list[list[int]]:
    """``SIGNATURES`` min-hashes of each page's long texts; of its whole text, if it has no long ones."""
    c = Chunk([" ".join(p.long).encode("utf-8", "replace") for p in pages], lower=True)
    keys, page = shingles(c, c.hashes(), 4)
    have, start = np.unique(page, return_index=True)
    out = np.repeat(np.array(contents, np.int64)[:, None], SIGNATURES, axis=1)
    for i in range(SIGNATURES if len(have) else 0):
        out[have, i] = np.minimum.reduceat(mix(keys ^ mix(np.array([i + 1], U64))), start).view(np.int64)
    return out.tolist()


def subtree_hashes(pages: DataFrame) -> DataFrame:
    """_page, _host, signatures of the page's article and its subtrees' hashes outside and inside of the main element."""
    def run(batches):
        for b, sources in chunks(batches, "html", SMALL_CHUNK):
            read = [Page(s.decode()) for s in sources]
            yield pa.RecordBatch.from_arrays(
                [b.column("_page"), b.column("_host"),
                 pa.array(signatures(read, [_digest(p.text()) for p in read]), pa.list_(pa.int64())),
                 pa.array([[d for d, inside in p.subtrees if not inside] for p in read], pa.list_(pa.int64())),
                 pa.array([[d for d, inside in p.subtrees if inside] for p in read], pa.list_(pa.int64()))],
                ["_page", "_host", "signatures", "outer", "inner"])

    return pages.where("_host IS NOT NULL").select("_page", "_host", "html") \
        .mapInArrow(run, "_page long, _host long, signatures array<long>, outer array<long>, inner array<long>")


def article_labels(read: DataFrame, hops: int = HOPS) -> DataFrame:
    """_page and label: the least page that it reaches in ``hops`` steps over pages of its host with an equal signature."""
    label = read.select("_page", "_host", F.col("_page").alias("label"), F.posexplode("signatures").alias("i", "signature"))
    for _ in range(hops):
        least = label.groupBy("_host", "i", "signature").agg(F.min("label").alias("least"))
        nearer = label.join(least, ["_host", "i", "signature"]).groupBy("_page").agg(F.min("least").alias("label"))
        label = staged(label.drop("label").join(nearer, "_page"), "labels")
    return label.where("i = 0").select("_page", "label")


def _subtrees(pages: DataFrame, *columns: str) -> DataFrame:
    return pages.select(*columns, F.lit(False).alias("inside"), F.explode("outer").alias("subtree")) \
        .unionByName(pages.select(*columns, F.lit(True).alias("inside"), F.explode("inner").alias("subtree")))


def site_templates(read: DataFrame, min_pages: int = MIN_PAGES, main_share: float = MAIN_SHARE) -> DataFrame:
    """_host, inside and subtree of what recurs on the different articles of a host."""
    known = staged(read.join(article_labels(read), "_page"), "labelled")
    hosts = known.groupBy("_host").agg(F.count_distinct("label").alias("pages"))
    seen = _subtrees(known, "_host", "label").groupBy("_host", "inside", "subtree").agg(F.count_distinct("label").alias("n")) \
        .where(F.when(F.col("inside"), F.col("n") >= MIN_MAIN_PAGES).otherwise(F.col("n") >= min_pages))
    return seen.join(hosts, "_host").where(~F.col("inside") | (F.col("n") >= main_share * F.col("pages"))) \
        .select("_host", "inside", "subtree")


def page_templates(pages: DataFrame) -> DataFrame:
    """_page and the hashes to delete from it outside and inside of the main element."""
    read = staged(subtree_hashes(pages).groupBy("_page")
                  .agg(*[F.any_value(c).alias(c) for c in ("_host", "signatures", "outer", "inner")]), "subtrees")
    salts = read.groupBy("_host").agg(F.ceil(F.count("*") / PAGES_PER_SALT).cast("int").alias("salts")).where("salts > 1")
    salts = staged(salts, "salts")
    found = site_templates(read).join(salts, "_host", "left") \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    own = _subtrees(read.join(salts, "_host", "left")
                    .withColumn("salt", F.pmod("_page", F.coalesce("salts", F.lit(1))).cast("int")), "_page", "_host", "salt")
    return own.join(staged(found, "templates"), ["_host", "salt", "inside", "subtree"]).groupBy("_page") \
        .agg(F.collect_list(F.when(~F.col("inside"), F.col("subtree"))).alias("outer"),
             F.collect_list(F.when(F.col("inside"), F.col("subtree"))).alias("inner"))


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST) -> DataFrame:
    """page_id, url and the main text of every page."""
    ship(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host.alias("host")) \
        .withColumn("_host", F.when(F.col("host") != "", F.xxhash64("host"))) \
        .withColumn("_page", F.xxhash64("host", "html")).drop("host")
    templates = staged(page_templates(rows), "page-templates")
    size = templates.agg(F.sum((F.size("outer") + F.size("inner")) * 8 + 100)).first()[0] or 0
    templates = F.broadcast(templates) if size <= broadcast_bytes else templates.hint("shuffle_hash")

    def run(batches):
        for b, sources in chunks(batches, "html", SMALL_CHUNK):
            texts = [Page(s.decode(), frozenset(o or ()), frozenset(i or ())).text()
                     for s, o, i in zip(sources, *(b.column(c).to_pylist() for c in ("outer", "inner")))]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return rows.join(templates, "_page", "left").select("page_id", "url", "html", "outer", "inner").mapInArrow(run, schema)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(read_table(spark, sf_dir, "pages"))
