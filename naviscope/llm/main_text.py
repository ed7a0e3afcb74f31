"""Main text of web pages, with site templates removed.

Every block element is a subtree; its hash covers its tag, its texts and the subtrees below.
Spark counts beside how many different contents (the main region without the subtree) each hash
occurs on a host: copies of one page count once. Subtrees with MIN_PAGES of them are the site's
template and go, however large the host is. Within articles a subtree must also stand in half of the
host's different articles, have at least MIN_CHARS characters and be no heading, list item or part
of a table: what a few articles share is their own text. So do elements that name themselves as
something else than the article (menus, footers, adverts, comments, ...). The main text is what is
left of the page's articles, or, on a page without one, of its main element, or of the whole body.
Pages are parsed once to count and once to extract, so that no text is stored or shuffled between.
"""

import re
import sys
from hashlib import blake2b
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from naviscope.llm.common import tidy
from naviscope.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A subtree is template if it stands beside so many different contents of the host.
MIN_PAGES = 4
# Within articles, shorter subtrees recur by chance.
MIN_CHARS = 12
# Hashes (8 bytes each) up to which templates are broadcast; beyond, they are joined to the pages.
BROADCAST_HASHES = 4_000_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
DROPPED = frozenset("head title script style noscript template iframe object svg canvas nav footer aside form select button textarea menu dialog audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar footer cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription comment comments disqus related recommended share sharing social widget".split()
)
OUTSIDE = frozenset("header masthead topbar".split())
# Elements that end an open element of the first kind.
ENDS = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
# Within articles, these recur as parts of different wholes.
PARTS = frozenset("h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption article".split())
HOLDERS = frozenset("ul ol dl table tbody thead body html article main div section".split())


def digest_of(text):
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def names_of(attributes):
    words = f"{attributes.get('class') or ''} {attributes.get('id') or ''}"
    return {w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", words)}


class Page(HTMLParser):
    """Blocks of text of a page: (text, dropped, level, element), and its subtrees' hashes.

    Each tag costs the same however many are open: the places of open elements are kept by tag.
    """

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.blocks, self.chars, self.parent, self.digest = [], [0], [-1], [0]
        # Per element: its first block, the one after its last, and whether it can be template.
        self.first, self.last, self.candidate, self.in_article = [0], [0], [False], [False]
        self.stack = [("", False, 0, 0, [])]
        # Places in the stack of open elements: by tag, of all blocks, and of those that hold lists and the like.
        self.open, self.open_blocks, self.open_holders = {}, [0], [0]
        self.pieces = []
        self.feed(html)
        self.close()
        self.flush()
        self.pop_to(1)

    def parse_marked_section(self, i, report=1):
        # Outside of embedded XML a browser takes `<![...>` for a comment.
        return self.parse_bogus_comment(i)

    def flush(self):
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        if text:
            _, dropped, level, element, parts = self.stack[-1]
            self.blocks.append((text, dropped, level, element))
            self.chars.append(self.chars[-1] + len(text))
            parts.append(text)

    def pop_to(self, size):
        while len(self.stack) > size:
            self.pop()

    def pop(self):
        tag, _, level, element, parts = self.stack.pop()
        at = len(self.stack)
        self.open[tag].pop()
        if self.open_blocks[-1] == at:
            self.open_blocks.pop()
        if self.open_holders[-1] == at:
            self.open_holders.pop()
        if element != self.stack[-1][3]:
            self.last[element] = len(self.blocks)
            if parts:
                inside = level == 2 and self.stack[-1][2] == 2
                # What stands in articles is counted apart from what stands elsewhere.
                self.digest[element] = digest_of("\x1f".join(["\x1d" * inside + tag, *parts]))
                self.stack[-1][4].append(f"\x1e{self.digest[element]}")
                chars = self.chars[-1] - self.chars[self.first[element]]
                self.in_article[element] = inside
                self.candidate[element] = level < 2 or (inside and tag not in PARTS and chars >= MIN_CHARS)

    def handle_starttag(self, tag, attrs):
        inline = tag in INLINE
        if not inline:
            self.flush()
        ended = ENDS.get(tag)
        if ended:
            last = max(self.open[t][-1] if self.open.get(t) else 0 for t in (*ended, "p"))
            if last > self.open_holders[-1]:
                self.pop_to(last)
        elif not inline and self.stack[self.open_blocks[-1]][0] == "p":
            self.pop_to(self.open_blocks[-1])
        if tag == "br":
            self.pieces.append(" ")
        if tag in VOID:
            return
        _, dropped, level, element, parts = self.stack[-1]
        attributes = dict(attrs)
        role = (attributes.get("role") or "").lower()
        if tag == "article" or role == "article" or attributes.get("itemprop") == "articleBody":
            level = 2
        elif tag == "main" or role == "main":
            level = max(level, 1)
        if not dropped and tag not in ("html", "body"):
            words = names_of(attributes) if attributes and not inline else set()
            dropped = tag in DROPPED or role in ROLES or bool(words & NAMES) or (level < 2 and (tag == "header" or bool(words & OUTSIDE)))
        at = len(self.stack)
        self.open.setdefault(tag, []).append(at)
        if not inline:
            self.open_blocks.append(at)
            if tag in HOLDERS:
                self.open_holders.append(at)
            element, parts = len(self.parent), []
            self.parent.append(self.stack[-1][3])
            self.digest.append(0)
            self.first.append(len(self.blocks))
            self.last.append(len(self.blocks))
            self.candidate.append(False)
            self.in_article.append(False)
        self.stack.append((tag, dropped, level, element, parts))

    def handle_endtag(self, tag):
        inline = tag in INLINE
        if not inline:
            self.flush()
        if self.open.get(tag) and (not inline or self.open[tag][-1] > self.open_blocks[-1]):
            self.pop_to(self.open[tag][-1])

    def handle_data(self, data):
        self.pieces.append(data)

    def best_level(self):
        return max((level for _, dropped, level, _ in self.blocks if not dropped), default=0)

    def hashes(self, host):
        """Rows (hash, rest, inside) of the page: for each different subtree that can be template its hash on this
        host, the digest of the main region without it, and whether it stands in an article. First comes a row
        of the host's own hash, with the digest of the whole main region."""
        best, salt = self.best_level(), digest_of(host)
        sums = [0]
        for text, dropped, level, _ in self.blocks:
            sums.append(sums[-1] + (digest_of(text) if level == best and not dropped else 0))
        found = {salt: (signed(sums[-1]), False)}
        for element, d in enumerate(self.digest):
            if self.candidate[element]:
                rest = sums[-1] - (sums[self.last[element]] - sums[self.first[element]])
                found.setdefault(d ^ salt, (signed(rest), self.in_article[element]))
        return [(h, *x) for h, x in found.items()]

    def main_text(self, is_template):
        """The blocks of the highest level left without the subtrees whose digest `is_template`."""
        gone = [False]
        for parent, digest, candidate in zip(self.parent[1:], self.digest[1:], self.candidate[1:]):
            gone.append(gone[parent] or (candidate and is_template(digest)))
        left = [(level, text) for text, dropped, level, element in self.blocks if not dropped and not gone[element]]
        best = max((level for level, _ in left), default=0)
        return "\n".join(text for level, text in left if level == best)


def signed(x):
    return (x + 2**63) % 2**64 - 2**63


def page_rows(batches):
    """(host, hash, rest, inside) of all subtrees of all pages, hosts by their hash."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    for batch in tidy(batches):
        rows = []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            salt = digest_of(host)
            rows += [(salt, *r) for r in Page(html.as_py() or "").hashes(host)]
        values = zip(*rows) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["host", "hash", "rest", "inside"])


def templates(pages):
    """(hash): the subtrees, each hashed with its host, that are template there; stored."""
    rows = pages.select("host", "html").mapInArrow(page_rows, "host long, hash long, rest long, inside boolean")
    counted = rows.distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"), F.bool_or("inside").alias("inside"))
    counted = materialise(counted.where((F.col("n") >= MIN_PAGES) | (F.col("host") == F.col("hash"))), "subtree-counts")
    wholes = counted.where("host = hash").select("host", F.col("n").alias("n_contents"))
    often = counted.where((F.col("n") >= MIN_PAGES) & (F.col("host") != F.col("hash"))).join(wholes, "host")
    return materialise(often.where(~F.col("inside") | (2 * F.col("n") >= F.col("n_contents"))).select("hash"), "templates")


def page_templates(pages, template):
    """(_host, _page, template): the hashes of a page that are template on its host, stored; pages without are left out."""

    def held(batches):
        kinds = [pa.string(), pa.binary(), pa.int64()]
        for batch in tidy(batches):
            rows = []
            for host, page, html in zip(*[c.to_pylist() for c in batch.columns]):
                rows += [(host, page, h) for h, _, _ in Page(html or "").hashes(host)]
            values = zip(*rows) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["_host", "_page", "hash"])

    rows = pages.select("host", "page", "html").mapInArrow(held, "_host string, _page binary, hash long").distinct()
    return materialise(rows.join(template, "hash").groupBy("_host", "_page").agg(F.collect_set("hash").alias("template")), "page-templates")


def extract(pages):
    """Main text of every page: page_id, url, text and n_chars (its code points).

    One row per input row. A null or empty page has an empty text; a null url, or one without
    `://`, has the empty host; repeated rows are repeated; an empty table gives no row; other
    columns are ignored; the time for a long page grows as its length. Tags in disorder are closed as
    browsers do; what follows an element that is never closed counts as inside it.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", "://([^/?#]*)", 1), F.lit("")))
    # Rows of equal host and html share their template; the key stands for the html.
    key = F.unhex(F.md5(F.coalesce(F.col("html").cast("string"), F.lit(""))))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), host.alias("host"), key.alias("page"), F.col("html").cast("string"))
    template = templates(rows)
    names = ["page_id", "url", "text", "n_chars"]
    known = None
    if template.limit(BROADCAST_HASHES + 1).count() <= BROADCAST_HASHES:
        # Eight bytes each.
        known = rows.sparkSession.sparkContext.broadcast(np.sort(template.toArrow().column("hash").to_numpy()))

    def run(batches):
        for batch in tidy(batches):
            texts = []
            for host, html, held in zip(*[c.to_pylist() for c in batch.columns[2:]]):
                page, salt = Page(html or ""), digest_of(host)
                if known is None:
                    mine = frozenset(held or ())
                else:
                    own = np.array([d ^ salt for d, c in zip(page.digest, page.candidate) if c], np.int64)
                    near = np.searchsorted(known.value, own)
                    mine = frozenset(own[(near < len(known.value)) & (known.value[np.minimum(near, len(known.value) - 1)] == own)].tolist()) if len(known.value) else ()
                texts.append(page.main_text(lambda d: d ^ salt in mine))  # noqa: B023
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names)

    if known is None:
        on = (F.col("host") == F.col("_host")) & (F.col("page") == F.col("_page"))
        rows = rows.join(page_templates(rows, template), on, "left")
    else:
        rows = rows.withColumn("template", F.lit(None).cast("array<long>"))
    return rows.select("page_id", "url", "host", "html", "template").mapInArrow(run, "page_id long, url string, text string, n_chars long")
