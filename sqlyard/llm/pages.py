"""Main text of web pages by site style trees: pages of a site are merged, and branches that say nothing new are cut off."""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlyard.sources.tables import stored

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that begin and end a block. All others, known or not, belong to the block around them.
_BLOCK = _HEADINGS | frozenset(
    "address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form head header "
    "hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Parts that the article is to be without by their element.
_NEVER = frozenset("head title script style noscript template nav footer aside form iframe object svg button select textarea dialog menu".split())
#: Words of class, id or role that name a part no article has, and words that may name a part of an article too.
_STRONG = frozenset("ad ads adv advert advertisement adverts breadcrumb breadcrumbs comment comments consent cookie cookies menu modal nav navbar navigation "
                    "newsletter pager pagination popup share sharing sidebar sponsor sponsored subscribe".split())
_WEAK = frozenset("banner footer header login notice promo related search social toolbar widget contentinfo complementary".split())
#: What may stand beside such a word in a name of several, as in ``comment-list`` or ``ad-slot``.
_BESIDE = frozenset("area bar block body bottom box container content footer form global group head header holder inner item items left list main outer page "
                    "panel post reader reply right section site slot text thread title top unit user wrap wrapper zone".split())
#: An element that ends where one of these begins.
_ROWS = {"tr", "td", "th", "caption", "colgroup"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": _ROWS, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
           "optgroup": {"option", "optgroup"}} | {tag: _ROWS | {"thead", "tbody", "tfoot"} for tag in ("thead", "tbody", "tfoot")}
#: All that a head may hold. An open head ends at anything else.
_HEAD = frozenset("base link meta noscript script style template title".split())
#: What lies around a block: a part that is never of the article; an article or main element; a strong or weak name outside or inside of it; a heading.
_OUT, _ARTICLE, _NAMED, _WEAKLY, _NAMED_INSIDE, _WEAKLY_INSIDE, _HEADING, _TITLE = 1, 2, 4, 8, 16, 32, 64, 128
_SCOPE = frozenset("table ul ol dl div section article main body aside nav header footer form blockquote".split())


def _named(word: str, names: frozenset) -> bool:
    """Whether a word of a class, id or role is one of the names, alone or with words that may stand beside it."""
    parts = re.split(r"[-_]+", word)
    return any(p in names for p in parts) and all(p in names or p in _BESIDE or p.isdigit() or not p for p in parts)


class Blocks(HTMLParser):
    """Reads a page into blocks ``(path, text, around)`` in page order, with the share of each that is links, and the kinds of children each element had.

    A path names the innermost block elements, ``deepest`` at most, with their classes and id, numbers masked; so its length, and the
    work per element, does not grow with the page's depth. ``around`` holds the marks above. Parts out by their element, and
    hidden ones, leave no text, wherever they stand, and do not end the block around them unless they are blocks themselves.
    """

    deepest = 24

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []
        self.names: list[str] = []
        self.open_tags: Counter[str] = Counter()
        self.blocks: list[tuple[str, str, int]] = []
        self.linked: list[float] = []
        self.styles: dict[str, list[str]] = {}
        self.words: list[str] = []
        self.in_links = 0
        self.feed(html)
        self.close()
        self.flush()

    def path(self) -> str:
        return "/".join(self.names[-self.deepest:])

    def around(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def flush(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            marks = next((m for _, m, block in reversed(self.stack) if block), 0)
            self.blocks.append((self.path(), text, marks))
            self.linked.append(min(1.0, self.in_links / len(text)))
        self.words, self.in_links = [], 0

    def cut_stack(self, first: int) -> None:
        for tag, _, block in self.stack[first:]:
            self.open_tags[tag] -= 1
            if block:
                self.names.pop()
        del self.stack[first:]

    def leave_head(self, tag: str | None = None) -> None:
        """An open head ends at ``body``, and between its elements at text or any element that is none of a head's."""
        if self.open_tags["head"]:
            i = next(i for i, (open_, _, _) in enumerate(self.stack) if open_ == "head")
            if tag == "body" or i == len(self.stack) - 1:
                self.flush()
                self.cut_stack(i)

    def handle_starttag(self, tag, attrs):
        if tag not in _HEAD:
            self.leave_head(tag)
        block = tag in _BLOCK
        if tag in _VOID:
            if tag in ("br", "hr", "img"):
                self.words.append(" ")
            if tag == "hr":
                self.flush()
            return
        inside = not self.around() & _OUT  # what a part without text holds ends nothing around it
        if block and inside:
            self.flush()
        if inside and (block or tag in _CLOSES):
            self.close_before(tag)
        marks = self.marks(tag, attrs)
        if block:
            words = sorted({re.sub(r"\d+", "0", w) for k, v in attrs if k in ("class", "id", "role") and v for w in v.lower().split()})
            name = ".".join([tag, *words])
            if not self.around() & _OUT:
                self.styles.setdefault(self.path(), []).append(name)
            self.names.append(name)
        self.stack.append((tag, marks, block))
        self.open_tags[tag] += 1

    def marks(self, tag: str, attrs) -> int:
        """What lies around the text of an element that begins here."""
        marks = self.around()
        hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v) for k, v in attrs)
        if hidden or tag in _NEVER or tag == "header" and not marks & _ARTICLE:
            return marks | _OUT
        if tag in ("article", "main"):
            return marks | _ARTICLE
        if tag in _HEADINGS:
            return marks | _HEADING | (_TITLE if tag == "h1" else 0)
        if tag in ("html", "body") or tag not in _BLOCK:
            return marks
        # inside an article an id is a place to link to, unless it says comments
        words = [w for k, v in attrs if v and (k in ("class", "role") or k == "id" and (not marks & _ARTICLE or "comment" in v.lower())) for w in v.lower().split()]
        if any(_named(w, _STRONG) for w in words):
            marks |= _NAMED_INSIDE if marks & _ARTICLE else _NAMED
        elif any(w in _WEAK for w in words):
            marks |= _WEAKLY_INSIDE if marks & _ARTICLE else _WEAKLY
        return marks

    def priors(self) -> list[float]:
        """What the place of each block says about it, from 0 to 1, before the style tree does.

        A strong name around it leaves little and a weak one less than all, unless it wraps the page: it does where it stands around
        all of the page's articles, or, without an article or inside one, around more text than is left without it. Text beside an
        article that holds most of the page's text is hardly of it, but for a title; nor are three or more blocks of links in a row
        outside an article, nor a short line with a copyright sign at the page's end.
        """
        marks, sizes = [m for _, _, m in self.blocks], [len(t) for _, t, _ in self.blocks]
        article = [bool(m & _ARTICLE) for m in marks]
        inside, total = sum(n for n, a in zip(sizes, article) if a), sum(sizes)

        def wraps(mark: int) -> bool:
            if mark in (_NAMED_INSIDE, _WEAKLY_INSIDE):
                return 2 * sum(n for n, m in zip(sizes, marks) if m & mark) > inside
            if any(article):
                return all(m & mark for m, a in zip(marks, article) if a)
            return 2 * sum(n for n, m in zip(sizes, marks) if m & mark) > total

        weights = {mark: 1.0 if wraps(mark) else weight for mark, weight in ((_NAMED, 0.2), (_WEAKLY, 0.2), (_NAMED_INSIDE, 0.2), (_WEAKLY_INSIDE, 0.6))}
        out = []
        for i, (m, a, n) in enumerate(zip(marks, article, sizes)):
            prior = min([1.0, *(w for mark, w in weights.items() if m & mark and not (a and mark in (_NAMED, _WEAKLY) and weights[mark] == 1.0))])
            if not a:
                run = [self.linked[j] >= 0.8 for j in range(max(0, i - 2), min(len(marks), i + 3))]
                linked = any(all(run[j: j + 3]) for j in range(len(run) - 2)) and self.linked[i] >= 0.8
                legal = n < 200 and i >= len(marks) - 2 and "©" in self.blocks[i][1] and len(marks) > 2
                if linked or legal or 2 * inside > total and not m & _TITLE:
                    prior *= 0.3
            out.append(prior)
        return out

    def close_before(self, tag: str) -> None:
        """Elements whose end tag may be left out: a paragraph ends at the next block, an item at the next item, with all in it."""
        ends, first = _CLOSES.get(tag, set()), len(self.stack)
        if self.open_tags["p"] or any(self.open_tags[e] for e in ends):
            for i in range(len(self.stack) - 1, -1, -1):
                open_ = self.stack[i][0]
                if open_ == "p" or open_ in ends:
                    first = i
                if open_ in _SCOPE:
                    break
            self.cut_stack(first)

    def handle_endtag(self, tag):
        if tag in _VOID or not self.open_tags[tag]:
            return
        block = tag in _BLOCK
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if block and not self.around() & _OUT:
                    self.flush()
                self.cut_stack(i)
                return
            if not block and self.stack[i][2]:
                return

    def handle_data(self, data):
        if not data.isspace():
            self.leave_head()
        if not self.around() & _OUT:
            self.words.append(data)
            if self.open_tags["a"]:
                self.in_links += len(" ".join(data.split()))


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _text_hash(text: str, site: str) -> int:
    """The same for texts that differ in numbers or the site's name only."""
    return _hash(re.sub(r"\d+", "0", text.replace(site, "") if site else text))


def _page_hash(blocks: list[tuple[str, str, int]]) -> int:
    """The same for all copies of an article, whatever the parts around it say."""
    inside = [text for _, text, around in blocks if around & _ARTICLE]
    return _hash("\n".join(inside or [text for _, text, _ in blocks]))


def _read(html: str | None) -> Blocks:
    return Blocks((html or "").replace("\x00", ""))


_FEATURES = ["site", "page", "path", "kind", "thing"]
_KINDS = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64()]


def _features(batches):
    """One row per page, path and distinct thing seen there: a text (kind 0), or the row of children (kind 1)."""
    for batch in batches:
        rows = []
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            site, page = host(url), _read(html)
            seen = {(path, 0, _text_hash(text, site)) for path, text, _ in page.blocks}
            for path, names in page.styles.items():
                row = [n for n, before in zip(names, [None, *names]) if n != before]
                seen.add((path, 1, _hash(" ".join(row))))
            which = _page_hash(page.blocks)
            rows += [(site, which, path, kind, thing) for path, kind, thing in seen]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, _KINDS)], _FEATURES)


def _importance(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Importance per element of the tree, from how many pages show each thing there.

    Content: one less the mean entropy of its texts, where a text on n of m pages has entropy log n / log m. Presentation: the
    entropy of its rows of children, to the base m. An element on one page only has importance 1.
    """
    n = F.col("n")
    per = counts.groupBy(*keys, "path", "kind").agg(
        F.sum(n).alias("all"), F.count("*").alias("things"), F.sum(F.log(n)).alias("logs"), F.sum(n * F.log(n)).alias("nlogs"))
    m = F.col("all")
    value = F.when(F.col("kind") == 0, 1 - F.col("logs") / F.col("things") / F.log(F.greatest(m, F.lit(2)))) \
        .otherwise((F.log(m) - F.col("nlogs") / m) / F.log(F.greatest(m, F.lit(2))))
    return per.select(*keys, "path", "kind", m.alias("pages"), F.when(m <= 1, 1.0).otherwise(value).alias("value"))


def _things(pages: DataFrame) -> DataFrame:
    """``(site, path, kind, thing, n)``: on how many pages of a site each thing is seen. Copies of an article on a site count once."""
    seen = pages.mapInArrow(_features, "site string, page long, path string, kind int, thing long")
    return stored(seen.groupBy("site", "path", "kind", "thing").agg(F.count_distinct("page").alias("n")), "things")


def _trees(counts: DataFrame, borrow: float, fade: float) -> DataFrame:
    own = _importance(counts, ["site"])
    every = stored(_importance(counts.groupBy("path", "kind", "thing").agg(F.sum("n").alias("n")), []), "every-site")
    mixed = own.join(every.select("path", "kind", F.col("value").alias("common")), ["path", "kind"]).select(
        "site", "path", "kind",
        ((F.col("value") * F.col("pages") + F.col("common") * borrow) / (F.col("pages") + borrow)).alias("value"))
    text, shape = F.max(F.when(F.col("kind") == 0, F.col("value"))), F.max(F.when(F.col("kind") == 1, F.col("value")))
    return mixed.groupBy("site", "path").agg(text.alias("text"), shape.alias("shape")).where("text IS NOT NULL").select(
        "site", "path", F.coalesce(F.greatest("text", (1 - fade) * F.col("text") + fade * F.col("shape")), F.col("text")).alias("importance"))


def style_trees(pages: DataFrame, borrow: float = 30.0, fade: float = 0.2) -> DataFrame:
    """``(site, path, importance)`` of every element with text of every site's merged tree.

    An element counts by its texts, and more by ``fade`` of the importance of its rows of children where that is higher. A branch is worth
    as much as the best element in it, so it goes as a whole exactly where all its elements do. A site's figures are mixed with
    those of the tree of all sites, which weighs as much as ``borrow`` pages, so that a site of one page is still told its menu
    from its article. Copies of an article on a site count once.
    """
    return _trees(_things(pages), borrow, fade)


def repeated_texts(counts: DataFrame, least: float) -> DataFrame:
    """``(site, path, thing)`` of texts whose own importance on their site, one less log n / log m for n of its m pages, is below ``least``;
    on three pages at least. The m of a site is the largest number of pages that any element of it is seen on."""
    sizes = counts.where("kind = 1").groupBy("site", "path").agg(F.sum("n").alias("n")).groupBy("site").agg(F.max("n").alias("m"))
    few = counts.where("kind = 0 AND n >= 3").join(sizes, "site")
    return few.where(1 - F.log("n") / F.log(F.greatest("m", "n")) < least).select("site", "path", "thing")


def main_text(pages: DataFrame, least: float = 0.5, least_in_article: float = 0.1, borrow: float = 30.0, fade: float = 0.2) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page: kept blocks in page order, two line ends between them.

    Each block is rated by the importance that its site's style tree gives its element, times what its place says
    (``Blocks.priors``: names, the article around or beside it, links), and goes below ``least``; so a branch goes as a whole only
    where all in it is rated below that. Inside an article or main element the tree's rating counts only with a name's, for
    repeats alone are no reason there, but a text, other than a heading, that all pages of a site show at the same place goes, by its own
    importance below ``least_in_article``. Parts that are never of the article (menus, headers, footers, asides, forms, scripts, hidden
    parts) go by their elements. Character references are decoded; white space in a block becomes one blank.

    Null html is empty, null or odd urls are one site of their own. Rows that repeat a ``page_id`` are a page each; further columns
    are not read. A page of any depth or length costs time in proportion to its length. A page is read twice and never grouped with
    others: only its site's elements and texts to cut, hashed, are joined to it.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    counts = _things(rows.select("url", "html"))
    rated = _trees(counts, borrow, fade).where(F.col("importance") < 1.0)
    # below ``least`` by itself, or with the mildest prior that still leaves a choice
    low = rated.where(F.col("importance") * 0.6 < least).groupBy("site").agg(F.collect_list(F.struct("path", "importance")).alias("low"))
    again = repeated_texts(counts, least_in_article).groupBy("site").agg(F.collect_list(F.struct("path", "thing")).alias("again"))
    cuts = stored(low.join(again, "site", "full"), "cuts")
    site_of = F.udf(host, "string")

    def extract(batches):
        tables: dict[str, tuple[dict, frozenset]] = {}  # of the batch's sites, made once each
        for batch in batches:
            out = []
            for url, html, row in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), range(batch.num_rows)):
                site = host(url)
                if site not in tables:
                    if len(tables) > 256:
                        tables.clear()
                    low_, again_ = batch.column("low")[row].as_py() or (), batch.column("again")[row].as_py() or ()
                    tables[site] = {x["path"]: x["importance"] for x in low_}, frozenset((x["path"], x["thing"]) for x in again_)
                ratings, repeats = tables[site]
                page, kept = _read(html), []
                for (path, text, around), prior in zip(page.blocks, page.priors()):
                    rating = 1.0 if around & _ARTICLE and prior == 1.0 else ratings.get(path, 1.0)
                    gone = not around & _HEADING and (path, _text_hash(text, site)) in repeats
                    if rating * prior >= least and not gone:
                        kept.append(text)
                out.append("\n\n".join(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    placed = rows.withColumn("site", site_of("url")).join(cuts, "site", "left").select("page_id", "url", "html", "low", "again")
    return placed.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
