"""Main text of web pages by template deduction over each host's pages.

Tokens are elements, told apart by their path from the root, and texts, told apart by path and
wording. Tokens of a host that occur equally often on the same pages form an equivalence class.
Classes on more than half of the host's pages are valid if elements are among them, which nest the class's texts and
other classes by path; together they are the host's template. Whatever text is in no class is a slot's value, and the
smallest element that holds all slots is where pages are read. Within it a text of a class goes only if its
place is the template's own: no slot's value ever stands at its path, which bears a class or id. Copied
articles and constant paragraphs thus stay, on hosts of any size.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import checked, cut, lookup_join

#: Depth of elements; deeper ones are children of the one at this depth, as in browsers, so that paths stay short.
DEPTH = 512
#: Pages that a class must be on. Hosts without a template of their own share one of all hosts.
MIN_PAGES = 3

# Elements by their part in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select article section div body html main aside nav".split())
CONTAINERS = frozenset("html body main article section div center table tbody tr td".split())
NOT_TEXT = frozenset("head nav footer aside form script style title noscript template iframe noembed noframes xmp textarea select button svg math object audio video canvas dialog menu input".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
COMMENT_WORDS = frozenset("comment comments disqus replies reply".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_P = frozenset(["p"])
#: Raw elements that say nothing and may stand within a word.
SILENT = frozenset("script style template noscript".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _label(name: str, attributes: str, in_article: bool) -> tuple[str, str]:
    """An element's name in paths, and why it may be other than content: its "name", its "class" (or id or role), or a "mark".

    Within an article words must be whole names of classes, but for comments, and are marks only: see ``page_texts``.
    """
    if not attributes.strip():
        return name, "name" if name in NOT_TEXT else ""
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    names = f"{found.get('class', '')} {found.get('id', '')}"
    label = ".".join([name, *found.get("class", "").split()])
    if found.get("id") and "." not in label:
        label += "."
    parts = set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", names).lower()))
    if name in ("html", "body", "article", "main"):
        return label, ("name" if in_article else "class") if name == "article" and parts & COMMENT_WORDS else ""
    if name in NOT_TEXT or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes) or found.get("aria-hidden") == "true":
        return label, "name"
    if in_article:
        return label, "name" if parts & COMMENT_WORDS else "mark" if NOT_TEXT_WORDS.intersection(names.lower().split()) or found.get("role", "").lower() in NOT_TEXT_ROLES else ""
    return label, "class" if parts & NOT_TEXT_WORDS or found.get("role", "").lower() in NOT_TEXT_ROLES else ""


def _marked_texts(page: str) -> Iterator[tuple[str, str | None, str, int, int]]:
    """(path, text, why, block, article): as ``page_texts``, with why it may be no content, and the number of the article around it."""
    stack: list[tuple[str, str, str, int]] = []  # name, path, why it is not content, the article it is in
    opened: dict[str, int] = {}  # how often a name is on the stack, so that it is searched only for what is there
    block, at, path, off, articles, within = 0, 0, "", "", 0, 0

    def innermost(names, stop=frozenset()) -> int | None:
        if not any(map(opened.get, names)):
            return None
        if stack[-1][0] in names:
            return len(stack) - 1
        k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in names or stack[k][0] in stop), None)
        return k if k is not None and stack[k][0] in names else None

    def close(k: int) -> None:
        while len(stack) > k:
            opened[stack.pop()[0]] -= 1

    for found in _TOKEN.finditer(page):
        if found.start() < at:
            continue
        if found.start() > at:
            yield path, page[at : found.start()], off, block, within
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        if name not in INLINE and name not in SILENT:
            block += 1
        if found[1]:
            k = innermost((name,)) if opened.get(name) and name not in ("html", "body") else None
            if k is not None:
                close(k)
        else:
            ended = _P if name in CLOSES_P else SIBLINGS.get(name)
            k = innermost(ended, SCOPES) if ended else 1 if name == "body" else None
            if k is not None:
                close(k)
            _, _, why, inside = stack[-1] if stack else ("", "", "", 0)
            above = stack[min(len(stack), DEPTH) - 1][1] if stack else ""
            label, own = _label(name, found[3], bool(inside))
            if name == "header" and not inside:
                own = "name"
            if name in ("article", "main") and not own:
                why = "" if why == "class" else why
                if not inside:
                    articles += 1
                    inside = articles
            why = "name" if "name" in (why, own) else why or own
            path, off, within = f"{above}/{label}", why, inside
            yield path, None, off, block, within
            if name in VOID or found[3].endswith("/") and name in ("path", "circle", "rect", "use", "g"):
                pass
            elif name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                stop = end.start() if end else len(page)
                if stop > at:
                    yield path, page[at:stop], "name", block, within
                at = end.end() if end else stop
            else:
                stack.append((name, path, why, inside))
                opened[name] = opened.get(name, 0) + 1
        _, path, off, within = stack[-1] if stack else ("", "", "", 0)
    if at < len(page):
        yield path, page[at:], off, block, within


def _in_heading(path: str) -> bool:
    return not HEADINGS.isdisjoint(x.partition(".")[0] for x in path.split("/"))


def page_texts(page: str) -> Iterator[tuple[str, str | None, bool, int]]:
    """(path, text, content, block) in page order: each element as it opens (text None) and each text.

    ``content`` is false inside what is not main text wherever it stands. Texts with equal
    ``block`` numbers are one run of inline content. A page's header is not content, an article's is; a
    class says nothing about an article or main element that stands within. Marks within an article do not hold
    where without them it would have no text but headings: then they name the article's own parts.
    """
    found = list(_marked_texts(page))
    marks = any(x[2] == "mark" for x in found)
    said = marks and {n for path, text, why, _, n in found if n and text is not None and not why and text.strip() and not _in_heading(path)}
    for path, text, why, block, n in found:
        yield path, text, not why or marks and why == "mark" and n not in said, block


def _squeezed(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


_TOKENS = "host string, token long, path string, n long, chars long, content boolean, page long"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct tokens of each page with their counts; elements carry their path and the length of their own texts."""
    for batch in batches:
        rows: list[tuple] = []
        for number, url, page in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["html"].to_pylist(), strict=True):
            host, own = host_of(url), _hash(f"{number} {url} {page}")
            elements: dict[str, list] = {}
            texts: dict[tuple[str, str], list] = {}
            for path, text, content, _ in page_texts(page or ""):
                if text is None:
                    elements.setdefault(path, [0, content])[0] += 1
                elif said := _squeezed(text):
                    texts.setdefault((path, said), [0, content])[0] += 1
            if elements or texts:
                rows.append((host, _hash(""), "", 1, 0, False, own))  # the page itself, so that those with tokens are counted
            rows += [(host, _hash(p), p, n, 0, c, own) for p, (n, c) in elements.items()]
            rows += [(host, _hash(f"{p}\n{t}"), p, n, len(t) * n, c, own) for (p, t), (n, c) in texts.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "token", "path", "n", "chars", "content", "page"])


def _once(pages: DataFrame) -> DataFrame:
    """Each distinct row once. Only rows that repeat are shuffled as a whole, by hash aggregation, which sums up copies first."""
    keyed = pages.withColumns({"__a": F.xxhash64("page_id", "url", "html"), "__b": F.xxhash64(F.lit(1), "html", "url", "page_id")})
    often = cut(keyed.groupBy("__a", "__b").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__a", "__b"))
    if not often.limit(1).count():
        return pages
    side = checked(often)
    alone = keyed.join(side, ["__a", "__b"], "left_anti").select(*pages.columns)
    return alone.unionByName(keyed.join(side, ["__a", "__b"], "left_semi").select(*pages.columns).distinct())


def deduce_templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, main, texts): a host's main element (a path) and its template texts (hashes) within it.

    A token's occurrence vector over the host's distinct pages is kept as their number and the exclusive-or of a hash
    of (page, count); both are combined before the shuffle, on (host, token), so no host's pages are ever gathered.
    Tokens with equal vectors form a class. It is valid on ``min_pages`` at least and on more than half of the host's
    pages that have tokens at all, if it holds an element; other pages, whatever is on them, do not undo it. A text is in
    the class if one of the class's elements is around it, which nests it. Texts in no class are slots. A class's
    text is template if no slot stands at its path, which has a class or id and is no heading's, and the host has slots
    elsewhere: pages that are all alike have no template that could be told from their content. ``texts`` holds fewer hashes
    than two pages have texts, since each is on more than half of the pages. The row whose host is null is the
    template over all hosts.
    """
    pooled = F.sum("chars").alias("chars"), F.bool_and("content").alias("content"), F.min("n").alias("least"), F.max("n").alias("most")
    seen = _once(pages).mapInArrow(_tokens, _TOKENS)
    # A token decides its path; with it among the keys all sums have fixed size and hash aggregation applies.
    tokens = cut(seen.groupBy("host", "token", "path").agg(F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count(F.lit(1)).alias("pages"), *pooled))
    host_pages = tokens.filter("path = ''").select("host", F.col("pages").alias("host_pages"))
    valid = F.expr("2 * pages > host_pages") & (F.col("pages") >= min_pages)
    joined = tokens.filter("path <> ''").join(host_pages, "host").withColumn("valid", valid)
    # A class's elements are fewer than those of two pages.
    classes = cut(joined.filter("valid and chars = 0").groupBy("host", "vector", "pages").agg(F.collect_set(F.concat("path", F.lit("/"))).alias("nest")))
    nested = joined.filter("valid and chars > 0 and content").join(classes, ["host", "vector", "pages"])
    nested = cut(nested.filter(F.exists("nest", lambda x: F.concat("path", F.lit("/")).startswith(x))).select("host", "token"))
    texts = cut(joined.filter("content and chars > 0").join(nested.withColumn("nested", F.lit(True)), ["host", "token"], "left").select("host", "token", "path", "chars", "nested"))
    slots = texts.filter("nested is null").groupBy("host", "path").agg(F.sum("chars").alias("chars"))
    # A slot's text counts for each element around it: its path and that path's prefixes.
    around = slots.select("host", "chars", F.explode(_prefixes("path")).alias("path")).filter(_name().isin(*CONTAINERS)).groupBy("host", "path").agg(F.sum("chars").alias("chars"))
    # The element must hold all slots of the pages with its root: what is outside is template or no content.
    totals = slots.groupBy("host", _root("path").alias("root")).agg(F.sum("chars").alias("total"))
    around = around.withColumn("root", _root("path"))
    elements = joined.filter("valid and content and chars = 0 and least = 1 and most = 1").select("host", "path").distinct()
    best = F.max_by("path", _preference(F.col("total")))
    local = around.join(elements, ["host", "path"]).join(totals, ["host", "root"]).filter("chars = total").groupBy("host").agg(best.alias("main"))
    own = texts.filter("nested").filter(F.col("path").contains(".") & ~F.col("path").rlike("/h[1-6](?:[./]|$)"))
    own = own.join(slots.select("host", "path"), ["host", "path"], "left_anti").groupBy("host").agg(F.collect_set("token").alias("texts"))
    local = local.join(own, "host", "left").select("host", "main", F.coalesce("texts", F.array().cast("array<bigint>")).alias("texts"))
    # Over all hosts: the path that holds all slot text under its root, from the sums above.
    every = around.groupBy("root", "path").agg(F.sum("chars").alias("chars")).join(totals.groupBy("root").agg(F.sum("total").alias("total")), "root")
    pool = every.filter("chars = total").agg(F.max_by("path", _preference(F.col("total"))).alias("main"))
    return local.unionByName(pool.select(F.lit(None).cast("string").alias("host"), "main", F.array().cast("array<bigint>").alias("texts")))


def _name() -> Column:
    return F.split(F.element_at(F.split("path", "/"), -1), "\\.")[0]


def _root(path: str) -> Column:
    return F.get(F.split(path, "/"), F.lit(1))


def _preference(*first: Column) -> Column:
    """An article or main element before others, the outermost of these; else the deepest container."""
    depth, named = F.size(F.split("path", "/")), _name().isin("article", "main")
    return F.struct(*first, named, F.when(named, -depth).otherwise(depth), "chars", "path")


def _prefixes(path: str) -> Column:
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.transform(parts, lambda _, i: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, i + 1), "/")))


def main_text(page: str, main: str | None, common: str | None, texts: frozenset[int]) -> str:
    """What a page's template leaves as slots inside the host's main element.

    A page without that element is read in the element common to all hosts; one without that
    too, in its articles if it has any, and else over all its content.
    """
    found = [(p, t, b) for p, t, c, b in page_texts(page) if c]
    opened = {p for p, t, _ in found if t is None}
    root = next((m for m in (main, common) if m and m in opened), "")
    roots = [root] if root else sorted(p for p in opened if p.rpartition("/")[2].partition(".")[0] in ("article", "main")) or [""]
    blocks: dict[int, list[str]] = {}
    for path, text, block in found:
        if text is not None and any(not r or path == r or path.startswith(f"{r}/") for r in roots):
            if texts and _hash(f"{path}\n{_squeezed(text)}") in texts:
                continue
            blocks.setdefault(block, []).append(text)
    return " ".join(s for s in (_squeezed("".join(x)) for x in blocks.values()) if s)


def _read(common: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = []
            for page, main, texts in zip(batch["html"].to_pylist(), batch["main"].to_pylist(), batch["texts"].to_pylist(), strict=True):
                said.append(main_text(page or "", main, common, frozenset(texts or ())))
            n = pa.array(np.array([len(s) for s in said], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(said, pa.string()), n], names=["page_id", "url", "text", "n_chars"])

    return run


def extract_main_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html).

    Null and empty pages, and pages without content, have an empty text. A null url or one without a
    host counts as the host ''. Hosts of fewer than ``min_pages`` distinct pages, and pages that lack
    their host's main element, are read by the template of all hosts. Repeated rows come back as
    often and count once for the template; other columns are left out; an empty table gives no rows. Whole pages are read.
    Templates are broadcast only up to a checked number of hosts.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    templates = cut(deduce_templates(rows, min_pages))
    common = templates.filter("host is null").select("main").first()
    # The host is the part of the url that ``host_of`` takes, as an expression, so that pages stay in the JVM until they are read.
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    joined = lookup_join(rows.withColumn("host", host), templates.filter("host is not null"), "host", F.col("page_id"))
    return joined.select("page_id", "url", "html", "main", "texts").mapInArrow(_read(common["main"] if common else None), "page_id long, url string, text string, n_chars long")
