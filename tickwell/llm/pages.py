"""Main text of web pages: what a page does not share with the nearest page of its host.

A page is cut into lines, one for each block. Pages of a host stand in the order of their
URL paths, and each is paired with the neighbour whose path agrees for longer. Pages of a host
whose lines that may stay are the same set are copies: they stand once, at the first of their
paths, so no page is paired with its copy. A near copy, with one such line more or less, is
another page. The lines of the two are aligned by a longest common subsequence, and shared lines go:
so for every page, whatever its markup.

Differencing alone keeps a menu or an advert that the neighbour does not have, and loses a
passage that both articles quote. So its result is checked by the markup: lines in menus, headers,
footers, sidebars, notices, adverts, forms, scripts and reader comments go after all, and shared
lines of an article (``article``, ``main``) come back; where a page has an article, nothing
outside it stays. Of lines of which the markup says nothing, the differencing stands. ``n_shared``,
``n_back`` and ``n_out`` say for each page how many lines the differencing took out, how many of
them the check brought back, and how many others it took out.

Class words name what an element is, or how the page around it is laid out (``sidebar-left``, ``search-page``), and
articles bear them, too (``article class="comment"``). So a word only marks an element. If all article
text of a page is under marks, the mark that holds most of it names a layout, or the article itself, and is
taken off, until some article text is free; the marks that are left then count.

* NULL or empty html gives an empty text. Broken markup is read as browsers do where that is
  simple: open elements end with their parent, an unfinished tag or comment at the end is dropped.
* NULL urls are a host of their own. A page alone on its host is compared with nothing.
* Repeated rows and NULL ids come back as they are, one row for each row; rows equal in id, url and html
  are one page where neighbours are looked for.
* Pages are ordered by ranges of (host, path, row), not host by host, so no host is too large
  for a task. Very long pages: alignment memory is bounded by dividing the longer page.
* Extra columns are left out, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.common import staged, width

ARTICLE, UNKNOWN, OTHER = 0, 1, 2

#: Names of HTML elements.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr br img".split())
_NOT_TEXT = frozenset("script style noscript template iframe object svg math canvas audio video textarea select title head".split())
_RAW = frozenset("script style textarea title iframe noscript".split())
_BESIDE = frozenset("nav aside form footer menu dialog button fieldset".split())
_MAIN = frozenset("article main".split())
_ENDS_ITSELF = {"p": "p", "li": "li", "dt": "dd", "dd": "dd", "tr": "tr", "td": "td", "th": "td", "option": "option"}
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                    "header hr main menu nav ol p pre section table ul".split())
#: Words in class, id or role that name a part beside the article.
_BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer comment comments commentlist respond disqus social share sharing related recommended widget popup modal overlay "
    "login search toolbar pagination pager skip hidden complementary contentinfo".split())
#: Elements that hold the whole page, whatever words they bear; names that say what stands inside or is missing; words
#: that make a name one of the article's own parts.
_WHOLE = frozenset("html body".split())
_OWN_WORDS = frozenset("hero lead board".split())
_LAYOUT = re.compile(r"(?<![^\s_-])(?:no|has|with|without)[-_][^\s]*", re.I)
_HEADER_WORDS = frozenset("header masthead topbar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _kind(name: str, attributes: str, inside_main: bool) -> tuple[bool, bool, bool]:
    """What an element says of its text: that it is beside the article whatever stands in it, that a word marks it
    as that, that it is an article."""
    if name in _NOT_TEXT or name in _BESIDE or (name == "header" and not inside_main):
        return True, False, False
    main, marked = name in _MAIN, False
    if attributes:
        for key, value in _NAMES.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                return True, False, False
            if key == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    return True, False, False
                continue
            if name not in _WHOLE:
                for part in _LAYOUT.sub(" ", value).split():
                    words = {w.lower() for w in _WORDS.findall(part)}
                    if not words & _OWN_WORDS:
                        marked |= bool(words & _BESIDE_WORDS or (words & _HEADER_WORDS and not inside_main))
            main |= key == "role" and value == "main"
    return False, marked, main


def _judged(found: list[tuple[bool, tuple[int, ...], bool, str]]) -> list[tuple[int, str]]:
    """Each line with OTHER, ARTICLE or UNKNOWN. Marks are taken off as long as all article text is under some."""
    inside = [(marks, len(line)) for beside, marks, main, line in found if main and not beside]
    off: set[int] = set()
    while inside and all(set(marks) - off for marks, _ in inside):
        held: dict[int, int] = {}
        for marks, size in inside:
            for k in marks:
                if k not in off:
                    held[k] = held.get(k, 0) + size
        off.add(min(held, key=lambda k: (-held[k], k)))
    return [(OTHER if beside or any(k not in off for k in marks) else ARTICLE if main else UNKNOWN, line)
            for beside, marks, main, line in found]


def lines(page: str) -> list[tuple[int, str]]:
    """The blocks of a page in order, with what the markup says of them."""
    found: list[tuple[bool, tuple[int, ...], bool, str]] = []
    #: open elements: name, whether beside the article, marks by words, whether in an article
    open_: list[tuple[str, bool, tuple[int, ...], bool]] = []
    nothing = (False, (), False)
    state = nothing
    text: list[str] = []
    numbered = 0

    def flush() -> None:
        line = " ".join(html.unescape("".join(text)).split()) if "&" in (joined := "".join(text)) else " ".join(joined.split())
        text.clear()
        if line:
            found.append((*state, line))

    def close_to(depth: int) -> None:
        nonlocal state
        del open_[depth:]
        state = open_[-1][1:] if open_ else nothing

    def last(names: tuple[str, ...], stops: frozenset[str]) -> int | None:
        for k in range(len(open_) - 1, -1, -1):
            if open_[k][0] in names:
                return k
            if open_[k][0] in stops:
                return None
        return None

    at, raw_until = 0, None
    while True:
        if raw_until is not None:
            end = re.compile(f"</{raw_until}(?=[\\s/>])", re.I).search(page, at)
            at, raw_until = (end.start() if end else len(page)), None
        m = _TOKEN.search(page, at)
        text.append(page[at:m.start()] if m else page[at:])
        if m is None:
            break
        at = m.end()
        if m.group(2) is None:
            continue
        name = m.group(2).lower()
        if m.group(1):
            if name in _INLINE:
                k = last((name,), _ENDS_P)
                if k is not None and not any(e[0] not in _INLINE for e in open_[k:]):
                    if open_[k][1:] != (open_[k - 1][1:] if k else nothing):
                        flush()
                    close_to(k)
                continue
            flush()
            k = last((name,), frozenset())
            if k is not None:
                close_to(k)
            continue
        beside, marked, main = _kind(name, m.group(3), state[2])
        if name not in _INLINE:
            flush()
            if name in _ENDS_P and (k := last(("p",), frozenset(("article", "div", "section", "td", "body", "li")))) is not None:
                close_to(k)
            if name in _ENDS_ITSELF:
                same = (name, _ENDS_ITSELF[name]) if name not in ("dd", "td") else (name, "dt" if name == "dd" else "th")
                k = last(same, frozenset(("ul", "ol", "dl", "table", "select", "article", "div", "section")))
                if k is not None:
                    close_to(k)
        elif name == "br":
            text.append(" ")
        elif beside or marked or main:
            flush()
        if name in _VOID or m.group(3).endswith("/") and name not in _RAW:
            continue
        if name == "body":
            close_to(0)
        numbered += marked
        state = (state[0] or beside, (*state[1], numbered) if marked else state[1], state[2] or main)
        open_.append((name, *state))
        if name in _RAW:
            raw_until = name
    flush()
    return _judged(found)


def _table(a: list, b: list) -> list[int]:
    """Bit rows of the alignment: bit j of row i is 0 if b[j] lengthens what a[:i] has in common."""
    where: dict = {}
    for k, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << k
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    return rows


def _prefix_lengths(a: list, b: list) -> list[int]:
    row, out = _table(a, b)[-1], [0]
    for k in range(len(b)):
        out.append(out[-1] + (not row >> k & 1))
    return out


def common(a: list, b: list, bits: int = 1 << 30) -> list[int]:
    """Positions in ``a`` of a longest common subsequence; ties go to earlier lines of ``b``."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    head, tail = list(range(start)), list(range(len(a) - end, len(a)))
    rest_a, rest_b = a[start:len(a) - end], b[start:len(b) - end]
    known_a, known_b = set(rest_a), set(rest_b)
    at = [k for k, x in enumerate(rest_a) if x in known_b]
    x, y = [rest_a[k] for k in at], [v for v in rest_b if v in known_a]
    return head + [start + at[k] for k in _aligned(x, y, bits)] + tail


def _aligned(x: list, y: list, bits: int) -> list[int]:
    if not x or not y:
        return []
    if len(x) > 1 and len(x) * len(y) > bits:
        half = len(x) // 2
        left, right = _prefix_lengths(x[:half], y), _prefix_lengths(x[half:][::-1], y[::-1])[::-1]
        cut = max(range(len(y) + 1), key=lambda k: (left[k] + right[k], -k))
        return _aligned(x[:half], y[:cut], bits) + [half + k for k in _aligned(x[half:], y[cut:], bits)]
    rows, out, i, j = _table(x, y), [], len(x), len(y)
    length = lambda i, j: j - (rows[i] & ((1 << j) - 1)).bit_count()
    while i and j:
        if x[i - 1] == y[j - 1]:
            out.append(i - 1)
            i, j = i - 1, j - 1
        elif length(i, j - 1) >= length(i - 1, j):
            j -= 1
        else:
            i -= 1
    return out[::-1]


def _open_lines(kinds: list[int]) -> list[int]:
    """The lines that may stay: of an article, its own; else those not named as beside it."""
    article = ARTICLE in kinds
    return [k for k, kind in enumerate(kinds) if (kind == ARTICLE if article else kind != OTHER)]


def _kinds(found: list[tuple[int, str]], structure: bool) -> list[int]:
    return [k if structure else UNKNOWN for k, _ in found]


def checked(kinds: list[int], shared: set[int]) -> tuple[list[int], int, int]:
    """What is left of a page's lines after the differencing and the check of it: which of the lines that may
    stay go, how many shared lines come back, how many others go."""
    spots = _open_lines(kinds)
    gone = [n for n, k in enumerate(spots) if k in shared and kinds[k] != ARTICLE]
    back = sum(k in shared for k in spots) - len(gone)
    return gone, back, len(kinds) - len(shared) - (len(spots) - len(gone) - back)


def _keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html and a key that equal pages share."""
    source = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return source.withColumn("key", F.xxhash64("page_id", "url", "html"))


def _marks(found: list[tuple[int, str]]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(t) - 2 ** 63 for _, t in found]


def _outlines(pages: DataFrame, structure: bool) -> DataFrame:
    """key, url, a mark and a kind for each line, which is what the alignment and its check need to know of a
    page, and content, equal for pages with the same set of lines that may stay."""
    def outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [lines(p) for p in batch["html"]]
            marks, kinds = [_marks(p) for p in found], [_kinds(p, structure) for p in found]
            own = [sorted({m[k] for k in _open_lines(p)}) for p, m in zip(kinds, marks)]
            yield pd.DataFrame({"key": batch["key"], "url": batch["url"], "marks": marks, "kinds": ["".join(map(str, p)) for p in kinds],
                                "content": [xxhash.xxh3_64_intdigest(repr(x)) - 2 ** 63 for x in own]})

    return _keyed(pages).select("key", "url", "html").mapInPandas(
        outline, "key long, url string, marks array<long>, kinds string, content long")


def _parsed(pages: DataFrame, structure: bool) -> DataFrame:
    """Every page with the lines that may stay."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [lines(p) for p in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "key": batch["key"],
                                "lines": [[p[k][1] for k in _open_lines(_kinds(p, structure))] for p in found]})

    return _keyed(pages).mapInPandas(parse, "page_id long, url string, key long, lines array<string>")


def _differences(outlines: DataFrame) -> DataFrame:
    """For each key with marks, kinds and the marks of the page it is compared with (NULL: none): gone, the lines
    that go of those that may stay, and what the differencing and its check did, as counts."""
    def difference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, marks, kinds, others in zip(*(batch[c] for c in ("key", "marks", "kinds", "other_marks"))):
                shared = set(common(list(marks), list(others))) if others is not None else set()
                gone, back, out = checked(list(map(int, kinds)), shared)
                rows.append((key, gone, len(shared), back, out))
            yield pd.DataFrame(rows, columns=["key", "gone", "n_shared", "n_back", "n_out"])

    return outlines.select("key", "marks", "kinds", "other_marks").mapInPandas(
        difference, "key long, gone array<int>, n_shared long, n_back long, n_out long")


def neighbours(keys: DataFrame) -> DataFrame:
    """row, other: for (row, host, path), the row next to it in its host whose path agrees for
    longer; the one before it on ties; NULL if it is alone. Sorted by ranges: each slice looks
    at its own rows, and the ends of the slices, one row each, are looked at together."""
    spark = keys.sparkSession
    order = ["host", "path", "row"]
    dealt = staged(keys.repartitionByRange(width(spark), *order).withColumn("slice", F.spark_partition_id()), "page-order")
    one = F.struct(*order)
    ends = dealt.groupBy("slice").agg(F.min(one).alias("first"), F.max(one).alias("last"))
    slices = Window.orderBy("slice")
    ends = ends.select("slice", F.lag("last").over(slices).alias("before_slice"), F.lead("first").over(slices).alias("after_slice"))
    inside = Window.partitionBy("slice").orderBy(*order)
    near = dealt.withColumn("before", F.lag(one).over(inside)).withColumn("after", F.lead(one).over(inside)).join(
        F.broadcast(ends), "slice")  # one row for each shuffle partition
    near = near.select("row", "host", "path", F.coalesce("before", "before_slice").alias("before"),
                       F.coalesce("after", "after_slice").alias("after"))

    def agreeing(other: str):
        shorter = F.least(F.length("path"), F.length(f"{other}.path"))
        same = F.filter(F.sequence(shorter, F.lit(0), F.lit(-1)),
                        lambda k: F.substring(F.col("path"), F.lit(1), k) == F.substring(F.col(f"{other}.path"), F.lit(1), k))
        return F.when(F.col(f"{other}.host") == F.col("host"), same[0])

    near = near.withColumn("b", agreeing("before")).withColumn("a", agreeing("after"))
    other = F.when(F.col("b").isNotNull() & (F.col("a").isNull() | (F.col("b") >= F.col("a"))), F.col("before.row")).when(
        F.col("a").isNotNull(), F.col("after.row"))
    return near.select("row", other.alias("other"))


def main_text(pages: DataFrame, structure: bool = True) -> DataFrame:
    """page_id, url, text, n_chars, n_shared, n_back, n_out for every page; ``structure=False`` leaves all to the
    differencing."""
    # pages are parsed twice and not stored in between: their outlines are small, their lines are not
    outlines = staged(_outlines(pages, structure).dropDuplicates(["key"]), "page-outlines")
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*)?([^?#]*)", 1)
    keys = outlines.select("key", "content", host.alias("host"), path.alias("path"), "marks", "kinds")
    # copies on a host are one page here, at the first of their paths: a copy shares every line, which tells nothing
    ones = keys.groupBy("host", "content").agg(F.min(F.struct("path", "key")).alias("one")).select(
        "host", "content", F.col("one.key").alias("row"), F.col("one.path").alias("path"))
    ones = staged(ones, "page-contents")
    pairs = neighbours(ones.select("row", "host", "path"))
    others = pairs.join(outlines.select(F.col("key").alias("other"), F.col("marks").alias("other_marks")), "other")
    # the alignment needs marks only; of its result, few numbers a page meet the lines
    beside = keys.join(ones.select("row", "host", "content").join(others, "row").drop("row", "other"), ["host", "content"], "left")
    differences = staged(_differences(beside), "page-differences")

    def left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for own, gone in zip(batch["lines"], batch["gone"]):
                gone = set(gone)
                texts.append("\n\n".join(line for k, line in enumerate(own) if k not in gone))
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]} | {c: batch[c] for c in ("n_shared", "n_back", "n_out")})

    # one plan at all sizes: the differences of many pages are no table to broadcast
    return _parsed(pages, structure).join(differences.hint("merge"), "key").drop("key").mapInPandas(
        left, "page_id long, url string, text string, n_chars long, n_shared long, n_back long, n_out long")
