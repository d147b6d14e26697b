"""Main text of web pages by union-free wrappers, inferred for every host.

A wrapper is a regular expression without alternatives over the token stream of a page: elements, text slots, fixed
texts, optional (`?`) and repeated (`+`, `*`) groups. Pages of a host are aligned one after the other: neighbours of the
same shape fold into a repeated group, a mismatch is resolved by the nearest next element that both sides have, what is
passed over becomes optional, and texts that differ become a slot. An element is named with those words of its class, id and role that recur on its host's pages, so a wrapper is as
large as the host's templates. Inference is two-phased: every task aligns the pages it reads, then the few different
results of a host are aligned with each other, in groups first, so a host with a third of all pages costs no task more
than others.

The main text lies in the innermost element that holds most of the text that the wrapper has in slots at the page's
paths; `article` and `main` only set its borders, or decide where the wrapper comes from too few pages. A page's text is
all text there, outside the regions that
are menus, headers, footers, sidebars, notices, adverts, forms or reader comments, and without texts of any
length that stay the same on most pages that have this element. Copies of a page count as one page.
"""

from __future__ import annotations

import hashlib
import html
import json
import math
from bisect import bisect_left
from collections.abc import Iterator, Set
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from spendwatch.llm.common import ship, slices

# Element names of HTML and words that name a region in class, id or role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg math object textarea".split())
DROPPED = RAW | set("head title nav header footer aside form button select option menu dialog canvas audio video".split())
INLINE = set("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong "
             "sub sup time tt u var".split())
MAIN = {"article", "main"}
CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                 "td": {"td", "th"}, "th": {"td", "th"}}
ENDS_PARAGRAPH = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                     "nav ol p pre section table ul".split())
REGION = set("ad ads advert advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav "
             "navbar navigation breadcrumb breadcrumbs footer header masthead toolbar cookie cookies consent notice "
             "notices alert newsletter subscribe signup share sharing social comment comments disqus replies related "
             "popup modal overlay widget pagination pager contentinfo complementary search".split())

_TOKEN = regex.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|"
                       r"([^<]+|<)", regex.S)
_MARKED = regex.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", regex.I)
_WORD = regex.compile(r"[a-z]+")
_SPACE = regex.compile(r"\s{2,}|[^\S ]")  # white space that is not one blank
_END = {name: regex.compile(rf"</{name}\s*>", regex.I) for name in RAW}
MAX_DEPTH = 60  # a wrapper does not look deeper; extraction has no such limit
_SHARE = 0.7  # an element with this share of the text that differs holds the main text

_LONG = 200  # longer texts stand in wrappers by their hash
_SALTS = 16  # words of a host are dealt over so many joins
_SALT_BYTES = 256 << 20  # pages of a host are dealt over one join for each so many bytes
_RECURS = 0.01  # a word of class, id or role is part of labels if this share of a host's pages has it
_PAGES = 16  # the pages that a text item names: those of the least hashes, the same sample for all items of a host
_FEW, _MOST = 3, 0.5  # a fixed text stands on so many pages, and on more than this share of those with its main place

Item = list  # ["#", key of the text or None, chars, hashes of pages] or [label, mark, children]


def tokens(page: str, words: Set[str] | None = None) -> Iterator[tuple[str, str, bool]]:
    """(kind, value, dropped region) of a page: kinds `open` and `close` with a label, `text`. A label is the element's
    name with those words of its class, id and role that are among `words` (None: all of them)."""
    at, size = 0, len(page)
    while at < size:
        match = _TOKEN.match(page, at)
        if match is None:  # a bracket that opens no tag
            yield "text", page[at], False
            at += 1
            continue
        at = match.end()
        name = match[2]
        if match[4] is not None:
            yield "text", match[4], False
        elif name is not None:
            name = name.lower()
            if match[1]:
                yield "close", name, False
                continue
            marks = [next(v for v in m.groups()[1:] if v is not None).lower()
                     for m in _MARKED.finditer(match[3])] if match[3] else ()
            # camelCase or dashed names are taken apart, so `site-footer` names a footer.
            parts = {w for mark in marks for w in _WORD.findall(mark)}
            named = {w for mark in marks for w in mark.replace(".", " ").split() if words is None or w in words}
            yield "open", name + "".join("." + w for w in sorted(named)), bool(name in DROPPED or parts & REGION)
            if name in RAW and not match[3].endswith("/"):
                end = _END[name].search(page, at)
                at = end.end() if end else size
                yield "close", name, False
            elif name in VOID or match[3].endswith("/") and name not in ENDS_PARAGRAPH | INLINE | MAIN:
                yield "close", name, False


def _stack_changes(stack: list[str], kind: str, name: str) -> int:
    """How many elements a tag closes, from the innermost on."""
    if kind == "close":
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] == name:
                return len(stack) - i
        return 0
    for i in range(len(stack) - 1, max(-1, len(stack) - 4), -1):
        if stack[i] in CLOSES_ITSELF.get(name, ()) or (stack[i] == "p" and name in ENDS_PARAGRAPH):
            return len(stack) - i
        if stack[i] not in INLINE and stack[i] != "p":
            break
    return 0


def walk(page: str, words: Set[str] | None = None) -> Iterator[tuple[str, tuple[str, ...], str, bool]]:
    """Texts and block borders of a page: (`text`, path, text, in a dropped region) and (`open` or `close`, path, label,
    dropped). Inline elements are no part of paths."""
    names: list[str] = []
    around: list[tuple[str, ...]] = []  # the path outside each open element
    drops: list[bool] = [False]
    here: tuple[str, ...] = ()
    for kind, value, dropped in tokens(page, words):
        if kind == "text":
            yield "text", here, value, drops[-1]
            continue
        name = value.split(".")[0]
        for _ in range(_stack_changes(names, kind, name)):
            last = names.pop()
            outside = around.pop()
            if last not in INLINE:
                here = outside
                yield "close", here, last, drops[-1]
            drops.pop()
        if kind == "open":
            names.append(name)
            around.append(here)
            drops.append(drops[-1] or dropped)
            if name not in INLINE:
                yield "open", here, value, drops[-1]
                here = (*here, value)


def page_hash(page: str) -> int:
    """Copies of a page have the same hash, so they count as one page."""
    return int.from_bytes(hashlib.blake2b(page.encode("utf-8", "surrogatepass"), digest_size=5).digest(), "big")


def _text_key(text: str) -> str:
    """A text as wrappers compare it: long ones by hash and length."""
    if len(text) <= _LONG:
        return text
    return f"\0{hashlib.blake2b(text.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}:{len(text)}"


def page_wrapper(page: str, words: Set[str] | None = None) -> list[Item]:
    """The wrapper of a single page: its tree, with neighbours of one label folded."""
    root: list[Item] = []
    stack = [root]
    text: list[str] = []
    number = page_hash(page)

    def flush() -> None:
        joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if joined:
            stack[-1].append(["#", _text_key(joined), len(joined), [number]])

    skipped = 0
    for kind, path, value, dropped in walk(page, words):
        if kind == "text":
            if not skipped and not dropped:
                text.append(value)
        elif kind == "open":
            if skipped or dropped or len(stack) > MAX_DEPTH:
                skipped += 1
                continue
            flush()
            node = [value, "", []]
            stack[-1].append(node)
            stack.append(node[2])
        elif skipped:
            skipped -= 1
        else:
            flush()
            if len(stack) > 1:
                done = stack.pop()
                done[:] = fold(done)
    flush()
    while len(stack) > 1:
        done = stack.pop()
        done[:] = fold(done)
    return fold(root)


def fold(items: list[Item]) -> list[Item]:
    """Neighbours with the same label become one repeated group."""
    out: list[Item] = []
    for item in items:
        if out and out[-1][0] == item[0]:
            out[-1] = merge(out[-1], item)
            if item[0] != "#":
                optional = out[-1][1] in "?*" and item[1] in "?*" and out[-1][1] and item[1]
                out[-1][1] = "*" if optional else "+"
        else:
            out.append(item)
    return out


def _joined_mark(a: str, b: str) -> str:
    optional, repeated = "?" in a + b or "*" in a + b, "+" in a + b or "*" in a + b
    return "*" if optional and repeated else "?" if optional else "+" if repeated else ""


def _joined_pages(a: list[int], b: list[int]) -> list[int]:
    if len(a) == _PAGES and a[-1] <= b[0]:
        return a
    return a if a == b else sorted({*a, *b})[:_PAGES]


def _page_count(pages: list[int]) -> float:
    """How many pages there are, from the least hashes: exact below `_PAGES`."""
    return len(pages) if len(pages) < _PAGES else max(_PAGES, (_PAGES - 1) * 2 ** 40 / (pages[-1] + 1))


def merge(a: Item, b: Item) -> Item:
    if a[0] == "#":
        return ["#", a[1] if a[1] == b[1] else None, a[2] + b[2], _joined_pages(a[3], b[3])]
    return [a[0], _joined_mark(a[1], b[1]), align(a[2], b[2])]


def _optional(item: Item) -> Item:
    return item if item[0] == "#" else [item[0], "*" if item[1] in ("+", "*") else "?", item[2]]


def _places(items: list[Item]) -> dict[str, list[int]]:
    places: dict[str, list[int]] = {}
    for i, item in enumerate(items):
        places.setdefault(item[0], []).append(i)
    return places


def align(a: list[Item], b: list[Item]) -> list[Item]:
    """Two sequences as one, in order: what matches is merged, what one side lacks becomes optional.

    At a mismatch either side may be passed over up to the element that the other has there. The side that passes over
    fewer elements which are not optional yet is chosen, `a` in a tie: a page whose elements a long wrapper already has
    as optional ones adds none. A step is a search in the sorted places of a label, so sequences of any length cost
    little more than their length.
    """
    if [x[0] for x in a] == [x[0] for x in b]:
        return [merge(x, y) for x, y in zip(a, b)]
    sides = []
    for items in (a, b):
        needed = list(accumulate((x[0] != "#" and x[1] not in ("?", "*") for x in items), initial=0))
        sides.append((items, _places(items), needed))

    def passed(side: int, start: int, label: str) -> tuple[float, int]:
        items, places, needed = sides[side]
        found = places.get(label, ())
        k = bisect_left(found, start)
        return (needed[found[k]] - needed[start], found[k]) if k < len(found) else (math.inf, len(items))

    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i][0] == b[j][0]:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
            continue
        cost_a, next_a = passed(0, i, b[j][0])
        cost_b, next_b = passed(1, j, a[i][0])
        if cost_a == cost_b == math.inf:  # neither side has the other's element
            next_a, next_b = i + 1, j + 1
        elif cost_a <= cost_b:
            next_b = j
        else:
            next_a = i
        out += [_optional(x) for x in (*a[i:next_a], *b[j:next_b])]
        i, j = next_a, next_b
    out += [_optional(x) for x in (*a[i:], *b[j:])]
    return fold(out)


def expression(items: list[Item]) -> str:
    """The wrapper as a readable regular expression."""
    out = []
    for item in items:
        if item[0] == "#":
            out.append("#" if item[1] is None else json.dumps(item[1], ensure_ascii=False))
        else:
            body = f"<{item[0]}>{expression(item[2])}</{item[0].split('.')[0]}>"
            out.append(f"({body}){item[1]}" if item[1] else body)
    return "".join(out)


def _is_main(label: str) -> bool:
    return label.split(".")[0] in MAIN


def main_paths(items: list[Item], page_paths: Set[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """Paths of the elements that hold the main text of a page with these paths.

    The wrapper decides: the place is the innermost element with `_SHARE` of the text that differs at the page's paths,
    as it is on the host's average page. A host may have several templates; the paths of a page say which of them counts.
    The outermost `article` and `main` elements set the borders: they replace a place inside them, a place around them
    unless it has `_SHARE` of its text outside them, and the whole page if no element has that share. Where fewer than `_FEW` pages have such paths, nothing tells the
    main text from the rest: these elements count, or, without any, all of the page."""
    named = {p for p in page_paths if p and _is_main(p[-1]) and not any(_is_main(x) for x in p[:-1])}
    seen: set[int] = set()

    def mass(level: list[Item], path: tuple[str, ...], inside: Set[tuple[str, ...]] = frozenset({()})) -> float:
        counts = path in inside
        total = 0.0
        for item in level:
            if item[0] == "#":
                if counts:
                    seen.update(item[3])
                    if item[1] is None or len(item[3]) < _FEW:
                        total += item[2] / _page_count(item[3])
            elif (own := (*path, item[0])) in page_paths:
                total += mass(item[2], own, frozenset({own}) if counts else inside)
        return total

    total, path, level = mass(items, ()), (), items
    if len(seen) < _FEW:
        return named or {()}
    while total and not (path and _is_main(path[-1])):
        inner = next((i for i in level if i[0] != "#" and (own := (*path, i[0])) in page_paths
                      and mass(i[2], own, frozenset({own})) >= _SHARE * total), None)
        if inner is None or inner[0].split(".")[0] in ENDS_PARAGRAPH - MAIN - {"div", "section", "table"}:
            break
        path, level = (*path, inner[0]), inner[2]
    if path in named:
        # Neighbours with such names, as the parts of one article, belong to it.
        return {p for p in named if p[:-1] == path[:-1]}
    inside = {p for p in named if p[:len(path)] == path}
    if inside and (not path or mass(level, path, inside) >= (1 - _SHARE) * mass(level, path, frozenset({path}))):
        return inside
    return {path}


def fixed_texts(items: list[Item], places: set[tuple[str, ...]]) -> set[tuple[tuple[str, ...], str]]:
    """(path, text) of the texts inside the places that never differ, on a few pages and most of those with a place.
    Both shares come from the pages of the least hashes, so they are exact up to `_PAGES` pages."""
    pages: list[int] = []
    never: dict[tuple[tuple[str, ...], str], list[int]] = {}

    def search(level: list[Item], path: tuple[str, ...]) -> None:
        nonlocal pages
        for item in level:
            if item[0] != "#":
                search(item[2], (*path, item[0]))
            elif any(path[:len(p)] == p for p in places):
                pages = _joined_pages(pages, item[3]) if pages else item[3]
                if item[1] is not None:
                    own = never.get((path, item[1]))
                    never[path, item[1]] = _joined_pages(own, item[3]) if own else item[3]

    search(items, ())
    sample = set(pages)
    return {text for text, own in never.items() if len(own) >= _FEW
            and len(sample.intersection(own)) > _MOST * len(sample)}


def main_text(page: str, wrapper: list[Item] | None, pages: int, words: Set[str] | None = None,
              known: dict | None = None) -> str:
    """The main text of a page under its host's wrapper, which `pages` pages have formed with these words in labels.
    `known` keeps places and fixed texts between the pages of a host."""
    # Paths are cut one element below the deepest place of a wrapper, so that deep pages stay small.
    events = [(kind, path[:MAX_DEPTH + 1], value, dropped) for kind, path, value, dropped in walk(page, words)]
    own = {(*path, value) for kind, path, value, dropped in events
           if kind == "open" and not dropped and len(path) < MAX_DEPTH}
    known = {} if known is None else known
    own = frozenset(own)
    if own not in known:
        if len(known) >= 500:  # pages of one template have few different sets of paths
            known.clear()
        found = main_paths(wrapper or [], own)
        known[own] = found, fixed_texts(wrapper, found) if wrapper and pages >= _FEW else set()
    places, fixed = known[own]
    blocks: list[str] = []
    current: list[str] = []
    at: tuple[str, ...] = ()

    def flush() -> None:
        joined = _SPACE.sub(" ", html.unescape("".join(current))).strip()
        current.clear()
        if joined and (at, _text_key(joined)) not in fixed:
            blocks.append(joined)

    for kind, path, value, dropped in events:
        if kind == "text":
            if not dropped and any(path[:len(p)] == p for p in places):
                at = path
                current.append(value)
        elif value.split(".")[0] == "br":
            if kind == "open":
                current.append(" ")
        else:
            flush()
    flush()
    return " ".join(blocks)


def _host(url: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(f"`{url}`").cast("string"), r"^[^:/?#]+://([^/?#]+)", 1), F.lit("")))


def _salted(df: DataFrame, salts: Column | None = None) -> DataFrame:
    """Every row once for each salt."""
    last = F.lit(_SALTS - 1) if salts is None else salts - 1
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), last)))


def large_hosts(rows: DataFrame) -> DataFrame:
    """(host, salts) of the hosts with more than `_SALT_BYTES` of pages: at most one row for each so many bytes of all pages,
    so this table may be broadcast (100 TB give 400,000 rows at the most, of a host's name and a number)."""
    return (rows.groupBy("host").agg(F.sum(F.octet_length("html")).alias("bytes")).where(F.col("bytes") > _SALT_BYTES)
            .select("host", F.ceil(F.col("bytes") / _SALT_BYTES).cast("int").alias("salts")))


def _for_hosts(df: DataFrame, large: DataFrame) -> DataFrame:
    """The row of each host once for each of its salts."""
    sized = df.join(F.broadcast(large), "host", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    return _salted(sized, F.col("salts")).drop("salts")


def host_words(rows: DataFrame) -> DataFrame:
    """(host, words): the words in class, id and role that recur on at least `_RECURS` of a host's pages and on two, with
    blanks between. So labels follow templates; words of one page, as its number in an id, are in no label."""
    marks = F.regexp_extract_all("html", F.lit(r"""(?i)\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(1))
    words = F.split(F.lower(F.translate(F.array_join(marks, " "), "\"'", "  ")), r"[\s.]+")
    # The empty word stands for the page itself.
    counts = (rows.select("host", F.explode(F.array_union(F.array(F.lit("")), F.coalesce(words, F.array()))).alias("word"))
              .groupBy("host", "word").agg(F.count("*").alias("n"))
              .withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(_SALTS)).cast("int")))
    totals = _salted(counts.where("word = ''").select("host", F.col("n").alias("total")))
    return (counts.where("word != '' and n > 1").join(totals, ["host", "salt"]).where(F.col("n") >= _RECURS * F.col("total"))
            .groupBy("host").agg(F.array_join(F.sort_array(F.collect_list("word")), " ").alias("words")))


def _labels(items: list[Item]) -> Iterator[str]:
    for item in items:
        if item[0] != "#":
            yield item[0]
            yield from _labels(item[2])


def _merge_rows(rows: Iterator[tuple[str, int]]) -> tuple[str, int]:
    whole, total = None, 0
    for text, n in rows:
        items = json.loads(text)
        whole = items if whole is None else align(whole, items)
        total += n
    return json.dumps(whole, ensure_ascii=False, separators=(",", ":")), total


def _rows(pages: DataFrame, id_column: str, url: str, page: str) -> DataFrame:
    """(id, url, html, host, salt) of every page: a host has one salt, a large one as many as `large_hosts` gives it."""
    rows = pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{page}`").cast("string").alias("html"), _host(url).alias("host"))
    salt = F.pmod(F.xxhash64("id", "html"), F.coalesce("salts", F.lit(1))).cast("int")
    return (rows.join(F.broadcast(large_hosts(rows)), "host", "left")
            .select("id", "url", "html", "host", salt.alias("salt")))


def infer_wrappers(rows: DataFrame, flush_chars: int = 20_000_000) -> DataFrame:
    """(host, wrapper as JSON, pages) of pages as in `_rows`: one row per host. A null html counts as empty."""
    ship(rows.sparkSession)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        known: tuple[str | None, frozenset[str]] = (None, frozenset())
        seen = 0

        def rows() -> pa.RecordBatch:
            columns = [list(held), [json.dumps(w, ensure_ascii=False, separators=(",", ":")) for w, _ in held.values()],
                       [n for _, n in held.values()]]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64()))],
                ["host", "wrapper", "pages"])

        for batch in slices(batches, "html"):
            for host, content, words in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "words"))):
                if words != known[0]:
                    known = (words, frozenset((words or "").split(" ")))
                own = page_wrapper(content or "", known[1])
                seen += len(content or "")
                held[host] = [align(held[host][0], own), held[host][1] + 1] if host in held else [own, 1]
            if seen > flush_chars:  # bounds what a task holds
                yield rows()
                seen = 0
        yield rows()

    def combine(columns: list[str]):
        def run(key: tuple, group: pa.Table) -> pa.Table:
            group = group.sort_by("wrapper")
            whole, n = _merge_rows(zip(group["wrapper"].to_pylist(), group["pages"].to_pylist()))
            return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "wrapper": pa.array([whole], pa.string()),
                             "pages": pa.array([n], pa.int64())})
        return run

    schema = "host string, wrapper string, pages long"
    # All columns go along, so the shuffle of this join is the one that `extract` reads again.
    parts = (rows.join(_for_hosts(host_words(rows), large_hosts(rows)), ["host", "salt"], "left").mapInArrow(partial, schema)
             .groupBy("host", "wrapper").agg(F.sum("pages").alias("pages")))
    some = (parts.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(16)))
            .groupBy("host", "part").applyInArrow(combine(["host", "part"]), schema))
    return some.groupBy("host").applyInArrow(combine(["host"]), schema)


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: the id column, url, text. A null or empty html gives an empty text; a null url or one without
    a host counts as host ''; repeated rows stay; other columns are ignored. Pages of any length are read whole."""
    rows = _rows(pages, id_column, url, page)
    joined = rows.join(_for_hosts(infer_wrappers(rows), large_hosts(rows)), ["host", "salt"], "left").select(
        "id", "url", "html", "wrapper", "pages")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, list | None, set[str], dict] = (None, None, set(), {})
        for batch in slices(batches, "html"):
            texts = []
            for content, wrapper, n in zip(*(batch.column(c).to_pylist() for c in ("html", "wrapper", "pages"))):
                if wrapper != last[0]:
                    items = json.loads(wrapper) if wrapper else None
                    last = (wrapper, items, {w for label in _labels(items or []) for w in label.split(".")[1:]}, {})
                texts.append(main_text(content or "", last[1], n or 0, last[2], last[3]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())],
                                             ["id", "url", "text"])

    return (joined.mapInArrow(run, f"id {kind}, url string, text string")
            .withColumnsRenamed({"id": id_column, "url": url}))
