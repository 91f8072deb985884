"""Main text of web pages: neighbouring pages of a host are compared line by line."""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import ROWS_AT_ONCE
from commitlens.session import written

# Elements that begin and end a block of text.
_BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol option p pre"
    " section select summary table tbody td tfoot th thead title tr ul".split()
)
# Elements whose content is no text of the page, read as raw characters up to their end tag.
_RAW = frozenset("script style textarea title xmp noembed noframes plaintext template".split())
# Elements that are never part of the article.
_CHROME = frozenset("head nav header footer aside form menu dialog noscript iframe select button script style svg math object template title".split())
_MAIN = frozenset(("article", "main"))
# What an element's class, id or role says when it is a menu, notice, advert, sidebar or comments.
_CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb"
    " breadcrumbs sidebar footer header masthead cookie cookies consent notice popup modal newsletter subscribe share"
    " sharing social related recommended comment comments respond disqus reply replies login signup search skip pagination"
    " pager toolbar widget complementary contentinfo alert disclaimer".split()
)
_MAIN_WORDS = frozenset(("article", "main", "content"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An element of these ends an open one of the same kind.
_SELF_ENDING = frozenset("p li dt dd tr td th option".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>\x00]*)((?:[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_WORDS = re.compile(r"[a-z]+")
# Words that say of a shell what it has or how it stands, not what it is: has-sidebar, comments-open.
_STATE_FIRST = frozenset("has no with without is show hide hides enable enabled disable disabled".split())
_STATE_LAST = frozenset("open opened closed enabled disabled on off layout visible active template page".split())
# Parts whose own articles are other pages' or readers'.
_OTHERS = frozenset("comment comments reply replies respond responses related recommended recommendations teaser teasers".split())
_SPACE = re.compile(r"\s+")


def _hidden(attributes: str) -> bool:
    """Whether an element says that it is not shown; what stands in the values of other attributes does not count."""
    lowered = attributes.lower()
    if "hidden" not in lowered and "display" not in lowered:
        return False
    for name, value in _ATTRIBUTE.findall(lowered):
        value = value.strip("\"'")
        if (name == "hidden" and value != "false") or (name == "aria-hidden" and value.strip() == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _words_of(attributes: str) -> set[str]:
    """The words of an element's class, id and role, but those of compounds that state what a shell has."""
    found: set[str] = set()
    for pair in _NAMES.findall(attributes):
        for token in "".join(pair).lower().split():
            words = _WORDS.findall(token)
            if len(words) < 2 or not (words[0] in _STATE_FIRST or words[-1] in _STATE_LAST):
                found.update(words)
    return found


class Line(NamedTuple):
    """A block of text and what the markup says of it."""

    text: str
    chrome: bool
    main: bool
    article: bool = False


def lines(page: str) -> list[Line]:
    """The blocks of a page in order: references decoded, white space inside made one space, trimmed."""
    out: list[Line] = []
    held: list[str] = []
    # Open elements: name, and whether what stands around them is chrome, in the main part, in an article element.
    # Chrome is 2 by an element or by being hidden or others' text, and 1 by a word alone, which an article or main element outranks.
    open_: list[tuple[str, int, bool, bool]] = []
    chrome, main, article = 0, False, False

    def end_block() -> None:
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                out.append(Line(text, chrome > 0, main, article))

    at = 0
    size = len(page)
    while at < size:
        tag = _TAG.search(page, at)
        if tag is None:
            held.append(page[at:])
            break
        if tag.start() > at:
            held.append(page[at : tag.start()])
        at = tag.end()
        if tag.group(2) is None:
            continue
        name, attributes = tag.group(2).lower(), tag.group(3)
        if name in _BLOCKS:
            end_block()
        if tag.group(1):
            depth = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
            # An end tag without its element ends nothing. A block ends all that was opened in it; a
            # paragraph's or formatting's end tag does not reach out of a block opened since.
            small = name not in _BLOCKS or name in _SELF_ENDING
            if depth is not None and small and any(o[0] in _BLOCKS and o[0] not in _SELF_ENDING for o in open_[depth + 1 :]):
                depth = None
            if depth is not None:
                if open_[depth][1:] != (chrome, main, article):
                    end_block()
                _, chrome, main, article = open_[depth]
                del open_[depth:]
            continue
        if name in _VOID:
            continue
        if name in _SELF_ENDING and open_ and name in (o[0] for o in open_[-4:]):
            depth = next(i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name)
            # Not across a list, table or section in between.
            if not any(o[0] in _BLOCKS for o in open_[depth + 1 :]):
                _, chrome, main, article = open_[depth]
                del open_[depth:]
        names = _words_of(attributes)
        open_.append((name, chrome, main, article))
        inner = chrome
        if name in _CHROME or names & _CHROME_WORDS & _OTHERS or _hidden(attributes):
            inner = 2
        elif names & _CHROME_WORDS:
            inner = max(inner, 1)
        if name in ("article", "main") and inner == 1:
            inner = 0
        # An article's own header holds its headline.
        if name == "header" and main and not names & _CHROME_WORDS:
            inner = chrome
        whole = main or name in _MAIN or bool(names & _MAIN_WORDS)
        # A page's body or outer shell may be called anything.
        if name in ("html", "body"):
            inner, whole = chrome, main
        if (inner, whole) != (chrome, main):
            end_block()
        chrome, main, article = inner, whole, article or name == "article"
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else size
            continue
    end_block()
    return out


def common(a: list, b: list) -> list[int]:
    """Places in ``a`` of one longest common subsequence of ``a`` and ``b``.

    Equal ends are matched first. Of the rest every row of the table is one big integer, a bit per item of
    ``b``, so a row costs a few additions whatever its length; the rows are then walked back.
    """
    first, last = 0, 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    x, y = a[first : len(a) - last], b[first : len(b) - last]
    places: dict = {}
    for j, item in enumerate(y):
        places[item] = places.get(item, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows, row = [], full
    for item in x:
        rows.append(row)
        hit = row & places.get(item, 0)
        row = ((row + hit) | (row - hit)) & full
    rows.append(row)
    found = []
    i, j = len(x), len(y)
    # A zero bit marks where the length grows; item i is used where its row has a zero the row before lacks.
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            found.append(first + i - 1)
            i, j = i - 1, j - 1
    return [*range(first), *reversed(found), *range(len(a) - last, len(a))]


# Different pages a page is compared with, and how many of them must have a line before it is the site's.
_NEIGHBOURS, _SEVERAL = 4, 2


def main_text(own: list[Line], neighbours: list[list[Line]]) -> str:
    """The article: what markup does not settle is decided by the lines shared with neighbours.

    Markup settles two things: what it calls chrome goes even if no other page has it, and an article element stays whole,
    as a passage that pages share may be quoted there. Every other line is looked for in the neighbours, in the same
    order. Lines that several of them have are the site's and go, also from a part that only ``main`` or a class, id or role
    names; where there is one neighbour to ask, its word goes, but not against such a name. Beside a named part a line
    stays if several were asked and none has it at any place. Neighbours with the very lines of the page are copies of
    it, not evidence, and passed over; how much of the text a different page shares does not matter.
    """
    named = any(x.main and not x.chrome for x in own)
    if all(x.chrome or x.article for x in own):
        return "\n".join(x.text for x in own if not x.chrome)
    texts = [x.text for x in own]
    votes = [0] * len(own)
    asked, seen = 0, set()
    for other in neighbours:
        theirs = [x.text for x in other]
        if theirs == texts:
            continue
        asked += 1
        seen.update(theirs)
        for i in common(texts, theirs):
            votes[i] += 1

    def stays(i: int, x: Line) -> bool:
        if x.chrome or x.article:
            return x.article and not x.chrome
        if x.main:
            return votes[i] < _SEVERAL
        if named:
            return asked >= _SEVERAL and x.text not in seen
        return not asked or votes[i] < min(_SEVERAL, asked)

    return "\n".join(x.text for i, x in enumerate(own) if stays(i, x))


_RESULT = "page_id long, url string, text string"
# What pages are sorted by, and what is dealt out: lines as one string, whether the page is answered here or only a neighbour.
_KEY = ["host", "path", "place", "number", "digest"]
_SORTED = "host string, path string, place string, number long, digest binary"
_DEALT = f"range int, own boolean, page_id long, url string, {_SORTED}, body string"
_ARROW = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
_EDGES = f"range int, first boolean, at int, {_SORTED}"


def _pack(found: list[Line]) -> str:
    return "\n".join(str(x.chrome + 2 * x.main + 4 * x.article) + x.text for x in found)


def _unpack(body: str) -> list[Line]:
    flags = ((int(x[0]), x[1:]) for x in body.split("\n") if x)
    return [Line(text, bool(f & 1), bool(f & 2), bool(f & 4)) for f, text in flags]


def _digest(found: list[Line]) -> bytes:
    return hashlib.blake2b("\n".join(x.text for x in found).encode(), digest_size=16).digest()


def _placed(pages: DataFrame) -> DataFrame:
    """The columns read, and host, path, URL and page_id without nulls."""
    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    bare = F.regexp_replace(F.coalesce("url", F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://|[?#].*$", "")
    host, path = F.lower(F.substring_index(bare, "/", 1)), F.regexp_replace(bare, "^[^/]*", "")
    number = F.coalesce("page_id", F.lit(-(2**63)))
    return picked.select("page_id", "url", host.alias("host"), path.alias("path"), F.coalesce("url", F.lit("")).alias("place"), number.alias("number"), "html")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield list(zip(*(c.to_pylist() for c in batch.slice(at, ROWS_AT_ONCE).columns), strict=True))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sort key of every page, the digest of its lines last."""
    for rows in _pieces(batches):
        yield _batch([(*row[2:6], _digest(lines(row[6] or ""))) for row in rows], _SORTED)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one sorted range: its first and last pages of different content, as many as neighbours may be asked for."""
    side = _NEIGHBOURS // 2 + 1
    first: list[tuple] = []
    # By content, the last page of each, the latest last.
    last: dict[tuple, tuple] = {}
    for rows in _pieces(batches):
        for key in rows:
            content = (key[0], key[4])
            if len(first) < side and all((x[0], x[4]) != content for x in first):
                first.append(key)
            last.pop(content, None)
            last[content] = key
            if len(last) > side:
                del last[next(iter(last))]
    found = [(True, i, *x) for i, x in enumerate(first)] + [(False, i, *x) for i, x in enumerate(reversed(last.values()))]
    if found:
        yield _batch([(TaskContext.get().partitionId(), *x) for x in found], _EDGES)


def _halo(firsts: list[list[tuple]], lasts: list[list[tuple]]) -> dict[tuple, list[int]]:
    """Which pages are sent to which other ranges: the nearest before and after of each that differ from each other.

    One more than a side asks for, as one may be a copy of the page that asks. Ranges of copies are looked beyond.
    """
    side = _NEIGHBOURS // 2 + 1
    sent: dict[tuple, list[int]] = {}
    for edges, other, order in ((lasts, firsts, range(len(firsts))), (firsts, lasts, range(len(firsts) - 1, -1, -1))):
        near: list[tuple] = []
        for i in order:
            host = other[i][0][0]
            for key in near:
                if key[0] == host:
                    sent.setdefault(key, []).append(i)
            seen: set[tuple] = set()
            near = [x for x in edges[i] + near if (x[0], x[4]) not in seen and not seen.add((x[0], x[4]))][:side]
    return sent


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): the main text of every page, one row per row of ``pages``.

    Pages of a host are sorted by URL path, and each is compared with the nearest two before and two after it
    that differ from it and from each other, however many copies lie in between. All pages are dealt out in ranges of that order, as many as there
    are shuffle partitions, so that a host of any size spreads over many tasks; every range also gets the few pages before and after
    it, so neighbours, and with them results, do not depend on where ranges end. The order is known from one pass over
    the pages that keeps only their keys and a digest of their lines. Pages stream through a task with a handful of
    different ones in memory. A null html counts as empty and gives an empty text; pages without a URL are one host, ordered by their ids and lines;
    repeated rows give repeated rows and, being copies, no evidence against each other; an empty table gives no rows. Other
    columns are not read.
    """
    placed = _placed(pages)
    spark = pages.sparkSession
    keys = written(placed.mapInArrow(_keys, _SORTED), "keys")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.repartitionByRange(ranges, *_KEY).sortWithinPartitions(*_KEY)
    # A few rows for each range.
    edges: dict[int, tuple[list, list]] = {}
    for r in sorted(ordered.mapInArrow(_edges, _EDGES).collect(), key=lambda r: (r["range"], r["at"])):
        key = (r["host"], r["path"], r["place"], r["number"], bytes(r["digest"]))
        edges.setdefault(r["range"], ([], []))[not r["first"]].append(key)
    firsts, lasts = ([edges[i][k] for i in sorted(edges)] for k in (0, 1))
    starts, halo = [x[0] for x in firsts], _halo(firsts, lasts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _pieces(batches):
            out = []
            for page_id, url, host, path, place, number, page in rows:
                found = lines(page or "")
                key, body = (host, path, place, number, _digest(found)), _pack(found)
                at = max(0, bisect_right(starts, key) - 1)
                out.append((at, True, page_id, url, *key, body))
                out += [(i, False, page_id, url, *key, body) for i in halo.get(key, ())]
            yield _batch(out, _DEALT)

    dealt = placed.mapInArrow(deal, _DEALT).repartitionById(max(1, len(starts)), F.col("range"))
    together = dealt.sortWithinPartitions("range", *_KEY)
    return together.select("page_id", "url", "own", "range", "host", "digest", "body").mapInArrow(_stream, _RESULT)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages in order of host and path; each waits until enough different ones have followed."""
    side = _NEIGHBOURS // 2
    group = None
    # The last different contents, the latest last; one more than a side asks for, as one may be the page's own.
    last: dict[bytes, list[Line]] = {}
    # Pages that wait, by content, markup and the neighbours found so far: copies wait as one. Lines by digest, and (page_id, url) of each.
    waiting: dict[tuple, tuple[dict[bytes, list[Line]], list[tuple]]] = {}
    done: list[tuple] = []

    def settle(key: tuple) -> None:
        near, copies = waiting.pop(key)
        text = main_text(_unpack(key[1]), list(near.values()))
        done.extend((page_id, url, text) for page_id, url in copies)

    for rows in _pieces(batches):
        for page_id, url, own, part, host, digest, body in rows:
            if group != (part, host):
                for key in list(waiting):
                    settle(key)
                last, group = {}, (part, host)
            found = last.pop(digest, None)
            found = _unpack(body) if found is None else found
            for key in list(waiting):
                content, packed, before, after = key
                if digest != content and digest not in after:
                    near, copies = waiting.pop(key)
                    key = (content, packed, before, (*after, digest))
                    held = waiting.setdefault(key, (near | {digest: found}, []))
                    held[1].extend(copies)
                    if len(key[3]) == side:
                        settle(key)
            if own:
                before = tuple(last)[-side:]
                waiting.setdefault((digest, body, before, ()), ({d: last[d] for d in before}, []))[1].append((page_id, url))
            last[digest] = found
            if len(last) > side + 1:
                del last[next(iter(last))]
        if done:
            yield _batch(done, _RESULT)
            done.clear()
    for key in list(waiting):
        settle(key)
    if done:
        yield _batch(done, _RESULT)


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of ``extract_pages``."""
    return extract_pages(pages).withColumn("n_chars", F.length("text").cast("long"))
