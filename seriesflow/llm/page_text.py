"""Main text of web pages: markup, and a host's repeated strings by suffix arrays.

A page is read as a stream of tokens, its tags and words. The streams of a slice of pages
lie end to end in one suffix array, sorted by prefix doubling; tokens of different hosts
differ, so equal prefixes are strings that repeat within a host. What a slice finds (the
first windows of each string, with the least and the largest page that has it) is merged
over all slices by an aggregate, so a host may be of any size. A string is repeated if two
pages of different content have it; copies of a page are one page.

Blocks covered by repeated strings are boilerplate and go, unique runs stay. Markup speaks
where repetition cannot: menus, footers, forms and the like go also on hosts of one page.

The texts of ``article`` elements are streams of their own in the same arrays. Pages quote and
copy each other's articles, so a string that two pages share is still article text there; one
that most pages of the host have in their articles, of many different contents, is a notice
or an advert of the host.
"""

from __future__ import annotations

import html as markup
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from seriesflow.llm.common import mix, numbered, ranges, share, small_batches, starts_of, within
from seriesflow.sources.storage import store

WINDOW = 8  # tokens compared
NEIGHBOURS = 5  # the smallest of so many consecutive windows speaks for them
COVERED = 2 / 3  # share of its words that makes a block boilerplate
KINDS = 8  # different contents, at least, that have a notice in their articles
KNOWN = 1_000_000  # repeated windows that may be broadcast (8 bytes each)
SLICE = 4 << 20
SALTS = 16

# Elements of HTML, by what they mean for the text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main
    menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul""".split())
DROPPED = set("""applet aside audio button canvas dialog embed footer head iframe math menu nav noframes noscript
    object optgroup option search select svg template video""".split())
HEAD = set("base link meta noscript script style template title".split())
SPACE = {"br", "td", "th", "wbr"}
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
# Words in class, id and role that mark what is not the article.
LABELS = set("""ad ads adsbygoogle advert advertisement advertising adverts alert banner breadcrumb breadcrumbs
    comment comments complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus
    footer gdpr login menu menubar modal nav navbar navigation newsletter notice notices overlay pager
    pagination popup promo promotion recommended related replies reply respond search share sharing
    sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget""".split())
OUTER_LABELS = {"header", "masthead", "topbar"}  # outside articles only
MODIFIERS = {"has", "is", "js", "no", "with", "without"}  # class="with-sidebar" is no sidebar

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea|xmp|iframe|noembed|noframes)(?=[\s/>])[^>]*+(?:>.*?(?:</\1\s*+>|\Z)|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[a-z]+")
END, GAP = "\x00end", "\x00article"
INNER = "article\x00"  # before the host, for the streams of its articles


@dataclass(slots=True)
class Block:
    text: str
    place: str  # article, main or empty
    labelled: bool  # markup says that it is not the article
    links: int  # words inside links
    words: int
    first: int  # its first word in the page's tokens, or inner tokens if it is inside an article
    inside: bool


@dataclass(slots=True)
class Page:
    tokens: list[str] = field(default_factory=list)
    inner: list[str] = field(default_factory=list)  # of articles
    blocks: list[Block] = field(default_factory=list)


def _labels(attributes: str) -> tuple[bool, bool, bool, str]:
    """Whether attributes mark boilerplate, boilerplate outside articles, the main part; their names."""
    inner = outer = main = False
    names = []
    for kind, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        names.append(value)
        if (kind.lower(), value.lower()) in (("role", "main"), ("itemprop", "articleBody".lower())):
            main = True
            continue
        for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().split():
            words = _WORD.findall(name)
            if words and words[0] not in MODIFIERS:
                inner |= not LABELS.isdisjoint(words)
                outer |= not OUTER_LABELS.isdisjoint(words)
    return inner, outer, main, " ".join(names)


class Reader:
    """Reads pages into tokens and blocks; remembers what tags mean."""

    REMEMBERED, LONGEST = 20_000, 200

    def __init__(self):
        self.seen: dict[str, tuple | None] = {}

    def tag(self, piece: str):
        """(is an end, name, is a block, token, ways in which its attributes mark it); None
        for comments, scripts and the like."""
        if piece in self.seen:
            return self.seen[piece]
        _, slash, name, attributes, slash2, name2, attributes2 = _PIECE.match(piece).groups()
        name = (name or name2 or "").lower()
        found = None
        if name:
            end = bool(slash or slash2)
            *marks, names = (False, False, False, "") if end else _labels(attributes or attributes2 or "")
            token = "\x00/" + name if end else f"\x00{name} {names}" if names else "\x00" + name
            found = end, name, name in BLOCKS, token, marks
        if len(piece) <= self.LONGEST:
            if len(self.seen) >= self.REMEMBERED:
                self.seen.clear()
            self.seen[piece] = found
        return found

    def read(self, source: str) -> Page:
        page = Page()
        # (name, how it is dropped, place): 1 inside a form, 2 otherwise
        stack: list[tuple[str, int, str]] = [("", 0, "")]
        opened: defaultdict = defaultdict(int)
        pieces: list[str] = []
        linked, links, last = False, 0, 0

        def flush():
            nonlocal links
            if not pieces:
                return
            words = "".join(pieces).split()
            if words:
                _, drop, place = stack[-1]
                inside = place == "article" and not drop
                page.blocks.append(Block(" ".join(words), place, drop > 0, min(links, len(words)), len(words),
                                         len(page.inner if inside else page.tokens), inside))
                if not inside:
                    page.tokens.extend(words)
                else:
                    page.inner.extend(words)
                    if not page.tokens or page.tokens[-1] is not GAP:
                        page.tokens.append(GAP)
            pieces.clear()
            links = 0

        def mark(token):
            page.tokens.append(token)
            if stack[-1][2] == "article":
                page.inner.append(token)

        def close(names):
            while True:
                name = stack.pop()[0]
                opened[name] -= 1
                if name in names:
                    return

        for found in _PIECE.finditer(source):
            start, end = found.span()
            if start > last:
                pieces.append(markup.unescape(source[last:start]))
                if linked:
                    links += len(pieces[-1].split())
            last = end
            tag = self.tag(found.group())
            if tag is None:
                continue
            is_end, name, block, token, (inner, outer, main) = tag
            if opened["head"] > 0 and name not in HEAD and not is_end:
                close(("head",))
            if block:
                flush()
                linked = False
            elif name in SPACE:
                pieces.append(" ")
            if is_end:
                if name == "a":
                    linked = False
                elif opened[name] > 0:
                    if not block and any(drop for _, drop, _ in stack):
                        flush()  # the end of what was marked inside a block
                    close((name,))
                if block:
                    mark(token)
                continue
            if name == "a":
                linked = True
            if block:
                if opened["p"] > 0:
                    close(("p",))
                mark(token)
            if name in SIBLINGS:
                alike, around = SIBLINGS[name]
                for other, _, _ in reversed(stack):
                    if other in around:
                        break
                    if other in alike:
                        close(alike)
                        break
            if name in VOID or name in ("html", "body"):
                continue
            _, drop, place = stack[-1]
            own = 0
            if name in DROPPED or inner or (name == "header" or outer) and not place:
                own = 2
            elif name == "form":
                own = 1
            elif name == "article":
                place = "article"
            elif (name == "main" or main) and not place:
                place = "main"
            if drop == 1 and place != stack[-1][2]:
                drop = 0  # an article in a form that holds the whole page
            if block or own or opened[name] > 0 or name in SIBLINGS:
                if own and not block:
                    flush()
                stack.append((name, max(drop, own), place))
                opened[name] += 1
        if len(source) > last:
            pieces.append(markup.unescape(source[last:]))
        flush()
        return page


def main_text(page: Page, covered: np.ndarray, notices: np.ndarray | None = None) -> str:
    """Blocks of the article without the host's notices; without such an element, the main
    part's unique blocks. ``covered`` and ``notices`` mark tokens and inner tokens of the page.

    Mostly linked blocks are menus. If no unique block is left, the page is a copy and keeps
    its repeated ones; so does an article of which notices would be half or more.
    """
    def left(blocks, marks):
        return [b for b in blocks if marks[b.first:b.first + b.words].sum() < COVERED * b.words]

    free = [b for b in page.blocks if not b.labelled]
    for place in ("article", "main", ""):
        chosen = [b for b in free if b.place == place] if place else free
        if chosen:
            break
    if chosen and chosen[0].place != "article":
        plain = [b for b in chosen if 2 * b.links <= b.words]
        chosen = left(plain, covered) or plain
    elif chosen and notices is not None:
        own = left(chosen, notices)
        if 2 * sum(b.words for b in own) > sum(b.words for b in chosen):
            chosen = own
    return "\n\n".join(b.text for b in chosen)


def doubled(tokens: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` tokens from each place on; size is a power of two."""
    width, value = 1, mix(tokens)
    while width < size:
        value = mix(value[:-width] * np.uint64(0x9E3779B97F4A7C15) + value[width:])
        width *= 2
    return value


def suffix_array(tokens: np.ndarray, size: int):
    """Places sorted by the ``size`` tokens from there on, and the rank of each place."""
    _, rank = np.unique(tokens, return_inverse=True)
    width = 1
    while width < size:
        key = rank * (len(rank) + 1)
        key[:-width] += rank[width:] + 1
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty_like(order)
        rank[order] = np.append(0, np.cumsum(ordered[1:] != ordered[:-1]))
        width *= 2
    return np.argsort(rank, kind="stable"), rank


def windows_of(streams: list[list[str]], hosts: list[str]):
    """Token hashes of all streams, each followed by end tokens; place, page and hash of
    every window that begins at a token; and which of them speak for their neighbours."""
    pad = WINDOW + NEIGHBOURS - 1
    flat = [t for stream in streams for t in (*stream, *[END] * pad)]
    numbers, hashes = numbered(flat)
    lengths = np.array([len(s) for s in streams], np.int64)
    salt = np.fromiter(map(xxhash.xxh64_intdigest, hosts), np.uint64, len(hosts))
    tokens = hashes[numbers] + np.repeat(mix(salt), lengths + pad)
    value = doubled(tokens, WINDOW)
    least = value
    for i in range(1, NEIGHBOURS):
        least = np.minimum(least[:-1], value[i:i + len(least) - 1])
    inside = within(lengths)
    place = np.repeat(starts_of(lengths + pad), lengths) + inside
    # a window speaks if it is the smallest of some NEIGHBOURS consecutive ones of its page
    depth = np.full(len(value), -1)
    depth[place] = inside
    speaks = np.zeros(len(value), bool)
    for i in range(NEIGHBOURS):
        speaks[i:i + len(least)] |= (value[i:i + len(least)] == least) & (depth[i:i + len(least)] >= i)
    return tokens, place, np.repeat(np.arange(len(streams)), lengths), value[place], speaks[place]


def _sorted_windows(streams, hosts):
    """By the suffix array of the streams: window and page of each place that begins at a token,
    where each different window begins, and which of these speak."""
    tokens, place, page, value, speaks = windows_of(streams, hosts)
    if not len(place):
        return value, page, place, speaks
    order, _ = suffix_array(tokens, WINDOW)
    at = np.full(len(tokens), -1)
    at[place] = np.arange(len(place))
    order = at[order]
    order = order[order >= 0]  # the suffixes that begin at a token
    value = value[order]
    begin = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    return value, page[order], begin, np.logical_or.reduceat(speaks[order], begin)


def repeats_in(streams, hosts, contents: np.ndarray):
    """Windows of a slice that speak, with the least and largest content hash of their pages."""
    value, page, begin, speaking = _sorted_windows(streams, hosts)
    if not len(value):
        return value, contents[:0], contents[:0]
    low = np.minimum.reduceat(contents[page], begin)
    high = np.maximum.reduceat(contents[page], begin)
    return value[begin][speaking], low[speaking], high[speaking]


def spread_in(streams, hosts, contents: np.ndarray):
    """Windows of a slice that speak, with one of their pages, their number of pages and a bit
    for the content of each (of 64: the bits of several slices can be united). Windows come
    page by page."""
    value, page, begin, speaking = _sorted_windows(streams, hosts)
    if not len(value):
        return value, page, page, contents[:0]
    # equal windows are in the order of their places, so a page's are neighbours
    new = np.append(True, page[1:] != page[:-1])
    new[begin] = True
    pages = np.add.reduceat(new.astype(np.int64), begin)
    bits = np.bitwise_or.reduceat(np.left_shift(np.int64(1), contents[page] & 63), begin)
    some = np.flatnonzero(speaking)
    some = some[np.argsort(page[begin[some]], kind="stable")]
    return value[begin[some]], page[begin[some]], pages[some], bits[some]


def cover(streams, hosts, known) -> list[np.ndarray]:
    """Which tokens of each stream are in a window that speaks and is ``known`` (a function of hashes)."""
    _, _, page, value, speaks = windows_of(streams, hosts)
    hit = np.zeros(len(value), bool)
    hit[speaks] = known(value[speaks], page[speaks])
    lengths = np.array([len(s) for s in streams], np.int64)
    begins = starts_of(lengths)
    change = np.zeros(len(value) + 1, np.int64)
    first = np.flatnonzero(hit)
    np.add.at(change, first, 1)
    np.add.at(change, np.minimum(first + WINDOW, (begins + lengths)[page[first]]), -1)
    covered = np.cumsum(change[:-1]) > 0
    return [covered[a:a + n] for a, n in zip(begins, lengths)]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _page_columns(pages: DataFrame, html: str, url: str):
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host = F.regexp_extract(F.lower(address), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return [F.col(html).cast("string").cast("binary").alias("0html"), host.alias("0host")]


def _slices(batches):
    """Read pages of about SLICE bytes: pages, hosts, content hashes, first and last row of a batch."""
    reader = Reader()
    for batch in batches:
        sizes = [len(v) if v is not None else 0 for v in batch.column(0).to_pylist()]
        for a, b in ranges(sizes, SLICE):
            raw = batch.column(0).slice(a, b - a).to_pylist()
            pages = [reader.read((v or b"").decode("utf-8", "replace")) for v in raw]
            content = [xxhash.xxh64_intdigest("\n".join(x.text for x in p.blocks)) for p in pages]
            yield batch, a, b, pages, batch.column(1).slice(a, b - a).to_pylist(), np.array(content, np.uint64)


def _streams(pages: list[Page], hosts: list[str]):
    """Tokens of the pages, then those of their articles, and what keeps their strings apart."""
    return [p.tokens for p in pages] + [p.inner for p in pages], hosts + [INNER + h for h in hosts]


def repeated_windows(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Column ``window``: hashes of the windows that pages of different content on one host
    share, and of those in the articles of most of the host's pages that have articles, of
    ``KINDS`` different contents or more."""
    small_batches(pages)

    def run(batches):
        for _, _, _, read, hosts, content in _slices(batches):
            value, low, high = repeats_in([p.tokens for p in read], hosts, _signed(content))
            some = [i for i, p in enumerate(read) if p.inner]
            names = [INNER + hosts[i] for i in some]
            own = [xxhash.xxh64_intdigest("\n".join(read[i].inner)) for i in some]
            inner, page, n, bits = spread_in([read[i].inner for i in some], names, _signed(np.array(own, np.uint64)))
            salts = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
            of_host, counts = np.unique(salts, return_counts=True)
            sizes = [len(value), len(inner), len(of_host)]

            def column(*parts):
                return pa.concat_arrays([pa.nulls(size, pa.int64()) if part is None else pa.array(part, pa.int64())
                                         for part, size in zip(parts, sizes)])

            yield pa.RecordBatch.from_arrays(
                [column(None, _signed(salts[page]), _signed(of_host)), column(_signed(value), _signed(inner), None),
                 column(low, None, None), column(high, None, None), column(None, n, counts), column(None, bits, None)],
                names=["host", "window", "low", "high", "n", "bits"])

    found = pages.select(*_page_columns(pages, html, url)).mapInArrow(
        run, "host bigint, window bigint, low bigint, high bigint, n bigint, bits bigint")
    merged = found.groupBy("host", "window").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                                 F.sum("n").alias("n"), F.bit_count(F.bit_or("bits")).alias("kinds"))
    merged = store(merged.where((F.col("low") != F.col("high")) | F.col("window").isNull()
                                | (F.col("kinds") >= KINDS)), "strings")
    hosts = merged.where(F.col("window").isNull()).select("host", F.col("n").alias("pages"))
    inside = merged.where(F.col("window").isNotNull()).join(hosts, "host").where(2 * F.col("n") > F.col("pages"))
    return merged.where(F.col("host").isNull()).select("window").unionAll(inside.select("window"))


def extract(pages: DataFrame, keep: list[str], html: str = "html", url: str = "url", known: int = KNOWN) -> DataFrame:
    """Columns ``keep``, ``text`` (the main text, empty if there is none) and ``n_chars`` of every row.

    Blocks have character references decoded and white space turned into single spaces, and
    are joined by two line feeds. Null html counts as empty; pages without an address are
    of one host. Repeated rows are each returned and do not make their strings repeated.
    Columns of ``keep`` named like a new one are replaced. Up to ``known`` repeated windows
    are broadcast, beyond that pages are joined with those that they ask for; the result is
    the same.
    """
    keep = [c for c in keep if c not in ("text", "n_chars")]
    repeated = store(repeated_windows(pages, html, url), "windows")
    columns = _page_columns(pages, html, url)
    kept = [F.col(c).alias(f"{i}keep") for i, c in enumerate(keep)]
    fields = [(c, pages.schema[c].dataType.simpleString()) for c in keep]
    schema = ", ".join(f"`{c}` {t}" for c, t in [*fields, ("text", "string"), ("n_chars", "bigint")])

    def texts(batches, lookup):
        for batch, a, b, read, hosts, _ in _slices(batches):
            marks = cover(*_streams(read, hosts), lookup(batch, a, b))
            found = [main_text(p, *m) for p, *m in zip(read, marks, marks[len(read):])]
            rest = [batch.column(i + 2).slice(a, b - a) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=[*keep, "text", "n_chars"])

    if repeated.count() <= known:
        windows = np.sort(repeated.toArrow().column(0).to_numpy())
        shared = share(pages, windows)

        def run(batches):
            windows = shared()
            return texts(batches, lambda *_: lambda values, _: is_in(windows, _signed(values)))

        return pages.select(*columns, *kept).mapInArrow(run, schema)

    # Rows are told by their whole content; rows that repeat it get the same answer.
    plain = [f.name for f in pages.schema.fields if not isinstance(f.dataType, T.MapType)]
    source = pages.select(*columns, *kept, F.xxhash64(*plain).alias("row_"))

    def ask(batches):
        for batch, a, b, read, hosts, _ in _slices(batches):
            _, _, page, value, speaks = windows_of(*_streams(read, hosts))
            rows = batch.column(batch.num_columns - 1).slice(a, b - a).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(rows[page[speaks] % (b - a)]), pa.array(_signed(value[speaks]))],
                                             names=["row_", "window"])

    salt = F.pmod(F.col("row_"), F.lit(SALTS)).cast("int").alias("salt")
    asked = source.mapInArrow(ask, "row_ bigint, window bigint").distinct().select("*", salt)
    salted = repeated.select("window", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    answers = asked.join(salted, ["window", "salt"]).groupBy("row_").agg(F.collect_list("window").alias("windows_"))
    joined = source.join(answers, "row_", "left").select(
        *[c for c in source.columns if c != "row_"], F.sort_array(F.coalesce("windows_", F.array().cast("array<bigint>"))))

    def run_joined(batches):
        def lookup(batch, a, b):
            answered = batch.column(batch.num_columns - 1).slice(a, b - a)

            def known(values, page):
                hit = np.zeros(len(values), bool)
                ends = np.searchsorted(page, np.arange(2 * (b - a) + 1))
                for i, (first, last) in enumerate(zip(ends[:-1], ends[1:])):
                    if last > first:
                        hit[first:last] = is_in(answered[i % (b - a)].values.to_numpy(), _signed(values[first:last]))
                return hit

            return known

        return texts(batches, lookup)

    return joined.mapInArrow(run_joined, schema)


def is_in(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values
