"""Main text of web pages, boilerplate found with the suffix array of each host."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from html import unescape
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.plans import scratch_folder

# Names of elements and of what their classes, ids and roles say.
_RAW = "script style noscript template textarea title iframe svg select button canvas".split()
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol"
    " p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CHROME = set("nav footer aside form dialog menu head".split())
_CONTENT = {"article", "main"}
_HINTS = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent"
    " cookie cookies footer login menu modal nav navbar navigation newsletter notice notices pager"
    " pagination popup promo related replies reply share sidebar signup social sponsor sponsored"
    " subscribe toolbar widget complementary contentinfo search alert alertdialog".split()
)
_READERS = {"comment", "comments", "reply", "replies"}
_HOLDERS = set(
    "area bar block body box buttons container content form inner item items left links list outer"
    " panel posts right section slot text title unit wrap wrapper".split()
)
_DENIALS = set("has hide is no not show with without".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(_RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[/!?a-zA-Z][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_WORDS = re.compile(r"[a-z]+")
_HUMPS = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"

# Pages and characters of which a task sorts the suffixes; a host beyond either is dealt to several lots.
GROUP_PAGES, _GROUP_CHARS = 16_384, 16_000_000
_CHROME_BIT, _CONTENT_BIT = 1, 2
_RESULT = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@dataclass
class Block:
    """Text between two block borders, and where it stands."""

    words: list[str]
    chrome: bool
    content: bool


@dataclass
class _Open:
    name: str
    chrome: bool
    content: bool
    hinted: bool = False


def _hint(token: str) -> str | None:
    """What a class, id or role names its element as: its last word that is no mere holder.

    ``cookie-notice`` is a notice, ``relatedPosts`` related; ``social-history`` is a history, and
    ``has-sidebar`` or ``no-comments`` tell of other elements.
    """
    words = _WORDS.findall(_HUMPS.sub("-", token).lower())
    if not words or words[0] in _DENIALS:
        return None
    while len(words) > 1 and words[-1] in _HOLDERS:
        words.pop()
    return words[-1] if words[-1] in _HINTS else None


def _hints(more: str) -> set[str]:
    """The hints in class, id and role among the attributes ``more``."""
    said = set()
    for name, *values in _ATTRIBUTE.findall(more):
        if name.lower() in ("class", "id", "role"):
            said.update(_hint(token) for token in "".join(values).split())
    return said - {None}


def _open(name: str, more: str, inside: _Open) -> _Open:
    """An element within ``inside``.

    Menus, footers and the like are boilerplate with all they hold, and so is what hints name inside
    an article. Outside, a hint may belong to the wrapper of the whole article.
    """
    content = inside.content or name in _CONTENT
    if inside.chrome or name in _CHROME or name == "header" and not inside.content:
        return _Open(name, True, content, inside.hinted)
    hints = _hints(more) if more and name not in ("html", "body") else set()
    if name in _CONTENT:
        hints &= _READERS
    named = bool(hints & _READERS if not inside.content else hints)
    return _Open(name, named, content, inside.hinted or bool(hints))


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order, without markup, comments, scripts and styles."""
    found: list[tuple[Block, bool]] = []
    stack = [_Open("", False, False)]
    parts: list[str] = []

    def flush() -> None:
        words = unescape("".join(parts)).split()
        parts.clear()
        if words:
            found.append((Block(words, stack[-1].chrome, stack[-1].content), stack[-1].hinted))

    at = 0
    for mark in _MARKUP.finditer(html):
        if mark.start() > at:
            parts.append(html[at : mark.start()])
        at = mark.end()
        name = mark["name"]
        if name is None:
            if mark["raw"] and mark["raw"].lower() in ("title", "select", "button", "textarea"):
                parts.append(" ")
            continue
        name = name.lower()
        block = name in _BLOCK
        if name == "br":
            parts.append(" ")
        if block:
            flush()
        if mark["close"]:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if place:
                del stack[place:]
        elif name not in _VOID and not mark["more"].endswith("/"):
            if block:
                _close_implied(stack, name)
            stack.append(_open(name, mark["more"], stack[-1]))
    parts.append(html[at:])
    flush()
    return _settled(found)


def _settled(found: list[tuple[Block, bool]]) -> list[Block]:
    """Blocks that stand in a hinted element are boilerplate, unless it holds the page's only article."""
    clear = any(block.content and not block.chrome and not hinted for block, hinted in found)
    for block, hinted in found:
        block.chrome |= hinted and (clear or not block.content)
    return [block for block, _ in found]


def _close_implied(stack: list[_Open], name: str) -> None:
    """A paragraph ends at the next block; list items, rows and cells at the next of their kind."""
    kinds = {
        "li": ({"li"}, {"ul", "ol", "menu"}),
        "dt": ({"dt", "dd"}, {"dl"}),
        "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}),
        "body": ({"head"}, set()),
    }
    ends, limits = kinds.get(name, (set(), set()))
    for i in range(len(stack) - 1, 0, -1):
        here = stack[i].name
        if here in ends or here == "p":
            del stack[i:]
            return
        if here in limits or here in _BLOCK and not ends:
            return


def suffix_array(streams: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes by their first ``depth`` tokens, where each rank begins, and their streams.

    ``depth`` is a power of two. The suffixes of all streams, one after the other and each closed by an end of
    its own, are ranked by their first tokens, twice as many each round.
    """
    sizes = [len(s) for s in streams]
    total = sum(sizes) + len(streams)
    rank = np.empty(total, dtype=np.int64)
    page = np.repeat(np.arange(len(streams)), [n + 1 for n in sizes])
    at = 0
    for number, stream in enumerate(streams):
        rank[at : at + len(stream)] = stream + len(streams)
        rank[at + len(stream)] = number  # an end that no other page has
        at += len(stream) + 1
    length = 1
    while length < depth:
        later = np.full(total, -1, dtype=np.int64)
        later[: max(0, total - length)] = rank[length:]
        _, rank = np.unique(rank * (total + len(streams) + rank.max() + 2) + later, return_inverse=True)
        length *= 2
    suffixes = np.argsort(rank, kind="stable")
    return suffixes, np.flatnonzero(np.diff(rank[suffixes], prepend=-1)), page[suffixes]


def covered(
    streams: list[np.ndarray], depth: int, elsewhere: Callable[[np.ndarray], np.ndarray] | None = None
) -> list[np.ndarray]:
    """Which tokens of each page lie in a run of ``depth`` tokens that another page has too.

    Suffixes of equal rank share ``depth`` tokens, and of a rank found in two pages every suffix
    starts such a run. ``elsewhere`` tells of which ranks, given by a suffix of each, other lots have runs.
    """
    suffixes, heads, pages = suffix_array(streams, depth)
    total = len(suffixes)
    several = np.minimum.reduceat(pages, heads) != np.maximum.reduceat(pages, heads)
    if elsewhere is not None:
        several |= elsewhere(suffixes[heads])
    starts = suffixes[np.repeat(several, np.diff([*heads, total]))]
    edges = np.zeros(total + depth + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + depth, -1)
    inside = np.cumsum(edges)[:total] > 0
    cuts = np.cumsum([len(s) + 1 for s in streams])[:-1]
    return [run[:-1] for run in np.split(inside, cuts)]


def _stays(sizes: np.ndarray, common: np.ndarray, kinds: np.ndarray, share: float) -> np.ndarray:
    """Which blocks of a page are its main text; ``common`` of their words are on other pages too."""
    plain = kinds & _CHROME_BIT == 0
    inside = plain & (kinds & _CONTENT_BIT > 0)
    own = common < share * sizes
    outside = plain & ~inside & own
    article = inside.any() and ((inside & own).any() or sizes[outside].sum() <= sizes[inside].sum())
    return inside if article else outside


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class _Lot:
    """Pages of a host: their blocks as lines, their words as numbers."""

    def __init__(self, rows: pa.Table, depth: int):
        self._depth = depth
        lines = pc.split_pattern(rows.column("body").combine_chunks().cast(pa.large_string()), "\n")
        self._lines = lines.flatten()
        words = pc.split_pattern(self._lines, " ")
        encoded = words.flatten().dictionary_encode()
        self._dictionary, codes = encoded.dictionary, np.asarray(encoded.indices).astype(np.int64)
        self._pages, self._blocks = (np.asarray(x.offsets, dtype=np.int64) for x in (lines, words))
        self._kinds = np.frombuffer(b"".join(rows.column("kinds").to_pylist()), np.uint8)
        self._streams: list[np.ndarray] = []
        self._stream_of: list[int] = []
        distinct: dict[bytes, int] = {}
        bounds = self._blocks[self._pages]
        for low, high in zip(bounds, bounds[1:]):
            key = codes[low:high].tobytes()
            if key not in distinct:
                distinct[key] = len(self._streams)
                self._streams.append(codes[low:high])
            self._stream_of.append(distinct[key])

    def _names(self) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit name of the words from each place on, and whether they are within a page."""
        digests = [_digest(word) for word in self._dictionary.to_pylist()]
        digests = np.array([*digests, 0], dtype=np.uint64)
        sizes = np.array([len(s) + 1 for s in self._streams])
        words = digests[np.concatenate([x for s in self._streams for x in (s, [-1])]).astype(np.int64)]
        ends = np.repeat(np.cumsum(sizes), sizes)
        within = np.arange(len(words)) + self._depth < ends
        words = np.append(words, np.zeros(self._depth, dtype=np.uint64))
        name = np.zeros(len(within), dtype=np.uint64)
        for k in range(self._depth):
            name = (name ^ words[k : k + len(name)]) * np.uint64(0x9E3779B97F4A7C15)
            name ^= name >> np.uint64(29)
        return name, within

    def runs(self) -> np.ndarray:
        """Names of all distinct runs, in order."""
        name, within = self._names()
        suffixes, heads, _ = suffix_array(self._streams, self._depth)
        first = suffixes[heads]
        return np.unique(name[first[within[first]]])

    def texts(self, share: float, repeated: np.ndarray | None = None) -> list[str]:
        """The main text of each page; ``repeated`` runs are also those of other lots."""
        elsewhere = None
        if repeated is not None and len(repeated):
            name, within = self._names()
            elsewhere = lambda first: within[first] & np.isin(name[first], repeated)
        if len(self._streams) > 1 or elsewhere:
            inside = covered(self._streams, self._depth, elsewhere)
        else:
            inside = [np.zeros(len(s), dtype=bool) for s in self._streams]
        lines, texts = self._lines.to_pylist(), []
        for low, high, stream in zip(self._pages, self._pages[1:], self._stream_of):
            ends = self._blocks[low : high + 1] - self._blocks[low]
            common = np.diff(np.concatenate(([0], np.cumsum(inside[stream])))[ends])
            stays = _stays(np.diff(ends), common, self._kinds[low:high], share)
            texts.append("\n".join(compress(lines[low:high], stays)))
        return texts


def _packed(names: np.ndarray) -> bytes:
    """Sorted names, compressed by place value."""
    return zstandard.compress(names.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 3)


def _unpacked(names: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(names), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _written(pages: pa.RecordBatch) -> bytes:
    """Pages of one batch and lot, compressed together."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pages.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pages)
    return sink.getvalue().to_pybytes()


def _read(rows: pa.Table) -> pa.Table:
    """The pages of a lot."""
    return pa.concat_tables(pa.ipc.open_stream(x).read_all() for x in rows.column("pages").to_pylist())


def extract_main_text(pages: DataFrame, depth: int = 8, share: float = 0.5) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``page_id, url, html``.

    Elements that class, id or role name boilerplate go (``_hint`` says which); one that holds the page's
    only article does not. Every page is compared with all pages of its host (of the url, lower case;
    null or without one: the empty host): the words of the host's distinct pages are one sequence,
    in whose suffix array runs of ``depth`` words that several pages have stand together. A block is repeated if
    ``share`` of its words lie in such runs. The main text is the article or main element, with passages that other
    pages quote too; but not one of which every block is repeated (a promotion, a teaser) on a page with more words in
    unnamed blocks of its own: then, as without an article, these are the main text.

    Hosts over ``GROUP_PAGES`` pages or 16 million characters are dealt to lots, equal pages to one. The
    suffixes of each lot are sorted alone, then the lots' runs, by names of 64 bits, are merged in
    buckets: runs of several lots are repeated in each. So results depend on no lot's size.

    White space within a block becomes one blank, blocks are joined by a line feed, references are
    decoded; nothing else is changed, and pages are never cut. A null or empty html, and a page
    without main text, give an empty text. Null and repeated ids and urls are kept. Equal pages count as
    one when runs are compared. Other columns, whatever their names, are not read.
    """
    spark, folder = pages.sparkSession, scratch_folder(pages.sparkSession)
    url = F.col("url").cast("string")
    rows = pages.select(
        F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)).alias("host"),
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    lots = F.greatest(
        F.ceil(F.count("*") / max(1, GROUP_PAGES)),
        F.ceil(F.coalesce(F.sum(F.length("html")), F.lit(0)) / _GROUP_CHARS),
    )
    sizes = rows.groupBy("host").agg(lots.cast("int").alias("lots")).filter("lots > 1")
    sizes.write.parquet(f"{folder}/hosts")
    large = spark.read.parquet(f"{folder}/hosts")  # a row for each 16 million characters at most

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, kinds, lot = [], [], []
            for html, lots in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                page = blocks(html or "") or [Block([""], True, False)]
                body = "\n".join(" ".join(block.words) for block in page)
                bodies.append(body)
                kinds.append(bytes(_CHROME_BIT * b.chrome + _CONTENT_BIT * b.content for b in page))
                lot.append(_digest(body.replace("\n", " ")) % lots if lots > 1 else 0)
            table = pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(bodies, pa.string()), pa.array(kinds, pa.binary())],
                names=["page_id", "url", "body", "kinds"],
            )
            together: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(batch.column(0).to_pylist(), lot, batch.column(4).to_pylist())):
                together.setdefault(key, []).append(i)
            columns = [*zip(*together), [_written(table.take(pa.array(at))) for at in together.values()]]
            types = (pa.string(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, types)],
                names=["host", "lot", "lots", "pages"],
            )

    def parsed(some: DataFrame) -> DataFrame:
        ordered = some.select("host", "page_id", "url", "html", "lots")
        return ordered.mapInArrow(parse, "host string, lot int, lots int, pages binary")

    def result(rows: pa.Table, texts: list[str]) -> pa.Table:
        sizes = [len(text) for text in texts]
        columns = [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())]
        return pa.table(columns, names=_RESULT.names)

    def alone(rows: pa.Table) -> pa.Table:
        rows = _read(rows)
        return result(rows, _Lot(rows, depth).texts(share))

    small = rows.join(F.broadcast(large), "host", "left_anti").withColumn("lots", F.lit(1))
    texts = parsed(small).groupBy("host", "lot").applyInArrow(alone, _RESULT)
    if large.isEmpty():
        return texts

    def name(key: tuple, rows: pa.Table) -> pa.Table:
        lots = rows.column("lots")[0].as_py()
        runs = _Lot(_read(rows), depth).runs()
        bucket = (runs % np.uint64(lots)).astype(np.int32)
        some = np.unique(bucket)
        packed = [_packed(runs[bucket == b]) for b in some]
        keys = [pa.array([k.as_py()] * len(some), kind) for k, kind in zip(key, (pa.string(), pa.int32()))]
        return pa.table([*keys, pa.array(some), pa.array(packed, pa.binary())], names=["host", "lot", "bucket", "runs"])

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        runs = [_unpacked(x) for x in rows.column("runs").to_pylist()]
        names, count = np.unique(np.concatenate(runs), return_counts=True)
        several = names[count > 1]
        found = [_packed(x[np.isin(x, several)]) for x in runs]
        host = pa.array([key[0].as_py()] * len(found), pa.string())
        return pa.table([host, rows.column("lot"), pa.array(found, pa.binary())], names=["of_host", "of_lot", "runs"])

    def beside(rows: pa.Table, runs: pa.Table) -> pa.Table:
        repeated = [_unpacked(x) for x in runs.column("runs").to_pylist()]
        rows = _read(rows)
        return result(rows, _Lot(rows, depth).texts(share, np.concatenate(repeated) if repeated else None))

    dealt = parsed(rows.join(F.broadcast(large), "host"))
    runs = dealt.groupBy("host", "lot").applyInArrow(name, "host string, lot int, bucket int, runs binary")
    repeated = runs.groupBy("host", "bucket").applyInArrow(merge, "of_host string, of_lot int, runs binary")
    of_large = dealt.groupBy("host", "lot").cogroup(repeated.groupBy("of_host", "of_lot"))
    return texts.union(of_large.applyInArrow(beside, _RESULT))
