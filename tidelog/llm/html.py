"""HTML extraction (operator 5): page structure, then differencing against the page of the nearest URL.

A page is first cut into text blocks. Elements that carry no article text (scripts, styles, navigation, forms,
asides, headers and footers of the page, and elements whose class, id or role names an advert, menu, notice,
sidebar or comment) are left out; where a page marks its article or main part, only that counts. Character
references are decoded, white space inside a block becomes one space.

Then all pages are paired: within each host, in order of URL path, each page goes with the neighbour whose path
shares the longer prefix (the earlier one of equals). The two whole pages, with what structure leaves out, are aligned
by longest common subsequence, and lines that both have are deleted as the site's template; not lines that the other
holds in a marked article, which are passages that both quote. A pair whose shared lines make up more
than COPY of the page's text may be one article at two addresses: there the next nearest page is a witness, and only lines
that it has too are deleted (none, if that were all lines: then all three are copies). In a marked article, a shared
line is deleted if both the partner and the witness leave it out (a menu, notice or advert there) and it stands in a plain
box; paragraphs, headings, items and cells of a marked article are text, also where others have the line as an advert.

Pairing sorts ids and paths only, over all hosts at once by ranges; the last and the first page of
neighbouring ranges are matched afterwards. Pages send line hashes, not text; where few pages lose lines, no text is
moved, and pages are parsed again instead of being kept.

Defined cases. Null or empty html: empty text. Null url, or a host with one page: no partner, structure
alone. Repeated rows of one page_id: each gets its own row; the id is one page for pairing. Null page_id: no
partner. Unclosed tags and elements end with the page. Empty table: no rows. Further columns are ignored.
Pages are never cut.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.scratch import Scratch

COPY = 0.5
#: Kinds of blocks: of the article (or of the body, where no article is marked), of elements left out, others beside a marked
#: article, and of boxes in a marked article that are in no element for text.
ARTICLE, LEFT, BESIDE, BOX = range(4)
BOXES = {"div", "section"}
FOR_TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "caption", "figcaption", "blockquote", "pre"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
LEFT_OUT = RAW | {"head", "nav", "footer", "aside", "form", "button", "select", "template", "svg", "math", "canvas", "object", "audio", "video", "dialog", "menu"}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
    "hr", "html", "legend", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that an opening tag of these closes, where one is open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|banner|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|sidebar|side-bar|widget|menu|nav|navbar|navigation|"
    r"breadcrumbs?|footer|masthead|topbar|comments?|commentlist|disqus|replies|respond|share|sharing|social|related|recommended|newsletter|subscribe|subscription|login|signup|search|toolbar|skip|pagination|pager|hidden)(?:$|[\s_-])",
    re.IGNORECASE,
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog"}
TAG = re.compile(r"""<!--(?P<comment>.*?)(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"'])*+)(?:>|(?P<open>["'].*\Z|\Z))|<[!?/][^>]*(?:>|\Z)""", re.DOTALL)
ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")


def _left_out(name: str, attrs: str, in_article: bool) -> bool:
    if name in LEFT_OUT or (name == "header" and not in_article):
        return True
    if not attrs.strip() or name in {"html", "body", "article", "main"}:
        return False
    for key, *values, bare in ATTR.findall(attrs):
        value, key = "".join(values), key.lower()
        if bare or (key in ("class", "id") and NAMES.search(value)) or (key == "role" and value.lower() in ROLES) or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return True
    return False


def blocks(page: str | None) -> list[str]:
    """Text blocks of a page's article (or of its whole body, where no article is marked), in page order."""
    return [text for kind, text in parsed(page)[0] if kind in (ARTICLE, BOX)]


def parsed(page: str | None) -> tuple[list[tuple[int, str]], bool]:
    """All text blocks of a page with their kinds, in page order, and whether it marks its article."""
    if not page:
        return [], False
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    left: list[str] = []  # text of elements left out
    open_: list[str] = []  # open elements of interest
    skip: list[str] = []  # open elements below one that is left out
    article = boxes = for_text = 0  # depth of article and main, of BOXES in these, of FOR_TEXT
    ever = False

    def end_block() -> None:
        text = " ".join(references.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((BOX if boxes and not for_text else ARTICLE if article else BESIDE, text))

    def end_left() -> None:
        text = " ".join(references.unescape("".join(left)).split())
        left.clear()
        if text:
            out.append((LEFT, text))

    at, lower = 0, None
    while True:
        m = TAG.search(page, at)
        (left if skip else parts).append(page[at : m.start() if m else len(page)])
        if m is None:
            break
        at = m.end()
        if not m["name"]:
            continue
        if m["open"] is not None:  # a tag that never ends takes the rest of the page with it
            break
        name, attrs = m["name"].lower(), m["attrs"] or ""
        closed_itself = name in VOID
        if m["close"]:
            if skip:
                if name in BLOCKS or name == skip[0]:
                    end_left()
                if name in skip:
                    while skip.pop() != name:
                        pass
                elif name in open_ and name in ("article", "main", "body"):  # closes what holds the element left out
                    skip.clear()
                if skip or name not in open_:
                    continue
            if name in BLOCKS:
                end_block()
            if name in open_:
                while True:
                    x = open_.pop()
                    boxes -= article > 0 and x in BOXES
                    for_text -= x in FOR_TEXT
                    article -= x in ("article", "main")
                    if x == name:
                        break
            continue
        while skip and (skip[-1] in CLOSES.get(name, ()) or (skip[-1] == "p" and name in BLOCKS)):
            skip.pop()  # its end is implied
        if left and (not skip or name in BLOCKS):
            end_left()
        if skip:
            if name in RAW:
                lower = lower or page.lower()
                end = lower.find(f"</{name}", at)
                at = len(page) if end < 0 else end
            elif name == "br":
                left.append(" ")
            if not closed_itself:
                skip.append(name)
            continue
        if name in BLOCKS:
            end_block()
        elif name == "br":
            parts.append(" ")
        if closed_itself:
            continue
        if _left_out(name, attrs, article > 0):
            if name not in BLOCKS and name not in ("span", "a", "b", "i", "em", "strong", "button", "svg", "script", "style", "noscript"):
                end_block()
            skip.append(name)
            if name in RAW:
                lower = lower or page.lower()
                end = lower.find(f"</{name}", at)
                at = len(page) if end < 0 else end
            continue
        if name in ("article", "main"):
            article += 1
            ever = True
        boxes += article > 0 and name in BOXES
        for_text += name in FOR_TEXT
        open_.append(name)
    end_left()
    end_block()
    return out if ever else [(ARTICLE if kind == BESIDE else kind, text) for kind, text in out], ever


def common(a: list, b: list) -> list[bool]:
    """For each line of a, whether it lies on a longest common subsequence with b (bit-parallel; rows of b's length in bits)."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, []
    for x in a:
        m = places.get(x, 0)
        u = v & m
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    hit = [False] * len(a)
    j = len(b)
    length = lambda i, j: 0 if i < 0 else ((~rows[i]) & ((1 << j) - 1)).bit_count()
    for i in range(len(a) - 1, -1, -1):
        if not places.get(a[i]):
            continue
        here = length(i, j)
        if here > length(i - 1, j):
            hit[i] = True
            while length(i, j - 1) == here:
                j -= 1
            j -= 1
    return hit


def shared(own: dict, other: dict) -> list[bool]:
    """Which lines of a page are another's too, by alignment of the whole pages; not those of the other's marked article, which are text."""
    text = {x for x, kind in zip(other["hashes"], other["kinds"], strict=True) if kind in (ARTICLE, BOX)} if other["marked"] else set()
    return [hit and x not in text for x, hit in zip(own["hashes"], common(own["hashes"], other["hashes"]), strict=True)]


def left_out(own: dict, other: dict) -> list[bool]:
    """Which lines of a page another shares and has in elements left out only."""
    kinds: dict[int, set[int]] = {}
    for x, kind in zip(other["hashes"], other["kinds"], strict=True):
        kinds.setdefault(x, set()).add(kind)
    return [hit and kinds[x] == {LEFT} for x, hit in zip(own["hashes"], shared(own, other), strict=True)]


def deleted(own: dict, partner: dict, witness: dict | None) -> list[int]:
    """Which of a page's article lines (counted among these) are template. Pages are dicts of fields of EXTRACTED."""
    lines = [i for i, kind in enumerate(own["kinds"]) if kind in (ARTICLE, BOX)]
    if own["marked"]:  # its elements for text stand, and boxes that not both others leave out
        hit = left_out(own, partner)
        if any(hit):
            hit = [x and y for x, y in zip(hit, left_out(own, witness), strict=True)] if witness else []
        return [k for k, i in enumerate(lines) if hit and hit[i] and own["kinds"][i] == BOX]
    hit, sizes = shared(own, partner), own["sizes"]
    if sum(sizes[i] for i in lines if hit[i]) > COPY * sum(sizes[i] for i in lines):
        hit = [x and y for x, y in zip(hit, shared(own, witness), strict=True)] if witness else [False] * len(hit)
        if all(hit[i] for i in lines):
            return []
    return [k for k, i in enumerate(lines) if hit[i]]


def _hash(line: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


EXTRACTED = "page_id long, host string, path string, marked boolean, hashes array<long>, kinds binary, sizes array<int>, sign long"


def _sign(marked: bool, kinds: bytes, hashes: list[int]) -> int:
    """Tells pages of one id apart."""
    return _hash(repr((marked, kinds, hashes)))


def _lines(page: str | None) -> tuple[list[str], bytes, list[int], bool]:
    """Lines of a page, their kinds and hashes, and whether it marks its article."""
    found, marked = parsed(page)
    lines = [x for _, x in found]
    return lines, bytes(kind for kind, _ in found), [_hash(x) for x in lines], marked


def extracted(pages: DataFrame) -> DataFrame:
    """EXTRACTED rows: host and path of the URL, hashes, kinds and sizes of all the page's lines; no text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                found = [_lines(x) for x in part.column("html").to_pylist()]
                places = [re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^?#]*)", u or "") for u in part.column("url").to_pylist()]
                hosts = [m and m[1].lower() or None for m in places]
                paths = [m and re.sub(r"(?:/|\.html?|\.php)$", "", m[2]) for m in places]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array([x[3] for x in found], pa.bool_()), pa.array([x[2] for x in found], pa.list_(pa.int64())),
                        pa.array([x[1] for x in found], pa.binary()), pa.array([[len(y) for y in x[0]] for x in found], pa.list_(pa.int32())), pa.array([_sign(x[3], x[1], x[2]) for x in found], pa.int64()),
                    ],
                    [x.split()[0] for x in EXTRACTED.split(", ")],
                )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, EXTRACTED)


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


_AROUND = ("before2", "before", "after", "after2")
NEIGHBOURS = "part int, head int, tail int, page_id long, host string, path string, " + ", ".join(f"{x} struct<page:long,path:string>" for x in _AROUND)
EDGE = 2  # pages on either side that count


def _around(rows: list[tuple | None], i: int) -> list[dict | None]:
    """What stands before2, before, after and after2 the i-th of rows (page_id, host, path); None among rows is a gap."""
    found = []
    for step in (-1, 1):
        side: list[dict | None] = []
        for j in range(1, EDGE + 1):
            at = i + step * j
            x = rows[at] if 0 <= at < len(rows) else None
            if x is None or x[1] != rows[i][1]:
                break
            side.append({"page": x[0], "path": x[2]})
        found.append(side + [None] * (EDGE - len(side)))
    return [found[0][1], found[0][0], *found[1]]


def partners(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """page_id, partner, witness: the neighbour in path order within the host whose path shares the longer prefix, and the next nearest page."""
    names = [x.split()[0] for x in NEIGHBOURS.split(", ")]
    place = pa.struct([("page", pa.int64()), ("path", pa.string())])
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string(), *[place] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, done, seen = TaskContext.get().partitionId(), [], 0, 0  # rows: those that may still be named; done: how many of them were handed on

        def ready(upto: int, final: bool) -> pa.RecordBatch:
            out = []
            for i in range(done, upto):
                head, tail = seen - len(rows) + i, len(rows) - 1 - i
                out.append((part, head if head < EDGE else None, tail if final and tail < EDGE else None, *rows[i], *_around(rows, i)))
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], k) for j, k in enumerate(kinds)], names)

        for batch in batches:
            new = list(zip(*(batch.column(c).to_pylist() for c in ("page_id", "host", "path")), strict=True))
            rows, seen = rows + new, seen + len(new)
            upto = max(done, len(rows) - EDGE)
            if upto > done:
                yield ready(upto, False)
            keep = max(0, upto - EDGE)
            rows, done = rows[keep:], upto - keep
        if rows:
            yield ready(len(rows), True)

    light = pages.where("page_id is not null and host is not null").groupBy("page_id").agg(F.min(F.struct("host", "path")).alias("x")).select("page_id", "x.host", "x.path")
    ranges = light.repartitionByRange("host", "path", "page_id").sortWithinPartitions("host", "path", "page_id")
    table = scratch.save(ranges.mapInArrow(run, NEIGHBOURS), "neighbours")
    ends = table.where("head is not null or tail is not null").orderBy("part", "host", "path", "page_id").select("part", "head", "tail", "page_id", "host", "path").collect()  # EDGE pages at both ends of each range
    order: list[tuple | None] = []
    before = None
    for x in ends:
        if before is not None and before["part"] == x["part"] and before["tail"] is None and x["head"] is None:
            order.append(None)  # others of the range stand between
        order.append((x["page_id"], x["host"], x["path"]))
        before = x
    fixes = {x[0]: _around(order, i) for i, x in enumerate(order) if x is not None}

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            partner, witness = [], []
            for page, path, *around in zip(*(batch.column(c).to_pylist() for c in ("page_id", "path", *_AROUND)), strict=True):
                b2, b, a, a2 = (x or y for x, y in zip(around, fixes.get(page, [None] * 4), strict=True))
                first = b is not None and (a is None or _prefix(path, b["path"]) >= _prefix(path, a["path"]))
                near, other, further = (b, a, b2) if first else (a, b, a2)
                other = other or further
                partner.append(near and near["page"])
                witness.append(other and other["page"])
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(partner, pa.int64()), pa.array(witness, pa.int64())], ["page_id", "partner", "witness"])

    return table.mapInArrow(choose, "page_id long, partner long, witness long").where("partner is not null")


def templates(table: DataFrame, scratch: Scratch) -> DataFrame:
    """page_id, sign, dropped: for pages of EXTRACTED rows that lose lines, which of their article lines."""
    pairs = partners(table, scratch)
    whole = table.where("page_id is not null and size(hashes) > 0")
    sent = F.struct("hashes", "kinds", "marked")
    lines = whole.groupBy(F.col("page_id").alias("of")).agg(F.min_by(sent, "sign").alias("sent"))
    theirs = pairs.join(lines, F.col("partner") == F.col("of")).select(F.col("page_id").alias("p"), F.col("sent").alias("theirs"), "witness")
    theirs = theirs.join(lines, F.col("witness") == F.col("of"), "left").select("p", "theirs", F.col("sent").alias("third"))
    asked = whole.groupBy("page_id", "sign").agg(F.first(F.struct("hashes", "kinds", "marked", "sizes")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, signs, dropped = [], [], []
            for page, sign, own, *around in zip(*(batch.column(c).to_pylist() for c in ("page_id", "sign", "own", "theirs", "third")), strict=True):
                if out := deleted(own, *around):
                    ids.append(page)
                    signs.append(sign)
                    dropped.append(out)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(signs, pa.int64()), pa.array(dropped, pa.list_(pa.int32()))], ["page_id", "sign", "dropped"])

    return asked.join(theirs, F.col("page_id") == F.col("p")).select("page_id", "sign", "own", "theirs", "third").mapInArrow(run, "page_id long, sign long, dropped array<int>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text for every row of pages."""
    scratch = Scratch(pages.sparkSession)
    table = scratch.save(extracted(pages), "lines")
    lost = scratch.save(templates(table, scratch), "templates")
    scratch.drop(table)
    scratch.release()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                signs, packed = [], []
                for lines, kinds, hashes, marked in map(_lines, part.column("html").to_pylist()):
                    signs.append(_sign(marked, kinds, hashes))
                    packed.append(press.compress("\n".join(x for x, kind in zip(lines, kinds, strict=True) if kind in (ARTICLE, BOX)).encode()))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(signs, pa.int64()), pa.array(packed, pa.binary())], ["page_id", "url", "sign", "packed"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        un = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = []
            for packed, dropped in zip(batch.column("packed").to_pylist(), batch.column("dropped").to_pylist(), strict=True):
                text, gone = un.decompress(packed).decode() if packed else "", set(dropped or ())
                texts.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone) if gone else text)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(read, "page_id long, url string, sign long, packed binary")
    found = rows.join(lost, ["page_id", "sign"], "left").select("page_id", "url", "packed", "dropped")  # few pages lose lines: then no page is moved
    return found.mapInArrow(write, "page_id long, url string, text string")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))
