"""Main text of pages by wrapper induction: pages of a host are aligned, and what stays equal is its template.

Each page becomes a tree of elements in which runs of equal siblings are folded (``dom``). The most frequent tree of a host is
its reference; simple tree matching aligns every other tree with it, so nodes of all pages fall into slots. Spark counts, over all
distinct pages of a host, the blocks of text in each slot. Blocks that nearly all pages share in a slot are template, slots that
are mostly links are menus; slots of navigation, headers, footers, asides, forms, adverts, notices and comments, told by
element, class, id and role, are no content either. What varies in the other slots is the text of the page: inside
``article`` or ``main`` where a page has one. Trees, statistics and wrappers are tables; a page meets the wrapper of its host by a
join. A wrapper has slots of at least a twentieth of the host's pages, so its size follows that of a page, not of the host.

Defined cases: null html is empty, a page without content has the empty text; a null url or one without a host takes part
in no wrapper; exact copies count as one page; repeated rows come out as often as they come in; elements nested deeper than ``dom.MAX_DEPTH``
share a slot with those above. No rows give no rows. Columns other than ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm import dom
from palaver.llm.tables import maybe_broadcast, written

#: A text is template if this share of the pages that have its slot have it, in percent; fewer distinct pages tell nothing.
CONSTANT_PERCENT, LEAST_PAGES = 90, 5
#: Slots of a wrapper are on at least one of so many pages of the host.
RARE_SLOT = 20

# Elements, and words of class, id and role, that are no article text.
NEVER = frozenset("#comment head script style title noscript template iframe object svg math canvas audio video nav footer aside menu button select datalist dialog search".split())
MAYBE = frozenset(["form", "label", "fieldset"])
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted banner nav navbar navigation menu breadcrumb breadcrumbs"
    " header masthead footer sidebar cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe"
    " subscription comment comments respond reply replies disqus share sharing social related recommended widget toolbar pagination pager"
    " login signin signup search hidden contentinfo complementary dialog".split()
)
PIECES = "page_id long, url string, host string, digest long, skeleton string, nodes array<int>, blocks array<int>, texts array<string>, links array<boolean>"


class Roles(NamedTuple):
    """By node of a shape, in preorder."""

    rejected: list[bool]
    main: list[bool]
    block: list[int]


def _names(label: str) -> set[str]:
    return {word for name in re.split(r"[.#@]", label)[1:] for word in re.split(r"[-_]+", name)}


@lru_cache(20_000)
def roles(skeleton: str) -> Roles:
    """Nodes that hold no article text by what they are, nodes of the main element, and the block around each node."""
    rejected, main, block = [], [], []
    hearts: dict[int, bool] = {}

    def has_heart(shape: dom.Shape) -> bool:
        """Whether an article or a main heading is below: what wraps it is no advert, whatever its name."""
        if id(shape) not in hearts:
            hearts[id(shape)] = any(kid.label.split(".")[0] in ("article", "main", "h1") or has_heart(kid) for kid in shape.kids)
        return hearts[id(shape)]

    def walk(shape: dom.Shape, no: bool, inside: bool, around: int) -> None:
        tag = re.split(r"[.#@]", shape.label)[0]
        names = _names(shape.label)
        at = len(rejected)
        if tag in NEVER or (tag == "header" and not inside):
            no = True
        elif (tag in MAYBE or names & NAMES) and tag not in ("html", "body", "#", "main", "h1") and not (tag == "article" and not names & {"comment", "comments", "reply"}):
            no = no or not has_heart(shape)
        inside = inside or (not no and (tag in ("article", "main") or "main" in {m[1:] for m in re.findall("@[^.#@]+", shape.label)}))
        around = at if tag in dom.BLOCKS else around
        rejected.append(no)
        main.append(inside and not no)
        block.append(around)
        for kid in shape.kids:
            walk(kid, no, inside, around)

    walk(dom.read(skeleton), False, False, 0)
    return Roles(rejected, main, block)


@lru_cache(20_000)
def slots(skeleton: str, reference: str) -> list[str]:
    """The slot of each node of a tree: the node of the reference it matches, or a name of its own below that of its parent."""
    out: list[str] = []

    def own(shape: dom.Shape, name: str) -> None:
        out.append(name)
        seen: dict[str, int] = {}
        for kid in shape.kids:
            seen[kid.label] = seen.get(kid.label, -1) + 1
            own(kid, f"{name}/{kid.label}:{seen[kid.label]}")

    def aligned(shape: dom.Shape, other: dom.Shape, at: int) -> None:
        out.append(str(at))
        places, start = [], at + 1
        for kid in other.kids:
            places.append(start)
            start += kid.size
        match = dict(dom.pairs(shape, other))
        seen: dict[str, int] = {}
        for k, kid in enumerate(shape.kids):
            if k in match:
                aligned(kid, other.kids[match[k]], places[match[k]])
            else:
                seen[kid.label] = seen.get(kid.label, -1) + 1
                own(kid, f"{at}/{kid.label}:{seen[kid.label]}")

    aligned(dom.read(skeleton), dom.read(reference), 0)
    return out


class Piece(NamedTuple):
    node: int
    block: int
    text: str
    link: bool


def by_block(page: dict) -> list[list[Piece]]:
    """The pieces of each block of a page."""
    pieces = (Piece(*piece) for piece in zip(page["nodes"], page["blocks"], page["texts"], page["links"], strict=True))
    return [list(found) for _, found in groupby(pieces, key=lambda piece: piece.block)]


def _text(pieces: list[Piece]) -> str:
    return " ".join("".join(piece.text for piece in pieces).split())


def _hash(pieces: list[Piece]) -> int:
    return int.from_bytes(hashlib.blake2b(_text(pieces).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            pages = [dom.Page(source or "") for source in part.column(4).to_pylist()]
            kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.bool_())]
            values = [[dom.wrote(p.shape) for p in pages], [p.nodes for p in pages], [p.blocks for p in pages], [p.texts for p in pages], [p.links for p in pages]]
            columns = [*part.columns[:4], *(pa.array(x, kind) for x, kind in zip(values, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", "digest", "skeleton", "nodes", "blocks", "texts", "links"])


def read_pages(pages: DataFrame) -> DataFrame:
    """Each page as its tree and its pieces of text, written."""
    url = F.lower(F.col("url").cast("string"))
    host = F.regexp_extract(url, r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.nullif(host, F.lit("")).alias("host"), F.xxhash64("html"), F.col("html").cast("string"))
    return written(narrow.mapInArrow(_read_pages, PIECES), "wrapper-pages")


def references(pages: DataFrame) -> DataFrame:
    """``host, reference``: the tree that most distinct pages of a host have."""
    counted = pages.filter("host is not null").groupBy("host", "skeleton").agg(F.count_distinct("digest").alias("n"))
    first = Window.partitionBy("host").orderBy(F.col("n").desc(), "skeleton")
    return written(counted.withColumn("rank", F.row_number().over(first)).filter("rank = 1").select("host", F.col("skeleton").alias("reference")), "wrapper-references")


def _slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page: a row without a slot, a row for each slot of its blocks with their letters and those of links, a row for each block's text."""
    for batch in batches:
        rows = []
        for page in batch.to_pylist():
            names, around = slots(page["skeleton"], page["reference"]), roles(page["skeleton"]).block
            sizes: dict[str, list[int]] = {}
            texts = set()
            for pieces in by_block(page):
                slot = names[around[pieces[0].node]]
                size = sizes.setdefault(slot, [0, 0])
                size[0] += sum(len(piece.text) for piece in pieces)
                size[1] += sum(len(piece.text) for piece in pieces if piece.link)
                texts.add((slot, _hash(pieces)))
            key = page["host"], page["digest"]
            rows.append((*key, "", None, 0, 0))
            rows += [(*key, slot, None, *size) for slot, size in sizes.items()]
            rows += [(*key, slot, text, 0, 0) for slot, text in texts]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], ["host", "digest", "slot", "text", "chars", "linked"])


def induce(pages: DataFrame, known: DataFrame) -> DataFrame:
    """``host, constants, menus``: template texts by slot, and slots of links, of hosts that have any."""
    rows = pages.join(maybe_broadcast(known), "host").mapInArrow(_slot_rows, "host string, digest long, slot string, text long, chars long, linked long")
    counted = rows.groupBy("host", "slot", "text").agg(F.count_distinct("digest").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    counted = written(counted.filter(F.col("n") >= LEAST_PAGES), "wrapper-counts")
    hosts = counted.filter("slot = ''").select("host", F.col("n").alias("host_pages"))
    found = counted.filter("slot <> ''").join(maybe_broadcast(hosts), "host").filter(F.col("n") * RARE_SLOT >= F.col("host_pages"))
    owners = Window.partitionBy("host", "slot")
    marked = found.withColumn("slot_pages", F.max(F.when(F.col("text").isNull(), F.col("n"))).over(owners))
    constants = marked.filter(F.col("text").isNotNull() & (F.col("n") * 100 >= F.col("slot_pages") * CONSTANT_PERCENT))
    menus = found.filter(F.col("text").isNull() & (F.col("chars") > 0) & (F.col("linked") * 2 >= F.col("chars")))
    listed = constants.select("host", F.struct("slot", "text").alias("constant"), F.lit(None).cast("string").alias("menu"))
    listed = listed.unionByName(menus.select("host", F.lit(None).cast("struct<slot:string,text:bigint>").alias("constant"), F.col("slot").alias("menu")))
    return written(listed.groupBy("host").agg(F.collect_list("constant").alias("constants"), F.collect_list("menu").alias("menus")), "wrapper-tables")


def content(page: dict) -> str:
    """The text of a page in the content slots of its host's wrapper."""
    by, names = roles(page["skeleton"]), slots(page["skeleton"], page["reference"] or page["skeleton"])
    constants = {(c["slot"], c["text"]) for c in page["constants"] or ()}
    menus = set(page["menus"] or ())
    blocks = by_block(page)
    in_main = any(by.main[piece.node] for pieces in blocks for piece in pieces)
    lines = []
    for pieces in blocks:
        slot = names[by.block[pieces[0].node]]
        if constants and (slot, _hash(pieces)) in constants or not in_main and slot in menus:
            continue
        lines.append(_text([piece for piece in pieces if (by.main[piece.node] if in_main else not by.rejected[piece.node])]))
    return "\n".join(line for line in lines if line)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [content(page) for page in batch.to_pylist()]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    parsed = read_pages(pages)
    known = references(parsed)
    wrappers = known.join(induce(parsed, known), "host", "left")
    wrapped = parsed.join(maybe_broadcast(wrappers), "host", "left")
    return wrapped.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
