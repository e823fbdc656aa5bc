"""Main-text extraction by wrapper induction.

The pages of a host are grouped by the shape of their upper containers, and each frequent
shape has a reference page. Every page is aligned with the reference of its shape (a rare
shape takes that of the host's most frequent one) by simple tree matching, and each matched
text node votes for its slot: how many different pages align there, and how many of them
hold the same text. A slot is template if nearly all pages that align there agree and they
are a large share of the different pages of the group. A varying slot is content. Texts that
match no slot (pages have more or fewer paragraphs) vary too.

What varies is not yet the article: menus and adverts change as well. Landmarks (nav, footer,
aside, form ... and class or role names that say so) are left out, and where a page has an
article or main element, only text in it is taken. A container that is left out by its name
alone stays if it holds most of the page's varying text, or the only article or main.

The votes are counted by grouping over all pages. Pages with the same texts outside landmarks
vote once, and pages without text are no reference. Every page is parsed once; its tree is stored for the
votes and for the texts. The reference pages are broadcast only if they are small; else pages are joined by host,
where the adaptive skew join splits a host that holds a third of all pages.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payerlens.llm.dom import BLOCKS, RAW, Node, Shapes, pack, parse, unpack
from payerlens.llm.tables import pick, stored

LEAST_PAGES = 10  # different pages of a host that must align with a template slot
SAME_SHARE = 0.95
GROUP_SHARE = 0.5  # of the different pages of a group that hold the text of a template slot
SHAPE_DEPTH = 3  # levels of containers below body that make a page's shape
BROADCAST_BYTES = 8 << 20
MENU_LINKS, MENU_SHARE = 3, 0.8  # a list or block of links, outside article and main

# --- fixed values: HTML landmarks and the usual names of what is not main text ---------
LEFT_OUT = frozenset(
    "nav header footer aside form button select option dialog menu svg object canvas head".split()
) | RAW
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar".split()
)
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar "
    "aside widget widgets notice notices alert cookie cookies consent gdpr popup modal overlay "
    "newsletter subscribe subscription signup login comment comments respond replies reply disqus "
    "share sharing social related recommended pagination pager hidden".split()
)
# Names that stay left out however much they hold: others' words, and what no reader sees first.
NEVER = frozenset(
    "comment comments respond replies reply disqus related recommended hidden cookie cookies consent "
    "gdpr popup modal overlay dialog alertdialog".split()
)
CONTAINERS = frozenset("div section td table tbody tr center main article span".split())
_UPPER = frozenset("div section main article table center header nav footer aside form".split())
# ----------------------------------------------------------------------------------------
_MAIN = frozenset(["article", "main"])
_WORD = re.compile(r"[a-z]+")


def _named(node: Node, names: frozenset) -> bool:
    # Whole names and their first and last words: "ad-slot", "site-footer", "comment-list".
    for name in node.names.split():
        if name in names:
            return True
        parts = _WORD.findall(name)
        if parts and (parts[0] in names or parts[-1] in names):
            return True
    return False


def _left_out(node: Node) -> bool:
    if node.tag in LEFT_OUT:
        return True
    if not node.names or node.tag in ("html", "body", "#root"):
        return False
    return _named(node, NAMES) or any(name in ROLES for name in node.names.split())


def _may_stay(node: Node) -> bool:
    """A container that only its name leaves out, which its content can overrule."""
    return node.tag in CONTAINERS and not _named(node, NEVER)


def _overruled(root: Node, template: set[int]) -> tuple[set[int], set[int]]:
    """ids of left-out containers with most of the page's varying text; ids of all that may stay."""
    order, todo, may = [], [root], []
    while todo:
        node = todo.pop()
        order.append(node)
        if node.tag and _left_out(node):
            if not _may_stay(node):
                continue
            may.append(node)
        todo.extend(node.children)
    if not may:
        return set(), set()
    held: dict[int, int] = {}
    for node in reversed(order):
        if node.tag:
            held[id(node)] = sum(held.get(id(c), 0) for c in node.children)
        elif id(node) not in template:
            held[id(node)] = len(node.text.strip())
    most = {id(node) for node in may if 2 * held.get(id(node), 0) > held[id(root)] and not _is_menu(node)}
    return most, {id(node) for node in may}


def _is_menu(node: Node) -> bool:
    """A block whose text is nearly all links."""
    links = linked = total = 0
    todo = [(node, False)]
    while todo:
        own, inside = todo.pop()
        if not own.tag:
            n = len(own.text.split())
            total += n
            linked += n if inside else 0
        links += own.tag == "a"
        todo.extend((c, inside or own.tag == "a") for c in own.children)
    return links >= MENU_LINKS and linked >= MENU_SHARE * max(total, 1)


def text_hash(text: str) -> int:
    digest = hashlib.blake2b(" ".join(text.split()).encode("utf-8", "replace"), digest_size=8)
    return int.from_bytes(digest.digest(), "little", signed=True)


def _mains(root: Node, stay: set[int]) -> list[Node]:
    mains, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag in _MAIN or (node.names and "main" in node.names.split() and node.tag == "div"):
            if id(node) in stay or not _left_out(node):
                mains.append(node)
            continue
        if node.tag and (id(node) in stay or not _left_out(node)):
            todo.extend(reversed(node.children))
    return mains


def main_text(root: Node, template: set[int]) -> str:
    """Blocks of the main text joined by newlines. ``template``: ids of text nodes to leave out."""
    most, may = _overruled(root, template)
    mains = _mains(root, most)
    if mains or not may:
        return _blocks(mains or [root], template, most, not mains)
    whole = _blocks([root], template, most, True)
    # An article below a name such as has-sidebar counts if it is not less than all else.
    inner = _mains(root, may)
    below = _blocks(inner, template, most, False) if inner else ""
    return below if below and len(below) >= len(whole) else whole


def _blocks(tops: list[Node], template: set[int], stay: set[int], menus: bool) -> str:
    blocks: list[str] = []
    current: list[str] = []

    def end_block():
        text = " ".join("".join(current).split())
        if text:
            blocks.append(text)
        current.clear()

    for top in tops:
        end_block()
        todo = [(top, False)]
        while todo:
            node, leaving = todo.pop()
            if not node.tag:
                if id(node) not in template:
                    current.append(node.text)
                continue
            if leaving:
                end_block()
                continue
            if node is not top and id(node) not in stay and _left_out(node):
                continue
            if menus and node.tag in ("ul", "ol", "div", "p", "table", "section") and _is_menu(node):
                continue
            if node.tag in BLOCKS:
                end_block()
                todo.append((node, True))
            todo.extend((c, False) for c in reversed(node.children))
    end_block()
    return "\n".join(blocks)


def shape_of(root: Node) -> int:
    """A hash of the upper containers: tags and first names, without repetitions, numbers and texts."""
    paths, todo = set(), [(root, "", 0)]
    while todo:
        node, path, depth = todo.pop()
        for child in node.children:
            if child.tag in ("html", "body"):
                todo.append((child, path, depth))
            elif child.tag in _UPPER:
                name = re.sub(r"[^a-z]+", "", child.names.split()[0]) if child.names.split() else ""
                below = f"{path}/{child.tag}.{name}"
                paths.add(below)
                if depth + 1 < SHAPE_DEPTH and child.tag not in _MAIN and not _left_out(child):
                    todo.append((child, below, depth + 1))
    return text_hash(" ".join(sorted(paths)))


def _page_hash(root: Node) -> int | None:
    """Of the texts outside landmarks; null if there is no text at all."""
    texts = [text for node in _texts(root, _left_out) if (text := node.text.strip())]
    if not texts:
        texts = [text for node in _texts(root, lambda n: n.tag in RAW) if (text := node.text.strip())]
    return text_hash("\n".join(texts)) if texts else None


class _Hosts:
    """Reference trees by host and shape, and the structures shared by all pages of a task."""

    def __init__(self):
        self.shapes, self.trees = Shapes(), {}

    def aligned(self, tree: bytes, group: tuple[str, int], reference: bytes) -> tuple[Node, dict[int, int]]:
        if self.shapes.full() or len(self.trees) > 500:
            self.__init__()
        if group not in self.trees:
            known = unpack(reference)
            self.shapes.assign(known)
            self.trees[group] = known
        root = unpack(tree)
        self.shapes.assign(root)
        return root, self.shapes.match(root, self.trees[group])


def _never(node: Node) -> bool:
    return _left_out(node) and not _may_stay(node)


def _texts(root: Node, skipped: Callable = _never) -> Iterator[Node]:
    """Text nodes outside the landmarks that are left out anyway."""
    todo = [root]
    while todo:
        node = todo.pop()
        if not node.tag:
            yield node
        elif not skipped(node):
            todo.extend(reversed(node.children))


def _parsed_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The only place where pages are parsed: their trees, shapes and text hashes."""
    for batch in batches:
        out = batch[["page_id", "url", "host", "code"]].copy()
        roots = map(parse, batch["html"])
        found = [(shape_of(root), _page_hash(root), pack(root)) for root in roots]
        out["shape"] = [f[0] for f in found]
        out["page"] = pd.array([f[1] for f in found], "Int64")
        out["tree"] = [f[2] for f in found]
        yield out


def _vote_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hosts = _Hosts()
    for batch in batches:
        out = []
        for host, group, own, tree, reference in zip(
            batch["host"], batch["group"], batch["page"], batch["tree"], batch["reference"], strict=True
        ):
            root, slots = hosts.aligned(tree, (host, group), reference)
            for node in _texts(root):
                slot = slots.get(id(node))
                if slot is not None and node.text != " ":
                    out.append((host, group, slot, text_hash(node.text), own))
        yield pd.DataFrame(out, columns=["host", "group", "slot", "value", "page"])


def _text_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hosts = _Hosts()
    for batch in batches:
        texts = []
        for host, group, tree, reference, constant in zip(
            batch["host"], batch["group"], batch["tree"], batch["reference"], batch["constant"], strict=True
        ):
            fixed = _as_map(constant)
            root, slots = hosts.aligned(tree, (host, group), reference) if fixed else (unpack(tree), {})
            template = {
                id(node)
                for node in (_texts(root) if fixed else ())
                if fixed.get(slots.get(id(node))) == text_hash(node.text)
            }
            texts.append(main_text(root, template))
        out = batch[["page_id", "url"]].copy()
        out["text"] = texts
        out["n_chars"] = [len(t) for t in texts]
        yield out


def _as_map(constant) -> dict[int, int]:
    return {} if constant is None else {c["slot"]: c["value"] for c in constant}


def extract_main_text(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    Null html counts as empty, and a page without main text gives an empty text. Pages with
    a null url or one without host share the empty host. Repeated rows give repeated rows.
    Other columns are not read.
    """
    slim = pick(pages, page_id=id_column, url=url_column, html=html_column)
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^(?:[a-z][a-z0-9+.\-]*:)?//([^/?#]*)", 1)
    hosted = slim.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    keys = slim.schema["page_id"].dataType.simpleString()
    parsed = stored(
        hosted.withColumn("code", F.xxhash64("html")).mapInPandas(
            _parsed_rows, f"page_id {keys}, url string, host string, code bigint, shape bigint, page bigint, tree binary"
        ),
        "parsed-pages",
    )
    # One row for a different page, whatever its copies' adverts: the copy of smallest code.
    different = parsed.where("host != '' AND page IS NOT NULL").groupBy("host", "shape", "page").agg(
        F.min("code").alias("code")
    )
    counted = stored(
        different.groupBy("host", "shape").agg(F.count("*").alias("pages"), F.min("code").alias("code")),
        "shape-counts",
    )
    largest = counted.groupBy("host").agg(
        F.max(F.struct("pages", "shape")).alias("top"), F.sum("pages").alias("all_pages")
    )
    # A host without a frequent shape is one group.
    groups = stored(
        counted.join(largest, "host")
        .where(f"pages >= {LEAST_PAGES} OR shape = top.shape")
        .select(
            "host", F.col("shape").alias("group"), "code",
            F.when(F.col("pages") >= LEAST_PAGES, F.col("pages")).otherwise(F.col("all_pages")).alias("group_pages"),
        ),
        "page-groups",
    )
    references = stored(
        parsed.select("host", "code", "tree").join(groups, ["host", "code"])
        .groupBy("host", "group").agg(F.first("tree").alias("reference"), F.first("group_pages").alias("group_pages")),
        "references",
    )
    small = references.agg(F.sum(F.octet_length("reference") + F.octet_length("host"))).first()[0] or 0
    side = F.broadcast(references) if small <= BROADCAST_BYTES else references
    frequent = groups.groupBy("host").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("group_pages", "group")), asc=False), lambda g: g["group"]
        ).alias("groups")
    )
    # The group of each page: that of its own shape, or of the host's most frequent shape.
    first = F.coalesce(F.get("groups", F.lit(0)), F.lit(0).cast("long"))
    own = F.when(F.coalesce(F.array_contains("groups", F.col("shape")), F.lit(False)), F.col("shape")).otherwise(first)
    grouped = parsed.join(stored(frequent, "frequent-shapes"), "host", "left").withColumn("group", own)
    votes = (
        # Pages without text vote as one. (A null would make pandas round the hashes.)
        grouped.select("host", "group", F.coalesce("page", F.lit(0).cast("long")).alias("page"), "tree").join(side, ["host", "group"])
        .select("host", "group", "page", "tree", "reference")
        .mapInPandas(_vote_rows, "host string, `group` bigint, slot int, value bigint, page bigint")
    )
    values = votes.distinct().groupBy("host", "group", "slot", "value").agg(F.count("*").alias("n"))
    templates = stored(
        values.groupBy("host", "group", "slot")
        .agg(F.sum("n").alias("pages"), F.max(F.struct("n", "value")).alias("top"))
        .where((F.col("pages") >= LEAST_PAGES) & (F.col("top.n") >= SAME_SHARE * F.col("pages")))
        .join(groups.select("host", "group", "group_pages"), ["host", "group"])
        .where(F.col("top.n") >= GROUP_SHARE * F.col("group_pages"))
        .groupBy("host", "group")
        .agg(F.collect_list(F.struct("slot", F.col("top.value").alias("value"))).alias("constant")),
        "templates",
    )
    wrappers = stored(references.join(templates, ["host", "group"]), "wrappers")
    side = F.broadcast(wrappers) if small <= BROADCAST_BYTES else wrappers
    return grouped.join(side, ["host", "group"], "left").select(
        "page_id", "url", "tree", "host", "group", "reference", "constant"
    ).mapInPandas(_text_rows, f"page_id {keys}, url string, text string, n_chars bigint")
