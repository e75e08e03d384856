r"""Main text of web pages by differencing pages of nearest address.

A page is cut into lines, one for each block of text, with the region it stands
in: inside the article (``article`` or ``main`` element), inside a part that is
marked as something else (navigation, page header, footer, sidebar, form,
advert, notice, comments ...), or neither. Scripts, styles and the like give no
lines.

Each page is paired with pages of its host whose paths are nearest: the longest
common start of the path (cut at a directory, or up to ``NEAR`` characters into
the last segment) that holds another path; of that group the first and the last
path are the partners. Only group minima and maxima are aggregated, so a host
with many pages needs no task of its own. The line sequences of page and partner
are aligned by a longest common subsequence, and shared lines are deleted: outside
the article all of them, inside it those that are mostly links (articles share
sentences, also with the adverts of other pages, that belong to their text). A
partner that shares every undecided line is a copy and tells nothing.

Afterwards marked lines that no partner shares go too. Text outside the article goes
unless it is ``TEASER`` times as long as the article, which then was a teaser. Inline adverts and
controls give no text wherever they stand. Classes and ids count as whole words: every
part of a hyphenated one must be a hint or a word of layout.

Defined results: a null page is empty, its text too. Pages without an address
have no partner. Rows that repeat a page give repeated results. Paths are
compared without query, fragment, final slash and ``.html``. Extra columns are
ignored.
"""

from __future__ import annotations

import html as entities
import re
import struct
from typing import Iterable

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens.llm.common import arrow_pass, counted_broadcast, table, written

NEAR, ROWS_LIMIT, TEASER = 3, 1 << 28, 4
MARKED, ARTICLE, OPEN = 0, 1, 2

#: Elements by their part in a page.
SILENT = set("script style noscript template svg iframe object canvas textarea title head audio video map".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
             "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
             "table tbody td tfoot th thead tr ul".split())
ASIDE = set("nav footer aside form menu button select dialog fieldset label".split())
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
HINTS = re.compile(
    r"(ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|disqus|footer|gdpr|login|masthead|menus?|"
    r"modal|nav|navbar|navigation|newsletter|notices?|pager|pagination|popup|promo\w*|related|replies|respond|share|sharing|"
    r"sidebar|signup|social|sponsor\w*|subscribe|toolbar|widgets?)")
#: Words of layout that may stand beside a hint in one class name.
LAYOUT = set("a b area bar block bottom box btn button center col column container desktop form global group holder home icon icons inline "
             "inner item items js left link links list main mobile module outer page panel right row section site slot small sticky "
             "text title top unit wrap wrapper zone".split())
CONTENT = set("article body content entry main post story text".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTES = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*+\"|'[^']*+'|[^\s>\"']+))?")


def _is_marked(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is a part of the page that is not its article."""
    if tag in ASIDE or tag == "header" and not inside:
        return True
    if not attributes.strip():
        return False
    found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTES.findall(attributes)}
    if "hidden" in found or found.get("role") in ROLES and not (inside and found["role"] == "banner"):
        return True
    if tag in ("html", "body", "main"):
        return False
    names = [re.split(r"[^a-z0-9]+", n) for n in f"{found.get('class', '')} {found.get('id', '')}".split()]
    words = {w for n in names for w in n}
    if tag == "article":
        return any(n in (["comment"], ["comments"], ["ad"], ["advert"]) for n in names)
    if not inside and any("header" in n and set(n) <= LAYOUT | {"header"} for n in names):
        return True
    return not words & CONTENT and any(_is_hint(n) for n in names)


def _is_hint(name: list[str]) -> bool:
    """Whether a class name says what it is with all of its parts."""
    parts = [w for w in name if w and not w.isdigit()]
    hints = [bool(HINTS.fullmatch(w)) for w in parts]
    return any(hints) and all(h or w in LAYOUT for h, w in zip(hints, parts))


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """Text, region and whether it is mostly links, of each block of a page."""
    out: list[tuple[str, int, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []      # open elements: tag, marked, inside the article, without text
    parts, linked = [], 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                marked, inside = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                out.append((text, MARKED if marked else ARTICLE if inside else OPEN, 2 * linked >= len(text)))
            parts.clear()
            linked = 0

    def text_until(end: int) -> None:
        nonlocal linked
        if end > at and not (stack and stack[-1][3]):
            text = entities.unescape(page[at:end])
            parts.append(text)
            if links:
                linked += len(text.strip())

    at, links, end_of_page = 0, 0, len(page)
    lowered = None
    while True:
        found = MARKUP.search(page, at)
        text_until(found.start() if found else end_of_page)
        if not found:
            break
        at = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br" or tag == "wbr":
            parts.append(" " if tag == "br" else "")
        elif closing:
            if tag in BLOCKS:
                flush()
            if any(e[0] == tag for e in stack):
                while stack:
                    t = stack.pop()[0]
                    links -= t == "a"
                    if t == tag:
                        break
        elif tag in SILENT:
            if tag != "head" and not attributes.endswith("/"):
                if lowered is None:
                    lowered = page.lower() if page.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), page)
                close = lowered.find(f"</{tag}", at)
                if tag == "title" and close < 0:
                    continue
                at = end_of_page if close < 0 else close
        elif tag not in VOID:
            if tag in BLOCKS:
                flush()
                ends = CLOSED_BY.get(tag, set()) | {"p"}
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        links -= sum(e[0] == "a" for e in stack[i:])
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCKS:
                        break
            marked, inside, silent = stack[-1][1:] if stack else (False, False, False)
            if not marked and _is_marked(tag, attributes, inside):
                marked, silent = True, tag not in BLOCKS
            inside = inside or tag in ("article", "main")
            if not attributes.endswith("/"):
                stack.append((tag, marked, inside, silent))
                links += tag == "a"
        elif tag == "hr":
            flush()
    flush()
    return out


def common(a: list[int], b: list[int]) -> set[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``."""
    in_a, in_b = set(a), set(b)
    left = [i for i, x in enumerate(a) if x in in_b]
    return _align([a[i] for i in left], [x for x in b if x in in_a], left)


def _align(a: list[int], b: list[int], at: list[int]) -> set[int]:
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < min(len(a), len(b)) - start and a[-stop - 1] == b[-stop - 1]:
        stop += 1
    found = set(at[:start]) | set(at[len(at) - stop:])
    a, b, at = a[start:len(a) - stop], b[start:len(b) - stop], at[start:len(at) - stop]
    if not a or not b:
        return found
    if len(a) * len(b) > ROWS_LIMIT and len(a) > 1:     # too large to keep all rows: split where the halves fit best
        half = len(a) // 2
        before, after = _lengths(a[:half], b), _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = max(range(len(b) + 1), key=lambda j: before[j] + after[j])
        return found | _align(a[:half], b[:cut], at[:half]) | _align(a[half:], b[cut:], at[half:])
    rows, i, j = _rows(a, b), len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i] >> (j - 1) & 1:
                found.add(at[i])
                j -= 1
    return found


def _rows(a: list[int], b: list[int], last_only: bool = False) -> list[int]:
    """Bit rows of the alignment: a zero at bit ``j`` means that the length grows there."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        if not last_only:
            rows.append(row)
    return [row] if last_only else rows


def _lengths(a: list[int], b: list[int]) -> list[int]:
    row, out = _rows(a, b, last_only=True)[0], [0]
    for j in range(len(b)):
        out.append(out[-1] + (not row >> j & 1))
    return out


def main_text(lines: list[tuple[str, int, bool]], own: list[int], partners: Iterable[list[int]]) -> str:
    """The lines that are left, without what the partners share."""
    undecided = {i for i, (_, region, links) in enumerate(lines) if region == OPEN or region == ARTICLE and links}
    article = any(region == ARTICLE for _, region, _ in lines)
    shared: set[int] = set()
    for partner in partners:
        same = common(own, partner) & undecided
        if article or any(lines[i][1] == OPEN for i in undecided - same):
            shared |= same
    left = [(i, region, text) for i, (text, region, _) in enumerate(lines) if region != MARKED and i not in shared]
    chars = {r: sum(len(text) for i, region, text in left if region == r and not lines[i][2]) for r in (ARTICLE, OPEN)}
    teaser = chars[OPEN] > TEASER * chars[ARTICLE]
    return "\n\n".join(text for _, region, text in left if region == ARTICLE or teaser)


def _keys(lines: list[tuple[str, int, bool]]) -> list[int]:
    return [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, _, _ in lines]


def _row_id(pages: DataFrame) -> Column:
    return F.xxhash64(pages["page_id"], pages["url"], pages["html"])


def _hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
    keys = [_keys(page_lines(x)) for x in batch["html"].to_pylist()]
    return pa.RecordBatch.from_arrays([batch["row"], batch["host"], batch["path"], pa.array(keys, pa.list_(pa.int64()))],
                                      ["row", "host", "path", "keys"])


def partners(lines: DataFrame) -> DataFrame:
    """Rows ``(row, partner)``: at most two rows of the same host and of the nearest other paths."""
    last = F.length(F.substring_index("path", "/", -1))
    near = F.transform(F.sequence(F.lit(1), F.lit(NEAR)), lambda n: F.when(n <= last, F.col("path").substr(F.lit(1), F.length("path") - n)))
    parts = F.split("path", "/")
    parents = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))
    starts = F.array_distinct(F.filter(F.concat(near, F.slice(parents, 1, F.size(parts) - 1), F.array(F.lit(""))), lambda x: x.isNotNull()))
    rows = lines.where("host <> ''").select("row", "host", "path").distinct()
    placed = rows.select("row", "host", "path", F.explode(starts).alias("start"))
    place = F.struct("path", "row")
    groups = placed.groupBy("host", "start").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low.path <> high.path")
    groups = counted_broadcast(written(groups, "page-groups"))      # a host's root holds all of its pages
    near_rows = placed.join(groups, ["host", "start"]).groupBy("row").agg(
        F.max(F.struct(F.length("start").alias("n"), "path", "low", "high")).alias("m"))
    other = F.filter(F.array("m.low", "m.high"), lambda x: x["path"] != F.col("m.path"))
    return near_rows.select("row", F.explode(F.transform(other, lambda x: x["row"])).alias("partner"))


def _address(url: Column) -> list[Column]:
    bare = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://|[?#].*$", "")
    path = F.regexp_replace(F.regexp_replace(bare, r"^[^/]*", ""), r"(\.html?|/)$", "")
    return [F.lower(F.substring_index(bare, "/", 1)).alias("host"), path.alias("path")]


def _packed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The lines of each page as one small compressed value, for the shuffle."""
    packer, out = zstandard.ZstdCompressor(level=1), []
    for page in batch["html"].to_pylist():
        kept = [(t, r, k) for t, r, k in page_lines(page)]
        raw = [t.encode("utf-8", "surrogatepass") for t, _, _ in kept]
        head = b"".join(struct.pack("<IBB", len(t), r, k) for t, (_, r, k) in zip(raw, kept))
        out.append(packer.compress(struct.pack("<I", len(kept)) + head + b"".join(raw)))
    return pa.RecordBatch.from_arrays([batch[c] for c in ("row", "page_id", "url")] + [pa.array(out, pa.binary())],
                                      ["row", "page_id", "url", "lines"])


def _unpacked(data: bytes) -> list[tuple[str, int, bool]]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    number, out = struct.unpack_from("<I", raw)[0], []
    at = 4 + 6 * number
    for size, region, links in struct.iter_unpack("<IBB", raw[4:at]):
        out.append((raw[at:at + size].decode("utf-8", "surrogatepass"), region, bool(links)))
        at += size
    return out


def _extracted(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = []
    for data, others in zip(batch["lines"].to_pylist(), batch["others"].to_pylist()):
        lines = _unpacked(data)
        texts.append(main_text(lines, _keys(lines), others or []))
    return pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """Rows ``(page_id, url, text)``, one per row of ``pages``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    hashed = arrow_pass(pages.select(_row_id(pages).alias("row"), *_address(F.col("url")), "html"), _hashed,
                        "row long, host string, path string, keys array<long>")
    lines = written(hashed, "page-lines")
    pairs = written(partners(lines), "page-partners")
    known = lines.select(F.col("row").alias("partner"), "keys").dropDuplicates(["partner"])
    others = pairs.join(known, "partner").groupBy("row").agg(F.collect_list("keys").alias("others"))
    packed = arrow_pass(pages.select(_row_id(pages).alias("row"), "page_id", "url", "html"), _packed,
                        "row long, page_id long, url string, lines binary")
    return arrow_pass(packed.join(written(others, "page-others"), "row", "left").select("page_id", "url", "lines", "others"),
                      _extracted, "page_id long, url string, text string")


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page: ``page_id, url, text, n_chars``."""
    return extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
