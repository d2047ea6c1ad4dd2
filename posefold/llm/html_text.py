"""Main text of web pages by a maximum-scoring subsequence.

A page is read as a run of tags and text pieces. Words score by the kind of element that holds them,
tags cost by their name; the weights are log ratios of counts inside and outside the marked content
(``article`` or ``main``) of all pages that mark it. One linear scan finds the contiguous region with
the largest sum. Pages without marked content are scored with the same weights. Boilerplate elements
that lie inside the region are left out of the text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.llm.common import slices

# Element names of HTML, by what they do to a page's text.
MARKED = frozenset("article main".split())
DROPPED = frozenset(
    "nav footer aside form dialog button select datalist menu noscript template svg math iframe object video audio canvas"
    .split()
)
RAW = "script|style|title|textarea|noscript|template|svg|iframe"
CONTAINERS = DROPPED | frozenset("header div section ul ol dl table head body figure fieldset details".split())
BLOCKS = CONTAINERS | MARKED | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption figcaption blockquote pre address hr br html summary"
    " hgroup center legend optgroup option".split()
)
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label map mark meter q ruby rp rt s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
#: Words of a class or id that name boilerplate. Inside marked content only a whole class, role or id does.
_HINTS = (
    r"(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|comments?|disqus|replies|sidebar|cookies?|consent|notices?|alert"
    r"|newsletter|subscribe|share|sharing|social|related|recommended|breadcrumbs?|menu|nav\w*|footer|masthead|popup|modal|login"
    r"|signup|widget|pagination|toolbar)"
)
HINT = re.compile(rf"(?:^|[\s_-]){_HINTS}(?:$|[\s_-])", re.I)
WHOLE_HINT = re.compile(rf"(?:^|\s){_HINTS}(?:$|\s)", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CELLS, _ROWS = ("td", "th"), ("tr", "td", "th")
_GROUPS = ("thead", "tbody", "tfoot", *_ROWS)
#: What an element's start ends if it is still open.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": _CELLS, "th": _CELLS, "tr": _ROWS}
ENDS |= {"thead": _GROUPS, "tbody": _GROUPS, "tfoot": _GROUPS}
_NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[/!?a-zA-Z][^>]*>|([^<]+|<)",
    re.I | re.S,
)
#: What follows the last ">": text, and a comment that is never closed.
_REST = re.compile(r"<!--.*|(?!)()()()()|([^<]+|<)", re.S)
SMOOTHING = 1.0
MOST = 8.0
TAG_COST = 0.5
_PRIOR_IN = frozenset("tag:p tag:/p tag:br word:flow".split())


class Piece:
    """A tag or a run of text: what it counts as, how often, and what it does to the text."""

    __slots__ = ("kind", "times", "text", "breaks", "dropped", "marked")

    def __init__(self, kind, times, text, breaks, dropped, marked):
        self.kind, self.times, self.text = kind, times, text
        self.breaks, self.dropped, self.marked = breaks, dropped, marked


def _tokens(page: str) -> Iterator[re.Match]:
    """Tags, text and what is neither. Behind the last ">" nothing is a tag, however often one begins, so no
    tag is looked for there; a comment or raw element that is never closed takes all that follows it."""
    end, last = page.rfind(">") + 1, None
    for last in _TOKEN.finditer(page, 0, end):
        yield last
    if last is not None:
        unclosed = last[0].startswith("<!--") and not (len(last[0]) >= 7 and last[0].endswith("-->"))
        if unclosed or last[1] and not re.search(rf"</{last[1]}\s*>\Z", last[0], re.I):
            return
    yield from _REST.finditer(page, end)


def read(page: str) -> list[Piece]:
    """The page's pieces. Unclosed elements end with what holds them, stray end tags are skipped."""
    out: list[Piece] = []
    stack: list[tuple[str, str, bool]] = []  # name, kind, dropped
    opened: Counter = Counter()  # how often each name is in the stack
    marked = links = 0

    def state() -> tuple[str, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else ("flow", False)

    def push(entry: tuple[str, str, bool]) -> None:
        stack.append(entry)
        opened[entry[0]] += 1

    def cut(depth: int) -> None:
        opened.subtract(n for n, _, _ in stack[depth:])
        del stack[depth:]

    for match in _tokens(page):
        raw, closing, name, attributes, text = match.groups()
        kind, dropped = state()
        if text is not None:
            words = len(text.split())
            if words or text:
                where = "link" if links and kind == "flow" else kind
                out.append(Piece(f"word:{where}", words, text, False, dropped, marked > 0))
            continue
        if name is None:
            continue  # comments, raw elements, declarations
        name = name.lower()
        if stack and stack[-1][0] == "p" and name in BLOCKS and name != "br":
            cut(len(stack) - 1)  # a paragraph ends where the next block begins or its parent ends
            kind, dropped = state()
        if not closing and name in ENDS and any(opened[n] for n in ENDS[name]):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ENDS[name]:
                    cut(depth)
                    kind, dropped = state()
                    break
                if stack[depth][0] in BLOCKS and stack[depth][0] not in ("div", "p", "address"):
                    break  # of a list or table further out
        if name in MARKED:
            marked = max(0, marked + (-1 if closing else 1))
            if closing:
                if opened[name]:
                    cut(next(i for i, (n, _, _) in enumerate(stack) if n == name))
            else:
                push((name, "flow", False))
            out.append(Piece("", 0, "", True, dropped, False))
            continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        hinted = begins = False
        if not closing and attributes and "=" in attributes and name not in ("html", "body"):
            hint = WHOLE_HINT if marked else HINT
            hinted = any(
                hint.search(next(filter(None, found), ""))
                for which, *found in _NAMED.findall(attributes)
                if not (name in HEADINGS and which.lower() == "id")
            )
        if closing:
            if opened[name]:
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
                marked -= min(marked, sum(n in MARKED for n, _, _ in stack[depth:]))
                cut(depth)
        elif name in CONTAINERS or hinted and name not in ("br", "hr", "img", "input", "meta", "link", "html"):
            if not attributes.endswith("/"):
                off = name in DROPPED or hinted or name == "head" or name == "header" and not marked
                own = name if off and not hinted else "hinted" if hinted else kind if name in ("div", "section", "body") else name
                begins = off
                push((name, "flow" if own in ("figure", "details", "table", "ul", "ol", "dl") and not dropped else own, dropped or off))
        known = name if name in BLOCKS or name in INLINE else "other"
        out.append(Piece(f"tag:{'/' * bool(closing)}{known}", 1, "", name in BLOCKS, dropped or begins, marked > 0))
    return out


def counts(page: str) -> Counter:
    """``(kind, inside)`` of a page that marks its content; empty if it doesn't."""
    pieces = read(page)
    if not any(p.marked for p in pieces):
        return Counter()
    found: Counter = Counter()
    for p in pieces:
        if p.times:
            found[p.kind, p.marked and not p.dropped] += p.times
    return found


def weights(inside: dict[str, int], outside: dict[str, int]) -> dict[str, float]:
    """Log ratios, words as they are, tags never positive; kinds that were never seen get none."""
    out = {}
    for kind in {*inside, *outside, *_PRIOR_IN}:
        ratio = math.log((inside.get(kind, 0) + (kind in _PRIOR_IN) + SMOOTHING) / (outside.get(kind, 0) + SMOOTHING))
        ratio = max(-MOST, min(MOST, ratio))
        out[kind] = ratio if kind.startswith("word:") else -TAG_COST + min(0.0, ratio)
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """``[begin, end)`` of the contiguous run with the largest positive sum, the first and shortest of equals."""
    best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, begin, end = total, start, i + 1
    return begin, end


def main_text(page: str, weight: dict[str, float]) -> str:
    """The region's blocks, one a line, with character references decoded and white space as single spaces."""
    pieces = read(page)
    default = {"word": -1.0, "tag": -TAG_COST - 1.0}
    # What is dropped never enters the text, so a region may reach across it at no cost.
    scores = [0.0 if p.dropped else p.times * weight.get(p.kind, default.get(p.kind[:4].rstrip(":"), 0.0)) for p in pieces]
    begin, end = best_region(scores)
    if begin < end:
        # Whole blocks, and all of the marked content that the region is a part of.
        while begin and not pieces[begin - 1].breaks or begin and pieces[begin].marked and pieces[begin - 1].marked:
            begin -= 1
        while end < len(pieces) and (not pieces[end].breaks or pieces[end - 1].marked and pieces[end].marked):
            end += 1
    blocks, held = [], []
    for p in pieces[begin:end]:
        if p.breaks:
            blocks.append("".join(held))
            held = []
        elif p.text and not p.dropped:
            held.append(p.text)
    blocks.append("".join(held))
    lines = (" ".join(html.unescape(block).split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def learn(pages: DataFrame, html_column: str = "html") -> dict[str, float]:
    """Weights from every page that marks its content; one line for each kind of piece reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches, 64):
            for page in batch.column(0).to_pylist():
                total.update(counts(page))
        rows = [(kind, n * inside, n * (not inside)) for (kind, inside), n in total.items()]
        if rows:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "inside", "outside"])

    found = (
        pages.select(html_column)
        .where(F.col(html_column).isNotNull())
        .mapInArrow(run, "kind string, inside bigint, outside bigint")
        .groupBy("kind")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .collect()  # element names of HTML: some hundred lines, whatever the input
    )
    return weights({r.kind: r.inside for r in found}, {r.kind: r.outside for r in found})


def extract_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", weight: dict | None = None
) -> DataFrame:
    """One row per page: ``id, url, text, n_chars``.

    Null or empty html, and pages without a region of positive score, give an empty text. Null ids and
    urls and repeated rows are kept as they are; an empty table gives no rows. Broken markup never
    fails: what is no tag is text. Other columns are not looked at, whatever their names.
    """
    weight = learn(pages, html_column) if weight is None else weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts = [main_text(page or "", weight) for page in batch.column("page").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("address"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["id", "address", "text", "n_chars"],
            )

    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("address"), F.col(html_column).alias("page"))
    id_type = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {id_type}, address string, text string, n_chars bigint")
    return found.select(F.col("id").alias(id_column), F.col("address").alias(url_column), "text", "n_chars")
