"""Main text of web pages: the contiguous run of tokens with the highest score, words counting for it and tags against it."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm._shared import materialize, scratch

#: Labelled pages that weights are learned from, and the longest of them.
PAGES, LONGEST = 2000, 1 << 18
#: What a tag can cost at most, in words; the best on the labelled pages is taken.
COSTS = (1.0, 2.0, 4.0, 8.0)
#: Observations that a class's prior is worth.
PRIOR = 10

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style noscript template textarea iframe svg math title xmp object canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
ASIDE = frozenset("nav footer aside form button select menu dialog head search label fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class and id names of elements beside the main text.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer masthead topbar comment comments commentlist disqus respond reply replies discussion share sharing "
    "social related recommended recommendations newsletter subscribe subscription signup login widget widgets pagination pager toolbar skip search copyright legal disclaimer".split()
)
#: Such words only outside of the main element, where a header belongs to the page and not to the article.
OUTER = frozenset("header banner".split())
#: After these a name tells of a layout, as in has-sidebar.
LAYOUT = frozenset("has with no without".split())
#: What the start of an element ends, if it is open.
ENDS = {"p": ("p",), "li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "a": ("a",)}
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Tags told apart in the weights; others count as one.
KNOWN = BLOCK | VOID | RAW | frozenset("a b i em strong span u s small sub sup font code kbd q cite abbr time mark label".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*+|[^>]*)>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Token(NamedTuple):
    kind: str  # class that weights are learned for; those of tags begin with t, those of words with w
    words: int
    text: str | None  # decoded, None for tags
    aside: bool  # in an element that is no part of the main text
    breaks: bool  # begins or ends a block
    main: str  # in the page's main element, out of it, or none has it


def beside(name: str, attributes: str, in_main: bool) -> bool:
    """Whether an element, by its tag, role, class or id, is beside the main text."""
    if name in ASIDE or (name == "header" and not in_main):
        return True
    if not attributes or name in ("html", "body", "main", "article"):
        return False
    for key, *values in _ATTR.findall(attributes):
        value, key = "".join(values), key.lower()
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "role":
            if value.lower() in ROLES - ({"banner"} if in_main else set()):
                return True
        elif key in ("class", "id"):
            for whole in value.split():
                parts = [p.lower() for p in _NAME.findall(whole)]
                for k, p in enumerate(parts):
                    if (p in NAMES or (p in OUTER and not in_main)) and not (k and parts[k - 1] in LAYOUT):
                        return True
    return False


def tokens(page: str, hints: bool = True) -> list[Token]:
    """Tags and text runs of a page in order, told apart by where they stand. Without hints neither names nor the main element count, only the tags themselves."""
    last = page.rfind(">") + 1
    tail = re.search(r"<[a-zA-Z/!?]", page[last:])  # a tag that never ends
    end = last + tail.start() if tail else len(page)
    low = page.lower()
    main_tag = next((t for t in ("article", "main") if re.search(rf"<{t}[\s>]", low)), "") if hints else ""
    out: list[Token] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, beside, link, main
    opened: Counter[str] = Counter()
    n_beside = n_link = n_main = 0
    block = [""]

    def pop() -> None:
        nonlocal n_beside, n_link, n_main
        name, side, link, main = stack.pop()
        opened[name] -= 1
        n_beside, n_link, n_main = n_beside - side, n_link - link, n_main - main
        if name in BLOCK:
            block.pop()

    def state() -> str:
        return ("in" if n_main else "out") if main_tag else "none"

    def say(raw: str) -> None:
        text = html.unescape(raw)
        n = len(text.split())
        if n or text:
            of = block[-1]
            of = "h" if of in HEADING else of if of in ("p", "li", "td", "dd", "pre", "blockquote") else "other"
            out.append(Token(f"w {state()} {n_beside > 0} {n_link > 0} {of}", n, text, n_beside > 0, False, state()))

    at = 0
    while at < end:
        m = _TAG.search(page, at, last)
        if not m:
            say(page[at:end])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in RAW and not closing:
            if not m[3].endswith("/") or name in ("script", "style", "title", "textarea"):
                stop = low.find(f"</{name}", at)
                at = end if stop < 0 else stop
            continue
        breaks = name in BLOCK
        if closing:
            kind = f"t {state()} {n_beside > 0} /{name if name in KNOWN else 'other'}"
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
        else:
            for other in ENDS.get(name, ()):
                if opened[other] and (other == "a" or not any(s[0] in ("table", "ul", "ol", "dl") for s in _above(stack, other))):
                    while stack[-1][0] != other:
                        pop()
                    pop()
            if name in BLOCK and name != "p" and opened["p"] and not any(s[0] in BLOCK for s in _above(stack, "p")):
                while stack[-1][0] != "p":  # a paragraph ends where another block begins
                    pop()
                pop()
            if name in ("article", "main"):  # what is left open before it has ended
                while n_beside and any(s[1] and s[0] not in ("head",) for s in stack) and not n_main and _unclosed(page, at, stack):
                    pop()
            if name == "body" and opened["head"]:
                while opened["head"]:
                    pop()
            side = beside(name, m[3], n_main > 0) if hints else name in ASIDE or name == "header"
            if name not in VOID and not m[3].endswith("/"):
                stack.append((name, side, name == "a", name == main_tag))
                opened[name] += 1
                if breaks:
                    block.append(name)
            kind = f"t {state()} {n_beside > 0 or side} {name if name in KNOWN else 'other'}"
            if name not in VOID and not m[3].endswith("/"):
                n_beside, n_link, n_main = n_beside + side, n_link + (name == "a"), n_main + (name == main_tag)
        out.append(Token(kind, 0, None, n_beside > 0, breaks, state()))
    return out


def _above(stack: list[tuple], name: str) -> Iterator[tuple]:
    """Open elements inside the last one of that name."""
    for s in reversed(stack):
        if s[0] == name:
            return
        yield s


def _unclosed(page: str, at: int, stack: list[tuple]) -> bool:
    """Whether the innermost element is never ended in the rest of the page."""
    return page.lower().find(f"</{stack[-1][0]}", at) < 0


class Weights(NamedTuple):
    share: dict[str, float]  # of the tokens of a class, those in main elements
    cost: float

    def of(self, t: Token) -> float:
        own = self.share.get(t.kind)
        own = prior(t.kind) if own is None else own
        return t.words * own if t.text is not None else -self.cost * (1 - own)


def prior(kind: str) -> float:
    """The share that a class not met in labelled pages is taken to have."""
    what, main, side, *rest = kind.split(" ")
    if what == "t" and main == "in":
        return 1.0  # what stands inside the main element does not end its text
    if side == "True" or main == "out":
        return 0.0
    if what == "t":
        return 0.8
    return 0.5 if rest[0] == "True" and main == "none" else 1.0


def region(found: list[Token], weights: Weights) -> tuple[int, int]:
    """The tokens from:to with the highest sum, by one scan; the first and then the shortest of those that tie; empty if no word counts."""
    best, where, total, start = 0.0, (0, 0), 0.0, 0
    for k, t in enumerate(found):
        if total <= 0:
            total, start = 0.0, k
        total += weights.of(t)
        if total > best:
            best, where = total, (start, k + 1)
    return where


def rendered(found: list[Token]) -> str:
    """Blocks of a region: white space as one space, elements beside the main text left out."""
    blocks: list[list[str]] = [[]]
    for t in found:
        if t.breaks:
            blocks.append([])
        elif t.text is None:
            if t.kind.endswith((" br", " hr")):
                blocks[-1].append(" ")
        elif not t.aside:
            blocks[-1].append(t.text)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def main_text(page: str | None, weights: Weights) -> str:
    """Main text of one page; a page whose names say that all is beside it is read once more without them."""
    for hints in (True, False):
        found = tokens(page or "", hints)
        start, stop = region(found, weights)
        text = rendered(found[start:stop])
        if text:
            return text
    return ""


def _labelled(pages: DataFrame, html_col: str, rows: int) -> DataFrame:
    """Pages that say themselves where their main text is: one article element, or else one main element."""
    h = F.lower(html_col)
    one = lambda name: F.size(F.split(h, rf"<{name}[\s>]")) == 2
    found = pages.select(F.col(html_col).alias("page"), F.xxhash64(html_col).alias("hash")).where((F.octet_length(html_col) <= LONGEST) & (one("article") | (~h.rlike(r"<article[\s>]") & one("main"))))
    last = found.select("hash").distinct().orderBy("hash").limit(rows).agg(F.max("hash")).first()[0]  # hashes are sorted, not pages
    return found.where(F.col("hash") <= F.lit(last)).groupBy("hash").agg(F.min("page").alias("page")).select("page")


def _hidden(found: list[Token]) -> list[tuple[Token, bool]]:
    """Tokens of a labelled page as if it had no main element, and whether they are in it."""
    return [(t._replace(kind=re.sub(r"^(.) \w+", r"\1 none", t.kind)), t.main == "in") for t in found]


def fit(pages: DataFrame, html_col: str = "html", rows: int = PAGES) -> Weights:
    """Weights from at most `rows` pages that mark their main text, chosen by a hash of the page; a bounded table of classes comes back.

    For each class of tokens (words by block, link and place, tags by name) the share that lies in main elements is learned, once with and once
    without knowing of the element. A word counts as its share, a tag costs the share outside times the cost that finds the marked regions best."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[str, bool]] = Counter()
        for b in batches:
            for page in b.column(0).to_pylist():
                found = tokens(page)
                for t in found:
                    seen[t.kind, t.main == "in"] += t.words or (t.text is None)
                for t, inside in _hidden(found):
                    seen[t.kind, inside] += t.words or (t.text is None)
        kinds = sorted({k for k, _ in seen})
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), *(pa.array([seen[k, x] for k in kinds], pa.int64()) for x in (True, False))], ["kind", "inside", "outside"])

    with scratch(pages.sparkSession):
        sample = materialize(_labelled(pages, html_col, rows).repartition(8), "labelled-pages")
        seen = sample.mapInArrow(count, "kind string, inside bigint, outside bigint").groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
        share = {r["kind"]: (r["inside"] + PRIOR * prior(r["kind"])) / (r["inside"] + r["outside"] + PRIOR) for r in seen if r["inside"] + r["outside"]}

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {c: [0, 0, 0] for c in COSTS}
            for b in batches:
                for page in b.column(0).to_pylist():
                    both = _hidden(tokens(page))
                    for c in COSTS:
                        start, stop = region([t for t, _ in both], Weights(share, c))
                        for k, (t, inside) in enumerate(both):
                            got = start <= k < stop and not t.aside
                            inside = inside and not t.aside
                            sums[c][0] += t.words * (got and inside)
                            sums[c][1] += t.words * got
                            sums[c][2] += t.words * inside
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.float64()), *(pa.array([v[x] for v in sums.values()], pa.int64()) for x in range(3))], ["cost", "both", "got", "want"])

        judged = sample.mapInArrow(judge, "cost double, both bigint, got bigint, want bigint").groupBy("cost").agg(*(F.sum(c).alias(c) for c in ("both", "got", "want"))).collect()
    worth = {r["cost"]: 2 * r["both"] / (r["got"] + r["want"]) if r["got"] + r["want"] else 0.0 for r in judged}
    return Weights(share, max(COSTS, key=lambda c: (worth.get(c, 0.0), -abs(c - 2))))


def extract(pages: DataFrame, weights: Weights, html_col: str = "html") -> DataFrame:
    """The columns of pages with `text` and `n_chars` added; a column of such a name is replaced.

    Tags and words are one sequence; its contiguous part with the highest sum of weights is the main region, found in one scan. Of it menus, headers of the page,
    footers, sidebars, notices, adverts, forms, comments of readers, scripts and styles are left out. Character references are decoded, white space in a block is
    one space, blocks are joined by a line feed; `br` is white space.

    Each page is judged by itself, whatever its id; null and empty pages, and pages without words, give an empty text; pages that repeat give equal rows; very long pages are
    read whole, cut off ones to their end, a tag that never ends is none; ties go to the first region; an empty table gives no rows."""
    keep = [c for c in pages.columns if c not in ("text", "n_chars")]
    rows = pages.select(*(F.col(f"`{c}`") for c in keep), F.col(html_col).alias("_page of the row"))
    schema = pages.select([F.col(f"`{c}`") for c in keep]).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p.as_py(), weights) for p in b.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    return rows.mapInArrow(run, schema)
