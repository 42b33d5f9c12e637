"""Main text of web pages by the maximum-scoring subsequence.

A page becomes a sequence of tokens: tags and words. Every token has a weight, and the main text is the contiguous run
of tokens with the largest sum, found by one linear scan. Words score positive and tags negative by default; the
weights of the kinds of tokens met in labelled pages are their smoothed log-odds of lying inside the main text. A kind
is a tag with its first class, or a word together with the innermost block it stands in. A page is labelled if its
markup names the main text (article, main, or that role or item property).

Scripts, styles, comments, forms, menus, adverts and other blocks that are never main text are no tokens at all, also
inside the chosen run.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.batches import map_batches, map_texts
from almanac.sources import table

# Bound of the training sample: the labelled pages with the smallest hash of page_id and html.
MAX_PAGES = 2_000
WORD_WEIGHT, TAG_WEIGHT = 1.0, -0.5  # for kinds of tokens that no labelled page has
LARGEST_WEIGHT = 4.0

# fixed values: names of HTML
RAW = "script style textarea title iframe".split()  # run to their end tag, whatever stands between
EMBEDDED = "svg object select template noscript".split()  # hold elements, and never text
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
BLOCKS = CLOSES_P | set("body caption dd dt head html li tbody td tfoot th thead tr".split())
NEVER = set("nav aside footer form button dialog menu".split())
ROLES = set("navigation complementary contentinfo banner search form dialog alert alertdialog menu".split())
MAIN = set("article main".split())

# What stands in a tag behind its name: a quote opens a value only right after an equals sign. A value or tag that never
# ends runs to the end of the page, so its markup is not shown as text.
_REST = r"(?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+|=)*+"
_PIECE = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(RAW)})(?=[\s/>]){_REST}(?:>.*?(?:</\1\s*>|\Z)|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({_REST})(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<|[^<]+",
    re.S | re.I,
)
# Markup that a labelled page has; whether it names main text there, the tokens say.
_MAIN_MARKUP = r"(?i)<(?:article|main)|role\s*=\s*[\"']?main|itemprop\s*=\s*[\"']?articlebody"
_EMBEDDED = re.compile(rf"<(?:{'|'.join(EMBEDDED)})\b", re.I)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>\"'][^\s>]*))?)?")
_NAMES = re.compile(r"[a-z0-9]+")
# fixed values: words in class and id names of blocks that are not main text
OUTSIDE = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disqus footer header menu modal nav navbar navigation newsletter notice pagination popup promo related reply "
    "replies share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# fixed values: words that stand beside those in such names and say nothing of their own
BESIDE = set(
    "area bar block bottom box btn button buttons col column container content group inner item items left links list "
    "main outer page panel posts primary right row secondary section site slot thread top wrap wrapper".split()
)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text.strip() else {}


def _is_outside(names: list[str]) -> bool:
    """Whether one of the class or id names says that a block is not main text, by all of its words."""
    for name in names:
        words = set(_NAMES.findall(name.lower()))
        words -= {w for w in words if w.isdigit()}
        if words & OUTSIDE and words <= OUTSIDE | BESIDE:
            return True
    return False


class _Open:
    """An open element, and what holds inside it by it and the elements around it.

    ``hidden``: it is in a block that is never main text, and not in the first main block inside that. ``met`` and
    ``main``: in a main block. ``block``: name of the innermost block. ``paragraph``: place of the p that a block
    would close, or -1.
    """

    __slots__ = ("name", "hidden", "main", "block", "paragraph")

    def __init__(self, name: str, outside: bool, main: bool, around: _Open | None, place: int):
        self.name = name
        self.main = main or (around is not None and around.main)
        # The first main block shows what is hidden around it.
        shown = main and not (around is not None and around.main)
        self.hidden = outside or (around is not None and around.hidden and not shown)
        self.block = name if name in BLOCKS else around.block if around else ""
        scope = around.paragraph if around else -1
        self.paragraph = place if name == "p" else -1 if name in ("button", "td", "th") else scope


def _embedded(page: str) -> dict[int, int]:
    """Start and end of the embedded elements that are closed before an element around them is.

    One that is not, or that closes itself, is no more than its tag: it does not hide what follows.
    """
    spans: dict[int, int] = {}
    if not _EMBEDDED.search(page):
        return spans
    stack: list[tuple[str, int]] = []
    open_names: Counter[str] = Counter()
    for m in _PIECE.finditer(page):
        if m[1] or m[3] is None:
            continue
        name = m[3].lower()
        if not m[2]:
            if name not in VOID and not m[4].rstrip().endswith("/"):
                stack.append((name, m.start()))
                open_names[name] += 1
        elif open_names[name]:
            while True:
                last, start = stack.pop()
                open_names[last] -= 1
                if last == name:
                    break
            if name in EMBEDDED:
                spans[start] = m.end()
    return spans


def tokens(page: str) -> Iterator[tuple[str, str, bool, bool]]:
    """(kind, words or "", starts a block, inside labelled main text) in page order.

    A tag has a kind that starts with "<". A run of text between tags is one token with all its words. Unclosed and
    stray tags are taken as browsers do: a block closes an open p, and an end tag without its start does nothing.
    """
    stack: list[_Open] = []
    open_names: Counter[str] = Counter()
    block = True
    embedded, skipped = _embedded(page), 0

    def close(at: int) -> None:
        open_names.subtract(e.name for e in stack[at:])
        del stack[at:]

    for m in _PIECE.finditer(page):
        name = m[3]
        if m[1] or m.start() < skipped:  # a raw element or inside an embedded one, never text
            continue
        if name is not None and name.lower() in EMBEDDED:
            skipped = embedded.get(m.start(), 0)
            continue
        around = stack[-1] if stack else None
        if name is None:
            if (m[0][0] == "<" and len(m[0]) > 1) or (around and around.hidden):
                continue
            yield f"word {around.block if around else ''}", m[0], block, bool(around and around.main)
            block = False
            continue
        name = name.lower()
        kind = f"<{m[2]}{name}"
        if m[2]:
            if not open_names[name]:
                continue
            hidden, main = around.hidden, around.main  # something is open
            at = len(stack) - 1
            while stack[at].name != name:
                at -= 1
            close(at)
        else:
            if name in CLOSES_P and around and around.paragraph >= 0:
                close(around.paragraph)
            elif name in ("li", "dd", "dt", "tr", "td", "th", "option") and around and around.name == name:
                close(len(stack) - 1)
            around = stack[-1] if stack else None
            attributes = _attributes(m[4])
            classes = attributes.get("class", "").split()
            boilerplate = _is_outside([*classes, attributes.get("id", "")])
            role = attributes.get("role", "").lower()
            is_main = not boilerplate and (
                name in MAIN or role == "main" or attributes.get("itemprop", "").lower() == "articlebody"
            )
            inside = is_main or bool(around and around.main)
            outside = (
                name in NEVER or role in ROLES or "hidden" in attributes
                or (name in BLOCKS and name not in ("html", "body") and boilerplate)
                or (name == "header" and not inside)
            )
            kind = f"{kind} {classes[0].lower()}" if classes else kind
            element = _Open(name, outside, is_main, around, len(stack))
            hidden, main = element.hidden, inside
            if name not in VOID and not m[4].rstrip().endswith("/"):
                stack.append(element)
                open_names[name] += 1
        block |= name in BLOCKS
        if not hidden:
            yield kind, "", False, main


def count_kinds(page: str) -> tuple[Counter, Counter]:
    """How many tokens of each kind lie inside and outside the labelled main text; words count singly."""
    inside, outside = Counter(), Counter()
    for kind, text, _, main in tokens(page):
        (inside if main else outside)[kind] += len(text.split()) if text else 1
    return inside, outside


def weight(inside: int, outside: int) -> float:
    """Smoothed log-odds."""
    return max(-LARGEST_WEIGHT, min(LARGEST_WEIGHT, math.log((inside + 0.5) / (outside + 0.5))))


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest positive sum; the earliest, then longest, of equal ones."""
    best, best_start, best_end = 0.0, 0, 0
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total < 0 or i == 0:
            total, start = 0.0, i
        total += score
        if total > best or (total == best and best > 0 and start == best_start):
            best, best_start, best_end = total, start, i + 1
    return best_start, best_end


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks of the best region, white space made single, joined by an empty line; no words: empty."""
    found = list(tokens(page))
    scores = []
    for kind, text, _, _ in found:
        if kind[0] != "<":
            scores.append(weights.get(kind, WORD_WEIGHT) * len(text.split()))
        else:  # a tag with a class that no labelled page has counts as one without
            known = weights.get(kind)
            scores.append(weights.get(kind.split(" ")[0], TAG_WEIGHT) if known is None else known)
    start, end = best_region(scores)
    blocks: list[list[str]] = []
    for kind, text, first, _ in found[start:end]:
        if kind[0] == "<":
            if kind.startswith("<br") and blocks:
                blocks[-1].append(" ")
            continue
        if first or not blocks:
            blocks.append([])
        blocks[-1].append(text)
    texts = (" ".join(entities.unescape("".join(parts)).split()) for parts in blocks)
    return "\n\n".join(t for t in texts if t)


def learn_weights(pages: DataFrame, max_pages: int = MAX_PAGES) -> dict[str, float]:
    """Weights of the token kinds of a bounded sample of the labelled pages; no labelled page: none."""
    hashed = pages.filter(F.rlike("html", F.lit(_MAIN_MARKUP))).select("html", F.xxhash64("page_id", "html").alias("hash"))

    def prepare() -> Callable[[list[str]], list]:
        return lambda texts: [[any(main for *_, main in tokens(t)) for t in texts]]

    labelled = map_texts(hashed, "html", ("hash",), "labelled boolean", prepare).filter("labelled")
    # Only hashes meet in one task to be ranked; the pages follow by a join with the bounded list.
    least = labelled.select("hash").distinct().orderBy("hash").limit(max_pages)
    sample = hashed.join(F.broadcast(least), "hash", "left_semi").select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside, outside = Counter(), Counter()
            for page in batch.column("html").to_pylist():
                both = count_kinds(page)
                if both[0]:
                    inside += both[0]
                    outside += both[1]
            kinds = list(inside | outside)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()),
                 pa.array([outside[k] for k in kinds], pa.int64())],
                ["kind", "inside", "outside"],
            )

    counted = map_batches(sample, run, "kind string, inside long, outside long")
    total = counted.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    return {r.kind: weight(r.inside, r.outside) for r in total.collect()}


def extracted(pages: DataFrame, weights: dict[str, float], keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, text and n_chars of every row.

    A null, empty or wordless page has an empty text. Rows are independent: repeated rows come out each, null keys
    are kept, other columns are not read. Pages of any length are read whole, in linear time.
    """

    def prepare() -> Callable[[list[str]], list]:
        def run(texts: list[str]) -> list:
            found = [main_text(t, weights) for t in texts]
            return [found, [len(t) for t in found]]

        return run

    return map_texts(pages, "html", keep, "text string, n_chars long", prepare)


def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    return extracted(pages, learn_weights(pages))


QUERIES = {"op6_html_text": op6_html_text}
ORACLES: dict[str, str] = {}
