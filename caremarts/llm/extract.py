"""Main text of web pages by the maximum-scoring subsequence (operator 3).

A page is read as a sequence of words and tags. Words score positive where
their surroundings look like content and negative inside boilerplate; every tag
scores negative. One linear scan finds the contiguous region of greatest score,
and the words of that region that score positive are the main text.

The weights of surroundings are log-odds learned from labelled pages: pages that
mark their content themselves (``article``, ``main`` or
``itemprop=articleBody``) label each of their words as inside or outside.
Elements and class words that few pages use keep the prior of their kind.
Learning counts their words in Spark; what is collected is
bounded, since a feature must hold ``LEAST_SHARE`` of all counted words. Every
labelled page teaches, however many pages there are.

A block's text runs to the next block-level tag; white space inside it becomes
one space; blocks are joined by one line feed in page order.

Cases: null and empty pages have an empty text; markup may be cut off anywhere
(an unfinished tag is dropped, open elements end with the page); pages without
any content word have an empty text; repeated rows get equal results; an empty
table gives an empty table; columns named like output columns are replaced; a very long text is worked on whole, by itself.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremarts.llm.common import map_pieces, pieces, texts, written

LEAST_SHARE = 1e-4
PRIOR_WORDS = 200.0  # how many words a prior counts for
TAG_SCORE = -0.2
DECISIVE = -1.0  # surroundings at or below this make words boilerplate
BOILERPLATE_SCORE = -0.4  # of such a word: an aside may not outweigh the rest of its article

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)""",
    re.DOTALL,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
BODY_MARK = re.compile(r"""itemprop\s*=\s*["']?articleBody""", re.IGNORECASE)
NAME_WORD = re.compile(r"[a-z]+")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object textarea select option".split())
SKIPPED_RAW = ("script", "style", "textarea", "title")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn del em font i ins kbd label mark nobr q s samp small span strike strong "
    "sub sup time tt u var br img wbr".split()
)
CONTENT_MARK = ("article", "main")
PLAIN = frozenset("html body div section".split())  # say nothing by themselves
LISTS = frozenset("ul ol li dl dt dd table thead tbody tr td th caption".split())  # never decide by themselves
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
# Priors (log-odds of being content) of elements, and of words in class, id and role.
ELEMENT_PRIOR = {
    **dict.fromkeys("nav footer header aside form button fieldset menu dialog head title figure".split(), -4.0),
    **dict.fromkeys(RAW, -6.0),
    **dict.fromkeys("article main".split(), 2.0),
    **dict.fromkeys("p h1 h2 h3 h4 h5 h6 blockquote pre".split(), 1.5),
}
NAME_PRIOR = {
    **dict.fromkeys(
        "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo "
        "cookie cookies consent disclaimer discussion footer form header login menu nav navbar navigation newsletter notice popup "
        "promo promotion related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe "
        "toolbar widget".split(),
        -4.0,
    ),
    **dict.fromkeys("article content entry main post story text".split(), 0.5),
}


RAW_END = {name: re.compile(f"</{name}", re.IGNORECASE) for name in SKIPPED_RAW}


class Page:
    """The runs of a page: text with its surroundings, or a tag."""

    def __init__(self, source: str):
        self.runs: list[tuple[str, tuple[str, ...] | None, int, bool]] = []  # text, surroundings, block, inside a mark
        self.marked = False
        stack: list[tuple[str, tuple[str, ...], bool]] = []  # name, surroundings, inside a mark
        at, block, n = 0, 0, len(source)
        surroundings: tuple[str, ...] = ()
        inside = False
        search = MARKUP.search
        while at < n:
            m = search(source, at)
            end = m.start() if m else n
            if end > at:
                self.runs.append((source[at:end], surroundings, block, inside))
            if not m:
                break
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            block += name not in INLINE
            self.runs.append((" " if name == "br" else "", None, block, inside))
            if m[1]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        del stack[i:]
                        break
            elif name not in VOID:
                if name in CLOSES_P or name == "li":
                    self._imply(stack, "li" if name == "li" else "p")
                if name in SKIPPED_RAW:  # their content has no markup
                    close = RAW_END[name].search(source, at)
                    if name == "title" and close:
                        self.runs.append((source[at : close.start()], ("title",), block, False))
                    at = close.start() if close else n
                    continue
                if m[3].rstrip().endswith("/"):
                    continue
                _, above, marked = stack[-1] if stack else ("", (), False)
                mark = name in CONTENT_MARK or ("=" in m[3] and bool(BODY_MARK.search(m[3])))
                self.marked |= mark
                stack.append((name, above + self._features(name, m[3], marked), marked or mark))
            else:
                continue
            _, surroundings, inside = stack[-1] if stack else ("", (), False)

    @staticmethod
    def _imply(stack: list, name: str) -> None:
        """End an open ``name`` unless a table or list stands between."""
        for i in range(len(stack) - 1, -1, -1):
            own = stack[i][0]
            if own == name:
                del stack[i:]
                return
            if own not in INLINE and own != "p":
                return

    @staticmethod
    def _features(name: str, attributes: str, inside: bool) -> tuple[str, ...]:
        if name == "header" and inside:  # the heading of an article
            own: tuple[str, ...] = ()
        else:
            own = () if name in PLAIN or name in INLINE else (name,)
        if "=" in attributes:
            for m in NAMES.finditer(attributes):
                own += tuple("." + w for w in NAME_WORD.findall((m[1] or m[2] or m[3] or "").lower()))
        return own


def count_labels(pages: list[str]) -> dict[str, list[int]]:
    """For each feature of labelled pages, words inside and outside of the marked content.

    Words of an aside, a form or the like are outside even where a page puts
    those elements into its marked content.
    """
    out: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for source in pages:
        page = Page(source)
        if not page.marked:
            continue
        for text, surroundings, _, inside in page.runs:
            if surroundings is None:
                continue
            n = len(text.split())
            inside = inside and min(map(prior, surroundings), default=0.0) > DECISIVE
            if n:
                for f in (*set(surroundings), ""):
                    out[f][not inside] += n
    return out


def prior(feature: str) -> float:
    return NAME_PRIOR.get(feature[1:], 0.0) if feature.startswith(".") else ELEMENT_PRIOR.get(feature, 0.0)


def fit(pages: DataFrame, column: str = "html") -> dict[str, float]:
    """Weights of features, learned from all pages that mark their content."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, column):
                found = count_labels(texts(piece, column))
                yield pa.RecordBatch.from_pydict(
                    {
                        "feature": pa.array(list(found), pa.string()),
                        "inside": pa.array([v[0] for v in found.values()], pa.int64()),
                        "outside": pa.array([v[1] for v in found.values()], pa.int64()),
                    }
                )

    counts = pages.select(column).mapInArrow(run, "feature string, inside long, outside long")
    sums = counts.groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    sums = written(sums.where("feature is not null"), "extract-counts")  # read twice
    total = sums.agg(F.sum(F.col("inside") + F.col("outside"))).first()[0] or 0
    rows = sums.where(F.col("inside") + F.col("outside") >= max(1.0, LEAST_SHARE * total)).collect()
    whole = next((r for r in rows if r["feature"] == ""), None)
    weights = {}
    if whole is not None:
        base = math.log((whole["inside"] + 1) / (whole["outside"] + 1))
        for r in rows:
            f = r["feature"]
            if f:
                odds = math.log((r["inside"] + 1) / (r["outside"] + 1)) - base
                n = r["inside"] + r["outside"]
                mixed = (n * odds + PRIOR_WORDS * prior(f)) / (n + PRIOR_WORDS)
                weights[f] = max(-0.3 if f in LISTS else -4.0, min(2.0, mixed))
    return weights


class Extractor:
    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.known: dict[tuple[str, ...], float] = {}

    def word_score(self, surroundings: tuple[str, ...]) -> float:
        """The worst feature if one is decisive, else more than zero by the features' mean."""
        if surroundings not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            own = [self.weights[f] if f in self.weights else prior(f) for f in set(surroundings)]
            worst = min(own, default=0.0)
            mean = sum(own) / len(own) if own else 0.0
            self.known[surroundings] = BOILERPLATE_SCORE if worst <= DECISIVE else min(1.5, max(0.1, 0.3 + mean))
        return self.known[surroundings]

    def __call__(self, source: str) -> str:
        runs = Page(source).runs
        best, begin, end = 0.0, 0, 0
        total, start = 0.0, 0
        scores = []
        for i, (text, surroundings, _, _) in enumerate(runs):
            if surroundings is None:
                score = TAG_SCORE
            else:
                score = 0.0 if text.isspace() else self.word_score(surroundings) * (1 + text.count(" "))
            scores.append(score)
            if total <= 0:
                total, start = 0.0, i
            total += score
            if total > best:
                best, begin, end = total, start, i + 1
        out: list[str] = []
        last = None
        for (text, surroundings, block, _), score in zip(runs[begin:end], scores[begin:end]):
            if surroundings is not None and score > 0:
                if block == last:
                    out[-1] += text
                else:
                    out.append(text)
                    last = block
            elif text and block == last:
                out[-1] += text  # a line break is white space
        joined = [" ".join(html.unescape(t).split()) for t in out]
        return "\n".join(t for t in joined if t)


def extract(df: DataFrame, weights: dict[str, float], column: str = "html", out: str = "text") -> DataFrame:
    """Add the main text of each page."""
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def setup():
        each_page = Extractor(shared.value)
        return lambda piece: [[each_page(t) for t in texts(piece, column)]]

    return map_pieces(df, column, [T.StructField(out, T.StringType(), False)], setup)


def page_texts(pages: DataFrame) -> DataFrame:
    """The registered result: the main text of every page."""
    pages = pages.select("page_id", "url", "html")
    return extract(pages, fit(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
