"""Main text of web pages: the best-scoring run of words and tags."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import table

RAW = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|title|iframe|select|button)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*>", re.S | re.I)
TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:"[^"]*"|'[^']*'|[^>"'])*+|[^>]*)>""")
#: Elements that are never main text, and words of a class, id or role that say the same.
DROPPED = {"nav", "aside", "footer", "form", "head", "menu", "dialog", "figcaption"}
SAID = {
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
    "disqus", "footer", "header", "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "related", "share",
    "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget",
}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "del", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Words that name lists of further articles below the page's own.
LISTED = {"comment", "comments", "disqus", "related"}
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)


def enclosing(page: str) -> set[int]:
    """Where the tags begin that open an element with an article or main element inside."""
    found, stack = set(), []
    for m in TAG.finditer(page):
        name = m[2].lower()
        if name in VOID or name in INLINE or name == "p":
            continue
        if not m[1]:
            if name in ("article", "main"):
                found.update(at for at, _ in stack)
            stack.append((m.start(), name))
        elif any(x[1] == name for x in stack):
            while stack.pop()[1] != name:
                pass
    return found


def parts(page: str | None, by_class: bool = True) -> Iterator[tuple[str, str, bool, bool]]:
    """Tags ``("<p", "", ...)`` and texts ``("", text, ...)`` in page order: kind, text, whether dropped, whether in an article.

    An element that holds an article or main element is not dropped, unless it lists further articles, nor is a header
    inside one. Without ``by_class`` only names of elements count.
    """
    page = RAW.sub(lambda m: " " if m[0].startswith("<!") else "<wbr>", page or "")
    around = enclosing(page)
    stack: list[tuple[str, bool]] = []
    at, dropped, inside, seen = 0, 0, 0, False
    for m in TAG.finditer(page):
        if m.start() > at:
            yield "", page[at : m.start()], dropped > 0, inside > 0
        at, name = m.end(), m[2].lower()
        if name not in VOID and name not in INLINE and name != "p":
            if not m[1]:
                named = {w for v in NAMED.findall(m[3]) for w in re.findall(r"[a-z]+", v.lower())} if by_class else set()
                if name in ("body", "html", "article", "main") or name == "header" and inside:
                    out = False
                elif m.start() in around:
                    out = seen and bool(named & LISTED)
                else:
                    out = name in DROPPED or name == "header" or bool(named & SAID)
                stack.append((name, out))
                dropped, inside = dropped + out, inside + (name in ("article", "main"))
                seen = seen or name == "article"
            elif any(x[0] == name for x in stack):
                while True:
                    top, out = stack.pop()
                    dropped, inside = dropped - out, inside - (top in ("article", "main"))
                    if top == name:
                        break
        yield f"<{name}", "", dropped > 0, inside > 0
    if at < len(page):
        yield "", page[at:], dropped > 0, inside > 0


def learned_weights(pages: list[str], least: float = 0.1, most: float = 4.0) -> dict[str, float]:
    """A positive weight for words (``""``) and negative ones for tags, from pages whose main text is marked by an element.

    A tag costs more the more often it stands outside the main text; dropped elements count as outside.
    """
    inside, outside = Counter(), Counter()
    for page in pages:
        for kind, text, dropped, main in parts(page):
            (inside if main and not dropped else outside)[kind] += len(text.split()) if not kind else 1
    weights = {k: -min(most, max(least, 1 + math.log((outside[k] + 1) / (inside[k] + 1)))) for k in {*inside, *outside} if k}
    weights[""] = min(most, max(least, 1 + math.log((inside[""] + 1) / (outside[""] + 1))))
    return weights


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of the best contiguous region, one a line; words of dropped elements neither score nor stay.

    If classes leave no text, the page is read without them.
    """
    return _best(list(parts(page)), weights) or _best(list(parts(page, by_class=False)), weights)


def _best(items: list[tuple[str, str, bool, bool]], weights: dict[str, float]) -> str:
    best, span, total, begin = 0.0, (0, 0), 0.0, 0
    for k, (kind, text, dropped, _) in enumerate(items):
        if kind:
            total += weights.get(kind, -1.0)
        elif not dropped:
            total += weights[""] * len(text.split())
        if total <= 0:
            total, begin = 0.0, k + 1
        elif total > best:
            best, span = total, (begin, k + 1)
    blocks = [""]
    for kind, text, dropped, _ in items[span[0] : span[1]]:
        if kind and kind[1:] not in INLINE:
            blocks.append("")
        elif kind == "<br":
            blocks[-1] += " "
        elif not dropped:
            blocks[-1] += text
    lines = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def with_main_text(pages: DataFrame, sample: int = 400, name: str = "text") -> DataFrame:
    """All rows and columns and the main text of the whole ``html``; null html gives an empty text.

    Weights come from at most ``sample`` pages with an article or main element, by order of a hash; without any, a
    word is worth 1 and a tag -1.
    """
    marked = pages.where(F.lower("html").rlike("<(article|main)[ >]")).select("html", F.xxhash64(F.lit(7), "html").alias("_h"))
    weights = learned_weights([r["html"] for r in marked.orderBy("_h", "html").limit(sample).collect()]) if sample else {"": 1.0}
    weights = weights if len(weights) > 1 else {"": 1.0}

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in batches:
            yield pd.Series([main_text(h, weights) for h in some], dtype=object)

    return pages.withColumn(name, extract(F.col("html")))


def op8_extraction(spark, sf_dir):
    pages = with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
