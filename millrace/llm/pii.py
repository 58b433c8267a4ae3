"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, table, trimmed
from millrace.session import written

# The base patterns, and words that name a secret. An email is found from its at sign, and an address from the
# beginning of a run of digits, where any match begins: no part of a text is read more than a few times.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LABELS = frozenset("token secret password passwd passphrase pwd apikey credential credentials".split())
KINDS = ("email", "ip", "card", "phone", "id")
#: What an unseen identifier can look like: it holds a digit or an at sign, or stands in quotes or after an equals sign. Runs
#: end at white space and punctuation.
QUOTED = re.compile(r"""(?<=["'`])[^\W\d_][\w./+-]*+(?=["'`])|(?<==)[^\W\d_][\w./+-]*+""")
TOKEN = re.compile(r"(?<![\w.:@/+-])(?:[^\W0-9]|[.:/+-])*+[0-9@][\w.:@/+-]*+")
EDGE = "._:@/+-"
IDENTIFIER = re.compile(r"[0-9@]")
#: Shorter values are no evidence for a context, and are marked only where they stand in a trusted one.
SHORT = 5
NEAR = re.compile(r"[^\W\d_]+")
#: What stands between a word and a value makes a pattern up to so many characters, white space counted as one.
BETWEEN = 6
#: Scores are whole multiples of this, so that they settle in a few rounds. (Fractions would rise by ever smaller parts.)
STEP = 0.05
#: Score of values that a label names: trusted, and below that of a base match.
LABELLED = 0.9
SPAN = "struct<kind:string,start:int,end:int,value:string,contexts:array<string>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind and start; a match that fails its test is dropped and not tried anew."""
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            last = found.end()
        at = text.find("@", max(at + 1, last))
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
                out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


class Words:
    """The places of the words of a text, and the lexical patterns around its spans."""

    def __init__(self, text: str):
        self.text = text
        self.places = [m.span() for m in NEAR.finditer(text)]
        self.starts, self.ends = [s for s, _ in self.places], [e for _, e in self.places]

    def contexts(self, start: int, end: int) -> list[str]:
        """Two words before, two after, and one on either side, however far away; one word and the punctuation next to the span."""
        last, first = bisect_right(self.ends, start), bisect_left(self.starts, end)
        left = [self.text[s:e].lower() for s, e in self.places[max(0, last - 2) : last]]
        right = [self.text[s:e].lower() for s, e in self.places[first : first + 2]]
        found = []
        if len(left) == 2:
            found.append("L " + " ".join(left))
        if len(right) == 2:
            found.append("R " + " ".join(right))
        if left and right:
            found.append(f"M {left[-1]} {right[0]}")
        if left and (gap := self._between(self.ends[last - 1], start)):
            found.append(f"l {left[-1]} {gap}")
        if right and (gap := self._between(end, self.starts[first])):
            found.append(f"r {gap} {right[0]}")
        return found

    def _between(self, start: int, end: int) -> str | None:
        """Punctuation between a word and a value, white space as one space; null without any, or with much of it."""
        marks = " ".join(self.text[start:end].split())
        return marks if 0 < len(marks) <= BETWEEN else None

    def labelled(self, start: int) -> bool:
        """Whether the word before names a secret and nothing but an equals sign or a colon, and quotes, follow it."""
        last = bisect_right(self.ends, start) - 1
        if last < 0 or self.text[slice(*self.places[last])].lower() not in LABELS:
            return False
        marks = "".join(self.text[self.ends[last] : start].split())
        return len(marks) <= BETWEEN and marks.strip("\"'`") in ("=", ":", ":=")


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Where values stand that may be identifiers, in order, none within another."""
    found = [(m.end() - len(v), m.end() - len(v) + len(v.rstrip(EDGE))) for m in TOKEN.finditer(text) if IDENTIFIER.search(v := m[0].lstrip(EDGE))]
    found += [(m.start(), m.start() + len(m[0].rstrip(EDGE))) for m in QUOTED.finditer(text)]
    last = 0
    for start, end in sorted(found):
        if start >= last and end > start:
            yield start, end
            last = end


def occurrences(text: str | None) -> list[dict]:
    """Base spans, and candidates that do not meet one: their kind is ``label`` where a word names them a secret, else empty."""
    text = text or ""
    spans, at = base_spans(text), 0
    taken = sorted((s, e) for _, s, e in spans)
    words = None
    for start, end in candidates(text):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at == len(taken) or taken[at][0] >= end:
            words = words or Words(text)
            spans.append(("label" if words.labelled(start) else "", start, end))
    words = words or (Words(text) if spans else None)
    return [{"kind": k, "start": s, "end": e, "value": text[s:e].lower(), "contexts": words.contexts(s, e)} for k, s, e in spans]


def trusted_patterns(edges: DataFrame, least: float = 0.8, support: int = 3) -> tuple[DataFrame, DataFrame]:
    """``(value)`` that trusted patterns hold and ``(pattern)`` that are trusted, from ``(value, pattern, seed)`` with seeds from 0 to 1.

    Each round, a pattern's confidence is the score of its values over their number plus one, if ``support`` trusted
    values stand in it, down to a whole ``STEP``; a value's score is the largest confidence of its patterns, and its seed at least. Values
    with scores of ``least`` or more are trusted in the next round. Scores never fall, and rise by whole steps; rounds go on until none does.
    """
    edges = written(edges.groupBy("value", "pattern").agg(F.max("seed").alias("seed")), "edges")
    seeds = edges.groupBy("value").agg(F.max("seed").cast("double").alias("score"))
    scores, last, stored = seeds, None, []
    while True:
        trust = F.when(F.col("score") >= least - 1e-9, F.col("score")).otherwise(0.0)
        patterns = (
            edges.join(scores, "value").groupBy("pattern")
            .agg((F.floor(F.sum(trust) / (F.count(F.lit(1)) + 1) / STEP + 1e-9) * STEP).alias("confidence"), F.count(F.when(F.col("score") >= least - 1e-9, 1)).alias("trusted"))
            .where((F.col("trusted") >= support) & (F.col("confidence") >= least - 1e-9))
        )
        patterns = written(patterns, "patterns")
        found = edges.join(patterns, "pattern").groupBy("value").agg(F.max("confidence").alias("found"))
        scores = seeds.join(found, "value", "left").select("value", F.greatest("score", F.coalesce("found", F.lit(0.0))).alias("score"))
        scores = written(scores, "scores", done=stored)
        stored = [patterns, scores]
        state = scores.where(F.col("score") >= least - 1e-9).agg(F.count(F.lit(1)), F.sum(F.col("score").cast("decimal(38,9)"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    values = scores.where(F.col("score") >= least - 1e-9).join(seeds.where("score < 1").select("value"), "value", "left_semi").select("value")
    return values, patterns.select("pattern")


def with_spans(docs: DataFrame, name: str = "spans") -> DataFrame:
    """All rows and columns and ``name``: the spans ``(kind, start, end)`` of personal data, by kind and start.

    The fixed patterns give the seeds, and so do values that a word of ``LABELS`` names (they are trusted a little less); what
    stands in the contexts of these has the kind ``id``, the labelled values among it. Code points count, the end is exclusive.
    Null text is empty; a text of any length and content is read in time proportional to it. The input is written once with a
    number for each row, so that repeated rows and null or repeated doc_ids stay apart. A column already called ``name`` is
    replaced; an empty table gives no rows.
    """

    @F.pandas_udf(f"array<{SPAN}>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        give_back()
        for texts in trimmed(batches):
            yield pd.Series([occurrences(t) for t in texts], dtype=object)

    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != name)).alias("row")
    rows = written(docs.select(F.monotonically_increasing_id().alias("id"), own, find(F.col("text")).alias("at")), "spans")
    at = rows.where(F.size("at") > 0).select("id", F.explode("at").alias("o")).select("id", "o.*")
    kind, seed = F.col("kind"), F.when(F.col("kind") == "", 0.0).when(F.col("kind") == "label", LABELLED).otherwise(1.0)
    new_kind = kind.isin("", "label")
    short = new_kind & (F.col("end") - F.col("start") < SHORT)
    at = at.withColumn("value", F.xxhash64("value"))
    pairs = at.where(~short).select("value", F.explode("contexts").alias("pattern"), seed.alias("seed"))
    accepted, patterns = trusted_patterns(pairs)
    span = F.struct("start", "end").alias("span")
    new = at.where(new_kind & ~short).join(accepted, "value", "left_semi").select("id", span)
    there = at.where(short).select("id", "start", "end", F.explode("contexts").alias("pattern")).join(patterns, "pattern", "left_semi")
    new = new.unionByName(there.select("id", span).distinct())
    new = new.groupBy("id").agg(F.array_sort(F.collect_list("span")).alias("new"))
    said = lambda o, kind: F.struct(kind.alias("kind"), o["start"].alias("start"), o["end"].alias("end"))
    base = F.transform(F.filter("at", lambda o: ~o["kind"].isin("", "label")), lambda o: said(o, o["kind"]))
    more = F.transform(F.coalesce("new", F.array().cast("array<struct<start:int,end:int>>")), lambda o: said(o, F.lit("id")))
    return rows.join(new, "id", "left").select("row.*", F.concat(base, more).alias(name))


def redacted(docs: DataFrame) -> DataFrame:
    """The rows with every span of personal data replaced by its kind in brackets; other columns as they are."""

    @F.pandas_udf("string")
    def replace(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans in batches:
            out = []
            for text, found in zip(texts, spans, strict=True):
                parts, at = [], 0
                for start, end, kind in sorted((s["start"], s["end"], s["kind"]) for s in found):
                    if start >= at:
                        parts += [text[at:start], f"[{kind.upper()}]"]
                    elif end > at:
                        parts.append("")
                    at = max(at, end)
                out.append("".join(parts) + text[at:] if text is not None and at else text)
            yield pd.Series(out, dtype=object)

    name = "found"
    while name in docs.columns:
        name += "_"
    return with_spans(docs, name).withColumn("text", replace(F.col("text"), F.col(name))).select(*(f"`{c}`" for c in docs.columns))


def op10_pii(spark, sf_dir):
    rows = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), "found")
    said = lambda a: F.array_join(F.transform(a, lambda o: F.concat_ws(":", o["kind"], o["start"].cast("string"), o["end"].cast("string"))), ",")
    of = lambda kind: F.filter("found", lambda o: o["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    base = F.filter("found", lambda o: o["kind"] != "id")
    return rows.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("found")).alias("spans"))
