"""License scans: exact containment join of word windows with templates, beside fixed phrases."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import lower_ascii, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices by label; a window that holds enough of a notice's words has its label.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by": "this work is licensed under a creative commons attribution license cc by",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "mit": "released under the mit license",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
FOUND = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


class Templates:
    """Templates as sets of words in order of frequency, rarest first.

    A template's window has its length over ``least``: as many words may stand between as may be missing.
    """

    def __init__(self, templates: dict[str, str], counts: dict[str, int], least: float):
        self.all: list[tuple[str, frozenset[str], int, int]] = []
        self.first: dict[str, list[int]] = {}
        for label, text in sorted(templates.items()):
            said = WORD.findall(lower_ascii(text))
            words = sorted(set(said), key=lambda w: (counts.get(w, 0), w))
            if words:
                need = math.ceil(least * len(words) - 1e-9)
                self.all.append((label, frozenset(words), need, math.ceil(len(said) / least - 1e-9)))
                for w in words[: len(words) - need + 1]:  # a window without any of these holds too few of the rest
                    self.first.setdefault(w, []).append(len(self.all) - 1)

    def found(self, words: list[str]) -> Iterator[tuple[str, float]]:
        """Labels with the largest share of their words in a window, if that is enough."""
        have = set(words)
        for k in {k for w in have & self.first.keys() for k in self.first[w]}:
            label, wanted, need, span = self.all[k]
            if len(wanted & have) < need:
                continue
            hits = [at for at, w in enumerate(words) if w in wanted]
            held: Counter = Counter()
            most, low = 0, 0
            for at in hits:
                held[words[at]] += 1
                while hits[low] <= at - span:
                    held[words[hits[low]]] -= 1
                    if not held[words[hits[low]]]:
                        del held[words[hits[low]]]
                    low += 1
                most = max(most, len(held))
            if most >= need:
                yield label, most / len(wanted)


def scan(text: str | None, templates: Templates) -> tuple:
    low = lower_ascii(text)
    words = WORD.findall(low)
    starts, base, labels, score = [], set(), set(), 0.0
    for phrase, label in PHRASES.items():
        want = phrase.split()
        if all(w in low for w in want):
            at = [k for k in range(len(words) - len(want) + 1) if words[k] == want[0] and words[k : k + len(want)] == want]
            if at:
                starts += at
                base.add(label)
                score = 1.0
    if any(w in low for w in templates.first):
        for label, share in templates.found(words):
            labels.add(label)
            score = max(score, share)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score


def with_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, name: str = "license") -> DataFrame:
    """All rows and columns and ``name``: words, places of the fixed phrases, labels, and the largest containment.

    Windows slide over the words of the whole text, whatever its line breaks. Words are ordered by their counts over all
    documents, rarest first; a text passes the prefix and count filters of a template, and the largest share of its
    words that a window holds is exact. Null and empty texts have no words and empty labels.
    """
    templates = templates or TEMPLATES
    wanted = {w for t in templates.values() for w in WORD.findall(lower_ascii(t))}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                total.update(w for w in WORD.findall(lower_ascii(text)) if w in wanted)
        yield pd.DataFrame({"word": pd.Series(list(total.keys()), dtype=object), "n": pd.Series(list(total.values()), dtype="int64")})

    counts = {r["word"]: r["n"] for r in docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    ordered = Templates(templates, counts, least)

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = pd.DataFrame([scan(t, ordered) for t in texts], columns=[c.split()[0] for c in FOUND.split(", ")])
            yield out.astype({"first_word": "Int64", "last_word": "Int64", "base_labels": object, "labels": object})

    return docs.withColumn(name, find(F.col("text")))


def op3_licenses(spark, sf_dir):
    return with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), name="found").select("doc_id", "found.*")
