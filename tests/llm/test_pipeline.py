"""The pipeline on the smallest tables: each stage's decisions take effect and clean documents stay."""

import re

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import neardup
from millrace.llm.common import table
from millrace.session import written

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def groups(texts, least=0.8):
    """The smallest index of each text's group, by similarity of all pairs."""
    sets, label = [shingle_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if label[i] != label[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) - 1e-9:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, SF), name)
        assert docs.columns == columns, name
        counts.append(docs.count())
        if name == "near_dedup":
            given = sorted(before.select("doc_id", "text").collect())
            label = groups([r.text for r in given])
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {given[k].doc_id for k in set(label)}
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    full = packed.groupBy("sequence_id").sum("length").toDF("s", "n")
    assert full.where("n > 2048").count() == 0


def test_near_copies_of_0_8(spark):
    """One stays of each group by brute-force similarity of five-word shingles, planted copies from about 0.75 to 0.98 among them."""
    draw = np.random.default_rng(6)
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(draw.choice(words, int(n))) for n in draw.integers(100, 600, 40)]
    for base in range(30):
        for share in (0.005, 0.01, 0.02, 0.03):
            w = texts[base].split()
            for at in draw.permutation(len(w))[: max(1, int(share * len(w)))]:
                w[at] = "new"
            texts.append(" ".join(w))
    texts += [texts[0]] * 30 + ["common words stand in all of these texts " + " ".join(draw.choice(words, 30)) for _ in range(40)]
    label = groups(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, frame, SF).collect()}
    assert got == set(label) and 80 < len(got) < len(texts) - 100


def test_counts_bound_what_two_texts_share(spark, monkeypatch):
    """With few buckets, and counts that do not fit a byte, more pairs are compared and the same ones link."""
    draw = np.random.default_rng(1)
    words = [f"w{k}" for k in range(50)]
    texts = [" ".join(draw.choice(words, 700)) for _ in range(6)]
    texts += [t.replace("w7 ", "w8 ", 3) for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for cells in (0, 3, 9):
        monkeypatch.setattr(neardup, "CELLS", cells)
        assert {r.doc_id for r in neardup.one_of_each(frame).collect()} == set(groups(texts)) == set(range(6))


def test_near_copies_meet_in_the_grid(spark, monkeypatch):
    """The stage's first candidates come from the grid join of the fingerprints of five-word shingles; it joins all within two bits."""
    draw = np.random.default_rng(2)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(draw.choice(words, 400)) for _ in range(8)]
    texts += [re.sub(r"(?<= )w7 ", "other ", t) for t in texts] + [t + " end" for t in texts] + [None, "a b"]
    texts = list(dict.fromkeys(texts))
    prints = [neardup.majority(neardup.Shingles().of(t)) for t in texts]
    near = {(i, j) for j in range(len(texts)) for i in range(j) if bin(prints[i] ^ prints[j]).count("1") <= 2}
    assert len(near) >= 6
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    met, meet = [], neardup.near_pairs

    def seen(rows):
        out = meet(rows)
        met.extend((r.a, r.b) for r in out.collect())
        return out

    monkeypatch.setattr(neardup, "near_pairs", seen)
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, frame, SF).collect()}
    assert got == set(groups(texts))
    assert set(met) <= near and joined(met, len(texts)) == joined(near, len(texts))


def test_a_large_group_of_near_copies_is_joined_by_few_pairs(spark, monkeypatch):
    """About half the pairs of a group are links: turns join it long before all its pairs are compared."""
    draw = np.random.default_rng(8)
    words = [f"w{k}" for k in range(3000)]
    base, texts = draw.choice(words, 150), []
    for k in range(300):
        w = base.copy()
        w[draw.permutation(150)[: 1 + k % 4]] = f"new{k}"
        texts.append(" ".join(w))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    compared, similar = [], neardup.similar

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return similar(pairs, *rest)

    monkeypatch.setattr(neardup, "similar", counted)
    assert {r.doc_id for r in neardup.one_of_each(frame).collect()} == set(groups(texts))
    assert sum(compared) < 45 * len(texts)  # 28,361 pairs, if all those of a cell are compared at once


def joined(pairs, n):
    """The smallest index that each one is joined with."""
    label = list(range(n))
    for i, j in pairs:
        low, high = sorted((label[i], label[j]))
        label = [low if x == high else x for x in label]
    return label


ODD = "doc_id long, text string, lang string, row struct<a:int>, _row long, found string, toxicity double, passages int, r long, cell string"


@pytest.mark.parametrize("rows", [0, 40])
@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_tables(spark, rows, name, stage):
    """Nulls, empty, equal and very long texts, repeated rows and ids, and columns named as a stage might name its own."""
    plain = " ".join(f"plain{k}" for k in range(60))
    texts = [None, "", " \n", "x", plain, plain, "y" * 200_000, "1" * 100_000 + " @", " ".join(f"long{k % 997}x{k}" for k in range(60_000))]
    given = [(k, texts[k % len(texts)], None, (k,), 1, "f", 0.9, 2, 3, "c") for k in range(20)]
    given += [given[4], given[4], (None, "no id here", *given[0][2:]), (None, None, *given[0][2:])]
    docs = spark.createDataFrame(given[:rows], ODD).repartition(3)
    kept = stage(spark, docs, SF)
    got = kept.collect()
    if name == "packing":
        assert sum(r.length for r in got) > 60_000 if rows else got == []
        return
    assert kept.columns == docs.columns
    assert all(r._row == 1 and r.found == "f" and r.toxicity == 0.9 and r.passages == 2 and r.cell == "c" and r.r == 3 for r in got)
    if name == "near_dedup":
        distinct = {str(shingle_set(r[1])) for r in given[:rows]}
        assert len(got) == len(distinct)
    else:
        assert len(got) == min(rows, len(given))
