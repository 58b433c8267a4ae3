"""Corpus operators against brute force, on small tables with nulls, empty texts, ties and clashing names."""

import math
import re
import time
import weakref
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import common, decontaminate, embeddings, extract, licenses, neardup, packing, pii, scoring, sharding, toxicity
from millrace.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank long, score double, fp string, n long"


@pytest.fixture(scope="module")
def docs(spark):
    draw = np.random.default_rng(1)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(draw.choice(words, 5 + k % 60)) for k in range(120)]
    texts += [texts[3]] * 40 + [None, "", "   ", "\n", "one", " ".join(draw.choice(words, 9000))]
    rows = [(k, t, None, "hot" if k % 3 else None, None, 1, 0.5, "x", 2) for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "null id here", *rows[0][2:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_sharding(docs, empty):
    rows = sharding.interleaved_shards(docs, 4).collect()
    assert len(rows) == docs.count() and sharding.interleaved_shards(empty, 4).count() == 0
    counts = Counter(r.shard for r in rows)
    assert set(counts) == {0, 1, 2, 3} and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)


def test_packing(docs, empty):
    rows = packing.packed(docs, 64).collect()
    assert packing.packed(empty, 64).count() == 0
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    expected = Counter()
    for d in docs.collect():
        ids = np.array(t.encode(d.text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        for k, at in enumerate(range(0, len(ids), 256)):
            part = ids[at : at + 256]
            expected[d.doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    assert len(held) <= 1.1 * -(-sum(r.length for r in rows) // 64) + 1


@pytest.mark.parametrize("text", ["it's a TEST <|endoftext|> x", "İstanbul ΑΣ ß ẞ ﬁ", "á b\xa0c　d\x1ce", "don't_stop ½ 12a ²", "ÀÉ÷×ÿ x'S"])
def test_word_ids(text):
    ids = packing.WordIds(packing.tokenizer_path())
    whole = ids.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(next(ids.of([text])), "<u4").tolist() == whole


def test_word_tables_stay_small():
    """Beyond its limit a table begins anew and gives the same ids; parts met again come back from the one before."""
    texts = [" ".join(f"often part{k}x{j}" for j in range(90)) for k in range(40)]
    small, large = packing.WordIds(packing.tokenizer_path(), most=50), packing.WordIds(packing.tokenizer_path())
    for text in texts:
        assert next(small.of([text])) == next(large.of([text]))
        assert max(map(len, (small, small.before, small.runs, small.runs_before))) <= 50 + 2 * 90 and "often" in small
    assert large.most <= 200_000


def test_word_tables_share_an_executor():
    """Two workers' tables fit beside the rest of an executor: 50,000 words each, whatever they met."""
    ids = packing.WordIds(packing.tokenizer_path())
    for k in range(0, 130_000, 1_000):
        list(ids.of([" ".join("".join(chr(97 + (j // 26**i) % 26) for i in range(4)) for j in range(k, k + 1_000))]))
        assert max(map(len, (ids, ids.before, ids.runs, ids.runs_before))) <= 52_000


def test_word_tables_hold_a_word_once():
    """However a plain word is written and what stands beside it; lines with other characters are split at spaces, the others not."""
    words = ["tokenwise", "größer", "forêt"]
    texts = [f"{w}{mark} {w.title()}{mark}\n({w.upper()}{mark})" for w in words for mark in ".,;:!?"] + ["Plain, größer.\nit's <odd> ΑΣ größer.\n\nforêt"]
    ids = packing.WordIds(packing.tokenizer_path())
    for text, got in zip(texts, ids.of(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids
    assert set(words) <= set(ids) and len(ids) < 30 and set(ids.runs) == {"it's", "<odd>", "ΑΣ", "größer."}


def closure(n, links):
    label = list(range(n))
    for _ in range(n):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_components(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 100), (200, 150), (150, 170)]
    got = {r.id: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(61)) and got[200] == got[170] == 150


def test_links_with_large_cells(spark):
    """More points in a cell than are paired: the links of the closure are still those of brute force."""
    draw, base = np.random.default_rng(2), 0x0123456789ABCDEF
    points = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in draw.integers(0, 64, (150, 2))}
    points |= {int(x) for x in draw.integers(0, 2**63, 60)}
    points |= {p ^ 3 for p in list(points)[:30]}
    points = sorted(points)
    links = [(i, j) for i in range(len(points)) for j in range(i) if (points[i] ^ points[j]).bit_count() <= 2]
    signed = [neardup._signed(p) for p in points]
    got = components(neardup.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long"))).collect()
    heads = {r.id: r.component for r in got}
    label = closure(len(points), links)
    groups = lambda names: {frozenset(k for k in range(len(points)) if names[k] == n) for n in names}
    assert groups([heads.get(s, s) for s in signed]) == groups(label)


def test_near_duplicates(docs, empty):
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == docs.count() and neardup.near_duplicates(empty).count() == 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {k: neardup.fingerprint(t) for k, t in texts.items()}
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" for r in rows)
    for r in rows:
        linked = [k for k, p in prints.items() if k is not None and (p ^ prints[r.doc_id]).bit_count() <= 2]
        assert r.doc_id is None or r.component_id <= min(linked)
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len({r.component_id for r in rows})
    assert neardup.one_of_each(empty).count() == 0


def test_decontamination(spark, docs, empty):
    base = [r.text for r in docs.where("doc_id in (20, 50)").collect()]
    item = " ".join(base[0].split()[2:24]) if len(base[0].split()) > 24 else base[0]
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "un seen words stand here today")], "item_id long, text string")
    near = item.upper().replace(" ", "\n", 3).replace(item.split()[-1].upper(), "changed")
    more = docs.unionByName(spark.createDataFrame([(900, "before " * 9 + near + " after", *[None] * 7)], SCHEMA))
    for block in (1, 100):
        got = {r.doc_id: r for r in decontaminate.with_passages(more, bench, block=block).collect()}
        assert got[900].found.item_ids == [1] and got[900].found.similarity >= 0.8
        hits = {k for k, r in got.items() if r.found.item_ids}
        assert hits == {r.doc_id for r in docs.collect() if item in (r.text or "")} | {900}
    assert decontaminate.with_passages(docs, bench.where("false")).where("size(found.item_ids) > 0").count() == 0
    assert decontaminate.with_passages(empty, bench).count() == 0


def test_base_spans():
    text = "a.b@c.de 1.2.3.4 no 256.1.1.1 card 4111 1111 1111 1111 call +1 (555) 123-4567 not 4111111111111112"
    got = {(k, text[s:e]) for k, s, e in pii.base_spans(text)}
    assert got == {("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("phone", "+1 (555) 123-4567")} | {("card", "4111 1111 1111 1111")}


def test_pii_finds_unseen(spark, docs, empty):
    rows = [(k, f"please write to user{k}@mail.example.org for help", *[None] * 7) for k in range(12)]
    rows += [(50, "please write to agent-7731-x for help", *[None] * 7), (51, "other words near agent9 stand", *[None] * 7)]
    many = spark.createDataFrame(rows, SCHEMA).unionByName(docs)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.with_spans(many).collect()}
    assert got[50] == [("id", 16, 28)] and got[51] == [] and got[3] and got[120] == []
    texts = {r.doc_id: r.text for r in pii.redacted(many).collect()}
    assert texts[50] == "please write to [ID] for help" and texts[160] is None
    assert pii.with_spans(empty).count() == 0


def test_embeddings(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(60, 8))
    near = np.concatenate([base + draw.normal(0, 0.1, base.shape) for _ in range(4)] + [np.tile(base[:1], (30, 1))])
    rows = [(k, v.tolist(), 0) for k, v in enumerate(near)]
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [None] * 8, [1.0, 2.0]]
    rows += [(1000 + k, v, None) for k, v in enumerate(odd)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embeddings.near_vectors(frame, per_cell=40, block=16).collect()}
    x = near / np.linalg.norm(near, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    expected = link.sum(axis=1) - 1
    found = np.array([got[k].n_links for k in range(len(near))])
    assert len(got) == len(rows) and (found <= expected).all() and found.sum() >= 0.9 * expected.sum()
    assert all(got[1000 + k].n_links == 0 and got[1000 + k].kept for k in range(len(odd)))
    assert embeddings.near_vectors(frame.where("false")).count() == 0


def test_extraction(spark):
    page = (
        "<html><head><title>T</title><script>var a='<p>x</p>';</script></head><body><nav><a>menu</a></nav><article><h1>A &amp; B</h1>"
        "<p>first  <b>words</b>\n here<br>and there<div class='ad'>buy</div><p>second block</article><div class=comments>no</div><footer>f</footer>"
    )
    frame = spark.createDataFrame([(1, "u", page, "t"), (2, "u", None, "t"), (3, None, "", None), (4, "u", "plain text", "t")], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in extract.with_main_text(frame).collect()}
    assert got == {1: "A & B\nfirst words here and there\nsecond block", 2: "", 3: "", 4: "plain text"}
    assert extract.with_main_text(frame.where("false")).count() == 0


def test_licenses(spark, empty):
    texts = ["Released under the MIT License.", "x\nAll rights reserved. ALL RIGHTS\nreserved", "released under a license", None, ""]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.with_licenses(frame).collect()}
    assert got[0].labels == "mit" and got[0].base_labels == "" and got[0].n_words == 5
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (2, 1, 4, "reserved")
    assert got[2].labels == got[3].labels == "" and got[4].first_word is None
    assert licenses.with_licenses(empty).count() == 0


def test_scoring(docs, empty):
    rows = scoring.scored(docs).collect()
    assert len(rows) == docs.count() and scoring.scored(empty).count() == 0
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = [(r.doc_id, [*re.findall(r"[^\x20\x09-\x0D]+", low(r.text)), None]) for r in docs.collect()]
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 5 == 1
    counts = Counter(w for k, t in tokens if not held(k) for w in t)
    n, v = sum(counts.values()), len(counts)
    expected = {k: (len(t), sum(counts[w] > 0 for w in t), sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) for k, t in tokens}
    for r in rows:
        assert (r.n_tokens, r.n_known) == expected[r.doc_id][:2] and r.train_tokens == n and r.held_out == held(r.doc_id)
        assert r.base_score == pytest.approx(expected[r.doc_id][2]) and r.score < 0


def test_scoring_holds_few_rows_at_a_time(spark):
    """A task gets a thousand texts at a time, unless the session says otherwise than Spark does by default."""
    name, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.createDataFrame([(k, f"some words {k}") for k in range(30)], "doc_id long, text string")
    try:
        for given, held in (("10000", "1000"), ("7", "7")):
            spark.conf.set(name, given)
            assert scoring.scored(docs).count() == 30 and spark.conf.get(name) == held
    finally:
        spark.conf.set(name, before)


def test_scoring_holds_few_rows_with_their_words(spark, monkeypatch):
    """Words and pairs that are not looked up are listed for two hundred texts at a time, in a batch of any size."""
    docs = spark.createDataFrame([(k, f"some words {k}") for k in range(450)], "doc_id long, text string").coalesce(1)
    kind, runs = type(docs), []
    plain = kind.mapInPandas
    monkeypatch.setattr(kind, "mapInPandas", lambda self, f, *rest: runs.append(f) or plain(self, f, *rest))
    assert scoring.scored(docs).where("score < 0").count() == 450
    batch = docs.toPandas().assign(_row=range(450), held_out=False, ids=[np.array([k, 0]) for k in range(450)])
    assert [len(out) for out in runs[-1](iter([batch]))] == [200, 200, 50]


def scoring_model(draw, n_texts=300):
    """Texts in two languages that share no id but the end: only ids further back tell which one follows the shared id 5."""
    texts = []
    for k in range(n_texts):
        words = np.stack([np.full(30, 5), draw.integers(10, 20, 30), draw.integers(20, 30, 30)], axis=1)
        texts.append(np.append((words + [0, 30 * (k % 2), 30 * (k % 2)]).ravel(), 0))
    counts = np.bincount(np.concatenate(texts), minlength=60).astype(float)
    before = np.concatenate([np.concatenate([[0], t[:-1]]) for t in texts])
    pairs, n = np.unique(np.stack([before, np.concatenate(texts)]), axis=1, return_counts=True)
    of = np.arange(60) // 10
    return texts, counts, (*pairs, n), scoring.Model(counts, of, (pairs[0], of[pairs[1]], n))


def test_scoring_model_is_a_distribution():
    """Classes and ids within their class sum to one; batched windows equal a place-by-place pass; each gradient is that of the loss."""
    draw = np.random.default_rng(6)
    texts, _, pairs, model = scoring_model(draw)
    model.p["c"] = draw.normal(0, 0.5, model.p["c"].shape).astype(np.float32)
    n = np.zeros((60, 60))
    n[pairs[0], pairs[1]] = pairs[2]
    inside = (n + model.within) / (model.after[:, model.of] + scoring.PRIOR)
    some = [texts[0], texts[1][:7], texts[2][:1], np.zeros(0, np.int64), np.tile(texts[3], 3)]
    for text, got in zip(some, model.scores(some), strict=True):
        expected = 0.0
        for s, first in scoring.windows(len(text)):
            ids = np.concatenate([[0], text])[s : s + scoring.CONTEXT]
            for place in range(first - s, min(scoring.CONTEXT, len(text) - s)):
                p = model.forward(ids[None, : place + 1])[-1][-1]
                p /= p.sum()
                assert (p[model.of] * inside[ids[place]]).sum() == pytest.approx(1, abs=1e-4)
                expected += math.log10(p[model.of[text[s + place]]])
        assert got == pytest.approx(expected, abs=1e-3)
    flat, of, begin, length = scoring.spans_of(some, [[(0, 0)] if len(t) else [] for t in some])[:4]
    ids, nxt, mask = scoring.inputs(flat, of, begin, length)

    def loss():
        out = model.forward(ids)[-1].astype(float)
        hit = out[np.arange(nxt.size), model.of[nxt].ravel()]
        return -(np.log(hit / out.sum(axis=1)) * mask.ravel()).sum() / mask.sum()

    model.p = {k: x.astype(np.float64) for k, x in model.p.items()}
    model.prior, model.cause, model.scale = model.prior.astype(float), model.cause.astype(float), float(model.scale)
    for name, grad in model.gradients(ids, nxt, mask).items():
        at = np.unravel_index(np.argmax(abs(grad)), grad.shape)
        held, step = model.p[name][at], 1e-4
        model.p[name][at] = held + step
        up = loss()
        model.p[name][at] = held - step
        slope = (up - loss()) / (2 * step)
        model.p[name][at] = held
        assert grad[at] == pytest.approx(slope, rel=2e-2, abs=1e-5)


def test_scoring_learns_what_pairs_cannot_tell():
    draw = np.random.default_rng(7)
    texts, _, _, model = scoring_model(draw)
    before = model.scores(texts[-40:]).sum()
    for _ in range(6):
        model.train_on([texts[:-40]], 0.02, batch=32)
    # The language halves the choices after each 5 but the first of a text.
    assert model.scores(texts[-40:]).sum() - before > 0.8 * 0.301 * 29 * 40


def test_most_frequent_keeps_its_bound(spark):
    counted = spark.createDataFrame([(k, 1 + k // 10) for k in range(500)], "pair long, n long")
    for most in (0, 1, 9, 25, 100, 500, 900):
        got = scoring.most_frequent(counted, most).collect()
        assert len(got) <= most and min((r.n for r in got), default=99) > max((n for n in range(51) if n not in {r.n for r in got} and n), default=0)
    assert scoring.most_frequent(counted, 500).count() == 500
    assert scoring.most_frequent(counted.where("false"), 5).count() == 0


def test_windows_score_each_place_once():
    for n in (1, 31, 32, 33, 56, 57, 200):
        places = [p for s, first in scoring.windows(n) for p in range(first, min(n, s + scoring.CONTEXT))]
        assert places == list(range(n))
        assert {p for s, e in toxicity.windows(n) for p in range(s, e)} == set(range(n))


def test_toxicity(spark, empty):
    draw = np.random.default_rng(4)
    words = [f"w{k}" for k in range(200)]
    texts, labels = [], []
    for k in range(500):
        text = list(draw.choice(words, 40 + k % 50))
        if k % 4 == 0:
            for at in range(5, len(text), 12):
                text[at] = "vile"
        texts.append(" ".join(text))
        labels.append(int(k % 4 == 0))
    frame = spark.createDataFrame([(k, t, 9) for k, t in enumerate([*texts, None, "", "w1 " * 9000])], "doc_id long, text string, score int")
    marks = spark.createDataFrame([*enumerate(labels), (0, 1), (None, 1)], "doc_id long, toxic int")
    net = toxicity.learned(frame, marks)
    got = {r.doc_id: r["_score"] for r in toxicity.with_toxicity(frame, net, "_score").collect()}
    held = [k for k in range(500) if zlib.crc32(str(k).encode()) % 3 == 1]
    right = sum((got[k] >= 0.7) == bool(labels[k]) for k in held)
    assert right >= 0.95 * len(held) and all(0 <= s <= 1 for s in got.values()) and len(got) == 503
    alone = toxicity.learned(frame, marks.where("false"))
    assert toxicity.with_toxicity(frame, alone, "_score").where(F.col("_score") >= 0.7).count() == 0
    assert toxicity.with_toxicity(empty.drop("score"), net).count() == 0


def test_toxicity_tables_share_an_executor():
    """A worker keeps some 50,000 words, and scores as one that keeps all."""
    draw = np.random.default_rng(4)
    words = [f"word{k}" for k in range(150_000)]
    texts = [" ".join(words[k : k + 500] + ["vile"] * (k % 3000 == 0)) for k in range(0, len(words), 500)]
    net = toxicity.train([" ".join([*draw.choice(words[:300], 40), *["vile"] * (k % 2)]) for k in range(200)], [k % 2 for k in range(200)], epochs=2)
    shared = type("Sent", (), {"id": "few words", "value": net})
    scorer, most = toxicity.scorer_of(shared), 0
    got = []
    for at in range(0, len(texts), 20):
        got.append(scorer.scores(texts[at : at + 20]))
        most = max(most, len(scorer.table))
    assert np.allclose(np.concatenate(got), toxicity.Scorer(net).scores(texts), atol=1e-5)
    assert most <= 65_536 and scorer.batch * toxicity.WINDOW * len(scorer.table[0]) * 4 < 4e6


def test_kept_tables_end_with_their_operator(spark):
    """An operator that keeps nothing gives back what the one before it in the same worker has kept."""
    docs = spark.createDataFrame([(k, f"some words {k}") for k in range(4)], "doc_id long, text string").coalesce(1)

    def ran(start):
        names = []
        plain = type(docs).mapInPandas
        type(docs).mapInPandas = lambda self, f, *rest: names.append(f) or plain(self, f, *rest)
        try:
            start()
        finally:
            type(docs).mapInPandas = plain
        return names[0]

    for run in (ran(lambda: neardup.shingle_order(docs)), ran(lambda: neardup.with_prefixes(docs.withColumnRenamed("doc_id", "_row"), 0.8))):
        common.kept(("table", "x"), lambda: [0] * 1_000)
        list(run(iter([docs.toPandas()])))
        assert not common._KEPT


def test_toxicity_holds_few_new_words():
    """Texts of which no word is known yet add no more words to a worker's table than it keeps, but for those of one batch."""
    net = toxicity.train([" ".join([f"w{k % 7}", *["vile"] * (k % 2)] * 5) for k in range(60)], [k % 2 for k in range(60)], epochs=2)
    texts = [" ".join(f"{k}x{q}" for q in range(500)) for k in range(500)]
    scorer = toxicity.Scorer(net, toxicity.KEPT, toxicity.WINDOWS)
    got = scorer.scores(texts)
    assert len(scorer.table) <= toxicity.KEPT + 1_000
    assert np.allclose(got[:20], toxicity.Scorer(net).scores(texts[:20]), atol=1e-5)


def test_workers_are_trimmed(monkeypatch):
    """A table that is made, and the end of a task, leave nothing in reserve; a batch is let go of before the next is read."""
    calls, alive = [], []
    monkeypatch.setattr(common, "trim", lambda: calls.append(1))
    common.kept(("table", "y"), lambda: [0])
    common.kept(("table", "y"), lambda: [0])
    assert len(calls) in (1, 2)
    common.kept(("table", "z"), lambda: [0])
    common.give_back()
    before = len(calls)

    def batches():
        for _ in range(3):
            batch = np.zeros(10)
            alive.append(weakref.ref(batch))
            yield batch
            del batch
            assert alive[-1]() is None

    rows = 0
    for batch in common.trimmed(batches()):
        rows += len(batch)
        del batch
    assert rows == 30 and before in (4, 5) and len(calls) == before + 1


def test_toxicity_reads_all_characters():
    """Trigrams beyond the tenth are learned, and those beyond character 40 are scored, in pieces that leave none out."""
    for n in (1, 40, 41, 70, 71, 500):
        word = "".join(chr(0x4E00 + k) for k in range(n))
        pieces = toxicity.words_of(word)
        assert {word[k : k + 3] for k in range(n)} == {g for p in pieces for k in range(len(p)) if len(g := p[k : k + 3]) == min(3, n)} | {word[-2:], word[-1:]}
        assert all(len(p) <= 40 for p in pieces)
    draw = np.random.default_rng(8)
    letters = list("abdefghijklmnoprstu")
    stem = lambda: "unterhaltungs" + "".join(draw.choice(letters, 8))
    texts = [" ".join(stem() + ("wqxy" if k % 2 and q % 3 == 0 else "") for q in range(25)) for k in range(300)]
    net = toxicity.train(texts[:200], [k % 2 for k in range(200)])
    got = toxicity.Scorer(net).scores(texts[200:])
    assert sum((s >= 0.5) == k % 2 for k, s in enumerate(got)) >= 95
    assert np.ptp(toxicity.Scorer(net).scores(["a" * 45 + "wqxy" * 5, "a" * 45 + "bcde" * 5])) > 0


def test_licenses_over_lines(spark):
    texts = [
        "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided",
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy",
        "released " + "words stand " * 20 + "under " + "and others " * 20 + "the " + "here " * 30 + "license",
        "Released\nunder the terms of\nthe MIT\nlicense",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.license.labels, r.license.score) for r in licenses.with_licenses(frame).collect()}
    assert got == {0: ("bsd", 1.0), 1: ("mpl-2.0", 1.0), 2: ("", 0.0), 3: ("mit", 0.8)}


def test_decontamination_of_shortened_items(spark):
    words = [f"q{k}" for k in range(39)]
    texts = [" ".join(words[:-1]), " ".join(words[2:]), " ".join(words[4:-3]), " ".join(words[5:-5]), " ".join(words)]
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.found.item_ids, r.found.similarity) for r in decontaminate.with_passages(frame, bench).collect()}
    expected = [34 / 35, 33 / 35, 28 / 35, 0, 1]
    assert got == {k: ([7] if x else [], pytest.approx(x)) for k, x in enumerate(expected)}


@pytest.mark.parametrize(("page", "expected"), [
    ("<body><div class='content-sidebar-wrap'><main><p>the whole text of this page</main><div class=sidebar>not this one</div></div>", "the whole text of this page"),
    ("<body><div class='site has-sidebar'><nav>a b c</nav><article><p>the whole text of this page</article></div>", "the whole text of this page"),
    ("<body><div class='site has-sidebar'><p>the whole text of this page</div><footer>f</footer>", "the whole text of this page"),
    ("<body><header>site</header><article><header class='entry-header'><h1>its title of seven words in all</h1></header><p>the whole text of this page</article>", "its title of seven words in all\nthe whole text of this page"),
    ("<body><form><main><p>the whole text of this page</main></form>", "the whole text of this page"),
    ("<body><article><p>the whole text of this page</article><div class=comments><article><p>an opinion of a reader on this</article></div>", "the whole text of this page"),
])
def test_extraction_of_wrapped_articles(page, expected):
    assert extract.main_text(page, {"": 1.0}) == expected


def found_by_patterns(text):
    """The base spans by the contract's patterns as they stand, tried at every place."""
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda t: 16 <= sum(map(str.isdigit, t)) <= 19 and pii.luhn(re.sub("[ -]", "", t))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 8 <= sum(map(str.isdigit, t)) <= 15),
    }
    return [(kind, m.start(), m.end()) for kind, (rule, fine) in rules.items() for m in re.finditer(rule, text) if fine(m[0])]


@given(st.text(st.sampled_from("0123456789aB.@+-% ()é_\n"), max_size=60))
@settings(max_examples=3000, deadline=None)
def test_pii_base_spans(text):
    assert pii.base_spans(text) == found_by_patterns(text)


@pytest.mark.parametrize("text", ["a" * 1_000_000 + " @", "1" * 1_000_000 + " .", "1." * 500_000, "a@" * 500_000, "+1" * 500_000, "+" + "1 " * 500_000 + "x", '="a' * 300_000, ". - " * 250_000 + "@1"])
def test_pii_of_long_texts(text):
    begun = time.process_time()
    assert len(pii.base_spans(text)) < 400_000 and sum(1 for _ in pii.candidates(text)) < 600_000
    assert time.process_time() - begun < 2


def test_pii_finds_labelled_secrets_and_what_stands_like_them(spark):
    """Words that name a secret are seeds; the punctuation around them finds what no label names, letters alone among it."""
    texts = [f'some words token = "{k:08x}beef{k}" and {k} more' for k in range(30)]
    texts += ['here token = "onlyletters" stands', 'plain "quoted" word', "the token is 7 long", "token ring 802"]
    texts += [f"bearer <{k:08x}beef{k}> once" for k in range(30)] + ["bearer <zz9unseen> once"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [r.text[s.start : s.end] for s in r.spans if s.kind == "id"] for r in pii.with_spans(frame).collect()}
    assert all(got[k] == [f"{k:08x}beef{k}"] for k in range(30)) and got[30] == ["onlyletters"]
    assert got[31] == got[32] == got[33] == [] and got[64] == ["zz9unseen"]


def test_vectors_of_any_length_link(spark):
    rows = [[1e200, 0, 0], [1e200, 1e198, 0], [1, 0, 0], [1e-200, 0, 0], [2e-200, 0, 0], [5e-324, 0, 0], [0, 1e-300, 0], [0, 0, 0]]
    frame = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(frame).collect()}
    assert all(got[k] == (5, 0) for k in range(6)) and got[6] == (0, 6) and got[7] == (0, 7)


def test_pii_takes_all_identifiers_with_digits(spark):
    """Whatever stands before them, of any length, and as many contexts away from a seed as it takes."""
    texts = [f"please write to user{k}@mail.example.org for help" for k in range(60)]
    odd = ["id=AB1234", "#A1234", "@user77", "A7", "x" * 300 + "9", "A1,", "été12345"]
    texts += [f"please write to {w} for help" for w in odd]
    hops = "alpha beta gamma delta epsilon zeta eta theta".split()
    for k, (x, y) in enumerate(zip(hops, hops[1:], strict=False)):
        # The seeds alone do not make a context trusted, they do together with the values of the context before.
        texts += [f"{w} {w} hop{k}x{v} {w} {w}" for w in (x, y) for v in range(10)]
    texts += [f"{w} {w} user{k}@mail.example.org {w} {w}" for w in hops for k in range(46)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [r.text[s.start : s.end] for s in r.spans if s.kind == "id"] for r in pii.with_spans(frame).collect()}
    assert [got[60 + k] for k in range(len(odd))] == [["AB1234"], ["A1234"], ["user77"], ["A7"], [odd[4]], ["A1"], [odd[6]]]
    assert [sum(len(got[67 + 20 * k + v]) for v in range(20)) for k in range(7)] == [20] * 7


def test_scoring_writes_ids_in_two_bytes(spark, monkeypatch):
    """Every pass over the ids reads one value of a row, which holds them all."""
    shapes, plain = {}, scoring.written
    monkeypatch.setattr(scoring, "written", lambda df, name, *a, **k: shapes.setdefault(name, plain(df, name, *a, **k)))
    texts = ["some words here", "caf\u00e9 \u4e2d\u6587 x" * 50, "", None]
    scoring.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    assert dict(shapes["encoded"].dtypes)["ids"] == "binary" and t.get_vocab_size() <= scoring.VOCABULARY < 1 << 16
    got = {r.doc_id: scoring.ids_of(r.ids).tolist() for r in shapes["encoded"].collect()}
    assert got == {k: [*t.encode(x or "", add_special_tokens=False).ids, 0] for k, x in enumerate(texts)}


def test_scoring_holds_for_large_weights():
    """Attention whose exponentials do not fit a float is shifted first; smaller weights need no shift."""
    texts, _, _, model = scoring_model(np.random.default_rng(3), 12)
    ids = np.stack([t[:32] for t in texts]).astype(np.int64)
    for k in "qk":
        model.p[k] = model.p[k] * np.float32(0.1)
    a = model.forward(ids)[4]
    q, k = ((model.p["ids"][model.own[ids]] + model.p["places"]) @ model.p[name] for name in "qk")
    exact = (q.astype(float) * model.scale) @ k.astype(float).transpose(0, 2, 1) + model.cause
    exact = np.exp(exact - exact.max(axis=2, keepdims=True))
    assert np.allclose(a, exact / exact.sum(axis=2, keepdims=True), atol=1e-6)
    for k in "qk":
        model.p[k] = model.p[k] * np.float32(3000)
    a = model.forward(ids)[4]
    assert np.allclose(a.sum(axis=2), 1, atol=1e-5) and np.isfinite(model.scores(texts)).all()


def test_scoring_counts_pairs_of_all_rows(spark, monkeypatch):
    """Pairs of ids over all training rows, frequent or joined, stand in the score; the layer is fitted to every place."""
    monkeypatch.setattr(scoring, "PAIRS", 30)
    monkeypatch.setattr(scoring, "class_of_ids", lambda counts, pairs: np.arange(scoring.VOCABULARY) % 7)
    draw = np.random.default_rng(9)
    words = "the of and to in is that for on with as by at from it an be this which or are was but not have had his her they one you were all we can has there been if more when will would who so no out up into".split()
    after = dict(zip(words, draw.permutation(words), strict=True))
    texts = []
    for k in range(700):
        text = [str(draw.choice(words))]
        while len(text) < 5 + k % 40:
            text.append(str(after[text[-1]] if draw.random() < 0.9 else draw.choice(words)))
        texts.append(" ".join(text))
    frame = spark.createDataFrame([*enumerate(texts), (5000, None)], "doc_id long, text string").repartition(3)
    rows = scoring.scored(frame).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    ids = {k: [*t.encode(x or "", add_special_tokens=False).ids, 0] for k, x in [*enumerate(texts), (5000, None)]}
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in ids}
    pairs = Counter(p for k, x in ids.items() if not held[k] for p in zip([0, *x], x, strict=False))
    singles = Counter(i for k, x in ids.items() if not held[k] for i in x)
    of_class, after, begins = [0.0] * 7, Counter(), Counter()
    for i in range(scoring.VOCABULARY):
        of_class[i % 7] += singles[i] + 0.5
    for (a, b), n in pairs.items():
        after[a, b % 7] += n
        begins[a] += n

    def by_pairs(a, b):
        """The class of b after a, and b in its class after a."""
        of = (after[a, b % 7] + 20 * of_class[b % 7] / sum(of_class)) / (begins[a] + 20)
        return math.log10(of) + math.log10((pairs[a, b] + 20 * (singles[b] + 0.5) / of_class[b % 7]) / (after[a, b % 7] + 20))

    for r in rows:
        x = ids[r.doc_id]
        assert r.score - r.attention_gain == pytest.approx(sum(by_pairs(a, b) for a, b in zip([0, *x], x, strict=False)), abs=1e-4 * len(x))
    new = [r for r in rows if r.held_out]
    assert len(rows) == 701 and sum(r.score for r in new) > 0.6 * sum(r.base_score for r in new)
    model = scoring_model(draw)[-1]
    assert model.train_on([[np.arange(5), np.arange(50)], [np.arange(33)]], 0.01) == 5
