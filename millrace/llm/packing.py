"""Best-fit packing of tokenised documents by the linear grouping scheme."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import kept, ranked, table, trimmed
from millrace.session import written

#: Text whose splitting needs no Unicode tables; no quote (contractions) and no bracket (special tokens).
PLAIN = re.compile(r"[\n !-&(-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
SPLIT = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\n a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds(dict):
    """Little-endian unsigned 32-bit ids of the runs of letters, digits and other characters that the tokenizer splits plain text into.

    The tokenizer never joins over a space, so in a line with any other character what stands between spaces is encoded by itself
    (``runs``), in one call for a batch of texts. Beyond ``most`` entries a table begins anew and keeps the one
    before, from which those met again come back; the one before that goes, so the frequent ones stay.
    """

    def __init__(self, path: str, most: int = 50_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.tokenize = self.tokenizer.model.tokenize
        self.runs: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.runs_before: dict[str, bytes] = {}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7}

    def __missing__(self, run: str) -> bytes:
        ids = self.before.get(run)
        if ids is None:
            tokens = self.tokenize(run if run.isascii() else run.translate(self.as_bytes))
            ids = b"".join([t.id.to_bytes(4, "little") for t in tokens])
        self[run] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        """Ids of ASCII and accented Latin letters, which the tokenizer splits as ``SPLIT`` does."""
        return b"".join(map(self.__getitem__, SPLIT.findall(text.lower())))

    def _learn(self, parts: list[str]) -> None:
        odd = []
        for part in parts:
            if PLAIN.fullmatch(part):
                self.runs[part] = self._plain(part)
            else:
                odd.append(part)
        for at in range(0, len(odd), 20_000):
            some = odd[at : at + 20_000]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            of = np.array([len(some) if w is None else w for w in found.word_ids], np.int64)
            ends = np.searchsorted(of, np.arange(len(some)), "right").tolist()
            begin = 0
            for part, end in zip(some, ends, strict=True):
                self.runs[part] = ids[4 * begin : 4 * end]
                begin = end

    def of(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, a million characters at a time."""
        at = 0
        while at < len(texts):
            some, held = [], 0
            while at < len(texts) and (not some or held < 1_000_000):
                text = texts[at] or ""
                lines = [text] if PLAIN.fullmatch(text) else text.split("\n")
                some.append([line if PLAIN.fullmatch(line) else line.split(" ") for line in lines])
                held += len(text)
                at += 1
            if len(self.runs) > self.most:
                self.runs, self.runs_before = {}, self.runs
            new = {p for lines in some for line in lines if type(line) is list for p in line if p not in self.runs}
            known = new & self.runs_before.keys()
            self.runs.update((p, self.runs_before[p]) for p in known)
            self._learn(list(new - known))
            for lines in some:
                if len(self) > self.most:
                    self.before = dict(self)
                    self.clear()
                yield b"".join([self._plain(x) if type(x) is str else b"".join(map(self.runs.__getitem__, x)) for x in lines])


def word_ids(path: str) -> WordIds:
    """One table for all tasks of a worker process."""
    return kept(("words", path), lambda: WordIds(path))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, capacity: int, tokenizer: str) -> DataFrame:
    """One row for each run of at most ``capacity`` ids of a document, the closing id 0 included."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = word_ids(tokenizer)
        for batch in trimmed(batches):
            out = []
            for doc_id, of_text in zip(batch["doc_id"], ids.of(batch["text"].tolist()), strict=True):
                whole = of_text + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    out.append((None if pd.isna(doc_id) else int(doc_id), k, at // 4, len(part) // 4, zlib.crc32(part)))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(cut, PIECES)


def _configuration(sizes: list[int], left: list[int], first: int, capacity: int) -> Counter:
    """The fullest sequence that holds group ``first`` and further groups, each within its rest: a subset sum by bits."""
    room = capacity - sizes[first]
    reached, mask = [1], (1 << room + 1) - 1
    for g in range(first, len(sizes)):
        new = step = reached[-1]
        for _ in range(min(left[g] - (g == first), room // sizes[g])):
            step = (step << sizes[g]) & mask
            new |= step
        reached.append(new)
        if new >> room:
            break
    total, chosen = reached[-1].bit_length() - 1, Counter({first: 1})
    for k in range(len(reached) - 1, 0, -1):
        while not reached[k - 1] >> total & 1:
            total -= sizes[first + k - 1]
            chosen[first + k - 1] += 1
    return chosen


def plan(counts: dict[int, int], capacity: int, groups: int = 1024, small: int = 192) -> list[tuple[int, int, int, int, int, int]]:
    """Places for ``counts[length]`` pieces, as runs ``(length, rank, pieces, sequence, per sequence, offset)``.

    The work depends on the number of different lengths (``capacity`` at most), not on that of pieces. Lengths
    over ``small`` are cut into ``groups`` groups of equal count and rounded up to each group's largest;
    configurations of the rounded sizes are chosen, actual lengths take their places, and small lengths go where
    they fit best, into new sequences last.
    """
    runs: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[list[int]]] = defaultdict(list)  # unused ids: [sequence, sequences]
    large = sorted((n for n in counts if n > small), reverse=True)
    each = max(1, -(-sum(counts[n] for n in large) // groups))
    stock: list[list[list[int]]] = [[]]  # of a group: [length, rank, pieces]
    filled = 0
    for n in large:
        rank = 0
        while rank < counts[n]:
            take = min(counts[n] - rank, each - filled)
            stock[-1].append([n, rank, take])
            rank, filled = rank + take, filled + take
            if filled == each:
                stock.append([])
                filled = 0
    stock = [g for g in stock if g]
    sizes, left = [g[0][0] for g in stock], [sum(x[2] for x in g) for g in stock]
    sequence = 0
    for first in range(len(sizes)):
        while left[first]:
            chosen = _configuration(sizes, left, first, capacity)
            times = min(left[g] // k for g, k in chosen.items())
            slots = []
            for g, k in chosen.items():
                for _ in range(k):
                    slot, need = [], times
                    while need:
                        n, rank, have = stock[g][0]
                        take = min(need, have)
                        slot.append((n, rank, take))
                        stock[g][0] = [n, rank + take, have - take]
                        need -= take
                        if have == take:
                            stock[g].pop(0)
                    slots.append(slot)
                left[g] -= k * times
            ends = sorted({int(e) for slot in slots for e in np.cumsum([x[2] for x in slot])})
            at = 0
            for end in ends:
                offset = 0
                for slot in slots:
                    begin = 0
                    for n, rank, have in slot:
                        if begin <= at < begin + have:
                            runs.append((n, rank + at - begin, end - at, sequence + at, 1, offset))
                            offset += n
                            break
                        begin += have
                if offset < capacity:
                    room[capacity - offset].append([sequence + at, end - at])
                at = end
            sequence += times
    for n in sorted((n for n in counts if n <= small), reverse=True):
        rank, rest = 0, counts[n]
        while rest:
            fit = min((r for r in room if r >= n and room[r]), default=None)
            if fit is None:
                per = min(capacity // n, rest)
                fit, new = capacity, max(1, rest // per)
                room[capacity].append([sequence, new])
                sequence += new
            begin, have = room[fit].pop()
            per = min(fit // n, rest)
            take = min(have, rest // per)
            runs.append((n, rank, take * per, begin, per, capacity - fit))
            rank, rest = rank + take * per, rest - take * per
            if have > take:
                room[fit].append([begin + take, have - take])
            if fit - per * n:
                room[fit - per * n].append([begin, take])
    return runs


def packed(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset`` in as few sequences as the scheme finds.

    Null text is empty and gives one piece of one id (0). Documents alike each take a place; a null doc_id stays null.
    Lengths are counted by Spark; only their histogram (``capacity`` rows at most) reaches the driver, and the runs of
    the plan, a few for each length, go back to the tasks. Columns besides doc_id and text are not read.
    """
    spark = docs.sparkSession
    rows = written(pieces(docs, capacity, tokenizer or tokenizer_path()), "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = np.array(sorted(plan(counts, capacity)), dtype=np.int64).reshape(-1, 6)
    order = ["_h", "doc_id", "piece"]
    buckets = max(64, sum(counts.values()) // 2_000_000)
    hashed = rows.withColumn("_h", F.xxhash64("doc_id", "piece", "ids_crc32"))
    numbered = ranked(hashed, ["length"], F.pmod("_h", F.lit(buckets)), order)
    shared = spark.sparkContext.broadcast(runs)
    scale = max(counts.values(), default=0) + 1

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = shared.value
        keys = at[:, 0] * scale + at[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            run = at[np.searchsorted(keys, length * scale + rank, "right") - 1]
            step = rank - run[:, 1]
            batch["sequence_id"] = run[:, 3] + step // run[:, 4]
            batch["offset"] = run[:, 5] + step % run[:, 4] * length
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            yield batch.drop(columns="rank")

    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(place, PIECES + ", sequence_id long, offset long")


def op1_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))
