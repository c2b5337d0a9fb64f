"""Benchmark decontamination: find benchmark items inside documents.

Items are cut to parts of at most ``PART_WORDS`` words.  Parts of similar
length form a class; over every document slides a window of the class's
length, one step per word, and each window gets a 64-bit SimHash of its
5-word shingles.  Four 16-bit blocks index the items' fingerprints: if two
fingerprints differ in at most ``RADIUS`` bits, one block differs in at most
``RADIUS // 4``, and the index lists every value that near, so no fingerprint
within the radius is missed.  Each candidate is then verified by the exact
similarity of the item and the best aligned window of the item's own length:
the larger of the plain and the weighted Jaccard.  A shingle of the item weighs
one over the number of items of the whole benchmark that hold it, any other
shingle as much as the item's shingles on average.

A document is handled whole inside one task and nothing is shuffled.  The
benchmark goes to the tasks in blocks of at most ``ITEMS_PER_PASS`` items,
one pass over the documents each, so its size needs no limit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import drop_saved, saved, shingle_hashes, word_hashes

N = 5                     # words per shingle
SIMILARITY = 0.8
PART_WORDS = 200          # a window's counts fit in 8-bit lanes
RADIUS = 15               # bits of 64
CLASS_RATIO = 1.1         # longest over shortest part of a class
ITEMS_PER_PASS = 5_000
_STEP = 1 << 16           # window positions handled at a time
_PIECE_BYTES = 4 << 20

_U = np.uint64
_ONES, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)


def _lane_sums(h: np.ndarray) -> list[np.ndarray]:
    """Running counts of set bits, eight 8-bit lanes to a number.  Lanes
    overflow in the running sums, but differences over up to 255 shingles
    are exact."""
    out = []
    for j in range(8):
        s = np.zeros(len(h) + 1, dtype=_U)
        np.cumsum((h >> _U(j)) & _ONES, out=s[1:])
        out.append(s)
    return out


def _simhash(sums: list[np.ndarray], w: int) -> np.ndarray:
    """SimHash of every run of ``w`` shingles: a bit is set if more than half have it."""
    shift = _U(127 - w // 2) * _ONES
    out = np.zeros(len(sums[0]) - w, dtype=_U)
    for j, s in enumerate(sums):
        d = s[w:] - s[:-w]
        d += shift
        d &= _TOPS
        d >>= _U(7 - j)
        out |= d
    return out


def _near_values(radius: int) -> np.ndarray:
    """All 16-bit patterns with at most ``radius`` bits."""
    v = np.arange(1 << 16, dtype=np.int64)
    return v[np.bitwise_count(v) <= radius]


def _item_shingles(text: str) -> np.ndarray:
    """Distinct shingles of a whole item."""
    return np.unique(shingle_hashes(word_hashes([text])[0], N))


class _Part:
    """An item's part ready for comparing: its distinct shingles, how often it
    has them, and their weights."""

    def __init__(self, h: np.ndarray, shared: np.ndarray, held: np.ndarray):
        self.keys, self.counts = np.unique(h, return_counts=True)
        self.size = len(h)
        self.weights = np.ones(len(self.keys))
        if len(shared):
            i = np.minimum(np.searchsorted(shared, self.keys), len(shared) - 1)
            self.weights = np.where(shared[i] == self.keys, 1.0 / held[i], 1.0)
        self.total = float((self.counts * self.weights).sum())

    def similarity(self, window: np.ndarray) -> float:
        """Larger one of the plain and the weighted Jaccard of the multisets."""
        keys, counts = np.unique(window, return_counts=True)
        _, i, j = np.intersect1d(keys, self.keys, assume_unique=True, return_indices=True)
        least = np.minimum(counts[i], self.counts[j])
        same = int(least.sum())
        if not same:
            return 0.0
        both = float((least * self.weights[j]).sum())
        more = float(((counts[i] - least) * self.weights[j]).sum()) + (len(window) - int(counts[i].sum())) * self.total / self.size
        return max(same / (len(window) + self.size - same), both / (self.total + more))


class _Class:
    """Item parts of similar length and the multi-index over their fingerprints."""

    def __init__(self, parts: list[tuple[int, np.ndarray]]):
        self.parts = parts
        self.w = len(parts[0][1])
        self.prints = np.array([int(_simhash(_lane_sums(h), len(h))[0]) for _, h in parts], dtype=_U)
        near = _near_values(RADIUS // 4)
        self.index = []
        for b in range(4):
            block = ((self.prints >> _U(16 * b)) & _U(0xFFFF)).astype(np.int64)
            value = (block[:, None] ^ near[None, :]).ravel()
            order = np.argsort(value, kind="stable")
            start = np.searchsorted(value[order], np.arange((1 << 16) + 1))
            self.index.append((np.diff(start) > 0, start, np.repeat(np.arange(len(parts)), len(near))[order]))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, part) pairs within the radius."""
        at, part = [], []
        for b, (some, start, parts) in enumerate(self.index):
            key = (prints >> _U(16 * b)).astype(np.uint16)
            i = np.flatnonzero(some[key])
            lo = start[key[i]]
            n = start[key[i].astype(np.int64) + 1] - lo
            row = np.repeat(i, n)
            which = parts[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
            close = np.bitwise_count(prints[row] ^ self.prints[which]) <= RADIUS
            at.append(row[close])
            part.append(which[close])
        pairs = np.unique(np.stack([np.concatenate(at), np.concatenate(part)], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]


class Benchmark:
    """The items of one pass, ready for searching.  ``shared`` has the shingles
    (sorted) that more than one item of the whole benchmark holds, ``held`` the
    number of those items."""

    def __init__(self, items: list[tuple[int, str]], shared: np.ndarray = np.empty(0, _U), held: np.ndarray = np.empty(0)):
        words, at = word_hashes([t for _, t in items])
        whole: list[tuple[int, np.ndarray]] = []
        self.short: dict[int, dict[int, list[int]]] = {}      # words -> hash -> items
        for k, (item, _) in enumerate(items):
            w = words[at[k]:at[k + 1]]
            if 0 < len(w) < N:
                self.short.setdefault(len(w), {}).setdefault(int(shingle_hashes(w, len(w))[0]), []).append(item)
            cuts = np.array_split(w, -(-len(w) // PART_WORDS)) if len(w) >= N else []
            whole += [(item, shingle_hashes(c, N)) for c in cuts]
        self.facts = {id(h): _Part(h, shared, held) for _, h in whole}
        whole.sort(key=lambda x: len(x[1]))
        self.classes: list[_Class] = []
        group: list[tuple[int, np.ndarray]] = []
        for p in whole:
            if group and len(p[1]) > CLASS_RATIO * len(group[0][1]):
                self.classes.append(_Class(group))
                group = []
            group.append(p)
        if group:
            self.classes.append(_Class(group))

    def _verify(self, doc: np.ndarray, at: int, part: np.ndarray, slack: int) -> tuple[float, int]:
        """Best similarity of ``part`` with a window of its length near ``at``."""
        m, facts = len(part), self.facts[id(part)]
        lo, hi = max(0, at - slack), min(len(doc), at + slack + m)
        ranked = np.sort(part)
        known = ranked[np.minimum(np.searchsorted(ranked, doc[lo:hi]), m - 1)] == doc[lo:hi]
        if known.sum() < SIMILARITY / 2 * m:
            return 0.0, 0
        run = np.concatenate(([0], np.cumsum(known)))
        last = max(lo, hi - m)
        best, where = 0.0, lo
        for s in range(lo, last + 1):
            e = min(len(doc), s + m)
            if run[e - lo] - run[s - lo] >= SIMILARITY / 2 * m:
                x = facts.similarity(doc[s:e])
                if x > best:
                    best, where = x, s
                if best == 1.0:
                    break
        return best, where

    def search(self, words: np.ndarray, at: np.ndarray) -> dict[tuple[int, int], tuple[float, int]]:
        """(text, item) -> (similarity, first word), over concatenated word hashes."""
        found: dict[tuple[int, int], tuple[float, int]] = {}
        doc_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
        for n, items in self.short.items():   # runs of the item's own length, verbatim
            if len(words) < n:
                continue
            h = shingle_hashes(words, n)
            for i in np.flatnonzero(np.isin(h, np.array(list(items), dtype=_U))):
                d = int(doc_of[i])
                if i + n <= at[d + 1]:
                    for item in items[int(h[i])]:
                        found.setdefault((d, item), (1.0, int(i - at[d])))
        if len(words) < N or not self.classes:
            return found
        h = shingle_hashes(words, N)          # those across two texts are in no window
        tried: set[tuple[int, int, int]] = set()

        def check(d: int, i: int, c: _Class, k: int) -> None:
            item, part = c.parts[k]
            slack = len(part) - c.w + 4
            spot = (d, id(part), i // (slack + 1))
            if spot in tried or found.get((d, item), (0.0, 0))[0] == 1.0:
                return
            tried.add(spot)
            own = h[at[d]:max(at[d], at[d + 1] - N + 1)]
            best, where = self._verify(own, i - int(at[d]), part, 2 * slack)
            if best >= SIMILARITY and best > found.get((d, item), (0.0, 0))[0]:
                found[(d, item)] = (best, where)

        widest = self.classes[-1].w
        for lo in range(0, len(h), _STEP):
            chunk = h[lo:lo + _STEP + widest]
            sums = _lane_sums(chunk)
            for c in self.classes:
                n = min(_STEP, len(chunk) - c.w + 1)
                if n <= 0:
                    continue
                whole = np.flatnonzero(doc_of[lo:lo + n] == doc_of[lo + c.w + N - 2:lo + n + c.w + N - 2])
                prints = _simhash([s[:n + c.w] for s in sums], c.w)[whole]
                for i, k in zip(*c.candidates(prints)):
                    check(int(doc_of[lo + whole[i]]), int(lo + whole[i]), c, int(k))
        size = np.diff(at) - N + 1
        for c in self.classes:                # a text shorter than the window is one window
            for d in np.flatnonzero((size > 0) & (size < c.w) & (size >= SIMILARITY * 0.5 * c.w)):
                own = h[at[d]:at[d] + size[d]]
                for _, k in zip(*c.candidates(_simhash(_lane_sums(own), len(own)))):
                    check(int(d), int(at[d]), c, int(k))
        return found


def _search(items: list[tuple[int, str]], shared: np.ndarray, held: np.ndarray):
    def run(batches):
        bench = Benchmark(items, shared, held)
        for pdf in batches:
            size = pdf["text"].str.len().fillna(0).cumsum().to_numpy() // _PIECE_BYTES
            for _, part in pdf.groupby(size, sort=True):
                ids = part["doc_id"].to_numpy()
                rows = [(ids[d], item, sim, first) for (d, item), (sim, first) in
                        bench.search(*word_hashes(part["text"].tolist())).items()]
                if rows:
                    yield pd.DataFrame(rows, columns=["doc_id", "item_id", "similarity", "first_word"])
    return run


def _shared_shingles(items: DataFrame) -> DataFrame:
    """Shingles that several items hold: their number ``n`` over the whole
    benchmark, and the passes in which they are needed."""
    def run(batches):
        for pdf in batches:
            for item, p, text in zip(pdf["item"], pdf["pass"], pdf["text"]):
                yield pd.DataFrame({"shingle": _item_shingles(text).view(np.int64)}).assign(item=item, **{"pass": p})

    rows = (items.select(F.xxhash64("item_id").alias("item"), "pass", "text")        # an item without an id counts too
            .mapInPandas(run, "shingle long, item long, pass long"))
    return (rows.groupBy("shingle").agg(F.countDistinct("item").alias("n"), F.collect_set("pass").alias("passes"))
            .where("n > 1"))


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row and benchmark item found in it: ``doc_id,
    item_id, similarity, first_word`` (place of the best window, in words).

    Null and wordless texts or items match nothing.  An item of fewer than
    5 words is found wherever a document has its words in sequence.  Of an item of over 200
    words each part is looked for.  A null id is kept; repeated rows give
    repeated results; other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    passes = max(1, -(-items.count() // ITEMS_PER_PASS))
    items = items.withColumn("pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)))
    shared = saved(_shared_shingles(items), "shingles")
    out = None
    for p in range(passes):
        block = [(r.item_id, r.text) for r in items.where(F.col("pass") == p).collect()]
        rows = shared.where(F.array_contains("passes", F.lit(p).cast("long"))).select("shingle", "n").collect()
        keys = np.array([r.shingle for r in rows], dtype=np.int64).view(_U)
        order = np.argsort(keys)
        search = _search(block, keys[order], np.array([r.n for r in rows], dtype=float)[order])
        found = docs.mapInPandas(search, "doc_id long, item_id long, similarity double, first_word long")
        out = found if out is None else out.union(found)
    drop_saved(df.sparkSession, shared)
    return out
