"""Near-duplicate groups by an exact n-gram Jaccard join with PartEnum signatures.

A text's set holds its distinct n-word shingles.  Two texts link when
``100 * |intersection| >= similarity * |union|``; linked texts form groups.

Method: sets are put in size bands.  For a band the largest possible Hamming
distance ``k`` of a linking pair follows from the similarity.  The hash domain
is cut into ``n1`` groups of ``n2`` partitions, so that at least one group has
at most ``k2`` partitions that differ (``n1 * (k2 + 1) > k``); the signatures
of a set are the contents of every choice of ``n2 - k2`` partitions of every
group.  Every linking pair shares a signature; nothing is probabilistic but
64-bit hashes standing for shingles and sets.

Empty choices would put unrelated sets together, so they are not emitted.
There are ``spare`` more groups than needed, so every linking pair agrees in
more than ``spare`` groups; a set with empty choices in more than that many
groups repeats the partitioning under another hash, as any partner that agrees
with it only there must do too (the last repetition emits empty choices).

Equal sets are one node from the start.  In each shared signature the nodes
are first held against the signature's smallest node only (of signatures with the
same nodes one stands for all).  Where a signature
still has several groups after that, the groups are held against each other, in
blocks of bounded size: 2048-bit parity sketches give a lower bound of the
Hamming distance of their sets, and where it cannot exclude a link the sets
themselves are compared so.  Of the pairs left a block gives out a spanning forest
of its groups, not all of them; they are verified, and signatures in which one of
them does not link go on without it.  So no link that could join two groups
is lost, and no group's pairs are written out.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import drop_saved, mix64, release, saved, shingle_hashes, word_hashes
from souk.llm.components import connected_components

BAND_RATIO = 1.5        # upper over lower end of a size band
SPARE = 5               # one spare group for as many needed ones
REPEATS = 8             # partitionings tried for sets with an empty choice
BITMAP_BITS = 27        # largest size of the filter of shared signatures (16 MB)
BITMAP_LEAST = 16
BITMAP_SPARSE = 128     # bits for a signature, up to that size
BROADCAST_IDS = 1_000_000   # ids (8 bytes each) that may be broadcast; checked by a count
BLOCK = 2_000           # nodes of a signature that are held against each other at a time
FEW = 64                # entries of a block up to which it is held against itself with others
SKETCH_WORDS = 32       # 64-bit words of a parity sketch
MORE_FORESTS = 64       # spanning forests of a signature's groups in the second round
FOLD = 4                # sketches are folded to a part of their words where all entries are moved
_SEEN_MAX = 200_000     # set keys a task remembers, to emit copies once

_U = np.uint64


def band_starts(limit: int) -> list[int]:
    """Lower ends of the size bands up to ``limit``."""
    starts = [1]
    while starts[-1] <= limit:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND_RATIO)))
    return starts


_STARTS = np.array(band_starts(1 << 40), dtype=np.int64)


def band_of(size: int) -> int:
    return int(np.searchsorted(_STARTS, size, side="right")) - 1


def hamming_bound(band: int, similarity: int) -> int:
    """Largest symmetric difference of a linking pair whose larger set is in ``band``."""
    upper = int(_STARTS[band + 1]) - 1
    return (100 - similarity) * 2 * upper // (100 + similarity)


@lru_cache(maxsize=256)
def _edges(parts: int) -> np.ndarray:
    return np.arange(1, parts, dtype=_U) * _U((1 << 64) // parts)


def signatures(s: np.ndarray, similarity: int, n2: int, k2: int, slice_: int = 0, slices: int = 1) -> np.ndarray:
    """All PartEnum signatures of one set (sorted distinct uint64 hashes); of
    several ``slices``, those of every ``slices``-th group, so that each
    signature is in one slice."""
    size = len(s)
    out = []
    choices = list(combinations(range(n2), n2 - k2))
    for band in range(band_of(size), band_of(100 * size // similarity) + 1):
        k = hamming_bound(band, similarity)
        if k == 0:          # only equal sets link, and those are one node already
            continue
        n1 = -(-(k + 1) // (k2 + 1))
        spare = 1 + n1 // SPARE
        n1 += spare
        for turn in range(REPEATS):
            v = s if turn == 0 else np.sort(mix64(s + _U(turn)))
            cut = np.concatenate(([0], np.searchsorted(v, _edges(n1 * n2)), [size]))
            run = np.concatenate((np.zeros(1, dtype=_U), np.cumsum(mix64(v ^ _U(0x5DEECE66D)))))
            sums, counts = np.diff(run[cut]).reshape(n1, n2), np.diff(cut).reshape(n1, n2)
            empty = np.zeros(n1, dtype=bool)
            mine = slice(slice_, None, slices)
            place = np.arange(n1, dtype=_U)[mine] * _U(64) + _U((band * REPEATS + turn) << 40)
            for c, choice in enumerate(choices):
                sig = mix64(sums[mine][:, choice].sum(axis=1, dtype=_U) * _U(0x9E3779B97F4A7C15) + mix64(place + _U(c)))
                full = counts[:, choice].sum(axis=1) > 0
                empty |= ~full
                out.append(sig[full[mine]] if turn < REPEATS - 1 else sig)
            if empty.sum() <= spare:
                break
    return np.concatenate(out) if out else np.empty(0, dtype=_U)


def _sets(texts: list, n: int):
    """Per text: sorted distinct shingle hashes."""
    words, at = word_hashes(texts)
    for i in range(len(texts)):
        yield np.unique(shingle_hashes(words[at[i]:at[i + 1]], n))


def _key(s: np.ndarray) -> int:
    """One 64-bit number for a set."""
    return int(mix64(mix64(s + _U(0xA24BAED4963EE407)).sum(dtype=_U, keepdims=True) + _U(len(s))).astype(np.int64)[0])


def _pieces(pdf: pd.DataFrame, bytes_most: int = 1 << 20):
    """The batch in runs of bounded text size."""
    size = pdf["text"].str.len().fillna(0).cumsum().to_numpy() // bytes_most
    for _, part in pdf.groupby(size, sort=True):
        yield part


def _keys(n: int):
    def run(batches):
        for pdf in batches:
            for part in _pieces(pdf):
                sets = list(_sets(part["text"].tolist(), n))
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(),
                    "n_shingles": np.array([len(s) for s in sets], dtype=np.int64),
                    "set_key": pd.array([_key(s) if len(s) else None for s in sets], dtype="Int64"),
                })
    return run


def _bitmap(shared: DataFrame) -> bytes:
    """Bits (a power of two, ``2**BITMAP_BITS`` at most), set where a shared signature
    may be: a filter that leaves out most unshared signatures before they are moved."""
    wanted = (BITMAP_SPARSE * shared.count()).bit_length()
    size = min(max(wanted, BITMAP_LEAST), BITMAP_BITS)
    low = size - 8
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << low, dtype=np.uint8)
        bits[pdf["spot"].to_numpy() & ((1 << low) - 1)] = 1
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "bits": [np.packbits(bits).tobytes()]})

    spots = shared.select(F.shiftrightunsigned("sig", 64 - size).alias("spot")).distinct()
    parts = (spots.withColumn("part", F.shiftright("spot", low).cast("int")).groupBy("part")
             .applyInPandas(pack, "part int, bits binary").collect())
    found = {r.part: bytes(r.bits) for r in parts}
    del parts
    return b"".join(found.pop(i, bytes(1 << low - 3)) for i in range(256))


def _signature_rows(n: int, similarity: int, n2: int, k2: int, bitmap=None, slice_: int = 0, slices: int = 1):
    """Signatures (of one of the slices) with their set's key; with a (broadcast) bitmap only those it has."""
    def run(batches):
        keep = None if bitmap is None else np.frombuffer(bitmap.value, dtype=np.uint8)
        unused = None if bitmap is None else _U(64 + 1 - (8 * len(keep)).bit_length())
        seen: set[int] = set()
        for pdf in batches:
            for part in _pieces(pdf):
                sig, key = [], []
                for s in _sets(part["text"].tolist(), n):
                    k = _key(s) if len(s) else None
                    if k is None or k in seen:
                        continue
                    if len(seen) >= _SEEN_MAX:
                        seen.clear()
                    seen.add(k)
                    got = signatures(s, similarity, n2, k2, slice_, slices)
                    if keep is not None:
                        spot = (got >> unused).astype(np.int64)
                        got = got[(keep[spot >> 3] >> (7 - (spot & 7)) & 1).astype(bool)]
                    sig.append(got.astype(np.int64))
                    key.append(np.full(len(got), k, dtype=np.int64))
                if sig:
                    yield pd.DataFrame({"sig": np.concatenate(sig), "set_key": np.concatenate(key)})
    return run


def _sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the number of elements per bin, as 64-bit words; two sets'
    sketches differ in at most as many bits as the sets differ in elements."""
    spot = (mix64(s ^ _U(0x3C6EF372FE94F82B)) % _U(SKETCH_WORDS * 64)).astype(np.int64)
    odd = (np.bincount(spot, minlength=SKETCH_WORDS * 64) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _set_rows(n: int):
    """Sets of the wanted nodes; a row whose text is not the node's is left out."""
    def run(batches):
        for pdf in batches:
            for part in _pieces(pdf):
                rows = [(k, len(s), s.astype(np.int64), _sketch(s)) for k, s in
                        zip(part["set_key"].tolist(), _sets(part["text"].tolist(), n)) if _key(s) == k]
                yield pd.DataFrame(rows, columns=["set_key", "size", "shingles", "sketch"])
    return run


def _folded(facts: DataFrame, words: int) -> DataFrame:
    """``facts`` with sketches of a ``FOLD``-th of the ``words``: bins that fall on
    one another are one bin, whose parity is that of their bits together."""
    short = words // FOLD
    return facts.withColumn("sketch", F.array(*[
        reduce(lambda x, y: x.bitwiseXOR(y), [F.get("sketch", j) for j in range(i, words, short)]) for i in range(short)]))


def _possible(pairs: DataFrame, facts: DataFrame, similarity: int, words: int) -> DataFrame:
    """The pairs ``(a, b)`` of set keys that sizes and sketches (``facts``:
    ``set_key, size, sketch``) cannot exclude, as a stored table.  Every pair is
    moved with folded sketches only, those left with whole ones."""
    some = _near(pairs, _folded(facts, words), similarity, words // FOLD)
    release(pairs.sparkSession)
    out = _near(some, facts, similarity, words)
    drop_saved(pairs.sparkSession, some)
    return out


def _near(pairs: DataFrame, facts: DataFrame, similarity: int, words: int) -> DataFrame:
    """The pairs that sizes and sketches of so many ``words`` cannot exclude, as a stored table."""
    if 2 * pairs.count() <= BROADCAST_IDS:          # else most sets are an end
        facts = _of_ends(pairs, facts, "set_key")
    left = facts.select(F.col("set_key").alias("a"), F.col("size").alias("na"), F.col("sketch").alias("ta"))
    right = facts.select(F.col("set_key").alias("b"), F.col("size").alias("nb"), F.col("sketch").alias("tb"))
    apart = sum((F.bit_count(F.get("ta", i).bitwiseXOR(F.get("tb", i))) for i in range(words)), F.lit(0))
    return saved(pairs.join(left, "a").join(right, "b")
                 .where(100 * F.least("na", "nb") >= similarity * F.greatest("na", "nb"))
                 .where(apart * (100 + similarity) <= (100 - similarity) * (F.col("na") + F.col("nb")))
                 .select("a", "b").distinct(), "possible")


def _of_ends(pairs: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The rows of ``table`` whose ``key`` is an end of one of the pairs."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias(key)).distinct()
    return table.join(F.broadcast(ends) if 2 * pairs.count() <= BROADCAST_IDS else ends, key)


def _verified(possible: DataFrame, sets: DataFrame, similarity: int) -> tuple[DataFrame, DataFrame]:
    """Of the (stored) pairs ``(a, b)`` of set keys that sketches cannot exclude, those that
    link by exact intersection, and the others.  Only the sets of these pairs are moved."""
    ends = _of_ends(possible, sets.select("set_key", "shingles"), "set_key")
    left = ends.select(F.col("set_key").alias("a"), F.col("shingles").alias("sa"))
    right = ends.select(F.col("set_key").alias("b"), F.col("shingles").alias("sb"))
    links = saved(possible.join(left, "a").join(right, "b")
                  .withColumn("shared", F.size(F.array_intersect("sa", "sb")))
                  .where(100 * F.col("shared") >= similarity * (F.size("sa") + F.size("sb") - F.col("shared")))
                  .select("a", "b"), "verified")
    return links, _refuted(possible, links)


def _refuted(possible: DataFrame, links: DataFrame) -> DataFrame:
    """The possible pairs that do not link; ``possible`` is dropped."""
    out = saved(possible.join(links, ["a", "b"], "left_anti"), "refuted")
    drop_saved(possible.sparkSession, possible)
    return out


def _by_block(each, few, names: list[str]):
    """``each`` on the columns (arrays) of every (signature, block, block) of a
    table sorted by them; it gives rows of ``names``.  Blocks of at most ``FEW`` entries
    that face themselves go to ``few`` together, with the place at which each entry's block ends."""
    def run(batches):
        rest, by = None, ["sig", "bi", "bj"]

        def found(pdf: pd.DataFrame, cut: np.ndarray) -> pd.DataFrame:
            cols, count = {c: pdf[c].to_numpy() for c in pdf.columns}, np.diff(cut)
            small = (count <= FEW) & (cols["bi"][cut[:-1]] == cols["bj"][cut[:-1]])
            rows = [r for x, y in zip(cut[:-1][~small], cut[1:][~small]) for r in each({c: v[x:y] for c, v in cols.items()})]
            out = [np.array(rows, dtype=np.int64).reshape(-1, len(names))]
            if small.any():
                mine, count = np.repeat(small, count), count[small]
                out.append(few({c: v[:cut[-1]][mine] for c, v in cols.items()}, np.repeat(np.cumsum(count), count)))
            return pd.DataFrame(np.concatenate(out), columns=names)

        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            at = pdf[by].to_numpy()
            cut = np.concatenate(([0], np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1))
            rest = pdf.iloc[cut[-1]:]                # at most two blocks
            if len(cut) > 1:
                yield found(pdf, cut)
        if rest is not None and len(rest):
            yield found(rest, np.array([0, len(rest)]))
    return run


def _pairs_within(end: np.ndarray, near) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of places (i, j), i < j, of one block that are ``near``; all
    entries are held against the next ones of their blocks together."""
    at, d, left, right = np.arange(len(end)), 1, [], []
    while len(at := at[at + d < end[at]]):
        ok = near(at, at + d)
        left.append(at[ok])
        right.append(at[ok] + d)
        d += 1
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _bits(sketches) -> np.ndarray:
    """Sketches as rows of unsigned words (numpy counts the bits of a negative
    number's absolute value)."""
    return np.stack(list(sketches)).astype(np.int64).view(_U)


def _facing(p: dict) -> tuple[np.ndarray, bool]:
    """Which entries are of the first block, and whether the second is the same."""
    return p["side"] == p["bi"], bool(p["bi"][0] == p["bj"][0])


def _undecided(similarity: int):
    """``(sig, label)`` of the groups of a block that the sketches cannot tell
    apart from every other one: a bit that all sets of one group have
    (``every``) and none of the other's (``some``; null for a single set) tells
    each pair of their sets apart."""
    def each(p: dict):
        key, size = p["key"], p["size"]
        mine, same = _facing(p)
        every = _bits(p["every"])
        some = _bits(e if s is None else s for e, s in zip(p["every"], p["some"]))
        undecided = np.zeros(len(key), dtype=bool)
        for i in np.flatnonzero(mine):
            other = np.flatnonzero(key > key[i] if same else ~mine)
            if undecided[i]:
                other = other[~undecided[other]]
            if not len(other):
                continue
            apart = (every[other] & ~some[i]) | (every[i] & ~some[other])
            least = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
            near = other[least * (100 + similarity) <= (100 - similarity) * (size[other] + size[i])]
            undecided[near] = True
            undecided[i] |= len(near) > 0
        return [(p["sig"][0], k) for k in key[undecided]]

    def few(p: dict, end: np.ndarray) -> np.ndarray:
        key, size = p["key"], p["size"]
        every = _bits(p["every"])
        some = _bits(e if s is None else s for e, s in zip(p["every"], p["some"]))

        def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            least = np.bitwise_count((every[j] & ~some[i]) | (every[i] & ~some[j])).sum(axis=1, dtype=np.int64)
            return (least * (100 + similarity) <= (100 - similarity) * (size[j] + size[i])) & (key[i] != key[j])

        at = np.unique(np.concatenate(_pairs_within(end, near)))
        return np.column_stack((p["sig"][at], key[at]))
    return _by_block(each, few, ["sig", "label"])


def _forests(similarity: int, forests: int):
    """``(sig, a, b)``: of the pairs of sets in different groups of a block that
    sizes and sketches cannot exclude and that are not known to be ``refuted``, so
    many as make ``forests`` spanning forests of the groups.  If all of the first
    link, every other such pair is joined by them."""
    def each(p: dict):
        key, size, sketch = p["key"], p["size"], _bits(p["sketch"])
        mine, same = _facing(p)
        gone: list[set] = [set() for _ in key]
        place = {k: i for i, k in enumerate(key.tolist())}
        for i, keys in enumerate(p["refuted"]):
            for j in () if keys is None else (place[k] for k in keys.tolist() if k in place):
                gone[i].add(j)
                gone[j].add(i)
        start = np.unique(p["label"], return_inverse=True)[1]

        def near(i: int, group: np.ndarray) -> np.ndarray:
            other = np.flatnonzero((group != group[i]) & (key > key[i] if same else ~mine))
            if gone[i]:
                other = other[~np.isin(other, list(gone[i]))]
            if not len(other):
                return other
            apart = np.bitwise_count(sketch[other] ^ sketch[i]).sum(axis=1, dtype=np.int64)
            return other[(apart * (100 + similarity) <= (100 - similarity) * (size[other] + size[i]))
                         & (100 * np.minimum(size[other], size[i]) >= similarity * np.maximum(size[other], size[i]))]

        rows = np.flatnonzero(mine)
        left = {i: n for i in rows if len(n := near(i, start))} if forests > 1 else {}       # sketches are compared once for all forests
        out = []
        for _ in range(forests):
            tree, before = start.copy(), len(out)
            for i in rows if forests == 1 else list(left):
                other = near(i, tree) if forests == 1 else left[i][tree[left[i]] != tree[i]]
                used = []
                while len(other):
                    j = other[0]
                    out.append((p["sig"][0], min(key[i], key[j]), max(key[i], key[j])))
                    used.append(j)
                    tree[tree == tree[j]] = tree[i]
                    other = other[tree[other] != tree[i]]
                if used and forests > 1:
                    left[i] = left[i][~np.isin(left[i], used)]
            if len(out) == before:
                break
        return out

    def few(p: dict, end: np.ndarray) -> np.ndarray:
        key, size, label, sketch = p["key"], p["size"], p["label"], _bits(p["sketch"])

        def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            ok = (label[i] != label[j]) & (key[i] != key[j]) & (100 * np.minimum(size[j], size[i]) >= similarity * np.maximum(size[j], size[i]))
            i, j = i[ok], j[ok]
            apart = np.bitwise_count(sketch[j] ^ sketch[i]).sum(axis=1, dtype=np.int64)
            ok[ok] = apart * (100 + similarity) <= (100 - similarity) * (size[j] + size[i])
            return ok

        i, j = _pairs_within(end, near)
        gone = {x: set(p["refuted"][x].tolist()) for x in np.unique(np.concatenate((i, j))).tolist() if p["refuted"][x] is not None}
        left = [(x, y) for x, y in sorted(zip(i.tolist(), j.tolist()))
                if not (x in gone and key[y] in gone[x]) and not (y in gone and key[x] in gone[y])]
        group = np.unique(np.column_stack((end, label)), axis=0, return_inverse=True)[1].ravel().tolist()
        out: list[tuple[int, int]] = []
        for _ in range(forests):
            root, more, before = {}, [], len(out)

            def top(g: int) -> int:
                while root.setdefault(g, g) != g:
                    root[g] = g = root[root[g]]
                return g

            for x, y in left:
                a, b = top(group[x]), top(group[y])
                if a != b:
                    root[a] = b
                (out if a != b else more).append((x, y))
            left = more
            if len(out) == before:
                break
        x, y = np.array(out, dtype=np.int64).reshape(-1, 2).T
        return np.column_stack((p["sig"][x], np.minimum(key[x], key[y]), np.maximum(key[x], key[y])))
    return _by_block(each, few, ["sig", "a", "b"])


def _in_blocks(entries: DataFrame, facts: DataFrame) -> DataFrame:
    """The ``entries`` (``sig, key``, more) of each signature, with the ``facts`` of their
    key, dealt to pairs of blocks of bounded size, sorted by them.  Blocks are
    counted before the facts are added, so these are moved with the entries once."""
    more = [c for c in [*entries.columns, *facts.columns] if c not in ("sig", "key")]
    blocks = entries.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = (entries.join(blocks, "sig")
             .withColumn("side", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
             .join(facts, "key")
             .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("sig", F.least("side", "t").alias("bi"), F.greatest("side", "t").alias("bj"), "side", "key", *more))
    return dealt.repartition("sig", "bi", "bj").sortWithinPartitions("sig", "bi", "bj")


def _open_pairs(members: DataFrame, label: DataFrame, facts: DataFrame, refuted: DataFrame,
                similarity: int, words: int, forests: int) -> DataFrame:
    """Pairs ``(sig, a, b)`` of different groups that share a signature and may
    link (see :func:`_forests`).  ``members``: ``sig, set_key``; ``facts``:
    ``set_key, size, sketch``.

    First the groups themselves are held against each other, one entry per
    signature and group however many sets it has; only groups that their common
    bits cannot tell apart are taken to their sets.  Groups are held by folded
    sketches, as there are many more entries than groups.
    """
    spark = members.sparkSession
    of_sig = Window.partitionBy("sig")
    held = (members.join(label, F.col("set_key") == F.col("node"), "left")
            .select("sig", "set_key", F.coalesce("component", "set_key").alias("label")))
    inner = saved(held.withColumns({"l": F.min("label").over(of_sig), "h": F.max("label").over(of_sig), "c": F.count(F.lit(1)).over(of_sig)})
                  .where("l <> h and c > 2").select("sig", "set_key", "label"), "mixed")
    release(spark)
    wide = _undecided_groups(inner, _folded(facts, words), similarity, words // FOLD)
    single = saved(inner.join(wide, ["sig", "label"]).select("sig", F.col("set_key").alias("key"), "label"), "single")
    drop_saved(spark, inner, wide)
    known = refuted.groupBy(F.col("b").alias("key")).agg(F.collect_set("a").alias("refuted"))
    keys = single.select("key").distinct()
    needed = (facts.withColumnRenamed("set_key", "key")
              .join(F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys, "key").join(known, "key", "left"))
    out = saved(_in_blocks(single, needed).mapInPandas(_forests(similarity, forests), "sig long, a long, b long"), "open")
    drop_saved(spark, single)
    return out


def _undecided_groups(members: DataFrame, facts: DataFrame, similarity: int, words: int) -> DataFrame:
    """``(sig, label)`` of the groups of ``members`` (``sig, set_key, label``) that
    sketches of so many ``words`` cannot tell from every other of their signature, as a stored table."""
    spark = members.sparkSession
    bits = [F.get("sketch", i) for i in range(words)]
    groups = saved(facts.join(members.select("set_key", "label").distinct(), "set_key").groupBy("label").agg(
        F.count("*").alias("n"), F.max("size").alias("size"),
        F.array(*[F.bit_and(b) for b in bits]).alias("every"), F.array(*[F.bit_or(b) for b in bits]).alias("some"))
        .select(F.col("label").alias("key"), "size", "every", F.when(F.col("n") > 1, F.col("some")).alias("some")), "facts")
    release(spark)
    entries = members.select("sig", F.col("label").alias("key")).distinct()
    wide = saved(_in_blocks(entries, groups).mapInPandas(_undecided(similarity), "sig long, label long").distinct(), "undecided")
    drop_saved(spark, groups)
    return wide


def _of_each_list(members: DataFrame, repeats: bool = True) -> DataFrame:
    """The members of one signature of all those with the same sets, without repeats, as
    a stored table: alike sets share many signatures, and each says the same.  Equal
    lists are told by their length and two 64-bit sums (exclusive or) of hashes.
    ``members`` is dropped; without ``repeats`` no row of it comes twice."""
    spark, once = members.sparkSession, members
    if repeats:
        once = saved(members.select("sig", "low", "set_key").distinct(), "once")
        drop_saved(spark, members)
    sums = once.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(F.lit(1), "set_key")).alias("x"),
                                   F.bit_xor(F.xxhash64(F.lit(2), "set_key")).alias("y"))
    first = sums.groupBy("n", "x", "y").agg(F.min("sig").alias("sig")).select("sig")
    out = saved(once.join(first, "sig"), "lists")
    drop_saved(spark, once)
    return out


def grouped_sets(members: DataFrame, facts: DataFrame, verify, similarity: int, words: int, repeats: bool = True) -> DataFrame:
    """``(node, component)`` of all sets that link with another one.  ``members``:
    ``sig, low, set_key`` (``low``: the signature's smallest), a stored table that is dropped, with rows twice only if ``repeats``;
    ``facts``: ``set_key, size, sketch``; ``verify`` parts stored pairs ``(a, b)`` that the
    sketches cannot exclude in those that link and those that do not, and drops them.

    Sets are held against their signatures' smallest first.  Then rounds: of the
    pairs that may join groups of a signature only spanning forests are
    verified, and where one of them does not link, the signature has another
    round, with many more forests and without the pairs known not to link.
    """
    spark = members.sparkSession
    members = _of_each_list(members, repeats)
    release(spark)
    tested = saved(members.where("set_key <> low").select(F.col("low").alias("a"), F.col("set_key").alias("b"))
                   .distinct(), "pairs")
    release(spark)
    possible = _possible(tested, facts, similarity, words)
    drop_saved(spark, tested)
    links, refuted = verify(possible)
    release(spark)
    label = connected_components(links, "a", "b")
    lists, within, forests = members, members.select("sig", "set_key"), 1
    while True:
        found = _open_pairs(within, label, facts, refuted, similarity, words, forests)
        release(spark)
        if found.isEmpty():
            drop_saved(spark, found, lists)
            return label
        more, failed = verify(saved(found.select("a", "b").distinct(), "possible"))     # by whole sketches already
        release(spark)
        if not more.isEmpty():
            links = links.union(more)
            label = connected_components(links, "a", "b")
        refuted = refuted.union(failed)
        again = found.join(failed, ["a", "b"]).select("sig").distinct()
        within, forests = saved(within.join(again, "sig"), "within"), max(MORE_FORESTS, 8 * forests)
        drop_saved(spark, found)
        if within.isEmpty():
            drop_saved(spark, lists)
            return label


def near_duplicates(df: DataFrame, n: int = 5, similarity: int = 80, n2: int = 3, k2: int = 1,
                    id_col: str = "doc_id", text_col: str = "text", slices: int = 1) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest id reachable over links, the row's own
    id included.  A null or wordless text has 0 shingles, no link, and its own
    id.  Rows with equal texts link.  A row without an id is counted but links
    with nothing (its ``component_id`` is null).  Other columns are ignored.
    With several ``slices`` the shared signatures are found slice by slice: each
    shuffles its part of all signatures only, and makes the sets anew.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    narrow = saved(docs.mapInPandas(_keys(n), "doc_id long, n_shingles long, set_key long"), "setkeys")
    nodes = (narrow.where("set_key is not null and doc_id is not null")
             .groupBy("set_key").agg(F.min("doc_id").alias("rep")))

    with_id, row = docs.where("doc_id is not null"), "sig long, set_key long"
    found = []
    for i in range(slices):
        sigs = with_id.mapInPandas(_signature_rows(n, similarity, n2, k2, slice_=i, slices=slices), row)
        found.append(saved(sigs.groupBy("sig").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high"))
                           .where("low <> high").select("sig", "low"), "shared"))
        release(spark)                   # every signature of the slice went through this shuffle
    shared = reduce(DataFrame.union, found)
    bitmap = spark.sparkContext.broadcast(_bitmap(shared))
    again = with_id.mapInPandas(_signature_rows(n, similarity, n2, k2, bitmap), row)
    members = saved(again.join(shared, "sig").select("sig", "low", "set_key"), "members")     # copies met by two tasks stay
    bitmap.destroy()
    drop_saved(spark, shared)
    keys = members.select("set_key").distinct()
    release(spark)
    wanted = saved(nodes.join(keys, "set_key").select("set_key", F.col("rep").alias("doc_id")), "wanted")
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    sets = saved(docs.join(few, "doc_id").select("set_key", "text").mapInPandas(
        _set_rows(n), "set_key long, size long, shingles array<long>, sketch array<long>"), "sets")
    release(spark)

    label = grouped_sets(members, sets.select("set_key", "size", "sketch"), lambda pairs: _verified(pairs, sets, similarity),
                         similarity, SKETCH_WORDS)
    drop_saved(spark, wanted, sets)

    grouped = (nodes.join(label, F.col("set_key") == F.col("node"), "left")
               .select("set_key", "rep", F.coalesce("component", "set_key").alias("component")))
    low = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_key = grouped.join(low, "component").select("set_key", "component_id")
    return (narrow.join(by_key, "set_key", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))
