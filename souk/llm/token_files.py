"""Token ids as binary shard files with a minimal perfect hash index.

Files.  Texts are sorted by id over range partitions; each partition is one
shard.  A shard is a sequence of chunks, one row each of a Parquet table (so
Spark's writer gives retries, commits and remote stores): ``shard, chunk,
payload`` (the ids of the chunk's texts one after another, little-endian,
``WIDTH`` bytes each) and ``ids, ends`` (the texts' keys and the place after
each text's last id, in ids).

Index.  A key is ``(id, occurrence)``, so repeated and null ids have keys of
their own.  Keys are dealt to buckets by hash; per bucket a minimal perfect hash
function maps ``n`` keys to ``0 .. n-1`` (levels of bit vectors: a key takes
the first level at which no other key has its position, and its number is the
rank of that bit), with a 32-bit fingerprint and the location (shard, chunk,
place, number of ids) per slot.  A lookup computes one slot, compares one
fingerprint and reads one location.

Encoding.  No token of the byte-level vocabulary goes over a single space or
line feed between two non-spaces, nor from a letter to a sign or back (the
apostrophe aside), so a text is encoded in units cut there.  Equal units of about
1 MB of text are found with numpy; a worker encodes a unit that it remembers only once.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import _PLAIN, SLAB_BYTES, _power_tables, mix64, saved

WIDTH = 2                       # bytes of a stored id; 65,536 ids at most
CHUNK_IDS = 1 << 20             # ids of a chunk; one text is never split
BUCKET_KEYS = 16_384            # keys of an index bucket, on average
CACHE_UNITS = 600_000           # units whose ids a task remembers
PIECE_CHARS = 1 << 20           # text encoded at a time
FEW_CHUNKS = 1_000              # chunks that a keyed read names one by one
RUN = 4_096                     # keys of one id made at a time
GAMMA = 2.0                     # bits per key and level
LEVELS = 48

_U = np.uint64
# Units that are put together from words: letters (of the Latin blocks) and signs other than the apostrophe.
PLAIN = re.compile("(\n?)( ?)([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]*)([!-&(-/:-@\\[-`{-~]*)").fullmatch
# How the byte-level rule writes a byte: printing characters stand for themselves, the others follow from 256 on.
_PRINTING = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTING)}
ODD_SPACE = re.compile("[\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]").search
SPACE_CHAR, FEED_CHAR = chr(BYTE_CHARS[0x20]), chr(BYTE_CHARS[0x0A])
_KIND = np.zeros(256, dtype=np.uint8)       # 1: ASCII letter, 2: sign other than the apostrophe; no two others add up to 3
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27]] = 2
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True


class Encoder:
    """Ids of whole texts by the tokenizers library, in memorised units.

    A unit goes from one space or line feed between two non-spaces to the next:
    the byte-level rule joins a space to what follows and keeps a lone line
    feed apart, so nothing goes over these places.  It also parts letters from
    signs, unless an apostrophe or an added token (as ``</s>``) is among them.  Units are known by their
    bytes, the space or line feed before them included; equal units of a slab are
    found with numpy and looked up once.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # Spark runs the tasks in parallel
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        if not isinstance(self.model.pre_tokenizer, ByteLevel) or self.model.normalizer is not None:
            raise ValueError("not a byte-level tokenizer; its texts can't be cut into units")
        if self.model.get_vocab_size(with_added_tokens=True) > 1 << 8 * WIDTH:
            raise ValueError("the vocabulary does not fit the stored width")
        self.merge = self.model.model.tokenize
        self.known: dict[bytes, bytes] = {}
        self.added = [a.content for a in self.model.get_added_tokens_decoder().values() if a.content]

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 20_000):
            out += [np.array(e.ids, dtype="<u2").tobytes()
                    for e in self.model.encode_batch(texts[i:i + 20_000], add_special_tokens=False)]
        return out

    def _word(self, word: str) -> bytes:
        """Ids of one word of the byte-level rule, by the model's own merge step."""
        if word.isascii():              # letters or signs, which stand for themselves
            mapped = word.replace(" ", SPACE_CHAR).replace("\n", FEED_CHAR)
        else:
            mapped = word.encode("utf-8").decode("latin-1").translate(BYTE_CHARS)
        return array("H", [t.id for t in self.merge(mapped)]).tobytes()

    def _unit_ids(self, names: list[str]) -> list[bytes]:
        """Ids of units with the space or line feed before them.

        Letters are one word together with the space before them, signs after
        them another, and a line feed before them one of its own (the
        byte-level rule; an apostrophe may begin a word of its kind, so units
        with one take the long way, as all others do).
        """
        out, rest = {}, []
        for n in names:
            m = PLAIN(n)
            feed, space, letters, signs = m.groups() if m else ("",) * 4
            if not letters and not signs:
                rest.append(n)
                continue
            ids = self._word(space + (letters or signs))
            if feed:
                ids = self._word("\n") + ids
            out[n] = ids + self._word(signs) if letters and signs else ids
        out.update(zip(rest, self._ids(rest)))
        return [out[n] for n in names]

    def _known_ids(self, units: list[bytes]) -> list[bytes]:
        """Ids of units, of those met before from memory."""
        if len(self.known) > CACHE_UNITS:
            self.known.clear()
        got = list(map(self.known.get, units))
        fresh = [u for u, ids in zip(units, got) if ids is None]
        if not fresh:
            return got
        self.known.update(zip(fresh, self._unit_ids([u.decode("utf-8") for u in fresh])))
        return [self.known[u] if ids is None else ids for u, ids in zip(units, got)]

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """Little-endian ids of every text and ``end_id``."""
        raw = [t.encode("utf-8") for t in texts]
        buf, ends = np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([len(r) for r in raw], dtype=np.int64)
        if not len(buf):
            return [np.array([end_id], dtype="<u2").tobytes()] * len(texts)
        starts = _unit_starts(buf, ends, [bool(ODD_SPACE(t)) for t in texts], [any(a in t for a in self.added) for t in texts])
        ids, counts = [], []
        edge = np.append(starts, len(buf))
        i = 0
        while i < len(starts):
            j = max(int(np.searchsorted(edge, edge[i] + SLAB_BYTES, side="right")) - 1, i + 1)
            first, code = _distinct(buf[edge[i]:edge[j]], edge[i:j + 1] - edge[i])
            some = buf[edge[i]:edge[j]].tobytes()
            at = (edge[i:j + 1] - edge[i]).tolist()
            known = self._known_ids([some[at[k]:at[k + 1]] for k in first.tolist()])
            size = np.array([len(k) // WIDTH for k in known], dtype=np.int64)
            begin, n = (np.cumsum(size) - size)[code], size[code]
            place = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
            ids.append(np.frombuffer(b"".join(known), dtype="<u2")[place])
            counts.append(n)
            i = j
        all_ids = np.concatenate(ids).tobytes()
        total = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) * WIDTH
        cut = np.concatenate(([0], total[np.searchsorted(starts, ends)])).tolist()
        end = np.array([end_id], dtype="<u2").tobytes()
        return [all_ids[x:y] + end for x, y in zip(cut[:-1], cut[1:])]


def _unit_starts(buf: np.ndarray, ends: np.ndarray, odd: list[bool], special: list[bool]) -> np.ndarray:
    """Places in the texts' UTF-8 bytes at which units begin: the texts' own
    beginnings, each single space or line feed between two non-spaces, and places
    between an ASCII letter and an ASCII sign other than the apostrophe.  In texts
    with spaces outside ASCII (``odd``) the first count only between ASCII
    characters, in those with added tokens (``special``) the last do not count."""
    gap = _GAP[buf]
    cut = (buf == 0x20) | (buf == 0x0A)
    cut[1:] &= ~gap[:-1]
    cut[:-1] &= ~gap[1:]
    size = np.diff(ends, prepend=0)
    if any(odd):
        wide = buf >= 0x80
        near = np.zeros(len(buf), dtype=bool)
        near[1:] = wide[:-1]
        near[:-1] |= wide[1:]
        cut &= ~(near & np.repeat(odd, size))
    full = size > 0
    cut[ends[full] - 1] = False
    kind = _KIND[buf]
    word = np.zeros(len(buf), dtype=bool)
    word[1:] = kind[1:] + kind[:-1] == 3                # a letter (1) and a sign (2)
    cut |= word & ~np.repeat(special, size) if any(special) else word
    cut[(ends - size)[full]] = True
    return np.flatnonzero(cut)


def _distinct(buf: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of units one after another: places of the distinct ones, and which of them
    each is.  Hashes find equal units, their bytes are compared."""
    size = np.diff(edge)
    if len(size) == 1:
        return np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    up, down = _power_tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=_U)
    np.cumsum(_PLAIN[buf] * up[:len(buf)], out=total[1:])
    code, names = pd.factorize((total[edge[1:]] - total[edge[:-1]]) * down[edge[:-1]])
    first = np.empty(len(names), dtype=np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    same = first[code]
    if (size == size[same]).all() and (buf[np.repeat(edge[same] - edge[:-1], size) + np.arange(len(buf))] == buf).all():
        return first, code
    text, at, known = buf.tobytes(), edge.tolist(), {}             # two units of one hash
    code = np.array([known.setdefault(text[x:y], len(known)) for x, y in zip(at[:-1], at[1:])], dtype=np.int64)
    return np.unique(code, return_index=True)[1], code


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _chunks(path: str, end_id: int):
    def run(batches):
        encoder, shard, chunk = _encoder(path), TaskContext.get().partitionId(), 0
        ids: list = []
        runs: list[bytes] = []
        held = 0

        def row() -> pd.DataFrame:
            ends = np.cumsum([len(r) // WIDTH for r in runs], dtype=np.int64)
            return pd.DataFrame({"shard": [shard], "chunk": [chunk], "ids": [list(ids)], "ends": [ends], "payload": [b"".join(runs)]})

        for pdf in batches:
            size = pdf["text"].str.len().cumsum().to_numpy() // PIECE_CHARS
            for _, part in pdf.groupby(size, sort=True):
                keys = [None if pd.isna(k) else int(k) for k in part["doc_id"]]
                for key, run_ids in zip(keys, encoder.encode(part["text"].tolist(), end_id)):
                    ids.append(key)
                    runs.append(run_ids)
                    held += len(run_ids) // WIDTH
                    if held >= CHUNK_IDS:
                        yield row()
                        chunk, held, ids, runs = chunk + 1, 0, [], []
        if runs:
            yield row()
    return run


CHUNK_SCHEMA = "shard int, chunk int, ids array<bigint>, ends array<bigint>, payload binary"


def write(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text (null: empty), append ``end_id``, and write the
    shard files in ascending id order (rows without an id first; ties by text).
    Returns the stored chunk table."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["doc_id", "text"]
    return saved(docs.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(*order)
                 .mapInPandas(_chunks(path, end_id), CHUNK_SCHEMA), "ids")


def entries(chunks: DataFrame) -> DataFrame:
    """One row per stored text: key, location, and ``start`` (ids of all texts
    before it).  Reads no payload."""
    chunk = chunks.select("shard", "chunk", F.element_at("ends", -1).alias("n"))
    shards = chunk.groupBy("shard").agg(F.sum("n").alias("s"))
    earlier = shards.select("shard", (F.sum("s").over(Window.orderBy("shard")) - F.col("s")).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("chunk")
    starts = (chunk.withColumn("c", F.sum("n").over(inside) - F.col("n")).join(earlier, "shard")
              .select("shard", "chunk", (F.col("c") + F.col("shard_start")).alias("chunk_start")))
    texts = (chunks.select("shard", "chunk", F.posexplode(F.arrays_zip("ids", "ends")).alias("i", "x"), F.col("ends").alias("all"))
             .select("shard", "chunk", "i", F.col("x.ids").alias("doc_id"),
                     F.when(F.col("i") > 0, F.get("all", F.col("i") - 1)).otherwise(F.lit(0)).alias("place"), F.col("x.ends").alias("end")))
    # occurrences of an id: those of earlier shards first, so an id on very many rows is cut by shards
    per = texts.groupBy("doc_id", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = (per.select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), (
        F.sum("n").over(Window.partitionBy("doc_id").orderBy("shard")) - F.col("n")).alias("_n")).where("_n > 0"))
    again = Window.partitionBy("doc_id", "shard").orderBy("chunk", "i")
    numbered = texts.withColumn("_k", F.row_number().over(again) - 1).join(
        before, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("shard") == F.col("_shard")), "left")
    return (numbered.join(starts, ["shard", "chunk"])
            .select("doc_id", (F.col("_k") + F.coalesce("_n", F.lit(0))).alias("occurrence"), "shard", "chunk", "place",
                    (F.col("end") - F.col("place")).alias("n_tokens"), (F.col("chunk_start") + F.col("place")).alias("start")))


def _keyed(df: DataFrame, buckets: int) -> DataFrame:
    return (df.withColumn("h", F.xxhash64(F.lit(1), "occurrence", "doc_id"))
            .withColumn("f", F.xxhash64(F.lit(2), "doc_id", "occurrence"))
            .withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int")))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys by levels of bit vectors."""

    def __init__(self, sizes: list[int], bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest      # one 0/1 byte per bit
        self.rank = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))

    @staticmethod
    def _spot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys + _U(level * 0x9E3779B97F4A7C15 & ((1 << 64) - 1))) % _U(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, bits, left = [], [], keys
        while len(left) and len(sizes) < LEVELS:
            size = int(GAMMA * len(left)) + 1
            spot = cls._spot(left, len(sizes), size)
            alone = np.bincount(spot, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[spot]]
        return cls(sizes, np.concatenate(bits) if bits else np.zeros(0, dtype=bool), np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key; any slot, or -1, for a key that was not built in."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            spot = base + self._spot(keys[todo], level, size)
            hit = self.bits[spot]
            out[todo[hit]] = self.rank[spot[hit]]
            todo, base = todo[~hit], base + size
        if len(self.rest) and len(todo):
            i = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            found = self.rest[i] == keys[todo]
            out[todo[found]] = self.rank[-1] + i[found]
        return out

    def dump(self) -> dict:
        return {"sizes": self.sizes, "bits": np.packbits(self.bits).tobytes(), "rest": self.rest.tobytes()}

    @classmethod
    def load(cls, row) -> "PerfectHash":
        sizes = [int(s) for s in row["sizes"]]
        bits = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8))[:sum(sizes)].astype(bool)
        return cls(sizes, bits, np.frombuffer(row["rest"], dtype=_U))


_LOCATION = ["shard", "chunk", "place", "n_tokens", "start"]
INDEX_SCHEMA = "bucket int, sizes array<bigint>, bits binary, rest binary, prints binary, " + ", ".join(f"{c} binary" for c in _LOCATION)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = pdf["h"].to_numpy().astype(np.int64).view(_U)
    hashed = PerfectHash.build(keys)
    slot = hashed.slots(keys)
    row = {"bucket": int(pdf["bucket"].iloc[0]), **hashed.dump()}
    prints = np.zeros(len(keys), dtype="<u4")
    prints[slot] = (pdf["f"].to_numpy().astype(np.int64) & 0xFFFFFFFF).astype("<u4")
    row["prints"] = prints.tobytes()
    for c in _LOCATION:
        column = np.zeros(len(keys), dtype="<i8")
        column[slot] = pdf[c].to_numpy()
        row[c] = column.tobytes()
    return pd.DataFrame([row])


def build_index(texts: DataFrame) -> tuple[DataFrame, int]:
    """The stored index over :func:`entries` and its number of buckets."""
    texts = saved(texts, "entries")
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = texts.count()
    buckets = max(1, -(-n // BUCKET_KEYS), min(tasks, n // 64))       # enough for all tasks
    index = _keyed(texts, buckets).groupBy("bucket").applyInPandas(_build, INDEX_SCHEMA)
    return saved(index, "index"), buckets


_FOUND = "doc_id long, occurrence long, " + ", ".join(f"{c} long" for c in _LOCATION)


def _find(strict: bool):
    """Locations of one bucket's keys; ``strict``: every key must be there."""
    def find(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "occurrence", *_LOCATION]
        if strict and len(keys) and not len(index):
            raise ValueError(f"the index has no bucket for {len(keys)} keys")
        if not len(keys) or not len(index):
            return pd.DataFrame(columns=columns)
        row = index.iloc[0]
        slot = PerfectHash.load(row).slots(keys["h"].to_numpy().astype(np.int64).view(_U))
        prints = np.frombuffer(row["prints"], dtype="<u4")
        want = (keys["f"].to_numpy().astype(np.int64) & 0xFFFFFFFF).astype("<u4")
        ok = (slot >= 0) & (slot < len(prints))
        ok[ok] = prints[slot[ok]] == want[ok]
        if strict and not ok.all():
            raise ValueError(f"{int((~ok).sum())} keys are not in the index, among them {keys['doc_id'][~ok].head(5).tolist()}")
        out = keys.loc[ok, ["doc_id", "occurrence"]].reset_index(drop=True)
        for c in _LOCATION:
            out[c] = np.frombuffer(row[c], dtype="<i8")[slot[ok]]
        return out
    return find


def lookup(keys: DataFrame, index: DataFrame, buckets: int, strict: bool = False) -> DataFrame:
    """Locations of keys ``(doc_id, occurrence)``; unknown keys have no row
    (but for one in 2**32, which the fingerprint cannot tell), with ``strict``
    they are an error."""
    left = _keyed(keys.select("doc_id", F.col("occurrence").cast("long").alias("occurrence")), buckets).groupBy("bucket")
    return left.cogroup(index.groupBy("bucket")).applyInPandas(_find(strict), _FOUND)


def fetch(keys: DataFrame, chunks: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, occurrence, payload`` of the known ones among ``keys``: the stored
    bytes of just these texts.  For up to ``FEW_CHUNKS`` chunks only their shards'
    files and row groups are opened; beyond, the chunks are joined."""
    at = saved(lookup(keys, index, buckets), "found").select("doc_id", "occurrence", "shard", "chunk", "place", "n_tokens")
    places = at.select("shard", "chunk").distinct().limit(FEW_CHUNKS + 1).collect()
    wanted = chunks.select("shard", "chunk", "payload")
    if len(places) <= FEW_CHUNKS:
        wanted = wanted.where(F.col("shard").isin([r.shard for r in places]) & F.col("chunk").isin([r.chunk for r in places]))
    return at.join(wanted, ["shard", "chunk"]).select(
        "doc_id", "occurrence", F.substring("payload", (F.col("place") * WIDTH + 1).cast("int"), (F.col("n_tokens") * WIDTH).cast("int")).alias("payload"))


def _sums(batches):
    """CRC-32 of every stored text's ids as unsigned 32-bit numbers."""
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            ids = np.frombuffer(row.payload, dtype="<u2").astype("<u4")
            ends = np.asarray(row.ends, dtype=np.int64)
            begins = np.concatenate(([0], ends[:-1]))
            yield pd.DataFrame({"shard": np.int64(row.shard), "chunk": np.int64(row.chunk), "place": begins, "stored": ends - begins,
                                "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(begins, ends)]})


def stored_sums(chunks: DataFrame) -> DataFrame:
    """Per stored text: its place and the CRC-32 of its ids, read from the payload."""
    return chunks.select("shard", "chunk", "ends", "payload").mapInPandas(
        _sums, "shard long, chunk long, place long, stored long, ids_crc32 long")


def round_trip(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write, index, look every key up and read its ids back: ``doc_id, start,
    n_tokens, ids_crc32`` per row of ``df``.  A key that the index does not know,
    or a place that does not hold what the index says, is an error."""
    chunks = write(df, path, end_id, id_col, text_col)
    index, buckets = build_index(entries(chunks))
    counts = df.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    # in two steps: an id on very many rows never makes one long array
    runs = counts.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN))).alias("run"))
    keys = runs.select("doc_id", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1)).alias("occurrence"))
    found = lookup(keys, index, buckets, strict=True)
    sums = stored_sums(chunks)
    whole = F.col("stored").isNotNull() & (F.col("n_tokens") == F.col("stored"))
    return (found.join(sums, ["shard", "chunk", "place"], "left")
            .withColumn("ids_crc32", F.when(whole, F.col("ids_crc32")).otherwise(
                F.raise_error(F.concat(F.lit("stored ids are not those of the index: id "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))))
            .select("doc_id", "start", "n_tokens", "ids_crc32"))
