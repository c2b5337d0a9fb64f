"""Helpers shared by the operators: scratch tables, hold-out rule, word hashing.

Word hashing works on whole batches of texts with numpy inside Arrow
functions; Spark partitions and moves the work.  Words are maximal runs of
bytes outside ``\\x20 \\x09-\\x0D``; a 64-bit hash stands for a word.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
SLAB_BYTES = 1 << 20            # texts are hashed in slabs of about this size

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15      # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1
_PLACE = np.array([0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03, 0x5851F42D4C957F2D,
                   0xDA3E39CB94B95BDB, 0x2127599BF4325C37, 0x880355F21E6D1965, 0xB5297A4D39B8A2F1], dtype=_U)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the session's shared checkpoint folder and read it
    back: the plan above starts from stored files that every executor sees."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: its cleaner does
    so when the driver's garbage collector has met their plans, which on a driver
    with little to do is long after the disk is full.  Spark holds the plan of the
    last job until another one has run, so one of a single row goes before."""
    spark.range(0, 1, 1, 1).collect()
    spark._jvm.java.lang.System.gc()


def drop_saved(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables made by :func:`saved` that nothing reads any more, and the
    shuffle files behind them."""
    release(spark)
    conf = spark._jsc.hadoopConfiguration()
    for df in frames:
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def held_out(id_col: Column) -> Column:
    """True for rows that no model may learn from (crc32 of the id as text
    leaves 1 modulo 3); a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser; spreads every input bit over the output."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x = x ^ (x >> _U(27))
    x = x * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    plain = mix64(np.arange(1, 257, dtype=_U) * _U(_BASE))
    lower = np.arange(256)
    lower[65:91] += 32
    return plain, plain[lower]


_PLAIN, _LOWER = _byte_tables()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = [np.ones(1, dtype=_U), np.ones(1, dtype=_U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to ``n``."""
    if len(_powers[0]) < n:
        for k, factor in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(n, factor, dtype=_U)
            row[0] = 1
            _powers[k] = np.cumprod(row, dtype=_U)
    return _powers[0], _powers[1]


def word_hashes(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the offsets
    (``len(texts) + 1``) at which each text's words begin.

    ``lower`` folds A-Z only.  A null text has no word.
    """
    raw = [b"" if t is None else t.encode("utf-8") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    buf = np.frombuffer(b"\n".join(raw) + b"\n" if raw else b"", dtype=np.uint8)
    table = _LOWER if lower else _PLAIN
    hashes, starts = [], []
    at = 0
    while at < len(buf):
        end = min(at + SLAB_BYTES, len(buf))
        while not _SPACE[buf[end - 1]]:           # end on white space
            nxt = np.flatnonzero(_SPACE[buf[end:end + 4096]])
            end = end + int(nxt[0]) + 1 if len(nxt) else min(end + 4096, len(buf))
        slab = buf[at:end]
        gap = _SPACE[slab]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap))))
        first, last = edge[0::2], edge[1::2]      # the slab ends on a gap
        up, down = _power_tables(len(slab) + 1)
        total = np.zeros(len(slab) + 1, dtype=_U)
        np.cumsum(table[slab] * up[:len(slab)], out=total[1:])
        size = (last - first).astype(_U)
        hashes.append(mix64((total[last] - total[first]) * down[first] + size))
        starts.append(first + at)
        at = end
    if not hashes:
        return np.empty(0, dtype=_U), np.zeros(len(texts) + 1, dtype=np.int64)
    begin = np.concatenate(starts)
    return np.concatenate(hashes), np.concatenate(([0], np.searchsorted(begin, ends))).astype(np.int64)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all ``n``-word windows; a shorter text gives its whole
    sequence as one window, a text without words none."""
    if not len(words):
        return words
    m = min(n, len(words))
    k = len(words) - m + 1
    acc = np.full(k, m * _BASE & _MASK, dtype=_U)
    for i in range(m):
        acc += words[i:i + k] * (_PLACE[i % len(_PLACE)] + _U(2 * (i // len(_PLACE))))
    return mix64(acc)
