"""Toxicity by compression distance with zstandard dictionaries.

Two dictionaries are trained on a bounded sample of labelled texts: one on
windows of ordinary text, one on windows of toxic text, weighted by how surely
their words are in more toxic than ordinary texts (log-likelihood ratio of the
document frequencies, so a few mislabelled rows or rare vocabulary do not matter).
Every text is cut into windows of about 40 bytes at spaces; a window is
compressed once against the ordinary dictionary alone and once with the toxic
one before it.  What the toxic dictionary saves is the window's evidence.

The counts of windows that save at least 1..10 bytes are calibrated to a
probability by a logistic regression on training texts that the dictionaries
have not seen; 0.7 is the threshold of a positive prediction.  All learning
uses at most ``DICT_TOXIC + DICT_ORDINARY + 2 * CALIBRATION`` texts.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from math import log

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 40                 # bytes, extended to the next space
LEVEL = 4                   # zstandard level
TOXIC_BYTES, ORDINARY_BYTES = 2048, 65536     # dictionary sizes
DICT_TOXIC, DICT_ORDINARY = 1_500, 9_000      # most training texts of each dictionary
CALIBRATION = 2_500         # most calibration texts of each label
ORDINARY_WINDOWS = 30_000   # windows for the ordinary dictionary, spread over all its training texts
# Chosen by fourfold cross-validation inside the training rows: most toxic texts found with under 1 % of others flagged.
SURE = 16                   # least log-likelihood ratio of a word that gives a window weight
THRESHOLD = 0.7
SAMPLE_CHARS = 20_000       # of a longer training text, so many characters are used; scoring has no limit
SAMPLE_PIECES = 10          # pieces, spread over the whole text, that they are taken in
STEPS = range(1, 11)

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _fold(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8")


def windows(data: bytes) -> list[bytes]:
    """The whole text in runs of ``WINDOW`` bytes, each extended to the next
    space (at most to twice that length); an empty text is one empty window."""
    out, i, n = [], 0, len(data)
    while i < n:
        j = i + WINDOW
        if j < n:
            j = data.find(b" ", j, i + 2 * WINDOW) + 1 or i + 2 * WINDOW
        out.append(data[i:j])
        i = j
    return out or [b""]


def _train(samples: list[bytes], size: int, **cover: int) -> bytes:
    """A trained dictionary; with too little text to train on, the text itself."""
    try:
        return zstandard.train_dictionary(size, samples, **cover).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=params)


class Scorer:
    """Two dictionaries and the calibration; plain bytes and arrays, so it travels to tasks."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = ordinary, toxic
        self.mean = self.scale = self.coef = None
        self._pair = None

    def __getstate__(self):
        return {**self.__dict__, "_pair": None}

    def features(self, text: str | None) -> np.ndarray:
        if self._pair is None:
            self._pair = (_compressor(self.ordinary or b" " * 8), _compressor((self.ordinary + self.toxic) or b" " * 8))
        plain, with_toxic = self._pair
        saved = np.array([len(plain.compress(w)) - len(with_toxic.compress(w)) for w in windows(_fold(text))])
        n = len(saved)
        up = np.array([(saved >= t).sum() for t in STEPS], dtype=float)
        down = np.array([(saved <= -t).sum() for t in range(1, 8)], dtype=float)
        return np.concatenate([up / n, np.log1p(up), np.minimum(up, 1), down / n, np.log1p(down),
                               [np.log(n), saved.mean(), saved.max()]])

    def calibrate(self, texts: list[str], labels: list[int]) -> None:
        """Ridge logistic regression by Newton steps."""
        x, y = np.array([self.features(t) for t in texts]), np.array(labels, dtype=float)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        self.coef = np.zeros(z.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(z @ self.coef, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + np.eye(len(self.coef))
            step = np.linalg.solve(h, z.T @ (p - y) + self.coef)
            self.coef -= step
            if np.abs(step).max() < 1e-8:
                break

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.coef is None:
            return np.zeros(len(texts))
        x = (np.array([self.features(t) for t in texts]) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.coef[:-1] + self.coef[-1], -30, 30)))


def _spread(items: list, most: int) -> list:
    """At most ``most`` of the items, evenly spread."""
    return items if len(items) <= most else [items[i * len(items) // most] for i in range(most)]


def _frequencies(texts: set[str]) -> Counter:
    """Number of texts that hold a word."""
    return Counter(w for t in texts for w in set(_WORD.findall(_fold(t))))


def _weights(toxic: list[str], ordinary: list[str]) -> dict[bytes, float]:
    """Log-likelihood ratio of the words that are in surely (``SURE``) more
    toxic than ordinary texts; equal texts count once."""
    toxic, ordinary = set(toxic), set(ordinary)
    here, there = _frequencies(toxic), _frequencies(ordinary)
    n, m = len(toxic), len(ordinary)
    out = {}
    for w, k in here.items():
        j = there[w]
        g = 2 * (k * log(k * (n + m) / ((k + j) * n)) + (j * log(j * (n + m) / ((k + j) * m)) if j else 0))
        if k * m > j * n and g >= SURE:
            out[w] = g
    return out


def _toxic_content(texts: list[str], weights: dict[bytes, float], size: int) -> bytes:
    """Windows of toxic texts, each from its first to its last weighted word,
    that hold the most weight not yet covered a byte; the best stand last."""
    runs = set()
    for t in texts:
        for w in windows(_fold(t)):
            words = _WORD.findall(w)
            at = [i for i, word in enumerate(words) if word in weights]
            if at:
                runs.add(b" " + b" ".join(words[at[0]:at[-1] + 1]) + b" ")
    covered: set[bytes] = set()

    def gain(run: bytes) -> float:
        return sum(weights.get(w, 0.0) for w in set(_WORD.findall(run)) - covered) / len(run)

    heap = [(-gain(r), r) for r in runs]
    heapq.heapify(heap)
    out, used = [], 0
    while heap and used < size:
        run = heapq.heappop(heap)[1]
        now = gain(run)
        if heap and now < -heap[0][0] - 1e-9:
            if now > 0:
                heapq.heappush(heap, (-now, run))
        elif now > 0:
            out.append(run)
            used += len(run)
            covered.update(_WORD.findall(run))
    return b"".join(reversed(out))[-size:]


def train(labelled: list[tuple[str, int]]) -> Scorer:
    """Fit on (text, label) pairs.  Without texts of both labels the scorer
    gives every text 0."""
    texts = {k: [t for t, y in labelled if y == k] for k in (0, 1)}
    cut = {1: min(DICT_TOXIC, -(-len(texts[1]) * 2 // 3)), 0: min(DICT_ORDINARY, -(-len(texts[0]) * 2 // 3))}
    if not texts[0] or not texts[1]:
        return Scorer(b"", b"")
    ordinary, toxic = texts[0][:cut[0]], texts[1][:cut[1]]
    per_text = max(1, ORDINARY_WINDOWS // len(ordinary))
    plain = [w for t in ordinary for w in _spread(windows(_fold(t)), per_text)]
    scorer = Scorer(_train(plain, ORDINARY_BYTES), _toxic_content(toxic, _weights(toxic, ordinary), TOXIC_BYTES))
    held = [(t, y) for y in (0, 1) for t in (texts[y][cut[y]:cut[y] + CALIBRATION] or texts[y][:CALIBRATION])]
    scorer.calibrate([t for t, _ in held], [y for _, y in held])
    return scorer


def _sampled(text: Column) -> Column:
    """A text of up to ``SAMPLE_CHARS`` characters; pieces spread over a longer one."""
    piece, gaps = SAMPLE_CHARS // SAMPLE_PIECES, SAMPLE_PIECES - 1
    pieces = F.transform(F.sequence(F.lit(0), F.lit(gaps)), lambda i: F.substring(
        text, (F.lit(1) + F.floor(i * (F.length(text) - piece) / gaps)).cast("int"), F.lit(piece)))
    return F.when(F.length(text) <= SAMPLE_CHARS, text).otherwise(F.array_join(pieces, " "))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> list[tuple[str, int]]:
    """At most ``DICT_* + CALIBRATION`` texts of each label (1, 0) in the order
    of a hash of the id: the same rows at every run.  The ids are chosen from
    ``labels`` first, so only the chosen texts are read on."""
    out = []
    for label, most in ((0, DICT_ORDINARY + CALIBRATION), (1, DICT_TOXIC + CALIBRATION)):
        ids = (labels.where(F.col(label_col) == label).select(F.col(id_col).alias("i")).distinct()
               .withColumn("h", F.xxhash64("i")).orderBy("h", "i").limit(most))
        rows = (docs.where(F.col(text_col).isNotNull())
                .select(F.col(id_col).alias("i"), _sampled(F.col(text_col)).alias("t"))
                .join(F.broadcast(ids), "i").orderBy("h", "i", "t").limit(most).collect())
        out += [(r.t, label) for r in rows]
    return out


def score_texts(df: DataFrame, scorer: Scorer, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1 for every whole text; null and empty
    texts have one too (that of a text without evidence).  No shuffle."""
    @F.pandas_udf("double")
    def run(batches: "pd.Series") -> "pd.Series":
        return pd.Series(scorer.score(batches.tolist()))

    return df.withColumn(out_col, run(F.col(text_col)))
