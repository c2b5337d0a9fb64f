"""Language identification by a linear-chain conditional random field.

Every word of a text has a language; neighbouring words depend on each other
by learned transitions, so code-switched text gets runs of words per language.
A word's features are the hashes of its 2-, 3- and 4-byte n-grams, those with
the space before or after it being its affixes, and of the word itself (the
lexicon).  Weights are learned by maximum likelihood (forward-backward
gradients, Adagrad) on windows of at most ``TRAIN_TEXTS`` texts per language.

Labelling computes exact posteriors of all words of whole texts.  Texts are cut
into segments of ``SEGMENT`` words; the segments' transfer matrices are chained
first, and forward and backward values inside all segments follow at once, so
one very long text costs no more than many short ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import mix64

TRAIN_TEXTS = 400           # texts per language that are learned from, at most
TRAIN_CHARS = 20_000        # characters of a training text that are used; labelling has no limit
WINDOWS, WINDOW = 3, 40     # windows per training text, words per window
MAX_LANGS = 200
BITS = 16                   # hash size of a feature table
GRAMS = (2, 3, 4)
EPOCHS, RATE, RIDGE = 25, 0.5, 1e-3
SEGMENT = 32
PIECE_CHARS = 1 << 20
UNKNOWN = "und"

_U = np.uint64
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Words:
    """Words of several texts in one buffer, in order."""

    buf: np.ndarray         # bytes, lower case, each white space a space, spaces at both ends
    first: np.ndarray       # first byte of every word
    last: np.ndarray        # byte after it
    at: np.ndarray          # where each text's words begin (len(texts) + 1)


def read_words(texts: list[str | None]) -> Words:
    raw = [(t or "").lower().encode("utf-8") for t in texts]
    ends = 1 + np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    buf = np.frombuffer(b" " + b" ".join(raw) + b"   ", dtype=np.uint8).copy()
    buf[(buf >= 9) & (buf <= 13)] = 32
    edge = np.flatnonzero(np.diff((buf == 32).astype(np.int8))) + 1
    first, last = edge[0::2], edge[1::2]
    return Words(buf, first, last, np.concatenate(([0], np.searchsorted(first, ends))))


class Tagger:
    """Weights and exact inference."""

    def __init__(self, langs: list[str]):
        self.langs = langs
        k = len(langs)
        self.tables = [np.zeros((1 << BITS, k), dtype=np.float32) for _ in range(len(GRAMS) + 1)]
        self.moves = np.zeros((k, k))

    def _numbers(self, w: Words) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        out, size = [], _U((1 << BITS) - 1)
        code = w.buf.astype(_U)
        for n in GRAMS:
            gram = np.zeros(len(code) - n + 1, dtype=_U)
            for i in range(n):
                gram |= code[i:i + len(gram)] << _U(8 * i)
            out.append(((mix64(gram + _U(n << 40)) & size).astype(np.int32), w.first - 1, np.maximum(w.first - 1, w.last + 2 - n)))
        # the word itself: a sum over bytes that depends on their place in the word
        place = np.arange(len(code)) - np.repeat(np.concatenate(([0], w.first)), np.diff(np.concatenate(([0], w.first, [len(code)]))))
        run = np.concatenate((np.zeros(1, dtype=_U), np.cumsum(mix64(code + (place.astype(_U) << _U(9)) + _U(1)))))
        whole = (mix64(run[w.last] - run[w.first]) & size).astype(np.int32)
        k = np.arange(len(whole))
        return [*out, (whole, k, k + 1)]

    def emissions(self, w: Words) -> np.ndarray:
        """Score of every language for every word."""
        total = np.zeros((len(w.first), len(self.langs)))
        for table, (number, lo, hi) in zip(self.tables, self._numbers(w)):
            run = np.zeros((len(number) + 1, len(self.langs)))
            np.cumsum(table[number], axis=0, dtype=np.float64, out=run[1:])
            total += run[hi] - run[lo]
        return total

    def posteriors(self, scores: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probability of every language for every word, given the whole text."""
        k, n = scores.shape[1], len(scores)
        if not n:
            return scores
        a = np.exp(self.moves - self.moves.max())
        e = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
        length = np.diff(at)
        segs = -(-length // SEGMENT)
        text = np.repeat(np.arange(len(length)), segs)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(segs) - segs, segs)
        begin = at[:-1][text] + nth * SEGMENT
        size = np.minimum(SEGMENT, at[1:][text] - begin)
        spot = np.minimum(begin[:, None] + np.arange(SEGMENT)[None, :], n - 1)
        live = np.arange(SEGMENT)[None, :] < size[:, None]
        es = e[spot]                                                    # segment, step, language
        opening = nth == 0

        # transfer matrix of every segment, rows scaled
        p = np.broadcast_to(np.eye(k), (len(text), k, k)).copy()
        for t in range(SEGMENT):
            q = (p.reshape(-1, k) @ a).reshape(-1, k, k)
            if t == 0:
                q[opening] = 1.0 / k
            q *= es[:, t][:, None, :]
            q /= q.sum(axis=(1, 2), keepdims=True)
            p = np.where(live[:, t][:, None, None], q, p)

        # values before and after every segment, one segment of each text at a time
        before, after = np.full((len(text), k), 1.0 / k), np.full((len(text), k), 1.0 / k)
        deepest = int(segs.max())
        order = np.argsort(nth, kind="stable")
        bounds = np.searchsorted(nth[order], np.arange(deepest + 1))
        for s in range(1, deepest):
            i = order[bounds[s]:bounds[s + 1]]
            v = np.einsum("ij,ijk->ik", before[i - 1], p[i - 1])
            before[i] = v / v.sum(axis=1, keepdims=True)
        for s in range(deepest - 1, 0, -1):
            i = order[bounds[s]:bounds[s + 1]]
            v = np.einsum("ijk,ik->ij", p[i], after[i])
            after[i - 1] = v / v.sum(axis=1, keepdims=True)

        # inside all segments at once
        fwd = np.empty_like(es)
        x = before
        for t in range(SEGMENT):
            y = x @ a
            if t == 0:
                y[opening] = 1.0 / k
            y = y * es[:, t]
            y /= y.sum(axis=1, keepdims=True)
            x = np.where(live[:, t][:, None], y, x)
            fwd[:, t] = x
        x = after
        for t in range(SEGMENT - 1, -1, -1):
            fwd[:, t] *= x
            y = (x * es[:, t]) @ a.T
            y /= y.sum(axis=1, keepdims=True)
            x = np.where(live[:, t][:, None], y, x)
        out = fwd[live]
        return out / out.sum(axis=1, keepdims=True)

    def _expected(self, scores: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors of all words of short windows, and the expected number
        of every transition, by forward-backward over all windows at once."""
        a, k = np.exp(self.moves - self.moves.max()), scores.shape[1]
        length = np.diff(at)
        deep = int(length.max(initial=0))
        spot = np.minimum(at[:-1][:, None] + np.arange(deep)[None, :], len(scores) - 1)
        live = np.arange(deep)[None, :] < length[:, None]
        e = np.exp(scores - scores.max(axis=1, keepdims=True))[spot] + 1e-30
        fwd, bwd = np.empty_like(e), np.empty_like(e)
        x = np.full((len(length), k), 1.0 / k)
        for t in range(deep):
            x = (x @ a if t else x) * e[:, t]
            x /= x.sum(axis=1, keepdims=True)
            fwd[:, t] = x
        x = np.full((len(length), k), 1.0 / k)
        for t in range(deep - 1, -1, -1):
            bwd[:, t] = x
            y = (x * e[:, t]) @ a.T
            y /= y.sum(axis=1, keepdims=True)
            x = np.where(live[:, t][:, None], y, x)
        moves = np.zeros((k, k))
        for t in range(1, deep):
            pair = fwd[:, t - 1][:, :, None] * a[None] * (e[:, t] * bwd[:, t])[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            moves += pair[live[:, t]].sum(axis=0)
        both = (fwd * bwd)[live]
        return both / both.sum(axis=1, keepdims=True), moves

    def fit(self, windows: list[str], labels: list[int]) -> None:
        """Maximum likelihood of the windows, all words of one labelled alike."""
        w, k = read_words(windows), len(self.langs)
        length = np.diff(w.at)
        gold = np.eye(k)[np.repeat(np.array(labels), length)]
        numbers = self._numbers(w)
        owner = [np.repeat(np.arange(len(lo)), hi - lo) for _, lo, hi in numbers]
        cells = [num[np.repeat(lo, hi - lo) + (np.arange(len(o)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo))]
                 for (num, lo, hi), o in zip(numbers, owner)]
        power = [np.full(t.shape, 1e-6) for t in self.tables]
        move_power = np.full((k, k), 1e-6)
        follow = np.ones(len(gold), dtype=bool)
        follow[w.at[:-1][length > 0]] = False           # words with one before them
        pairs = np.flatnonzero(follow)
        for _ in range(EPOCHS):
            post, have = self._expected(self.emissions(w), w.at)
            miss = (gold - post) / len(gold)
            for i, table in enumerate(self.tables):
                g = np.stack([np.bincount(cells[i], weights=miss[owner[i], c], minlength=1 << BITS) for c in range(k)], axis=1)
                g -= RIDGE * table / len(gold)
                power[i] += g * g
                table += (RATE * g / np.sqrt(power[i])).astype(np.float32)
            want = gold[pairs - 1].T @ gold[pairs] / len(gold)
            g = want - have / len(gold) - RIDGE * self.moves
            move_power += g * g
            self.moves += RATE * g / np.sqrt(move_power)

    def votes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: mean posterior of every language over its words with a
        letter, and whether there is any."""
        w = read_words(texts)
        post = self.posteriors(self.emissions(w), w.at)
        letter = np.concatenate(([0], np.cumsum((w.buf >= 128) | ((w.buf >= 97) & (w.buf <= 122)))))
        counts = (letter[w.last] > letter[w.first]).astype(float)
        run = np.vstack((np.zeros((1, len(self.langs) + 1)), np.cumsum(np.column_stack((post * counts[:, None], counts)), axis=0)))
        total = run[w.at[1:]] - run[w.at[:-1]]
        some = np.array([bool(t) and _LETTER.search(t) is not None for t in texts])
        return total[:, :-1] / np.maximum(total[:, -1:], 1.0), some & (total[:, -1] > 0)

    def runs(self, text: str | None) -> list[tuple[str, int, int]]:
        """(language, first word, words) of every run of equally labelled words."""
        w = read_words([text])
        best = self.posteriors(self.emissions(w), w.at).argmax(axis=1)
        cut = np.concatenate(([0], np.flatnonzero(np.diff(best)) + 1, [len(best)])) if len(best) else np.zeros(1, dtype=int)
        return [(self.langs[best[a]], int(a), int(b - a)) for a, b in zip(cut[:-1], cut[1:])]


def _windows(text: str) -> list[str]:
    words = text.split()
    starts = sorted({int(s) for s in np.linspace(0, max(0, len(words) - WINDOW), WINDOWS)})
    return [" ".join(words[s:s + WINDOW]) for s in starts] if words else []


def training_texts(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> list[tuple[str, str]]:
    """About ``TRAIN_TEXTS`` (text, language) pairs per language, chosen by a
    hash of the id; one pass counts, one reads the chosen texts."""
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang_col).count().limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not counts:
        return []
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col(lang_col) == lang, 1.5 * TRAIN_TEXTS / n + 20 / n).otherwise(share)
    place = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / (1 << 30)
    rows = (known.withColumn("u", place).where(F.col("u") < share)
            .select("u", F.col(lang_col).alias("l"), F.substring(text_col, 1, TRAIN_CHARS).alias("t"))
            .orderBy("u", "l", "t").limit(3 * TRAIN_TEXTS * len(counts)).collect())
    out, seen = [], dict.fromkeys(counts, 0)
    for r in rows:
        if seen[r.l] < TRAIN_TEXTS:
            seen[r.l] += 1
            out.append((r.t, r.l))
    return out


def train(pairs: list[tuple[str, str]]) -> Tagger | None:
    """A tagger, or None without labelled words."""
    cut = [(w, lang) for text, lang in pairs for w in _windows(text)]
    if not cut:
        return None
    langs = sorted({lang for _, lang in cut})
    tagger = Tagger(langs)
    tagger.fit([w for w, _ in cut], [langs.index(lang) for _, lang in cut])
    return tagger


def _pieces(texts: list[str | None]):
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > PIECE_CHARS:
            yield texts[at:i]
            at, size = i, 0
        size += len(t or "")
    yield texts[at:]


def with_language(df: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` (the language of most word mass) and ``score``
    (that mean probability).  ``und`` and 0 for null texts, texts without a
    letter, and without a model.  No shuffle."""
    def guess(texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for part in _pieces(texts):
            if tagger is None or not part:
                names += [UNKNOWN] * len(part)
                scores += [0.0] * len(part)
                continue
            votes, some = tagger.votes(part)
            best = votes.argmax(axis=1)
            names += [tagger.langs[b] if s else UNKNOWN for b, s in zip(best, some)]
            scores += [float(min(1.0, v[b])) if s else 0.0 for v, b, s in zip(votes, best, some)]
        return names, scores

    @F.pandas_udf("lang_pred string, score double")
    def run(batch: pd.Series) -> pd.DataFrame:
        names, scores = guess(batch.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return df.withColumn("_lang", run(F.col(text_col))).select(*df.columns, "_lang.lang_pred", "_lang.score")
