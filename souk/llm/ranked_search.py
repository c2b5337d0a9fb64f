"""Ranked lexical search: hybrid term-at-a-time / document-at-a-time top k.

An item is a bag of terms; a document's score is an integer sum of one
contribution per term it shares with the item (BM25-like, all 64-bit integers
but for the term weight).  The documents are cut into blocks by a hash of the
row; every block is searched for every item by one group of a cogrouped map:

* the item's short posting lists are summed term at a time into accumulators;
* the accumulators are then one iterator among the item's long lists, with a
  bound of its own per window of documents, and the block is passed document
  window by document window: a window whose summed bounds cannot reach the k-th
  score so far is skipped, in the others the long lists are added.

Bounds are exact maxima and a window is only skipped when its bound lies
strictly below the k-th score, so the result is that of scoring everything.

Nulls and other cases: a null or empty text has no term and is not counted in
``N``; an item without terms finds nothing; a repeated item or document row is
an item or document of its own; equal scores go by ascending ``doc_id`` (null
last); empty tables give an empty result.  Columns other than the named ones
are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import drop_saved, saved
from souk.operators.sinks import sequential_id

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP_K = 10
VOCAB_BYTES = 32 << 20          # item terms up to this size travel with the tasks; beyond, a shuffle join
BLOCK_POSTINGS = 1_000_000      # postings of item terms per block of documents, on average
BATCH_TERMS = 100_000           # item terms searched together
WINDOW_DOCS = 128               # documents per window of the bounds
SHORT_SHARE = 32                # a list is short if it holds at most 1/32 of the block's documents

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: Column) -> Column:
    """The terms of a text in order, A-Z lower-cased."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0)),
                      F.array().cast("array<string>"))


def _document_terms(number: dict | None):
    """Arrow function: a document's length and the counts of its terms; with
    ``number`` (term -> id) of the item terms only, by their ids."""
    find = re.compile(TERM).findall

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ns, terms, tfs = [], [], []
            for text in pdf["text"]:
                # bytes.lower() changes A-Z only
                words = find(text.encode("utf-8").lower().decode("utf-8")) if text else []
                held = Counter(words)
                ns.append(len(words))
                if number is None:
                    terms.append(list(held))
                    tfs.append(list(held.values()))
                else:
                    known = [t for t in held if t in number]
                    terms.append([number[t] for t in known])
                    tfs.append([held[t] for t in known])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": ns, "terms": terms, "tfs": tfs})
    return run


def _postings(docs: DataFrame, vocab: DataFrame, vocab_bytes: int) -> DataFrame:
    """Stored, one row per document: ``doc, doc_id, n, ids, tfs`` (numbers and
    counts of the item terms it holds)."""
    size = vocab.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    key = F.monotonically_increasing_id().alias("doc")
    if size <= vocab_bytes:
        number = {r.term: r.id for r in vocab.collect()}
        found = plain.mapInPandas(_document_terms(number), "doc_id long, n long, terms array<long>, tfs array<long>")
        return saved(found.select(key, "doc_id", "n", F.col("terms").alias("ids"), "tfs"), "search-postings")
    found = plain.mapInPandas(_document_terms(None), "doc_id long, n long, terms array<string>, tfs array<long>")
    rows = saved(found.select(key, "*"), "search-terms")
    pairs = rows.select("doc", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select("doc", F.col("p.terms").alias("term"), "p.tfs")
    known = (pairs.join(vocab, "term").groupBy("doc")
             .agg(F.collect_list(F.struct("id", "tfs")).alias("p"))        # of one document: at most the item terms
             .select("doc", F.col("p.id").alias("ids"), F.col("p.tfs").alias("tfs")))
    none = F.array().cast("array<long>")
    out = saved(rows.select("doc", "doc_id", "n").join(known, "doc", "left").select(
        "doc", "doc_id", "n", F.coalesce("ids", none).alias("ids"), F.coalesce("tfs", none).alias("tfs")), "search-postings")
    drop_saved(docs.sparkSession, rows)
    return out


def _search_block(key: tuple, docs: pd.DataFrame, items: pd.DataFrame, k: int, n_docs: int, n_terms: int) -> pd.DataFrame:
    """The ``k`` best documents of one block for every item of one batch."""
    out_cols = ["item", "doc", "doc_id", "score"]
    if not len(docs) or not len(items):
        return pd.DataFrame({c: np.empty(0, dtype=np.int64) for c in out_cols})
    docs = docs.sort_values(["doc_id", "doc"], na_position="last", kind="stable", ignore_index=True)
    m = 10 + (90 * docs["n"].to_numpy(dtype=np.int64) * n_docs) // n_terms
    sizes = docs["ids"].map(len).to_numpy()
    ids = np.concatenate(docs["ids"].to_list()).astype(np.int64)
    tfs = np.concatenate(docs["tfs"].to_list()).astype(np.int64)
    at = np.repeat(np.arange(len(docs)), sizes)

    weight: dict[int, int] = {}
    for t, w in zip(items["ids"], items["ws"]):
        weight.update(zip(t, w))
    wanted = np.array(sorted(weight), dtype=np.int64)
    place = np.searchsorted(wanted, ids)
    mine = wanted[np.minimum(place, len(wanted) - 1)] == ids
    place, tfs, at = place[mine], tfs[mine], at[mine]
    order = np.argsort(place, kind="stable")                   # lists by term, documents ascending
    place, tfs, at = place[order], tfs[order], at[order]
    ws = np.array([weight[int(t)] for t in wanted], dtype=np.int64)
    value = ws[place] * ((1_000_000_000 * tfs) // (1_000 * tfs + 8 * m[at]))
    begin = np.searchsorted(place, np.arange(len(wanted) + 1))

    starts = np.arange(0, len(docs), WINDOW_DOCS)
    short_most = max(1, len(docs) // SHORT_SHARE)
    long_lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}   # term -> bound per window, offset per window

    def long_list(t: int) -> tuple[np.ndarray, np.ndarray]:
        if t not in long_lists:
            lo, hi = begin[t], begin[t + 1]
            cut = lo + np.searchsorted(at[lo:hi], np.append(starts, len(docs)))
            top = np.zeros(len(starts), dtype=np.int64)
            held = np.flatnonzero(cut[1:] > cut[:-1])
            top[held] = np.maximum.reduceat(value[lo:hi], cut[held] - lo)
            long_lists[t] = top, cut
        return long_lists[t]

    found = {c: [] for c in out_cols}
    for item, terms in zip(items["item"], items["ids"]):
        lists = [t for t in np.searchsorted(wanted, np.asarray(terms, dtype=np.int64)) if begin[t + 1] > begin[t]]
        short = [t for t in lists if begin[t + 1] - begin[t] <= short_most]
        longer = [long_list(t) for t in lists if begin[t + 1] - begin[t] > short_most]
        acc = np.zeros(len(docs), dtype=np.int64)              # term at a time
        for t in short:
            acc[at[begin[t]:begin[t + 1]]] += value[begin[t]:begin[t + 1]]
        bound = np.maximum.reduceat(acc, starts)
        for top, _ in longer:
            bound = bound + top
        least = 1                                              # scores below this cannot be among the k best
        if len(acc) >= k:
            least = max(least, int(np.partition(acc, len(acc) - k)[len(acc) - k]))
        best, best_at = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for w, start in enumerate(starts):                     # document at a time, by windows
            if bound[w] < least:
                continue
            score = acc[start:start + WINDOW_DOCS].copy()
            for _, cut in longer:
                span = slice(cut[w], cut[w + 1])
                score[at[span] - start] += value[span]
            good = np.flatnonzero(score >= least)
            if len(good):
                best, best_at = np.append(best, score[good]), np.append(best_at, good + start)
                if len(best) > k:
                    keep = np.lexsort((best_at, -best))[:k]
                    best, best_at = best[keep], best_at[keep]
                if len(best) == k:
                    least = max(least, int(best.min()))
        found["item"] += [item] * len(best)
        found["doc"] += docs["doc"].to_numpy()[best_at].tolist()
        found["doc_id"] += docs["doc_id"].iloc[best_at].astype("Int64").tolist()
        found["score"] += best.tolist()
    return pd.DataFrame({c: pd.array(v, dtype="Int64") for c, v in found.items()})


def _upto(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def top_documents(docs: DataFrame, items: DataFrame, k: int = TOP_K, vocab_bytes: int = VOCAB_BYTES,
                  block_postings: int = BLOCK_POSTINGS, batch_terms: int = BATCH_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents (``doc_id,
    text``) of every row of ``items`` (``item_id, text``) with a score above 0.

    With N documents that have a term, L terms in all of them (repeats counted)
    and df documents holding a term, the term weighs
    ``floor(1000 * ln((2N + 2) / (2df + 1)))``; a document of n terms has
    ``m = 10 + (90 n N) div L`` and each shared term of count tf adds
    ``weight * ((10^9 tf) div (1000 tf + 8 m))``.

    A task holds the postings of one block (``block_postings`` on average) and
    the items of one batch; no step gathers more.
    """
    spark = docs.sparkSession
    asked = saved(items.select("item_id", F.array_distinct(terms_of(F.col("text"))).alias("terms"))
                  .select(F.monotonically_increasing_id().alias("item"), "*"), "search-items")
    each = asked.select("item", F.explode("terms").alias("term"))
    vocab = saved(sequential_id(each.select("term").distinct(), ["term"]), "search-vocabulary")
    postings = _postings(docs, vocab, vocab_bytes)
    total = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms"),
                         F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("postings")).first()
    n_docs, n_terms = int(total.docs), max(int(total.terms), 1)
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    weights = (postings.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("df"))
               .select("id", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("w")))
    asked_terms = each.join(vocab, "term").join(weights, "id")         # terms that no document holds find nothing
    n_asked = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total.postings) // block_postings))
    batches = max(1, -(-int(n_asked) // batch_terms))
    batch = F.pmod(F.xxhash64("item"), F.lit(batches)).alias("batch")
    queries = saved(asked_terms.groupBy("item").agg(F.collect_list(F.struct("id", "w")).alias("p"))
                    .select(batch, "item", F.col("p.id").alias("ids"), F.col("p.w").alias("ws")), "search-queries")
    lists = postings.where(F.size("ids") > 0).select(
        F.pmod(F.xxhash64("doc"), F.lit(blocks)).alias("block"), F.explode(_upto(batches)).alias("batch"),
        "doc", "doc_id", "n", "ids", "tfs")
    asked_of = queries.select(F.explode(_upto(blocks)).alias("block"), "*")

    def search(key, left, right):
        return _search_block(key, left, right, k, n_docs, n_terms)

    found = (lists.groupBy("block", "batch").cogroup(asked_of.groupBy("block", "batch"))
             .applyInPandas(search, "item long, doc long, doc_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "doc"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
