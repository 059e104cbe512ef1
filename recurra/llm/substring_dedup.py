"""Removal of repeated word windows, found by level-wise doubling.

A window is ``length`` consecutive words of one document. A word goes if any
window that covers it has the same words as a window that starts anywhere else.
Windows are found from short to long: only what is repeated at one length is
extended to twice that length, until the asked length is reached or nothing is
left.

* First length, a quarter of the asked one. Of the short windows inside a long
  one, that with the least hash (leftmost on ties) is its anchor. Equal long
  windows have the same anchor at the same offset, so only anchors, about one
  word in fourteen, are written and counted, and none can be missed.
* Twice that length. An anchor that occurs twice or more is extended to the
  right, or to the left where the long window ends too early; the offset
  decides, so equal long windows agree. Both hashes are written with the
  anchor, so this level reads no text.
* The asked length. Long windows whose extended anchor is repeated are hashed
  to 96 bits and counted. Those found twice or more are removed.

Counting is a grouped count with partial sums before the shuffle; candidates
meet the counts in a semi join, which splits skewed keys. A document's own
anchors and windows are the only lists collected.

Rows: documents are matched on (doc_id, 64-bit hash of the text), so null ids
and repeated rows need no care: a repeated row's windows all start elsewhere
too. A null, empty or short text has no window and loses nothing. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import cut, discard

RIGHT, LEFT = 0, 1
ROWS = 100_000     # anchors written at once
_SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))   # odd multipliers of the two hashes


def _word_hashes(w: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x) for x in w), np.uint64, len(w))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(27))


def _windows(a: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of every window of ``size`` words: doubled up from single words, then mixed."""
    m, n = _SEEDS[seed], len(a)
    if n < size:
        return np.zeros(0, np.uint64)
    out, have, power, length = None, 0, m, 1
    block = _mixed(a + m)
    with np.errstate(over="ignore"):
        while size:
            if size & 1:      # append a block of this length
                out = block if out is None else out[:len(out) - length] * power + block[have:]
                have += length
            size >>= 1
            if size:
                block = block[:len(block) - length] * power + block[length:]
                length, power = 2 * length, power * power
    return _mixed(out[:n - have + 1])


def _anchors(short: np.ndarray, span: int) -> np.ndarray:
    """For every start: place of the least of the next ``span`` hashes, the leftmost on ties."""
    at = np.arange(len(short))
    best, width = at, 1
    while width < span:
        step = min(width, span - width)
        a, b = best[:len(best) - step], best[step:]
        best = np.where(short[b] < short[a], b, a)
        width += step
    return best


class _Levels:
    """Lengths of the levels, and the anchors of one document."""

    def __init__(self, length: int):
        self.length = length
        self.short = max(1, (length + 3) // 4)
        self.double = min(2 * self.short, (length + self.short) // 2)

    def of(self, words: list[bytes]):
        """Word hashes; of each long window its anchor and the side it is extended to."""
        a = _word_hashes(words)
        short = _windows(a, self.short)
        anchor = _anchors(short, self.length - self.short + 1)
        side = np.where(anchor - np.arange(len(anchor)) <= self.length - self.double, RIGHT, LEFT)
        return a, short, anchor, side

    def rows(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """The distinct anchors: place, side, hash, extended hash."""
        a, short, anchor, side = self.of(words)
        double = _windows(a, self.double)
        key = np.unique(anchor * 2 + side)
        at, side = key >> 1, key & 1
        begin = np.where(side == RIGHT, at, at - (self.double - self.short))
        return at, side, short[at].view(np.int64), double[begin].view(np.int64)


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    # ids travel as strings: pandas would turn whole numbers beside a null into floats
    return docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                       F.col(text).cast("binary").alias("text"))


KEY = ["doc_id", "text_hash"]


def _with_lists(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Documents with their list from a grouped table, null where there is none."""
    named = lists.withColumnsRenamed({c: f"of_{c}" for c in KEY})
    same = docs["doc_id"].eqNullSafe(named["of_doc_id"]) & (docs["text_hash"] == named["of_text_hash"])
    return docs.join(named, same, "left").drop("of_doc_id", "of_text_hash")


def _repeated(found: DataFrame, key: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``found`` whose key occurs twice or more, and the table of those keys."""
    often = cut(found.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), label)
    return found.join(often, key, "left_semi"), often


def candidates(docs: DataFrame, length: int) -> DataFrame:
    """Per document (doc_id, text_hash): the anchors whose doubled window is repeated, as 2 * place + side."""
    levels = _Levels(length)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, found = [], []
            for i, k, t in zip(b["doc_id"], b["text_hash"], b["text"]):
                w = (t or b"").split()
                if len(w) >= length:
                    at, side, short, double = levels.rows(w)
                    ids += [i] * len(at)
                    found.append((np.full(len(at), k), (at * 2 + side).astype(np.int32), short, double))
                if len(ids) >= ROWS:
                    yield frame(ids, found)
                    ids, found = [], []
            if ids:
                yield frame(ids, found)

    def frame(ids: list, found: list) -> pd.DataFrame:
        columns = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"doc_id": ids, **dict(zip(("text_hash", "anchor", "short", "double"), columns))})

    rows = cut(docs.mapInPandas(emit, "doc_id string, text_hash long, anchor int, short long, double long"), "anchors")
    found, often = _repeated(rows, ["short"], "short-repeats")
    found = cut(found.drop("short"), "level-1")
    discard(rows, often)
    twice, often = _repeated(found.withColumn("side", F.col("anchor").bitwiseAND(1)), ["double", "side"], "double-repeats")
    out = cut(twice.groupBy(*KEY).agg(F.collect_set("anchor").alias("anchors")), "candidates")
    discard(found, often)
    return out


def _covered(starts: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of n words are covered by the windows at these starts."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + length, -1)
    return np.cumsum(step[:n]) > 0


def remove_repeats(docs: DataFrame, length: int = 35, text: str = "text", doc_id: str = "doc_id",
                   with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (words joined by one space), kept_sha256.

    ``with_text=False`` leaves out ``kept``.
    """
    kind = docs.schema[doc_id].dataType
    docs, levels = _keyed(docs, text, doc_id), _Levels(length)
    found = candidates(docs, length)
    columns = [*KEY, "text", "starts", "high", "low", "n", "digest"]

    def long_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 256):
                part = b.iloc[i:i + 256][[*KEY, "text", "anchors"]]
                yield pd.DataFrame([hashed(*x) for x in part.itertuples(index=False)], columns=columns)

    def hashed(i, k, t, anchors):
        w = (t or b"").split()
        if anchors is None:      # nothing can go: done here, and without its text from here on
            kept = b" ".join(w)
            return i, k, kept if with_text else None, None, None, None, len(w), hashlib.sha256(kept).hexdigest()
        a, _, anchor, side = levels.of(w)
        starts = np.flatnonzero(np.isin(anchor * 2 + side, np.asarray(anchors)))
        high, low = (_windows(a, length, s)[starts] for s in (0, 1))
        return i, k, t, starts.astype(np.int32), high.view(np.int64), low.astype(np.uint32).view(np.int32), None, None

    held = cut(_with_lists(docs, found).mapInPandas(
        long_windows, "doc_id string, text_hash long, text binary, starts array<int>, high array<long>, low array<int>, "
                      "n long, digest string"), "long-windows")
    discard(found)
    each = (held.where("starts IS NOT NULL")
            .select(*KEY, F.explode(F.arrays_zip("starts", "high", "low")).alias("w"))
            .select(*KEY, F.col("w.starts").alias("start"), F.col("w.high").alias("high"), F.col("w.low").alias("low")))
    twice, often = _repeated(each, ["high", "low"], "long-repeats")
    hits = cut(twice.groupBy(*KEY).agg(F.collect_set("start").alias("hits")), "hits")
    discard(often)

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t, n, digest, starts in zip(b["doc_id"], b["text"], b["n"], b["digest"], b["hits"]):
                if digest is not None:
                    out.append((i, int(n), 0, t.decode() if with_text else None, digest))
                    continue
                w, gone = t.split(), 0
                n = len(w)
                if starts is not None:
                    cover = _covered(np.asarray(starts), n, length)
                    gone = int(cover.sum())
                    w = [x for x, c in zip(w, cover.tolist()) if not c]
                kept = b" ".join(w)
                out.append((i, n, gone, kept.decode() if with_text else None, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    out = (_with_lists(held.select(*KEY, "text", "n", "digest"), hits).select("doc_id", "text", "n", "digest", "hits")
           .mapInPandas(clean, "doc_id string, n_words long, n_removed long, kept string, kept_sha256 string")
           .withColumn("doc_id", F.col("doc_id").cast(kind)))
    return out if with_text else out.drop("kept")
