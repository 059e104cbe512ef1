"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``size`` consecutive words; an item of fewer
words, but not none, is one window. A document word is hit if any occurrence of
a window in the document covers it. Words are runs of digits, letters and
characters beyond ASCII, with A-Z lower-cased.

1. A window is a set of placed shingles of ``shingle`` words (all its words, if
   it has fewer). Documents are read once: their shingles that any window has
   are written with their places.
2. The shingles are counted over all documents, which orders them by rarity. A
   window that must be contained whole has a necessary prefix of one shingle,
   its rarest; where that one is in no document, the window is in none.
3. The prefix shingles are joined with the written ones. The place of a shingle
   in its window gives the place of the window, which must lie within the
   document (positional and length bound).
4. What is left is verified over the item-sized window: the shingles that cover
   it must stand at their places. They are compared as text, so this is exact.

The windows' shingles are broadcast only after their bytes have been summed and
found under ``BROADCAST_BYTES``; beyond that they are joined by a shuffle. No
list is collected but a document's own items. Copies of a row are merged by key
before anything is counted, and one document's words are never in one task
unless they are hit.

Rows: documents are matched on (doc_id, 64-bit hash of the text), null-safe, so
null ids and repeated rows need no care. A null, empty or wordless text has no
words and no hit. Very long texts are read whole. An item without words has no
window; rows of one item_id make one item, and a null item_id is written as the
empty text. Empty tables give empty results, or no hits. Other columns are not
read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import cut, let

SIZE = 10
SHINGLE = 5
BROADCAST_BYTES = 32 << 20

# Every other ASCII character is part of a word (A-Z after lower-casing), and so is everything beyond ASCII.
NO_WORD = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
NO_WORD_RUN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
KEY = ("doc_id", "text_hash")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, and nothing else changed."""
    def plain(t: Column) -> Column:
        return F.octet_length(t) == F.length(t)
    runs = F.regexp_extract_all(text, F.lit("[\\x00-\\x7F]+|[^\\x00-\\x7F]+"), F.lit(0))
    return F.when(plain(text), F.lower(text)).otherwise(
        F.array_join(F.transform(runs, lambda r: F.when(plain(r), F.lower(r)).otherwise(r)), ""))


def item_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for a null text."""
    return let(F.trim(F.coalesce(text, F.lit("")), F.lit(NO_WORD)), lambda bare: F.when(
        bare == "", F.array().cast("array<string>")).otherwise(F.split(lower_ascii(bare), NO_WORD_RUN)))


def runs_of(words: Column, k: int) -> Column:
    """Every run of k words, joined by spaces, in order; none if there are fewer words."""
    return F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(0))),
                       lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + j) for j in range(1, k)]))


def _shingled(words: Column, shingle: int) -> Column:
    """(offset, token) of a window's shingles; a shorter window is its only one."""
    short = F.array(F.array_join(words, " "))
    tokens = F.when(F.size(words) < shingle, short).otherwise(runs_of(words, shingle))
    return F.transform(tokens, lambda t, i: F.struct(i.alias("offset"), t.alias("token")))


def item_windows(items: DataFrame, text: str = "text", item_id: str = "item_id", size: int = SIZE) -> DataFrame:
    """item, window (its words joined by spaces): every window of every item once."""
    ws = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), item_words(F.col(text)).alias("ws"))
    windows = F.when(F.size("ws") >= size, runs_of(F.col("ws"), size)).otherwise(F.array(F.array_join("ws", " ")))
    return ws.where(F.size("ws") > 0).select("item", F.explode(windows).alias("window")).distinct()


def _same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])


def _exploded(read: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, n_words, pos, token: every run of k words of every document, as rows.

    The shifted word arrays are zipped and joined after the generator, in
    generated code, which takes half the time of ``runs_of`` over a whole text.
    An outer generator, as for an inner one the optimiser would ask whether the
    array is empty, and so split every text a second time.
    """
    n = F.greatest(F.size("ws") - (k - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice("ws", F.lit(1 + j), n).alias(f"w{j}") for j in range(k)])
    token = F.concat(F.col("run.w0"), *[c for j in range(1, k) for c in (F.lit(" "), F.col(f"run.w{j}"))])
    return (read.select(*KEY, F.size("ws").alias("n_words"), F.posexplode_outer(zipped).alias("pos", "run"))
            .select(*KEY, "n_words", "pos", token.alias("token")))


def _shingles_of_windows(docs: DataFrame, tokens: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash, n_words, pos, token: the documents' shingles that are among ``tokens``, written once."""
    held = tokens.agg(F.sum(F.octet_length("token") + 32)).first()[0] or 0
    sides = F.broadcast(tokens) if held <= BROADCAST_BYTES else tokens
    lengths = [r[0] for r in tokens.select("k").distinct().collect()]      # at most ``shingle`` of them
    read = docs.select(*KEY, item_words(F.col("text")).alias("ws"))
    parts = [_exploded(read, k) for k in lengths] or [_exploded(read.where("false"), 1)]
    found = reduce(DataFrame.unionByName, [p.join(sides.select("token"), "token") for p in parts])
    return cut(found.select(*KEY, "n_words", "pos", "token").distinct(), "item-shingles")


def occurrences(docs: DataFrame, windows: DataFrame, size: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """Where windows occur: doc_id, text_hash, start (word, from 0), length (words), window; written once.

    ``docs`` has doc_id, text_hash and text, ``windows`` has window.
    """
    shingle = min(shingle, size)
    sets = cut(windows.select("window").distinct().withColumn("ws", F.split("window", " "))
               .select("window", F.size("ws").alias("length"), _shingled(F.col("ws"), shingle).alias("parts")), "windows")
    tokens = (sets.select(F.explode("parts.token").alias("token"), F.least("length", F.lit(shingle)).alias("k"))
              .distinct())
    found = _shingles_of_windows(docs, cut(tokens, "window-shingles"), shingle)

    often = found.groupBy("token").agg(F.count("*").alias("often"))
    placed = sets.select("window", "length", "parts", F.explode("parts").alias("part")).select(
        "window", "length", "parts", F.col("part.offset").alias("offset"), F.col("part.token").alias("token"))
    rank = F.struct(F.coalesce("often", F.lit(0)), "offset")
    rarest = (placed.join(often, "token", "left").groupBy("window")
              .agg(F.min_by(F.struct("offset", "token", "length", "parts", "often"), rank).alias("p"))
              .where("p.often IS NOT NULL").select("window", "p.*"))
    # the shingles that cover the window: every k-th, and the last
    k = F.least("length", F.lit(shingle))
    cover = let(k, lambda n: F.filter("parts", lambda p: (p["offset"] % n == 0) | (p["offset"] == F.col("length") - n)))
    prefix = cut(rarest.select("window", "length", "offset", "token", cover.alias("cover")), "rarest-shingles")

    start = F.col("pos") - F.col("offset")
    within = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    candidates = (found.join(prefix, "token").where(within)
                  .select(*KEY, start.alias("start"), "length", "window", F.size("cover").alias("needed"),
                          F.explode("cover").alias("c"))
                  .select(*KEY, "start", "length", "window", "needed", (F.col("start") + F.col("c.offset")).alias("pos"),
                          F.col("c.token").alias("token")))
    there = (_same_document(candidates, found) & (candidates["pos"] == found["pos"]) & (candidates["token"] == found["token"]))
    whole = (candidates.join(found, there, "left_semi").groupBy(*KEY, "start", "length", "window", "needed")
             .agg(F.count("*").alias("n")).where("n = needed"))
    return cut(whole.select(*KEY, "start", "length", "window"), "occurrences")


def covered_words(found: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_hit: the words that a document's occurrences cover, each counted once."""
    from pyspark.sql import Window
    before = Window.partitionBy(*KEY).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    return found.withColumn("fresh", fresh).groupBy(*KEY).agg(F.sum("fresh").alias("n_hit"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id", size: int = SIZE,
                  shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (ids of items with an occurring window, as sorted strings)."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    windows = cut(item_windows(items, item_text, item_id, size), "item-windows")
    found = occurrences(keyed, windows, size, shingle)
    named = found.select(*KEY, "window").distinct().join(windows, "window").select(*KEY, "item").distinct()
    lists = named.groupBy(*KEY).agg(F.array_sort(F.collect_list("item")).alias("items"))
    hits = covered_words(found)
    hit = cut(hits.join(lists, _same_document(hits, lists)).select(hits["doc_id"], hits["text_hash"], "n_hit", "items"),
              "hit-documents")
    every = keyed.select(*KEY, F.size(item_words(F.col("text"))).cast("long").alias("n_words"))
    return (every.join(hit, _same_document(every, hit), "left")
            .select(every["doc_id"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))
