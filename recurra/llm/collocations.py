"""Phrase collocations by prefix-free parsing.

Texts are cut at punctuation and line ends into pieces of words. With phrases
of up to L words:

1. Parse. A piece is cut where the L - 1 words from a place on hash to a trigger
   value; only the words decide, so equal passages are cut alike wherever they
   stand. Neighbouring chunks overlap by these L - 1 words. The distinct chunks,
   with the language, are the dictionary, and their counts the frequencies of
   the parse. A repeated passage costs its chunks once.
2. Count. Phrases are counted inside the distinct chunks, each weighted by its
   chunk's frequency. A phrase belongs to the chunk in which it begins before the
   overlap with the next one, so that it is counted once; the last chunk of a
   piece owns all of its words. Every phrase of up to L words lies whole in the
   chunk that it belongs to.
3. Score. A phrase with ``least`` or more occurrences is a candidate. Cut after
   its first k words, it scores floor(10^6 a^2 / (l r)) from its own count and
   those of its two parts; the lowest cut counts. Counts are whole decimals, so
   this is exact.
4. Drop candidates that lie inside a longer one with at least ``share`` percent
   of their occurrences, and rank the others by language.

Counting combines before every shuffle, and tables are written between the steps,
so no key's rows meet in one task: the joins of step 3 have written tables on
both sides, whose skewed keys Spark splits. Only the ``best`` of a language are
sorted together. Nothing passes through the driver.

Rows: a null or blank text has no words; a null language is ``und``. Very long
texts are parsed whole. Repeated rows count as often as they stand. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import cut, discard

LONGEST = 3
LEAST = 10
SHARE = 50
BEST = 2000
PARTS = 8              # one place in so many is a trigger; a chunk repeats longest - 1 words, so short ones cost more words
HELD = 100_000         # distinct chunks that a task holds before it writes them
BREAKS = b".,;:!?\n\x0b\x0c\r"      # fixed by the definition of a piece
BREAK = b"\n"          # stands for all of them
# A-Z in lower case, all breaks as line ends, tabs as spaces
_PLAIN = bytes(10 if c in BREAKS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_MULTIPLIER = 0x9E3779B1
_NUMBERS = np.random.default_rng(0x9E37).integers(0, 1 << 32, 1 << 16, dtype=np.uint32)
_NUMBERS[32 << 8:33 << 8] = 0        # a space begins none


def chunks(data: bytes, overlap: int, parts: int = PARTS) -> Iterator[tuple[int, bytes]]:
    """(number of own words, chunk) of the pieces between breaks, from left to right.

    ``data`` is words and breaks with one space between them.
    """
    if not data:
        return
    raw = np.frombuffer(data + b" ", np.uint8)
    spaces = np.flatnonzero(raw == 32)
    starts, stops = np.append(0, spaces[:-1] + 1), spaces
    n, size = len(starts), stops - starts
    # a word's hash adds up a number for each of its bytes and the byte after it, the space at its end among them
    h = np.add.reduceat(_NUMBERS[raw[:-1].astype(np.uint16) << 8 | raw[1:]], starts, dtype=np.uint32)
    word = np.concatenate([[False], (size > 1) | (raw[starts] != 10), [False] * (overlap + 1)])      # breaks around
    h = np.append(h, np.zeros(overlap, np.uint32))
    inside, mixed = word[:n].copy(), np.zeros(n, np.uint32)     # a word before, and words up to one after the overlap
    for j in range(overlap + 1):
        inside &= word[1 + j:1 + j + n]
        if j < overlap:
            mixed = (mixed * np.uint32(31) + h[j:j + n]) * np.uint32(_MULTIPLIER)
    cut = inside & (mixed >> np.uint32(8) < (1 << 24) // parts)
    begins = np.flatnonzero(cut | word[1:n + 1] & ~word[:n])
    ends = np.append(np.flatnonzero(~word[1:n + 1]), n)
    piece = ends[np.searchsorted(ends, begins)]
    nxt = np.append(begins[1:], n)
    goes_on = np.append(cut[begins[1:]], False)[:len(begins)]
    own = np.where(goes_on, nxt[:len(begins)], piece) - begins
    last = np.where(goes_on, nxt[:len(begins)] + overlap, piece) - 1
    for k, i, j in zip(own.tolist(), starts[begins].tolist(), stops[last].tolist()):
        yield k, data[i:j]


def parse(docs: DataFrame, longest: int = LONGEST, text: str = "text", lang: str = "lang") -> DataFrame:
    """The dictionary: lang, own, chunk, n (frequency in the parse); written once."""
    overlap, parts = max(1, longest - 1), PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}

        def written() -> pa.RecordBatch:
            of, own, chunk = zip(*held) if held else ((), (), ())
            out = pa.RecordBatch.from_arrays([
                pa.array(of, pa.string()), pa.array(own, pa.int32()), pa.array(chunk, pa.binary()).cast(pa.string()),
                pa.array(held.values(), pa.int64())], names=["lang", "own", "chunk", "n"])
            held.clear()
            return out

        for b in batches:
            for of, t in zip(b.column(0).to_pylist(), b.column(1)):
                apart = (t.as_py() or b"").translate(_PLAIN).replace(BREAK, b" \n ").split(b" ")
                for own, chunk in chunks(b" ".join(filter(None, apart)), overlap, parts):
                    held[of, own, chunk] = held.get((of, own, chunk), 0) + 1
                if len(held) >= HELD:
                    yield written()
        yield written()

    read = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    each = read.mapInArrow(run, "lang string, own int, chunk string, n long")
    return cut(each.groupBy("lang", "own", "chunk").agg(F.sum("n").alias("n")), "dictionary")


def count_phrases(dictionary: DataFrame, k: int) -> DataFrame:
    """lang, phrase, f: every phrase of k words with its number of occurrences."""
    # shifted word arrays, zipped, and joined after the generator in generated code; an outer generator, as for an
    # inner one the optimiser would work the array out a second time, to ask whether it is empty
    n = F.greatest(F.least("own", F.size("ws") - (k - 1)), F.lit(0))
    runs = F.arrays_zip(*[F.slice("ws", F.lit(1 + j), n).alias(f"w{j}") for j in range(k)])
    phrase = F.concat(F.col("run.w0"), *[c for j in range(1, k) for c in (F.lit(" "), F.col(f"run.w{j}"))])
    return (dictionary.select("lang", "own", "n", F.split("chunk", " ").alias("ws"))
            .select("lang", "n", F.explode_outer(runs).alias("run")).where("run IS NOT NULL")
            .select("lang", "n", phrase.alias("phrase"))
            .groupBy("lang", "phrase").agg(F.sum("n").alias("f")))


def _words(phrase: Column, begin: int, k: int) -> Column:
    """k words of a phrase, from word ``begin`` (0 is the first) on."""
    return F.array_join(F.slice(F.split(phrase, " "), begin + 1, k), " ")


def _count_of(rows: DataFrame, counts: DataFrame, part: Column, name: str) -> DataFrame:
    named = counts.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of_phrase"), F.col("f").alias(name))
    rows = rows.withColumn("part", part)
    return rows.join(named, (rows["lang"] == named["of_lang"]) & (rows["part"] == named["of_phrase"])) \
        .drop("of_lang", "of_phrase", "part")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(10^6 a^2 / (l r)) in whole decimals."""
    whole = [c.cast("decimal(19,0)") for c in (a, left, right)]
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (whole[0] * whole[0]), whole[1] * whole[2])


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, best: int = BEST,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``best`` phrases of 2 to ``longest`` words of every language."""
    dictionary = parse(docs, longest, text, lang)
    # parts of a candidate occur as often as it does: counts of longer phrases are kept from ``least`` on
    counts = {k: cut(count_phrases(dictionary, k).where(F.col("f") >= (least if k > 1 else 1)), f"phrases-{k}")
              for k in range(1, longest + 1)}
    discard(dictionary)
    total = counts[1].groupBy("lang").agg(F.sum("f").alias("n"))
    scored = []
    for m in range(2, longest + 1):
        rows = counts[m].withColumnRenamed("f", "a")
        cuts = []
        for k in range(1, m):
            rows = _count_of(rows, counts[k], _words(F.col("phrase"), 0, k), f"l{k}")
            rows = _count_of(rows, counts[m - k], _words(F.col("phrase"), k, m - k), f"r{k}")
            left, right = F.col(f"l{k}"), F.col(f"r{k}")
            cuts.append(F.struct(score(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
        lowest = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        rows = cut(rows.select("lang", "phrase", "a", lowest.alias("s")), f"scored-{m}")
        longer = [counts[j].select("lang", _words(F.col("phrase"), at, m).alias("inner"), "f")
                  for j in range(m + 1, longest + 1) for at in range(j - m + 1)]
        if longer:
            inside = reduce(DataFrame.unionByName, longer).groupBy("lang", "inner").agg(F.max("f").alias("f"))
            holds = ((rows["lang"] == inside["lang"]) & (rows["phrase"] == inside["inner"])
                     & (inside["f"] * 100 >= rows["a"] * share))
            rows = rows.join(inside, holds, "left_anti")
        scored.append(rows)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (reduce(DataFrame.unionByName, scored).select("lang", "phrase", "a", "s.l", "s.r", "s.score")
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best))
    return (ranked.join(total.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of"))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
