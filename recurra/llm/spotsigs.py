"""Document fingerprints by SpotSigs.

A signature is a common word (the anchor) and the ``CHAIN`` content words that
follow it, common words between them skipped. The set of a text's signatures is
its fingerprint; two fingerprints are compared by Jaccard likeness. A text
without a signature is described by the set of its words instead, so that only
texts without a word have the empty fingerprint.

``near_pairs`` finds all pairs of different fingerprints at ``threshold`` or
more. Sets of lengths too far apart cannot reach it, so the lengths are cut into
partitions whose bounds differ by the factor 1 / threshold, and a set meets only
its own partition and the next. There it meets the sets that share one of its
rarest signatures (as many as a likeness of ``threshold`` cannot do without),
and the pairs that pass the length bound are compared in full. Copies are one
set and are never paired.

Everything runs on built-in column functions: signatures come from one pattern
with a lookahead, so that chains may overlap.

Rows: a null text is an empty one. Repeated rows count as one document in the
order of documents and get equal results; ``compare_edits`` reads equal rows in
one task, which drops all but one. Null ids come last in that order. An
empty table gives an empty result; a single document follows itself. Other
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import cut, let

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from have in is it not of on or that the this to was were with "
    "das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au dans de du elle en est et la le les pour que qui un une "
    "con del el los las para por se su y"
).split()
CHAIN = 2


def _any_of(words: list[str]) -> str:
    """A pattern of these words that shares their beginnings, so that few letters are tried at any place."""
    tails: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        if w:
            tails.setdefault(w[0], []).append(w[1:])
    body = "(?:" + "|".join(a + _any_of(t) if any(t) else a for a, t in tails.items()) + ")"
    return body + "?" if "" in words else body


_S = _any_of(ANCHORS)
_SIGNATURE = f" (?=({_S} " + f"(?:{_S} )*+[^ ]+ " * CHAIN + "))"
# possessive: a greedy loop over alternatives recurses once for each word of a run
_INNER = f"(?<= )(?:{_S} )++"
_RUN = f"(?<= )({_S} )\\1++"


def signatures(text: Column) -> Column:
    """The sorted distinct signature hashes of a text."""
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", " "), F.lit(" "))
    # an anchor that follows itself adds no signature; long runs of one word would make chains as long
    plain = F.regexp_replace(plain, _RUN, "$1")

    def hashes(p: Column, chains: Column) -> Column:
        spots = F.transform(chains, lambda s: F.xxhash64(F.regexp_replace(s, _INNER, "")))
        bag = F.transform(F.filter(F.split(p, " +"), lambda w: w != ""), lambda w: F.xxhash64(w))
        return F.when(F.size(chains) > 0, spots).otherwise(bag)

    found = let(plain, lambda p: let(F.regexp_extract_all(p, F.lit(_SIGNATURE), F.lit(1)), lambda c: hashes(p, c)))
    return F.array_sort(F.array_distinct(found))


def fingerprint(sigs: Column) -> Column:
    """A signature set as a short string: its size and a digest of its members."""
    return F.concat(F.size(sigs).cast("string"), F.lit("-"),
                    F.substring(F.sha2(F.array_join(sigs.cast("array<string>"), ","), 256), 1, 32))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets; two empty sets are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def following(docs: DataFrame) -> DataFrame:
    """For every distinct (doc_id, text_hash): the next one in falling order of doc_id, the first after the last.

    ``docs`` has doc_id, text_hash and n_chars. The ids are range-partitioned
    once; each task then looks one row ahead, and the last row of a partition
    takes the first row of the next partition that has one, from a table with
    one row per partition.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash").desc()]
    dealt = cut(docs.groupBy("doc_id", "text_hash").agg(F.first("n_chars").alias("n_chars"))
                .repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "document-order")
    here = Window.partitionBy("part").orderBy(*order)
    after = F.struct("doc_id", "text_hash")
    rows = dealt.withColumn("next", F.lead(after).over(here)).withColumn("nth", F.row_number().over(here))
    firsts = rows.where("nth = 1").select("part", after.alias("first"))
    # one row per partition: their order fits one task
    whole = Window.partitionBy(F.lit(0)).orderBy("part")
    firsts = firsts.select("part", F.coalesce(
        F.lead("first").over(whole),
        F.first("first").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("then"))
    found = F.coalesce("next", "then")
    return (rows.join(F.broadcast(firsts), "part")
            .select("doc_id", "text_hash", "n_chars", found["doc_id"].alias("next_id"), found["text_hash"].alias("next_hash")))


def compare_edits(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprint every document, its edited text and the next document, and compare them.

    The edited text replaces the last third of the code points by as many from
    the beginning of the next document. One row per document: doc_id, n_chars,
    edited, sigs, edited_sigs, next_sigs. Texts are shuffled by document once,
    for both joins; a third of them, with the successor's signatures, goes on to
    the document before. Signatures are found after the first shuffle, which
    they would make half as large again.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    key = F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("text_hash"))     # structs compare null-safe
    texts = docs.select(key.alias("key"), t.alias("text"))
    ids = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("text_hash"), F.length(t).cast("long").alias("n_chars"))
    # hashes are never null; said so, keys of both sides have one type, and both joins read one exchange of the texts
    sure = lambda h: F.coalesce(h, F.lit(0).cast("long")).alias("text_hash")
    asked = cut(following(ids), "following").select(
        F.struct("doc_id", sure("text_hash")).alias("for_key"),
        F.struct(F.col("next_id").alias("doc_id"), sure("next_hash")).alias("next_key"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("take"))
    # a document follows one other: its repeated rows are one row, found where the join has put them
    begun = (texts.join(asked, texts["key"] == asked["next_key"])
             .groupBy("next_key").agg(F.first(F.struct("for_key", "text", "take")).alias("n"))
             .select(F.col("n.for_key").alias("for_key"), F.expr("substring(n.text, 1, n.take)").alias("begin"),
                     signatures(F.col("n.text")).alias("next_sigs")))
    n = F.length("text")
    return (texts.join(begun, texts["key"] == begun["for_key"], "left")
            .select(F.col("key.doc_id").alias("doc_id"), n.cast("long").alias("n_chars"), signatures(F.col("text")).alias("sigs"),
                    "next_sigs", F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")),
                                          F.col("begin")).alias("edited"))
            .withColumn("edited_sigs", signatures(F.col("edited"))))


def near_pairs(docs: DataFrame, threshold: float = 0.8, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Classes of equal fingerprints, and all links between different classes.

    Returns (members, pairs): members has doc_id and class_id (the fingerprint
    string); pairs has a < b (class ids) and likeness >= threshold.
    """
    sigs = cut(docs.select(F.col(doc_id).alias("doc_id"), signatures(F.col(text)).alias("sigs"))
               .withColumn("class_id", fingerprint(F.col("sigs"))), "spotsigs")
    sets = cut(sigs.groupBy("class_id").agg(F.first("sigs").alias("sigs")).withColumn("size", F.size("sigs"))
               .where("size > 0"), "spotsig-sets")
    step = math.log(1 / threshold)
    sets = sets.withColumn("part", F.floor(F.log("size") / F.lit(step) + F.lit(1e-9)).cast("int"))
    each = sets.select("class_id", "size", "part", F.explode("sigs").alias("sig"))
    often = cut(each.groupBy("sig").agg(F.count("*").alias("n")), "spotsig-counts")
    needed = F.col("size") - F.ceil(F.col("size") * F.lit(threshold) - F.lit(1e-9)).cast("int") + 1
    rare = (each.join(often, "sig").groupBy("class_id", "size", "part")
            .agg(F.array_sort(F.collect_list(F.struct("n", "sig"))).alias("by_count"))
            .select("class_id", "size", "part", F.explode(F.slice(F.col("by_count.sig"), F.lit(1), needed)).alias("sig")))
    rare = cut(rare, "spotsig-index")
    a = rare.select(F.col("class_id").alias("x"), F.col("size").alias("x_size"), "part", "sig")
    b = (rare.select(F.col("class_id").alias("y"), F.col("size").alias("y_size"),
                     F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"), "sig"))
    bound = (F.col("y_size") <= F.col("x_size")) & (F.col("y_size") >= F.col("x_size") * F.lit(threshold) - 1e-9)
    once = (F.col("y_size") < F.col("x_size")) | (F.col("x") < F.col("y"))
    found = a.join(b, ["part", "sig"]).where(bound & once & (F.col("x") != F.col("y"))).select("x", "y").distinct()
    xs = sets.select(F.col("class_id").alias("x"), F.col("sigs").alias("x_sigs"))
    ys = sets.select(F.col("class_id").alias("y"), F.col("sigs").alias("y_sigs"))
    pairs = (found.join(xs, "x").join(ys, "y")
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
                     likeness(F.col("x_sigs"), F.col("y_sigs")).alias("likeness"))
             .where(F.col("likeness") >= threshold))
    return sigs.select("doc_id", "class_id"), pairs
