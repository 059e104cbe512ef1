"""Language identification by Bayesian fusion of evidence.

The posterior of a language is, up to a constant, the product of

* the likelihood of the text under a letter-trigram model of the language,
* the likelihood of the declared language (a markup or metadata attribute),
* the likelihood ratio of the address suffix (the last label of the host name),
* the prior of the host, smoothed step by step: host counts lean on those of the
  host's domain, which lean on those of all rows.

The trigram models are fitted on rows with a known declared language, at most
``TRAIN_ROWS`` of them, chosen by hash. The other tables are grouped counts over
all rows, of the language that the text alone suggests; declarations are
weighed by how often they agreed with it. A uniform model stands for text in
none of the languages ("und"). Trigrams of a text are not independent, so its
likelihood counts as at most ``TEXT_WEIGHT`` trigrams, approached smoothly.

Host and suffix tables stay distributed and are joined; the optimiser broadcasts
them only below its size limit, and splits skewed hosts otherwise. The trigram
table (languages x 65,536 numbers) is the only one sent to the tasks whole.

Rows: a row without letters (null, empty, blank or unlettered text) has no text
evidence; its language follows from the rest, and it is not accepted. Null or
unknown declarations, suffixes and hosts are no evidence. Very long texts are
read whole, in blocks. Repeated rows get equal results, an empty table an empty
one. Other columns are returned as they are; one named like the result is
replaced.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import cut

LANGUAGES = ("de", "en", "es", "fr")
UNDETERMINED = "und"
BUCKETS = 1 << 16
BLOCK = 1 << 20            # letters counted at once
TRAIN_ROWS = 200_000       # rows that the trigram models are fitted on, at most
TEXT_WEIGHT = 100.0        # trigrams
PRIOR_ROWS = 20.0          # rows that a level of the host hierarchy borrows from the next
UNDETERMINED_PRIOR = 0.01
ACCEPT = 0.5               # least posterior


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point to itself for letters and marks of the first plane, to 0 for anything else."""
    return np.array([c if unicodedata.category(chr(c))[0] in "LM" else 0 for c in range(1 << 16)], np.uint32)


def _trigrams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the letter trigrams of a text, in blocks; a gap between words counts as one letter."""
    table = _letters()
    for at in range(0, len(text), BLOCK):
        x = np.frombuffer((" " + text[at:at + BLOCK + 1].lower() + " ").encode("utf-32-le", "replace"), "<u4")
        x = table[np.where(x < 1 << 16, x, 0)]
        x = x[np.append(True, (x[1:] != 0) | (x[:-1] != 0))].astype(np.uint64)    # one gap for a run
        h = x[:-2] * np.uint64(0x9E3779B1) + x[1:-1] * np.uint64(0x85EBCA77) + x[2:] * np.uint64(0xC2B2AE3D)
        h = (h ^ (h >> np.uint64(15))) * np.uint64(0x2C1B3C6D)
        yield ((h >> np.uint64(12)) & np.uint64(BUCKETS - 1))[x[1:-1] != 0].astype(np.int64)


def train(docs: DataFrame, text: Column, declared: Column, languages: tuple[str, ...] = LANGUAGES,
          rows: int = TRAIN_ROWS) -> np.ndarray:
    """Log-probabilities [language, bucket] with the uniform model as the last row."""
    known = docs.select(text.alias("text"), F.lower(declared).alias("lang")).where(F.col("lang").isin(*languages))
    share = min(1.0, rows / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for b in batches:
            for lang, t in zip(b["lang"], b["text"]):
                for h in _trigrams(t or ""):
                    total[languages.index(lang)] += np.bincount(h, minlength=BUCKETS)
        for i in range(len(languages)):
            at = np.flatnonzero(total[i])
            yield pd.DataFrame({"i": i, "at": at, "n": total[i, at]})

    out = np.ones((len(languages), BUCKETS))
    counted = sample.mapInPandas(count, "i int, at int, n long").groupBy("i", "at").agg(F.sum("n").alias("n"))
    found = counted.toPandas()
    np.add.at(out, (found["i"].to_numpy(int), found["at"].to_numpy(int)), found["n"].to_numpy(float))
    return np.vstack([np.log(out / out.sum(1, keepdims=True)), np.full(BUCKETS, -math.log(BUCKETS))])


def text_evidence(text: Column, model: np.ndarray) -> Column:
    """Mean log-likelihood of the text's trigrams for every row of the model, then their number."""
    table = np.ascontiguousarray(model.T.astype(np.float32))

    @F.pandas_udf("array<double>")
    def evidence(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            total, n = np.zeros(table.shape[1]), 0
            for h in _trigrams(t or ""):
                seen = np.bincount(h, minlength=BUCKETS) if len(h) > BUCKETS else None
                total += seen @ table if seen is not None else table[h].sum(0, dtype=np.float64)
                n += len(h)
            out.append(np.append(total / max(1, n), n))
        return pd.Series(out)
    # else a filter on the evidence would be pushed below its projection, and work it out again in a second worker
    return evidence.asNondeterministic()(text)


class Fusion:
    """The fitted evidence tables."""

    def __init__(self, model: np.ndarray, languages: tuple[str, ...], declared: dict[str, list[float]],
                 hosts: DataFrame, suffixes: DataFrame, overall: list[float]):
        self.model, self.languages, self.declared = model, languages, declared
        self.hosts, self.suffixes, self.overall = hosts, suffixes, overall

    @staticmethod
    def fit(docs: DataFrame, text: Column, declared: Column, host: Column, suffix: Column, domain: Column,
            languages: tuple[str, ...] = LANGUAGES, rows: int = TRAIN_ROWS) -> "Fusion":
        model, k = train(docs, text, declared, languages, rows), len(languages)
        known = F.when(F.lower(declared).isin(*languages), F.lower(declared))
        seen = docs.select(text_evidence(text, model).alias("e"), known.alias("declared"), host.alias("host"),
                           suffix.alias("suffix"), domain.alias("domain"))
        best = F.array_position(F.slice("e", 1, k + 1), F.array_max(F.slice("e", 1, k + 1))) - 1
        seen = seen.where(F.element_at("e", -1) > 0).withColumn("z", best).where(F.col("z") < k)
        counts = cut(seen.groupBy("host", "domain", "suffix", "declared").agg(
            *[F.sum((F.col("z") == i).cast("long")).alias(f"n{i}") for i in range(k)]), "language-counts")
        sums = [F.sum(f"n{i}").cast("double").alias(f"n{i}") for i in range(k)]
        # a language's own declarations: a few rows, one per language and one for none
        by_declared = {r["declared"]: [r[f"n{i}"] for i in range(k)] for r in counts.groupBy("declared").agg(*sums).collect()}
        total = [sum(v[i] for v in by_declared.values()) for i in range(k)]
        n = sum(total)
        overall = [(x + 1) / (n + k) for x in total]
        names = [*languages, None]
        table = {d: [math.log((by_declared.get(d, [0] * k)[i] + 0.5) / (total[i] + 0.5 * len(names))) for i in range(k)]
                 for d in languages}

        def shares(own: str, parent: list[Column]) -> list[Column]:
            rows_of = sum((F.col(f"{own}{i}") for i in range(1, k)), F.col(f"{own}0"))
            return [(F.col(f"{own}{i}") + PRIOR_ROWS * parent[i]) / (rows_of + PRIOR_ROWS) for i in range(k)]

        base = [F.lit(x) for x in overall]
        domains = counts.groupBy(F.col("domain").alias("of_domain")).agg(*[s.alias(f"d{i}") for i, s in enumerate(sums)])
        hosts = (counts.where("host IS NOT NULL").groupBy("host").agg(F.min("domain").alias("domain"), *sums))
        hosts = hosts.join(domains, hosts["domain"].eqNullSafe(domains["of_domain"]), "left")
        prior = shares("n", [F.coalesce(x, b) for x, b in zip(
            [F.when(F.col("domain").isNotNull(), s) for s in shares("d", base)], base)])
        hosts = cut(hosts.select(F.col("host").alias("of_host"), F.array(*[F.log(p) for p in prior]).alias("host_prior")),
                    "host-priors")
        ratio = shares("n", base)
        suffixes = cut(counts.where("suffix IS NOT NULL").groupBy(F.col("suffix").alias("of_suffix")).agg(*sums)
                       .select("of_suffix", F.array(*[F.log(r / b) for r, b in zip(ratio, base)]).alias("suffix_ratio")),
                       "suffix-ratios")
        return Fusion(model, languages, table, hosts, suffixes, overall)

    def apply(self, docs: DataFrame, text: Column, declared: Column, host: Column, suffix: Column,
              out: str = "language_id") -> DataFrame:
        """``docs`` with a struct column ``out``: language, posterior, accepted, letters, text_language."""
        k = len(self.languages)
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != out]).alias("row")
        seen = docs.select(row, text_evidence(text, self.model).alias("e"), F.lower(declared).alias("declared"),
                           host.alias("host"), suffix.alias("suffix"))
        seen = (seen.join(self.hosts, F.col("host") == F.col("of_host"), "left")
                .join(self.suffixes, F.col("suffix") == F.col("of_suffix"), "left"))
        n = F.element_at("e", -1)
        weight = n * TEXT_WEIGHT / (n + TEXT_WEIGHT)
        score = []
        for i in range(k):
            said = F.lit(0.0)
            for d in self.languages:
                said = F.when(F.col("declared") == d, F.lit(self.declared[d][i])).otherwise(said)
            score.append(F.col("e")[i] * weight + said
                         + F.coalesce(F.col("host_prior")[i], F.lit(math.log(self.overall[i])))
                         + F.coalesce(F.col("suffix_ratio")[i], F.lit(0.0)))
        # text in none of the languages: any declaration is as likely as overall
        said = F.lit(0.0)
        for d in self.languages:
            said = F.when(F.col("declared") == d, F.lit(math.log(1 / len(self.languages)))).otherwise(said)
        score.append(F.col("e")[k] * weight + said + math.log(UNDETERMINED_PRIOR))
        seen = seen.withColumn("s", F.array(*score)).withColumn("top", F.array_max("s"))
        names = F.array(*[F.lit(x) for x in (*self.languages, UNDETERMINED)])
        posterior = 1 / F.aggregate(F.transform("s", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, x: a + x)
        language = F.get(names, (F.array_position("s", F.col("top")) - 1).cast("int"))
        by_text = F.slice("e", 1, k + 1)
        result = F.struct(
            language.alias("language"), posterior.alias("posterior"),
            ((n > 0) & (language != UNDETERMINED) & (posterior >= ACCEPT)).alias("accepted"),
            n.cast("long").alias("letters"),
            F.when(n > 0, F.get(names, (F.array_position(by_text, F.array_max(by_text)) - 1).cast("int"))).alias("text_language"))
        return seen.select("row", result.alias("r")).select("row.*", F.col("r").alias(out))


def identify(docs: DataFrame, text: str = "text", declared: str | None = "lang", host: str | None = "source",
             address: str | None = None, out: str = "language_id", **how) -> DataFrame:
    """Fit the tables on ``docs`` and identify every row; see ``Fusion.apply``.

    ``address`` names a column of web addresses, from which host, domain (the
    last two labels) and suffix (the last) are taken. Without it ``host`` names
    a column of origins, which have no domain and no suffix.
    """
    none = F.lit(None).cast("string")
    said = F.col(declared) if declared else none
    if address:
        name = F.lower(F.parse_url(F.col(address), F.lit("HOST")))
        suffix, domain = F.substring_index(name, ".", -1), F.substring_index(name, ".", -2)
    else:
        name, suffix, domain = (F.col(host) if host else none), none, none
    fitted = Fusion.fit(docs, F.col(text), said, name, suffix, domain, **how)
    return fitted.apply(docs, F.col(text), said, name, suffix, out)


def page_text(html: Column) -> Column:
    """The text of a page: scripts, styles, comments and tags removed."""
    bare = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1\\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, "<[^>]*>", " ")


def markup_language(html: Column) -> Column:
    """The primary language that the page's html element declares."""
    found = F.regexp_extract(html, "(?i)<html\\b[^>]*?\\blang\\s*=\\s*[\"']?([a-z]{2,3})", 1)
    return F.when(found != "", F.lower(found))
