"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints within ``distance`` bits, cut into m bit groups, must be within
``t_i`` bits in some group i whenever the thresholds add up to
``distance - m + 1``; a threshold of -1 leaves a group out. So each fingerprint
may choose its own thresholds, and it chooses, by dynamic programming, those
with the fewest expected candidates:

1. the 64 x 64 bit co-occurrence counts of all distinct fingerprints put
   correlated bits into the same group, so that skew is held in few groups;
2. counts of short bit strings of all distinct fingerprints estimate how many
   fingerprints lie within e bits of a value in a group;
3. every fingerprint is indexed once per group, probes the values within its
   threshold, and the join keeps the pairs within ``distance`` bits overall;
4. the links' connected components are the near-duplicate groups.

Exact copies share one fingerprint and are merged before step 1. All counts are
tables of fixed size (64 x 64, and at most 2^11 entries for each of a few bit
strings), whatever the corpus.

Rows: a null or blank text has fingerprint 0 and is linked like any other;
a null doc_id is a row without a name: it takes part, and its group's id is the
least doc_id there is (null if there is none). Repeated rows get equal results.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import components, cut

BITS = 64
BLOCK = 1 << 16       # shingles counted at once: bounds memory on very long texts
PROBES = 1 << 18      # probes written at once
STRING_BITS = 11      # longest bit string whose values are counted


def _fingerprint(text: bytes | None, size: int) -> int:
    # bytes.lower and bytes.split know ASCII only: A-Z, and the six blanks
    w = (text or b"").lower().split()
    if not w:
        return 0
    size = min(size, len(w))
    total, bits = len(w) - size + 1, np.zeros(BITS, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, total, BLOCK):
        part = w[at:at + BLOCK + size - 1]
        h = np.array([digest(join(s), 42) for s in zip(*(part[i:] for i in range(size)))], "<u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > total, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The 64-bit SimHash of a text's word shingles, as a signed long."""
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, shingle) for t in texts], dtype="int64")
    # else a filter on it, such as a join's, would be pushed below its projection, and work it out again in a second worker
    return simhash.asNondeterministic()(text.cast("binary"))


def _bits(fps: np.ndarray, positions: list[int]) -> np.ndarray:
    """The values of the bits at these positions, the first one lowest."""
    out = np.zeros(len(fps), np.int64)
    for j, b in enumerate(positions):
        out |= ((fps >> b) & 1) << j
    return out


def _summed(df: DataFrame, counts, width: int) -> np.ndarray:
    """Sum over all fingerprints of a fixed-size vector of counts."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(width, np.int64)
        for b in batches:
            total += counts(b["fp"].to_numpy(np.int64))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})
    out = np.zeros(width, np.int64)
    for r in df.select("fp").mapInPandas(partial, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def bit_groups(fps: DataFrame, groups: int) -> list[list[int]]:
    """Partition the 64 bits into ``groups`` of near-equal width, correlated bits together."""
    def counts(f: np.ndarray) -> np.ndarray:
        b = ((f[:, None] >> np.arange(BITS)) & 1).astype(np.float64)
        return np.append(b.T @ b, len(f)).round().astype(np.int64)
    total = _summed(fps, counts, BITS * BITS + 1)
    n, both = max(1, total[-1]), total[:-1].reshape(BITS, BITS) / max(1, total[-1])
    p = np.diag(both) if n else np.zeros(BITS)
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    tie = np.abs(both - np.outer(p, p)) / spread
    free, out = list(range(BITS)), []
    for g in range(groups):
        width = BITS // groups + (g < BITS % groups)
        own = [max(free, key=lambda b: (tie[b, free].sum(), -b))]
        free.remove(own[0])
        while len(own) < width:
            nxt = max(free, key=lambda b: (tie[b, own].sum(), -b))
            own.append(nxt)
            free.remove(nxt)
        out.append(own)
    return out


def _within(counted: np.ndarray, width: int, most: int) -> np.ndarray:
    """[d, v]: how many of the counted values differ from v in exactly d bits."""
    values = np.arange(1 << width)
    out = np.zeros((most + 1, 1 << width))
    for d in range(min(most, width) + 1):
        for flips in combinations(range(width), d):
            out[d] += counted[values ^ sum(1 << b for b in flips)]
    return out


class Allocation:
    """Per-fingerprint thresholds with the fewest expected candidates."""

    def __init__(self, fps: DataFrame, groups: list[list[int]], distance: int):
        self.groups, self.distance = groups, distance
        self.strings = [[g[i::-(-len(g) // STRING_BITS)] for i in range(-(-len(g) // STRING_BITS))] for g in groups]
        flat, start = [s for g in self.strings for s in g], [0]
        for s in flat:
            start.append(start[-1] + (1 << len(s)))

        def counts(f: np.ndarray) -> np.ndarray:
            return np.concatenate([np.bincount(_bits(f, s), minlength=1 << len(s)) for s in flat])
        total = _summed(fps, counts, start[-1])
        self.n = max(1, int(total[:1 << len(flat[0])].sum()))
        tables = iter(_within(total[a:b] / self.n, len(s), distance) for s, a, b in zip(flat, start, start[1:]))
        self.tables = [[next(tables) for _ in g] for g in self.strings]

    def expected(self, f: np.ndarray, group: int) -> np.ndarray:
        """[e + 1, row]: expected cost of threshold e, from -1 (none) to ``distance``."""
        near = np.zeros((self.distance + 1, len(f)))
        near[0] = 1
        for s, table in zip(self.strings[group], self.tables[group]):
            at = table[:, _bits(f, s)]
            near = np.array([sum(near[i] * at[d - i] for i in range(d + 1)) for d in range(self.distance + 1)])
        width, probes, out = len(self.groups[group]), 0, [np.zeros(len(f))]
        for e in range(self.distance + 1):
            probes += sum(1 for _ in combinations(range(width), e))
            out.append(self.n * near[:e + 1].sum(0) + probes)
        return np.array(out)

    def thresholds(self, f: np.ndarray) -> np.ndarray:
        """[group, row]: the thresholds; each column adds up to distance - groups + 1."""
        m, levels = len(self.groups), self.distance + 2
        # sums are counted with every threshold raised by one, so they start at 0
        goal = self.distance + 1
        best = np.full((goal + 1, len(f)), np.inf)
        best[0] = 0
        back = np.zeros((m, goal + 1, len(f)), np.int8)
        for g in range(m):
            cost, new = self.expected(f, g), np.full_like(best, np.inf)
            for e in range(levels):
                for s in range(e, goal + 1):
                    total = best[s - e] + cost[e]
                    better = total < new[s]
                    new[s][better] = total[better]
                    back[g, s][better] = e
            best = new
        out, at, rows = np.zeros((m, len(f)), np.int8), np.full(len(f), goal), np.arange(len(f))
        for g in reversed(range(m)):
            out[g] = back[g, at, rows] - 1
            at = at - out[g] - 1
        return out


def group_count(n: int, distance: int) -> int:
    """Fewer, wider groups for more fingerprints: about 64 to a value of a group at most."""
    wide = max(1, n.bit_length() - 6)
    return max(1, min(distance + 1, BITS // wide))


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """All pairs a < b of the distinct fingerprints ``fp`` that differ in at most ``distance`` bits.

    A pair may come more than once. Candidates are compared inside the join;
    only links leave it.
    """
    n = fps.count()
    groups = bit_groups(fps, group_count(n, distance))
    plan = Allocation(fps, groups, distance)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            f = b["fp"].to_numpy(np.int64)
            for i in range(0, len(f), 4096):
                yield from rows(f[i:i + 4096])

    def rows(f: np.ndarray) -> Iterator[pd.DataFrame]:
        chosen = plan.thresholds(f)
        for g, positions in enumerate(plan.groups):
            v, flips = _bits(f, positions), []
            yield pd.DataFrame({"part": g, "value": v, "fp": f, "probe": False})
            for e in range(distance + 1):
                flips += [sum(1 << b for b in c) for c in combinations(range(len(positions)), e)]
                own = chosen[g] == e
                masks = np.array(flips, np.uint64).view(np.int64)
                step = max(1, PROBES // len(masks))
                for i in range(0, int(own.sum()), step):
                    at = v[own][i:i + step, None] ^ masks[None, :]
                    yield pd.DataFrame({"part": g, "value": at.ravel(),
                                        "fp": np.repeat(f[own][i:i + step], len(masks)), "probe": True})

    keyed = cut(fps.select("fp").mapInPandas(index, "part int, value long, fp long, probe boolean"), "simhash-index")
    held = keyed.where("NOT probe").select("part", "value", F.col("fp").alias("b"))
    asked = keyed.where("probe").select("part", "value", F.col("fp").alias("a"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return asked.join(held, (asked["part"] == held["part"]) & (asked["value"] == held["value"]) & close).select("a", "b")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per document: doc_id, fp (signed long), root_fp, component_id (least doc_id of its group)."""
    fps = cut(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("fp")), "simhash")
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct, distance)).select(F.col("node").alias("fp"), F.col("root").alias("root_fp"))
    named = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root_fp", "fp").alias("root_fp"))
    least = named.groupBy("root_fp").agg(F.min("least").alias("component_id"))
    named = cut(named.select("fp", "root_fp").join(least, "root_fp"), "simhash-groups")
    return fps.join(named, "fp").select("doc_id", "fp", "root_fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
             shingle: int = 3, distance: int = 3) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the least doc_id, columns unchanged.

    Rows are matched on fingerprint and doc_id together, so that a group of
    copies, however large, is spread over the tasks before it is cut down.
    """
    found = near_duplicates(docs, text, doc_id, shingle, distance)
    # of a group's equal doc_ids (repeated rows) the least fingerprint stays
    kept = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root_fp").agg(F.min("fp").alias("__fp"), F.first("component_id").alias("__id"))
            .select("__fp", "__id"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                      F.col(doc_id).alias("__doc"), fingerprint(F.col(text), shingle).alias("__own"))
    one = (own.join(kept, (own["__own"] == kept["__fp"]) & own["__doc"].eqNullSafe(kept["__id"]))
           .dropDuplicates(["__own", "__doc"]))
    return one.select("__row.*")
