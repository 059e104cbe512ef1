"""Views that the streaming job keeps up to date (K6), and the last invoices of a merchant (L2).

A ``StoredView`` declares its keys, its measures by how they merge (sum, count,
least, greatest), and its result over the merged measures: a rate is a ratio of
two sums and is worked out when the view is read. A batch adds partial aggregates,
one row per key that it touches; the view is the merge of the partials.

A view of the latest versions (``latest``) is kept by signed deltas. A table holds
the current version of every key. A batch finds, in one aggregate over its rows and
the buckets that they touch, the versions that it replaces and those that replace
them; the former enter the partials with sign -1 and the latter with +1. Groups
without rows left go, and a sum over nulls alone is null again, as the rows and the
values of a sum are counted with their signs. Least and greatest cannot be taken
back, so such a view may not have them.

``LastRows`` keeps the first ``n`` rows of every owner by a rank, in the owner's
bucket. Merging is exact as long as a row keeps its owner and rank, as an invoice
keeps its merchant and date of emission. Where a stored row changes its rank, rows
dropped before may have to come back: such owners are noted, and read from the log.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.calendar import month_start
from recurra.functions.numeric import safe_divide
from recurra.plans import metrics

MERGES = {"sum": F.sum, "count": F.sum, "least": F.min, "greatest": F.max}


class Measure(NamedTuple):
    kind: str
    of: Callable[[], Column]        # the value, or the condition of a count
    type: str


def total(of: str | Callable[[], Column], type: str = metrics.SUM_TYPE) -> Measure:
    return Measure("sum", of if callable(of) else lambda: F.col(of), type)


def count(of: Callable[[], Column] = lambda: F.lit(True)) -> Measure:
    return Measure("count", of, "bigint")


def least(of: str, type: str) -> Measure:
    return Measure("least", lambda: F.col(of), type)


def greatest(of: str, type: str) -> Measure:
    return Measure("greatest", lambda: F.col(of), type)


class Latest(NamedTuple):
    key: str
    order: tuple[str, ...]


@dataclass(frozen=True)
class StoredView:
    table: str                                              # event log
    keys: dict[str, Callable[[], Column]]
    measures: dict[str, Measure]
    latest: Latest | None = None
    result: Callable[[], list[Column]] | None = None        # over keys and measures; these themselves by default

    def __post_init__(self):
        taken_back = [n for n, m in self.measures.items() if m.kind in ("least", "greatest")]
        if self.latest and taken_back:
            raise ValueError(f"{taken_back} cannot follow the latest version: least and greatest cannot be taken back")

    @property
    def _signed_sums(self) -> list[str]:
        return [n for n, m in self.measures.items() if self.latest and m.kind == "sum"]

    def partials(self, rows: DataFrame) -> DataFrame:
        """Mergeable rows of a batch; ``rows`` of a latest view have ``sign``."""
        sign = F.col("sign") if self.latest else F.lit(1)

        def part(m: Measure) -> Column:
            if m.kind == "count":
                return F.coalesce(F.sum(F.when(m.of(), sign)), F.lit(0))
            value = F.when(sign < 0, -m.of()).otherwise(m.of()) if self.latest else m.of()
            return MERGES[m.kind](value)

        out = [part(m).alias(n) for n, m in self.measures.items()]
        out += [F.sum(F.when(self.measures[n].of().isNotNull(), sign)).alias(f"{n}__values") for n in self._signed_sums]
        if self.latest:
            out.append(F.sum(sign).alias("__rows"))
        return rows.groupBy(*[k().alias(n) for n, k in self.keys.items()]).agg(*out)

    def merge(self, partials: DataFrame, *also: str) -> DataFrame:
        """Partials of the same key as one; partials again. ``also`` names further grouping columns."""
        kinds = {n: m.kind for n, m in self.measures.items()}
        return partials.groupBy(*self.keys, *also).agg(*[
            MERGES[kinds.get(n, "sum")](n).alias(n) for n in partials.columns if n not in (*self.keys, *also, "batch_id")])

    def finish(self, partials: DataFrame) -> DataFrame:
        merged = self.merge(partials)
        if self.latest:
            merged = merged.filter("__rows > 0")
        value = {n: F.when(F.col(f"{n}__values") > 0, F.col(n)) if n in self._signed_sums else F.col(n) for n in self.measures}
        merged = merged.select(*self.keys, *[value[n].cast(m.type).alias(n) for n, m in self.measures.items()])
        return merged.select(*self.result()) if self.result else merged


def _month(c: str) -> Callable[[], Column]:
    return lambda: month_start(c)


def _named(c: str) -> Callable[[], Column]:
    return lambda: F.col(c)


def _failed_payments(success: Sequence[str]) -> StoredView:
    def failed() -> Column:
        return F.col("statut") == "failed"

    def succeeded() -> Column:
        return F.col("statut").isin(*success)

    def result() -> list[Column]:
        return [F.col("mois"), F.col("total_attempts"), F.col("nb_success"), F.col("nb_failed"),
                safe_divide(F.col("nb_failed"), F.col("total_attempts")).alias("failed_rate"),
                *[F.col(f"err_{code}") for code in metrics.ERROR_CODES],
                safe_divide(F.col("recovered"), F.col("nb_failed")).alias("recovery_rate"), F.col("revenue_at_risk_cad")]

    errors = {f"err_{code}": count(lambda code=code: F.col("code_erreur") == code) for code in metrics.ERROR_CODES}
    return StoredView("payment_attempts_stream", {"mois": _month("created_at")}, {
        "total_attempts": count(), "nb_success": count(succeeded), "nb_failed": count(failed), **errors,
        "recovered": count(lambda: succeeded() & (F.col("tentative_numero") > 1)),
        "revenue_at_risk_cad": total(lambda: F.when(failed(), F.col("montant_cad")).otherwise(F.lit(0))),
    }, result=result)


def _subscriptions(keys: dict[str, Callable[[], Column]], counted: str, latest: bool) -> StoredView:
    version = Latest("subscription_id", ("updated_at", "montant_mensuel_cad", "cdc_ts_ms")) if latest else None
    return StoredView("subscriptions_stream", keys, {counted: count(), "mrr_cad": total("montant_mensuel_cad")}, version)


def stored_views() -> dict[str, StoredView]:
    """The views of the reports that a stream can keep."""
    by_plan = {"mois": _month("updated_at"), "plan": _named("plan"), "statut": _named("statut")}
    by_status = {"mois": _month("updated_at"), "statut": _named("statut")}
    return {
        "mrr_current": _subscriptions(by_plan, "nb_abonnements", False),
        "churn_monthly": _subscriptions(by_status, "nb_subscriptions", False),
        "mrr_current_latest": _subscriptions(by_plan, "nb_abonnements", True),
        "churn_monthly_latest": _subscriptions(by_status, "nb_subscriptions", True),
        "failed_payment_rate": _failed_payments(metrics.LITERAL_SUCCESS),
        "failed_payment_rate_corrected": _failed_payments(metrics.CORRECTED_SUCCESS),
    }


# ------------------------------------------------------------------ current versions

def replaced(batch: DataFrame, current: DataFrame | None, latest: Latest) -> DataFrame:
    """Per key of ``batch`` and of ``current``: the version held (``was``), the version after the batch (``now``).

    Versions compare by the order, then by all other columns, so that equal instants always give the same one.
    """
    rest = [c for c in batch.columns if c not in latest.order]
    version = F.struct(*latest.order, *rest)
    rows = batch.withColumn("held", F.lit(False))
    if current is not None:
        rows = rows.unionByName(current.select(*batch.columns).withColumn("held", F.lit(True)))
    return rows.groupBy(latest.key).agg(F.max(F.when(F.col("held"), version)).alias("was"), F.max(version).alias("now"))


def signed(versions: DataFrame) -> DataFrame:
    """The versions that go (sign -1) and those that come (+1)."""
    changed = versions.filter(~F.col("was").eqNullSafe(F.col("now")))
    gone = changed.filter(F.col("was").isNotNull()).select("was.*", F.lit(-1).alias("sign"))
    return changed.select("now.*", F.lit(1).alias("sign")).unionByName(gone)


# ------------------------------------------------------------------ last rows of an owner

@dataclass(frozen=True)
class LastRows:
    table: str
    owner: str
    key: str
    rank: str                       # falling, nulls last; then the key, falling
    order: tuple[str, ...]          # of the versions of a row
    n: int

    def merge(self, parts: list[DataFrame]) -> DataFrame:
        """The first ``n`` current rows of every owner, and a row with a null key for owners whose rows changed rank.

        ``parts`` are batches of the log and stored rows, in any order and number.
        """
        rows = reduce(DataFrame.unionByName, parts)
        rest = [c for c in rows.columns if c not in (*self.order, self.owner, self.key)]
        versions = rows.filter(F.col(self.key).isNotNull()).groupBy(self.owner, self.key).agg(
            F.max(F.struct(*self.order, *rest)).alias("now"),
            (~F.min(F.struct(self.rank)).eqNullSafe(F.max(F.struct(self.rank)))).alias("moved"))
        current = versions.select(self.owner, self.key, "now.*")
        first = self.first(current).drop("rang").select(*rows.columns)
        noted = (versions.filter("moved").select(self.owner)
                 .unionByName(rows.filter(F.col(self.key).isNull()).select(self.owner)).distinct())
        return first.unionByName(noted, allowMissingColumns=True)

    def first(self, current: DataFrame) -> DataFrame:
        """The first ``n`` rows of every owner, numbered; a limit per group that applies before the shuffle."""
        by_rank = Window.partitionBy(self.owner).orderBy(F.col(self.rank).desc_nulls_last(), F.col(self.key).desc())
        return current.withColumn("rang", F.row_number().over(by_rank)).filter(F.col("rang") <= self.n)
