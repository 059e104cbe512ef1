"""Job entry points (``spark-submit recurra/jobs.py <job> ...``).

snapshot   typed load of the delimited dump into ``<out>/<table>_batch`` (S2-S4, K3)
reconcile  streaming vs batch MRR for a day, appended to the reconciliation log (R1-R3, K4)
stream     the CDC streaming job over a directory of topic files (K1, K2, K6)
billing    the billing transitions for a day, written as change sets (B1-B6)
load-book  fill a versioned book with the operational tables as of a day
billing-day  all billing rules of a day, folded per key and merged into the book
compact    rewrite closed batches of the streaming job's logs into months, of its side logs and views into spans

``register_metric_views`` registers the metric views in a session (K5).

Paths are plain Hadoop paths (shared storage on a cluster). Nothing is
collected to the driver except the one-row reconciliation status.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from recurra import schemas
from recurra.operators import billing
from recurra.operators.latest import latest_version
from recurra.plans import metrics, reconcile, serving
from recurra.plans.billing_book import BillingBook
from recurra.session import apply_cluster_defaults
from recurra.sources import sinks, snapshot
from recurra.sources.cdc_source import from_kafka, read_cdc_files
from recurra.streaming.cdc_job import CdcJob


def _yesterday_utc() -> str:
    return (dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)).isoformat()


def run_snapshot(spark: SparkSession, src: str, out: str, sep: str, null_value: str | None) -> dict:
    counts = {}
    for table in ("subscriptions", "invoices"):
        df = snapshot.load_snapshot(spark, f"{src}/{table}.csv", table, sep, null_value)
        counts[table] = snapshot.write_snapshot(df, f"{out}/{table}_batch")
    return counts


def run_reconciliation(spark: SparkSession, stream_path: str, batch_path: str, log_path: str,
                       as_of: str | None = None) -> str | None:
    """Writes the log row and returns the alert text (None when batch MRR is 0)."""
    as_of = as_of or _yesterday_utc()
    # a folder that the streaming job compacts holds the newest batches only: read it as the job does
    inside = "/logs/subscriptions_stream"
    root = stream_path.rstrip("/").removesuffix(inside)
    of_job = root != stream_path.rstrip("/") or _is_job(spark, root)
    streamed = CdcJob(root).log(spark, "subscriptions_stream", until=as_of) if of_job else spark.read.parquet(stream_path)
    status = reconcile.reconciliation_status(streamed, spark.read.parquet(batch_path), as_of)
    row = reconcile.log_row(status).cache()
    try:
        sinks.append(row, log_path)
        msg = reconcile.alert_text(row).select("message").collect()   # zero or one row
        return msg[0].message if msg else None
    finally:
        row.unpersist()


def read_log(spark: SparkSession, root: str, table: str):
    """An event log: through the streaming job's reader (compacted months +
    fresh batches) when ``root`` is a ``CdcJob`` output, else a plain table
    ``<root>/<table>``."""
    if _is_job(spark, root):
        return CdcJob(root).log(spark, table)
    return spark.read.parquet(f"{root}/{table}")


def _is_job(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` is the output folder of a ``CdcJob``."""
    logs_dir = spark._jvm.org.apache.hadoop.fs.Path(CdcJob(root).path("logs"))
    return logs_dir.getFileSystem(spark._jsc.hadoopConfiguration()).exists(logs_dir)


def run_billing(spark: SparkSession, logs: str, merchants_path: str, out: str, as_of: str) -> None:
    def known(table: str):
        return billing.known_at(read_log(spark, logs, table), as_of)
    subs = latest_version(known("subscriptions_stream"), "subscription_id", reconcile.TIE_BREAK_ORDER)
    invoices = serving.current_invoices(known("invoices_stream"))
    attempts = read_log(spark, logs, "payment_attempts_stream")     # bounded by the rule that reads it
    changes = known("plan_changes_stream")
    merchants = spark.read.parquet(merchants_path)
    run = billing.billing_run(subs, as_of)
    retries = billing.apply_retries(invoices, attempts, subs, merchants, as_of)
    plans = billing.apply_plan_changes(subs, merchants, changes)
    outputs = {
        "new_invoices": run.invoices, "billed_subscriptions": run.subscriptions,
        "retried_invoices": retries.invoices, "churned_subscriptions": retries.subscriptions,
        "churned_merchants": retries.merchants,
        "expired_trials": billing.expire_trials(subs, as_of),
        "cancelled_subscriptions": billing.cancel_scheduled(subs, as_of),
        "plan_changed_subscriptions": plans.subscriptions, "plan_changed_merchants": plans.merchants,
    }
    for name, df in outputs.items():
        # the day's folder itself is replaced, so that a rerun without rows leaves none of an earlier run
        df.write.mode("overwrite").parquet(f"{out}/{name}/as_of={as_of}")


def run_billing_day(spark: SparkSession, book: str, logs: str, as_of: str) -> None:
    """All rules of a day folded into one change per key and merged into the book's tables."""
    BillingBook(spark, book).run(as_of, read_log(spark, logs, "payment_attempts_stream"),
                                 read_log(spark, logs, "plan_changes_stream"))


def load_book(spark: SparkSession, book: str, logs: str, merchants_path: str, as_of: str) -> None:
    """Fill a new book with the tables as they stood at a day."""
    def known(table: str):
        return billing.known_at(read_log(spark, logs, table), as_of)
    held = BillingBook(spark, book)
    held.load("subscriptions", latest_version(known("subscriptions_stream"), "subscription_id", reconcile.TIE_BREAK_ORDER))
    held.load("invoices", serving.current_invoices(known("invoices_stream")))
    held.load("merchants", spark.read.parquet(merchants_path))


def run_compaction(spark: SparkSession, root: str, through_batch: int) -> None:
    job = CdcJob(root)
    for table in schemas.LOG_TABLES.values():
        job.compact(spark, table, through_batch)
    for name in job.side_logs():
        job.compact_side(spark, name, through_batch)


def register_metric_views(spark: SparkSession, logs: str) -> None:
    subs = read_log(spark, logs, "subscriptions_stream")
    changes = read_log(spark, logs, "plan_changes_stream")
    attempts = read_log(spark, logs, "payment_attempts_stream")
    mrr = metrics.mrr_current(subs)
    churn = metrics.churn_monthly(subs)
    sinks.register_views(spark, {
        "mrr_current": mrr, "mrr_active_arr": metrics.mrr_active_arr(mrr), "churn_monthly": churn,
        "churn_rate": metrics.churn_rate(churn), "nrr_monthly": metrics.nrr_monthly(subs, changes),
        "mrr_waterfall": metrics.mrr_waterfall(subs, changes),
        "failed_payment_rate": metrics.failed_payment_rate(attempts),
    })


def _stream_source(spark: SparkSession, args):
    if args.format == "files":
        return read_cdc_files(spark, args.source, max_files_per_trigger=args.max_files)
    reader = spark.readStream.format(args.format)
    for kv in args.option:
        k, _, v = kv.partition("=")
        reader = reader.option(k, v)
    df = reader.load()
    return from_kafka(df) if args.format == "kafka" else df.select("topic", F.col("value").cast("string"))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="recurra.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("snapshot")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--sep", default=",")
    s.add_argument("--null-value", default=None)
    r = sub.add_parser("reconcile")
    r.add_argument("--stream", required=True, help="output folder of the streaming job, or a log table")
    r.add_argument("--batch", required=True)
    r.add_argument("--log", required=True)
    r.add_argument("--date", default=None, help="day to reconcile (default: yesterday, UTC)")
    st_ = sub.add_parser("stream")
    st_.add_argument("--source", required=True, help="directory of <topic>/<file> JSON lines, or the "
                     "source name passed to --format")
    st_.add_argument("--format", default="files", help="'files' or any streaming source yielding "
                     "(topic, value), e.g. kafka")
    st_.add_argument("--option", action="append", default=[], help="source option key=value (repeatable)")
    st_.add_argument("--max-files", type=int, default=None, help="files taken by one batch of the 'files' source")
    st_.add_argument("--dedupe-batches", type=int, default=0, help="batches in which a redelivered message is looked for")
    st_.add_argument("--output", required=True)
    st_.add_argument("--checkpoint", default=None)
    st_.add_argument("--trigger", default="15 minutes", help="processing-time interval or 'available-now'")
    b = sub.add_parser("billing")
    b.add_argument("--logs", required=True)
    b.add_argument("--merchants", required=True)
    b.add_argument("--output", required=True)
    b.add_argument("--date", required=True)
    for name in ("load-book", "billing-day"):
        d = sub.add_parser(name)
        d.add_argument("--book", required=True)
        d.add_argument("--logs", required=True)
        d.add_argument("--date", required=True)
        if name == "load-book":
            d.add_argument("--merchants", required=True)
    c = sub.add_parser("compact")
    c.add_argument("--output", required=True, help="output folder of the streaming job")
    c.add_argument("--through-batch", type=int, required=True, help="last closed batch")
    args = p.parse_args(argv)

    spark = apply_cluster_defaults(SparkSession.builder.appName(f"recurra-{args.job}").getOrCreate())
    if args.job == "snapshot":
        print(run_snapshot(spark, args.input, args.output, args.sep, args.null_value))
    elif args.job == "reconcile":
        print(run_reconciliation(spark, args.stream, args.batch, args.log, args.date))
    elif args.job == "stream":
        trig = {"availableNow": True} if args.trigger == "available-now" else {"processingTime": args.trigger}
        job = CdcJob(args.output, dedupe_batches=args.dedupe_batches)
        job.start(_stream_source(spark, args), args.checkpoint, trig).awaitTermination()
    elif args.job == "billing":
        run_billing(spark, args.logs, args.merchants, args.output, args.date)
    elif args.job == "load-book":
        load_book(spark, args.book, args.logs, args.merchants, args.date)
    elif args.job == "billing-day":
        run_billing_day(spark, args.book, args.logs, args.date)
    elif args.job == "compact":
        run_compaction(spark, args.output, args.through_batch)


if __name__ == "__main__":
    main(sys.argv[1:])
