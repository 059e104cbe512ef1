"""Subscription-billing analytics on Spark.

Layout:
  functions/  column-level helpers (CDC value decoders, calendar, ratios, text)
  sources/    readers and writers (CDC wire, delimited snapshots, event logs)
  operators/  DataFrame -> DataFrame building blocks (decode, latest version,
              merchant state, billing jobs)
  plans/      composed reports (metric views, reconciliation, serving reads)
  streaming/  Structured Streaming jobs (routed log sink, merchant state,
              partial aggregates)
"""

from recurra.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
