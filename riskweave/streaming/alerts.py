"""Rule alerts on a stream of transactions.

Scoring is row-local over static dimensions, so the batch functions run unchanged on a stream
with stream-static joins. Alerts are appended once per transaction and source: a micro-batch
that is repeated after a failure finds what it has already written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators.joins import enrich_transactions
from riskweave.operators.rules import rule_alerts, score_transactions
from riskweave.sources.sinks import append_alerts


def stream_alerts(transactions: DataFrame, accounts, customers, cards, merchants, devices, kyc) -> DataFrame:
    """Alerts of a streaming ``transactions``; the other tables are static."""
    enriched = enrich_transactions(transactions, accounts, customers, cards, merchants, devices, kyc)
    return rule_alerts(score_transactions(enriched))


def write_alert_stream(alerts: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Start appending alerts to the table at ``path``."""
    writer = alerts.writeStream.foreachBatch(lambda batch, _: append_alerts(batch, path)).option(
        "checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
