"""Change-data capture: envelope parsing and per-key ordered apply.

(The streaming drivers live in ``streaming/jobs.py``; the functions here
are plain DataFrame transforms usable in batch and inside foreachBatch.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAYLOAD_SCHEMA = "k BIGINT"


def flatten_events(events: DataFrame) -> DataFrame:
    """Event columns plus the JSON payload's ``k`` as a typed column."""
    parsed = F.from_json(F.col("props"), PAYLOAD_SCHEMA)
    return events.select("event_id", "ts", "user_id", "event_type", "value",
                         parsed.getField("k").alias("k"))


def flatten_events_variant(events: DataFrame) -> DataFrame:
    """The same flattening through a VARIANT column: the payload is parsed
    once (``parse_json``) and fields are read with ``variant_get``; useful
    when payloads carry fields no fixed schema lists."""
    v = F.parse_json(F.col("props"))
    return events.select("event_id", "ts", "user_id", "event_type", "value",
                         F.variant_get(v, "$.k", "bigint").alias("k"))
