"""Stream-static joins on real streams.

Each run reads its lookups anew, so a stream that is started again joins with the lookup as it is then,
while rows written before stay as they were. Rows go to an append sink: no state, no per-batch function.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratum.sources.files import stream_table
from stratum.streaming.sinks import append_stream


@dataclass
class Branch:
    """One sink of a shared source: what is made of its rows, where it goes, and the lookups it joins,
    each as a function that reads it."""
    name: str
    path: str
    transform: Callable[..., DataFrame]
    lookups: Mapping[str, Callable[[], DataFrame]]
    partition_by: Sequence[str] = ()


def run_branches(spark: SparkSession, source_path: str, schema, branches: Sequence[Branch], checkpoints: str,
                 trigger: dict | None = None, one_by_one: bool = False) -> dict[str, object]:
    """Run several sinks from one stored stream, each with a checkpoint of its own, side by side (or one
    after the other). A branch that fails is taken up again where it was by the next run; the others
    don't wait for it."""
    queries = {}
    for b in branches:
        lookups = {k: read() for k, read in b.lookups.items()}   # as they are now
        out = b.transform(stream_table(spark, source_path, schema=schema), **lookups)
        queries[b.name] = append_stream(out, b.path, f"{checkpoints}/{b.name}", b.partition_by, trigger)
        if one_by_one:
            queries[b.name].awaitTermination()
    failed = []
    for name, q in queries.items():
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001 - told together, after all have ended
            failed.append((name, e))
    if failed:
        raise RuntimeError(f"branches failed: {', '.join(n for n, _ in failed)}") from failed[0][1]
    return queries
