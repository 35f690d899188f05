"""Medallion batch and streaming analytics on PySpark.

The operators are plain functions over DataFrames; the most used ones are re-exported here.
"""

from stratum.functions.columns import (add_metadata, lowercase_all_column_names, rename,
                                       stamp_ingest, uppercase_all_column_names)
from stratum.functions.xml import flatten_alerts, malformed_alerts
from stratum.operators.aggregates import (avg_by_key, count_by_window, distinct_values, reconcile,
                                          sum_by_key, sum_by_period, table_counts, top_k_by_sum)
from stratum.operators.changes import (apply_changes, dedupe, latest_per_key, merge_upsert,
                                       merge_upsert_tagged, retention)
from stratum.operators.joins import enrich, prefix_case, with_region
from stratum.operators.layout import cluster_by_zorder, compact, file_stats, table_files
from stratum.operators.quality import (expect, expect_or_drop, expectation_counts, quarantine,
                                       split_by_rules)
from stratum.operators.reports import commit_report, merge_report
from stratum.operators.schema import merge_schemas, read_merged
from stratum.session import checkpoint_root, get_spark, scratch_dir
from stratum.sources.envelope import ingest_envelope, stream_bus
from stratum.sources.files import (empty_like, from_rows, infer_schema, read_csv, read_lookup,
                                   read_table, stream_files, stream_table, with_input_file)
from stratum.sources.json import parse_json_rescue
from stratum.streaming.buckets import ChangeTable, KeptSums
from stratum.streaming.datasets import Dataset, live_table, rule_metrics, streaming_table
from stratum.streaming.enrich import Branch, run_branches
from stratum.streaming.late import LateSplit, count_by_window_stream, dedupe_stream, drop_late
from stratum.streaming.sinks import append_stream, complete_stream, stop_all, upsert_stream
from stratum.streaming.snapshots import Snapshots
from stratum.streaming.upsert import CommitLog, UpsertTable

__all__ = [n for n in dir() if not n.startswith("_")]
