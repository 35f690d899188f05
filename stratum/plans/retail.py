"""Retail medallion flow: CSV landing -> raw -> cleaned -> quality / quarantine -> keyed latest ->
summaries. One function per dataset node; each takes and returns a DataFrame and works on batch
frames and (the streaming nodes) on streams. ``run_retail`` executes the graph in dependency order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.datetime import split_invoice_datetime
from stratum.operators import aggregates as agg
from stratum.operators.changes import apply_changes
from stratum.operators.quality import expect_or_drop, quarantine
from stratum.plans.fixtures import RETAIL_DDL
from stratum.session import freed_shuffles
from stratum.sources.files import redistribute, stream_files, with_input_file

# The declared expectations of the retail flow.
QUALITY_RULES = {
    "has_customer": "CustomerID IS NOT NULL",
    "has_invoice": "InvoiceNo IS NOT NULL",
    "valid_date_time": "TRY_CAST(InvoiceDatetime AS TIMESTAMP) IS NOT NULL",
}
QUARANTINE_RULE = "CustomerID IS NULL OR InvoiceNo IS NULL OR InvoiceDate IS NULL"
CHANGE_KEYS = ["CustomerID", "InvoiceNo"]
SEQUENCE_BY = "InvoiceDatetime"
QUALITY_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "InvoiceTime",
                   "InvoiceDatetime", "UnitPrice", "CustomerID", "Country"]
QUARANTINE_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
                      "UnitPrice", "CustomerID", "Country"]


def raw_retail_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Incremental CSV ingest with the declared DDL schema and the source file of every row."""
    src = stream_files(spark, path, "csv", RETAIL_DDL, max_files=max_files, recursiveFileLookup=True)
    return with_input_file(src)


def cleaned_retail(raw: DataFrame, width: int | None = None, dealt: bool = False) -> DataFrame:
    """The raw rows, dealt out if their scan is narrow (P17), so that the nodes behind it are as wide; not again
    if they were made from rows already ``dealt`` out."""
    return raw.select("*") if dealt else redistribute(raw.select("*"), width=width)


def shape_retail(cleaned: DataFrame) -> DataFrame:
    """Split the invoice text into clean date / time / timestamp columns."""
    parts = split_invoice_datetime("InvoiceDate")
    return cleaned.select(
        "InvoiceNo", "StockCode", "Description", "Quantity",
        parts["date"].alias("InvoiceDate"), parts["time"].alias("InvoiceTime"),
        parts["InvoiceDatetime"].alias("InvoiceDatetime"),
        "UnitPrice", "CustomerID", "Country")


def quality_retail(cleaned: DataFrame, rules: dict | None = None) -> DataFrame:
    """Shape the rows, then drop every row violating a rule."""
    return expect_or_drop(shape_retail(cleaned), QUALITY_RULES if rules is None else rules)


def quarantined_retail(cleaned: DataFrame) -> DataFrame:
    return quarantine(cleaned.select(*QUARANTINE_COLUMNS), QUARANTINE_RULE)


def distinct_countries(quality: DataFrame) -> DataFrame:
    return agg.distinct_values(quality, "Country")


def sales_all_countries(quality: DataFrame, target: DataFrame | None = None,
                        keys: list[str] | None = None) -> DataFrame:
    """APPLY CHANGES ... KEYS (CustomerID, InvoiceNo) SEQUENCE BY InvoiceDatetime."""
    return apply_changes(target, quality, keys or CHANGE_KEYS, SEQUENCE_BY)


def sales_by_day(latest: DataFrame) -> DataFrame:
    return agg.sum_by_period(latest, SEQUENCE_BY, "day", "Quantity", "Date", "TotalSales")


def sales_by_country(latest: DataFrame) -> DataFrame:
    return agg.sum_by_key(latest, "Country", "Quantity", "TotalSales")


def top_ten_customers(latest: DataFrame, k: int = 10) -> DataFrame:
    return agg.top_k_by_sum(latest, "CustomerID", "Quantity", k, "TotalSales")


def quality_split_by_country(quality: DataFrame) -> DataFrame:
    """The same rules applied again downstream (idempotent), for a copy partitioned by Country."""
    return expect_or_drop(quality, QUALITY_RULES)


def _sum_rows(spark: SparkSession, target, name: str, version: int) -> DataFrame:
    """Signed rows for the sums of a node: what a version changed in the target. Countries are those of all
    quality rows, superseded ones too, which are only ever added."""
    if name == "distinct_countries_retail":
        return target.changes(version).withColumn("_sign", F.lit(1))
    return target.deltas(version)


@dataclass
class RetailTables:
    root: str
    prefix: str
    paths: dict[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A node's rows: of the target by merge on read, of a complete dataset its newest snapshot."""
        from stratum.streaming.snapshots import Snapshots
        kind = {d[0]: d[3] for d in RETAIL_DATASETS}[name]
        if kind == "target":
            return self.target(spark).read()
        if kind == "complete":
            return Snapshots(spark, self.paths[name]).read()
        return spark.read.parquet(self.paths[name])

    def target(self, spark: SparkSession):
        """The keyed target, by append-only changes and the newest row of a key."""
        from stratum.streaming.buckets import ChangeTable
        schema = spark.read.parquet(self.paths["quality_retail"]).select(*QUALITY_COLUMNS).schema
        return ChangeTable(spark, self.paths["retail_sales_all_countries"], schema, CHANGE_KEYS, SEQUENCE_BY,
                           compression=CODEC)

    def sums(self, spark: SparkSession, name: str):
        """The sums that a complete dataset is shown from."""
        from stratum.streaming.buckets import KeptSums
        groups, value, types = KEPT_SUMS[name]
        return KeptSums(spark, f"{self.root}/sums/{name}", {c: F.expr(e) for c, e in groups.items()},
                        F.col(value) if value else None, types)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(f"{self.prefix}_{name}")


# The declared datasets of the retail flow (name, tier, partitioning, kind).
RETAIL_DATASETS = [
    ("raw_retail", "bronze", ["Country"], "streaming"),
    ("cleaned_retail", "bronze", ["Country"], "streaming"),
    ("quality_retail", "silver", ["Country"], "streaming"),
    ("quarantined_retail", "bronze", [], "streaming"),
    ("quality_retail_split_by_country", "silver", ["Country"], "streaming"),
    ("retail_sales_all_countries", "silver", [], "target"),
    ("distinct_countries_retail", None, [], "complete"),
    ("sales_by_day", None, [], "complete"),
    ("sales_by_country", None, [], "complete"),
    ("top_ten_customers", None, [], "complete"),
]


# The sums kept of each complete dataset: its groups, what is summed, and the groups' types.
KEPT_SUMS = {
    "distinct_countries_retail": ({"Country": "Country"}, None, {"Country": "string"}),
    "sales_by_day": ({"Date": f"date_trunc('day', {SEQUENCE_BY})"}, "Quantity", {"Date": "timestamp"}),
    "sales_by_country": ({"Country": "Country"}, "Quantity", {"Country": "string"}),
    "top_ten_customers": ({"CustomerID": "CustomerID"}, "Quantity", {"CustomerID": "string"}),
}
# How the complete datasets are shown from their sums.
SHOWN = {
    "distinct_countries_retail": lambda df: df,
    "sales_by_day": lambda df: df.orderBy("Date"),
    "sales_by_country": lambda df: df.orderBy(F.col("TotalSales").desc()),
    "top_ten_customers": lambda df: df.orderBy(F.col("TotalSales").desc(), F.col("CustomerID").asc()).limit(10),
}


#: Codec of the stored rows: the graph keeps them in six tables.
CODEC = "zstd"


def run_retail(spark: SparkSession, csv_path: str, root: str, prefix: str,
               max_files: int | None = None, keep_hours: float | None = None,
               landed: Callable[[], None] | None = None) -> RetailTables:
    """Run the whole retail graph once, in dependency order.

    Streaming datasets run as Structured Streaming queries with ``availableNow`` (each with its own
    checkpoint, so a re-run only picks up new files). The keyed target appends the new quality rows and
    merges them into the buckets that they touch; the complete datasets keep sums, to which a version's
    signed changes are added, and show them as a new snapshot. So a re-run reads new rows, touched
    buckets and sums, never the whole target. Every materialised dataset is registered as
    ``<prefix>_<name>`` with its comment and tier. Given ``keep_hours``, a run deletes what is superseded for
    longer: older versions of buckets, sums and snapshots, and changes that the target and its sums hold.
    ``landed`` is called once the raw table holds the files that came.
    """
    with freed_shuffles(spark):
        return _run_retail(spark, csv_path, root, prefix, max_files, keep_hours, landed)


def _run_retail(spark: SparkSession, csv_path: str, root: str, prefix: str, max_files: int | None,
                keep_hours: float | None, landed: Callable[[], None] | None) -> RetailTables:
    from stratum.streaming.datasets import Dataset, live_table, snapshots, streaming_table

    t = RetailTables(root, prefix)
    ds = {}
    for name, tier, parts, kind in RETAIL_DATASETS:
        t.paths[name] = f"{root}/tables/{name}"
        ds[name] = Dataset(f"{prefix}_{name}", t.paths[name], comment=f"retail {kind} dataset {name}",
                           properties={"quality": tier} if tier else {}, partition_by=parts, compression=CODEC)
    ck = f"{root}/checkpoints"

    def upstream(name: str) -> DataFrame:
        schema = spark.read.parquet(t.paths[name]).schema
        return spark.readStream.schema(schema).parquet(t.paths[name])

    streaming_table(spark, ds["raw_retail"], raw_retail_stream(spark, csv_path, max_files), f"{ck}/raw")
    if landed:
        landed()
    streaming_table(spark, ds["cleaned_retail"], cleaned_retail(upstream("raw_retail")), f"{ck}/cleaned")
    cleaned_s = upstream("cleaned_retail")
    streaming_table(spark, ds["quality_retail"], quality_retail(cleaned_s), f"{ck}/quality")
    streaming_table(spark, ds["quarantined_retail"], quarantined_retail(cleaned_s), f"{ck}/quarantined")
    streaming_table(spark, ds["quality_retail_split_by_country"],
                    quality_split_by_country(upstream("quality_retail")), f"{ck}/split")

    # the keyed target takes the quality rows that are new; its version tells what they changed
    target = t.target(spark)
    target.append(upstream("quality_retail").select(*QUALITY_COLUMNS), f"{ck}/target")
    target.compact()
    target.read().createOrReplaceTempView(ds["retail_sales_all_countries"].name)
    for name in KEPT_SUMS:
        sums = t.sums(spark, name)
        for version in target.base.versions():
            if not sums.applied(version):           # the changes of one that is may be gone
                sums.apply(_sum_rows(spark, target, name, version), version)
        live_table(spark, ds[name], SHOWN[name](sums.read()))
    if keep_hours is not None:                      # all sums hold all versions
        target.vacuum(keep_hours)
        for name in KEPT_SUMS:
            t.sums(spark, name).vacuum(keep_hours)
            snapshots(spark, ds[name]).vacuum(keep_hours)
    return t
