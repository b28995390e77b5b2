"""The seven tables as parquet folders: creation, appends, audit, statistics, SQL.

A table is a folder of loads: every append is one ``load_id=...`` directory written in overwrite mode. A job or a
micro-batch that is run again after a failure replaces its own directory and nothing else.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException

from bookflow import contracts as ct
from bookflow.functions.keys import uuid_of
from bookflow.plans.session import compiled_methods

log = logging.getLogger(__name__)

# Columns the hot predicates filter on; the other tables are filtered through parquet statistics.
PARTITIONED = {
    "silver_transactions": "year_month", "gold_transactions": "year_month", "gold_period_summaries": "period_type",
}

# Columns looked up by single values that sort into no range. Their Bloom filters (or the dictionaries of columns with few
# values) let such a look-up skip row groups.
LOOKED_UP = {
    "bronze_transactions": ["source_file_hash", "ingestion_batch_id"], "file_results": ["file_hash"],
    "rejected_rows": ["file_hash"], "known_files": ["file_hash"],
}

# Ids and texts take about half the room they take as Spark's default.
CODEC = {"compression": "zstd"}

# Tables of which every load is a whole new version, and the load id of a newly made table, which sorts first.
VERSIONED = ["bronze_schema_mappings", "gold_period_summaries"]
CREATED = "0-created"

# Relations beside the tables: what became of every file, rows that were not stored, the status of settled rows, the
# steps of all rows, curated rows that a later load replaced, totals by day, summaries of the periods a load touched, and
# the manifest of files a stream took up.
EXTRAS = {
    "known_files": """file_name string, file_path string, file_hash string, source_type string, source_software string,
        detection_conf double, file_size_bytes bigint, detected_at string""",
    "file_results": """file_name string, file_hash string, success boolean, rows_written bigint, rows_rejected bigint,
        batch_id string, error string, parse_meta string""",
    "rejected_rows": """file_hash string, file_name string, source_row_number int, raw_content string, error string""",
    "processing_status": "bronze_id string, processing_status string",
    "status_events": "bronze_id string, status string, at timestamp, place int",
    "superseded": "transaction_id string, gold_version int, stored_in string, transaction_date date",
    "daily_partials": """transaction_date date, category string, vendor_normalised string, debits decimal(38,2),
        credits decimal(38,2), n bigint""",
    "period_refreshes": """period_type string, period_key string, fiscal_year string, total_debits decimal(18,2),
        total_credits decimal(18,2), net_cashflow decimal(18,2), transaction_count int, vs_prior_period_pct float,
        anomaly_flag boolean, anomaly_reason string, category_breakdown string, top_vendors string, summary_text string,
        summary_id string""",
}

# --- fixed values: the six tables counted by table_stats, and the operations written to the audit log --
COUNTED = [t for t in ct.TABLES if t != "bronze_schema_mappings"]
AUDIT_OPERATIONS = """
watcher_started watcher_stopped file_detected duplicate_file_skipped file_watcher_error bronze_ingest_empty
bronze_ingest_success bronze_ingest_failed schema_mapping_complete
""".split()


class Ledger:
    """The tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _stored(self, table: str) -> DataFrame:
        """The table's files; raises where there are none. The given schema spares Spark any look into them."""
        contract = ct.CONTRACTS[table]
        schema = T.StructType([*contract.schema.fields, T.StructField("load_id", T.StringType())])
        stored = self.spark.read.schema(schema).parquet(self.path(table))
        return stored.select(*schema.fieldNames())

    def _exists(self, table: str) -> bool:
        try:
            self._stored(table)
            return True
        except AnalysisException:
            return False

    def ensure_tables(self) -> None:
        """Create the tables that are missing and register all of them as views. Safe to repeat."""
        for table in ct.TABLES:
            if not self._exists(table):
                empty = self.spark.createDataFrame([], ct.CONTRACTS[table].schema)
                self.append(empty, table, CREATED)
        missing = self.missing_tables()
        if missing:
            raise RuntimeError(f"Schema verification failed. Missing tables: {missing}")
        self.register_views()

    def missing_tables(self) -> list[str]:
        """Expected tables that are not there."""
        return [t for t in ct.TABLES if not self._exists(t)]

    def read(self, table: str) -> DataFrame:
        """A table with its generated columns and ``load_id``; of a versioned table the newest version."""
        stored = self.version(table) if table in VERSIONED else self._stored(table)
        return ct.with_computed(stored, ct.CONTRACTS[table])

    def version(self, table: str, before: str | None = None) -> DataFrame:
        """The newest version of a table that is rewritten as a whole, or the newest one ``before`` a load.

        Load ids of such tables must sort by time. A load that is run again takes the version before itself, so it
        counts nothing twice. The condition on the partition column prunes every other version.
        """
        stored = self._stored(table)
        older = stored if before is None else stored.filter(F.col("load_id") < before)
        newest = older.agg(F.max("load_id")).first()[0] or CREATED
        return stored.filter(F.col("load_id") == newest)

    def register_views(self) -> None:
        """Temp views named like the tables."""
        for table in ct.TABLES:
            self.read(table).createOrReplaceTempView(table)

    def sql(self, query: str) -> DataFrame:
        """Any Spark SQL over the tables; failures are logged and raised again."""
        self.register_views()
        try:
            return self.spark.sql(query)
        except PySparkException as problem:
            log.error("SQL failed: %s", problem)
            raise

    def current(self, table: str, key: str, *newest: str) -> DataFrame:
        """One row per ``key``: of rows stored several times, as by a second run over the same raw rows, the greatest by
        ``newest`` and then by load. Only the key and these columns are grouped; whole rows meet the few keys that
        stand more than once."""
        stored, order = self.read(table), F.struct(*newest, "load_id")
        several = (
            stored.groupBy(key).agg(F.count("*").alias("_n"), F.max(order).alias("_newest")).filter("_n > 1").drop("_n")
        )
        return stored.join(several, key, "left").filter(F.col("_newest").isNull() | (order == F.col("_newest"))).drop("_newest")

    def read_curated(self) -> DataFrame:
        """Curated transactions for consumers, each in its highest version."""
        return self.current("gold_transactions", "transaction_id", "gold_version")

    def read_clean(self) -> DataFrame:
        """Clean rows, each as its last load left it."""
        return self.current("silver_transactions", "silver_id")

    def append(
        self, df: DataFrame, table: str, load_id: str, as_of: Column | None = None, strict: bool = False,
        unique: bool = False,
    ) -> int:
        """Write one load, with defaults filled and columns cast to the contract, and return how many rows it refused.

        Every row is checked against NOT NULL, the enumerations and the quality gate while it is written; ``unique``
        checks the unique keys as well, within the load and against other loads. The library's own ids are hashes of
        what makes a row unique, so its own appends go without. Refused rows are stored with their ``reasons`` and can
        be read by ``rejected``; with ``strict`` nothing is written and ValueError is raised.
        """
        contract = ct.CONTRACTS[table]
        ready = ct.apply_defaults(df, contract, as_of)
        if unique and contract.unique:
            others = self.read(table).filter(F.col("load_id") != load_id) if self._exists(table) else None
            accepted, rejected = ct.validate(ready, contract, existing=others, strict=strict)
            self._write(accepted, table, load_id)
            refused = rejected.count()
        else:
            judged = ready.withColumn("reasons", ct.row_reasons(contract, ready.columns))
            accepted = judged.filter(F.size("reasons") == 0).drop("reasons")
            rejected = judged.filter(F.size("reasons") > 0)
            if strict and not rejected.isEmpty():
                raise ValueError(f"{table}: rows break the contract: {rejected.first()['reasons']}")
            # Counted on the way, so that rows are worked out once when none is refused.
            seen = Observation()
            counted = judged.observe(seen, F.count_if(F.size("reasons") > 0).alias("refused"))
            self._write(counted.filter(F.size("reasons") == 0).drop("reasons"), table, load_id)
            try:
                refused = seen.get.get("refused") or 0
            except Py4JJavaError:  # the plan of an input that Spark knows to be empty has nothing to observe
                refused = rejected.count()
        if refused:
            rejected.write.mode("overwrite").parquet(f"{self.path('rejected')}/{table}/load_id={load_id}")
            log.warning("%s: %s rows break the contract and were set aside", table, refused)
        return refused

    def rejected(self, table: str) -> DataFrame:
        """Rows refused by ``append``, with their ``reasons``."""
        fields = [
            *ct.CONTRACTS[table].schema.fields, T.StructField("reasons", T.ArrayType(T.StringType())),
            T.StructField("load_id", T.StringType()),
        ]
        return self._folder(f"rejected/{table}", T.StructType(fields))

    def append_extra(self, df: DataFrame, name: str, load_id: str) -> None:
        """Write one load of a relation beside the tables."""
        with compiled_methods(self.spark):
            df.write.mode("overwrite").options(**CODEC, **bloom_filters(name)).parquet(f"{self.path(name)}/load_id={load_id}")

    def extra(self, name: str) -> DataFrame:
        """A relation beside the tables, empty before its first load. See EXTRAS."""
        return self._folder(name, T.StructType.fromDDL(f"{EXTRAS[name]}, load_id string"))

    def _folder(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.fieldNames())
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def _write(self, ready: DataFrame, table: str, load_id: str) -> None:
        folder = f"{self.path(table)}/load_id={load_id}"
        with compiled_methods(self.spark):
            if table in PARTITIONED:
                # Rebalancing gathers a partition's rows into few files and splits one that holds too many.
                column = PARTITIONED[table]
                ready.hint("rebalance", column).write.mode("overwrite").options(**CODEC).partitionBy(column).parquet(folder)
            else:
                ready.write.mode("overwrite").options(**CODEC, **bloom_filters(table)).parquet(folder)

    def audit(self, events: DataFrame, load_id: str) -> None:
        """Append audit events; a failing write is logged, never raised."""
        try:
            self.append(with_log_id(events, load_id), "pipeline_audit_log", load_id)
        except PySparkException as problem:
            log.warning("Audit log write failed (non-fatal): %s", problem)

    def table_stats(self) -> DataFrame:
        """(table_name, row_count) of six tables, -1 for an unreadable one. Counts come from parquet footers."""
        counts = []
        for table in COUNTED:
            if self._exists(table):
                rows = self.read(table).agg(F.count("*").alias("row_count"))
            else:
                rows = self.spark.range(1).select(F.lit(-1).cast("bigint").alias("row_count"))
            counts.append(rows.select(F.lit(table).alias("table_name"), "row_count"))
        return reduce(DataFrame.unionByName, counts)


def bloom_filters(table: str) -> dict[str, str]:
    """Write options for the columns of LOOKED_UP; a filter is as large as its row group's values need."""
    enabled = {f"parquet.bloom.filter.enabled#{c}": "true" for c in LOOKED_UP.get(table, [])}
    return {**enabled, "parquet.bloom.filter.adaptive.enabled": "true"} if enabled else {}


def with_log_id(events: DataFrame, load_id: str = "") -> DataFrame:
    """Adds a deterministic log_id to audit events; the same event of another load has another one."""
    return events.withColumn("log_id", uuid_of(F.lit(load_id), "operation", "source_id", "message"))


def audit_event(
    operation: str | Column, layer: str, status: str | Column, message: Column, rows: Column | None = None,
    source_id: Column | None = None, duration_ms: int = 0,
) -> list[Column]:
    """The audit columns of one event per row."""
    none = F.lit(None)
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    return [
        as_column(operation).alias("operation"),
        (none if source_id is None else source_id).cast("string").alias("source_id"),
        F.lit(layer).alias("source_layer"),
        as_column(status).alias("status"),
        message.alias("message"),
        (F.lit(0) if rows is None else rows).cast("int").alias("rows_affected"),
        F.lit(int(duration_ms)).alias("duration_ms"),
    ]
