"""Flow, syscall, score and vector views derived from the star-schema tables.

Each view is a plain projection (plus one grouping for flows), so filters and column pruning
still reach the Parquet scans below it. ``*_SQL`` are the same views in ANSI SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.sources.readers import spread_scan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Expressions are shared text: both engines read them the same way.
_FLOW_COLUMNS = {
    "row_id": "(l_orderkey * 10 + l_linenumber) * 10000000000 + l_partkey % 1000000 * 10000 + l_suppkey % 10000",
    "proto": "l_returnflag",
    "service": "l_linestatus",
    "state": "o_orderstatus",
    "dur": "l_tax * l_quantity",
    "rate": "l_extendedprice / l_quantity",
    "sbytes": "l_extendedprice",
    "dbytes": "o_totalprice",
    "spkts": "l_quantity",
    "dpkts": "CAST(l_linenumber AS DOUBLE)",
    "sload": "l_tax",
    "dload": "l_discount",
    "sloss": "CAST(l_suppkey % 3 AS DOUBLE)",
    "dloss": "CAST(o_custkey % 2 AS DOUBLE)",
    "sttl": "CAST(l_partkey % 256 AS DOUBLE)",
    "dttl": "CAST(o_custkey % 256 AS DOUBLE)",
    "sjit": "l_extendedprice * l_tax * 400",
    "djit": "o_totalprice * l_discount * 100",
    "sinpkt": "l_tax * l_extendedprice / l_quantity",
    "dinpkt": "l_discount * o_totalprice / l_linenumber",
    "smean": "l_quantity * l_discount * 10",
    "dmean": "o_totalprice / (1000 * l_linenumber)",
    "ct_srv_src": "CAST(l_suppkey % 40 AS DOUBLE)",
    "ct_srv_dst": "CAST(o_custkey % 40 AS DOUBLE)",
    "ct_src_ltm": "CAST(l_partkey % 30 AS DOUBLE)",
    "ct_dst_ltm": "CAST(l_suppkey % 30 AS DOUBLE)",
    "label": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "attack_cat": "o_orderpriority",
}
FLOW_NUMERIC = [c for c in _FLOW_COLUMNS if c not in ("row_id", "proto", "service", "state", "label", "attack_cat")]
FLOW_SQL = (
    "flows AS (SELECT "
    + ", ".join(f"{e} AS {c}" for c, e in _FLOW_COLUMNS.items())
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)


def flow_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow records: one row per line item, keyed by order, line, part and supplier."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *[F.expr(e).alias(c) for c, e in _FLOW_COLUMNS.items()]
    )


_SYSCALL_REST = {
    "row_id": "event_id",
    "processId": "event_id % 50",
    "threadId": "event_id % 97",
    "parentProcessId": "event_id % 7",
    "userId": "user_id * 20",
    "mountNamespace": "4026531840 + event_id % 3",
    "processName": "event_type",
    "hostName": "concat('h', CAST(user_id % 5 AS VARCHAR(20)))",
    "eventId": "user_id % 10",
    "eventName": "event_type",
    "argsNum": "k % 4",
    "returnValue": "k - 50",
    "k": "k",
    "value": "value",
    "sus": "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END",
    "evil": "CASE WHEN event_type = 'error' AND k > 90 THEN 1 ELSE 0 END",
    "split": "CASE WHEN event_id % 5 < 3 THEN 'train' WHEN event_id % 5 = 3 THEN 'val' ELSE 'test' END",
}

SYSCALL_SQL = (
    "syscalls AS (SELECT date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 1000000.0::DOUBLE AS timestamp, "
    + ", ".join(f"{e} AS {c}" for c, e in _SYSCALL_REST.items())
    + " FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e)"
)

ARGS_SQL = (
    "call_args AS (SELECT row_id, sus, evil, split, ["
    "{'name': 'kind', 'type': 'str', 'value': eventName}, "
    "{'name': 'k', 'type': 'int', 'value': CAST(k AS VARCHAR)}, "
    "{'name': 'dev', 'type': 'dev_t', 'value': CAST(eventId AS VARCHAR)}] AS args FROM syscalls)"
)
TOKENS_SQL = (
    "tokens AS (SELECT row_id, sus, evil, split, "
    "unnest(list_transform(args, lambda a: a.name || '=' || a.value || '(' || a.type || ')')) AS term FROM call_args)"
)


def syscall_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System-call records: one row per event, with the call arguments as a literal string."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    seconds = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)") / F.lit(1e6)
    rest = {c: e for c, e in _SYSCALL_REST.items()}
    return (
        spread_scan(table(spark, sf_dir, "events"), "event_id")
        .withColumn("k", k)
        .select(
            seconds.alias("timestamp"),
            *[F.expr(e).alias(c) for c, e in rest.items()],
            F.format_string(
                "[{'name': 'kind', 'type': 'str', 'value': '%s'}, {'name': 'k', 'type': 'int', 'value': %d}, "
                "{'name': 'dev', 'type': 'dev_t', 'value': %d}]",
                F.col("event_type"), F.col("k"), F.expr("user_id % 10"),
            ).alias("args"),
        )
    )


SCORES_SQL = (
    "scores AS (SELECT doc_id AS row_id, CAST(n_chars AS DOUBLE) AS score, quality AS label, toxic "
    "FROM labels JOIN documents USING (doc_id))"
)


def score_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled scores: text length as the score of two document labels (ties, imbalance)."""
    return (
        table(spark, sf_dir, "labels")
        .join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
        .select(
            F.col("doc_id").alias("row_id"),
            F.col("n_chars").cast("double").alias("score"),
            F.col("quality").alias("label"),
            "toxic",
        )
    )


CLASSES_SQL = (
    "classes AS (SELECT o_orderkey AS row_id, o_orderpriority AS actual, "
    "CASE WHEN o_orderkey % 4 = 0 THEN '3-MEDIUM' WHEN o_orderkey % 7 = 1 THEN '1-URGENT' "
    "ELSE o_orderpriority END AS predicted FROM orders)"
)


def class_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-class predictions: the order priority and a deterministic guess of it."""
    guess = (
        F.when(F.col("o_orderkey") % 4 == 0, "3-MEDIUM")
        .when(F.col("o_orderkey") % 7 == 1, "1-URGENT")
        .otherwise(F.col("o_orderpriority"))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_orderpriority").alias("actual"), guess.alias("predicted")
    )


VECTORS_SQL = "vectors AS (SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS features, label FROM embeddings)"


def vector_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense vectors with their group label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("features"), "label"
    )
