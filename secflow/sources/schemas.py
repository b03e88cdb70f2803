"""Declared schemas of the raw inputs; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _DOUBLE, _INT, _TEXT = T.LongType(), T.DoubleType(), T.IntegerType(), T.StringType()

# The raw flow columns by type, in file order within each type.
FLOW_TEXT = ["proto", "service", "state"]
FLOW_DOUBLE = ["dur", "rate", "sload", "dload", "sinpkt", "dinpkt", "sjit", "djit", "tcprtt", "synack", "ackdat"]
FLOW_LONG = [
    "spkts", "dpkts", "sbytes", "dbytes", "sttl", "dttl", "sloss", "dloss", "swin", "dwin",
    "stcpb", "dtcpb", "smean", "dmean", "trans_depth", "response_body_len",
    "ct_srv_src", "ct_state_ttl", "ct_dst_ltm", "ct_src_dport_ltm", "ct_dst_sport_ltm",
    "ct_dst_src_ltm", "ct_ftp_cmd", "ct_flw_http_mthd", "ct_src_ltm", "ct_srv_dst",
]
FLOW_FLAG = ["is_ftp_login", "is_sm_ips_ports"]

FLOW = T.StructType(
    [T.StructField("id", _LONG)]
    + [T.StructField(c, _TEXT) for c in FLOW_TEXT]
    + [T.StructField(c, _DOUBLE) for c in FLOW_DOUBLE]
    + [T.StructField(c, _LONG) for c in FLOW_LONG]
    + [T.StructField(c, _INT) for c in FLOW_FLAG]
    + [T.StructField("attack_cat", _TEXT), T.StructField("label", _INT)]
)

SYSCALL = T.StructType(
    [T.StructField("timestamp", _DOUBLE)]
    + [T.StructField(c, _LONG) for c in ("processId", "threadId", "parentProcessId", "userId", "mountNamespace")]
    + [T.StructField(c, _TEXT) for c in ("processName", "hostName")]
    + [T.StructField("eventId", _LONG), T.StructField("eventName", _TEXT), T.StructField("stackAddresses", _TEXT)]
    + [T.StructField("argsNum", _LONG), T.StructField("returnValue", _LONG), T.StructField("args", _TEXT)]
    + [T.StructField("sus", _INT), T.StructField("evil", _INT)]
)

ARGS = T.ArrayType(
    T.StructType([T.StructField("name", _TEXT), T.StructField("type", _TEXT), T.StructField("value", _TEXT)])
)

FLOW_TARGETS = ["label", "attack_cat"]
SYSCALL_TARGETS = ["sus", "evil"]
# Never features: targets, the row key and the split tag.
NON_FEATURES = ["label", "attack_cat", "sus", "evil", "row_id", "split"]
