"""Derived flow features: source/destination pairs, global indicators and the log stage.

Every stage is one projection over all columns, so the plan stays a single codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.columns import as_flag, guarded_ratio, signed_log

# Name rules for the partner of a source column, tried in this order.
PAIR_RULES = [("src_dport", "dst_sport"), ("src_sport", "dst_dport"), ("src", "dst")]
# Base columns with a long right tail.
SKEWED = ["sbytes", "dbytes", "spkts", "dpkts", "dur", "sloss", "dloss", "sttl", "dttl",
          "sload", "dload", "sjit", "djit"]
SYSCALL_SKEWED = ["timeSinceBoot", "processId", "parentProcessId"]
INTEGER_TOLERANCE = 0.05
TINY_PACKET = 10
EXTREME_JITTER = 1e6


def partner_of(name: str, columns: list[str]) -> str | None:
    """Destination column matching a source column, or None."""
    known = set(columns)
    if name.startswith("s") and "d" + name[1:] in known:
        return "d" + name[1:]
    for mine, theirs in PAIR_RULES:
        if mine in name:
            other = name.replace(mine, theirs)
            return other if other in known else None
    return None


def find_pairs(columns: list[str]) -> dict[str, str]:
    """Source column -> destination column, in column order."""
    found = ((c, partner_of(c, columns)) for c in columns)
    return {c: other for c, other in found if other is not None}


def pair_columns(src: str, dst: str) -> dict[str, Column]:
    """The eight derived columns of one pair."""
    s, d = F.col(src), F.col(dst)
    tail = f"{src}_{dst}"
    largest = F.greatest(guarded_ratio(s, d), guarded_ratio(d, s))
    return {
        f"sum_{tail}": s + d,
        f"diff_{tail}": s - d,
        f"ratio_{tail}": guarded_ratio(s, d),
        f"both_zero_{tail}": as_flag((s == 0) & (d == 0)),
        f"one_zero_{tail}": as_flag((s == 0) != (d == 0)),
        f"is_integer_ratio_{tail}": as_flag(F.abs(largest - F.rint(largest)) < INTEGER_TOLERANCE),
        f"distance_{tail}": guarded_ratio(F.abs(s - d), s + d),
        f"log_distance_{tail}": F.abs(F.log1p(s) - F.log1p(d)),
    }


def variation(src: str, dst: str) -> Column:
    """Population deviation of the two values over their mean; the deviation is half their gap."""
    s, d = F.col(src), F.col(dst)
    return guarded_ratio(F.abs(s - d) / 2, (s + d) / 2)


def global_columns(columns: list[str]) -> dict[str, Column]:
    """Indicators and interactions; each is present only when its inputs are."""
    have = set(columns)
    out: dict[str, Column] = {}

    def both(a: str, b: str) -> bool:
        return {a, b} <= have

    if both("smean", "dmean"):
        src, dst = F.col("smean") < TINY_PACKET, F.col("dmean") < TINY_PACKET
        out |= {"is_tiny_src_pkt": as_flag(src), "is_tiny_dst_pkt": as_flag(dst), "has_tiny_packet": as_flag(src | dst)}
    if both("sjit", "djit"):
        src, dst = F.col("sjit") > EXTREME_JITTER, F.col("djit") > EXTREME_JITTER
        out |= {
            "is_extreme_src_jitter": as_flag(src),
            "is_extreme_dst_jitter": as_flag(dst),
            "has_extreme_jitter": as_flag(src | dst),
        }
    if both("sloss", "dloss"):
        s, d = F.col("sloss"), F.col("dloss")
        out["unidirectional_loss"] = as_flag(((s == 0) & (d > 0)) | ((d == 0) & (s > 0)))
    if {"sbytes", "dbytes", "sinpkt", "dinpkt"} <= have:
        out["throughput_efficiency"] = guarded_ratio(
            F.col("sbytes") + F.col("dbytes"), F.col("sinpkt") + F.col("dinpkt")
        )
    for side, word in (("s", "src"), ("d", "dst")):
        if both(f"{side}inpkt", f"{side}mean"):
            out[f"ipt_size_product_{word}"] = F.col(f"{side}inpkt") * F.col(f"{side}mean")
    if {"sinpkt", "dinpkt", "smean", "dmean"} <= have:
        parts = [pair_columns(f"s{c}", f"d{c}")[f"distance_s{c}_d{c}"] for c in ("inpkt", "mean")]
        out["asymmetry_score"] = (parts[0] + parts[1]) / 2
    for name, tail in (("bytes", "bytes"), ("pkts", "pkts"), ("ipt", "inpkt")):
        if both(f"s{tail}", f"d{tail}"):
            out[f"cv_{name}"] = variation(f"s{tail}", f"d{tail}")
    return out


def engineer_flows(df: DataFrame, pairs: dict[str, str] | None = None) -> DataFrame:
    """Append all pair and global features."""
    chosen = find_pairs(df.columns) if pairs is None else pairs
    new: dict[str, Column] = {}
    for s, d in chosen.items():
        new |= pair_columns(s, d)
    new |= global_columns(df.columns)
    return df.select("*", *[e.alias(c) for c, e in new.items()])


def log_replacements(columns: list[str]) -> dict[str, Column]:
    """Column to replace -> its log expression (signed for differences)."""
    out: dict[str, Column] = {}
    for c in columns:
        of_skewed = any(base in c for base in SKEWED)
        if c in SKEWED or c.startswith("ct_") or (c.startswith("sum_") and of_skewed):
            out[c] = F.log1p(c)
        elif c.startswith("diff_") and of_skewed:
            out[c] = signed_log(F.col(c))
    return out


def replace_with_logs(df: DataFrame, logs: dict[str, Column]) -> DataFrame:
    """Drop each original column and append ``log_<name>``."""
    kept = [F.col(c) for c in df.columns if c not in logs]
    return df.select(*kept, *[e.alias(f"log_{c}") for c, e in logs.items()])


def log_flows(df: DataFrame) -> DataFrame:
    return replace_with_logs(df, log_replacements(df.columns))


def log_syscalls(df: DataFrame) -> DataFrame:
    return replace_with_logs(df, {c: F.log1p(c) for c in SYSCALL_SKEWED if c in df.columns})
