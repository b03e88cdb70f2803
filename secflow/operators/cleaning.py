"""Row-wise cleaning of flow and system-call records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.functions.columns import as_flag, finite_or_zero, is_fractional, numeric_columns, text_columns
from secflow.operators import encoding
from secflow.sources.schemas import NON_FEATURES

# Fixed values of the system-call data.
INIT_PROCESS_IDS = [0, 1, 2]
FIRST_LOGIN_USER = 1000
ROOT_MOUNT_NAMESPACE = 4026531840
SYSCALL_UNUSED = ["threadId", "processName", "stackAddresses", "eventName"]


def rename_boot_time(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("timestamp", "timeSinceBoot")


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the columns that exist; missing ones are ignored."""
    return df.drop(*columns)


def drop_incomplete_rows(df: DataFrame) -> DataFrame:
    """Keep rows without null or NaN.

    One conjunct per column: a single predicate over all columns would make the optimizer's
    constraint propagation grow exponentially with the aliases below it.
    """
    kept = df
    for c in df.columns:
        kept = kept.filter(F.col(c).isNotNull())
        if is_fractional(df, c):
            kept = kept.filter(~F.isnan(c))
    return kept


def fill_gaps(df: DataFrame, skip: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Numbers: null, NaN and infinities become 0. Text: null becomes the empty string."""
    numbers, texts = numeric_columns(df, skip), text_columns(df, skip)
    out = []
    for c in df.columns:
        if c in numbers:
            filled = finite_or_zero(F.col(c)) if is_fractional(df, c) else F.coalesce(F.col(c), F.lit(0))
            out.append(filled.cast(df.schema[c].dataType).alias(c))
        elif c in texts:
            out.append(F.coalesce(F.col(c), F.lit("")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def syscall_flags(df: DataFrame) -> DataFrame:
    """Indicator columns for special ids and the sign of the return value."""
    return df.withColumns(
        {
            "processId_flag": as_flag(F.col("processId").isin(INIT_PROCESS_IDS)),
            "parentProcessId_flag": as_flag(F.col("parentProcessId").isin(INIT_PROCESS_IDS)),
            "userId_flag": as_flag(F.col("userId") < FIRST_LOGIN_USER),
            "mountNamespace_flag": as_flag(F.col("mountNamespace") == ROOT_MOUNT_NAMESPACE),
            "returnValue_flag": F.signum("returnValue").cast("int"),
        }
    )


def clean_syscalls(df: DataFrame, host_codes: DataFrame | None = None) -> DataFrame:
    """Flags, column drops, host codes and gap filling. Codes come from ``host_codes`` or this input."""
    out = drop_columns(syscall_flags(rename_boot_time(df)), SYSCALL_UNUSED)
    if "hostName" in out.columns:
        codes = host_codes if host_codes is not None else encoding.fit_codes(df, ["hostName"])
        out = encoding.apply_codes(out, codes, ["hostName"])
    return fill_gaps(out, skip=["args", "split"])


def clean_flows(df: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Drop incomplete rows and the file id, code text features, fill what is left."""
    out = drop_columns(drop_incomplete_rows(df), ["id"])
    texts = text_columns(out, NON_FEATURES)
    if texts:
        out = encoding.apply_codes(out, codes if codes is not None else encoding.fit_codes(out, texts), texts)
    return fill_gaps(out, skip=NON_FEATURES)


def binary_label_name(label: str, normal: str = "Normal", attack: str = "Attack"):
    return F.when(F.col(label) == 0, normal).otherwise(attack)


def true_class(label: str = "label", category: str = "attack_cat", normal: str = "Normal"):
    """The attack category, overwritten with ``normal`` wherever the binary label is 0."""
    return F.when(F.col(label) == 0, normal).otherwise(F.col(category))
