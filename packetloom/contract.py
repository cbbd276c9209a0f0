"""Field lists, the feature contract and threshold precedence."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, replace
from typing import Any, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The 63 columns of the labelled packet table, in file order.
PACKET_COLUMNS = [
    "frame.time", "ip.src_host", "ip.dst_host",
    "arp.dst.proto_ipv4", "arp.opcode", "arp.hw.size", "arp.src.proto_ipv4",
    "icmp.checksum", "icmp.seq_le", "icmp.transmit_timestamp", "icmp.unused",
    "http.file_data", "http.content_length", "http.request.uri.query", "http.request.method",
    "http.referer", "http.request.full_uri", "http.request.version", "http.response", "http.tls_port",
    "tcp.ack", "tcp.ack_raw", "tcp.checksum", "tcp.connection.fin", "tcp.connection.rst",
    "tcp.connection.syn", "tcp.connection.synack", "tcp.dstport", "tcp.flags", "tcp.flags.ack",
    "tcp.len", "tcp.options", "tcp.payload", "tcp.seq", "tcp.srcport",
    "udp.port", "udp.stream", "udp.time_delta",
    "dns.qry.name", "dns.qry.name.len", "dns.qry.qu", "dns.qry.type",
    "dns.retransmission", "dns.retransmit_request", "dns.retransmit_request_in",
    "mqtt.conack.flags", "mqtt.conflag.cleansess", "mqtt.conflags", "mqtt.hdrflags", "mqtt.len",
    "mqtt.msg_decoded_as", "mqtt.msg", "mqtt.msgtype", "mqtt.proto_len", "mqtt.protoname",
    "mqtt.topic", "mqtt.topic_len", "mqtt.ver",
    "mbtcp.len", "mbtcp.trans_id", "mbtcp.unit_id",
    "Attack_label", "Attack_type",
]

# Label columns.
LABEL_COLUMNS = ["Attack_label", "Attack_type"]

# Identity and payload columns that are left out of training.
IDENTITY_PAYLOAD_COLUMNS = [
    "frame.time", "ip.dst_host", "ip.src_host",
    "arp.src.proto_ipv4", "arp.dst.proto_ipv4",
    "http.file_data", "http.request.full_uri", "icmp.transmit_timestamp", "http.request.uri.query",
    "tcp.options", "tcp.payload", "tcp.srcport", "tcp.dstport", "udp.port", "mqtt.msg",
]

# Metadata columns carried through beside file predictions ...
FILE_METADATA_FIELDS = [
    "frame.time", "ip.src_host", "ip.dst_host", "tcp.srcport", "tcp.dstport", "udp.port",
    "tcp.flags", "tcp.connection.syn", "tcp.connection.synack", "tcp.connection.rst",
    "tcp.connection.fin", "http.request.method",
]
# ... and beside window predictions.
WINDOW_METADATA_FIELDS = FILE_METADATA_FIELDS + ["dns.qry.name"]

# Field order of the window summary table.
WINDOW_SUMMARY_FIELDS = [
    "window_id", "window_start", "window_end", "interface", "source_path",
    "records", "attack_records", "attack_record_ratio",
    "mean_attack_probability", "median_attack_probability",
    "p95_attack_probability", "max_attack_probability",
    "threshold", "file_max_threshold", "file_ratio_threshold",
    "window_pred_label", "raw_csv_path", "unsupported_tshark_fields",
]

# Columns a calibration input must have.
CALIBRATION_FIELDS = ["records", "attack_record_ratio", "max_attack_probability"]

SOURCE_FILE = "source_file"


def spark_name(name: str) -> str:
    """Column name used inside the library: blanks and BOM cut, dots become underscores.

    pyspark.ml cannot address a column whose name has a dot, so field names
    are renamed once where they enter and kept that way.
    """
    return name.replace("﻿", "").strip().replace(".", "_")


def spark_names(names: Iterable[str]) -> list[str]:
    return [spark_name(n) for n in names]


def source_names(names: Iterable[str]) -> list[str]:
    """The names that fields have in packet files, for columns that were renamed at ingest."""
    original = {spark_name(c): c for c in PACKET_COLUMNS}
    return [original.get(n, n) for n in names]


def requested_fields(contract: "FeatureContract", include_metadata: bool = True) -> list[str]:
    """Fields a capture must deliver: the features, and the metadata fields unless left out."""
    return merge_fields(contract.feature_columns, spark_names(WINDOW_METADATA_FIELDS) if include_metadata else [])


def merge_fields(*field_lists: Iterable[str]) -> list[str]:
    """Union of field lists, first occurrence decides the position."""
    return list(dict.fromkeys(name for names in field_lists for name in names))


def feature_columns(columns: Iterable[str]) -> list[str]:
    """Columns that may be features: all but the labels and the provenance column."""
    excluded = {*spark_names(LABEL_COLUMNS), *LABEL_COLUMNS, SOURCE_FILE}
    return [c for c in columns if c not in excluded]


def split_supported(requested: Iterable[str], available: Iterable[str] | None) -> tuple[list[str], list[str]]:
    """Requested fields that a source offers, in request order, and the sorted rest."""
    requested = list(requested)
    if available is None:
        supported, unsupported = requested, []
    else:
        offered = set(available)
        supported = [f for f in requested if f in offered]
        unsupported = sorted(set(requested) - offered)
    if not supported:
        raise ValueError("none of the requested fields is available in the source")
    return supported, unsupported


def first_given(*values: Any) -> Any:
    """The first value that is not None; later arguments are weaker settings."""
    return next((v for v in values if v is not None), None)


@dataclass(frozen=True)
class Thresholds:
    """Decision settings; None means not given at this level."""

    record: float | None = None
    file_max: float | None = None
    file_ratio: float | None = None
    min_records: int | None = None

    def over(self, weaker: "Thresholds") -> "Thresholds":
        return Thresholds(**{f.name: first_given(getattr(self, f.name), getattr(weaker, f.name)) for f in fields(self)})


# Defaults of the record, window and size rules.
DEFAULT_RECORD_THRESHOLD = 0.5
DEFAULT_RATIO_THRESHOLD = 0.4
DEFAULT_MIN_RECORDS = 50


def resolve_thresholds(*levels: Thresholds | None) -> Thresholds:
    """Merge settings, strongest first (argument, baseline, bundle), then the defaults.

    Without any other setting the window maximum must reach the record threshold.
    """
    merged = Thresholds()
    for level in levels:
        if level is not None:
            merged = merged.over(level)
    record = first_given(merged.record, DEFAULT_RECORD_THRESHOLD)
    return merged.over(Thresholds(record, record, DEFAULT_RATIO_THRESHOLD, DEFAULT_MIN_RECORDS))


@dataclass(frozen=True)
class FeatureContract:
    """What training decided about the columns; scoring only follows it."""

    feature_columns: list[str]
    numeric_columns: list[str]
    categorical_columns: list[str]
    original_rows: int = 0
    rows_after_drop_duplicates: int = 0
    label_source: str = ""
    raw_columns: list[str] = field(default_factory=list)
    dropped_identity_payload_columns: list[str] = field(default_factory=list)
    dropped_empty_columns: list[str] = field(default_factory=list)
    dropped_constant_columns: list[str] = field(default_factory=list)
    numeric_parse_ratios: dict[str, float] = field(default_factory=dict)
    numeric_non_empty_counts: dict[str, int] = field(default_factory=dict)
    medians: dict[str, float] = field(default_factory=dict)
    min_category_count: int = 20
    record_threshold: float | None = None
    file_max_threshold: float | None = None
    file_ratio_threshold: float | None = None
    min_records: int | None = None
    threshold_strategy: str = "fixed"
    threshold_meta: dict[str, float] = field(default_factory=dict)
    evaluation_metrics: dict[str, float] = field(default_factory=dict)
    runtime: dict[str, float] = field(default_factory=dict)

    @property
    def thresholds(self) -> Thresholds:
        return Thresholds(self.record_threshold, self.file_max_threshold, self.file_ratio_threshold, self.min_records)

    def with_values(self, **values: Any) -> "FeatureContract":
        return replace(self, **values)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "FeatureContract":
        return cls(**json.loads(text))

    def report(self, spark: SparkSession) -> DataFrame:
        """One row: rows, features by kind and columns dropped by reason."""
        counts = {
            "original_rows": self.original_rows,
            "rows_after_drop_duplicates": self.rows_after_drop_duplicates,
            "features_used": len(self.feature_columns),
            "numeric_features": len(self.numeric_columns),
            "categorical_features": len(self.categorical_columns),
            "dropped_identity_payload": len(self.dropped_identity_payload_columns),
            "dropped_empty": len(self.dropped_empty_columns),
            "dropped_constant": len(self.dropped_constant_columns),
        }
        return spark.range(1).select(
            *[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()],
            F.lit(self.label_source).alias("label_source"),
        )
