"""Header feature tables: IPv4 (B2), TCP (B3), UDP (B4) and the combined
per-packet feature row (D1).

The reference parses every packet three times (three branches off an
unpersisted parent) and writes three outputs to one wide row. Here the
combined table is a single projection of the decoded frame: one scan, one
decode, no join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.bytesx import hex_lower


def ipv4_feature_cols() -> list[Column]:
    return [
        F.col("ipv4.src").alias("src"),
        F.col("ipv4.dst").alias("dst"),
        F.col("ipv4.version").alias("ip_version"),
        F.col("ipv4.protocol").alias("protocol"),
        F.col("ipv4.ihl").alias("ihl"),
        F.col("ipv4.tos").alias("tos"),
        F.col("ipv4.identification").alias("identification"),
        F.col("ipv4.total_length").alias("total_length"),
        F.col("ipv4.df").alias("df"),
        F.col("ipv4.mf").alias("mf"),
        F.col("ipv4.ttl").alias("ttl"),
        hex_lower(F.col("ipv4.options")).alias("options"),
    ]


def tcp_feature_cols(prefix: str = "") -> list[Column]:
    return [
        F.col("tcp.sport").alias(prefix + "sport"),
        F.col("tcp.dport").alias(prefix + "dport"),
        F.col("tcp.reserved").alias(prefix + "reserved"),
        hex_lower(F.col("tcp.options")).alias(prefix + "options"),
        F.col("tcp.flags").alias(prefix + "flags"),
    ]


def udp_feature_cols(prefix: str = "") -> list[Column]:
    return [
        F.col("udp.sport").alias(prefix + "sport"),
        F.col("udp.dport").alias(prefix + "dport"),
        F.col("udp.length").alias(prefix + "length"),
    ]


def ipv4_features(pk: DataFrame, key: list[str]) -> DataFrame:
    """B2 + C6: 12 IPv4 header fields for packets that have IPv4."""
    return pk.filter(F.col("has_ipv4")).select(*key, *ipv4_feature_cols())


def tcp_features(pk: DataFrame, key: list[str]) -> DataFrame:
    """B3 + C6: TCP ports, reserved bits, options, flags byte (header byte 13)."""
    return pk.filter(F.col("has_tcp")).select(*key, *tcp_feature_cols())


def udp_features(pk: DataFrame, key: list[str]) -> DataFrame:
    """B4 + C6: UDP ports and length."""
    return pk.filter(F.col("has_udp")).select(*key, *udp_feature_cols())


def packet_features(pk: DataFrame, key: list[str]) -> DataFrame:
    """One row per packet that has any of IPv4/TCP/UDP; absent layers
    leave their columns NULL (what the three writes to one row amount to)."""
    return (pk.filter(F.col("has_ipv4") | F.col("has_tcp") | F.col("has_udp"))
              .select(*key, *ipv4_feature_cols(), *tcp_feature_cols("tcp_"), *udp_feature_cols("udp_")))
