"""Partition sizing for a given input volume.

The library does not build sessions; these helpers give the numbers a caller
passes to ``SparkSession.builder.config`` (or ``spark.conf.set``) so shuffle
and scan partitions fit executor memory at the target scale.
"""

from __future__ import annotations

MB = 1 << 20


def shuffle_partitions(input_bytes: int, target_bytes: int = 256 * MB, cores: int | None = None) -> int:
    """Enough partitions that each holds about ``target_bytes`` (at least one
    wave over ``cores`` when given). AQE coalesces small ones at runtime."""
    n = max(1, -(-int(input_bytes) // int(target_bytes)))
    if cores:
        n = max(n, int(cores))
    return n


def recommended_settings(input_bytes: int, cores: int, target_bytes: int = 256 * MB) -> dict[str, str]:
    """Spark SQL settings for a job reading about ``input_bytes``."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes, target_bytes, cores)),
        "spark.sql.files.maxPartitionBytes": str(min(target_bytes, 512 * MB)),
        # keep broadcasts to sides this library has proven small
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
    }


def buckets_for(table_bytes: int, bucket_bytes: int = 1 << 30) -> int:
    """Bucket count for a bucketed snapshot table: about ``bucket_bytes`` each,
    rounded up to a power of two."""
    n = max(1, -(-int(table_bytes) // int(bucket_bytes)))
    return 1 << (n - 1).bit_length()
