"""Session settings sized to the input."""

from __future__ import annotations

MB = 1024 * 1024


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Spark settings for one run over ``input_bytes`` of bronze on ``cores``.

    Shuffles move keys, names and measures, never the JSON text: about a tenth of the input. They
    get partitions of about 512 MB, at least one per core, which adaptive execution merges to the
    advisory size when small and splits when skewed. Scan tasks read 128 MB at every input size, so
    no staged file grows with the input.
    """
    partitions = max(cores, -(-input_bytes // (10 * 512 * MB)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(128 * MB),
        "spark.sql.session.timeZone": "UTC",
    }
