"""Identity of a file's content: a tree of hashes over its lines and their places.

A leaf covers the lines that begin in one block of bytes. The tasks add up hashes of (place, line), so
the ranges of a file are read apart and a leaf that two of them share is combined; a line in
another place gives another sum. The digests of the leaves are hashed in their order, a bounded number at
a time, up to one for the file. How a file was cut for reading plays no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.session import stage

LEAF_BYTES, FAN_OUT = 1 << 20, 1024


def content_digests(lines: DataFrame, leaf_bytes: int = LEAF_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """``file_path, content_id`` of every file that has a line, from ``file_path, byte, value``."""
    leaves = lines.groupBy("file_path", F.floor(F.col("byte") / leaf_bytes).alias("node")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.bit_xor(F.xxhash64("byte", "value")).alias("mixed"),
        F.sum(F.xxhash64("value", "byte").cast("decimal(38,0)")).alias("total"),
    )
    # Leaves without lines, in the middle of a long line, are none.
    digest = F.sha2(F.concat_ws(":", F.col("node").cast("string"), "lines", "mixed", F.col("total").cast("string")), 256)
    level = stage(leaves.select("file_path", "node", "lines", digest.alias("digest")))
    last = level.agg(F.max("node")).first()[0]
    while last:
        children = F.sort_array(F.collect_list(F.struct("node", "digest")))
        level = level.groupBy("file_path", F.floor(F.col("node") / fan_out).alias("parent")).agg(
            F.sum("lines").alias("lines"), children.alias("children")
        )
        joined = F.sha2(F.concat_ws(",", F.transform("children", lambda c: c["digest"])), 256)
        # A node of one child is that child: the height of other files plays no part.
        joined = F.when(F.size("children") == 1, F.col("children")[0]["digest"]).otherwise(joined)
        level = level.select("file_path", F.col("parent").alias("node"), "lines", joined.alias("digest"))
        last //= fan_out
    return level.select("file_path", F.concat_ws(":", F.lit("lines"), F.col("lines").cast("string"), "digest").alias("content_id"))
