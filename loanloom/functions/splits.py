"""Row-to-part assignment that depends on the row's key alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 10_000


def hash_bucket(*keys: str, seed: int, portable: bool = True) -> Column:
    """Bucket 0..9999 from the key and the seed.

    Portable: first 8 hex digits of ``md5("key:seed")`` modulo 10,000, which any other
    engine can repeat. Otherwise Spark's own 64-bit hash of the typed keys, about eight
    times cheaper. Null keys still get a bucket, so parts made from buckets cover every row.
    """
    if not portable:
        return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(BUCKETS)).cast("int")
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % BUCKETS).cast("int")
