"""HMAC-SHA256 as native Spark expressions.

``HMAC(K, m) = SHA256((K ⊕ opad) ‖ SHA256((K ⊕ ipad) ‖ m))`` with the key padded
to the 64-byte block (hashed first when longer).  The two padded keys
are read by scalar subqueries from a one-row table, so neither they nor the
secret are literals of any plan.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 64
IPAD, OPAD = 0x36, 0x5C


def hmac_pads(secret: bytes | str) -> tuple[bytes, bytes]:
    key = secret.encode("utf-8") if isinstance(secret, str) else bytes(secret)
    if len(key) > BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(BLOCK, b"\0")
    return bytes(b ^ IPAD for b in key), bytes(b ^ OPAD for b in key)


def signing_key(spark: SparkSession, secret: bytes | str) -> DataFrame:
    """The padded keys (``ipad``, ``opad``) as a one-row table; also what a deployment may
    keep in an access-controlled file and pass on as read."""
    return spark.createDataFrame([hmac_pads(secret)], "ipad binary, opad binary")


def hmac_sha256_hex(body, key: DataFrame) -> Column:
    """Lower-case hex HMAC-SHA256 of a binary (or string, UTF-8) column under the one-row
    table of :func:`signing_key`."""
    b = F.col(body) if isinstance(body, str) else body
    inner = F.unhex(F.sha2(F.concat(key.select("ipad").scalar(), b.cast("binary")), 256))
    return F.sha2(F.concat(key.select("opad").scalar(), inner), 256)
