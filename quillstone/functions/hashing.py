"""Hash buckets and keyed hashes as expressions, equal on every engine."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_lower(text: Column) -> Column:
    """The last eight bytes of the MD5 read as a little-endian unsigned number, as decimal(20,0)."""
    digest = F.md5(text)
    turned = F.concat(*(F.substring(digest, at, 2) for at in range(31, 16, -2)))
    return F.conv(turned, 16, 10).cast("decimal(20,0)")


def md5_bucket(text: Column, n: int) -> Column:
    return (md5_lower(text) % n).cast("int")


def sha_bucket(text: Column, n: int = 100) -> Column:
    """SHA-256 modulo n: Horner's rule over 32-bit pieces."""
    digest, out = F.sha2(text, 256), F.lit(0).cast("long")
    for at in range(1, 65, 8):
        out = (out * (1 << 32) + F.conv(F.substring(digest, at, 8), 16, 10).cast("long")) % n
    return out.cast("int")


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Hex HMAC-SHA-256 from built-in hashes. The padded keys are literals of the plan: keep plans of secret keys out of logs."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ x for b in block)) for x in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))), 256)


def person_key(key: bytes, *parts: Column) -> Column:
    """A keyed hash of all parts; null if any part is."""
    joined = F.concat(*(x for p in parts for x in (F.upper(F.trim(p.cast("string"))), F.lit("\x1f"))))
    return F.when(joined.isNotNull(), hmac_sha256(key, joined))
