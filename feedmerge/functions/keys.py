"""Keys derived from text, with built-in digests only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGESTS = {
    "MD5": F.md5,
    "SHA": F.sha1,
    "SHA1": F.sha1,
    "SHA-1": F.sha1,
    "SHA-224": lambda c: F.sha2(c, 224),
    "SHA-256": lambda c: F.sha2(c, 256),
    "SHA-384": lambda c: F.sha2(c, 384),
    "SHA-512": lambda c: F.sha2(c, 512),
}

# Digests that exist but that Spark has no expression for.
WITHOUT_EXPRESSION = ("MD2", "SHA-512/", "SHA3-")


def url_key(column: Column | str, algorithm: str = "MD5") -> Column:
    """The first 16 bytes of the digest as 32 hex digits; null stays null.

    An algorithm nobody knows gives an empty key, as the feeds expect.
    """
    name = algorithm.upper()
    if name.startswith(WITHOUT_EXPRESSION):
        raise NotImplementedError(f"Spark has no {algorithm} digest")
    digest = DIGESTS.get(name)
    if digest is None:
        return F.lit("")
    return F.substring(digest(F.col(column) if isinstance(column, str) else column), 1, 32)


def key_bucket(column: Column | str, buckets: int) -> Column:
    """A stable bucket number for a key of any type, text included; null goes to bucket 0.

    It is the first 60 bits of the MD5 of the key's text, modulo ``buckets``, so other
    systems find the same buckets.
    """
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    digits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(digits, F.lit(buckets)), F.lit(0)).cast("int")
