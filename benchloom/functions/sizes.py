"""Human-readable sizes and digests as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB")


def format_bytes(size: Column) -> Column:
    """Base 1024 with one decimal, ``PiB`` being the largest unit.

    ``format_number`` with a pattern rounds ties to even, as the expected texts do
    (``format_string`` would round 1.25 up).
    """
    n = size.cast("double")

    def scaled(power: int) -> Column:
        number = F.call_function("format_number", n / float(1024**power), F.lit("0.0"))
        return F.concat(number, F.lit(f" {UNITS[power]}"))

    out = scaled(len(UNITS) - 1)
    for power in range(len(UNITS) - 2, -1, -1):
        out = F.when(n < float(1024 ** (power + 1)), scaled(power)).otherwise(out)
    return F.when(size.isNotNull(), out)


def content_md5(hex_digest: Column) -> Column:
    """Base64 of the raw digest bytes, the form a ``Content-MD5`` header has."""
    return F.base64(F.unhex(hex_digest))
