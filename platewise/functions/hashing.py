"""Deterministic hashing: pseudonyms, buckets in [0, 1] and reproducible uniforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the bucket: 16 hex digits, divided by 16^16 - 1.
BUCKET_DIGITS = 16
BUCKET_DIVISOR = float(16**16 - 1)
# 13 hex digits are 52 bits, which a double holds exactly.
UNIFORM_DIGITS = 13
UNIFORM_DIVISOR = float(16**13)
DRAWS_PER_DIGEST = 4


def pseudonym(c: Column) -> Column:
    """SHA-256 hex of an identifier; null stays null."""
    return F.sha2(c.cast("string"), 256)


def seeded_digest(c: Column, seed: int | str) -> Column:
    """64 hex digits that order rows at random but reproducibly; null stays null."""
    return F.sha2(F.concat(c.cast("string"), F.lit(f"|{seed}")), 256)


def stable_bucket(c: Column, seed: int) -> Column:
    """Share in [0, 1] from the leading digits of the seeded digest."""
    head = F.substring(seeded_digest(c, seed), 1, BUCKET_DIGITS)
    return F.conv(head, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(BUCKET_DIVISOR)


def digest_uniform(digest: Column, slot: int) -> Column:
    """Uniform in [0, 1) cut from slot 0..3 of a digest, so one hash yields several draws."""
    part = F.substring(digest, 1 + slot * UNIFORM_DIGITS, UNIFORM_DIGITS)
    return F.conv(part, 16, 10).cast("double") / F.lit(UNIFORM_DIVISOR)
