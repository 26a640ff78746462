"""Hashes that are equal in every engine: ids, digests, sampling."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The namespace of generated ids, this engine's own.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_DNS, "lexiloom")


def uuid5(seed: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """RFC 4122 version 5 UUID of a name, from SHA-1."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(seed, "UTF-8")))
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def sample_fraction(seed: str, key: Column) -> Column:
    """A stable number in [0, 1) for a key."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(seed + "|"), key), 256), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def prompt_hash(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def row_digest(columns: list[Column]) -> Column:
    """SHA-256 of the values in order, each closed by 0x1F; null as empty."""
    return F.sha2(F.concat(*[F.concat(F.coalesce(c.cast("string"), F.lit("")), F.lit("\x1f")) for c in columns]), 256)
