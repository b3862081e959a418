"""Keys that do not depend on partitioning: SHA-256 over unit-separated parts, and canonical JSON digests."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"


def stable_hash(*parts: Column | str | int | float) -> Column:
    """SHA-256 (hex) of the parts as text, joined by the unit separator; a null part reads None."""
    as_text = [F.coalesce(p.cast("string"), F.lit("None")) if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.sha2(F.concat_ws(SEPARATOR, *as_text), 256)


def hash_int(hex_hash: Column, digits: int = 8) -> Column:
    """The first hex digits of a hash as a whole number."""
    return F.conv(F.substring(hex_hash, 1, digits), 16, 10).cast("bigint")


def hash_unit(hex_hash: Column) -> Column:
    """The first 32 bits of a hash as a number from 0 to 1, both included."""
    return hash_int(hex_hash) / F.lit(float(0xFFFFFFFF))


def text_sha256(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()


def canonical_sha256(value: Any, *, ascii_only: bool = False, without: tuple[str, ...] = ()) -> str:
    """Digest of compact JSON with sorted keys; ascii_only escapes other characters, without drops top-level keys."""
    if without:
        value = {k: v for k, v in value.items() if k not in without}
    return text_sha256(json.dumps(value, ensure_ascii=ascii_only, sort_keys=True, separators=(",", ":")))


def evidence_sha256(value: dict) -> str:
    return canonical_sha256(value, ascii_only=True, without=("sha256",))


def manifest_sha256(value: dict) -> str:
    return canonical_sha256(value, without=("manifest_payload_sha256",))
