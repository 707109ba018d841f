"""Keyed customer hash (HMAC-SHA256, RFC 2104) as a native Column expression.

HMAC(K, m) = SHA256((K' xor opad) || SHA256((K' xor ipad) || m)), where K' is
the key zero-padded to the 64-byte SHA-256 block (hashed first if longer).
Both pads are constants per salt, so the whole expression is two ``sha2``
calls over ``concat`` of binaries: it stays inside whole-stage codegen, no
Python worker is involved.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: default salt of the original pipeline, kept so that hashes
# of existing linked files stay comparable. Pass your own salt in production.
DEFAULT_SALT = "CHANGE_ME_SECRET_SALT"

_BLOCK = 64


def hmac_pads(salt: str | bytes) -> tuple[bytes, bytes]:
    """Inner and outer key pads for ``salt`` (UTF-8 if text)."""
    key = salt.encode("utf-8") if isinstance(salt, str) else bytes(salt)
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\x00")
    inner = bytes(b ^ 0x36 for b in key)
    outer = bytes(b ^ 0x5C for b in key)
    return inner, outer


def hmac_sha256_hex(c: Column | str, salt: str | bytes = DEFAULT_SALT) -> Column:
    """Lower-case hex HMAC-SHA256 of the UTF-8 text of ``c``; null stays null."""
    col = F.col(c) if isinstance(c, str) else c
    inner, outer = hmac_pads(salt)
    message = F.encode(col.cast("string"), "UTF-8")
    inner_digest = F.unhex(F.sha2(F.concat(F.unhex(F.lit(inner.hex())), message), 256))
    return F.sha2(F.concat(F.unhex(F.lit(outer.hex())), inner_digest), 256)


def hmac_sha256_digest(c: Column | str, salt: str | bytes = DEFAULT_SALT) -> Column:
    """The same HMAC as 32 raw bytes: half the size of the hex text, which
    matters when it is a shuffle key."""
    return F.unhex(hmac_sha256_hex(c, salt))


def digest_to_hex(c: Column) -> Column:
    """Raw digest -> the lower-case hex text of ``hmac_sha256_hex``."""
    return F.lower(F.hex(c))
