"""SHA-256 texts, keyed digests and link tokens."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(col: Column, salt: str = "") -> Column:
    """Lower-case hex SHA-256 of the cell's UTF-8 text, behind the salt if there is one."""
    text = col.cast("string")
    return F.sha2(F.concat(F.lit(salt), text) if salt else text, 256)


# The block size of SHA-256 and the two masks of HMAC.
HASH_BLOCK = 64
INNER, OUTER = 0x36, 0x5C


def hmac_sha256(col: Column, secret: bytes) -> Column:
    """The 32-byte HMAC-SHA256 of the cell's UTF-8 text, or of its bytes.

    Who does not have the secret cannot try out likely values, as with a plain
    or salted hash. The two masked forms of the secret stand in the plan as
    literals: whoever may read plans or event logs must be allowed to know it.
    """
    key = hashlib.sha256(secret).digest() if len(secret) > HASH_BLOCK else secret
    key = key.ljust(HASH_BLOCK, b"\0")
    inner, outer = (F.lit(bytes(byte ^ mask for byte in key)) for mask in (INNER, OUTER))
    once = F.unhex(F.sha2(F.concat(inner, col.cast("binary")), 256))
    return F.unhex(F.sha2(F.concat(outer, once), 256))


def link_token(keys: Sequence[Column], key_mode: str = "columns", secret: bytes = b"") -> Column:
    """The 32-byte SHA-256 of a composite key, half the size of its hex text.

    In ``columns`` mode each part of a composite key is written behind its
    length, so that no two different keys give the same text. With a ``secret``
    it is the HMAC-SHA256.
    """
    parts = [F.coalesce(key.cast("string"), F.lit("")) for key in keys]
    if key_mode == "columns" and len(parts) > 1:
        parts = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    text = F.concat(*parts)
    return hmac_sha256(text, secret) if secret else F.unhex(F.sha2(text, 256))
