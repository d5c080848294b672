"""Key expressions: site prefixes (F20), hashing (F12) and salts."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from .util import as_col


def prefix_id(c, prefix: str | int | None) -> Column:
    """``prefix || id`` read back as a long; a null id stays null.

    With no prefix the id is returned as a long.  Callers that combine sites
    must use prefixes of one length, otherwise ``10||12`` and ``101||2``
    collide (``check_prefixes`` enforces this).
    """
    x = as_col(c)
    if prefix is None or str(prefix) == "":
        return x.cast("long")
    return F.when(x.isNull(), F.lit(None).cast("long")).otherwise(
        F.concat(F.lit(str(prefix)), x.cast("string")).cast("long"))


def prefix_id_text(c, prefix: str | None) -> Column:
    """String form of F20 for multi-site unification (facility code + id)."""
    x = as_col(c)
    if not prefix:
        return x.cast("string")
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(F.concat(F.lit(str(prefix)), x.cast("string")))


def check_prefixes(prefixes) -> None:
    lengths = {len(str(p)) for p in prefixes if p not in (None, "")}
    if len(lengths) > 1:
        raise ValueError(f"site prefixes must share one length, got lengths {sorted(lengths)}")


def hash_id(c, salt: str | None = None) -> Column:
    """md5 hex of the id's text.  With a salt, sha-256 of salt||id instead
    (plain md5 of small integers can be reversed by enumeration)."""
    x = as_col(c).cast("string")
    if salt:
        return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(F.sha2(F.concat(F.lit(salt), x), 256))
    return F.md5(x)


def keyed_hash(c, key: bytes, kind: str) -> Column:
    """HMAC-SHA256 (hex) of ``kind:id`` under a release's secret key, by built-in
    functions: ids cannot be found by enumeration without the key, one id hashes
    alike wherever it stands as the same kind, and ids of different kinds differ."""
    if not key:
        raise ValueError("keyed hashes need a key")
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)
    x = as_col(c).cast("string")
    text = F.concat(F.lit(f"{kind}:"), x).cast("binary")
    return F.when(x.isNotNull(), F.sha2(F.concat(F.lit(outer), F.unhex(F.sha2(F.concat(F.lit(inner), text), 256))), 256))


def stable_key(*cols) -> Column:
    """W4 for large tables: a deterministic 64-bit key from the natural key,
    computed row-locally (no single-partition window)."""
    return F.xxhash64(*[as_col(c) for c in cols])


def _dashed(h: Column) -> Column:
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def packed_uuid(uuid) -> Column:
    """A uuid as it moves through shuffles: 16 bytes and its form (0: hex digits,
    1: with dashes); any other text stays as it is."""
    u = as_col(uuid)
    bits = F.unhex(F.replace(u, F.lit("-"), F.lit("")))
    digits = F.lower(F.hex(bits))
    form = F.when(F.length(u) == 32, F.when(digits == u, 0)).when(F.length(u) == 36, F.when(_dashed(digits) == u, 1))
    return F.struct(form.alias("form"), F.when(form.isNotNull(), bits).alias("bits"), F.when(form.isNull(), u).alias("text"))


def unpacked_uuid(packed) -> Column:
    """The text that ``packed_uuid`` got."""
    p = as_col(packed)
    digits = F.lower(F.hex(p["bits"]))
    return F.when(p["form"] == 0, digits).when(p["form"] == 1, _dashed(digits)).otherwise(p["text"])
