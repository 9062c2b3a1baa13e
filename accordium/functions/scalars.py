"""Column functions: hashing, tokens, encryption, masking, paths and times; all of them built from Spark's own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefix of an encrypted field, form of a token.
ENCRYPTED = "enc:v1:"
TOKEN = "^[0-9a-f]{64}$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_fingerprint(*columns: str) -> Column:
    """sha256 of the named columns' canonical text (version 1): sorted by name, nulls marked, joined by unit separators."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def hmac_pads(key: bytes) -> tuple[bytes, bytes]:
    """Inner and outer pads of HMAC-SHA256. They are as secret as the key: as literals they would stand in the plan."""
    key = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha256(value: str | Column, inner: Column, outer: Column) -> Column:
    """Lower-case hex of HMAC-SHA256 of a string column; pads are binary columns. Null stays null."""
    first = F.sha2(F.concat(inner, F.encode(col(value), "UTF-8")), 256)
    return F.sha2(F.concat(outer, F.unhex(first)), 256)


def token(value: str | Column, key: bytes) -> Column:
    """HMAC-SHA256 with a key that needn't be kept from those who see plans, as of test data: its pads are literals. For secret
    keys join the pads (operators.crypto.with_secrets) and use hmac_sha256."""
    inner, outer = hmac_pads(key)
    return hmac_sha256(value, F.lit(inner), F.lit(outer))


def encrypt(value: str | Column, key: Column, aad: Column) -> Column:
    """AES-GCM with a random nonce as enc:v1:<nonce>:<ciphertext and tag>. One evaluation gives both parts. The value must be
    a column: a literal would be folded to one nonce for all rows."""
    sealed = F.array(F.aes_encrypt(col(value), key, F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), aad))
    text = F.transform(sealed, lambda x: F.concat(F.lit(ENCRYPTED), F.base64(F.substring(x, 1, 12)), F.lit(":"), F.base64(F.substr(x, F.lit(13)))))
    return F.when(col(value).isNotNull(), text[0])


def decrypt(blob: str | Column, key: Column, aad: Column, strict: bool = True) -> Column:
    """The inverse; a wrong key, subject or field raises, or gives null unless strict."""
    parts = F.split(col(blob), ":")
    sealed = F.concat(F.unbase64(parts[2]), F.unbase64(parts[3]))
    f = F.aes_decrypt if strict else F.try_aes_decrypt
    return F.when(is_encrypted(blob), f(sealed, key, F.lit("GCM"), F.lit("DEFAULT"), aad).cast("string"))


def is_encrypted(value: str | Column) -> Column:
    return F.coalesce(F.startswith(col(value), F.lit(ENCRYPTED)), F.lit(False))


def mask_email(value: str | Column) -> Column:
    """Two letters at both ends of a local part of more than four, else the first; the rest bullets, three at least."""
    v = col(value)
    local, domain = F.substring_index(v, "@", 1), F.regexp_extract(v, "(@.*)$", 1)
    n = F.length(local)
    long = F.concat(F.substring(local, 1, 2), F.repeat(F.lit("•"), F.greatest(n - 4, F.lit(3))), F.right(local, F.lit(2)))
    return F.concat(F.when(n > 4, long).otherwise(F.concat(F.substring(local, 1, 1), F.lit("•••"))), domain)


def key_fingerprint(value: str | Column) -> Column:
    return F.substring(F.sha2(F.concat(F.lit("fingerprint:"), col(value).cast("string")), 256), 1, 12)


def normal_path(value: str | Column) -> Column:
    """s3a, s3n and s3 schemes alike, no slash at the end."""
    return F.rtrim(F.regexp_replace(col(value), "^s3[an]?://", "s3://"), F.lit("/"))


def bucket_and_key(value: str | Column) -> Column:
    """A store's path as struct(bucket, key): what stands before and behind the first slash after the scheme; a key may be empty."""
    rest = F.regexp_replace(normal_path(value), "^[a-z0-9]+://", "")
    return F.struct(F.substring_index(rest, "/", 1).alias("bucket"), F.regexp_extract(rest, "^[^/]*/(.*)$", 1).alias("key"))


def placed_path(value: str | Column, root: str | None = None) -> Column:
    """Where an object-store path is to be found: below a local root, if one is given, else under its normal form. Others stay."""
    v = col(value)
    below = F.concat(F.lit((root or "").rstrip("/") + "/"), F.regexp_replace(normal_path(v), "^s3://", ""))
    return F.when(v.rlike("^s3[an]?://"), below if root else normal_path(v)).otherwise(v)


def table_path(dataset: str | Column, root: str) -> Column:
    """A dataset's own table below a root: its last label names it."""
    return F.concat(F.lit(root.rstrip("/") + "/"), F.substring_index(col(dataset), ".", -1))


def escaped_label(value: str | Column) -> Column:
    """A label value of the metrics text format."""
    v = F.replace(col(value), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(v, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))


def frame_payload(value: str | Column) -> Column:
    """A framed message without its magic byte and schema id."""
    return F.substr(col(value), F.lit(6))
