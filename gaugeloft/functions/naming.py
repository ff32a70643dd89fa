"""Names and ids: tenant and file from a path, stable ids, key samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The DNS namespace of name-based UUIDs, and the tenant assumed without a path part.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"
DEFAULT_TENANT = "tenantA"


def tenant_of(path: Column, prefix: str = "tenant", default: str = DEFAULT_TENANT) -> Column:
    """First path part that starts with the prefix."""
    parts = F.filter(F.split(path, "/"), lambda part: part.startswith(prefix))
    return F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(default))


def file_name_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem_of(path: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(file_name_of(path), ".", 1)


def name_uuid(name: Column) -> Column:
    """Version-5 UUID of a name in the DNS namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(name, "UTF-8")))
    # The top two bits of the ninth byte are 10, so its first digit is one of 8, 9, a, b.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def file_id(tenant: Column, name: Column) -> Column:
    return name_uuid(F.concat(tenant, F.lit(":"), name))


def point_id(file: Column, chunk: Column, position: Column) -> Column:
    """The same point gets the same id again when a chunk is replayed."""
    return name_uuid(F.concat_ws(":", file, chunk.cast("string"), position.cast("string")))


def key_hash(key: Column) -> Column:
    """Non-negative number from the first 32 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def in_key_sample(key: Column, modulus: int = 1000) -> Column:
    """Keeps about one key in ``modulus``, each key wholly in or out, the same on every run."""
    return key_hash(key) % modulus == 0
