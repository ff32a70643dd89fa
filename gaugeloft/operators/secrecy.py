"""Encryption of single fields or of the whole payload, one key per tenant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloft.operators.joins import join_small

KEY = "_tenant_key"


def _sealed(value: Column) -> Column:
    return F.base64(F.aes_encrypt(value.cast("string"), F.col(KEY), F.lit("GCM")))


def encrypt_fields(df: DataFrame, keys: DataFrame, fields: list[str], tenant: str = "tenant_id") -> DataFrame:
    """Replaces the fields by encrypted text.

    ``keys`` has the tenant column and a binary ``key`` of 16, 24 or 32 bytes. A tenant without a
    key gets null, never plain text.
    """
    joined = join_small(df, keys.select(tenant, F.col("key").alias(KEY)), [tenant], how="left")
    return joined.select(*[_sealed(F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns])


def decrypt_fields(df: DataFrame, keys: DataFrame, fields: dict[str, str], tenant: str = "tenant_id") -> DataFrame:
    """Plain values again; ``fields`` maps each encrypted column to its type."""
    joined = join_small(df, keys.select(tenant, F.col("key").alias(KEY)), [tenant], how="left")

    def opened(name: str) -> Column:
        plain = F.aes_decrypt(F.unbase64(F.col(name)), F.col(KEY), F.lit("GCM"))
        return plain.cast("string").cast(fields[name]).alias(name)

    return joined.select(*[opened(c) if c in fields else F.col(c) for c in df.columns])


def encrypt_payload(df: DataFrame, keys: DataFrame, tenant: str = "tenant_id") -> DataFrame:
    """Tenant and the whole row as one encrypted JSON text."""
    payload = df.select(tenant, F.to_json(F.struct(*df.columns)).alias("payload"))
    return encrypt_fields(payload, keys, ["payload"], tenant)
