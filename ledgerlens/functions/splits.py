"""Assignments derived from a key alone: the same customer always lands on the same side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: Column | str, salt: str, buckets: int = 1000) -> Column:
    """First 32 bits of md5(salt:key), modulo ``buckets``; reproducible in any SQL engine."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def fold_id(key: Column | str, folds: int, salt: str = "fold") -> Column:
    """Cross-validation fold 0..folds-1."""
    return (hash_bucket(key, salt) % F.lit(folds)).cast("int")


def treatment_flag(key: Column | str, share: float, salt: str = "treatment") -> Column:
    """1 for the treated share of customers, else 0.  Shares are whole thousandths."""
    if abs(share * 1000 - round(share * 1000)) > 1e-9:
        raise ValueError(f"share {share} is not a multiple of 0.001")
    return (hash_bucket(key, salt) < F.lit(round(share * 1000))).cast("int")


def conformal_part(key: Column | str, salt: str = "conformal") -> Column:
    """train / calibration / test in the proportions 60 / 20 / 20."""
    bucket = hash_bucket(key, salt)
    return F.when(bucket < 600, "train").when(bucket < 800, "calibration").otherwise("test")
