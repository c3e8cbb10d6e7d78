"""Seeded random draws as column expressions.

A draw is the md5 of ``"<seed>:<seq>"``; the same text hashes the same way
in Spark and in plain SQL engines, so sampled results can be checked against
SQL. Using the first 13 hex digits (52 bits) gives a uniform value in
[0, 1) with the precision of a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13


def draw_hex(seq: Column | str, seed: int) -> Column:
    """Lower-case md5 hex of ``seed:seq`` (32 characters); a null counts as the empty text."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(seq.cast("string"), F.lit(""))))


def coin_threshold_hex(p: float) -> str | None:
    """Zero-padded hex threshold for probability ``p``; None means always."""
    if p >= 1:
        return None
    if p <= 0:
        return ""
    return format(int(p * 16 ** HEX_DIGITS), f"0{HEX_DIGITS}x")


def coin(seq: Column | str, seed: int, p: float) -> Column:
    """True with probability ``p``, decided by ``seed`` and ``seq``."""
    th = coin_threshold_hex(p)
    if th is None:
        return F.lit(True)
    if th == "":
        return F.lit(False)
    return F.substring(draw_hex(seq, seed), 1, HEX_DIGITS) <= F.lit(th)
