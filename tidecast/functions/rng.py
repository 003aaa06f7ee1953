"""Counter-based randomness.

``u(seed, key...) = (first 8 hex digits of md5("seed:key:...") + 0.5) / 2^32``.
A draw depends only on its key, never on partitioning, task order or retries,
so every random operator is deterministic, retry-safe and has a SQL twin
(``sql_uniform`` below renders the same draw for DuckDB).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO32 = 4294967296.0


def _key(seed: int, keys) -> Column:
    parts = [F.lit(str(int(seed)))]
    for k in keys:
        parts.append(k if isinstance(k, Column) else F.lit(str(k)))
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def uniform(seed: int, *keys) -> Column:
    """Uniform draw in (0, 1) for the given key parts."""
    h = F.conv(F.substring(F.md5(_key(seed, keys)), 1, 8), 16, 10).cast("double")
    return (h + F.lit(0.5)) / F.lit(_TWO32)


def normal(seed: int, *keys) -> Column:
    """Standard normal draw by Box-Muller over two keyed uniforms."""
    u1 = uniform(seed, *keys, "bm1")
    u2 = uniform(seed, *keys, "bm2")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def hash_order(seed: int, *keys) -> Column:
    """A string sort key giving a seeded pseudo-random order."""
    return F.md5(_key(seed, keys))


# --- DuckDB twins (used by the oracle SQL) ---------------------------------

def sql_key(seed: int, *keys: str) -> str:
    parts = ", ".join([f"'{int(seed)}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"concat_ws(':', {parts})"


def sql_uniform(seed: int, *keys: str) -> str:
    return (f"((('0x' || substr(md5({sql_key(seed, *keys)}), 1, 8))::BIGINT + 0.5)"
            f" / {_TWO32})")


def sql_normal(seed: int, *keys: str) -> str:
    u1 = sql_uniform(seed, *keys, "'bm1'")
    u2 = sql_uniform(seed, *keys, "'bm2'")
    return f"(sqrt(-2.0 * ln({u1})) * cos({2.0 * math.pi!r} * {u2}))"
