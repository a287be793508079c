"""Hash-derived scalars shared by the lexical and embedding operators.

All of them start from ``md5`` (hex), the one digest both Spark and the SQL
oracle compute identically, and stay in BIGINT arithmetic.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

MERSENNE_31 = (1 << 31) - 1  # modulus of the universal hash family


def hex_prefix_int(t: Column, n_hex: int) -> Column:
    """The first ``n_hex`` hex digits of ``md5(t)`` as a BIGINT."""
    return F.conv(F.substring(F.md5(t), 1, n_hex), 16, 10).cast("bigint")


def token_hash28(t: Column) -> Column:
    """28-bit token hash used by MinHash (products with 31-bit factors fit in BIGINT)."""
    return hex_prefix_int(t, 7)


def minhash_coefficients(n: int, seed: int) -> list[tuple[int, int]]:
    """``n`` pairs (a, b) of the hash family ``(a*h + b) mod (2^31 - 1)``, fixed by ``seed``."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, MERSENNE_31, size=n, dtype=np.int64)
    b = rng.integers(0, MERSENNE_31, size=n, dtype=np.int64)
    return [(int(x), int(y)) for x, y in zip(a, b)]
