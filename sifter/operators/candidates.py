"""MinHash LSH candidate pairs (scale path in front of pair scoring).

A signature of ``minhash_perms`` slots is cut into ``lsh_bands`` bands; two
documents are candidates when at least one band is identical. The band key is
the md5 of the band's slot values, and candidates come from one equi-join on
``(band, key)`` with the query side broadcast after a size check, so no
all-pairs enumeration happens. Every candidate is then scored exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.operators.common import bounded_broadcast
from sifter.params import Params


def band_keys(sigs: DataFrame, id_col: str, params: Params) -> DataFrame:
    """``(id, band, key)`` for every band of every signature."""
    rows = params.minhash_perms // params.lsh_bands
    keys = [F.md5(F.concat_ws(",", F.transform(F.slice("sig", b * rows + 1, rows), lambda x: x.cast("string"))))
            for b in range(params.lsh_bands)]
    return (sigs.where(F.col("sig").isNotNull())
            .select(id_col, F.posexplode_outer(F.array(*keys)).alias("band", "key")))


def band_candidates(q_sig: DataFrame, d_sig: DataFrame, q_id: str, d_id: str, params: Params) -> DataFrame:
    """``(q_id, d_id, n_bands)``: pairs sharing at least one band, with how many."""
    qk = band_keys(q_sig, q_id, params)
    dk = band_keys(d_sig, d_id, params)
    qb, _ = bounded_broadcast(qk, params.broadcast_max_rows)
    return (dk.join(qb, ["band", "key"]).groupBy(q_id, d_id)
            .agg(F.count(F.lit(1)).alias("n_bands")))
