"""Statistical column functions without UDFs: normal pdf and inverse normal cdf."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Wichura's algorithm AS 241 (PPND16, Applied
# Statistics 1988), the inverse of the standard normal cdf to about 1e-16.
# Central region |q| <= 0.425, numerator then denominator, highest power first.
AS241_A = [2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
           13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608]
AS241_B = [5226.495278852545925, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
           5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0]
# Intermediate region r <= 5.
AS241_C = [7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177,
           1.27045825245236838258, 3.64784832476320460504, 5.7694972214606914055,
           4.6303378461565452959, 1.42343711074968357734]
AS241_D = [1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966,
           0.14810397642748007459, 0.68976733498510000455, 1.6763848301838038494,
           2.05319162663775882187, 1.0]
# Tail region r > 5.
AS241_E = [2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386,
           0.026532189526576123093, 0.29656057182850489123, 1.7848265399172913358,
           5.4637849111641143699, 6.6579046435011037772]
AS241_F = [2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5,
           7.868691311456132591e-4, 0.0148753612908506148525, 0.13692988092273580531,
           0.59983220655588793769, 1.0]


def _poly(coefs: list[float], r: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * r + F.lit(c)
    return acc


def inv_norm_cdf(p: Column) -> Column:
    """Standard normal quantile of p in (0, 1); null outside."""
    q = p - 0.5
    r_c = F.lit(0.180625) - q * q
    central = q * _poly(AS241_A, r_c) / _poly(AS241_B, r_c)
    r_t = F.sqrt(-F.log(F.when(q <= 0, p).otherwise(F.lit(1.0) - p)))
    mid = _poly(AS241_C, r_t - 1.6) / _poly(AS241_D, r_t - 1.6)
    tail = _poly(AS241_E, r_t - 5.0) / _poly(AS241_F, r_t - 5.0)
    outer = F.when(r_t <= 5.0, mid).otherwise(tail)
    outer = F.when(q < 0, -outer).otherwise(outer)
    return (F.when((p <= 0) | (p >= 1) | p.isNull(), F.lit(None).cast("double"))
            .when(F.abs(q) <= 0.425, central).otherwise(outer))


def norm_pdf(x: Column, mu: Column, sigma: Column) -> Column:
    z = (x - mu) / sigma
    return F.exp(-0.5 * z * z) / (sigma * math.sqrt(2 * math.pi))


def with_inv_norm_cdf(df, p: str, out: str):
    """``inv_norm_cdf`` in staged projections, so a complex ``p`` is computed once
    per row instead of being copied into every polynomial term."""
    q = F.col("_q")
    staged = df.withColumn("_p", F.col(p)).withColumn("_q", F.col("_p") - 0.5)
    staged = staged.withColumns({
        "_rc": F.lit(0.180625) - q * q,
        "_rt": F.sqrt(-F.log(F.when(q <= 0, F.col("_p")).otherwise(F.lit(1.0) - F.col("_p")))),
    })
    rt = F.col("_rt")
    staged = staged.withColumns({
        "_central": q * _poly(AS241_A, F.col("_rc")) / _poly(AS241_B, F.col("_rc")),
        "_outer": F.when(rt <= 5.0, _poly(AS241_C, rt - 1.6) / _poly(AS241_D, rt - 1.6))
                   .otherwise(_poly(AS241_E, rt - 5.0) / _poly(AS241_F, rt - 5.0)),
    })
    res = (F.when((F.col("_p") <= 0) | (F.col("_p") >= 1) | F.col("_p").isNull(), F.lit(None).cast("double"))
           .when(F.abs(q) <= 0.425, F.col("_central"))
           .when(q < 0, -F.col("_outer")).otherwise(F.col("_outer")))
    return staged.withColumn(out, res).drop("_p", "_q", "_rc", "_rt", "_central", "_outer")
