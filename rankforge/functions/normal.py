"""Normal distribution functions as Column expressions (no builtin erf/probit).

* ``probit`` — inverse normal CDF, algorithm AS241 (Wichura 1988, PPND16),
  relative accuracy ~1e-16.
* ``norm_cdf`` — normal CDF, Hart (1968) double-precision rational
  approximation as published by West (2005), accuracy ~1e-15.

Both are emitted twice from the same coefficient tables: as Spark Columns
(JVM codegen, no Python UDF) and as SQL text for the DuckDB oracle.

FIXED VALUES — published coefficients of the two algorithms, in natural order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# AS241 PPND16: central region |q| <= 0.425
AS241_A = [3.3871328727963666080e0, 1.3314166789178437745e+2, 1.9715909503065514427e+3,
           1.3731693765509461125e+4, 4.5921953931549871457e+4, 6.7265770927008700853e+4,
           3.3430575583588128105e+4, 2.5090809287301226727e+3]
AS241_B = [1.0, 4.2313330701600911252e+1, 6.8718700749205790830e+2, 5.3941960214247511077e+3,
           2.1213794301586595867e+4, 3.9307895800092710610e+4, 2.8729085735721942674e+4,
           5.2264952788528545610e+3]
# intermediate tail, r <= 5
AS241_C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
           3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
           2.27238449892691845833e-2, 7.74545014278341407640e-4]
AS241_D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
           1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
           1.05075007164441684324e-9]
# far tail, r > 5
AS241_E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
           2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
           2.71155556874348757815e-5, 2.01033439929228813265e-7]
AS241_F = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
           7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
           2.04426310338993978564e-15]

# Hart (1968) / West (2005) cumulative normal
HART_NUM = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
            112.079291497871, 221.213596169931, 220.206867912376]
HART_DEN = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
            296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]
HART_SPLIT = 7.07106781186547
HART_CUTOFF = 37.0
SQRT_2PI = 2.506628274631


# ---- generic polynomial builders ---------------------------------------------------
def _horner_col(coefs_high_first, x: Column) -> Column:
    acc = F.lit(float(coefs_high_first[0]))
    for a in coefs_high_first[1:]:
        acc = acc * x + F.lit(float(a))
    return acc


def sql_double(a: float) -> str:
    """A DOUBLE literal for DuckDB (plain decimals would parse as DECIMAL)."""
    s = repr(float(a))
    return s if ("e" in s or "inf" in s or "nan" in s) else s + "e0"


def _horner_sql(coefs_high_first, x: str) -> str:
    acc = sql_double(coefs_high_first[0])
    for a in coefs_high_first[1:]:
        acc = f"({acc}) * {x} + {sql_double(a)}"
    return acc


def _as241_ratio_col(num, den, r: Column) -> Column:
    # AS241 tables are stored low-order first
    return _horner_col(list(reversed(num)), r) / _horner_col(list(reversed(den)), r)


def _as241_ratio_sql(num, den, r: str) -> str:
    return f"(({_horner_sql(list(reversed(num)), r)}) / ({_horner_sql(list(reversed(den)), r)}))"


# ---- probit ------------------------------------------------------------------------
def probit(p) -> Column:
    """Inverse standard-normal CDF of ``p`` in (0, 1); NULL outside."""
    p = F.col(p) if isinstance(p, str) else p
    q = p - F.lit(0.5)
    r_c = F.lit(0.180625) - q * q
    central = q * _as241_ratio_col(AS241_A, AS241_B, r_c)
    tail_p = F.when(q < 0, p).otherwise(F.lit(1.0) - p)
    r_t = F.sqrt(-F.ln(tail_p))
    tail = F.when(r_t <= F.lit(5.0),
                  _as241_ratio_col(AS241_C, AS241_D, r_t - F.lit(1.6))) \
            .otherwise(_as241_ratio_col(AS241_E, AS241_F, r_t - F.lit(5.0)))
    signed_tail = F.when(q < 0, -tail).otherwise(tail)
    return F.when((p > 0) & (p < 1),
                  F.when(F.abs(q) <= F.lit(0.425), central).otherwise(signed_tail))


def probit_sql(p: str) -> str:
    q = f"(({p}) - 0.5e0)"
    r_c = f"(0.180625e0 - {q} * {q})"
    central = f"({q} * {_as241_ratio_sql(AS241_A, AS241_B, r_c)})"
    tail_p = f"(CASE WHEN {q} < 0 THEN ({p}) ELSE 1.0e0 - ({p}) END)"
    r_t = f"sqrt(-ln({tail_p}))"
    tail = (f"(CASE WHEN {r_t} <= 5.0e0 THEN {_as241_ratio_sql(AS241_C, AS241_D, f'({r_t} - 1.6e0)')} "
            f"ELSE {_as241_ratio_sql(AS241_E, AS241_F, f'({r_t} - 5.0e0)')} END)")
    return (f"(CASE WHEN ({p}) > 0 AND ({p}) < 1 THEN "
            f"(CASE WHEN abs({q}) <= 0.425e0 THEN {central} "
            f"ELSE (CASE WHEN {q} < 0 THEN -{tail} ELSE {tail} END) END) END)")


# ---- normal CDF ----------------------------------------------------------------------
def norm_cdf(x) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    ax = F.abs(x)
    e = F.exp(-(ax * ax) / F.lit(2.0))
    near = e * _horner_col(HART_NUM, ax) / _horner_col(HART_DEN, ax)
    cf = ax + F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        cf = ax + F.lit(k) / cf
    far = e / cf / F.lit(SQRT_2PI)
    lower = F.when(ax > F.lit(HART_CUTOFF), F.lit(0.0)) \
             .when(ax < F.lit(HART_SPLIT), near).otherwise(far)
    return F.when(x > 0, F.lit(1.0) - lower).otherwise(lower)


def norm_cdf_sql(x: str) -> str:
    ax = f"abs({x})"
    e = f"exp(-({ax} * {ax}) / 2.0e0)"
    near = f"({e} * ({_horner_sql(HART_NUM, ax)}) / ({_horner_sql(HART_DEN, ax)}))"
    cf = f"({ax} + 0.65e0)"
    for k in (4.0, 3.0, 2.0, 1.0):
        cf = f"({ax} + {sql_double(k)} / {cf})"
    far = f"({e} / {cf} / {sql_double(SQRT_2PI)})"
    lower = (f"(CASE WHEN {ax} > {sql_double(HART_CUTOFF)} THEN 0.0e0 WHEN {ax} < {sql_double(HART_SPLIT)} "
             f"THEN {near} ELSE {far} END)")
    return f"(CASE WHEN ({x}) > 0 THEN 1.0e0 - {lower} ELSE {lower} END)"
