"""Distribution functions as column expressions (JVM-side, no UDF).

* ``kolmogorov_sf``: survival function of the Kolmogorov limit distribution,
  Q(l) = 2 sum_{k>=1} (-1)^(k-1) exp(-2 k^2 l^2); for l < 1 the equivalent theta
  form 1 - sqrt(2 pi)/l * sum exp(-(2k-1)^2 pi^2 / (8 l^2)) converges faster.
  Used for the asymptotic two-sample KS p-value.
* ``norm_cdf`` (erf-free Abramowitz-Stegun 7.1.26 form) and ``norm_ppf`` (Acklam's
  rational approximation) for the Gaussian copula (N13).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_TERMS = 20


def kolmogorov_sf(lam: Column) -> Column:
    big = F.lit(0.0)
    for k in range(1, _TERMS + 1):
        big = big + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam)
    small = F.lit(0.0)
    for k in range(1, _TERMS + 1):
        small = small + F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0) / (lam * lam))
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * small
    q = F.when(lam <= F.lit(0.0), F.lit(1.0)).when(lam < F.lit(1.0), small).otherwise(big)
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))


def kolmogorov_sf_sql(lam: str) -> str:
    big = " + ".join(f"{2.0 * (-1) ** (k - 1)} * exp({-2.0 * k * k} * ({lam}) * ({lam}))" for k in range(1, _TERMS + 1))
    small = " + ".join(f"exp({-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0} / (({lam}) * ({lam})))" for k in range(1, _TERMS + 1))
    return (f"least(greatest(CASE WHEN ({lam}) <= 0.0 THEN 1.0 WHEN ({lam}) < 1.0 THEN 1.0 - {math.sqrt(2 * math.pi)} / ({lam}) * ({small}) "
            f"ELSE {big} END, 0.0), 1.0)")


# fixed values: Acklam's inverse-normal coefficients
_A = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00]
_B = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00]
_P_LOW = 0.02425


def _poly(coefs, x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def norm_ppf(p: Column) -> Column:
    """Inverse standard normal CDF (relative error ~1e-9) for p in (0, 1)."""
    q_low = F.sqrt(F.lit(-2.0) * F.log(p))
    q_high = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    q = p - F.lit(0.5)
    r = q * q
    low = _poly(_C, q_low) / (_poly(_D, q_low) * q_low + F.lit(1.0))
    high = -_poly(_C, q_high) / (_poly(_D, q_high) * q_high + F.lit(1.0))
    mid = _poly(_A, r) * q / (_poly(_B, r) * r + F.lit(1.0))
    return F.when(p < F.lit(_P_LOW), low).when(p > F.lit(1 - _P_LOW), high).otherwise(mid)


def norm_cdf(x: Column) -> Column:
    """Standard normal CDF via erf (Abramowitz-Stegun 7.1.26, |error| < 1.5e-7)."""
    z = F.abs(x) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * z)
    poly = t * (F.lit(0.254829592) + t * (F.lit(-0.284496736) + t * (F.lit(1.421413741) + t * (F.lit(-1.453152027) + t * F.lit(1.061405429)))))
    erf = F.lit(1.0) - poly * F.exp(-z * z)
    return F.when(x >= 0, F.lit(0.5) * (F.lit(1.0) + erf)).otherwise(F.lit(0.5) * (F.lit(1.0) - erf))
