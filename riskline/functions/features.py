"""Feature expressions F1-F13.

Two variants exist for some features (library module vs. analysis notebooks); the
notebook variant is the default and the other is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

V_COLS = [f"V{i}" for i in range(1, 29)]

# ---- fixed values (must equal the reference's rules) ---------------------------------
SECONDS_PER_HOUR = 3600.0
SECONDS_PER_DAY = 86400.0
NIGHT_START_HOUR = 22.0          # Is_Night: hour >= 22 ...
NIGHT_END_HOUR = 6.0             # ... or hour <= 6 (notebook) / hour < 6 (module)
WEEKEND_FROM_DAY = 5             # Is_Weekend: day % 7 >= 5
AMOUNT_BINS_NOTEBOOK = (10.0, 50.0, 200.0)               # codes 0..3, right-closed
AMOUNT_BINS_FIVE = (0.0, 10.0, 50.0, 200.0, 1000.0)       # codes -1..4, right-closed
EXTREME_THRESHOLD_NOTEBOOK = 3.0
EXTREME_THRESHOLD_MODULE = 2.0
# ---------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hour(time="Time") -> Column:
    """fractional hour of day, (Time/3600) mod 24."""
    return F.pmod(_c(time) / F.lit(SECONDS_PER_HOUR), F.lit(24.0))


def day(time="Time") -> Column:
    """whole days since the start, floor(Time/86400)."""
    return F.floor(_c(time) / F.lit(SECONDS_PER_DAY)).cast("int")


def is_night(hour_col="Hour", variant: str = "notebook") -> Column:
    """night flag; notebook variant uses hour <= 6, module variant hour < 6."""
    h = _c(hour_col)
    late = h >= F.lit(NIGHT_START_HOUR)
    early = h <= F.lit(NIGHT_END_HOUR) if variant == "notebook" else h < F.lit(NIGHT_END_HOUR)
    return F.coalesce((late | early).cast("int"), F.lit(0))


def is_weekend(day_col="Day") -> Column:
    """simulated weekend, day % 7 >= 5."""
    return F.coalesce((F.pmod(_c(day_col), F.lit(7)) >= F.lit(WEEKEND_FROM_DAY)).cast("int"), F.lit(0))


def amount_log(amount="Amount") -> Column:
    """log1p(Amount)."""
    return F.log1p(_c(amount))


def amount_category(amount="Amount", variant: str = "notebook") -> Column:
    """amount band code.

    notebook: 0 by default, (10,50] -> 1, (50,200] -> 2, > 200 -> 3.
    five_bin: right-closed bins (0,10], (10,50], (50,200], (200,1000], (1000,inf) -> 0..4,
              anything outside (Amount <= 0, NULL) -> -1.
    """
    a = _c(amount)
    if variant == "notebook":
        b1, b2, b3 = AMOUNT_BINS_NOTEBOOK
        return (
            F.when(a > F.lit(b3), F.lit(3))
            .when(a > F.lit(b2), F.lit(2))
            .when(a > F.lit(b1), F.lit(1))
            .otherwise(F.lit(0))
        )
    if variant == "five_bin":
        e0, e1, e2, e3, e4 = AMOUNT_BINS_FIVE
        return (
            F.when(a.isNull() | (a <= F.lit(e0)), F.lit(-1))
            .when(a <= F.lit(e1), F.lit(0))
            .when(a <= F.lit(e2), F.lit(1))
            .when(a <= F.lit(e3), F.lit(2))
            .when(a <= F.lit(e4), F.lit(3))
            .otherwise(F.lit(4))
        )
    raise ValueError(f"unknown amount_category variant {variant!r}")


# Wide expressions are written as one SQL expression string: a single call into the
# JVM parser instead of hundreds of per-node Py4J round trips; the plan is identical.

def pca_magnitude(cols=V_COLS) -> Column:
    """Euclidean norm of the component columns."""
    return F.expr("sqrt(" + " + ".join(f"`{c}` * `{c}`" for c in cols) + ")")


def pca_extreme_count(cols=V_COLS, threshold: float = EXTREME_THRESHOLD_NOTEBOOK) -> Column:
    """F8: number of components with |V| > threshold."""
    return F.expr(" + ".join(f"coalesce(CAST(abs(`{c}`) > {float(threshold)!r} AS INT), 0)" for c in cols))


def default_transaction_id(id_col="transaction_id", key_col=None) -> Column:
    """keep a given id, else ``txn_<key>``.

    The reference stamps ``txn_<epoch seconds>``, which collides inside one second; a
    per-row key is used when one is given, the epoch form otherwise.
    """
    fallback = (
        F.concat(F.lit("txn_"), _c(key_col).cast("string"))
        if key_col is not None
        else F.concat(F.lit("txn_"), F.unix_timestamp().cast("string"))
    )
    return F.coalesce(_c(id_col), fallback)


def features_length_ok(features_col="features", expected: int = 30) -> Column:
    """request vector length check."""
    return F.coalesce(F.size(_c(features_col)) == F.lit(expected), F.lit(False))


def confidence(probability_col="probability") -> Column:
    """highest class probability of a Spark ML probability vector."""
    from pyspark.ml.functions import vector_to_array

    return F.array_max(vector_to_array(_c(probability_col)))
