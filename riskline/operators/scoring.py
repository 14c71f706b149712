"""Scoring requests and batch scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskline.functions.features import V_COLS

# fixed values: request feature order V1..V28, Time, Amount
REQUEST_ORDER = [*V_COLS, "Time", "Amount"]
REQUEST_LENGTH = 30


def requests_from_transactions(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Scoring requests as the service receives them: a 30-float array + an id."""
    return df.select(
        F.concat(F.lit("txn_"), F.col(key).cast("string")).alias("transaction_id"),
        F.array(*[F.col(c).cast("double") for c in REQUEST_ORDER]).alias("features"),
        *[c for c in (key, "Class") if c in df.columns],
    )


def requests_to_columns(req: DataFrame) -> DataFrame:
    """Unpack the request array into named columns (valid-length rows only)."""
    ok = req.where(F.size("features") == F.lit(REQUEST_LENGTH))
    return ok.select("*", *[F.col("features")[i].alias(c) for i, c in enumerate(REQUEST_ORDER)]).drop("features")


#: Why a request is skipped, in the order in which it is looked for.
FAULTS = ("missing", "wrong_length", "null_element", "nan_element")


def request_fault(features: str = "features") -> Column:
    """The first fault of a request's array, null for a sound request."""
    x = F.col(features)
    tests = (x.isNull(), F.size(x) != F.lit(REQUEST_LENGTH), F.exists(x, lambda v: v.isNull()), F.exists(x, lambda v: F.isnan(v)))
    found = F.lit(None).cast("string")
    for fault, test in reversed(list(zip(FAULTS, tests))):
        found = F.when(test, F.lit(fault)).otherwise(found)
    return found


def sound_requests(requests: DataFrame, observed: Observation | str | None = None) -> DataFrame:
    """The requests that can be scored.  With ``observed`` (an Observation for a batch, a name for a
    stream) the pass that scores them also counts ``requests``, ``scored`` and each fault.

    Give an Observation only to requests of a session of their own (``spark.newSession()``): once a
    session has had one, Spark can't send a model with a training summary from it to executors."""
    rows = requests.withColumn("_fault", request_fault())
    if observed is not None:
        counts = [F.count_if(F.col("_fault") == f).alias(f) for f in FAULTS]
        rows = rows.observe(observed, F.count(F.lit(1)).alias("requests"), F.count_if(F.col("_fault").isNull()).alias("scored"), *counts)
    return rows.where(F.col("_fault").isNull()).drop("_fault")
