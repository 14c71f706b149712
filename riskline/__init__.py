"""riskline: transaction-risk analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    table loading, the transaction fixture view, CSV scan, sinks, artifacts
functions  column expressions (features, deterministic RNG, normal/Kolmogorov math)
operators  DataFrame -> DataFrame operators (validation, exploration, cleaning,
           scaling, splitting, metrics, drift, anomalies, logs, rebalancing, models)
plans      the query catalog used by ``__spark_entry__`` and the DuckDB oracles
streaming  Structured Streaming versions of the windowed / scoring operators
"""

__all__ = ["session"]
