"""Queries: kNN joins and synthetic rebalancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.functions.rng import lcg_int_sql, lcg_uniform_sql
from riskline.operators import balance as bl
from riskline.operators.featurize import enrich
from riskline.operators.neighbors import knn
from riskline.plans.registry import query
from riskline.plans.sql import FEAT, TX, with_ctes
from riskline.sources import fixtures as fx

_F = bl.SMOTE_FEATURES
_Q = ['"Time"' if c == "Time" else c for c in _F]


def _dist_sql(a: str, b: str) -> str:
    return "sqrt(CAST(0 AS DOUBLE) + " + " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in _Q) + ")"


_MINO = "mino AS (SELECT event_id, " + ", ".join(_Q) + " FROM feat WHERE Class = 1)"
_KNN = f"""pairs AS (SELECT a.event_id AS qid, b.event_id AS pid, {_dist_sql('a', 'b')} AS dist FROM mino a JOIN mino b ON a.event_id <> b.event_id),
nn AS (SELECT * FROM (SELECT qid, pid, dist, row_number() OVER (PARTITION BY qid ORDER BY dist, pid) AS rank FROM pairs) WHERE rank <= 5)"""
_CNT = "cnt AS (SELECT count(CASE WHEN Class = 1 THEN 1 END) AS n_min, count(CASE WHEN Class <> 1 THEN 1 END) AS n_maj FROM feat)"


def _gen_sql(bases: str, n_base: str) -> str:
    idx = f"({lcg_int_sql('j', '1')} % nullif({n_base} * 5, 0))"  # no base rows -> no synthetic rows
    return f"""gen AS (SELECT j AS synthetic_id, CAST(floor({idx} / 5) AS BIGINT) + 1 AS base_rn, CAST({idx} % 5 AS INTEGER) + 1 AS nn_rank,
    {lcg_uniform_sql('j', '2')} AS gap
  FROM (SELECT unnest(range(0, CAST(floor(CAST(0.1 AS DOUBLE) * n_maj) AS BIGINT) - n_min)) AS j FROM cnt)),
br AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn FROM {bases}),
syn AS (SELECT g.synthetic_id, br.event_id AS base_id, nn.pid AS nn_id, g.gap FROM gen g JOIN br ON br.rn = g.base_rn JOIN nn ON nn.qid = br.event_id AND nn.rank = g.nn_rank)"""


_SYN_SELECT = ("SELECT s.synthetic_id, s.base_id, s.nn_id, "
               + ", ".join(f"round(b.{c} + s.gap * (n.{c} - b.{c}), 6) AS {c}" for c in _Q)
               + ", 1 AS Class FROM syn s JOIN mino b ON b.event_id = s.base_id JOIN mino n ON n.event_id = s.nn_id")


def _round_syn(spark, df):
    """Rounded synthetic rows; an empty table when nothing had to be generated."""
    if df is None:
        return spark.createDataFrame([], "synthetic_id bigint, base_id bigint, nn_id bigint, " + ", ".join(f"{c} double" for c in _F) + ", Class int")
    return df.select("synthetic_id", "base_id", "nn_id", *[F.round(c, 6).alias(c) for c in _F], "Class")


@query("j2_minority_knn", with_ctes(TX, FEAT, _MINO, _KNN) + "SELECT qid, rank, pid, round(dist, 6) AS dist FROM nn")
def j2_minority_knn(spark, sf):
    """Exact 5-NN of every fraud row among the fraud rows (band join, no all-pairs)."""
    e = enrich(fx.transactions(spark, sf)).where(F.col("Class") == 1)
    v = bl._vec(e, _F, "event_id")
    return knn(v, v, 5).select("qid", "rank", "pid", F.round("dist", 6).alias("dist"))


@query("b1_smote", with_ctes(TX, FEAT, _MINO, _KNN, _CNT, _gen_sql("mino", "(SELECT count(*) FROM mino)")) + _SYN_SELECT)
def b1_smote(spark, sf):
    """B1: SMOTE rows (ratio .1, k 5) on the raw notebook features."""
    return _round_syn(spark, bl.smote(enrich(fx.transactions(spark, sf))))


@query(
    "b10_balance_before_after",
    with_ctes(TX, FEAT, _CNT)
    + """SELECT n_min AS minority_before, n_maj AS majority_before, round(CAST(n_maj AS DOUBLE) / n_min, 6) AS ratio_before,
  CAST(floor(CAST(0.1 AS DOUBLE) * n_maj) AS BIGINT) AS minority_after,
  round(CAST(n_maj AS DOUBLE) / floor(CAST(0.1 AS DOUBLE) * n_maj), 6) AS ratio_after,
  round((CAST(n_maj AS DOUBLE) / n_min) / (CAST(n_maj AS DOUBLE) / floor(CAST(0.1 AS DOUBLE) * n_maj)), 6) AS improvement FROM cnt""",
)
def b10_balance_before_after(spark, sf):
    """Class balance before and after SMOTE (original + synthetic union)."""
    e = enrich(fx.transactions(spark, sf))
    syn = bl.smote(e)
    after = bl.balanced_dataset(e, syn, _F)
    b = e.agg(F.count(F.when(F.col("Class") == 1, 1)).alias("minority_before"), F.count(F.when(F.col("Class") != 1, 1)).alias("majority_before"))
    a = after.agg(F.count(F.when(F.col("Class") == 1, 1)).alias("minority_after"), F.count(F.when(F.col("Class") != 1, 1)).alias("_maj_after"))
    j = b.withColumn("_k", F.lit(1)).join(a.withColumn("_k", F.lit(1)), "_k")
    rb = F.col("majority_before") / F.col("minority_before")
    ra = F.col("_maj_after") / F.col("minority_after")
    return j.select("minority_before", "majority_before", F.round(rb, 6).alias("ratio_before"), "minority_after",
                    F.round(ra, 6).alias("ratio_after"), F.round(rb / ra, 6).alias("improvement"))


_ALL = "allv AS (SELECT event_id, Class, " + ", ".join(_Q) + " FROM feat)"
_DANGER = f"""ap AS (SELECT a.event_id AS qid, b.event_id AS pid, b.Class AS py, {_dist_sql('a', 'b')} AS dist FROM mino a JOIN allv b ON a.event_id <> b.event_id),
m10 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, pid) AS r FROM ap) WHERE r <= 10),
danger AS (SELECT qid AS event_id, count(CASE WHEN py <> 1 THEN 1 END) AS n_majority_neighbors FROM m10 GROUP BY qid
  HAVING count(CASE WHEN py <> 1 THEN 1 END) >= 5 AND count(CASE WHEN py <> 1 THEN 1 END) < 10)"""


@query("j3_danger_set", with_ctes(TX, FEAT, _MINO, _ALL, _DANGER) + "SELECT event_id AS id, n_majority_neighbors FROM danger")
def j3_danger_set(spark, sf):
    """Fraud rows whose 10 nearest rows (all classes) are 5-9 normal rows."""
    return bl.danger_set(enrich(fx.transactions(spark, sf)), _F, "Class", "event_id", 10, 1)


_KNN_DANGER = _KNN.replace("FROM mino a JOIN mino b", "FROM (SELECT m.* FROM mino m JOIN danger d ON d.event_id = m.event_id) a JOIN mino b")


@query(
    "b2_borderline_smote",
    with_ctes(TX, FEAT, _MINO, _ALL, _DANGER, _KNN_DANGER, _CNT, _gen_sql("danger", "(SELECT count(*) FROM danger)")) + _SYN_SELECT,
)
def b2_borderline_smote(spark, sf):
    """B2: borderline-1 SMOTE (danger rows as bases, k 5 minority neighbours)."""
    return _round_syn(spark, bl.borderline_smote(enrich(fx.transactions(spark, sf))))
