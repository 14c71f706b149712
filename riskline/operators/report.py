"""Run report table (S5), its sink and text, and global run status.

Each step contributes rows ``(step, key, value)``; the report is their union, so a run's metrics
are one small table.  In the sink a run has a partition of its own, which a repeated run replaces;
a partition counts as written once Spark's commit marker is there.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.sources.staging import exists

REPORT = "step string, key string, value string, position int"

# The report's headings and recommendations.
TITLE = "# Rapport d'Exécution du Pipeline de Détection de Fraude"
DATE = "**Date d'exécution:** "
SUMMARY = "## Résumé Exécutif"
ADVICE = (
    "## Recommandations", "",
    "- Surveiller les métriques de performance en continu",
    "- Valider la qualité des données synthétiques générées",
    "- Planifier le réentraînement selon la dérive observée",
    "", "---",
)
FOOTER = "*Rapport généré automatiquement le "


def step_rows(step: str, one_row: DataFrame, status_col: str | None = None) -> DataFrame:
    """Turn a one-row metrics frame into (step, key, value) rows: numbers with a fraction to six
    decimals, everything else as its string; a missing value stays null."""
    def text(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            return F.when(c.isNotNull(), F.format_string("%.6f", c.cast("double")))
        return c.cast("string")

    cols = one_row.columns
    long = one_row.select(*[text(f).alias(f.name) for f in one_row.schema.fields]).unpivot([], cols, "key", "value")
    return long.select(F.lit(step).alias("step"), "key", "value")


def write_report(report: DataFrame, root: str, run: str) -> str:
    """The report's rows as the partition ``run`` of the table at ``root``, with the order of its
    steps; a repeated run replaces its own partition."""
    at = os.path.join(root, f"run={run}")
    report.select("step", "key", "value", "position").coalesce(1).write.mode("overwrite").parquet(at)
    return at


def read_reports(spark: SparkSession, root: str, runs: list[str]) -> DataFrame:
    """The rows of the named runs that are whole, with their run."""
    whole = [r for r in runs if exists(spark, os.path.join(root, f"run={r}", "_SUCCESS"))]
    out = spark.createDataFrame([], f"{REPORT}, run string")
    for r in whole:
        out = out.unionByName(spark.read.schema(REPORT).parquet(os.path.join(root, f"run={r}")).withColumn("run", F.lit(r)))
    return out


def report_lines(report: DataFrame, executed_at: str) -> list[str]:
    """The report as Markdown lines; ``report`` has a row per step and key, in order of position."""
    lines = [TITLE, f"{DATE}{executed_at}", "", SUMMARY, ""]
    step = None
    for r in report.orderBy("position").collect():  # a few rows a step
        if r["step"] != step:
            lines += ([""] if step is not None else []) + [f"### {r['step'].replace('_', ' ').title()}", ""]
            step = r["step"]
        lines.append(f"- **{r['key']}:** {r['value']}")
    return [*lines, *([""] if step is not None else []), *ADVICE, f"{FOOTER}{executed_at}*"]


def pipeline_report(parts: list[DataFrame]) -> DataFrame:
    """The steps' rows in one table; ``position`` keeps their order (step, then key)."""
    out = None
    for k, p in enumerate(parts):
        p = p.withColumn("position", F.lit(1000 * k) + F.row_number().over(Window.partitionBy("step").orderBy(F.monotonically_increasing_id())))
        out = p if out is None else out.unionByName(p)
    return out


def global_status(report: DataFrame) -> DataFrame:
    """Failed if any step reported status 'failed'."""
    failed = (F.col("key") == "status") & (F.col("value") == "failed")
    return report.agg(F.when(F.max(failed.cast("int")) == 1, F.lit("failed")).otherwise(F.lit("success")).alias("global_status"),
                      F.countDistinct("step").alias("steps"))
