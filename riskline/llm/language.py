"""Language identification as multilingual mixture inference.

Each language has a distribution over hashed character n-grams, learned from labelled rows.
A document's n-grams come from a mixture of the languages; expectation-maximisation
estimates the proportions.  The language set is grown from the best single language by the
one that adds most likelihood, as long as the gain exceeds a penalty per language (half the
logarithm of the number of n-grams, as in the Bayesian information criterion, times
``PENALTY`` because neighbouring n-grams overlap).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.llm.common import in_fold, text_or_empty

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Labelled rows per language that the n-gram model is fitted on, by smallest hash of the id.
TRAIN_ROWS = 1500
SMOOTHING = 0.5
PENALTY = 6.0
EM_ROUNDS = 12
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")
_GAPS = re.compile(r"[\W\d_]+")
_SALT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)


def grams(text: str) -> np.ndarray:
    """Buckets of the n-grams of the lower-cased letters; other characters separate words."""
    letters = " " + _GAPS.sub(" ", text.lower()).strip() + " "
    code = np.frombuffer(letters.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    found, h = [], np.zeros(len(code), np.uint64)
    for k in range(max(ORDERS)):
        h = (h[: len(code) - k] * np.uint64(0x100000001B3)) + (code[k:] + np.uint64(1)) * _SALT[k % 3]
        if k + 1 in ORDERS:
            found.append(((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48))
    return np.concatenate(found).astype(np.int64) if len(code) > 2 else np.zeros(0, np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if lang not in totals:
                totals[lang] = np.zeros(BUCKETS, np.int64)
            totals[lang] += np.bincount(grams(text.as_py()), minlength=BUCKETS)
    for lang, n in totals.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n[at])], names=["lang", "bucket", "n"])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS):
    """(languages, log-probability matrix buckets x languages) from rows with a language.

    Fitted on at most ``rows`` rows a language, those of smallest hash of id.  The matrix
    has BUCKETS rows whatever the corpus, and comes to the driver."""
    spark = labelled.sparkSession
    rows_of = labelled.where(F.col(lang_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows_of.groupBy(F.col(lang_col).cast("string")).count().collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((BUCKETS, 0))
    # A threshold on the hash that leaves each language about ``rows`` rows: no sort, no collect.
    keep = F.lit(False)
    u = F.pmod(F.xxhash64(F.col(id_col), F.lit("lang")), F.lit(1_000_000))
    for lang in langs:
        share = min(1.0, rows / sizes[lang])
        keep = keep | ((F.col(lang_col) == lang) & (u < F.lit(int(share * 1_000_000))))
    parts = rows_of.where(keep).select(F.col(lang_col).cast("string").alias("lang"), text_or_empty(text_col).alias("text"))
    counts = parts.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    at = {lang: k for k, lang in enumerate(langs)}
    for r in counts.collect():  # at most BUCKETS rows a language
        table[r["bucket"], at[r["lang"]]] += r["n"]
    return langs, np.log(table / table.sum(axis=0))


def mixture(logp: np.ndarray, n: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Proportions of the languages for a document with n-gram counts ``n`` whose rows of
    log-probabilities are ``logp``."""
    single = n @ logp
    langs, total = logp.shape[1], n.sum()
    share = np.zeros(langs)
    chosen = [int(single.argmax())]
    share[chosen] = 1.0
    if langs == 1:
        return share
    top = logp.max(axis=1, keepdims=True)
    p = np.exp(logp - top)
    best = float(n @ np.log(p[:, chosen[0]] + 1e-300))
    cost = penalty * 0.5 * np.log(max(total, 2.0))
    # An upper bound of any mixture: every n-gram from its best language.
    while len(chosen) < langs and -best > cost:
        tried = []
        for extra in set(range(langs)) - set(chosen):
            cols = [*chosen, extra]
            w = np.full(len(cols), 1 / len(cols))
            q = p[:, cols]
            for _ in range(EM_ROUNDS):
                mix = q @ w
                w = w * ((n / mix) @ q) / total
            tried.append((float(n @ np.log(q @ w)), extra, cols, w))
        like, _, cols, w = max(tried, key=lambda t: (t[0], -t[1]))
        if like - best <= cost:
            break
        best, chosen = like, cols
        share[:] = 0
        share[cols] = w
    return share


def _predict(langs: list[str], logp: np.ndarray, text_at: int):
    def predict(text: str | None) -> tuple[str, float, int]:
        if not langs or not text or not _LETTER.search(text):
            return UNDETERMINED, 0.0, 0
        buckets = grams(text)
        if len(buckets) > BUCKETS // 4:
            counted = np.bincount(buckets, minlength=BUCKETS)
            at = np.flatnonzero(counted)
            n = counted[at].astype(float)
        else:
            at, n = np.unique(buckets, return_counts=True)
            n = n.astype(float)
        share = mixture(logp[at], n)
        k = int(share.argmax())
        return langs[k], min(1.0, float(share[k])), int((share > 0).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [predict(t.as_py()) for t in batch.column(text_at)]
            more = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*(f"c{k}" for k in range(batch.num_columns)), "lang_pred", "score", "n_languages"])

    return run


def _predicted(docs: DataFrame, cols: list[str], text_col: str, model) -> DataFrame:
    langs, logp = model
    named = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(cols)])
    out = T.StructType([*named.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("n_languages", T.IntegerType())])
    return named.mapInArrow(_predict(langs, logp, cols.index(text_col)), out)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(~in_fold(id_col, 4, 2))


def identify(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score (the language's proportion),
    n_languages.  ``und`` with score 0 for a null text, a text without a letter, or a model
    without languages.  Other columns are never read."""
    return _predicted(docs, [id_col, text_col], text_col, model).select(
        F.col("c0").alias("doc_id"), "lang_pred", "score", "n_languages"
    )


def keep_identified(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is found, with all their columns."""
    rows = _predicted(docs, docs.columns, text_col, model).where(F.col("lang_pred") != UNDETERMINED)
    return rows.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])
