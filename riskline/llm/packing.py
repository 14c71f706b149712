"""Packing by cutting-stock column generation.

A document's ids are cut into full sequences and one rest; full pieces are sequences of
their own.  The rests' lengths, rounded up to classes of ``CLASS`` tokens, form a histogram
(at most capacity / CLASS numbers, whatever the corpus), over which a linear program picks
how often to use which pattern of classes; a knapsack by dynamic programming prices new
patterns until none shortens the program by more than ``GAP``.  Pattern counts are rounded
down, the few pieces left over are packed first-fit, and the documents of a class, ranked,
fill the slots of the patterns in turn.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskline.llm.common import ranked, staged, text_or_empty

CAPACITY = 4096
END_ID = 2
CLASS = 8
GAP = 0.003
#: Entries of a worker's word cache, which only saves time.
CACHE_WORDS = 1_500_000
#: Words that are tokenised as one string, and documents that wait for theirs together.
RUN_WORDS, WAITING = 128, 16
DIGIT = "7"

# Points after a letter: a-z and U+00C0-U+00FF but for U+00D7 and U+00F7; and points after others.
# Both begin with the point itself, so that the search skips what lies between the points.
_POINTS = re.compile(rb"[.,](?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))")
_OTHER_POINTS = re.compile(rb"[.,](?:(?<=[^a-z\s\x80-\xbf].)|(?<=(?<!\xc3)[\x80-\xbf].)|(?<=\xc3[\x97\xb7].))")
_WORKER: dict = {}


class _Ids(dict):
    """Ids of a run of non-white-space as little-endian bytes.

    White space always separates the tokenizer's own pieces, so a run's ids do not depend on
    its neighbours."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tok = Tokenizer.from_file(path)
        (self.digit,) = self.tok.encode(DIGIT, add_special_tokens=False).ids

    def fill(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(words)
        texts = [w.decode("utf-8", "surrogatepass") for w in new]
        # Words of letters alone go many to a string, parted by a digit: it is a piece of its own.
        plain = [k for k, t in enumerate(texts) if t.isalpha()]
        runs = [plain[k : k + RUN_WORDS] for k in range(0, len(plain), RUN_WORDS)]
        for run, ids in zip(runs, self._encode([DIGIT.join([texts[k] for k in run]) for run in runs])):
            at = np.flatnonzero(ids == self.digit).tolist()
            data = ids.tobytes()
            for k, a, b in zip(run, [0, *[i + 1 for i in at]], [*at, len(ids)]):
                self[new[k]] = data[4 * a : 4 * b]
        rest = [k for k, t in enumerate(texts) if not t.isalpha()]
        for k, ids in zip(rest, self._encode([texts[k] for k in rest])):
            self[new[k]] = ids.tobytes()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]


def _words(text: str) -> list[bytes]:
    """Parts of a text that the tokenizer treats each on its own, in lower case as it does.

    Letters and points never share a piece.  Its special tokens are matched in the raw text,
    so a text that may hold one is only split at white space.  ``bytes.split`` knows just the
    ASCII white space; where every point follows a letter or white space, plain replacement
    parts the points."""
    raw = text.encode("utf-8", "surrogatepass")
    if b"<|" in raw:
        return raw.split()
    lower = raw.lower()
    if _OTHER_POINTS.search(lower):
        return _POINTS.sub(rb" \g<0>", lower).split()
    return lower.replace(b".", b" .").replace(b",", b" ,").split()


def _tokenise(tokenizer: str, capacity: int, end_id: int):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _WORKER.get("path") != tokenizer:
            _WORKER.update(path=tokenizer, ids=_Ids(tokenizer))
        cache = _WORKER["ids"]
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])

            def put(doc_id, words) -> None:
                ids = b"".join(map(cache.__getitem__, words)) + end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    for col, v in zip(out, (doc_id, start, len(piece) // 4, zlib.crc32(piece), n)):
                        col.append(v)

            waiting: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = _words(text.as_py())
                try:
                    put(doc_id, words)
                except KeyError:
                    waiting.append((doc_id, words))
                if len(waiting) == WAITING:
                    cache.fill(set().union(*[w for _, w in waiting]))
                    while waiting:
                        put(*waiting.pop())
            if waiting:
                cache.fill(set().union(*[w for _, w in waiting]))
                for doc in waiting:
                    put(*doc)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=schema)

    return run


def best_pattern(price: np.ndarray, room: int) -> tuple[float, dict[int, int]]:
    """Unbounded knapsack: item class c (1-based) takes c units and is worth price[c - 1]."""
    use = np.flatnonzero(price > 1e-12)
    width, worth = use + 1, price[use]
    best = np.zeros(room + 1)
    pick = np.full(room + 1, -1)
    for w in range(1, room + 1):
        k = np.searchsorted(width, w, side="right")
        best[w] = best[w - 1]
        if k:
            got = best[w - width[:k]] + worth[:k]
            j = int(got.argmax())
            if got[j] > best[w] + 1e-15:
                best[w], pick[w] = got[j], j
    items: dict[int, int] = {}
    w = room
    while w > 0:
        if pick[w] < 0:
            w -= 1
        else:
            c = int(width[pick[w]])
            items[c] = items.get(c, 0) + 1
            w -= c
    return float(best[room]), items


def first_columns(demand: dict[int, int], room: int) -> tuple[list[dict[int, int]], list[float], list[int]]:
    """A first basis: one pattern, count and spent class for each class, whatever the corpus.

    Each pattern is filled first-fit from the largest class down and used until one of its
    classes is spent, which then leaves.  A pattern has none of the classes spent before it,
    so the basis is triangular in that order."""
    left, todo = {c: float(n) for c, n in demand.items()}, sorted(demand, reverse=True)
    patterns, counts, spent = [], [], []
    while todo:
        free, items = room, {}
        for c in todo:
            k = free // c if not items else min(free // c, int(np.ceil(left[c])))
            if k:
                items[c] = k
                free -= k * c
        x, gone = min((left[c] / k, c) for c, k in items.items())
        for c, k in items.items():
            left[c] = max(0.0, left[c] - k * x)
        todo.remove(gone)
        patterns.append(items)
        counts.append(x)
        spent.append(gone)
    return patterns, counts, spent


def column_generation(demand: dict[int, int], room: int, gap: float = GAP, rounds: int = 3_000) -> list[tuple[dict[int, int], float]]:
    """Patterns and their (fractional) counts for the demand {class: pieces}, by a revised
    simplex from :func:`first_columns` whose further columns :func:`best_pattern` prices."""
    classes = sorted(demand)
    m = len(classes)
    if not m:
        return []
    at = {c: k for k, c in enumerate(classes)}
    need = np.array([demand[c] for c in classes], float)
    columns, first, spent = first_columns(demand, room)
    inverse, count = np.zeros((m, m)), np.array(first)
    for k, c in enumerate(spent):  # forward substitution
        inverse[k, at[c]] = 1.0
        for j in range(k):
            if c in columns[j]:
                inverse[k] -= columns[j][c] * inverse[j]
        inverse[k] /= columns[k][c]
    bound = need @ np.array(classes) / room  # no sequence holds more than its room
    for _ in range(rounds):
        dual = inverse.sum(axis=0)
        price = np.zeros(room)
        price[np.array(classes) - 1] = dual
        worth, pattern = best_pattern(price, room)
        total = count.sum()
        bound = max(bound, need @ np.maximum(dual, 0) / worth)  # Farley's bound from below
        if worth <= 1 + 1e-9 or total * (1 - gap) <= bound:
            break
        a = np.zeros(m)
        for c, k in pattern.items():
            a[at[c]] = k
        step = inverse @ a
        ok = step > 1e-9
        ratio = np.where(ok, count / np.where(ok, step, 1), np.inf)
        out = int(ratio.argmin())
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        move = ratio[out]
        count = np.maximum(count - move * step, 0)
        count[out] = move
        columns[out] = pattern
    return list(zip(columns, count.tolist()))


def first_fit(demand: dict[int, int], room: int) -> list[dict[int, int]]:
    """First-fit decreasing, a class at a time, for the pieces left over by rounding."""
    bins: list[list] = []  # free room, items
    for c in sorted(demand, reverse=True):
        left = demand[c]
        for b in bins:
            k = min(left, b[0] // c)
            if k:
                b[0] -= k * c
                b[1][c] = b[1].get(c, 0) + k
                left -= k
            if not left:
                break
        while left:
            k = min(left, room // c)
            bins.append([room - k * c, {c: k}])
            left -= k
    return [b[1] for b in bins]


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Patterns with whole counts that hold every piece of the histogram exactly once."""
    whole = [(p, int(x + 1e-7)) for p, x in column_generation(histogram, room)]
    whole = [(p, k) for p, k in whole if k]
    left = dict(histogram)
    for p, k in whole:
        for c, a in p.items():
            left[c] -= a * k
    for c, short in [(c, -n) for c, n in left.items() if n < 0]:  # a rounding error of the solver
        for i, (p, k) in enumerate(whole):
            while short > 0 and k and c in p:
                k -= 1
                short -= p[c]
                for d, a in p.items():
                    left[d] += a
            whole[i] = (p, k)
    return [x for x in whole if x[1]] + [(p, 1) for p in first_fit({c: n for c, n in left.items() if n > 0}, room)]


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, klass: int = CLASS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of ``docs`` is a document (repeated rows too); null and empty texts have the
    end id alone.  Pieces of equal length class, id and start are interchangeable.  Other
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = staged(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(
            _tokenise(tokenizer, capacity, end_id), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
        ),
        "pieces",
    ).withColumn("klass", F.ceil(F.col("length") / klass).cast("int"))
    room = capacity // klass
    counts = {r["klass"]: r["n"] for r in pieces.groupBy("klass").agg(F.count("*").alias("n")).collect()}  # at most ``room`` rows
    patterns = plan({c: n for c, n in counts.items() if c < room}, room)
    if room in counts:
        patterns.append(({room: 1}, counts[room]))
    slots, base, done = [], 0, {}
    for items, k in patterns:
        place = 0
        for c, a in sorted(items.items(), reverse=True):
            lo = done.get(c, 0)
            slots.append((c, lo, lo + a * k, a, base, place))
            done[c] = lo + a * k
            place += a
        base += k
    # At most patterns x classes in a pattern: bounded by ``room``, not by the documents.
    slots_df = F.broadcast(spark.createDataFrame(slots, "klass int, lo long, hi long, per int, base long, place int"))
    nth = F.col("rank") - 1 - F.col("lo")
    placed = ranked(pieces, "klass", ["doc_id", "start", "ids_crc32"]).join(slots_df, "klass").where("rank > lo and rank <= hi")
    placed = placed.withColumn("sequence_id", F.col("base") + F.floor(nth / F.col("per"))).withColumn("slot", F.col("place") + nth % F.col("per"))
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")).alias("offset"),
    )
