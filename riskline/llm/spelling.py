"""Spelling variants by dynamic programming along a sorted vocabulary.

Words of a vocabulary that are one edit apart are found in sorted lists.  A word keeps three
cells of each row of its edit matrix (the band of one edit).  The rows belong to prefixes of
the sorted list: all words that share a prefix reuse its row, and the whole range of words
under a prefix is skipped once no cell of its row is within one edit.  The ranges come from the
longest common prefixes (LCP) of neighbours in the list.

Lists are cut so that each fits a task.  Of two words one edit apart, the shorter of length
m, either the first m // 2 letters are equal or, if not, the last m - m // 2 are.  So words meet
in the list of their first or of their last letters, once for each m, and only what lies between
(the middle) is compared.  A list of over ``LIST_WORDS`` words is cut again by the same rule
applied to its middles, so a common beginning or ending is never one task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import partitions, staged, text_or_empty

MIN_LENGTH = 7
MIN_COUNT = 2
#: A form is at least so many times as frequent as its variant.
RATIO = 10
#: One in so many (document, run) pairs has a letter deleted.
DELETES = 31
#: Words of a list; longer ones are cut again.
LIST_WORDS = 20_000
#: Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 300_000
#: Words that are compared at a time in a task.
BLOCK_WORDS = 20_000
_NO_BOUND = 1 << 30

# Letters A-Z, a-z and U+00C0-U+00FF, with A-Z lower-cased; all else separates runs.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> list[bytes]:
    """The maximal runs of letters in Latin-1, one byte for a code point."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _count(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def hand_on() -> pa.RecordBatch:
            words, n = [w.decode("latin-1") for w in held], list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs(text.as_py())).items():
                    if len(word) >= min_length:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), own)
                        if h % DELETES == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < min_length:
                                continue
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield hand_on()
        yield hand_on()

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) for the words of whole texts with ``min_count`` occurrences or more."""
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), text_or_empty(text_col).alias("text"))
    counted = rows.mapInArrow(_count(min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _cut(lists: DataFrame) -> DataFrame:
    """Each list (head, tail, m, below) of middles cut into those of a common beginning and those
    of a common ending.  ``m`` is the shorter length of a pair's middles; a pair of the list has
    fewer than ``below`` leading letters of its middles in common (it meets elsewhere otherwise)."""
    half = F.expr("m div 2").cast("int")
    end = F.col("m") - half
    size = F.length("mid")
    starts = F.struct(
        F.concat("head", F.col("mid").substr(F.lit(1), half)).alias("head"), F.col("tail").alias("tail"), end.alias("m"),
        (F.col("below") - half).alias("below"), F.col("mid").substr(half + 1, size).alias("mid"),
    )
    ends = F.struct(
        F.col("head").alias("head"), F.concat(F.col("mid").substr(size - end + 1, end), "tail").alias("tail"), half.alias("m"),
        F.least("below", half).alias("below"), F.col("mid").substr(F.lit(1), size - end).alias("mid"),
    )
    return lists.select("word", "n", F.explode(F.array(starts, ends)).alias("l")).select("l.*", "word", "n").where("below > 0")


_LIST = ["head", "tail", "m", "below"]


def _lists(words: DataFrame, min_length: int, list_words: int) -> DataFrame:
    """(head, tail, m, below, mid, word, n): the lists in which words one edit apart meet."""
    size = F.length("word")
    both = F.filter(F.array(size, size - 1), lambda m: m >= min_length)
    whole = words.select("word", "n", F.explode(both).alias("m")).select(
        F.lit("").alias("head"), F.lit("").alias("tail"), "m", F.lit(_NO_BOUND).alias("below"), F.col("word").alias("mid"), "word", "n"
    )
    lists = _cut(whole)
    while True:
        # At most (words of all lists) / list_words rows; middles of one letter are few anyway.
        long = staged(lists.where("m > 1").groupBy(*_LIST).agg(F.count("*").alias("size")).where(F.col("size") > list_words).select(*_LIST), "long_lists")
        if long.isEmpty():
            return lists
        lists = staged(lists.join(long, _LIST, "left_anti").unionByName(_cut(lists.join(long, _LIST, "left_semi"))), "lists")


class SortedList:
    """Middles in sorted order, list after list, as one byte array with offsets."""

    def __init__(self, middles: list[str], first: np.ndarray):
        """``first``: the position of the first word of the same list, for each word."""
        self.letters = np.frombuffer("".join(middles).encode("latin-1") + b"\0", np.uint8)
        self.size = np.fromiter(map(len, middles), np.int64, len(middles))
        self.at = np.concatenate([[0], np.cumsum(self.size)[:-1]]).astype(np.int64) if len(middles) else np.zeros(0, np.int64)
        self.first = first
        self.lcp = np.full(len(middles), -1, np.int64)  # with the word before; -1 at a list's start
        open_, d = np.flatnonzero(first < np.arange(len(middles))), 0
        while open_.size:
            same = (self.size[open_] > d) & (self.size[open_ - 1] > d)
            same &= self.letter(open_, d) == self.letter(open_ - 1, d)
            self.lcp[open_[~same]] = d
            open_, d = open_[same], d + 1

    def letter(self, words: np.ndarray, j: int) -> np.ndarray:
        """The letters at ``j``; 0 beyond a word's end."""
        inside = j < self.size[words]
        return np.where(inside, self.letters[np.where(inside, self.at[words] + j, 0)], 0)

    def share(self, a: np.ndarray, b: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Whether the first ``letters`` letters of the words a and b are equal."""
        out, open_, d = np.ones(len(a), bool), np.arange(len(a)), 0
        while open_.size:
            open_ = open_[letters[open_] > d]
            x, y = a[open_], b[open_]
            same = (self.size[x] > d) & (self.size[y] > d) & (self.letter(x, d) == self.letter(y, d))
            out[open_[~same]] = False
            open_, d = open_[same], d + 1
        return out

    def one_edit(self, query: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word of its list) exactly one edit apart; ``last``: end of each query's list.

        A state is a query, a range [low, high) of words that share their first d letters, and the
        cells (d - 1, d, d + 1) of the query's row d for these letters, counts beyond one as 2."""
        low, high = self.first[query], last
        left, mid, right = np.full(len(query), 2, np.int8), np.zeros(len(query), np.int8), np.where(self.size[query] > 0, 1, 2).astype(np.int8)
        reach = np.flatnonzero(np.isin(self.first, np.unique(low)))  # words longer than d
        found: list[tuple[np.ndarray, np.ndarray]] = []
        d = 0
        while query.size:
            done = np.flatnonzero(self.size[low] == d)  # the range's first word ends here
            over = self.size[query[done]] - d
            cost = np.select([over == -1, over == 0, over == 1], [left[done], mid[done], right[done]], 2)
            hit = done[cost == 1]
            found.append((query[hit], low[hit]))
            # the ranges of the next letter
            reach = reach[self.size[reach] > d]
            starts = reach[self.lcp[reach] <= d]
            a, b = np.searchsorted(starts, low), np.searchsorted(starts, high)
            n = b - a
            state = np.repeat(np.arange(len(query)), n)
            if not state.size:
                break
            child = np.arange(len(state)) - np.repeat(np.cumsum(n) - n, n) + a[state]
            ends = np.append(starts[1:], np.iinfo(np.int64).max)
            query, high, low = query[state], np.minimum(ends[child], high[state]), starts[child]
            letter = self.letters[self.at[low] + d]
            left, mid, right, size = left[state], mid[state], right[state], self.size[query]
            x = np.minimum(left + (letter != self.letter(query, d - 1)), mid + 1) if d else mid + 1
            x = np.where(d <= size, x, 2)
            y = np.where(d < size, np.minimum(np.minimum(mid + (letter != self.letter(query, d)), right + 1), x + 1), 2)
            z = np.where(d + 1 < size, np.minimum(right + (letter != self.letter(query, d + 1)), y + 1), 2)
            alive = np.minimum(np.minimum(x, y), z) <= 1
            query, low, high = query[alive], low[alive], high[alive]
            left, mid, right = (np.minimum(v[alive], 2).astype(np.int8) for v in (x, y, z))
            d += 1
        if not found:
            return query, low
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of whole lists: (word, near, near_n)."""
    key = table.column("key").combine_chunks()
    new = np.ones(len(key), bool)
    new[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    number = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    first, last = starts[number], np.append(starts[1:], len(key))[number]
    words = SortedList(table.column("mid").to_pylist(), first)
    shorter, below = table.column("m").to_numpy(), table.column("below").to_numpy()
    word, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
    ask = np.flatnonzero(last - first > 1)
    for k in range(0, len(ask), BLOCK_WORDS):
        q = ask[k : k + BLOCK_WORDS]
        a, b = words.one_edit(q, last[q])
        ok = np.minimum(words.size[a], words.size[b]) == shorter[a]
        ok[ok] = ~words.share(a[ok], b[ok], below[a[ok]])
        a, b = pa.array(a[ok]), pa.array(b[ok])
        yield pa.RecordBatch.from_arrays([word.take(a), word.take(b), n.take(b)], names=["word", "near", "near_n"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_WORDS:
            table = pa.Table.from_batches(held)
            key = table.column("key")
            # the lists before the last one are whole
            cut = pc.index(key, key[-1]).as_py()
            if cut:
                yield from _compare(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                rows = table.num_rows - cut
    if held:
        yield from _compare(pa.Table.from_batches(held))


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, list_words: int = LIST_WORDS) -> DataFrame:
    """(word, near, near_n) for each ordered pair of distinct ``words`` (word, n) one edit apart,
    each pair once.  Words are of letters up to U+00FF and of ``min_length`` or more."""
    key = F.concat_ws("\1", "head", "tail", F.col("m").cast("string"), F.col("below").cast("string"))
    lists = _lists(words, min_length, list_words).select(key.alias("key"), "mid", "m", "below", "word", "n")
    dealt = lists.repartition(partitions(words.sparkSession), "key").sortWithinPartitions("key", "mid")
    return dealt.mapInArrow(_scan, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last.  A form is ``RATIO`` times as frequent as its
    word, so chains are short and have no rings; each turn doubles what is followed."""
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = staged(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, list_words: int = LIST_WORDS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Null and empty texts have no words; a null id counts as an empty one.  Repeated rows count
    each.  Of equally frequent near words the form is the first in code-point order; form and
    form_n are null without one.  No words, no rows.  Other columns are ignored.
    """
    words = staged(vocabulary(docs, id_col, text_col, min_length, min_count), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("down"), "near"))
    near = near_words(words, min_length, list_words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.down") >= ratio * F.col("n")
    found = staged(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.down")).alias("form_n"),
        ),
        "found",
    )
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
