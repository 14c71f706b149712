"""N-gram Jaccard self-join with rare-first prefixes.

Documents with equal shingle sets form a class; the join runs over classes.

1. *Frequencies.*  A scan writes, for each block of documents, the sorted hash keys of its
   shingles, delta-coded, split by key range.  A group per key range counts over all blocks
   and sends back to each block the keys that occur in two documents or more.
2. *Prefixes.*  Each document orders its shingles rare first (frequency, then hash, the same
   order everywhere).  Two sets within the threshold share one of the first
   n - ceil(t n) + 1; shingles that occur once cannot be shared and give no posting.
3. *Candidates.*  Postings meet on the shingle under the length filter, the positional
   filter, and the suffix filter: a lower bound of the sets' Hamming distance.  Shingles before
   the met one can only meet each other, so the distance is that of the parts before and after
   it; both are bounded at once by the bits that differ in the sets' parity sketches (a bit is
   the parity of the shingles hashed to it; each difference flips one).
4. *Verification*, once per pair, on whole texts.

A group of copies needs no all-pairs step: first every class meets only the smallest class of
each posting list (a star), and verified links form components.  Then, within a list, classes
of different components meet.  Pairs already in one component cannot change the result, so no
link between components is lost, and no list emits its pairs within a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from riskline.llm.common import drop_part, drop_staged, keyed, staged, text_or_empty, tidy
from riskline.llm.components import components

SHINGLE = 4
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Shingles of a block of documents, and keys of a key range: memory bounds of a task.
BLOCK_SHINGLES = 1_000_000
RANGE_KEYS = 2_000_000
#: Star rounds before all components of a list meet.
STARS = 2
#: Shingles before a met one among which an earlier meeting is looked for.
LOOK_BACK = 24
#: Words of 64 bits of the parity sketch that bounds the distance of two sets from below.
SKETCH = 4

_U = np.uint64
_MULT = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93)]


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word)
        return h


_HASH = _WordHash()


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def shingles(text: str, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word k-grams (A-Z lower-cased); fewer than
    k words: the whole sequence is one; no word: empty."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.array([_HASH[x] for x in words], np.uint64)
    n = max(1, len(w) - k + 1)
    h = np.full(n, len(w) if len(w) < k else k, np.uint64)
    for i in range(min(k, len(w))):
        h = (h ^ (h >> _U(31))) * _MULT[i % 4] + w[i : i + n]
    h = (h ^ (h >> _U(33))) * _MULT[0]
    return _distinct(np.sort(h ^ (h >> _U(29))))


def _plain(text: pa.Scalar) -> str:
    return zstandard.ZstdDecompressor().decompress(text.as_py()).decode("utf-8", "surrogatepass")


def _squeeze(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as deltas, a byte plane after the other, compressed."""
    delta = np.diff(values, prepend=_U(0))
    return zstandard.ZstdCompressor(level=1).compress(delta.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


_SCANNED = "kind int, doc_id long, n long, class binary, block long, text binary, shard int, keys binary, place int"


def _scan(bits: int, shards: int, words: int):
    """Document rows (kind 0) tagged with a block, and the block's keys by range (kind 1).

    A key is the top ``bits`` of a shingle's hash; keys only order shingles, so that two
    shingles of one key merely count as one."""
    schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("class", pa.binary()), ("block", pa.int64()), ("text", pa.binary()), ("shard", pa.int32()), ("keys", pa.binary()), ("place", pa.int32())])
    cuts = (np.arange(1, shards, dtype=object) * (1 << bits) // shards).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, keys, place = TaskContext.get().partitionId(), 0, 0, [], 0
        squeeze = zstandard.ZstdCompressor(level=3)

        def close() -> pa.RecordBatch:
            every = np.sort(np.concatenate(keys))
            at = [0, *np.searchsorted(every, cuts).tolist(), len(every)]
            rows = [{"kind": 1, "block": (part << 24) + block, "shard": s, "keys": _squeeze(every[a:b])} for s, (a, b) in enumerate(zip(at, at[1:])) if b > a]
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = text.as_py()
                h = shingles(s, words)
                rows.append({"kind": 0, "doc_id": doc_id, "n": len(h), "class": xxh3_128_digest(h.tobytes()) if len(h) else None, "block": (part << 24) + block, "text": squeeze.compress(s.encode("utf-8", "surrogatepass")) if len(h) else None, "place": place})
                place += 1
                if len(h):
                    keys.append(_distinct(h >> _U(64 - bits)))
                    held += len(h)
                if held >= BLOCK_SHINGLES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    yield close()
                    rows, keys, held, block, place = [], [], 0, block + 1, 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if keys:
            yield close()

    return run


def _frequent(table: pa.Table) -> pa.Table:
    """For one key range: the keys found in two documents or more, for each block that has
    them, with their frequencies."""
    blocks, lists = table.column("block").to_pylist(), [_unsqueeze(k.as_py()) for k in table.column("keys")]
    every, n = np.unique(np.concatenate(lists), return_counts=True)
    every, n = every[n > 1], n[n > 1].astype(np.uint32)
    out: tuple[list, list, list] = ([], [], [])
    for b, own in zip(blocks, lists):
        own = _distinct(own)
        at = np.searchsorted(every, own)
        hit = at < len(every)
        hit[hit] = every[at[hit]] == own[hit]
        if hit.any():
            out[0].append(b)
            out[1].append(_squeeze(own[hit]))
            out[2].append(zstandard.ZstdCompressor(level=1).compress(n[at[hit]].tobytes()))
    return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], names=["block", "keys", "freq"])


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _postings(bits: int, percent: int, words: int):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        if found.num_rows:
            keys = np.concatenate([_unsqueeze(k.as_py()) for k in found.column("keys")])
            freq = np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(f.as_py()), np.uint32) for f in found.column("freq")])
            order = np.argsort(keys)
            keys, freq = keys[order], freq[order]
        else:
            keys, freq = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        cols: tuple[list, ...] = tuple([] for _ in range(4 + SKETCH))
        seen = set()
        for cls, text in zip(docs.column("class"), docs.column("text")):
            cls = cls.as_py()
            if cls in seen:
                continue
            seen.add(cls)
            h = shingles(_plain(text), words)
            own = h >> _U(64 - bits)
            at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
            times = np.where(keys[at] == own, freq[at], 1) if len(keys) else np.ones(len(h), np.uint32)
            order = np.argsort(times, kind="stable")  # ties in order of hash
            n, p = len(h), prefix_length(len(h), percent)
            pre = order[:p]
            use = np.flatnonzero(times[pre] > 1)
            if not len(use):
                continue
            bits_on = np.bincount((h & _U(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
            sketch = np.packbits(bits_on.astype(np.uint8)).view("<i8")
            cols[0].append(h[pre[use]].view(np.int64))
            cols[1].extend([cls] * len(use))
            cols[2].append(np.full(len(use), n, np.int32))
            cols[3].append(use.astype(np.int32))
            for k in range(SKETCH):
                cols[4 + k].append(np.full(len(use), sketch[k]))
        kinds = [pa.int64(), None, pa.int32(), pa.int32(), *[pa.int64()] * (SKETCH)]
        arrays = [pa.array(c, pa.binary()) if t is None else pa.array(np.concatenate(c) if c else [], t) for c, t in zip(cols, kinds)]
        return pa.table(arrays, names=["gram", *_POSTING])

    return run


_POSTING = ["class", "n", "pos", *[f"bits{k}" for k in range(SKETCH)]]


def _filters(percent: int) -> str:
    """Length, positional and suffix filters on a pair of postings x, y of one shingle."""
    need = f"ceil({percent} * (x_n + y_n) / {100 + percent}D)"
    apart = f"(x_n + y_n - 2 * {need})"
    differ = " + ".join(f"bit_count(x_bits{k} ^ y_bits{k})" for k in range(SKETCH))
    # at the pair's first common shingle all before it differ; it is enough to meet there
    return (
        f"100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n)"
        f" and least(x_n - x_pos, y_n - y_pos) >= {need} and x_pos + y_pos <= {apart} and {differ} <= {apart}"
    )


def _verify(percent: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, None
        for batch in batches:
            good = []
            for a, s, t in zip(batch.column("a"), batch.column("s"), batch.column("t")):
                if a.as_py() != last:
                    last, x = a.as_py(), shingles(_plain(s), words)
                y = shingles(_plain(t), words)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _links(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs (a, b) of classes that are within the threshold, each compared once."""
    got = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("s")), "a").join(
        texts.select(F.col("class").alias("b"), F.col("text").alias("t")), "b"
    )
    return staged(got.select("a", "b", "s", "t").mapInArrow(_verify(percent, words), "a binary, b binary"), "links")


def _class_components(scanned: DataFrame, bits: int, shards: int, percent: int, words: int) -> DataFrame:
    """(class, root) for the classes with a link to another one."""
    docs = scanned.where("kind = 0 and n > 0")
    found = staged(scanned.where("kind = 1").groupBy("shard").applyInArrow(_frequent, "block long, keys binary, freq binary"), "found")
    drop_part(scanned, "kind=1")
    tidy(scanned.sparkSession)
    postings = staged(
        docs.select("block", "class", "text").groupBy("block").cogroup(found.groupBy("block"))
        .applyInArrow(_postings(bits, percent, words), "gram long, class binary, n int, pos int, " + ", ".join(f"bits{k} long" for k in range(SKETCH))).distinct(),
        "postings",
    )
    drop_staged(found)
    tidy(scanned.sparkSession)
    # the text of one document of each class that has postings; copies are told apart by block
    # and place in it, so that only one of them is shipped, once
    some = docs.select("class", "block", "place").join(postings.select("class").distinct(), "class", "left_semi")
    some = some.groupBy("class").agg(F.min(F.struct("block", "place")).alias("m")).select("m.block", "m.place")
    texts = staged(docs.select("class", "text", "block", "place").join(some, ["block", "place"]).select("class", "text"), "texts")
    tidy(scanned.sparkSession)
    test = F.expr(_filters(percent))
    past: list[DataFrame] = []
    labels = postings.select("class", F.col("class").alias("root")).distinct()
    links = None
    for turn in range(STARS + 1):
        members = postings.join(labels, "class")
        if turn:
            # only lists whose classes are not all in one component yet
            open_lists = members.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
            members = staged(members.join(open_lists.select("gram", "lo"), "gram"), "members")
        if turn < STARS:
            # first the class with the fewest rarer shingles, which is likest to the others
            pick = F.min_by(F.struct(*_POSTING, "root"), F.struct(F.col("pos") if turn == 0 else F.lit(0), F.xxhash64("class", F.lit(turn))))
            hub = members.groupBy("gram").agg(pick.alias("h")).select("gram", *[F.col(f"h.{c}").alias(f"y_{c}") for c in (*_POSTING, "root")])
            pairs = _side(members, "x").join(hub, "gram").where("x_root <> y_root")
        else:
            # The filters are part of the join, so that a pair they reject is never a row; nor is
            # one whose classes have met at one of the shingles just before.
            back = Window.partitionBy("class").orderBy("pos").rowsBetween(-LOOK_BACK, -1)
            told = members.withColumn("before", F.collect_list("gram").over(back))
            pairs = _side(told, "x", "before").join(_side(told, "y", "before"), "gram").where("x_root < y_root").where(test).where("not arrays_overlap(x_before, y_before)")
        pairs = pairs.where(test).select(F.least("x_class", "y_class").alias("a"), F.greatest("x_class", "y_class").alias("b")).where("a <> b").distinct()
        new = _links(pairs, texts, percent, words)
        links = new if links is None else links.union(new)
        found_components = components(links)
        labels = staged(
            postings.select("class").distinct().join(found_components.select(F.col("node").alias("class"), "component"), "class", "left")
            .select("class", F.coalesce("component", "class").alias("root")),
            "labels",
        )
        # what the turn has read and no later one does
        past += [found_components, *([members] if turn else [])]
        for table in past:
            drop_staged(table)
        past = [labels]
        tidy(scanned.sparkSession)
    for table in (links, texts, postings):
        drop_staged(table)
    return labels


def _side(members: DataFrame, side: str, *more: str) -> DataFrame:
    return members.select("gram", *[F.col(c).alias(f"{side}_{c}") for c in (*_POSTING, "root", *more)])


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, words: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class, root (of the class's component).

    Null and blank texts have no shingles, class and root null.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    guess = size // 4 + 1  # shingles, roughly; only sizes ranges and keys
    bits = max(32, min(64, guess.bit_length() + 9))
    shards = max(1, guess // RANGE_KEYS)
    scanned = staged(rows.mapInArrow(_scan(bits, shards, words), _SCANNED), "scanned", by="kind")
    roots = _class_components(scanned, bits, shards, percent, words)
    plain = scanned.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "class")
    return plain.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))


def linked_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, words: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_copies.

    ``component_id`` is the smallest doc_id reachable over links, its own included; a document
    without shingles is its own component.  ``n_copies`` counts the rows of equal shingle set.
    Null ids are ignored in that minimum (null if there is no other).  Repeated rows are
    copies of each other.  Other columns are ignored.
    """
    found = jaccard_classes(docs, id_col, text_col, percent, words)
    rows = staged(found, "rows")
    drop_staged(found, keep=docs)
    least = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    copies = rows.where("class is not null").groupBy("class").agg(F.count("*").alias("n_copies"))
    return rows.join(least, "root", "left").join(copies, "class", "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, words: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component of links: the one of smallest id (null last).

    Rows without shingles stay.  The rows are written once with their key."""
    rows = keyed(docs)
    ids = rows.select(F.col("row")[id_col].alias("id"), "row_key")
    found = jaccard_classes(rows.select("row_key", F.col("row")[text_col].alias("text")), "row_key", "text", percent, words)
    # only components of two rows or more can lose rows
    found = found.where("root is not null").select("root", F.col("doc_id").alias("row_key"))
    large = found.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    members = staged(found.join(large, "root").join(ids, "row_key"), "members")
    drop_staged(found, keep=rows)
    tidy(docs.sparkSession)
    order = F.struct(F.col("id").isNull().alias("z"), "id", "row_key")
    stays = members.groupBy("root").agg(F.min(order)["row_key"].alias("stays"))
    gone = members.join(stays, "root").where("row_key <> stays").select("row_key")
    return rows.join(gone, "row_key", "left_anti").select("row.*")
