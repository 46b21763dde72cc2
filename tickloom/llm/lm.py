"""LM scoring by a hashed maximum-entropy model.

A word is a path down a tree of classes: its class, its slot in the class, and, unless that is the end of a text or one of the most
frequent words, the slot of words with one ending, from where digits of the word's hash lead on.  The tree is as deep as the counted
vocabulary asks (``depth_for``).  Each step is a softmax over sums of feature rows: the branches' own frequency, the word before,
the word before that (a skip), and for the class both (a trigram).  For the class and below the buckets the word before counts
with its full path, elsewhere with its slot.  The number of hashed rows grows with the counted tokens (``rows_for``).  Within a leaf words have add-one probabilities from exact counts, one more for any
unseen word, so that all probabilities sum to one.

Training uses every document that is not held out.  In each round the partitions run AdaGrad over their share of the documents,
from the model of the round before; their changes, weighted by how often a row was used, are averaged by Spark (iterative
parameter mixing).  Counts of the most frequent words are broadcast (bounded); all rarer words are
looked up by a join, which has no hot keys because the frequent words are not in it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import partitions, text_of
from tickloom.session import written

#: Branches of a class, of a slot and of each step below it.
CLASSES, SLOTS, BRANCHES = 32, 32, 32
#: Symbols: 0 is the end, then the FREQUENT words, then the buckets of endings, under which the tree goes on.
BUCKETS = 256
FREQUENT = CLASSES * SLOTS - BUCKETS - 1
#: Words whose counts are broadcast, at most; words counted at a time by one worker.
HEAD, COUNTED = 1 << 17, 300_000
#: Different words of a leaf on average, at most; levels below the buckets, at most (8 million leaves, 32 MB).
LEAF_WORDS, MOST_LEVELS = 4096, 3
#: Hashed rows of a table, at least and at most (32 MB, reached at 17 thousand million tokens).
LEAST_ROWS, MOST_ROWS = 1 << 14, 1 << 18
#: Rows of one table row-block as it travels; tokens of a step; passes over shares of the documents.
ROW_BLOCK, STEP, ROUNDS = 16, 8192, 2
RATE = 0.25
#: Bound of a sum of feature rows; rows of a run that are added one after the other.
LIMIT, SHORT = 60, 4


def depth_for(distinct: int) -> int:
    """Levels below the buckets: one, and more until a leaf holds LEAF_WORDS different words or fewer."""
    depth = 1
    while depth < MOST_LEVELS and distinct > BUCKETS * BRANCHES**depth * LEAF_WORDS:
        depth += 1
    return depth


def rows_for(tokens: int) -> int:
    """Hashed rows of each table: as the root of the tokens, since every learner sends its rows."""
    return int(min(max(2 * tokens**0.5, LEAST_ROWS), MOST_ROWS))


def held_out(id_col: str = "doc_id") -> Column:
    """Documents kept from training: crc32 of the id as text leaves 2 by 7.  A null id trains."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def leaf_of(word: bytes, leaves: int) -> int:
    """The word's leaf if it is not frequent; a bucket has ``leaves`` of them."""
    return zlib.crc32(word[-2:]) % BUCKETS * leaves + zlib.crc32(word) % leaves


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column("text"):
            counts.update(words_of(text.as_py()))
            if len(counts) > COUNTED:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


@dataclass
class Counts:
    """``table`` (word, n) of all training words, and what fits the driver: totals, and the words counted ``least`` times or more."""

    table: DataFrame
    documents: int
    tokens: int
    distinct: int
    least: int
    head: list[bytes]
    head_counts: np.ndarray
    depth: int
    leaf_base: np.ndarray  # of each leaf: training words, distinct ones, and one; the frequent words are not in it

    @property
    def leaves(self) -> int:
        return BRANCHES**self.depth

    @property
    def denominator(self) -> int:
        return self.tokens + self.distinct + 1


def count_words(training: DataFrame) -> Counts:
    table = written(training.select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    documents = training.count()
    total, distinct = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    rarest = 1 << 20
    by_count = {r["c"]: r["k"] for r in table.groupBy(F.least("n", F.lit(rarest)).alias("c")).agg(F.count("*").alias("k")).collect()}  # rarest rows at most
    least, held = rarest, 0
    for c in sorted(by_count, reverse=True):
        if (held := held + by_count[c]) > HEAD:
            break
        least = c
    head = table.filter(F.col("n") >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")]) if held else None  # HEAD rows at most
    words = head.column("word").to_pylist() if head is not None else []
    head_counts = head.column("n").to_numpy().astype(np.int64) if head is not None else np.empty(0, np.int64)
    depth = depth_for(distinct)
    leaves = BRANCHES**depth
    base = np.ones(BUCKETS * leaves)
    leaf = F.crc32(F.substring("word", -2, 2)) % BUCKETS * leaves + F.crc32("word") % leaves
    masses = table.groupBy(leaf.cast("long").alias("leaf")).agg((F.sum("n") + F.count("*")).alias("n")).toArrow()  # a row per leaf
    base[masses.column("leaf").to_numpy()] += masses.column("n").to_numpy()
    for word, n in zip(words[:FREQUENT], head_counts):
        base[leaf_of(word, leaves)] -= n + 1
    return Counts(table, documents, total + documents, distinct + (documents > 0), least, words, head_counts, depth, base)


def _encoder(counts: Counts):
    """Picklable parts of the counts, and the function that encodes documents with them."""
    spark = counts.table.sparkSession
    shared = spark.sparkContext.broadcast((b" ".join(counts.head), counts.head_counts, counts.leaf_base))  # HEAD words and the leaves
    end_logs, leaves = float(np.log10(counts.documents + 1)), counts.leaves
    under = (FREQUENT + 1) * leaves  # the first code below the buckets

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined, head_counts, leaf_base = shared.value
        head = joined.split(b" ") if joined else []
        known = {w: i for i, w in enumerate(head)}
        code = np.array([(i + 1) * leaves if i < FREQUENT else under + leaf_of(w, leaves) for i, w in enumerate(head)], dtype=np.int32)
        logs, base_logs = np.log10(head_counts + 1.0), np.log10(leaf_base)
        for batch in batches:
            held, names = [batch.column(c) for c in ("row", "doc_id", "held_out")], ["row", "doc_id", "held_out"]
            ids, rare, sums, in_leaf, known_n = [], [], [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                at = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
                out = at < 0
                tail = [words[i] for i in np.flatnonzero(out)]
                codes = np.zeros(len(words) + 1, dtype=np.int32)
                found = at[~out]
                codes[:-1][~out] = code[found]
                codes[:-1][out] = [under + leaf_of(w, leaves) for w in tail]
                ids.append(codes)
                rare.append(tail)
                sums.append(float(logs[found].sum()) + end_logs)
                in_leaf.append(float(logs[found[found >= FREQUENT]].sum() - base_logs[codes[codes >= under] - under].sum()))
                known_n.append(len(found) + (end_logs > 0))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [*held, pa.array(np.diff(offsets).astype(np.int64)), pa.array(known_n, pa.int64()), pa.array(sums, pa.float64()),
                 pa.array(in_leaf, pa.float64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(rare, pa.list_(pa.binary()))],
                names=[*names, "n_tokens", "n_head", "head_logs", "leaf_logs", "codes", "rare"],
            )

    return encode


ENCODED = ("row long, doc_id long, held_out boolean, n_tokens long, n_head long, head_logs double, leaf_logs double, "
           "codes array<int>, rare array<binary>")


def _hash(kind: int, a: np.ndarray, b: np.ndarray | int, rows: int) -> np.ndarray:
    x = (a.astype(np.uint32) * np.uint32(0x9E3779B1)) ^ (np.asarray(b).astype(np.uint32) * np.uint32(0x85EBCA77)) ^ np.uint32(kind * 0x27D4EB2F & 0xFFFFFFFF)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (((x ^ (x >> np.uint32(13))) * np.uint32(0x297A2D39)) >> np.uint32(7)).astype(np.int64) % rows


class Model:
    """Weights of the feature rows: tables of the classes', the slots' and the deeper branches' rows.

    The first ``rows`` rows of a table are hashed; behind them stand those of the branches' own frequencies.
    """

    def __init__(self, tables: list[np.ndarray], depth: int, rows: int):
        self.tables, self.depth, self.rows = tables, depth, rows

    @classmethod
    def from_counts(cls, counts: Counts) -> Model:
        """Own rows are the logarithms of shares: before training the model is the unigram one."""
        n = np.zeros(CLASSES * SLOTS)
        n[0] = counts.documents
        top = counts.head_counts[:FREQUENT]
        n[1:len(top) + 1] = top
        n[FREQUENT + 1:] = counts.leaf_base.reshape(BUCKETS, -1).sum(axis=1)
        n = n.reshape(CLASSES, SLOTS) + 1.0
        below = [counts.leaf_base.reshape(BUCKETS * BRANCHES**d, BRANCHES, -1).sum(axis=2) for d in range(counts.depth)]
        rows = rows_for(counts.tokens)
        return cls([np.concatenate([np.zeros((rows, own.shape[1])), np.log(own / own.sum(axis=1, keepdims=True))]).astype(np.float32) for own in (n.sum(axis=1)[None], n, np.concatenate(below))],
                   counts.depth, rows)

    def steps(self, codes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray | slice, np.ndarray, np.ndarray]]:
        """Table, places, feature rows and wanted branches of each step down the tree, for consecutive texts ended by code 0 each;
        ``first``: places where a text begins."""
        leaves = BRANCHES**self.depth
        before, skipped = np.zeros_like(codes), np.zeros_like(codes)
        before[1:], skipped[2:] = codes[:-1], codes[:-2]
        skipped[first] = 0
        symbols, old = codes // leaves, skipped // leaves
        group = symbols // SLOTS
        yield 0, slice(None), np.stack([np.full(len(codes), self.rows), self._hash(1, before, 0), self._hash(2, old, 0), self._hash(3, before // leaves, old)]), group
        yield 1, slice(None), np.stack([self.rows + group.astype(np.int64), self._hash(4, before // leaves, group), self._hash(5, old, group)]), symbols % SLOTS
        deep = np.flatnonzero(symbols > FREQUENT)
        inner, before, own = codes[deep] - (FREQUENT + 1) * leaves, before[deep], self.rows
        for d in range(self.depth):
            node, branch = np.divmod(inner // BRANCHES**(self.depth - 1 - d), BRANCHES)
            yield 2, deep, np.stack([own + node.astype(np.int64), self._hash(6 + d, before, node)]), branch
            own += BUCKETS * BRANCHES**d

    def _hash(self, kind: int, a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
        return _hash(kind, a, b, self.rows)

    @staticmethod
    def _sums(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Sums of the feature rows, held within what exponentials of 32 bits can take."""
        x = table.take(rows[0], axis=0)
        for r in rows[1:]:
            x += table.take(r, axis=0)
        return np.clip(x, -LIMIT, LIMIT, out=x)

    def log_probabilities(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Natural logarithms, one for each code."""
        out = np.zeros(len(codes))
        for table, places, rows, wanted in self.steps(codes, first):
            found = np.empty(len(wanted))
            for low in range(0, len(wanted), STEP):
                part = slice(low, low + STEP)
                x = self._sums(self.tables[table], rows[:, part])
                found[part] = np.take_along_axis(x, wanted[part, None], axis=1)[:, 0]
                found[part] -= np.log(np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype))
            out[places] += found
        return out

    def learn(self, codes: np.ndarray, first: np.ndarray, state: list[np.ndarray], used: list[np.ndarray]) -> None:
        """AdaGrad steps; ``state`` holds each row's sum of squares, ``used`` how often it was used."""
        for table, _, rows, wanted in self.steps(codes, first):
            for low in range(0, len(wanted), STEP):
                part = slice(low, low + STEP)
                self._step(self.tables[table], rows[:, part], wanted[part], state[table], used[table])

    def _step(self, table: np.ndarray, rows: np.ndarray, wanted: np.ndarray, squares: np.ndarray, count: np.ndarray) -> None:
        gradient = self._sums(table, rows)
        np.exp(gradient, out=gradient)
        gradient /= gradient @ np.ones((table.shape[1], 1), table.dtype)
        gradient[np.arange(len(wanted)), wanted] -= 1
        for feature in rows[1:]:  # the branches' own frequencies stay as counted
            order = _order(feature)
            ordered = feature.take(order)
            begins = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
            touched = ordered[begins]
            times = np.diff(np.append(begins, len(ordered)))
            total = _totals(gradient.take(order, axis=0), begins, times)
            seen = squares.take(touched) + np.einsum("ij,ij->i", total, total) / total.shape[1]
            squares[touched] = seen
            total *= (RATE / np.sqrt(seen + 1e-6))[:, None]
            table[touched] -= total
            count[touched] += times


def _totals(rows: np.ndarray, begins: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows; most runs are short, and these are added place by place."""
    total = rows.take(begins, axis=0)
    for place in range(1, SHORT):
        longer = np.flatnonzero((times > place) & (times <= SHORT))
        total[longer] += rows.take(begins[longer] + place, axis=0)
    longer = np.flatnonzero(times > SHORT)
    if len(longer):
        inside = rows[np.repeat(times > SHORT, times)]
        total[longer] = np.add.reduceat(inside, np.cumsum(times[longer]) - times[longer], axis=0)
    return total


def _order(rows: np.ndarray) -> np.ndarray:
    """Sorts by 16 bits at a time, which numpy does by radix."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    if rows.size and rows.max() >= 1 << 16:
        order = order[np.argsort((rows[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def _flat(batch: pa.RecordBatch, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of rows low to high, and where each text begins."""
    column = batch.column("codes").slice(low, high - low)
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.int32), (offsets[:-1] - offsets[0]).astype(np.int64)


def _parts(batch: pa.RecordBatch, at_most: int = 16 * STEP) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about that many codes; a longer text stands alone."""
    offsets, low = batch.column("codes").offsets.to_numpy(), 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + at_most, "right")) - 1)
        yield low, high
        low = high


def _block_rows(table: int, change: np.ndarray, used: np.ndarray) -> pa.RecordBatch:
    pad = -len(used) % ROW_BLOCK
    used = np.pad(used, (0, pad)).astype(np.float32).reshape(-1, ROW_BLOCK)
    change = np.pad(change, ((0, pad), (0, 0))).astype(np.float16).reshape(len(used), -1)
    touched = np.flatnonzero(used.any(axis=1))
    return pa.RecordBatch.from_arrays([
        pa.array(touched * 3 + table, pa.int64()), pa.array([used[i].tobytes() for i in touched], pa.binary()), pa.array([change[i].tobytes() for i in touched], pa.binary()),
    ], names=["block", "used", "change"])


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted sums by block: no more than the model's own size, however many partitions have sent changes."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for block, used, change in zip(batch.column("block").to_pylist(), batch.column("used"), batch.column("change"), strict=True):
            n = np.frombuffer(used.as_py(), np.float32).astype(np.float64)
            weighted = np.frombuffer(change.as_py(), np.float16).astype(np.float64).reshape(ROW_BLOCK, -1) * n[:, None]
            if block in sums:
                sums[block][0].__iadd__(n)
                sums[block][1].__iadd__(weighted)
            else:
                sums[block] = (n, weighted)
    means = [(w / np.maximum(n, 1)[:, None]).astype(np.float32).tobytes() for n, w in sums.values()]
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(means, pa.binary())], names=["block", "mean"])


def train(encoded: DataFrame, counts: Counts, rounds: int = ROUNDS) -> Model:
    """A model from all documents of ``encoded`` that are not held out; each takes part in one round."""
    spark: SparkSession = encoded.sparkSession
    model = Model.from_counts(counts)
    training = encoded.filter("not held_out").select("row", "codes")
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(model)  # MOST_ROWS hashed rows a table, and those of the leaves

        def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            before = shared.value
            local = Model([t.copy() for t in before.tables], before.depth, before.rows)
            state, used = ([np.zeros(len(t)) for t in before.tables] for _ in range(2))
            for batch in batches:
                for low, high in _parts(batch):
                    local.learn(*_flat(batch, low, high), state, used)
            for i, (new, old) in enumerate(zip(local.tables, before.tables, strict=True)):
                yield _block_rows(i, new[:before.rows] - old[:before.rows], used[i][:before.rows])

        changes = training.filter(F.pmod("row", F.lit(rounds)) == r).select("codes").mapInArrow(learn, "block long, used binary, change binary")
        means = changes.repartition(partitions(spark), "block").mapInArrow(_sum_blocks, "block long, mean binary").collect()  # the model's size
        tables = [t.copy() for t in model.tables]
        for row in means:
            table, low = tables[row["block"] % 3][:model.rows], row["block"] // 3 * ROW_BLOCK
            mean = np.frombuffer(bytes(row["mean"]), np.float32).reshape(ROW_BLOCK, -1)
            table[low:low + ROW_BLOCK] += mean[: len(table) - low]
        model = Model(tables, model.depth, model.rows)
    return model


def score_texts(docs: DataFrame, holdout: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per document.

    A text's tokens are its words, A-Z lower-cased, and one end.  A null text counts as empty: its end alone is scored.  Rows
    that repeat an id are scored each.  An empty table gives no rows; without training documents every word is unseen.
    """
    out = held_out(id_col) if holdout is None else holdout
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), out.alias("held_out"))
    counts = count_words(slim.filter("not held_out"))
    numbered = slim.withColumn("row", F.monotonically_increasing_id())
    encoded = written(numbered.mapInArrow(_encoder(counts), ENCODED), "lm-encoded")
    model = train(encoded, counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as above

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in batches:
            sums = []
            for low, high in _parts(batch):
                codes, first = _flat(batch, low, high)
                sums.append(np.add.reduceat(scorer.log_probabilities(codes, first), first) / np.log(10))
            kept = ["row", "doc_id", "held_out", "n_tokens", "n_head", "head_logs", "leaf_logs"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(np.concatenate([np.empty(0), *sums]))], names=[*kept, "path_logs"])

    scored = encoded.drop("rare").mapInArrow(score, "row long, doc_id long, held_out boolean, n_tokens long, n_head long, head_logs double, leaf_logs double, path_logs double")
    rare = encoded.select("row", F.explode("rare").alias("word")).join(counts.table.filter(F.col("n") < counts.least), "word", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare_logs"), F.count("n").alias("n_rare"))
    joined = scored.join(rare, "row", "left")
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    return joined.select(
        F.col("doc_id").alias("id"), "held_out", "n_tokens", (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("head_logs") + rare_logs - F.col("n_tokens") * float(np.log10(counts.denominator))).alias("base_score"),
        (F.col("path_logs") + F.col("leaf_logs") + rare_logs).alias("score"),
    )
