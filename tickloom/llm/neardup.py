"""MinHash near-duplicates with odd sketches.

1. Shingles are hashed in the JVM; per text SAMPLES MinHash samples are drawn in numpy.  The samples form bands, and
   they are folded into a parity bitmap (the odd sketch).  A second bitmap folds the whole set.  The population count of two
   bitmaps' XOR grows with the difference, so both bound a pair's similarity from above, tightly where it is high.
2. Texts with equal sets are one class; only its first row goes on.
3. Texts that share a band are candidates.  Buckets are not expanded into pairs: each text is first held against a pivot of its
   buckets, then against the other pivots that its component does not contain yet; then, in buckets that still hold several
   components, blocks of bitmaps are compared inside tasks, and only pairs of different components that pass go on.
4. Every pair that passes the bitmaps is confirmed on the full sets.  Links give components.

A pair within one component needs no further test; all other pairs that share a band are tested, whatever the bucket's size.
At similarity 0.85 a pair shares no band of 6 rows with probability 7e-7, at 0.80 none of 5 rows with 6e-7; each bitmap rejects
it with about 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import lower_ascii, partitions, text_of, words
from tickloom.llm.components import components
from tickloom.session import written

SHINGLE, PERCENT = 5, 85
SAMPLES, BANDS = 180, 30
#: Percent and bands (a divisor of SAMPLES) for similarities of 0.80 and more.
LOOSE = {"percent": 80, "bands": 36}
#: Bits of the samples' and of the sets' parity bitmaps.
SAMPLE_BITS, SET_BITS = 1024, 2048
#: Standard deviations that a bitmap grants beyond the expected count.
MARGIN = 6
#: Shingles hashed at a time, and rows whose bitmaps are made at a time; rows of a block of one bucket.
AT_ONCE, ROWS, BLOCK = 1 << 18, 1024, 512

_random = np.random.default_rng(20240229)
FLIP = _random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
SPREAD = _random.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

SIGNATURE = "row long, doc_id long, text_hash long, n_shingles long, f1 long, f2 long, bands array<long>, sample_bits binary, set_bits binary"


def shingles(text: Column) -> Column:
    """Distinct hashes of the 5-word windows; of the whole sequence where there are fewer words; none without words."""

    def of(w: Column) -> Column:
        window = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(w) >= SHINGLE, F.array_distinct(window)).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<long>"))

    return F.element_at(F.transform(F.array(words(lower_ascii(text))), of), 1)


def _mix(x: np.ndarray, by: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(by)
    return x ^ (x >> np.uint64(29))


def _parity(rows: np.ndarray, bits: np.ndarray, n_rows: int, n_bits: int) -> np.ndarray:
    """Bitmaps whose bits tell whether an odd number of the values fell on them."""
    counts = np.bincount(rows * n_bits + bits, minlength=n_rows * n_bits).reshape(n_rows, n_bits)
    return np.packbits(counts & 1, axis=1)


def sign(values: np.ndarray, offsets: np.ndarray, n_bands: int = BANDS) -> tuple[np.ndarray, ...]:
    """Fingerprints, bands and bitmaps of consecutive non-empty sets of hashes."""
    rows = SAMPLES // n_bands
    n = len(offsets) - 1
    begins, lengths = offsets[:-1], np.diff(offsets)
    of_row = np.repeat(np.arange(n), lengths)
    once, twice = _mix(values, 0x9E3779B97F4A7C15), _mix(values, 0xC2B2AE3D27D4EB4F)
    f1, f2 = np.add.reduceat(once, begins), np.add.reduceat(twice, begins)
    set_bits = _parity(of_row, (twice >> np.uint64(40)).astype(np.int64) % SET_BITS, n, SET_BITS)
    narrow, samples = (once >> np.uint64(32)).astype(np.uint32), np.empty((n, SAMPLES), np.uint32)
    scratch = np.empty_like(narrow)
    for k in range(SAMPLES):
        np.bitwise_xor(narrow, FLIP[k], out=scratch)
        np.multiply(scratch, SPREAD[k], out=scratch)
        samples[:, k] = np.minimum.reduceat(scratch, begins)
    bands = np.full((n, n_bands), 1, np.uint64) + np.arange(n_bands, dtype=np.uint64)
    for r in range(rows):
        bands = _mix(bands * np.uint64(0xD6E8FEB86659FD93) ^ samples[:, r::rows], 0x9E3779B97F4A7C15)
    place = _mix(samples.astype(np.uint64) << np.uint64(8) | np.arange(SAMPLES, dtype=np.uint64), 0xC2B2AE3D27D4EB4F)
    sample_bits = _parity(np.repeat(np.arange(n), SAMPLES), (place >> np.uint64(40)).astype(np.int64).ravel() % SAMPLE_BITS, n, SAMPLE_BITS)
    return f1, f2, bands, sample_bits, set_bits


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    offsets = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(rows.tobytes())])


def sign_partition(batches: Iterator[pa.RecordBatch], n_bands: int) -> Iterator[pa.RecordBatch]:
    """Adds the signature to ``row, doc_id, text_hash, set``; sets of about AT_ONCE values at a time, and ROWS of them at most."""
    for batch in batches:
        offsets = batch.column("set").offsets.to_numpy()
        values = batch.column("set").values.to_numpy(zero_copy_only=False).view(np.uint64)
        low = 0
        while low < batch.num_rows:
            high = min(max(low + 1, int(np.searchsorted(offsets, offsets[low] + AT_ONCE, "right")) - 1), low + ROWS)
            at = offsets[low:high + 1]
            f1, f2, bands, sample_bits, set_bits = sign(values[at[0]:at[-1]], at - at[0], n_bands)
            part = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays([
                part.column("row"), part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(at).astype(np.int64)),
                pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                pa.ListArray.from_arrays(pa.array((np.arange(len(at)) * n_bands).astype(np.int32)), pa.array(bands.view(np.int64).ravel())),
                _binary(sample_bits), _binary(set_bits),
            ], names=["row", "doc_id", "text_hash", "n_shingles", "f1", "f2", "bands", "sample_bits", "set_bits"])
            low = high


def _odd_count(differences: np.ndarray, bits: int) -> np.ndarray:
    """Expected number of odd bits after so many flips, and MARGIN deviations more."""
    share = np.exp(-2.0 * differences / bits)
    return bits / 2 * (1 - share) + MARGIN * np.sqrt(bits / 4 * (1 - share * share)) + 1


def sample_limit(percent: int = PERCENT) -> float:
    """The odd count of the samples' bitmaps that a pair of that similarity exceeds only beyond MARGIN deviations."""
    j = percent / 100
    mean, deviation = 2 * SAMPLES * (1 - j), 2 * np.sqrt(SAMPLES * j * (1 - j))
    shrink = np.exp(-2.0 * mean / SAMPLE_BITS)
    occupied = SAMPLE_BITS / 2 * (1 - shrink)
    return occupied + MARGIN * np.hypot(deviation * shrink, np.sqrt(SAMPLE_BITS / 4 * (1 - shrink * shrink)))


def may_be_similar(n_a, n_b, xor_samples: np.ndarray, xor_sets: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Rows of XORed bitmaps (as 64-bit words): False only where the pair's similarity is below ``percent``."""
    most = np.floor((n_a + n_b) * (100 - percent) / (100 + percent))  # greatest symmetric difference
    limit = np.minimum(most, _odd_count(most, SET_BITS))
    sizes = np.minimum(n_a, n_b) * 100 >= np.maximum(n_a, n_b) * percent
    return sizes & (np.bitwise_count(xor_sets).sum(axis=1) <= limit) & (np.bitwise_count(xor_samples).sum(axis=1) <= sample_limit(percent))


def _words64(column: pa.Array, bits: int) -> np.ndarray:
    width = bits // 8
    data, start = np.frombuffer(column.buffers()[2], dtype=np.uint8), column.offset * width
    return data[start:start + len(column) * width].reshape(len(column), width).view(np.uint64)


def pass_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_a, n_b = b.column("n_a").to_numpy(), b.column("n_b").to_numpy()
        good = may_be_similar(
            n_a, n_b, _words64(b.column("samples_a"), SAMPLE_BITS) ^ _words64(b.column("samples_b"), SAMPLE_BITS),
            _words64(b.column("sets_a"), SET_BITS) ^ _words64(b.column("sets_b"), SET_BITS), percent,
        )
        yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(good)), b.column("b").filter(pa.array(good))], names=["a", "b"])


def _compare(block: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the left and right rows of one task that lie in different components and pass the bitmaps."""
    block = block.combine_chunks()
    column = {c: block.column(c).chunk(0) for c in block.column_names}
    left = column["left"].to_numpy(zero_copy_only=False)
    row, root, n = (column[c].to_numpy() for c in ("row", "root", "n_shingles"))
    samples, sets = _words64(column["sample_bits"], SAMPLE_BITS), _words64(column["set_bits"], SET_BITS)
    ls, rs = np.flatnonzero(left), np.flatnonzero(~left)
    a, b = [], []
    for i in ls:
        others = rs[root[rs] != root[i]]
        others = others[may_be_similar(n[others], n[i], samples[others] ^ samples[i], sets[others] ^ sets[i], percent)]
        a.append(np.full(len(others), row[i]))
        b.append(row[others])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def compare_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``task``; a task has at most some BLOCK left and right rows."""

    def pairs(block: pa.Table) -> Iterator[pa.RecordBatch]:
        a, b = _compare(block, percent)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    held: list[pa.Table] = []
    for batch in batches:
        task = batch.column("task").to_numpy()
        cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)] if len(task) else [0]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            part = pa.Table.from_batches([batch.slice(low, high - low)])
            if held and held[0].column("task")[0].as_py() != task[low]:
                yield from pairs(pa.concat_tables(held))
                held = []
            held.append(part)
    if held:
        yield from pairs(pa.concat_tables(held))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_bands: int = BANDS) -> DataFrame:
    """One row per document with words; ``row`` numbers them, so repeated ids stay apart."""
    text = text_of(text_col)
    sets = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), shingles(text).alias("set"))
    return written(sets.filter(F.size("set") > 0).mapInArrow(lambda batches: sign_partition(batches, n_bands), SIGNATURE), "neardup-signatures")


class Verifier:
    """Confirms pairs: first by their bitmaps, then on the full sets of the texts that share a band."""

    def __init__(self, docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, percent: int):
        self.percent = percent
        text = text_of(text_col)
        named = wanted.select("row", F.col("doc_id").alias("w_id"), "text_hash")
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("t"))
        found = named.join(texts, F.col("w_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
        self.sets = written(found.select("row", shingles(F.col("t")).alias("set")), "neardup-sets")
        self.bitmaps = wanted.select("row", "n_shingles", "sample_bits", "set_bits")

    def side(self, name: str) -> DataFrame:
        return self.bitmaps.select(
            F.col("row").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sample_bits").alias(f"samples_{name}"), F.col("set_bits").alias(f"sets_{name}"))

    def passing(self, pairs: DataFrame) -> DataFrame:
        percent = self.percent
        both = pairs.join(self.side("a"), "a").join(self.side("b"), "b")
        return written(both.mapInArrow(lambda batches: pass_pairs(batches, percent), "a long, b long"), "neardup-passed")

    def links(self, passed: DataFrame) -> DataFrame:
        one, other = (self.sets.select(F.col("row").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab")
        both = passed.join(one, "a").join(other, "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - common
        return written(both.filter(100 * common >= self.percent * union).select("a", "b").distinct(), "neardup-links")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _rooted(members: DataFrame, stars: DataFrame) -> DataFrame:
    """``members`` with ``root``, the component of ``row``."""
    return members.join(stars.select(F.col("a").alias("row"), F.col("b").alias("root")), "row", "left").withColumn("root", F.coalesce("root", "row"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, bands: int = BANDS) -> DataFrame:
    """``id, text_hash, n_shingles, component_id, kept``, one row per document.

    ``component_id`` is the smallest id reachable over pairs with 100 * intersection >= percent * union; the row that bears it is
    kept.  Texts without words, and null texts, link with nothing and are kept.  Rows that repeat an id are documents of their
    own; a null id in a component takes the component's id and goes, alone it stays.  An empty table gives no rows.
    ``bands`` of SAMPLES / bands rows each must suit the percentage: see LOOSE.
    """
    if SAMPLES % bands:
        raise ValueError(f"bands must divide {SAMPLES}")
    signed = signatures(docs, id_col, text_col, bands)
    classes = written(signed.groupBy("f1", "f2").agg(F.min("row").alias("first"), F.min("doc_id").alias("low")), "neardup-classes")
    firsts = signed.join(classes.select(F.col("first").alias("row")), "row", "left_semi")

    keyed = written(firsts.select("row", F.explode("bands").alias("band")), "neardup-bands")
    pivots = keyed.groupBy("band").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("row", "band").alias("h"), "row"))["row"].alias("pivot")).filter("size > 1")
    members = written(keyed.join(written(pivots, "neardup-pivots"), "band"), "neardup-members")
    wanted = written(firsts.join(members.select("row").distinct(), "row", "left_semi").drop("bands", "f1", "f2"), "neardup-wanted")
    verify = Verifier(docs, wanted, id_col, text_col, percent)

    beside = members.filter("row != pivot").groupBy("row", "pivot").agg(F.count("*").alias("shared"))
    beside = written(beside, "neardup-beside")
    best = beside.groupBy("row").agg(F.max(F.struct("shared", "pivot"))["pivot"].alias("pivot"))
    links = verify.links(verify.passing(best.select(*_pair("row", "pivot")).distinct()))
    stars = components(links)

    apart = _rooted(_rooted(beside.select("row", "pivot"), stars).select(F.col("row").alias("other"), F.col("root").alias("other_root"), F.col("pivot").alias("row")), stars)
    links = links.unionByName(verify.links(verify.passing(apart.filter("root != other_root").select(*_pair("row", "other")).distinct())))
    stars = components(links)

    links = links.unionByName(verify.links(_left_over(members, wanted, stars, percent)))
    stars = components(links)

    rooted = _rooted(classes.withColumnRenamed("first", "row"), stars)
    lows = written(rooted.filter("root is not null").groupBy("root").agg(F.min("low").alias("component_id")), "neardup-lows")
    of_class = written(rooted.join(lows, "root").select("f1", "f2", "component_id"), "neardup-components")
    labelled = written(
        signed.select("doc_id", "text_hash", "n_shingles", "f1", "f2").join(of_class, ["f1", "f2"]).select("doc_id", "text_hash", "n_shingles", "component_id"), "neardup-rows")
    text = text_of(text_col)
    bare = docs.filter(~text.rlike(r"[^\x20\x09-\x0D]")).select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.lit(0).cast("long").alias("n_shingles"), F.col(id_col).cast("long").alias("component_id"))
    return labelled.unionByName(bare).select(
        F.col("doc_id").alias("id"), "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _left_over(members: DataFrame, wanted: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """Pairs that pass the bitmaps, from buckets of more than two texts that still hold several components.

    In such a bucket the largest component's texts are held against the others, and the others against each other, block by
    block.  With few others the copies made grow with the bucket's size, not with its square.
    """
    rooted = written(_rooted(members.filter("size > 2").select("band", "row"), stars), "neardup-rooted")
    per = rooted.groupBy("band", "root").agg(F.count("*").alias("n"))
    mixed = written(per.groupBy("band").agg(
        F.count("*").alias("roots"), F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("size"),
    ).filter("roots > 1").select("band", F.col("main.root").alias("main"), F.col("main.n").alias("n_main"), (F.col("size") - F.col("main.n")).alias("n_other")), "neardup-mixed")

    def blocks(n: str) -> Column:
        return F.ceil(F.col(n) / BLOCK).cast("int")

    placed = rooted.join(mixed, "band").withColumn("is_main", F.col("root") == F.col("main"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("row"), F.when(F.col("is_main"), blocks("n_main")).otherwise(blocks("n_other"))).cast("int"))

    def tasks(left: bool, against_main: bool, i: Column, j: Column) -> Column:
        return F.struct(F.lit(left).alias("left"), F.xxhash64("band", F.lit(against_main), i, j).alias("task"))

    def upto(n: Column) -> Column:
        return F.sequence(F.lit(0), n - 1)

    block = F.col("block")
    for_main = F.transform(upto(blocks("n_other")), lambda i: tasks(False, True, i, block))
    for_other = F.concat(
        F.transform(upto(blocks("n_main")), lambda j: tasks(True, True, block, j)),
        F.transform(F.sequence(block, blocks("n_other") - 1), lambda j: tasks(True, False, block, j)),
        F.transform(F.sequence(F.lit(0), block), lambda i: tasks(False, False, i, block)),
    )
    dealt = placed.select("row", "root", F.explode(F.when(F.col("is_main"), for_main).otherwise(for_other)).alias("x")).select("row", "root", "x.left", "x.task")
    full = dealt.join(wanted.select("row", "n_shingles", "sample_bits", "set_bits"), "row")
    n = partitions(members.sparkSession)
    found = full.repartition(n, "task").sortWithinPartitions("task").mapInArrow(lambda batches: compare_blocks(batches, percent), "a long, b long")
    return written(found.distinct(), "neardup-left-over")
