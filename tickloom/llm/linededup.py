"""Line dedup by deletion neighbourhoods: lines within one word's edit of an earlier line go.

A line's variants are its words with any one left out, each keyed by the place and a hash; the line itself stands under every
place at which a longer line may have one more word.  All lines under one key differ from one another by one word at that
place, so the earliest of a key is found by an aggregate, without pairs; the edit distance to it is then verified on the words.

Variants are many, so only lines that can have a neighbour emit them, and only at the places where it can differ: one edited
word leaves the first or the second half of the shorter line as it was, hence lines that share neither half with another line
are out, and lines that share one half emit the places of the other.  Only the first occurrence of a line is fetched again.
Rows are picked through bitmaps of bounded size, which only save shuffling: what they let through is joined exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, let, partitions, text_of
from tickloom.session import written

#: Lines with fewer words are never dropped (headings, braces); from NEAR words on one word may differ.
EXACT, NEAR = 3, 8
#: log2 of the bits of a bitmap that is broadcast, at least and at most (32 MB).
LEAST_BITS, MOST_BITS = 23, 28


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text_hash, no, w, m, wh, h1`` of every line with EXACT words or more; ``wh``: a hash per word."""
    text = text_of(text_col)
    cut = F.filter(F.transform(F.split(flat_lines(text), "\n"), lambda line, no: F.struct(no.alias("no"), _words(line).alias("w"))), lambda x: F.size(x["w"]) >= EXACT)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.explode(cut).alias("x")).select("id", "text_hash", "x.no", "x.w")
    return rows.select("*", F.size("w").alias("m"), _hashes(F.col("w")).alias("wh")).withColumn("h1", F.xxhash64("wh"))


def _said(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text_hash, no, said`` of every line, not yet cut into words."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(flat_lines(text), "\n")).alias("no", "said"))


def flat_lines(text: Column) -> Column:
    """Every blank but the line end as a space."""
    for blank in "\t\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return text


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _second(wh: Column) -> Column:
    """The other half of a line's 128-bit key."""
    return F.xxhash64(F.lit("2"), wh)


def _halves(wh: Column, m: Column) -> Column:
    """Hashes of the first and second half, as the shorter line and as the longer one of a pair."""

    def of(length: Column) -> list[Column]:
        h = F.floor(length / 2).cast("int")
        return [F.xxhash64(F.lit("first"), length, F.slice(wh, F.lit(1), h)), F.xxhash64(F.lit("second"), length, F.slice(wh, m - (length - h) + 1, length - h))]

    return F.when(m >= NEAR, F.array(*of(m), *of(m - 1)))


class Bitmap:
    """The hashes of a written table as bits: rows without a set bit cannot have a partner there."""

    def __init__(self, table: DataFrame, column: str):
        self.bits = 1 << min(max((8 * table.count()).bit_length(), LEAST_BITS), MOST_BITS)
        marks = table.select(self._bit(F.col(column)).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("mark_bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))
        self.marks = F.broadcast(marks)

    def _bit(self, h: Column) -> Column:
        return F.pmod(h, F.lit(self.bits))

    def passing(self, rows: DataFrame, column: str) -> DataFrame:
        """Rows whose bit is set."""
        bit = self._bit(F.col(column))
        place = F.bitmap_bit_position(bit)
        byte = F.conv(F.hex(F.expr("bitmap").substr((F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_set = F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int")).bitwiseAND(1) == 1
        return rows.withColumn("mark_bucket", F.bitmap_bucket_number(bit)).join(self.marks, "mark_bucket").filter(is_set).drop("mark_bucket", "bitmap")


#: What a line shares with another, as bits (of the first half, of the second): a half with one of its own length, as the shorter
#: line a half with a longer one, as the longer line a half with a shorter one.
EQUAL, SHORTER, LONGER = (1, 2), (4, 8), (16, 32)


def _shares(role: Column, n_own: Column, n_longer: Column) -> Column:
    """Bits of one half; ``role`` is its place in ``_halves``, ``n_own`` and ``n_longer`` count the lines that bear it as the shorter and the longer one."""

    def side(bits: tuple[int, int]) -> Column:
        return F.when(role % 2 == 0, bits[0]).otherwise(bits[1])

    own = F.when(n_own > 1, side(EQUAL)).otherwise(0) + F.when(n_longer > 0, side(SHORTER)).otherwise(0)
    return F.when(role < 2, own).otherwise(side(LONGER))


def _neighbourhood(wh: Column, m: Column, shares: Column) -> Column:
    """A key for each word left out, and for each place at which a word may be missing, where the shared halves allow it."""
    half, half_less = F.floor(m / 2), F.floor((m - 1) / 2)

    def has(bit: int) -> Column:
        return shares.bitwiseAND(bit) != 0

    def differs(i: Column) -> Column:
        equal = (has(EQUAL[0]) & (i >= half)) | (has(EQUAL[1]) & (i < half))
        return equal | (has(LONGER[0]) & (i >= half_less)) | (has(LONGER[1]) & (i <= half_less))

    def misses(i: Column) -> Column:
        return (has(SHORTER[0]) & (i >= half)) | (has(SHORTER[1]) & (i <= half))

    places = F.filter(F.sequence(F.lit(0), m - 1), differs)
    out = F.transform(places, lambda i: F.xxhash64(i, m - 1, F.xxhash64(F.concat(F.slice(wh, F.lit(1), i), F.slice(wh, i + 2, m)))))
    gaps = F.filter(F.sequence(F.lit(0), m), misses)
    return F.concat(out, let(F.xxhash64(wh), lambda h: F.transform(gaps, lambda i: F.xxhash64(i, m, h))))


def _one_word_apart(a: Column, b: Column) -> Column:
    """Common begin and common end cover all but one word of the longer line."""

    def common(x: Column, y: Column) -> Column:
        unequal = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(unequal == 0, F.least(F.size(x), F.size(y))).otherwise(unequal - 1)

    return common(a, b) + common(F.reverse(a), F.reverse(b)) >= F.greatest(F.size(a), F.size(b)) - 1


def surviving_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, no``: the one place at which each line that stays, stays.

    Earlier means by id (null first), then digest of the text, then place in the text.
    """
    place, spot = F.struct("id", "text_hash", "no"), F.xxhash64("id", "text_hash", "no")
    lines, n = _lines(docs, id_col, text_col), partitions(docs.sparkSession)
    halves = lines.select("h1", _second(F.col("wh")).alias("h2"), place.alias("place"), _halves(F.col("wh"), F.col("m")).alias("halves"))
    distinct = written(halves.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.first("halves").alias("halves")), "line-distinct")

    half = distinct.select(F.xxhash64("place.id", "place.text_hash", "place.no").alias("spot"), F.posexplode("halves").alias("role", "half"))
    per = half.groupBy("half").agg(F.sum(F.when(F.col("role") < 2, 1).otherwise(0)).alias("n_own"), F.count("*").alias("n"))
    shared = written(per.filter("n > 1 and n_own > 0").select("half", "n_own", (F.col("n") - F.col("n_own")).alias("n_longer")), "line-shared-halves")
    bits = Bitmap(shared, "half").passing(half, "half").join(shared, "half").select("spot", _shares(F.col("role"), F.col("n_own"), F.col("n_longer")).alias("shares"))
    candidates = written(bits.groupBy("spot").agg(F.bit_or("shares").alias("shares")), "line-candidates")

    said = Bitmap(candidates, "spot").passing(_said(docs, id_col, text_col).withColumn("spot", spot), "spot")
    once = said.groupBy("id", "text_hash", "no").agg(F.first("said").alias("said")).withColumn("spot", spot)  # documents may repeat
    found = once.join(candidates, "spot").select(place.alias("place"), "said", "shares")
    ordered = found.repartitionByRange(n, "place").sortWithinPartitions("place").withColumn("line", F.monotonically_increasing_id())
    texts = written(ordered.drop("place"), "line-texts")  # lines are numbered in order of their first place

    hashed = texts.select("line", "shares", _hashes(_words(F.col("said"))).alias("wh")).repartition(n)
    variants = hashed.select("line", F.explode(_neighbourhood(F.col("wh"), F.size("wh"), F.col("shares"))).alias("key"))
    variants = written(variants, "line-variants")
    leads = written(variants.groupBy("key").agg(F.min("line").alias("lead"), F.count("*").alias("n")).filter("n > 1").select("key", "lead"), "line-leads")
    pairs = Bitmap(leads, "key").passing(variants, "key").join(leads, "key").filter("lead < line").select("line", "lead").distinct()
    leading = texts.select(F.col("line").alias("lead"), F.col("said").alias("lead_said"))
    both = pairs.join(texts, "line").join(leading, "lead").select(_words(F.col("said")).alias("w"), _words(F.col("lead_said")).alias("lead_w"))
    near = both.filter((F.col("w") != F.col("lead_w")) & _one_word_apart(F.col("w"), F.col("lead_w"))).select(_hashes(F.col("w")).alias("wh"))
    gone = written(near.select(F.xxhash64("wh").alias("h1"), _second(F.col("wh")).alias("h2")).distinct(), "line-near")
    return distinct.join(gone, ["h1", "h2"], "left_anti").select("place.*")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` with repeated and nearly repeated lines taken out of the text, and two counts of lines appended.

    Lines are parts between newlines; they are compared by their words, so blanks do not matter.  A line goes if an earlier
    line of the table, in the same document or another, has the same words, or (from eight words on each side) differs by one
    word added, left out or replaced.  The rest of the text stays as it is; a null text stays null and has no lines.  Rows that
    repeat an id and a text are one document and keep the same lines.  A count whose name is taken gets underscores behind it.
    An empty table gives no rows.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # the work's own columns cannot clash with these
    id_name, text_name = (f"c{names.index(c)}" for c in (id_col, text_col))
    kept = surviving_lines(docs, id_col, text_col).groupBy("id", "text_hash").agg(F.collect_list("no").alias("kept"))  # lines of one text
    kept = written(kept.withColumnsRenamed({"id": "_kept_id", "text_hash": "_kept_hash", "kept": "_kept"}), "line-kept")
    text = F.col(text_name)
    keyed = plain.withColumn("_line_hash", F.xxhash64(text_of(text_name)))
    joined = keyed.join(kept, F.col(id_name).eqNullSafe(F.col("_kept_id")) & (F.col("_line_hash") == F.col("_kept_hash")), "left")
    cut = joined.withColumn("_cut", F.split(text, "\n"))
    long = F.filter(F.transform(F.split(flat_lines(text), "\n"), lambda line, i: F.when(F.size(_words(line)) >= EXACT, i)), lambda i: i.isNotNull())
    marked = cut.withColumn("_gone", F.array_except(long, F.coalesce("_kept", F.array().cast("array<int>"))))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_cut") - 1), "_gone")
    rebuilt = F.when(F.size("_gone") == 0, text).otherwise(F.array_join(F.transform(stay, lambda i: F.get("_cut", i)), "\n"))
    n_lines = free_name(counts[0], names)
    return marked.select(
        *[(rebuilt if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)],
        F.when(text.isNull(), 0).otherwise(F.size("_cut")).cast("long").alias(n_lines),
        F.when(text.isNull(), 0).otherwise(F.size("_gone")).cast("long").alias(free_name(counts[1], [*names, n_lines])),
    )
