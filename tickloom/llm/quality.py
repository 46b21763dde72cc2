"""Quality rules with thresholds that follow each language and source.

Every document is measured once, in one pass over its whole text.  A measure's distribution per (lang, source) is kept as a
sketch of counters: a value falls in a bin that keeps its ``DIGITS`` leading bits, so a bin is at most 1/32 of the value wide,
and sketches merge by adding counters (in Spark: partial sums, also of a hot source).  A source's sketch is merged into its
language's, and that into the corpus's; a group with too few documents takes the thresholds of the next wider one.  Fences
outside the quartiles become the cutoffs, which are joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import flat, let, text_of, words
from tickloom.session import written

WINDOW = 5
#: Leading bits of a value that its bin keeps.
DIGITS = 6
#: Documents below which a group takes the wider group's thresholds.
LEAST = 50
#: Quartile distances beyond the quartile at which the fence stands, and the least width of that margin per measure.
FENCE = 3
#: measure -> least margin.  All are whole numbers: thousandths of a share, hundredths of a character.
HIGH = {"symbol_share": 100, "dup_line_share": 500, "repeat_share": 150, "word_length": 400}
LOW = {"word_length": 250}


def _repeat_words(windows: Column, n: Column) -> Column:
    """Words in windows found twice or more.  ``windows``: a hash per window; ``n``: words."""

    def covered(sorted_at: Column) -> Column:
        """Union of [p, p + 5) over sorted p: each adds up to the next one."""
        return F.aggregate(
            F.transform(sorted_at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(sorted_at, i + 1), p + WINDOW) - p)),
            F.lit(0), lambda a, b: a + b,
        )

    def repeated(pairs: Column) -> Column:
        """Places of the windows that equal a neighbour in order of hash."""
        kept = F.filter(pairs, lambda x, i: (x["h"] == F.get(pairs, i - 1)["h"]) | (x["h"] == F.get(pairs, i + 1)["h"]))
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    paired = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
        let(let(paired, repeated), covered)
    )


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines`` (long) in a struct ``measured``.

    A null text has no words.  Windows are compared by 64-bit hashes within one document.
    """
    text = F.col("t")
    n = F.size("w")
    gram = F.transform(
        F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]),
    )
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.withColumn("t", text_of(text_col)).withColumn("w", words(text))
    held = cut.withColumn("g", gram).withColumn("l", lines)
    return held.withColumn("measured", F.struct(
        n.cast("long").alias("n_words"),
        (F.char_length("t") - F.regexp_count(flat(text), F.lit(" "))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("g"), n).cast("long").alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
    )).drop("t", "w", "g", "l")


def _bin(value: Column) -> Column:
    """The least value with the same leading bits."""
    cut = F.greatest(F.length(F.bin(value)) - DIGITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


#: What the sketches hold, as whole numbers.
SHARES = {
    "symbol_share": "n_symbols * 1000 div greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines * 1000 div greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words * 1000 div greatest(n_words, 1)",
    "word_length": "word_chars * 100 div greatest(n_words, 1)",
}


def sketches(measured: DataFrame, names: list[str]) -> DataFrame:
    """``lang, source, measure, bin, n``: one counter per occupied bin of each group."""
    long = measured.select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), _bin(F.col(m)).alias("bin")) for m in names])).alias("x"))
    return long.groupBy("lang", "source", "x.measure", "x.bin").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """``keys, measure, n, q1, q3`` from the counters: the bin that holds rank ceil(n / 4), and ceil(3 n / 4)."""
    by = Window.partitionBy(*keys, "measure")
    upto = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    run = sketch.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(by))
    return run.groupBy(*keys, "measure").agg(
        F.first("total").alias("n"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bin"))).alias("q3"),
    )


def thresholds(measured: DataFrame) -> DataFrame:
    """``lang, source, cut``: one row per group, ``cut`` with ``<measure>_high`` and ``<measure>_low``."""
    names = sorted({*HIGH, *LOW})
    fine = written(sketches(measured, names), "quality-sketches")
    by_lang = merged(fine, "lang")
    own, lang, corpus = quartiles(fine, "lang", "source"), quartiles(by_lang, "lang"), quartiles(merged(by_lang))

    def named(q: DataFrame, side: str) -> DataFrame:
        return q.withColumnsRenamed({c: f"{side}_{c}" for c in q.columns})

    at = own.join(named(lang, "w"), F.col("lang").eqNullSafe(F.col("w_lang")) & (F.col("measure") == F.col("w_measure")), "left").join(
        named(corpus, "c"), F.col("measure") == F.col("c_measure"), "left")

    def chosen(q: str) -> Column:
        return F.when(F.col("n") >= LEAST, F.col(q)).when(F.col("w_n") >= LEAST, F.col(f"w_{q}")).otherwise(F.col(f"c_{q}"))

    q = at.select("lang", "source", "measure", chosen("q1").alias("q1"), chosen("q3").alias("q3"))
    spread = FENCE * (F.col("q3") - F.col("q1"))
    cut = [F.max(F.when(F.col("measure") == m, F.col("q3") + F.greatest(spread, F.lit(least)))).alias(f"{m}_high") for m, least in HIGH.items()]
    cut += [F.max(F.when(F.col("measure") == m, F.col("q1") - F.greatest(spread, F.lit(least)))).alias(f"{m}_low") for m, least in LOW.items()]
    return q.groupBy("lang", "source").agg(*cut)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``id, text_hash, lang, source``, the measures, ``base_failed`` and ``kept``; one row per document.

    Base rules: fewer than 10 words, or more than a fifth of the words in repeated windows.  Documents that fail them are
    not kept and not sketched, so that junk cannot move the thresholds.  Null languages and sources are groups of their own.
    Texts without words fail.  An empty table gives no rows.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    flat_rows = measures(named).select("id", F.xxhash64(text_of("text")).alias("text_hash"), "lang", "source", "measured.*")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    table = written(flat_rows.withColumn("base_failed", failed).withColumns({m: F.expr(e) for m, e in SHARES.items()}), "quality-measured")
    cuts = written(thresholds(table.filter("not base_failed")), "quality-cuts").withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    joined = table.join(cuts, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    inside = F.lit(True)
    for m in HIGH:
        inside = inside & (F.col(m) <= F.col(f"{m}_high"))
    for m in LOW:
        inside = inside & (F.col(m) >= F.col(f"{m}_low"))
    return joined.select(
        "id", "text_hash", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )
