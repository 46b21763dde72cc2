"""The corpus pipeline: documents, stage by stage, each written and read again as the next one's input.

Rows are matched to an operator's verdicts by id and digest of the text; rows that repeat both are one document.  Extra columns of
the documents pass through; a column of the last table whose name they bear gets underscores behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, partitions, text_of
from tickloom.llm.linededup import line_dedup
from tickloom.llm.mixing import mix_sources
from tickloom.llm.neardup import LOOSE, near_duplicates
from tickloom.llm.pieces import decode_pieces, encode_pieces
from tickloom.llm.quality import quality_rules
from tickloom.llm.queries import BLOCK_BYTES, vocabulary
from tickloom.session import written

#: Stretches whose ids a worker of the last stage keeps: fewer than alone, as the executors are still full from the stages before.
CACHED = 100_000


def _matched(docs: DataFrame, verdicts: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``id, text_hash`` of ``verdicts``; the latter stand in one column, named by :func:`_verdict`."""
    verdict = _verdict(docs)
    named = verdicts.select(F.struct("*").alias(verdict))
    same = F.col("doc_id").eqNullSafe(F.col(f"{verdict}.id")) & (F.xxhash64(text_of()) == F.col(f"{verdict}.text_hash"))
    return docs.join(named, same, how)


def _verdict(docs: DataFrame) -> str:
    return free_name("_verdict", docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    del spark, sf_dir
    kept = quality_rules(docs).filter("kept").select("id", "text_hash")
    return _matched(docs, kept, "left_semi").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; documents of which nothing else is left go."""
    del spark, sf_dir
    dropped = free_name("_dropped", docs.columns)
    cut = line_dedup(docs, counts=(free_name("_lines", docs.columns), dropped))
    # unpacked from an array, else the filter is pushed below and cuts each text again, in code of several times the size
    cut = cut.select(F.inline(F.array(F.struct("*")))).filter((F.col(dropped) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cut.withColumn("n_chars", F.when(F.col(dropped) == 0, F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.80 or more), that with the smallest id."""
    del spark, sf_dir
    kept = near_duplicates(docs, **LOOSE).filter("kept").select("id", "text_hash")
    return _matched(docs, kept, "left_semi").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: sources interleaved by the square roots of their sizes, across and within the files."""
    del sf_dir
    order = mix_sources(docs, block_bytes=BLOCK_BYTES).select("id", "text_hash", "slot", "mixed").distinct()
    keys = [f"{_verdict(docs)}.slot", f"{_verdict(docs)}.mixed", "doc_id", f"{_verdict(docs)}.text_hash"]
    joined = _matched(docs, order, "inner")
    return joined.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).select(docs.columns)


def _placed(docs: DataFrame, place: str) -> DataFrame:
    """``docs``, read from the files that a stage has written, with each row's ``place`` in the order of the files and of their rows."""
    file, names = F.col("_metadata.file_name"), docs.columns
    own, of, row, earlier = (free_name(c, names) for c in ("_file", "_f", "_row", "_before"))
    part, split = (F.regexp_extract(file, pattern, 1).try_cast("long") for pattern in (r"^part-(\d+)", r"-c(\d+)\."))
    rows = docs.select("*", F.struct(part.alias("part"), split.alias("split"), file.alias("name")).alias(own), F.col("_metadata.row_index").alias(row))
    before = Window.orderBy(own).rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy(own).agg(F.count("*").alias("n")).select(F.col(own).alias(of), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(earlier))
    joined = rows.join(F.broadcast(files), F.col(own) == F.col(of))  # as many rows as files
    return joined.select(*names, (F.col(earlier) + F.col(row)).alias(place))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids, and whether these decode to the text; ``place`` is that of the mix, and the order of the files."""
    del sf_dir
    model, names = vocabulary("piece_bpe_32k.model"), docs.columns
    place, ids, crc, text, n_pieces, exact = (free_name(c, names) for c in ("place", "piece_ids", "ids_crc32", "decoded", "n_pieces", "exact"))
    mixed = _placed(docs, place).repartitionByRange(partitions(spark), place).sortWithinPartitions(place)
    decoded = decode_pieces(encode_pieces(mixed, model, ids_col=ids, cached=CACHED), model, ids_col=ids, text_col=text, crc_col=crc)
    return decoded.withColumn(n_pieces, F.size(ids).cast("long")).withColumn(exact, F.col(text) == text_of()).drop(text)


#: In this order: quality rules, line dedup, near-duplicates, mixing to target weights, SentencePiece encoding and decoding.
STAGES = [("quality", quality), ("lines", lines), ("near_dedup", near_dedup), ("mixing", mixing), ("pieces", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: A Viterbi search over a vocabulary is not expressible in SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None
