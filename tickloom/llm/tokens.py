"""Token ids as Parquet list columns.

Documents are dealt out by id range and sorted, so the files together are in ascending id order and a filter on ids reads few
row groups and pages.  Each file's ids carry their place within the file; the files' totals give every document's place in the
whole stream without another pass.  ``encoding``: ``dictionary`` (ids of one vocabulary) or ``delta`` (page format 2, binary packed).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import partitions, text_of

FILE_SCHEMA = "chunk int, doc_id long, at long, n_tokens long, ids array<int>"
#: Entries of the newer half of a worker's cache of encoded pieces; the older half holds as many.
CACHED = 560_000
#: Documents, and about the bytes of text, whose ids are held at a time; new pieces that are encoded as one text.
BATCH, PART_BYTES, TOGETHER = 1024, 4 << 20, 400
#: A piece that begins or ends with white space, or holds a long run of it: the pre-tokenizer may join it with its neighbour.
ODD = re.compile(r"\A\s|\s\Z|\s{3}")
#: Runs of blanks in which a line end does not stand alone.
RUNS = re.compile(r"\s{3}|\s\s\Z|\n ")
#: Signs before which a word's token ends.
SIGNS = frozenset(".,;:!?")


class PieceCache:
    """Values per piece of text, bounded: when the newer half is full it becomes the older one.  None is encoded anew each time."""

    def __init__(self, encode: Callable[[list[str]], list], size: int = CACHED):
        self.encode, self.size = encode, size
        self.new: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}

    def learn(self, lists: list[list[str]]) -> Callable[[str], bytes | None]:
        """The lookup of a piece, for all pieces of the lists."""
        self.values(list(set().union(*lists)))
        return self.new.__getitem__

    def values(self, pieces: list[str]) -> list[bytes | None]:
        """The values of different pieces.  Nothing here passes over the whole cache."""
        if len(self.new) + len(pieces) > self.size:
            self.old, self.new = self.new, {}
        found = list(map(self.new.get, pieces))
        missing = [p for p, x in zip(pieces, found, strict=True) if x is None]
        if not missing:
            return found
        older = list(map(self.old.get, missing))
        encoded = iter(self.encode([p for p, x in zip(missing, older, strict=True) if x is None]))
        older = [next(encoded) if x is None else x for x in older]
        self.new.update(zip(missing, older, strict=True))
        later = iter(older)
        return [next(later) if x is None else x for x in found]


class SpaceCodec:
    """Encodes texts with the library, each distinct piece between blanks once per worker.

    For byte-level vocabularies whose pieces hold at most one space, in front: the text is cut before each space, and pieces
    are looked up without it; it is cut before each line end too, and such a piece keeps the line end.  A last sign after a
    letter is a token of its own, so the word without it is looked up.  A text with an odd piece (see ``ODD``), or with what may
    be a special token, is encoded whole.  New pieces are encoded many in one text; its ids are parted where a piece begins.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.spaced, self.lined = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.spaced[i] = token.startswith("\u0120")  # the byte-level signs for a space and a line end
            self.lined[i] = token == "\u010a"
        self.line_end, self.signs = self._ids("\n").tobytes(), {c: self._ids(c).tobytes() for c in SIGNS}
        self.later, self.first = PieceCache(self._later), PieceCache(self._first, CACHED // 8)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _first(self, pieces: list[str]) -> list[bytes | None]:
        """Pieces that begin a text, as they are."""
        return [None if ODD.search(p) else self._ids(p).tobytes() for p in pieces]

    def _together(self, pieces: list[str], before: str, begins_with: np.ndarray, found: dict[str, bytes | None]) -> None:
        for low in range(0, len(pieces), TOGETHER):
            part = pieces[low:low + TOGETHER]
            ids = self._ids(before + before.join(part))
            begins = np.flatnonzero(begins_with[ids])
            if len(begins) != len(part):
                raise ValueError("this vocabulary has pieces with several blanks: encode whole texts")
            data, bounds = ids.tobytes(), [*(begins * 4).tolist(), len(ids) * 4]
            found.update(zip(part, [data[a:b] for a, b in pairwise(bounds)], strict=True))

    def _later(self, pieces: list[str]) -> list[bytes]:
        """Pieces that follow a space, or begin with a line end; no ids for odd ones."""
        known, signed, spaced, lined = self.later.new, [], [p for p in pieces if p.isalpha()], []
        found: dict[str, bytes] = {}
        for p in [p for p in pieces if not p.isalpha()]:
            begins = p[:1] == "\n"
            body = p[1:] if begins else p
            if body[-1:] in SIGNS and body[:-1].isalpha():
                signed.append(p)
                body = body[:-1]
                if p[:-1] in known:
                    continue
            elif not body or ODD.search(body):
                found[p] = b""
                continue
            (lined if begins else spaced).append(body)
        self._together(list(set(spaced)), " ", self.spaced, found)
        self._together(list(set(lined)), "\n", self.lined, lines := {})
        found.update(("\n" + p, ids) for p, ids in lines.items())
        for p in signed:
            word = found.get(p[:-1])
            found[p] = (known[p[:-1]] if word is None else word) + self.signs[p[-1]]
        known.update((p[:-1], found[p[:-1]]) for p in signed if p[:-1] in found)  # the words without their signs as well
        return list(map(found.__getitem__, pieces))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Texts are cut and their pieces told apart by Arrow; each different piece of the call is looked up once."""
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        special = pc.match_substring(texts, "<|").to_pylist()
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        firsts, counts = cut.offsets.to_numpy()[:-1], np.diff(cut.offsets.to_numpy())
        heads = cut.values.take(pa.array(firsts)).to_pylist()
        behind = np.ones(len(cut.values), dtype=bool)
        behind[firsts] = False
        pieces = cut.values.filter(pa.array(behind)).dictionary_encode()
        at, distinct = pieces.indices.to_numpy(), pieces.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist is slow
        first = self.first.learn([[h for h, s in zip(heads, special, strict=True) if not s]])
        found = self.later.values(distinct)

        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        unknown = np.flatnonzero(lengths == 0).tolist()  # a lone line end among them
        odd, lone = np.zeros(len(found), dtype=bool), np.zeros(len(found), dtype=bool)
        for i in unknown:
            found[i], lengths[i] = self.line_end, len(self.line_end) // 4
            (lone if distinct[i] == "\n" else odd)[i] = True
        ids, starts = np.frombuffer(b"".join(found), np.uint32), np.cumsum(lengths) - lengths
        sizes = lengths[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(starts[at] - ends[:-1], sizes)
        places += np.arange(ends[-1])
        ids = ids[places]

        bounds = np.concatenate([[0], np.cumsum(counts - 1)])
        low, high = ends[bounds[:-1]], ends[bounds[1:]]
        if unknown:
            odd, lone = (np.diff(np.concatenate([[0], np.cumsum(x[at])])[bounds]) > 0 for x in (odd, lone))
        else:
            odd = lone = np.zeros(len(texts), dtype=bool)
        out = []
        for i, head in enumerate(heads):
            whole = special[i] or odd[i] or lone[i] and RUNS.search(texts[i].as_py())
            head = None if whole else first(head)
            out.append(self._ids(texts[i].as_py()).tobytes() if head is None else head + ids[low[i]:high[i]].tobytes())
        return out


_codecs: dict[str, SpaceCodec] = {}


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """At most BATCH rows and about PART_BYTES of text; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else 0
        high = min(max(low + 1, int(np.searchsorted(ends, before + PART_BYTES, "right"))), low + BATCH)
        yield batch.slice(low, high - low)
        low = high


def encode_partition(batches: Iterator[pa.RecordBatch], tokenizer_path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    codec = _codecs.get(tokenizer_path) or _codecs.setdefault(tokenizer_path, SpaceCodec(tokenizer_path))
    end, at = np.array([end_id], dtype=np.uint32).tobytes(), 0
    for batch in batches:
        for part in _parts(batch):
            ids = codec.encode(part.column("text"))
            counts = np.array([len(x) // 4 + 1 for x in ids], dtype=np.int64)
            places = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(end.join([*ids, b""]))])
            yield pa.RecordBatch.from_arrays(
                [part.column("chunk"), part.column("doc_id"), pa.array(places), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), values)],
                names=["chunk", "doc_id", "at", "n_tokens", "ids"],
            )


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10,
) -> None:
    """Encode every document, append ``end_id``, and write files in ascending id order below ``path``.

    A null text counts as empty and yields the end id alone.  Null ids come first; rows with one id follow each other by
    digest of the text.  An empty table writes an empty dataset.  Files are committed by Spark, so a lost task leaves nothing.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding: dictionary or delta, not {encoding!r}")
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    spread = slim.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("chunk"), "doc_id", "text")
    encoded = spread.mapInArrow(lambda batches: encode_partition(batches, tokenizer_path, end_id), FILE_SCHEMA)
    options = {
        "compression": "zstd", "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes,
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(), "parquet.writer.version": "v2" if encoding == "delta" else "v1",
    }
    encoded.write.options(**options).mode("errorifexists").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def starts(files: DataFrame) -> DataFrame:
    """``chunk, before``: ids in the files before, from the files' metadata columns only."""
    totals = files.groupBy("chunk").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return totals.select("chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def ids_crc32(ids: pa.ListArray) -> np.ndarray:
    """Unsigned crc32 of each list as little-endian unsigned 32-bit integers."""
    offsets = ids.offsets.to_numpy()
    values = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<i4")).cast("B")
    return np.array([zlib.crc32(values[4 * a:4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], dtype=np.int64)


def digest_files(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            counts = np.diff(ids.offsets.to_numpy()).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), batch.column("doc_id"), batch.column("at"), pa.array(counts), pa.array(ids_crc32(ids))],
                names=["chunk", "doc_id", "at", "n_tokens", "ids_crc32"],
            )

    read = files.select("chunk", "doc_id", "at", "ids").mapInArrow(digest, "chunk int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read.join(F.broadcast(starts(files)), "chunk").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")  # a row per file
