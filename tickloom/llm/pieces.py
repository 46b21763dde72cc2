"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The best segmentation maximises the sum of the pieces' log-probabilities.  A piece has at most ``longest`` characters, so only
that many places before the present one can still be extended: the search holds scores for that window alone.  Whenever the
backpointer paths of all places that can still be extended meet in one boundary, the ids before it are final and leave.

Vocabularies whose scores are merge ranks (BPE models) get Zipf log-probabilities by rank instead.  Characters that no piece
covers become byte pieces.  Blanks are not normalised: decoding gives back the text, also where it holds the blank's own sign.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.common import free_name
from tickloom.llm.tokens import PieceCache, ids_crc32

#: Fixed values of the format: the sign for a blank, and a character that no text holds, for the sign itself.
BLANK, SIGN = "▁", "\udc81"
#: Zipf-Mandelbrot shift for ranks, and what a character without a piece costs beyond the rarest piece.
SHIFT, UNKNOWN = 2.7, 10.0
#: Characters between two looks for a meeting point inside a stretch without certain boundaries.
LOOK = 64
BATCH = 256
#: Entries of the newer half of a worker's cache of stretches.
CACHED = 400_000


class Vocabulary:
    """Pieces with log-probabilities; ``prefixes`` also holds every beginning of a piece, so that a search can stop early."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.scores = scores
        self.prefixes: dict[str, tuple[float, int] | None] = {}
        self.bytes_id: dict[int, int] = {}
        self.decoded: list[bytes] = []
        self.longest = 1
        for i, (piece, kind) in enumerate(zip(pieces, kinds, strict=True)):
            if kind == "byte":
                self.bytes_id[int(piece[3:5], 16)] = i
                self.decoded.append(bytes([int(piece[3:5], 16)]))
            elif kind == "normal":
                for n in range(1, len(piece)):
                    self.prefixes.setdefault(piece[:n], None)
                self.prefixes[piece] = (scores[i], i)
                self.longest = max(self.longest, len(piece))
                self.decoded.append(piece.replace(BLANK, " ").encode())
            else:
                self.decoded.append(b"")
        self.bytes = np.frombuffer(b"".join(self.decoded), dtype=np.uint8)
        self.sizes = np.array([len(x) for x in self.decoded], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.unknown = min((s for s, k in zip(scores, kinds, strict=True) if k == "normal"), default=0.0) - UNKNOWN
        #: No piece holds a blank after another character: each blank after one is a boundary of every path.
        self.parts_at_blanks = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p, k in zip(pieces, kinds, strict=True) if k == "normal")

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        kinds = ["byte" if model.is_byte(i) else "special" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal" for i in range(n)]
        scores = [model.get_score(i) for i in range(n)]
        if min(scores) < -1000:  # ranks, not log-probabilities
            total = sum(1 / (i + SHIFT) for i in range(n))
            scores = [-math.log((i + SHIFT) * total) for i in range(n)]
        return cls(pieces, scores, kinds)

    def of_character(self, char: str) -> list[int]:
        return [self.bytes_id[b] for b in (BLANK if char == SIGN else char).encode()]


def stream(vocabulary: Vocabulary, chars: Iterator[str]) -> Iterator[list[int]]:
    """Ids in batches, as early as they are certain.  ``chars``: the escaped text in parts of any size."""
    prefixes, longest, unknown = vocabulary.prefixes, vocabulary.longest, vocabulary.unknown
    text, base = "", 0  # characters from place ``base`` on are not committed yet
    best, back = [0.0], [(0, -1)]  # by place - base
    at, reach, looked, parts, ended = 0, 0, 0, iter(chars), False

    def commit(upto: int) -> list[int]:
        nonlocal text, base, best, back
        ids: list[int] = []
        place = upto
        while place > base:
            start, piece = back[place - base]
            ids += [piece] if piece >= 0 else reversed(vocabulary.of_character(text[start - base]))
            place = start
        text, best, back, base = text[upto - base:], best[upto - base:], back[upto - base:], upto
        return ids[::-1]

    def meeting() -> int:
        """The last boundary that the paths of all places from ``at`` to ``reach`` share."""
        live = set(range(at, reach + 1))
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(max(base, back[last - base][0]))
        return live.pop()

    while True:
        while not ended and base + len(text) - at < longest:
            part = next(parts, None)
            if part is None:
                ended = True
            else:
                text += part
        if at >= base + len(text):
            break
        i = at - base
        if at and at >= reach:
            if ids := commit(at):
                yield ids
            best[0], i, looked = 0.0, 0, at
        elif at - looked >= LOOK:
            looked = at
            if (boundary := meeting()) > base:
                yield commit(boundary)
                i = at - base
        score = best[i]
        for n in range(1, min(longest, len(text) - i) + 1):
            known = prefixes.get(text[i:i + n], False)
            if known is False:
                if n > 1:
                    break
                known = None
            if known is None and n > 1:
                continue
            gain, piece = known if known is not None else (unknown, -1)
            while len(best) <= i + n:
                best.append(-math.inf)
                back.append((0, -1))
            if score + gain > best[i + n]:
                best[i + n] = score + gain
                back[i + n] = (at, piece)
            reach = max(reach, at + n)
            if n == 1 and text[i] not in prefixes:
                break
        at += 1
    if ids := commit(at):
        yield ids


def at_once(vocabulary: Vocabulary, text: str) -> list[int]:
    """The same search over a text that is shorter than the stretch between two looks: nothing leaves before its end."""
    find, unknown, end = vocabulary.prefixes.get, vocabulary.unknown, len(text)
    best, back, pieces = [0.0] + [-math.inf] * end, [0] * (end + 1), [-1] * (end + 1)
    reach = 0
    for i in range(end):
        score, j = best[i] if i < reach else 0.0, i + 1
        known = find(text[i:j], False)
        if not known:
            if score + unknown > best[j]:
                best[j], back[j], pieces[j] = score + unknown, i, -1
            if known is False:
                reach = max(reach, j)
                continue
        while known is not False:
            if known and score + known[0] > best[j]:
                best[j], back[j], pieces[j] = score + known[0], i, known[1]
            j += 1
            if j > end:
                break
            known = find(text[i:j], False)
        reach = max(reach, j - 1)
    ids: list[int] = []
    while end:
        start = back[end]
        if pieces[end] >= 0:
            ids.append(pieces[end])
        else:
            ids += reversed(vocabulary.of_character(text[start]))
        end = start
    return ids[::-1]


def escaped(text: str) -> str:
    return text.replace(BLANK, SIGN).replace(" ", BLANK)


class Codec:
    """Encodes texts by stretches between certain boundaries, with a bounded cache of stretches; decodes ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.cache = PieceCache(self._encode_stretches, CACHED)

    def _encode_stretches(self, stretches: list[str]) -> list[bytes]:
        return [array("I", self._search(BLANK + escaped(s))).tobytes() for s in stretches]

    def _search(self, text: str) -> list[int]:
        if len(text) < LOOK:
            return at_once(self.vocabulary, text)
        return [i for ids in stream(self.vocabulary, iter([text])) for i in ids]

    def stretches(self, text: str) -> list[str]:
        """The text without the blank that stands before each stretch; a run of blanks begins one stretch."""
        if not text:
            return []
        if not self.vocabulary.parts_at_blanks:
            return [text]
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [s[1:] for s in re.findall(" +[^ ]*", " " + text)]
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.stretches(t) for t in texts]
        known = self.cache.learn(cut)
        return [b"".join(map(known, stretches)) for stretches in cut]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of the lists ``ids[offsets[i]:offsets[i + 1]]``: their pieces' bytes, gathered at once, less each one's first blank."""
        v = self.vocabulary
        sizes = v.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        data = v.bytes[np.arange(total) + np.repeat(v.begins[ids] - (ends - sizes), sizes)]
        bounds = np.concatenate([[0], ends])[offsets]
        if total:
            stays = np.ones(total, dtype=bool)
            stays[bounds[:-1][bounds[1:] > bounds[:-1]]] = False
            data = data[stays]
            bounds = np.concatenate([[0], np.cumsum(stays)])[bounds]
        texts = pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
        texts.validate(full=True)  # ids that no text has may not be UTF-8
        return texts


_codecs: dict[str, Codec] = {}


def codec(model_path: str) -> Codec:
    return _codecs.get(model_path) or _codecs.setdefault(model_path, Codec(Vocabulary.load(model_path)))


def encode_pieces(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "piece_ids", cached: int = CACHED) -> DataFrame:
    """``docs`` with an array of ids appended.  A null or empty text has none.  An empty table gives no rows.

    ``model_path`` must be readable on every executor.  Every column of ``docs`` passes through, whatever its name.  A worker
    keeps the ids of up to twice ``cached`` stretches.
    """
    if ids_col in docs.columns:
        raise ValueError(f"{ids_col} is taken: name another column for the ids")
    names = docs.columns
    place = names.index(text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(model_path)
        one.cache.size = cached
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                part = batch.slice(low, BATCH)
                ids = one.encode([t or "" for t in part.column(place).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(offsets), values)], names=[*names, ids_col])
        one.cache.old = {}  # idle workers hold the newer half alone

    return docs.mapInArrow(encode, T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode_pieces(encoded: DataFrame, model_path: str, ids_col: str = "piece_ids", text_col: str = "decoded", crc_col: str | None = None) -> DataFrame:
    """``encoded`` with the text of its ids appended (null ids give an empty text), and optionally the ids' crc32.

    A new column whose name is taken gets underscores behind it.
    """
    names = encoded.columns
    place = names.index(ids_col)
    added = [free_name(text_col, names)]
    if crc_col:
        added.append(free_name(crc_col, [*names, *added]))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(model_path)
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                part = batch.slice(low, BATCH)
                ids = part.column(place)
                offsets = ids.offsets.to_numpy()
                texts = one.decode(ids.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]], offsets - offsets[0])
                more = [pa.array(ids_crc32(ids))] if crc_col else []
                yield pa.RecordBatch.from_arrays([*part.columns, texts, *more], names=[*names, *added])

    more = [T.StructField(c, t) for c, t in zip(added, (T.StringType(), T.LongType()), strict=False)]
    return encoded.mapInArrow(decode, T.StructType([*encoded.schema.fields, *more]))
