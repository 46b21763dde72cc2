"""Clashing names, other types of sources, and links between weak parts of credentials against a plain version."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tickloom.llm.common import free_name
from tickloom.llm.linededup import Bitmap, line_dedup
from tickloom.llm.mixing import mix_sources
from tickloom.llm.pieces import codec, decode_pieces, encode_pieces
from tickloom.llm.queries import vocabulary
from tickloom.llm.secrets import BASE, NEEDED, SCOPE, WEAK, secret_scan
from tests.llm.test_operators import ROWS, SCHEMA, prose


def test_free_names():
    assert free_name("a", ["b"]) == "a" and free_name("a", ["A", "a_"]) == "a__"


def test_line_dedup_with_its_own_names_taken(spark):
    names = ["n_lines", "n_dropped", "_kept", "_cut", "_gone", "_line_hash", "_kept_id", "_kept_hash", "kept", "no", "w", "h1", "place", "line", "c0", "id"]
    rows = [(d, t, *([7] * len(names))) for d, t in ROWS]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} int" for c in names))
    got = line_dedup(df)
    assert got.columns == [*df.columns, "n_lines_", "n_dropped_"]
    found = got.collect()
    assert {r["doc_id"]: r["text"] for r in found} == dict(brute.line_dedup(ROWS)) and all(r[c] == 7 for r in found for c in names)


def test_pieces_with_their_own_names_taken(spark):
    model = vocabulary("piece_bpe_32k.model")
    df = spark.createDataFrame([(d, t, "x", 5) for d, t in ROWS], "doc_id long, text string, decoded string, ids_crc32 long")
    got = decode_pieces(encode_pieces(df, model), model, crc_col="ids_crc32")
    assert got.columns == [*df.columns, "piece_ids", "decoded_", "ids_crc32_"]
    assert {r["doc_id"]: (r["decoded_"], r["decoded"], r["ids_crc32"]) for r in got.collect()} == {d: (t or "", "x", 5) for d, t in ROWS}


def test_ids_of_no_text_are_refused():
    one = codec(vocabulary("piece_bpe_32k.model"))
    broken = one.vocabulary.bytes_id[0xC3]
    with pytest.raises(ValueError):
        one.decode(np.array([broken, broken, broken]), np.array([0, 3]))
    assert one.decode(np.array([], dtype=np.int64), np.array([0, 0, 0])).to_pylist() == ["", ""]


@pytest.mark.parametrize("kind", ["long", "date", "struct<a:int,b:string>"])
def test_sources_of_other_types(spark, kind):
    value = {"long": F.col("id") % 3, "date": F.date_add(F.lit("2024-01-01"), (F.col("id") % 3).cast("int"))}.get(kind, F.struct((F.col("id") % 3).cast("int").alias("a"), F.lit("x").alias("b")))
    df = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 20).alias("text"), F.when(F.col("id") > 2, value).alias("source"))
    got = mix_sources(df, block_bytes=200).collect()
    assert sorted(r["id"] for r in got) == list(range(60)) and len({str(r["source"]) for r in got}) == 4


def test_a_long_document_stands_at_its_first_block(spark):
    rows = [(0, "a" * 1000, "x"), *((i, "b" * 99, "y") for i in range(1, 21))]
    got = {r["id"]: (r["block"], r["slot"]) for r in mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_bytes=100).collect()}
    assert got[0][0] == 0 and len({v[1] for k, v in got.items() if k}) == 20


def test_rows_beyond_a_full_bitmap_are_joined_exactly(spark):
    table = spark.range(50).select(F.xxhash64("id").alias("h"))
    rows = spark.range(5000).select(F.xxhash64("id").alias("h"))
    passed = Bitmap(table, "h").passing(rows, "h")
    assert passed.columns == ["h"] and passed.join(table, "h", "left_semi").count() == 50 and passed.count() < 200


# -- weak parts of credentials -----------------------------------------------------------------------------------------

def pattern(before, value):
    return re.compile(f"({before})({value})".replace("(?i:", "(?i:"))


def plain_spans(text):
    """Matches per kind; weak ones clear of base spans; links by distance between begins."""
    found = []
    for kind, (before, value, least) in (BASE | WEAK).items():
        for m in pattern(before, value).finditer(text):
            body = m.group(2)
            if len(body) < least or (kind == "credential" and not all(re.search(n, body) for n in NEEDED)):
                continue
            found.append((kind, m.start(), m.end(), kind != "credential" or bool(re.search("[a-z]", body) and re.search("[A-Z]", body))))
    base = [x for x in found if x[0] in BASE]
    weak = [x for x in found if x[0] not in BASE and not any(b[1] < x[2] and x[1] < b[2] for b in base)]
    role = {"assign": "secret", "access": "id", "hex": "secret", "identifier": "id", "credential": "secret", "endpoint": "place"}

    def near(x, others, roles):
        return any(role[o[0]] in roles and abs(o[1] - x[1]) <= SCOPE for o in others)

    sure = [x for x in base + weak if x[3]]
    taking = sure + [x for x in weak if not x[3] and near(x, sure, {"id"}) and near(x, sure, {"place"})]
    completes = {"id": {"secret"}, "secret": {"id", "place"}, "place": {"secret"}}
    linked = [x for x in taking if x[0] not in BASE and near(x, [o for o in taking if o != x], completes[role[x[0]]])]
    return {(k, s, e) for k, s, e, _ in base + linked}


def scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["id"]: {(x["kind"], x["start"], x["end"]) for x in r["found"]} for r in secret_scan(df).collect()}


def test_linked_parts_equal_a_plain_version(spark):
    rng = random.Random(12)
    parts = ["client_id: bob99", "account-key = Zed_1", "https://host.example/path", "s3://bucket/x", "zx81kq77mm20pl45tt90", "550e8400-e29b-41d4-a716-446655440000",
             "aZ9kQ2mN7xR4tY8w", "JBSWY3DPEHPK3PXP2", "password=hunter22", "AKIA" + "Q7" * 9, "0123456789abcdef01234567", "averyveryverylongword", "Vereinbarungsgemaess"]
    texts = []
    for _ in range(150):
        words = prose(rng, rng.choice([20, 60, 150])).split()
        for _ in range(rng.randint(0, 5)):
            words.insert(rng.randint(0, len(words)), rng.choice(parts))
        texts.append(" ".join(words))
    got = scanned(spark, texts)
    want = {i: plain_spans(t) for i, t in enumerate(texts)}
    assert got == want and sum(any(k == "credential" for k, *_ in v) for v in want.values()) > 20


def test_keys_of_one_case_count_between_an_identifier_and_an_endpoint(spark):
    both = "client_id: bob99 at https://host.example/x with {}"
    texts = [both.format("zx81kq77mm20pl45tt90"), both.format("550e8400-e29b-41d4-a716-446655440000"), "client_id: bob99 with zx81kq77mm20pl45tt90",
             "https://host.example/x with zx81kq77mm20pl45tt90", "client_id: bob99 at https://host.example/x"]
    got = scanned(spark, texts)
    assert [sorted(k for k, *_ in got[i]) for i in range(5)] == [["credential", "endpoint", "identifier"]] * 2 + [[], [], []]
