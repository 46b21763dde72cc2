"""Each operator on a small table with the awkward cases, against plain versions."""

import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tickloom.llm import lm, neardup
from tickloom.llm.common import lower_ascii, words
from tickloom.llm.components import components
from tickloom.llm.exact import exact_dedup
from tickloom.llm.linededup import line_dedup
from tickloom.llm.lm import score_texts
from tickloom.llm.mixing import cycle, mix_sources, segments, shares
from tickloom.llm.neardup import near_duplicates
from tickloom.llm.pieces import BLANK, Codec, Vocabulary, at_once, codec, decode_pieces, encode_pieces, escaped, stream
from tickloom.llm.quality import quality_rules
from tickloom.llm.queries import vocabulary
from tickloom.llm.secrets import listed, secret_scan
from tickloom.llm.sharding import GroupEnds, minimax_cuts, minimax_shards
from tickloom.llm.tokens import digest_files, read_token_files, write_token_files
from tickloom.session import scratch_dir

LEXICON = [a + b for a in "ka to mi ra su ne".split() for b in "lon dir pes vat gam".split()]
#: Columns that operators use inside, as extra columns of the documents.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, chunk int, w string, set string, word string"


def prose(rng, n):
    return " ".join(rng.choice(LEXICON) for _ in range(n))


def awkward_texts():
    rng = random.Random(5)
    base = prose(rng, 220)
    w = base.split()
    texts = [base, base, base.upper(), None, "", " \t\n", "one", "a b c", base]
    for i in range(12):
        other = list(w)
        other[17 * i % 220] = "changed"
        texts.append(" ".join(other))
    line = prose(rng, 12)
    near = line.split()
    near[4] = "other"
    texts += [line + "\n" + prose(rng, 30), prose(rng, 25) + "\n" + line, " ".join(near) + "\nshort", line + " more\n" + line + "\n\n" + line]
    texts += ["#|$ " * 40, (prose(rng, 8) + " ") * 12, prose(rng, 9000), "Straße ÄÖ " + prose(rng, 30), "\x00\x01\x02 token=abc123456 \x02 " + prose(rng, 20)]
    texts += [f"key: {rng.getrandbits(128):032x} and AKIA{'Q7' * 10} password = \"hunter2345\" see https://host.example/x secret=token:abcdefgh"]
    texts += [prose(rng, 60) for _ in range(20)]
    return texts


ROWS = list(enumerate(awkward_texts()))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en" if d % 3 else None, f"src{d % 4}" if d % 5 else None, len(t or ""), 1, 2, "x", "y", "z") for d, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_words_and_case(spark):
    text = " a\tB\x0bÄ\x0cé\r\nZ  Iİ\x85x "
    row = spark.createDataFrame([(text,)], "t string").select(words(F.col("t")), lower_ascii(F.col("t"))).first()
    assert row[0] == brute.WORD.findall(text)
    assert row[1] == text.translate(brute.UPPER_TO_LOWER)


# -- sharding -----------------------------------------------------------------------------------------------------------------
def test_shards(docs, empty):
    rows = minimax_shards(docs, 7).collect()
    assert sorted(r["id"] for r in rows) == [d for d, _ in ROWS]
    sizes, slots, shard_of = {}, {}, {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        text = ROWS[r["id"]][1] or ""
        assert (r["size"], r["text_crc32"]) == (len(text.encode()) + 8, zlib.crc32(text.encode()))
        assert shard_of.setdefault(text, r["shard"]) == r["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) == rows[0]["capacity"] == brute.smallest_capacity(brute.group_sizes(ROWS), 7)
    assert minimax_shards(empty, 7).count() == 0


def test_more_shards_than_groups_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "aa"), (1, "aa"), (None, "b"), (2, None)], "doc_id long, text string")
    rows = minimax_shards(df, 5).collect()
    assert len(rows) == 4 and len({r["shard"] for r in rows if r["id"] == 1}) == 1
    assert sorted(r["slot"] for r in rows if r["id"] == 1) == [0, 1]


@pytest.mark.parametrize("seed", range(6))
def test_cuts_from_a_coarse_grid(seed, monkeypatch):
    """The bounded view of the group ends gives the capacity of the full one."""
    from tickloom.llm import sharding

    monkeypatch.setattr(sharding, "CELLS", 3)
    monkeypatch.setattr(sharding, "FINER", 2)
    rng = random.Random(seed)
    sizes = [rng.choice([1, 3, 8, 8, 900 if seed % 2 else 40]) for _ in range(150)]
    ends = np.cumsum(sizes).tolist()

    def split(shift, parent, cells):
        found = {}
        for e in ends:
            if cells is None or (e - 1) >> parent in cells:
                found.setdefault((e - 1) >> shift, []).append(e)
        return [(max(v), len(v) - 1, shift) for v in found.values()]

    capacity, cuts = minimax_cuts(GroupEnds(ends[-1], split), 9)
    assert capacity == brute.smallest_capacity(sizes, 9)
    shards = [b - a for a, b in zip([0, *cuts], [*cuts, ends[-1]], strict=True)]
    assert max(shards) == capacity and set(cuts) <= {0, *ends}


# -- quality ------------------------------------------------------------------------------------------------------------------
def test_quality(docs, empty):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = quality_rules(docs)
    got = by_id(found, *columns, "kept")
    assert {d: v[:-1] for d, v in got.items()} == {d: brute.quality(t) for d, t in ROWS}
    assert not any(v[-1] for v in got.values() if v[-2])
    assert got[0][-1] and quality_rules(empty).count() == 0


def test_thresholds_follow_the_group(spark):
    """A source in which every document has symbols keeps them; elsewhere the same share is an outlier."""
    rng = random.Random(1)
    table = [(i, prose(rng, 60) + " | |" * (10 if i % 2 else 0), "en", "tables" if i % 2 else "prose") for i in range(200)]
    table.append((1000, prose(rng, 60) + " | |" * 10, "en", "prose"))
    got = by_id(quality_rules(spark.createDataFrame(table, "doc_id long, text string, lang string, source string")), "base_failed", "kept")
    assert all(kept for i, (failed, kept) in got.items() if i != 1000 and not failed)
    assert not got[1000][1]


# -- near-duplicates ----------------------------------------------------------------------------------------------------------
def test_near_duplicates(docs, empty):
    want = brute.components_of(ROWS)
    assert by_id(near_duplicates(docs), "n_shingles", "component_id") == want
    assert sum(c != d for d, (_, c) in want.items()) > 8
    assert near_duplicates(empty).count() == 0


def test_a_bucket_of_several_components_in_blocks(spark, monkeypatch):
    """Two hundred copies with random edits share buckets; small blocks, and the result of the plain version."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(3)
    base = prose(rng, 150).split()
    rows = []
    for i in range(160):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 3, 4, 5])):
            copy[rng.randrange(150)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(copy)))
    got = by_id(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)), "n_shingles", "component_id")
    assert got == brute.components_of(rows)


def test_bitmaps_do_not_reject_similar_sets():
    rng = np.random.default_rng(0)
    for n in (1, 5, 40, 400, 6000):
        for _ in range(20):
            common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            extra = int(n * 15 / 85)
            a = common
            b = np.concatenate([common, rng.integers(0, 1 << 63, extra, dtype=np.uint64)])
            _, _, bands, samples, sets = neardup.sign(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            x, y = samples.view(np.uint64), sets.view(np.uint64)
            assert neardup.may_be_similar(np.array([len(a)]), np.array([len(b)]), x[:1] ^ x[1:], y[:1] ^ y[1:])[0]
            assert (bands[0] == bands[1]).any()


def between_80_and_85(rng, n):
    """Pairs of texts of 250 words with five scattered words changed: similarity 221 / 271."""
    out = []
    for i in range(n):
        w = [f"w{rng.randrange(10**6)}" for _ in range(250)]
        v = list(w)
        for k in range(20, 245, 45):
            v[k] = f"other{i}k{k}"
        out += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    return out


def test_near_duplicates_at_80_percent(spark):
    rows = between_80_and_85(random.Random(8), 60)
    pair = [brute.shingle_set(t) for _, t in rows[:2]]
    assert 80 <= 100 * len(pair[0] & pair[1]) / len(pair[0] | pair[1]) < 85
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert by_id(near_duplicates(table, **neardup.LOOSE), "n_shingles", "component_id") == brute.components_of(rows, 80)
    assert by_id(near_duplicates(table), "n_shingles", "component_id") == brute.components_of(rows)


def test_bitmaps_do_not_reject_sets_at_80_percent():
    rng = np.random.default_rng(1)
    for n in (5, 40, 400, 6000):
        for _ in range(20):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            b = np.concatenate([a, rng.integers(0, 1 << 63, n // 4, dtype=np.uint64)])
            _, _, bands, samples, sets = neardup.sign(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 36)
            x, y = samples.view(np.uint64), sets.view(np.uint64)
            assert neardup.may_be_similar(np.array([len(a)]), np.array([len(b)]), x[:1] ^ x[1:], y[:1] ^ y[1:], 80)[0]
            assert bands.shape == (2, 36) and (bands[0] == bands[1]).any()


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(50)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["a"]: r["b"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}


# -- lines --------------------------------------------------------------------------------------------------------------------
def test_lines(docs, empty):
    found = line_dedup(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    want = dict(brute.line_dedup(ROWS))
    assert got == want and any(want[d] != t for d, t in ROWS)
    assert line_dedup(empty).count() == 0


def test_lines_one_word_apart(spark):
    line = prose(random.Random(9), 10).split()
    variants = [line, line[1:], line[:-1], [*line, "z"], ["z", *line], line[:3] + ["z"] + line[4:], line[:3] + line[5:], [line[1], line[0], *line[2:]], line[:7], list(reversed(line))]
    for seed in range(3):
        order = list(variants)
        random.Random(seed).shuffle(order)
        rows = [(i, " ".join(v)) for i, v in enumerate(order)]
        got = {r["doc_id"]: r["text"] for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == dict(brute.line_dedup(rows))


def test_lines_one_word_apart_at_any_place(spark):
    """Lines of few different words, so that an edit has many explanations, and documents that repeat."""
    rng = random.Random(4)
    rows = [(i, "\n".join(" ".join(rng.choice("ab") for _ in range(rng.randint(7, 13))) for _ in range(4))) for i in range(60)]
    base = [f"w{i}" for i in range(12)]
    for at in range(13):
        rows += [(100 + at, " ".join([*(f"{at}{w}" for w in base[:at]), "x", *(f"{at}{w}" for w in base[at:])])), (200 + at, " ".join(f"{at}{w}" for w in base))]
        rows.append((300 + at, " ".join([*(f"{at}{w}" for w in base[:at]), "y", *(f"{at}{w}" for w in base[at:])])))
    found = line_dedup(spark.createDataFrame([*rows, rows[0], rows[-1]], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in found} == dict(brute.line_dedup(rows)) and len(found) == len(rows) + 2


# -- exact --------------------------------------------------------------------------------------------------------------------
def test_exact(docs, empty):
    got = sorted((r["id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup(docs, keep="largest").collect())
    assert got == brute.exact(ROWS)
    smallest = by_id(exact_dedup(docs), "keep_id", "kept")
    assert smallest[8] == (0, False) and smallest[0] == (0, True)
    assert exact_dedup(empty).count() == 0


def test_one_text_over_many_ranges(spark):
    """A third of all rows with one text, and texts with one begin, spread over ranges and are joined again."""
    rows = [(i, "same Text" if i % 3 == 0 else "a common beginning of forty characters .. " + str(i // 6)) for i in range(600)]
    got = sorted((r["id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), keep="largest").collect())
    assert got == brute.exact(rows)


# -- mixing -------------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 7, "b": 2, "c": 1}, {i: 1 + i * i for i in range(12)}])
def test_cycle_stays_within_one_block(weights):
    of = shares(weights, 64)
    order, seen = cycle(of), dict.fromkeys(of, 0)
    assert len(order) == sum(of.values()) == 64 and all(order.count(s) == k for s, k in of.items())
    for t, s in enumerate(order, 1):
        seen[s] += 1
        assert all(abs(seen[x] - of[x] * t / 64) < 1 for x in of)


def test_segments_place_every_block_once():
    plan = segments({"a": 100, "b": 3, "c": 31, "d": 0}, {"a": 1, "b": 5, "c": 2, "d": 1}, 16)
    total = sum(len(p["order"]) * p["cycles"] for p in plan)
    assert total == 134 and [p["at"] for p in plan] == [sum(len(q["order"]) * q["cycles"] for q in plan[:i]) for i in range(len(plan))]


def test_mix(docs, empty):
    rows = mix_sources(docs, block_bytes=500, slots=16).collect()
    assert sorted(r["id"] for r in rows) == [d for d, _ in ROWS]
    of_block, slots = {}, {}
    for r in rows:
        assert of_block.setdefault((r["source"], r["block"]), r["slot"]) == r["slot"]
        assert slots.setdefault(r["slot"], (r["source"], r["block"])) == (r["source"], r["block"])
    blocks = {s: 1 + max(b for x, b in of_block if x == s) for s in {r["source"] for r in rows}}
    sizes = {s: sum(r["size"] for r in rows if r["source"] == s) for s in blocks}
    placed = []
    for part in segments(blocks, {s: sizes[s] ** 0.5 for s in sorted(blocks, key=lambda s: (s is not None, s))}, 16):
        placed += part["order"] * part["cycles"]
    seen = {}
    for slot, s in enumerate(placed):
        j = seen[s] = seen.get(s, -1) + 1
        if (s, j) in of_block:
            assert of_block[s, j] == slot
    assert mix_sources(empty).count() == 0


@pytest.mark.parametrize(("n", "weights"), [
    (8000, [0.55, *[0.05] * 9]), (1400, [0.5, *[0.5 / 63] * 63]), (5000, [1.0, 2.0, 0.0001, 3**0.5]), (300, [7, 2, 1]),
])
def test_every_prefix_is_within_one_block_of_the_weights(n, weights):
    """The target weights themselves, over many blocks; no source ends before."""
    total = sum(map(Fraction, weights))
    part = [Fraction(w) / total for w in weights]
    plan = segments(dict.fromkeys(range(len(weights)), n), dict(enumerate(weights)))
    order = [s for p in plan for s in p["order"] * p["cycles"]][:n]
    seen = [0] * len(weights)
    for t, s in enumerate(order, 1):
        seen[s] += 1
        assert all(abs(k - p * t) < 1 for k, p in zip(seen, part, strict=True))


@pytest.mark.parametrize("seed", range(8))
def test_every_prefix_follows_the_target_when_sources_end(seed):
    rng = random.Random(seed)
    left = {s: rng.randrange(1, 60) for s in range(rng.randrange(1, 9))}
    weights = {s: rng.random() ** 3 + 1e-6 for s in left}
    order = [s for p in segments(left, weights, 7) for s in p["order"] * p["cycles"]]
    assert {s: order.count(s) for s in left} == left
    seen, had = dict.fromkeys(left, 0), dict.fromkeys(left, Fraction(0))
    for s in order:
        seen[s] += 1
        room = Fraction(1)
        while room:  # one slot shared by those that go on, in exact steps from end to end
            going = [x for x in left if had[x] < left[x]]
            whole = sum(Fraction(weights[x]) for x in going)
            step = min(room / whole, *((left[x] - had[x]) / Fraction(weights[x]) for x in going))
            for x in going:
                had[x] += step * Fraction(weights[x])
            room -= step * whole
        assert all(abs(seen[x] - had[x]) < 1 for x in left)


def test_a_source_without_weight_comes_last():
    order = [s for p in segments({"a": 3, "b": 2, "c": 4}, {"a": 1, "b": 0, "c": 2}) for s in p["order"]]
    assert order[7:] == ["b", "b"] and order.count("c") == 4


def test_mix_follows_the_given_weights(spark):
    """Blocks of one document each, through the tables: a weight of 0.9999 gives the other source 1 block of 10 000."""
    rows = [(i, "x" * 9, "a" if i else "b") for i in range(3000)] + [(9000 + i, "x" * 9, "b") for i in range(5)]
    found = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), {"a": 0.9999, "b": 0.0001}, block_bytes=10, slots=1000)
    at = sorted((r["slot"], r["source"]) for r in found.collect())
    assert [x for x, _ in at] == list(range(3005))
    assert [s for _, s in at[:2999]].count("b") <= 1


def test_mix_of_several_hundred_sources(spark):
    rng = random.Random(4)
    rows = [(i, "x" * 9, f"site{min(i % 500, rng.randrange(500))}") for i in range(6000)] + [(9000, "y" * 9, None)]
    got = sorted((r["slot"], r["source"], r["block"]) for r in mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_bytes=10, slots=700).collect())
    sizes = Counter(s for _, _, s in rows)
    assert len(sizes) > 400 and [x for x, _, _ in got] == list(range(6001))
    assert Counter(s for _, s, _ in got) == sizes
    weights, seen = {s: n**0.5 for s, n in sizes.items()}, Counter()
    until = min(n / weights[s] for s, n in sizes.items()) * sum(weights.values())
    for t, (_, s, block) in enumerate(got, 1):
        assert block == seen[s]
        seen[s] += 1
        assert t > until or all(abs(seen[x] - w * t / sum(weights.values())) < 1 for x, w in weights.items())


# -- pieces -------------------------------------------------------------------------------------------------------------------
TEXTS = [t for _, t in ROWS if t] + ["  two  spaces ", f"{BLANK}sign {BLANK}", "日本語" * 60, "\n\n\t", "x" * 400, "🙂 ok\x00"]


def best_score(v, text):
    best = [0.0] + [-math.inf] * len(text)
    for i in range(len(text)):
        for n in range(1, min(v.longest, len(text) - i) + 1):
            if known := v.prefixes.get(text[i:i + n]):
                best[i + n] = max(best[i + n], best[i] + known[0])
            elif n == 1:
                best[i + 1] = max(best[i + 1], best[i] + v.unknown)
    return best[-1]


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_stream_equals_the_whole_search(step):
    one = codec(vocabulary("piece_bpe_32k.model"))
    v = one.vocabulary
    for text, ids in zip(TEXTS, one.encode(TEXTS), strict=True):
        ids = np.frombuffer(ids, np.uint32).tolist()
        assert one.decode(np.array(ids, dtype=np.int64), np.array([0, len(ids)])).to_pylist() == [text]
        whole = BLANK + escaped(text)
        assert [i for part in stream(v, iter([whole[i:i + step] for i in range(0, len(whole), step)])) for i in part] == ids
        if not set(ids) & set(v.bytes_id.values()):
            assert math.isclose(sum(v.scores[i] for i in ids), best_score(v, whole), rel_tol=1e-9)


def test_ids_leave_before_the_end():
    """Without any certain boundary the paths still meet, and the window stays short."""
    letters = [BLANK, *"ab", "aa", "ab", "ba", "aab", "bb"]
    v = Vocabulary(letters, [-1.0 - 0.1 * i for i in range(len(letters))], ["normal"] * len(letters))
    rng = random.Random(4)
    text = BLANK + "".join(rng.choice("ab") for _ in range(5000))
    batches = list(stream(v, iter(text)))
    assert len(batches) > 20
    ids = [i for b in batches for i in b]
    assert "".join(letters[i] for i in ids) == text and math.isclose(sum(v.scores[i] for i in ids), best_score(v, text), rel_tol=1e-9)
    assert ids == at_once(v, text) or math.isclose(sum(v.scores[i] for i in at_once(v, text)), sum(v.scores[i] for i in ids), rel_tol=1e-9)


def test_the_library_agrees_on_scores():
    """The same vocabulary as a unigram model of the library gives segmentations of the same score."""
    sentencepiece = pytest.importorskip("sentencepiece")
    model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    path = vocabulary("piece_bpe_32k.model")
    proto = model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    v = Vocabulary.load(path)
    proto.trainer_spec.model_type = 1
    for piece, score in zip(proto.pieces, v.scores, strict=True):
        piece.score = score
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in TEXTS[:8]:
        ours = np.frombuffer(Codec(v).encode([text])[0], np.uint32).tolist()
        theirs = library.encode(text)
        assert math.isclose(sum(v.scores[i] for i in ours), sum(v.scores[i] for i in theirs), rel_tol=1e-4)


def test_encode_and_decode_tables(docs, empty):
    model = vocabulary("piece_bpe_32k.model")
    rows = decode_pieces(encode_pieces(docs, model), model, crc_col="crc").collect()
    assert {r["doc_id"]: r["decoded"] for r in rows} == {d: t or "" for d, t in ROWS}
    assert all(r["crc"] == zlib.crc32(np.array(r["piece_ids"], "<u4").tobytes()) for r in rows)
    assert encode_pieces(empty, model).count() == 0
    with pytest.raises(ValueError, match="taken"):
        encode_pieces(docs.withColumn("piece_ids", F.lit(1)), model)


# -- language model -----------------------------------------------------------------------------------------------------------
def test_scores(docs, empty):
    want, got = brute.unigram(ROWS), by_id(score_texts(docs), "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    for d, row in want.items():
        assert got[d][:4] == row[:4] and math.isclose(got[d][4], row[4], rel_tol=1e-9)
    assert score_texts(empty).count() == 0


@pytest.mark.parametrize("depth", [1, 2])
def test_probabilities_sum_to_one(depth):
    rng = np.random.default_rng(1)
    nodes, leaves = sum(lm.BUCKETS * lm.BRANCHES**d for d in range(depth)), lm.BRANCHES**depth
    model = lm.Model([rng.normal(size=(500 + own, 32)).astype(np.float32) for own in (1, lm.CLASSES, nodes)], depth, 500)
    ends = np.concatenate([np.arange(lm.FREQUENT + 1) * leaves, (lm.FREQUENT + 1) * leaves + np.arange(lm.BUCKETS * leaves)])
    codes = np.zeros(3 * len(ends), np.int32)
    codes[0::3], codes[1::3], codes[2::3] = 17 * leaves, 1000 * leaves + 5, ends
    logs = model.log_probabilities(codes, np.arange(0, 3 * len(ends), 3))
    assert math.isclose(np.exp(logs[2::3]).sum(), 1, rel_tol=1e-4)


@pytest.mark.parametrize("leaf_words", [4096, 0.01])
def test_scores_by_hand(spark, monkeypatch, leaf_words):
    """Every score by the plain walk down the tree, at a depth of one and of two."""
    monkeypatch.setattr(lm, "LEAF_WORDS", leaf_words)
    trained = []
    train = lm.train
    monkeypatch.setattr(lm, "train", lambda *args: trained.append(train(*args)) or trained[0])
    rng = random.Random(3)
    rows = [(d, " ".join(f"w{int(rng.paretovariate(0.2)) % 5000}" for _ in range(rng.randrange(60)))) for d in range(120)] + [(120, None), (121, "Unheard of")]
    got = {r["id"]: r["score"] for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert trained[0].depth == (1 if leaf_words > 1 else 2)
    counts = Counter(w for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2 for w in lm.words_of(t or ""))
    assert len(counts) > lm.FREQUENT
    want = brute.maxent_scores(rows, trained[0], counts, lm.FREQUENT, lm.BUCKETS)
    assert got.keys() == want.keys() and all(math.isclose(got[d], want[d], rel_tol=1e-5) for d in want)


def test_tree_and_rows_grow_with_the_corpus():
    assert [lm.depth_for(n) for n in (0, 1 << 20, 1 << 25, (1 << 25) + 1, 1 << 40)] == [1, 1, 1, 2, 3]
    assert lm.rows_for(0) == lm.LEAST_ROWS < lm.rows_for(10**8) < lm.rows_for(10**9) < lm.rows_for(10**12) == lm.MOST_ROWS


def test_sums_of_runs():
    rng = np.random.default_rng(2)
    times = rng.integers(1, 9, 300)
    rows, begins = rng.normal(size=(times.sum(), 4)), np.cumsum(times) - times
    assert np.allclose(lm._totals(rows, begins, times), np.add.reduceat(rows, begins, axis=0))
    keys = rng.integers(0, 1 << 18, 5000)
    assert (lm._order(keys) == np.argsort(keys, kind="stable")).all()


def test_contexts_help_among_rare_words(spark):
    """Thousands of words, each of which determines the next: those beyond the frequent ones have features of their own."""
    rng = random.Random(9)
    lexicon = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(4000)})
    rows = []
    for d in range(700):
        at = [rng.randrange(len(lexicon))]
        for _ in range(200):
            at.append((at[-1] * 7 + 3) % len(lexicon) if rng.random() < 0.95 else rng.randrange(len(lexicon)))
        rows.append((d, " ".join(lexicon[i] for i in at)))
    found = score_texts(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert found[1] > 0.85 * found[0]


def test_contexts_help_on_held_out_texts(spark):
    """Texts in which each word determines the next: the model beats the unigram base by far."""
    rng = random.Random(8)
    follow = {w: LEXICON[(i * 7 + 3) % len(LEXICON)] for i, w in enumerate(LEXICON)}
    rows = []
    for d in range(300):
        w = [rng.choice(LEXICON)]
        for _ in range(60):
            w.append(follow[w[-1]] if rng.random() < 0.9 else rng.choice(LEXICON))
        rows.append((d, " ".join(w)))
    found = score_texts(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert found[1] > 0.8 * found[0]


# -- token files --------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, docs, encoding):
    from tokenizers import Tokenizer

    path = scratch_dir(spark, "test-tokens")
    write_token_files(docs, path, vocabulary("byte_bpe_50k.json"), 2, encoding=encoding)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in digest_files(read_token_files(spark, path)).collect()}
    tokenizer, at = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), 0
    for d, t in ROWS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert got[d] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_files_are_ordered_and_have_page_indexes(spark, docs):
    import glob

    import pyarrow.parquet as pq

    path = scratch_dir(spark, "test-tokens")
    write_token_files(docs, path, vocabulary("byte_bpe_50k.json"), 2)
    ids = []
    for name in sorted(glob.glob(path.removeprefix("file:") + "/part-*")):
        file = pq.ParquetFile(name)
        ids += file.read(["doc_id"]).column(0).to_pylist()
        for g in range(file.metadata.num_row_groups):
            column = file.metadata.row_group(g).column(1)
            assert column.has_offset_index and column.has_column_index
    assert ids == sorted(ids) and len(ids) == len(ROWS)
    plan = read_token_files(spark, path).filter("doc_id = 5").select("n_tokens")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,5)" in plan and "ids" not in plan.split("ReadSchema")[-1]


def test_blanks_and_special_strings(spark):
    from tokenizers import Tokenizer

    texts = ["a  b", "a\n\n b", " x \n y\t\tz   ", "end  ", "a<|endoftext|> b", " \n \n ", "ünï cödé  ok", "  lead"]
    path = scratch_dir(spark, "test-tokens")
    write_token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, vocabulary("byte_bpe_50k.json"), 2)
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = {r["doc_id"]: list(r["ids"]) for r in read_token_files(spark, path).collect()}
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}


# -- secrets ------------------------------------------------------------------------------------------------------------------
def test_secrets(docs, empty):
    found = secret_scan(docs).select("id", listed(F.filter("found", lambda x: x["no"] < 3)).alias("base"), listed(F.col("found")).alias("spans"))
    got = by_id(found, "base", "spans")
    assert {d: v[0] for d, v in got.items()} == {d: brute.secrets(t)[4] for d, t in ROWS}
    assert any("endpoint" in v[1] for v in got.values())
    assert secret_scan(empty).count() == 0


def test_weak_parts_need_company(spark):
    alone, mixed = "see https://host.example/path for more", "aB3" + "xY9zQ1" * 4
    rows = [(0, alone), (1, mixed), (2, f"{alone} with {mixed}"), (3, f"{alone} {'x ' * 300} {mixed}"), (4, f"user_id: bob99 ... {mixed}"), (5, "token: é abc token = ééé secret:'abcdefgh'")]
    got = by_id(secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).select("id", listed(F.col("found")).alias("s")), "s")
    assert got[0] == got[1] == got[3] == ("",)
    assert [x.split(":")[0] for x in got[2][0].split(",")] == ["endpoint", "credential"]
    assert [x.split(":")[0] for x in got[4][0].split(",")] == ["identifier", "credential"]
    assert got[5] == (brute.secrets(rows[5][1])[4],)


def test_odd_pieces_have_no_ids_and_others_are_encoded_once():
    """Odd pieces were None, so that every lookup had to tell them from absent ones."""
    import public_tokenizers

    from tickloom.llm.tokens import SpaceCodec

    codec = SpaceCodec(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = ["word", " odd", "word,", "\nword"]
    first = codec.later.values(pieces)
    codec.later.encode = lambda wanted: [] if not wanted else pytest.fail(f"{wanted} encoded again")
    assert first[1] == b"" and all(first[i] for i in (0, 2, 3)) and codec.later.values(pieces) == first
