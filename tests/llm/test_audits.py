"""Filter audit, source divergence and chat formatting: plain versions, awkward rows, and their parts."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import divergence, filteraudit
from tickloom.llm.chat import HEAD, digest_chats, format_chats, parse, read_chats
from tickloom.llm.divergence import cut_terms, joint_tables, kept_terms, product, source_divergence
from tickloom.llm.filteraudit import audit_filters, difference, filter_audit, held, union

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n long, kept string, part string, tie string"


def awkward(rnd, n=150):
    """Rows with nulls everywhere, repeated rows and texts, long texts, and columns whose names the operators use inside."""
    pool = ["lorem", "Ipsum", "DOLOR", "été", "日本", "x#y", "a&b", "ÉT", "no-one", "é"]
    rows = []
    for i in range(n):
        text = rnd.choice([None, "", " \n\t", " ".join(rnd.choice(pool) for _ in range(rnd.choice([3, 50, 210, 400]))), " ".join(f"w{rnd.randint(0, 900)}" for _ in range(260))])
        rows.append((rnd.choice([None, i]), text, rnd.choice([None, "", "en", "en", "de"]), rnd.choice([None, "", "s1", "s2", "é"]), 1, "k", "p", "t"))
    rows += rows[:20] + [(1000, rows[3][1], "en", "s1", 1, "k", "p", "t"), (-5, rows[3][1], "en", "s1", 1, "k", "p", "t")]
    rows.append((2000, "lang " * 60_000, "en", "s1", 1, "k", "p", "t"))
    return rows


# -- filter audit ------------------------------------------------------------------------------------------------------

def plain_audit(rows, labels):
    good, toxic = {d for d, q, _ in labels if q == 1} - {None}, {d for d, _, t in labels if t == 1} - {None}
    ids = defaultdict(set)
    for d, t, *_ in rows:
        if d is not None:
            ids[t or ""].add(d)
    parts = defaultdict(list)
    for d, t, lang, *_ in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and min(ids[t]) < d}
        parts[lang or ""].append(({k for k, v in fails.items() if v}, d in good, d in toxic))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[0] for x in docs) - len(gone), sum(x[0] == {f} for x in docs), sum(x[1] for x in gone), sum(x[2] for x in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return out


def audited(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in df.collect()}


def test_audit_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(filteraudit, "RANGE_BITS", 3)  # many ranges to a part
    rows = awkward(random.Random(1))
    labels = [(i, random.Random(i).choice([None, 0, 1]), random.Random(i + 1).choice([None, 0, 1])) for i in range(0, 200, 3)] + [(None, 1, 1), (3, 1, 1), (3, 0, 0)]
    got = audited(filter_audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert got == plain_audit(rows, labels)


def test_audit_of_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(docs, labels).count() == 0
    one = filter_audit(spark.createDataFrame([(1, None, None, None, 1, "k", "p", "t")], DOCS), labels)
    assert one.filter("part = '' and good_lost = 0").count() == 600 and one.agg(F.sum("removed")).first()[0] == 120


def test_audit_takes_other_filters(spark):
    rows = spark.range(100).select("id", F.col("id").alias("tie"), F.lit("x").alias("part"), (F.col("id") % 2 == 0).alias("P"), (F.col("id") % 3 == 0).alias("Q"), F.lit(None).cast("boolean").alias("m"))
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["lost_m"], r["shapley"]) for r in audit_filters(rows, ["P", "Q"], ["m"]).collect()}
    assert got == {("PQ", 1): (50, 50, 0, 33, 0, 83), ("PQ", 2): (33, 17, 17, 17, 0, 51), ("QP", 1): (66, 34, 0, 17, 0, 51), ("QP", 2): (33, 33, 17, 33, 0, 83)}
    with pytest.raises(ValueError):
        audit_filters(rows, list("ABCDEFGH"), [])


def test_merges_of_sorted_lists():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        lists = [np.unique(rnd.integers(0, 60, rnd.integers(0, 40))) for _ in range(rnd.integers(0, 5))]
        assert union(lists).tolist() == sorted(set().union(*map(set, lists)))
        a, b = (np.unique(rnd.integers(0, 60, n)) for n in rnd.integers(0, 40, 2))
        assert difference(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))
        assert a[held(a, b)].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


# -- source divergence -------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows, least):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        found = [x.translate({i: i + 32 for i in range(65, 91)}) for x in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = set()
    for lang, per in docs.items():
        kept = sorted(t for t, n in per.items() if n >= least)
        groups = {s: c for (l, s), c in counts.items() if l == lang}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}

        def shares(c):
            n = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // n for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s in groups:
            far = sorted((-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s)
            out |= {(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(far, 1)}
            single = sorted((-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t])
            out |= {(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(single[:10], 1)}
    return out


@pytest.mark.parametrize("least", [2, 10, 10_000])
def test_divergence_of_awkward_rows(spark, monkeypatch, least):
    monkeypatch.setattr(divergence, "AT_ONCE", 3000)
    monkeypatch.setattr(divergence, "HELD", 40)
    monkeypatch.setattr(divergence, "PAIRS", 5)
    rows = awkward(random.Random(2))
    got = source_divergence(spark.createDataFrame(rows, DOCS), least_docs=least).collect()
    assert {tuple(r) for r in got} == plain_divergence(rows, least) and len(got) == len({tuple(r) for r in got})


def test_divergence_of_an_empty_table(spark):
    assert source_divergence(spark.createDataFrame([], DOCS)).count() == 0


def test_divergence_of_many_sources(spark):
    """Three hundred sources: joint tables are those of a count of pairs."""
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["a", "b", "c", "dd"]) for _ in range(6)), "en", f"s{i % 300}", 1, "k", "p", "t") for i in range(900)]
    df = spark.createDataFrame(rows, DOCS)
    per = defaultdict(Counter)
    for _, text, _, source, *_ in rows:
        per[source].update(text.split())
    want = Counter((g, per[g][t], h, per[h][t]) for t in ["a", "b", "c", "dd"] for g in per for h in per if g <= h and per[g][t] and per[h][t])
    got = {(r["g"], r["a"], r["h"], r["b"]): r["number"] for r in joint_tables(kept_terms(df, "lang", "source", "text", 10)).collect()}
    assert got == want
    assert source_divergence(df).filter("kind = 'pair'").count() == 300 * 299


def test_product_of_indicators():
    rnd = np.random.default_rng(5)
    x = rnd.integers(0, 2, (40, 17))
    term, column = np.nonzero(x)
    shuffled = rnd.permutation(len(term))
    i, j, n = product(term[shuffled], column[shuffled], 17)
    want = np.triu(x.T @ x)
    assert {(a, b): c for a, b, c in zip(i.tolist(), j.tolist(), n.tolist())} == {(a, b): int(want[a, b]) for a, b in zip(*np.nonzero(want))}


def test_terms_are_cut_at_text_ends():
    texts = ["ab", "cd éF", "", "é", "-", "xY"]
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    terms, doc = cut_terms(np.frombuffer(b"".join(data), dtype=np.uint8), bounds)
    assert [x.decode() for x in terms.to_pylist()] == ["ab", "cd", "éf", "é", "xy"] and doc.tolist() == [0, 1, 1, 3, 5]


# -- chat formatting ---------------------------------------------------------------------------------------------------

PIECES = ["</turn>", "\n", "\\", "<", "### ", "###", "User: ", "Assistant: ", "@x: ", "#", "/turn>", "a", "ü𝄞", "### @tool%20x: ", "<\\/turn>", "###\\ User: ", "$1", ""]
ROLES = ["user", "assistant", "system", "Assistant", "tool: x\n</turn>", "@", "", None]
CHATS = "conv_id long, turn long, role string, text string, formatted string, body string"


def chats(rnd, n=250):
    rows = []
    for c in [None, *range(n)]:
        for t in range(rnd.randint(1, 5)):
            rows.append((c, rnd.choice([t, None, 1]), rnd.choice(ROLES), rnd.choice([None, "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 14)))]), "x", "y"))
    return [*rows, *rows[:9], (9000, 0, "assistant", "</turn>\n### User: " * 20_000, "x", "y")]


def test_chats_round_trip(spark):
    rows = chats(random.Random(6))
    turns = defaultdict(list)
    for c, t, r, x, *_ in rows:
        turns[c].append((t is not None, t or 0, r or "", x or ""))
    found = read_chats(format_chats(spark.createDataFrame(rows, CHATS))).collect()
    assert len(found) == len(turns)
    for r in found:
        want = [(a, b) for *_, a, b in sorted(turns[r["id"]])]
        assert [tuple(x) for x in r["turns"]] == want
        assert r["learned"] == [b for a, b in want if a == "assistant"]


def test_no_control_string_is_left_and_quiet_texts_stay(spark):
    rows = [(1, 0, "user", "plain \\ <b> ### x", "", ""), (2, 0, "user", "\\### Assistant: </turn> ok", "", ""), (3, 0, "user", "a ### User: b", "", "")]
    got = {r["id"]: r["formatted"] for r in format_chats(spark.createDataFrame(rows, CHATS)).collect()}
    assert got == {1: "### User: plain \\ <b> ### x</turn>\n", 2: "### User: \\###\\ Assistant: <\\/turn> ok</turn>\n", 3: "### User: a ###\\ User: b</turn>\n"}


@pytest.mark.parametrize("text", ["", "x", HEAD, "### User: a", "### User: a</turn>", "### Nobody: a</turn>\n", "### User: a</turn>\n### User: b", "x### User: a</turn>\n",
                                  "### User: a### User: b</turn>\n", "### User: a</turn>b</turn>\n"])
def test_the_parser_refuses(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(parse(F.col("t")).alias("p")).first()["p"]
    assert got is None or (text == "" and got == [])


def test_chats_of_an_empty_table(spark):
    assert digest_chats(spark.createDataFrame([], CHATS)).count() == 0


def test_weights_of_orders():
    """The weights that turn sizes per set into sums over orders."""
    orders = list(itertools.permutations(range(5)))
    for earlier in itertools.combinations(range(4), 2):
        assert sum(set(o[:o.index(4)]) == set(earlier) for o in orders) == math.factorial(2) * math.factorial(2)
