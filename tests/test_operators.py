import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators import search
from rollcall.operators.attribute import attribute
from rollcall.operators.components import connected_components
from rollcall.operators.dedupe import descending, keep_best, nulls_last
from rollcall.operators.identity import identity_edges, refused_pairs
from rollcall.operators.ordinals import number_rows
from rollcall.operators.resolve import FormBlock, best_forms, indel_ratio, lookup, resolve
from rollcall.operators.upsert import insert_or_ignore, merge_stats, mint_ids, snapshot_join, upsert


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_keep_best_with_nulls_and_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, None, "z"), (None, 1, "w"), ("b", 3, "q"), ("b", 3, "p")], "k string, n int, v string")
    assert rows(keep_best(df, ["k"], [descending(F.col("n"))])) == [("a", 2, "y"), ("b", 3, "p"), (None, 1, "w")]
    assert rows(keep_best(df, ["k"], [nulls_last(F.col("n"))]))[0] == ("a", 1, "x")
    assert rows(keep_best(df.limit(0), ["k"], [F.col("n")])) == []


def test_upsert_is_idempotent_and_guarded(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(2, ""), (3, "z"), (None, "m")], "k int, v string")
    once = upsert(a, b, ["k"])
    assert rows(once) == rows(upsert(once, b, ["k"])) == [(1, "x"), (2, ""), (3, "z"), (None, "m")]
    kept = snapshot_join(a, b, ["k"], (F.col("n_v") == "") & (F.col("o_v") != ""))
    assert (2, "y", "kept") in rows(kept)
    assert rows(merge_stats(kept, [])) == [(1, 1, 2)]


def test_minted_ids_are_stable(spark):
    state = spark.createDataFrame([("b", 7)], "k string, id long")
    keys = spark.createDataFrame([(x,) for x in ["c", "a", "b", None, "a"]], "k string")
    first = mint_ids(state, keys, "k", "id")
    assert rows(first) == [("a", 8), ("b", 7), ("c", 9)] and rows(mint_ids(first, keys, "k", "id")) == rows(first)


def test_insert_or_ignore_keeps_null_keys(spark):
    t = spark.createDataFrame([(1, "x")], "k int, v string")
    new = spark.createDataFrame([(1, "y"), (None, "a"), (None, "b"), (2, "z")], "k int, v string")
    assert rows(insert_or_ignore(t, new, ["k"])) == [(1, "x"), (2, "z"), (None, "a"), (None, "b")]


def test_components_against_union_find(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(50)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 230)] + [(None, 3)]
    root = {n: n for e in edges for n in e if n is not None and None not in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {n: find(n) for n in root}
    assert connected_components(spark.createDataFrame([], "a int, b int")).collect() == []


def test_search(spark):
    docs = spark.createDataFrame([(1, "abc def abc", "g"), (2, "abc xyz", "g"), (3, None, "g"), (4, "", "h"), (5, "def", "h")], "id int, t string, g string")
    assert rows(search.document_frequency(docs, "id", "t", 1.0)) == [("abc", 2), ("def", 2)]
    assert rows(search.postings(docs, "id", "t", F.col("g"))) == [("g", "abc", 0), ("g", "abc", 1), ("g", "def", 0), ("g", "xyz", 1), ("h", "def", 0)]
    assert rows(search.positional_postings(docs, "id", "t", 2)) == [(0, "abc", 0), (0, "abc", 1), (0, "def", 0), (1, "def", 2)]


def test_ratio_and_resolve(spark):
    assert indel_ratio("abc", "abc") == 100 and round(indel_ratio("kitten", "sitting"), 2) == 61.54 and indel_ratio("", "") == 100
    persons = spark.createDataFrame([("p1", "Shri Ram Lal Gopal"), ("p2", "Mohan Das"), ("p3", "Mohan Das")], "pid string, n string")
    names = spark.createDataFrame([(x,) for x in ["Ram Lal Gopal", "Mohan Das", "Ram Lal Gopall", "Nobody Here", "", "Shri"]], "raw string")
    got = {r.raw: (r.pid, r.status) for r in resolve(names, lookup(persons, "pid", "n")).collect()}
    assert got["Ram Lal Gopal"] == ("p1", "exact") and got["Mohan Das"] == (None, "ambiguous_exact") and got["Ram Lal Gopall"] == ("p1", "fuzzy_high")
    assert got["Nobody Here"][1] == "unmatched" and got[""][1] == "empty"


def test_waterfall(spark):
    row = "row_id int, year int, state string, seat string, party string, name string, won boolean, source_id string"
    data = [
        (1, 2019, "s", "seat", "P", "gopal ram", False, "t1"), (2, 2019, "s", "bangalore cent", "P", "hari zed", True, None), (3, 2014, "s", "other", "Q", "x", False, "t2"),
        (4, 2014, "s", "other", "R", "y", True, "t3"), (5, 2009, "s", "else", "R", "y", False, "t3"), (6, 2024, "s", "old", "Z", "gopal ram", False, "t9"), (7, 2014, "s", "none", "Z", "n", False, "t8"),
    ]
    terms = spark.createDataFrame([("p1", 2019, "s", "seat", "P", "gopal ram"), ("p2", 2019, "s", "bangalore central", "P", "hari zed")], "pid string, year int, state string, seat string, party string, name string")
    history = spark.createDataFrame([("p1", "s", "old", "gopal ram")], "pid string, state string, seat string, name string")
    bridge = spark.createDataFrame([("t2", "p7")], "source_id string, pid string")
    got = rows(attribute(spark.createDataFrame(data, row), terms, bridge, history, 2024))
    assert got == [(1, "p1", "A"), (2, "p2", "A"), (3, "p7", "B"), (4, "TCPD:t3", "C"), (5, "TCPD:t3", "C"), (6, "p1", "D")]


def test_resolve_takes_the_best_of_all_forms(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abdeghiklmnoprstuvy") for _ in range(r.randint(4, 13)))
    known = [" ".join(word() for _ in range(r.randint(1, 3))) for _ in range(120)] + ["ram lal " + word() * 7, "asheswar undivangadarkiyan", "pqrs"]
    slip = lambda s: "".join(c for c in s if r.random() > 0.06)
    typed = ["asheswwar undivangararkiyan", *(x for k in known for x in (slip(k), " ".join(reversed(k.split())), word() + " " + word()))]
    persons = spark.createDataFrame([(f"p{i}", k) for i, k in enumerate(known)], "pid string, n string")
    forms = lookup(persons, "pid", "n")
    key = lambda s: " ".join(sorted(s.split()))
    best = {}
    for x in best_forms(spark.createDataFrame([(t,) for t in typed], "form string"), forms, 50).collect():
        best.setdefault(x.form, []).append((x.score, x.other))
    for t in typed:
        score = max(indel_ratio(key(t), key(k)) for k in known)
        assert max(best[t])[0] == score and {o for s, o in best[t] if s == score} == {k for k in known if indel_ratio(key(t), key(k)) == score}
    got = {x.raw: x for x in resolve(spark.createDataFrame([(t,) for t in typed], "raw string"), forms).collect()}
    assert got[typed[0]].pid == f"p{len(known) - 2}" and (got[typed[0]].status, got[typed[0]].score) == ("review", 94) and len(got) == len(set(typed))
    assert {x.status for x in resolve(spark.createDataFrame([("abc",)], "raw string"), forms.limit(0)).collect()} == {"unmatched"}


def test_only_pairs_that_may_be_best_are_compared(monkeypatch):
    r, compared = random.Random(4), []
    word = lambda: "".join(r.choice("abdeghiklmnoprstuvy") for _ in range(r.randint(4, 13)))
    forms = sorted({f"{word()} {word()}" for _ in range(800)} | {"ram " * 20 + "lal", "ab", "ba", "a" * 30, "नाम देवी"})
    typed = ["".join(c for c in f if r.random() > 0.06) for f in r.sample(forms, 150)] + ["ram " * 20 + "la", "ax", "zzz", "a" * 29 + "b", "नाम देव", word() + " " + word()]
    ratios = FormBlock.ratios
    monkeypatch.setattr(FormBlock, "ratios", lambda self, *a: compared.append(len(a[-1])) or ratios(self, *a))
    every = [[indel_ratio(t, f) for f in forms] for t in typed]
    want = {(i, j, x[j]) for i, x in enumerate(every) for j in range(len(forms)) if x[j] == max(x)}
    # from nothing known, from a ratio that some form has, and from one that none of the forms has
    for least, rows in (([0.0] * len(typed), want), ([max(x[:100]) for x in every], want), ([100.1] * len(typed), set())):
        compared.clear()
        q, f, score = FormBlock(forms).best(typed, least, 16)
        assert set(zip(q.tolist(), f.tolist(), score.tolist())) == rows
    compared.clear()
    FormBlock(forms).best(typed[:150], [max(x) for x in every[:150]])
    assert sum(compared) < 0.02 * 150 * len(forms)


def test_unfinished_components_are_an_error(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a int, b int")
    with pytest.raises(RuntimeError, match="converged"):
        connected_components(path, 2)
    assert {r.component for r in connected_components(path).collect()} == {0}


def test_identity_edges_against_the_rule_on_pairs(spark):
    r = random.Random(9)
    nodes = [(i, r.choice(["", "a", "b", "c"]), r.choice([None, None, "1", "2", "3"]), r.choice([None, *"uvwxyz"])) for i in range(90)]

    def one(x, y):
        if x[1] and x[1] == y[1] and x[2] and x[2] == y[2]:
            return True
        if x[3] is None or x[3] != y[3]:
            return False
        return x[2] == y[2] if x[2] and y[2] else not x[1] or not y[1] or x[1] == y[1]

    label = {x[0]: x[0] for x in nodes}
    for _ in nodes:
        for x in nodes:
            for y in nodes:
                if one(x, y):
                    label[x[0]] = label[y[0]] = min(label[x[0]], label[y[0]])
    df = spark.createDataFrame(nodes, "node int, name string, day string, link string")
    assert {x.node: x.component for x in connected_components(identity_edges(df)).collect()} == label
    want = {}
    for x in nodes:
        for y in nodes:
            if x[0] < y[0] and x[3] and x[3] == y[3]:
                apart = x[2] != y[2] if x[2] and y[2] else bool(x[1] and y[1] and x[1] != y[1])
                want[x[3]] = want.get(x[3], 0) + apart
    assert {x.link: x.refused for x in refused_pairs(df).collect()} == {k: v for k, v in want.items() if v}
    assert identity_edges(df.limit(0)).collect() == [] and refused_pairs(df.limit(0)).collect() == []


def test_orders_keep_every_bit_and_maps(spark):
    df = spark.createDataFrame([(1, 9007199254740992, {"b": 1, "a": 2}), (1, 9007199254740993, {"x": 1}), (2, None, None), (2, -5, {})], "k int, n long, m map<string,int>")
    assert {(x.k, x.n) for x in keep_best(df, ["k"], [descending(F.col("n"))]).collect()} == {(1, 9007199254740993), (2, -5)}
    assert [x.m for x in keep_best(df, ["k"], [descending(F.col("n"))]).orderBy("k").collect()] == [{"x": 1}, {}]


def test_numbers_of_rows(spark):
    r = random.Random(4)
    data = [(r.choice(["hot", "hot", "hot", "b", None]), i) for i in range(200)]
    got = number_rows(spark.createDataFrame(data, "g string, n int"), ["g"], [F.desc("n")], "place").collect()
    want = {(g, n): 1 + sum(1 for h, m in data if h == g and m > n) for g, n in data}
    assert {(x.g, x.n): x.place for x in got} == want
    assert number_rows(spark.createDataFrame([], "g string, n int"), [], [F.col("n")], "place").collect() == []
