import random

from rollcall.llm.mixing import mix, plan_amounts

SIZED, TARGETS = "doc_id long, source string, n_tokens long, position string", "source string, target_share double, max_repeats int"


def test_amounts_fill_up():
    plan = {a.source: a for a in plan_amounts([("a", 0.5, 1, 100), ("b", 0.4, 4, 900), ("c", 0.1, 2, 0), ("d", None, None, 50), ("e", 0.0, 3, 10)], 1060)}
    assert plan["a"].amount == 100 and plan["b"].amount == 960 and plan["c"].amount == plan["d"].amount == plan["e"].amount == 0
    assert abs(sum(a.slope * a.amount for a in plan.values())) < 1e-6 and all(abs(a.slope) <= 1 for a in plan.values())
    assert plan_amounts([], 0) == []


def test_mix_against_its_targets(spark):
    r = random.Random(2)
    docs = [(i, r.choice("aaaaaaabbc"), r.randint(0, 60), "clash") for i in range(2000)]
    docs += [(5000 + i, None, 5, None) for i in range(10)]
    targets = [("a", 0.4, 1), ("b", 0.4, 3), ("c", 0.2, 2), ("none", 0.1, 5), ("a", 0.4, 1)]
    mixed, report = mix(spark.createDataFrame(docs, SIZED), spark.createDataFrame(targets, TARGETS), bucket_rows=100)
    rows = mixed.collect()
    shares = {x.source: x for x in report.collect()}
    have = {s: sum(n for _, t, n, _ in docs if t == s) for s in "abc"}
    total = sum(n for _, _, n, _ in docs)
    assert [x.position for x in rows] == sorted(x.position for x in rows)
    assert all(x.n_tokens > 0 for x in rows) and len({(x.doc_id, x.repeat_no) for x in rows}) == len(rows)
    wanted = {a.source: a.amount for a in plan_amounts([("a", 0.4, 1, have["a"]), ("b", 0.4, 3, have["b"]), ("c", 0.2, 2, have["c"]), ("none", 0.1, 5, 0)], total)}
    for s in "abc":
        assert abs(shares[s].mixed_tokens - wanted[s]) <= 60 and shares[s].most_repeats <= {"a": 1, "b": 3, "c": 2}[s]
        assert shares[s].mixed_tokens == sum(x.n_tokens for x in rows if x.source == s)
    assert shares["none"].mixed_tokens == 0 and shares[None].mixed_tokens == 0 and abs(sum(x.actual_share for x in shares.values()) - 1) < 1e-9
    # a rising source has more of its tokens late than a falling one
    late = lambda s: sum(x.n_tokens for x in rows if x.source == s and x.position > total / 2) / shares[s].mixed_tokens
    assert late("b") > late("a")


def test_empty_tables(spark):
    mixed, report = mix(spark.createDataFrame([], SIZED), spark.createDataFrame([], TARGETS))
    assert mixed.collect() == [] and report.collect() == []
