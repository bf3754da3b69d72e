"""Custom operators against brute-force Python on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from touchline.operators.reconcile import reconcile

names = st.sampled_from(["ana", "bo", "cy", None])
ages = st.sampled_from([20, 21, 22, None])
targets = st.lists(st.tuples(names, ages), min_size=1, max_size=12)
sources = st.lists(st.tuples(names, ages, st.sampled_from([None, None, None, 999])), min_size=1, max_size=40)
PASSES = [["k_name", "k_age"], ["k_name"]]


def brute(src, tgt):
    out = {}
    for sid, (name, age, linked) in enumerate(src):
        row = {"k_name": name, "k_age": age}
        if linked is not None:
            out[sid] = (linked, 0, None)
            continue
        out[sid] = (None, None, None)
        for p, keys in enumerate(PASSES, start=1):
            cand = [tid for tid, (tn, ta) in enumerate(tgt)
                    if all(row[k] is not None and row[k] == {"k_name": tn, "k_age": ta}[k] for k in keys)]
            if cand:
                out[sid] = (min(cand), p, len(cand))
                break
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sources, targets, st.integers(1, 6))
def test_reconcile_matches_brute_force(spark, src, tgt, hot_rows):
    s_df = spark.createDataFrame(
        [(i, n, a, l) for i, (n, a, l) in enumerate(src)], "src long, k_name string, k_age int, id long"
    )
    t_df = spark.createDataFrame([(i, n, a) for i, (n, a) in enumerate(tgt)], "id long, k_name string, k_age int")
    out = reconcile(s_df, t_df, PASSES, "id", "id", hot_key_rows=hot_rows)
    got = {r.src: (r.id, r.matched_pass, r.n_candidates) for r in out.collect()}
    assert got == brute(src, tgt)
    assert out.count() == len(src)


keyed_values = st.dictionaries(st.sampled_from(["a", "b", "c", "d"]), st.one_of(st.none(), st.integers(-3, 3)), max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed_values, keyed_values)
def test_diff_report_matches_brute_force(spark, before, after):
    from touchline.operators.compare import Measure, diff_report

    b = spark.createDataFrame(list(before.items()) or [("zz", 0)], "k string, v int").filter("k != 'zz'")
    a = spark.createDataFrame(list(after.items()) or [("zz", 0)], "k string, v int").filter("k != 'zz'")
    m = Measure("v", "v", "vb", "va", fill=False, gap="gap")
    got = {r.k: (r.vb, r.va, r.gap) for r in diff_report(b, a, ["k"], [m]).collect()}
    want = {}
    for k in set(before) | set(after):
        vb, va = before.get(k), after.get(k)
        if (vb or 0) != (va or 0):
            want[k] = (vb, va, (va or 0) - (vb or 0))
    assert got == want


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.one_of(st.none(), st.integers(0, 5))), min_size=1, max_size=30))
def test_best_per_group_matches_brute_force(spark, rows):
    from touchline.operators.ranking import best_per_group, desc

    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id long, g string, v int")
    got = {r.g: r.id for r in best_per_group(df, ["g"], [desc("v")], tie=["id"]).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        members = [(i, v) for i, (gg, v) in enumerate(rows) if gg == g]
        # DESC with NULLs first, then the lowest id.
        members.sort(key=lambda iv: (iv[1] is not None, -(iv[1] or 0), iv[0]))
        want[g] = members[0][0]
    assert got == want
