"""Randomised checks against pure-Python brute force (small tables, few
examples: each example is a Spark job)."""

import datetime as dt
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablekit.operators import analytics as A
from tablekit.operators import dedup as D

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

events = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 7200)), min_size=1, max_size=40)


@SETTINGS
@given(events)
def test_sessionize_matches_brute_force(spark, evs):
    data = [(u, T0 + dt.timedelta(seconds=s), i) for i, (u, s) in enumerate(evs)]
    df = spark.createDataFrame(data, "u long, t timestamp_ntz, id long")
    got = {r.id: r.session_id for r in A.sessionize(df, "u", "t", gap="10 minutes", tie_break=["id"],
                                                     rows_per_segment=3).collect()}
    expect = {}
    by_user = defaultdict(list)
    for u, t, i in data:
        by_user[u].append((t, i))
    for rows in by_user.values():
        rows.sort()
        sid, prev = 0, None
        for t, i in rows:
            if prev is None or (t - prev).total_seconds() > 600:
                sid += 1
            expect[i] = sid
            prev = t
    assert got == expect


@SETTINGS
@given(events)
def test_burst_matches_brute_force(spark, evs):
    data = [(u, T0 + dt.timedelta(seconds=s), i) for i, (u, s) in enumerate(evs)]
    df = spark.createDataFrame(data, "u long, t timestamp_ntz, id long")
    got = {r.id: r.events_in_window for r in
           A.burst_events(df, "u", "t", window="5 minutes", min_count=1, bucket="5 minutes").collect()}
    expect = {i: sum(1 for u2, t2, _ in data if u2 == u and t - dt.timedelta(minutes=5) <= t2 <= t)
              for u, t, i in data}
    assert got == expect


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 6)), min_size=1, max_size=40),
       st.integers(1, 4))
def test_market_basket_matches_brute_force(spark, lines, k):
    df = spark.createDataFrame(lines, "o long, p long")
    got = sorted((r.product_a, r.product_b, r.pair_count, r.rank)
                 for r in A.market_basket_pairs(df, "o", "p", max_rank=k, block_size=2).collect())
    counts = Counter()
    by_order = defaultdict(list)
    for o, p in lines:
        by_order[o].append(p)
    for ps in by_order.values():
        for a in ps:
            for b in ps:
                if a < b:
                    counts[(a, b)] += 1
    expect = []
    for pair, c in counts.items():
        rank = 1 + sum(1 for c2 in counts.values() if c2 > c)
        if rank <= k:
            expect.append((pair[0], pair[1], c, rank))
    assert got == sorted(expect)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), min_size=1, max_size=30))
def test_dedup_partitions_rows(spark, rows):
    data = [(k, o, i) for i, (k, o) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, o long, id long")
    firsts = {r.id for r in D.dedup_keep_first(df, "k", ["o", "id"]).collect()}
    dups = {r.id for r in D.find_duplicates(df, "k", ["o", "id"]).collect()}
    best = {}
    for k, o, i in data:
        if k not in best or (o, i) < best[k]:
            best[k] = (o, i)
    assert firsts == {v[1] for v in best.values()}
    assert dups == {i for _, _, i in data} - firsts


@SETTINGS
@given(st.lists(st.integers(0, 50), min_size=1, max_size=25), st.integers(1, 5))
def test_customer_tiers_is_ntile(spark, amounts, parts):
    data = [(i, float(a)) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(data, "c long, amt double")
    labels = ("t1", "t2", "t3", "t4")
    got = {r.c: r.customer_segment for r in
           A.customer_tiers(df, "c", "amt", labels=labels, num_partitions=parts).collect()}
    order = sorted(data, key=lambda r: (-r[1], r[0]))
    n, k = len(order), len(labels)
    q, r = divmod(n, k)
    expect, pos = {}, 0
    for tile in range(k):
        size = q + (1 if tile < r else 0)
        for c, _ in order[pos:pos + size]:
            expect[c] = labels[tile]
        pos += size
    assert got == expect


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 8), st.sampled_from(["a", "b", None])), max_size=12),
       st.lists(st.tuples(st.integers(0, 8), st.sampled_from(["a", "b", "c", None])), max_size=12))
def test_scd2_merge_output_passes_checks(spark, current_rows, new_rows):
    from pyspark.sql import functions as F
    from tablekit.operators import scd2 as S
    t0 = dt.datetime(2020, 1, 1)
    seen, cur = set(), []
    for i, (k, a) in enumerate(current_rows):
        if k not in seen:                                   # a valid dimension: one current row per key
            seen.add(k)
            cur.append((i + 1, k, a, t0, None, True))
    current = spark.createDataFrame(cur, "SurrogateKey long, k long, a string, Start_Date timestamp_ntz, "
                                         "End_Date timestamp_ntz, Flg_Is_Current boolean")
    new = spark.createDataFrame([(k, a, i) for i, (k, a) in enumerate(new_rows)], "k long, a string, n long")
    out = S.scd2_merge(new, current, "k", ["a"], now=F.lit("2024-01-01").cast("timestamp_ntz"),
                       tie_break=["n"])
    assert S.scd2_single_current(out, "k", "Flg_Is_Current").count() == 0
    assert S.scd2_overlaps(out, "k", "Start_Date", "End_Date", mode="any").count() == 0
    keys = [r.SurrogateKey for r in out.collect()]
    assert len(keys) == len(set(keys))                       # surrogate keys stay unique
    assert out.filter("Flg_Is_Current").count() == len(seen | {k for k, _ in new_rows})
