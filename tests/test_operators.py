"""Operators against brute force or the SQL they replace."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderlens.operators import latest_per_key, left_join_within, not_in, presence_flags, union_positional


def _bag(rows):
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_left_join_within_equals_brute_force(spark, seed):
    """Binned join == every (left, right) pair with equal key and |dt| < gap; unmatched left kept once.
    One key holds most rows (a hot subscriber) and gaps sit on the +-gap boundary (T9)."""
    rnd = random.Random(seed)
    gap = 100
    left = [(i, "hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 5)}", rnd.randint(0, 2000)) for i in range(300)]
    left.append((999, None, 50))
    left.append((1000, "k1", None))
    right = [(j, "hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 7)}", rnd.randint(0, 2000)) for j in range(400)]
    right += [(5000, "edge", 1000 + gap - 1), (5001, "edge", 1000 + gap), (5002, "edge", 1000 - gap),
              (5003, "edge", 1000 - gap + 1)]
    left.append((2000, "edge", 1000))
    ldf = spark.createDataFrame(left, "lid int, lkey string, lt long")
    rdf = spark.createDataFrame(right, "rid int, rkey string, rt long")
    got = left_join_within(ldf, rdf, [("lkey", "rkey")], F.col("lt"), F.col("rt"), gap).select("lid", "rid")
    expected = []
    for lid, lk, lt in left:
        hits = [rid for rid, rk, rt in right if lk is not None and lt is not None and rt is not None
                and lk == rk and abs(rt - lt) < gap]
        expected += [(lid, h) for h in hits] or [(lid, None)]
    assert _bag(got.collect()) == _bag(expected)
    edge = {r["rid"] for r in got.where("lid = 2000").collect()}
    assert edge == {5000, 5003}  # 99 s in, 100 s out, -100 s out, -99 s in


def test_not_in_null_semantics(spark):
    """T11 / M6: NOT IN is null-aware; compare with Spark SQL's own NOT IN subquery."""
    cases = {
        "plain": ([("a",), ("b",), (None,)], [("b",), ("c",)]),
        "null_in_list": ([("a",), ("b",)], [("b",), (None,)]),
        "empty_list": ([("a",), (None,)], []),
        "left_nulls": ([(None,), ("z",)], [("q",)]),
    }
    for name, (lrows, rrows) in cases.items():
        ldf = spark.createDataFrame(lrows, "k string")
        rdf = spark.createDataFrame(rrows, "k2 string")
        got = not_in(ldf, "k", rdf, "k2").collect()
        ldf.createOrReplaceTempView("nin_l")
        rdf.createOrReplaceTempView("nin_r")
        want = spark.sql("SELECT * FROM nin_l WHERE k NOT IN (SELECT k2 FROM nin_r)").collect()
        assert _bag(got) == _bag(want), name


def test_latest_per_key_nulls_last_and_ties(spark):
    rows = [
        ("r1", None, 1, "a"),
        ("r1", 5, 2, "b"),
        ("r1", 5, 1, "c"),  # tie on time, lower sequence wins
        ("r2", None, 3, "d"),
        ("r2", None, 2, "e"),  # all times NULL: lowest sequence
        ("r3", 1, 1, "f"),
    ]
    df = spark.createDataFrame(rows, "k string, t int, seq int, v string")
    got = latest_per_key(df, ["k"], [F.col("t").desc_nulls_last(), F.col("seq").asc_nulls_last()])
    assert {r["k"]: r["v"] for r in got.collect()} == {"r1": "c", "r2": "e", "r3": "f"}


def test_presence_flags(spark):
    df = spark.createDataFrame([("o1", "A"), ("o1", "B"), ("o2", "C"), (None, "A")], "k string, v string")
    got = {r["k"]: (r["has_a"], r["has_b"]) for r in presence_flags(df, "k", "v", {"has_a": "A", "has_b": "B"}).collect()}
    assert got == {"o1": (True, True), "o2": (False, False), None: (True, False)}


def test_union_positional(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s2 string, n2 int").select("n2", "s2")
    u = union_positional(a, b)
    assert u.columns == ["n", "s"] and sorted(tuple(r) for r in u.collect()) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        union_positional(a, b.select("n2"))


@pytest.mark.parametrize("seed", [3, 4])
def test_not_in_random_vs_brute_force(spark, seed):
    """NOT IN on random keys with NULLs on both sides and one key holding a third of the rows."""
    rnd = random.Random(seed)

    def key():
        x = rnd.random()
        return "hot" if x < 0.33 else (None if x < 0.38 else f"k{rnd.randint(0, 30)}")

    left = [(i, key()) for i in range(400)]
    for with_null in (False, True):
        right = [(key() if with_null else f"k{rnd.randint(0, 40)}",) for _ in range(60)]
        if not with_null:
            right.append(("hot",))
        listed = {r[0] for r in right}
        if None in listed:
            expected = []
        else:
            expected = [row for row in left if row[1] is not None and row[1] not in listed]
        ldf = spark.createDataFrame(left, "id int, k string")
        rdf = spark.createDataFrame(right, "k2 string")
        assert _bag(not_in(ldf, "k", rdf, "k2").collect()) == _bag(expected), with_null


def test_presence_flags_and_their_values_hot_key(spark):
    """One key holds a third of the rows; flags and sets equal brute force, aggregated map-side."""
    from orderlens.operators import flagged_values

    rnd = random.Random(7)
    kinds = ["Device", "Accessories", "Service", "Other"]
    rows = [("hot" if i % 3 == 0 else f"o{rnd.randint(0, 50)}", rnd.choice(kinds)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v string").repartition(6)
    flags = presence_flags(df, "k", "v", {"has_dev": "Device", "has_acc": "Accessories"})
    seen = {}
    for k, v in rows:
        seen.setdefault(k, set()).add(v)
    got = {r["k"]: (r["has_dev"], r["has_acc"]) for r in flags.collect()}
    assert got == {k: ("Device" in s, "Accessories" in s) for k, s in seen.items()}
    named = {"s": "Service", "d": "Device", "a": "Accessories", "o": "Other"}
    sets = presence_flags(df, "k", "v", named).select("k", flagged_values(named).alias("v"))
    assert {r["k"]: r["v"] for r in sets.collect()} == {k: ",".join(sorted(s)) for k, s in seen.items()}
    for agg in (flags, sets):
        plan = agg._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan, plan


def test_latest_per_key_hot_key_vs_brute_force(spark):
    """A key with a third of the rows; NULL times sort last; the group limit runs before the shuffle."""
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        k = "hot" if i % 3 == 0 else f"r{rnd.randint(0, 200)}"
        t = None if rnd.random() < 0.2 else rnd.randint(0, 50)
        rows.append((k, t, rnd.randint(0, 5), i))
    df = spark.createDataFrame(rows, "k string, t int, seq int, id int").repartition(6)
    order = [F.col("t").desc_nulls_last(), F.col("seq").asc_nulls_last(), F.col("id").asc()]
    got = latest_per_key(df, ["k"], order)
    best = {}
    for k, t, seq, i in rows:
        rank = (t is None, -(t or 0), seq, i)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, i)
    assert {r["k"]: r["id"] for r in got.collect()} == {k: v[1] for k, v in best.items()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan, plan


def test_rows_are_reduced_to_keys_before_the_shuffle(spark):
    """No row with a matching key is lost, few others pass, and a full bitmap only lets more pass."""
    from orderlens.operators.key_filter import bits_for, reduced_to_keys

    big = spark.range(50_000).select(F.concat(F.lit("k"), "id").alias("k"), "id").union(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    keys = spark.range(0, 50_000, 100).select(F.concat(F.lit("k"), "id").alias("key")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    for bits, most in ((bits_for(500), 500 + 50_000 // 16), (1 << 10, 50_000)):
        kept = {r["id"] for r in reduced_to_keys(big, "k", keys, "key", bits).collect()}
        assert set(range(0, 50_000, 100)) <= kept and len(kept) <= most and -1 not in kept
    assert reduced_to_keys(big, "k", keys.limit(0), "key").count() == 0
    assert [bits_for(n) for n in (0, 1 << 11, 1 << 20, 1 << 60)] == [1 << 15, 1 << 15, 1 << 24, 1 << 29]


def test_pairing_with_removed_vs_brute_force(spark):
    from orderlens.operators import pair_with_removed

    rnd = random.Random(5)
    key = lambda: None if rnd.random() < 0.1 else rnd.randint(0, 5)
    rows = [(i, key(), rnd.choice("xyz"), f"p{i}") for i in range(60)]
    added, removed = rows[:40], rows[40:]
    schema = "id int, k int, flag string, p string"
    got = pair_with_removed(spark.createDataFrame(added, schema), spark.createDataFrame(removed, schema), ["k", "flag"], {"p": "old_p"})
    assert got.columns == ["id", "k", "flag", "p", "old_p"]
    want = [(*a, r[3]) for a in added for r in removed if a[1] is not None and (a[1], a[2]) == (r[1], r[2])]
    assert _bag(got.collect()) == _bag(want)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",  # small partitions would become one map task, which isn't split
}


@pytest.fixture
def skewed(spark):
    """No broadcasts, and partitions of the tests' size count as skewed."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_of_a_shared_exchange_is_split(spark, skewed, how):
    """60 % of the rows on one key, a tenth without a key, after another join on the same key."""
    from orderlens.operators import join_on_own_exchange

    rnd = random.Random(3)
    key = lambda: "hot" if (x := rnd.random()) < 0.6 else None if x < 0.7 else f"k{rnd.randint(0, 60)}"
    rows = [(i, key(), "x" * 50) for i in range(6000)]
    left = spark.createDataFrame(rows, "id int, k string, pad string").repartition(8)
    names = [("hot", 0), ("hot", -1), *((f"k{i}", i) for i in range(0, 50)), (None, 9)]
    right = spark.createDataFrame(names, "name string, v int")
    once = spark.createDataFrame([(n,) for n in sorted({n for n, _ in names if n})], "n1 string")
    first = left.join(once, F.col("k") == F.col("n1"), "left")
    got = join_on_own_exchange(first, right, "k", "name", how)
    matches = {}
    for k, v in names:
        matches.setdefault(k, []).append(v)
    want = [(i, k, v) for i, k, _ in rows for v in (matches.get(k) if k is not None and k in matches else [None] if how == "left" else [])]
    assert _bag((r["id"], r["k"], r["v"]) for r in got.collect()) == _bag(want)
    assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
