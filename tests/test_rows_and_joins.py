"""Joins and ordered rows against literal simulations, with and without hot keys."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import joins, rows, setops, spread
from cohortloom.sources import sinks  # noqa: F401  (import check)


def result(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def merge_by_steps(a, b):
    """Row by row: read one row of each side while there is one, b's values last."""
    out = []
    for key in sorted(set(a) | set(b)):
        ra, rb = a.get(key, []), b.get(key, [])
        vector = {"x": None, "only_a": None, "only_b": None}
        for i in range(max(len(ra), len(rb))):
            if i < len(ra):
                vector["x"], vector["only_a"] = ra[i]
            if i < len(rb):
                vector["x"], vector["only_b"] = rb[i]
            out.append((key, i + 1, vector["x"], vector["only_a"], vector["only_b"]))
    return out


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_match_merge(spark, hot_rows):
    a, b = {}, {}
    for key, (na, nb) in enumerate(itertools.product(range(4), range(4))):
        a[f"k{key:02d}"] = [(f"a{key}-{i}", f"oa{i}") for i in range(na)]
        b[f"k{key:02d}"] = [(None if i == 1 else f"b{key}-{i}", f"ob{i}") for i in range(nb)]
    a, b = {k: v for k, v in a.items() if v}, {k: v for k, v in b.items() if v}
    left = spark.createDataFrame([(k, i, x, o) for k, v in a.items() for i, (x, o) in enumerate(v)], "k string, ia int, x string, only_a string")
    right = spark.createDataFrame([(k, i, x, o) for k, v in b.items() for i, (x, o) in enumerate(v)], "k string, ib int, x string, only_b string")
    merged = joins.match_merge(left, right, ["k"], ["ia"], ["ib"], hot_rows=hot_rows)
    assert result(merged, "k", "row_in_key", "x", "only_a", "only_b") == sorted(merge_by_steps(a, b), key=repr)
    assert merged.count() == sum(max(len(a.get(k, [])), len(b.get(k, []))) for k in set(a) | set(b))


def test_match_merge_keeps_both_sides_copies(spark):
    a = spark.createDataFrame([("1", "F"), ("2", "H")], "id string, load string")
    b = spark.createDataFrame([("1", None), ("3", "Q")], "id string, load string")
    merged = joins.match_merge(a, b, ["id"], ["load"], ["load"])
    assert result(merged, "id", "load", "load_a", "load_b", "in_a", "in_b") == [
        ("1", None, "F", None, True, True), ("2", "H", "H", None, True, False), ("3", "Q", None, "Q", False, True),
    ]


def skewed(spark, n=3000):
    """A third of all rows under one key, some under a missing key."""
    random.seed(3)
    data = [(None if i % 50 == 0 else (0 if i % 3 == 0 else i % 40), random.randrange(500), i, random.random() < 0.01) for i in range(n)]
    return spark.createDataFrame(data, "k int, t int, id int, hit boolean")


@pytest.mark.parametrize("hot_rows", [1_000_000, 100])
def test_rank_within(spark, hot_rows):
    df = skewed(spark)
    expected, seen = [], {}
    for r in sorted(df.collect(), key=lambda r: (r.t, r.id)):
        seen[r.k] = seen.get(r.k, 0) + 1
        expected.append((r.id, seen[r.k]))
    ranked = spread.rank_within(df, ["k"], ["t", "id"], "n", hot_rows)
    assert result(ranked, "id", "n") == sorted(expected, key=repr)


def test_ordered_index_and_running_count(spark):
    df = skewed(spark)
    order = sorted((r.t, r.id) for r in df.collect())
    assert result(rows.running_count(df, ["t", "id"], start=2), "running_count", "id") == sorted(
        ((i + 3, id_) for i, (_, id_) in enumerate(order)), key=repr
    )


def test_hash_rank_is_a_permutation(spark):
    df = skewed(spark).withColumn("digest", spread.hash_order(1, "id"))
    ranked = spread.hash_rank(df, ["k"], "digest", ["id"], "n", digits=2, total="all")
    for key, group in itertools.groupby(sorted(ranked.collect(), key=lambda r: (r.k is None, r.k or 0, r.n)), key=lambda r: r.k):
        group = list(group)
        assert [r.n for r in group] == list(range(1, len(group) + 1))
        assert [r.digest for r in group] == sorted(r.digest for r in group)
        assert {r["all"] for r in group} == {len(group)}


def test_running_flag_and_last_rows(spark):
    df = skewed(spark)
    flags, last, kept = [], {}, set()
    state = {}
    ordered = sorted(df.collect(), key=lambda r: (r.t, r.id))
    for r in ordered:
        state[r.k] = state.get(r.k, False) or r.hit
        flags.append((r.id, "Y" if state[r.k] else "N"))
        last[r.k] = r.id
        if r.hit:
            kept.add(r.id)
    assert result(rows.running_flag(df, ["k"], ["t", "id"], F.col("hit"), "flag"), "id", "flag") == sorted(flags, key=repr)
    assert {r.id for r in rows.last_row_per_key(df, ["k"], ["t", "id"]).collect()} == set(last.values())
    assert {r.id for r in rows.keep_or_last(df, ["k"], ["t", "id"], F.col("hit")).collect()} == kept | set(last.values())


def test_duplicates(spark):
    df = skewed(spark)
    firsts = {}
    for r in sorted(df.collect(), key=lambda r: (r.t, r.id)):
        firsts.setdefault(r.k, r.id)
    extra = rows.duplicate_keys(df, ["k"], ["t", "id"])
    assert {r.id for r in extra.collect()} == {r.id for r in df.collect()} - set(firsts.values())
    assert {r.id for r in rows.dedupe_keys(df, ["k"], ["t", "id"]).collect()} == set(firsts.values())
    assert rows.duplicate_counts(df, ["k"]).agg(F.sum("extra_rows")).first()[0] == df.count() - len(firsts)
    same = spark.createDataFrame([(1, "x")] * 3 + [(2, "y"), (None, "z"), (None, "z")], "k int, t string")
    assert sorted((r.k, r.t) for r in rows.duplicate_keys(same, ["k"], ["t"]).collect() if r.k) == [(1, "x")] * 2
    assert rows.duplicate_keys(same, ["k"], ["t"]).count() == rows.duplicate_counts(same, ["k"]).agg(F.sum("extra_rows")).first()[0] == 3


@pytest.mark.parametrize("bucket", [None, lambda t: F.floor(t / 7)])
def test_asof_join(spark, bucket):
    df = skewed(spark, 900)
    right = df.filter("hit").select("k", F.col("t").alias("rt"), F.col("id").alias("rid"))
    marks = right.collect()
    expected = []
    for r in df.collect():
        before = [m.rt for m in marks if m.k == r.k and m.rt <= r.t]
        hits = [m.rid for m in marks if before and m.k == r.k and m.rt == max(before)] or [None]
        expected += [(r.id, h) for h in hits]
    joined = joins.asof_term_join(df, right, ["k"], "t", "rt", bucket)
    assert result(joined, "id", "rid") == sorted(expected, key=repr)


def test_dated_joins(spark):
    left = spark.createDataFrame([("A",), ("B",), ("C",)], "plan string")
    dated = spark.createDataFrame(
        [("A", 1, "A", "old"), ("A", 5, "I", "new"), ("B", 3, "A", "b1"), ("B", 3, "A", "b2"), ("C", 9, "A", "late")],
        "plan string, effdt int, status string, v string",
    )
    active = F.col("status") == "A"
    assert result(joins.effective_dated_join(left, dated, ["plan"], "effdt", F.lit(4)), "plan", "v") == [
        ("A", "old"), ("B", "b1"), ("B", "b2"), ("C", None)]
    assert result(joins.latest_then_status(left, dated, ["plan"], "effdt", active), "plan", "v") == [
        ("A", None), ("B", "b1"), ("B", "b2"), ("C", "late")]
    assert result(joins.latest_active(left, dated, ["plan"], "effdt", active), "plan", "v") == [
        ("A", "old"), ("B", "b1"), ("B", "b2"), ("C", "late")]


def test_effective_dating_is_per_institution(spark):
    left = spark.createDataFrame([("P",)], "plan string")
    dated = spark.createDataFrame([("I1", "P", 1, "x"), ("I1", "P", 2, "y"), ("I2", "P", 1, "z")], "inst string, plan string, effdt int, v string")
    joined = joins.effective_dated_join(left, dated, ["plan"], "effdt", F.lit(9), keys=["inst", "plan"])
    assert result(joined, "inst", "v") == [("I1", "y"), ("I2", "z")]


def test_null_matching(spark):
    left = spark.createDataFrame([(1, None), (2, "a")], "id int, k string")
    right = spark.createDataFrame([(None, "n"), ("a", "x")], "k string, v string")
    assert result(joins.null_matching_join(left, right, ["k"]), "id", "v") == [(1, "n"), (2, "x")]
    assert result(joins.null_matching_join(left, right, ["k"], null_keys_match=False), "id", "v") == [(1, None), (2, "x")]


def test_other_row_exists(spark):
    df = spark.createDataFrame([(1, "s", "P1"), (2, "s", "P2"), (3, "t", "P1"), (4, "u", None)], "id int, k string, plan string")
    others = spark.createDataFrame([("s", "P1", "MAJ"), ("t", "P1", "MAJ"), ("t", "P9", "MIN"), ("u", "P1", None)], "k string, plan string, kind string")
    counts = ~F.col("kind").eqNullSafe("MIN")
    assert result(joins.other_row_exists(df, others, ["k"], "plan", counts, "m"), "id", "m") == [(1, "N"), (2, "Y"), (3, "N"), (4, "Y")]


def test_media_fallback(spark):
    posts = spark.createDataFrame([("a", "IMAGE", 1), ("a", "VIDEO", 2), ("b", "VIDEO", 3)], "account string, kind string, id int")
    fallback = spark.createDataFrame([("a", "FALLBACK", 8), ("b", "FALLBACK", 9), ("c", "FALLBACK", 10)], "account string, kind string, id int")
    kept = joins.media_allow_list(posts, fallback, "account", "kind", ["IMAGE"])
    assert result(kept, "id") == [(1,), (10,), (9,)]


def test_hot_key_is_split_by_the_join_back(spark):
    """The shape of join_back lets adaptive execution split the hot key's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 200_000, 1, 16)
        big = ids.select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"), F.col("id").alias("t"), F.md5(F.col("id").cast("string")).alias("v"))
        flagged = rows.running_flag(big, ["k"], ["t"], F.col("t") > 1000, "flag")
        assert flagged.agg(F.count("*"), F.max("v")).first()[0] == 200_000
        flagged.write.format("noop").mode("overwrite").save()
        counted = flagged.select("k", "flag", "v")
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_set_operations(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2, 3.5)], "id int, n double")
    both = setops.snapshot_concat([(a, "d1"), (b, "d2")])
    assert result(both, "id", "s", "n", "day") == [(1, "x", None, "d1"), (2, None, 3.5, "d2")]
    yes, no = setops.split_output(spark.createDataFrame([(1,), (None,)], "v int"), F.col("v") == 1)
    assert (yes.count(), no.count()) == (1, 1)
    with pytest.raises(ValueError):
        setops.select_rename_drop(a, {"id": "z", "s": "z"})
