from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from foldgauge.operators import ranking as R
from foldgauge.operators import splitting as S
from foldgauge.operators import stats


def label_sets(corpus, schema):
    return {r["id"]: tuple(r[label] for label in schema.labels) for r in corpus.collect()}


def test_folds_cover_all_rows_evenly(corpus, schema):
    sets = label_sets(corpus, schema)
    folds = {r["id"]: r["fold"] for r in S.stratified_folds(corpus, schema, k=5).collect()}
    assert set(folds) == set(sets)
    sizes = Counter(folds.values())
    assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 1
    per_set = defaultdict(Counter)
    for row_id, fold in folds.items():
        per_set[sets[row_id]][fold] += 1
    for counts in per_set.values():
        spread = [counts[f] for f in range(5)]
        assert max(spread) - min(spread) <= 1


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_folds_do_not_depend_on_partitioning(spark, corpus, schema, partitions):
    expected = sorted(map(tuple, S.fold_roles(corpus, schema).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        again = sorted(map(tuple, S.fold_roles(corpus.repartition(int(partitions)), schema).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert again == expected


@pytest.mark.parametrize("rows", [1, 7, 10**9])
def test_cells_do_not_change_results(corpus, schema, rows):
    assert sorted(S.stratified_folds(corpus, schema, cell_rows=rows).collect()) == sorted(S.stratified_folds(corpus, schema).collect())
    assert sorted(S.sampled_ids(corpus, schema, 37, cell_rows=rows).collect()) == sorted(S.sampled_ids(corpus, schema, 37).collect())


def test_seed_changes_folds(corpus, schema):
    assert sorted(S.stratified_folds(corpus, schema, seed=1).collect()) != sorted(S.stratified_folds(corpus, schema, seed=2).collect())


def test_roles_are_disjoint_and_sized(corpus, schema):
    roles = S.fold_roles(corpus, schema, k=4, val_ratio=0.2).collect()
    seen = Counter((r["fold"], r["id"]) for r in roles)
    assert set(seen.values()) == {1} and len(seen) == 4 * 600
    sizes = Counter((r["fold"], r["role"]) for r in roles)
    for fold in range(4):
        assert sizes[fold, "test"] == 150
        assert sizes[fold, "val"] == 90 and sizes[fold, "train"] == 360
    tests = Counter(r["id"] for r in roles if r["role"] == "test")
    assert set(tests.values()) == {1}


@pytest.mark.parametrize("n", [1, 7, 100, 599, 600, 5000])
def test_sample_is_exact_and_proportional(corpus, schema, n):
    sets = label_sets(corpus, schema)
    chosen = [r["id"] for r in S.stratified_subsample(corpus, schema, n).collect()]
    assert len(chosen) == len(set(chosen)) == min(n, 600)
    whole, part = Counter(sets.values()), Counter(sets[i] for i in chosen)
    for label_set, count in whole.items():
        assert abs(part[label_set] - count * min(n, 600) / 600) < 1
    rest = {r["id"] for r in S.sample_remainder(corpus, schema, n).collect()}
    assert rest == set(sets) - set(chosen)


def test_large_samples_join_without_broadcast(corpus, schema, monkeypatch):
    expected = sorted(r["id"] for r in S.stratified_subsample(corpus, schema, 100).collect())
    monkeypatch.setattr(R, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    assert sorted(r["id"] for r in S.stratified_subsample(corpus, schema, 100).collect()) == expected


def test_running_positions_equal_brute_force(spark):
    rows = [(g, i * 37 % 211, i % 5) for g in ("x", "y") for i in range(200 if g == "x" else 3)]
    frame = spark.createDataFrame(rows, "g string, v int, w int").withColumn("cell", F.expr("v div 16"))
    out = R.running_positions(frame, ["g"], "cell", ["v"], {"total": F.col("w")}, start_groups=[]).collect()
    expected = {}
    start = {"x": 0, "y": 200}
    for g in ("x", "y"):
        total = 0
        mine = sorted(r for r in rows if r[0] == g)
        for position, (_, v, w) in enumerate(mine, 1):
            total += w
            expected[g, v] = (position, len(mine), start[g], total)
    assert {(r["g"], r["v"]): (r["position"], r["group_rows"], r["group_start"], r["total"]) for r in out} == expected


def test_first_rows_equal_brute_force(spark):
    rows = [(i % 3, i * 7919 % 1000, i) for i in range(1000)]
    frame = spark.createDataFrame(rows, "g int, v int, i int").withColumn("cell", F.expr("v div 50"))
    for n in (1, 5, 400):
        expected = {(g, v, i) for g in range(3) for g_, v, i in sorted(r for r in rows if r[0] == g)[:n]}
        picked = R.first_rows(frame, ["g"], "cell", ["v", "i"], F.lit(n), most=3 * n)
        assert {(r["g"], r["v"], r["i"]) for r in picked.collect()} == expected
        pruned = R.first_n_pruned(frame.repartition(3), ["g"], ["v", "i"], n, spread="i", salts=8)
        assert {(r["g"], r["v"], r["i"]) for r in pruned.collect()} == expected


def test_pruning_keeps_nulls_and_ties(spark, monkeypatch):
    monkeypatch.setattr(R, "PRUNE_ROWS", 10)
    rows = [(i % 4 or None, f"k{i % 9}" if i % 10 else None, i) for i in range(500)]
    frame = spark.createDataFrame(rows, "g int, k string, i int").repartition(3)
    for n in (1, 40, 2000):
        want = sorted((g or -1, k or "", i) for g in {r[0] for r in rows} for _, k, i in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] or "", r[2]))[:n])
        got = sorted((r["g"] or -1, r["k"] or "", r["i"]) for r in R.first_n_pruned(frame, ["g"], ["k", "i"], n, spread="i").collect())
        assert got == want
    plan = R.first_n_pruned(frame, ["g"], ["k", "i"], 2000, spread="i")._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("MapInArrow") > plan.rindex("Exchange hashpartitioning(g")  # pruned before the shuffle


def test_statistics(corpus, schema):
    frequency = {r["label"]: (r["count"], r["proportion"]) for r in stats.label_frequency(corpus, schema).collect()}
    assert frequency == {"a": (86, 0.143333), "b": (55, 0.091667), "c": (47, 0.078333)}
    rows = corpus.withColumn("fold", F.lit(0)).where("a = 0 or b = 1")
    weights = {r["label"]: r["pos_weight"] for r in stats.pos_weights(rows, schema, clip=5.0).collect()}
    n = rows.count()
    assert weights["a"] == 5.0 and weights["b"] == 5.0
    assert stats.pos_weights(rows, schema, clip=1000.0).where("label = 'c'").first()["pos_weight"] == (n - rows.where("c = 1").count()) / rows.where("c = 1").count()


def test_no_positives_weight(spark, schema):
    rows = spark.createDataFrame([(0, 0, 1, 0), (0, 0, 1, 0)], "fold int, a int, b int, c int")
    weights = {r["label"]: r["pos_weight"] for r in stats.pos_weights(rows, schema).collect()}
    assert weights == {"a": 2.0, "b": 0.0, "c": 2.0}


def test_hot_label_set_is_never_one_partition(spark, schema):
    """All rows in one label combination: the ranking shuffle still spreads them."""
    rows = spark.range(4000).select(F.col("id").cast("string"), F.lit("t").alias("text"), *[F.lit(0).alias(x) for x in schema.labels])
    folds = S.stratified_folds(rows, schema)
    assert max(Counter(r["fold"] for r in folds.collect()).values()) == 800
    plan = folds._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert windows and all("cell" in line.split("windowspecdefinition(")[1].split(" ASC")[0] for line in windows)


def test_crowded_cells_are_cut_until_they_fit(spark):
    """Half of all rows in one group: no cell above the bound (but for equal hashes), order kept, totals right."""
    rows = spark.range(60_000).select((F.col("id") % 2 * F.col("id") % 5).alias("g"), F.col("id"))
    rows = rows.withColumn("h", F.shiftright(F.abs(F.xxhash64("id")), 3))
    rows = rows.unionByName(spark.range(40).select(F.lit(0).cast("long").alias("g"), F.lit(7).cast("long").alias("id"), F.lit(123456789).cast("long").alias("h")))
    cut, cells = R.refined_cells(rows.where("h < (1L << 50)"), ["g"], "h", {"s": F.col("id")}, cell_rows=5)
    counted = {(r["g"], r["cell"]): (r["n"], r["s"]) for r in cut.groupBy("g", "cell").agg(F.count("*").alias("n"), F.sum("id").alias("s")).collect()}
    assert {(r["g"], r["cell"]): (r["cell_rows"], r["cell_s"]) for r in cells.collect()} == counted
    hot = max(cell for g, cell in counted if g == 0 and cell <= 123456789)  # holds the 40 rows of one hash
    assert max(n for key, (n, _) in counted.items() if key != (0, hot)) <= 20 and counted[0, hot][0] >= 40
    assert cut.where("cell > h").isEmpty()
    wrong = cut.alias("a").join(cut.alias("b"), F.expr("a.g = b.g AND a.h < b.h AND a.cell > b.cell AND a.g = 1"))
    assert wrong.isEmpty()


@pytest.mark.parametrize("most", [None, 1 << 40])
def test_totals_before_equal_brute_force(spark, most):
    rows = [(i % 3, f"k{i * 7919 % 500:03d}", i % 11) for i in range(500)]
    frame = spark.createDataFrame(rows, "g int, k string, v int").repartition(7)
    for by in ([], ["g"]):
        got = {(r["g"], r["k"]): r["t"] for r in R.totals_before(frame, by, [F.desc("k")], F.col("v"), "t", most).collect()}
        for g, k, _ in rows:
            assert got[g, k] == sum(v for h, other, v in rows if other > k and (not by or h == g))
