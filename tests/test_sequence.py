"""Skew-safe per-key lag / numbering equal the plain window, with a hot key cut over many partitions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from roadflow.operators.sequence import lag_by_key, number_by_key


def test_hot_key_over_many_partitions(spark):
    old = {k: spark.conf.get(k) for k in ["spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"]}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        # key 'hot' holds 60% of rows; ties on t are broken by u.
        df = spark.range(5000).select(
            F.when(F.col("id") % 5 < 3, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 37).cast("string"))).alias("k"),
            (F.col("id") % 997).alias("t"),
            F.col("id").alias("u"),
            (F.col("id") * 7 % 13).alias("v"),
        )
        got = lag_by_key(df, "k", ["t", "u"], ["v", "t"], bucket=F.floor(F.col("t") / 50))
        w = Window.partitionBy("k").orderBy("t", "u")
        want = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lag("t").over(w).alias("prev_t"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))

        parted_hot = lag_by_key(df, "k", ["t", "u"], ["v"], bucket=F.floor(F.col("t") / 50)).where("k = 'hot'")
        assert parted_hot.count() == 3000

        got_n = number_by_key(df, "k", ["t", "u"], bucket=F.floor(F.col("t") / 50))
        want_n = df.select("*", F.row_number().over(w).cast("bigint").alias("step"))
        assert sorted(map(tuple, got_n.collect())) == sorted(map(tuple, want_n.collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_ordered_join_hot_key(spark):
    from roadflow.operators.sequence import ordered_join_by_key

    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select(
            F.when(F.col("id") % 4 != 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 11).cast("string"))).alias("k"),
            (F.col("id") % 101).alias("t"),
            F.col("id").alias("u"),
            (F.col("id") % 7).cast("string").alias("a"),
            (F.col("id") % 5).cast("string").alias("b"),
        )
        got = {r.k: (r.x, r.y) for r in ordered_join_by_key(df, "k", ["t", "u"], {"x": "a", "y": "b"}, bucket=F.floor(F.col("t") / 50)).collect()}
        items = F.array_sort(F.collect_list(F.struct("t", "u", "a", "b")))
        want_df = df.groupBy("k").agg(items.alias("s")).select(
            "k",
            F.array_join(F.transform("s", lambda x: x["a"]), ">").alias("x"),
            F.array_join(F.transform("s", lambda x: x["b"]), ">").alias("y"),
        )
        want = {r.k: (r.x, r.y) for r in want_df.collect()}
        assert got == want and len(got["hot"][0].split(">")) == 2250
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_plans_hold_no_job_and_cut_the_key(spark):
    """One lazy plan: no window over the bare key but the one over a row per (key, bucket), no checkpoint."""
    from test_plans import plan_of

    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    p = plan_of(lag_by_key(df, "k", ["t"], ["t"], bucket=F.floor(F.col("t") / 10)))
    assert "Scan ExistingRDD" not in p and "hashpartitioning(k" in p and "_bucket" in p


def test_null_keys_and_times(spark):
    rows = [(None, 1, 1), (None, 5, 2), ("a", None, 3), ("a", 7, 4), ("a", 31, 5)]
    df = spark.createDataFrame(rows, "k string, t int, u int")
    got = sorted((r.u, r.prev_u) for r in lag_by_key(df, "k", ["t", "u"], ["u"], bucket=F.floor(F.col("t") / 10)).collect())
    assert got == [(1, None), (2, 1), (3, None), (4, 3), (5, 4)]
    steps = sorted((r.u, r.step) for r in number_by_key(df, "k", ["t", "u"], F.floor(F.col("t") / 10)).collect())
    assert steps == [(1, 1), (2, 2), (3, 1), (4, 2), (5, 3)]


def test_ordered_join_skips_nulls_also_in_whole_pieces(spark):
    from roadflow.operators.sequence import ordered_join_by_key

    df = spark.range(60).select(
        F.lit("k").alias("k"), F.col("id").alias("t"),
        F.when(F.col("id").between(20, 39), F.lit(None)).otherwise(F.col("id").cast("string")).alias("a"),
    )
    one = ordered_join_by_key(df, "k", ["t"], {"x": "a"}, F.lit(0)).collect()[0].x
    split = ordered_join_by_key(df, "k", ["t"], {"x": "a"}, F.floor(F.col("t") / 5)).collect()[0].x
    assert one == split and ">>" not in split and split.count(">") == 39


def test_lag_groups_made_of_identical_rows(spark):
    """A (partition, key) group whose rows tie on every order column: its first row must still get the
    previous group's last row, not a copy of itself."""
    from roadflow.operators.sequence import lag_by_key

    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # key 'k' with five t values, 400 rows each: range bounds fall between t values, so every
        # (partition, key) group is a run of identical rows
        df = spark.range(2000).select(F.lit("k").alias("k"), (F.col("id") / 400).cast("long").alias("t"))
        got = sorted(map(tuple, lag_by_key(df, "k", ["t"], ["t"], bucket=F.col("t")).collect()), key=str)
        want = sorted(map(tuple, df.select("*", F.lag("t").over(Window.partitionBy("k").orderBy("t")).alias("prev_t")).collect()), key=str)
        assert got == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
