"""Order model: numbering under skew, history, 14-day rules."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.functions import columns as fx
from tillroll.functions import stats
from tillroll.operators import orders
from tillroll.operators.ranking import range_position, split_large, split_row_number, top_k
from tillroll.plans.flow import Flow
from tillroll.sources import dataset

PLACED = (
    "user_id bigint, order_id bigint, order_number int, order_dow int, "
    "order_hour_of_day int, days_since_prior_order double"
)


@pytest.fixture(scope="module")
def placed(spark):
    """Users 1..5 with as many orders; the gaps of user 5 cross the 14-day line."""
    gaps = {5: [None, 13.0, 14.0, 15.0, 3.0]}
    rows = []
    for user in range(1, 6):
        for n in range(1, user + 1):
            gap = gaps.get(user, [None, 10.0, 20.0, 5.0])[n - 1]
            rows.append((user, user * 100 + n, n, n % 7, n, gap))
    return spark.createDataFrame(rows, PLACED)


@pytest.fixture(scope="module")
def lines(placed):
    """Order n of a user has n lines; even cart positions are reorders."""
    pos = F.explode(F.sequence(F.lit(1), "order_number")).alias("add_to_cart_order")
    return placed.select("*", pos).withColumns(
        {
            "product_id": F.col("add_to_cart_order").cast("bigint"),
            "reordered": (F.col("add_to_cart_order") % 2 == 0).cast("int"),
            "department_id": F.col("add_to_cart_order") % 2,
        }
    )


def test_split_row_number_equals_plain_window(spark):
    """One key holds most rows; ties are broken by id."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 5).alias("k"),
        (F.col("id") * 7919 % 97).alias("day"),
        F.col("id"),
    ).withColumn("b", F.floor(F.col("day") / 10))
    got = split_row_number(df, ["k"], ["b"], ["day", "id"], "n", {"last": F.max("day")})
    plain = F.row_number().over(W.partitionBy("k").orderBy("day", "id"))
    prev = F.lag("day").over(W.partitionBy("k").orderBy("day", "id"))
    bad = got.withColumns({"want": plain, "prev": prev}).withColumn(
        "got_prev",
        F.coalesce(F.lag("day").over(W.partitionBy("k", "b").orderBy("day", "id")), "last"),
    )
    assert bad.where("n <> want or not (prev <=> got_prev)").count() == 0


def test_split_large_equals_split_row_number(spark):
    """Two keys of five are large; buckets may be open and keys unknown."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 5).alias("k"),
        F.when(F.col("id") % 11 > 0, F.col("id") * 7919 % 9).alias("b"),
        F.when(F.col("id") % 13 > 0, F.col("id") % 4).alias("c"),
        F.col("id"),
    )
    want = split_row_number(df, ["k"], ["b", "c"], ["id"], "n").select("k", "b", "c", "id", "n").collect()
    for large in ([], [0, 3], [0, 1, 2, 3, 4, 9]):
        marks = spark.createDataFrame([(k, True) for k in large], "k bigint, large boolean")
        got = split_large(df, marks, "k", ["b", "c"], ["id"], "n").select("k", "b", "c", "id", "n").collect()
        assert sorted(got) == sorted(want), large


def test_only_large_orders_are_numbered_in_parts(spark, tmp_path, monkeypatch):
    rows = [(o, i * 907 % 5000, i % 3, i % 4 or None, float(i)) for o, n in ((1, 300), (2, 5), (3, 4), (None, 3)) for i in range(n)]
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double"
    spark.createDataFrame(rows, line).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = []
    for least in (100_000, 100, 0):
        monkeypatch.setattr(dataset, "LARGE_ORDER", least)
        numbered = Flow(spark, str(tmp_path)).raw_lines
        got.append(sorted(numbered.collect()))
        # parts are counted for the lines of large orders only
        plan = numbered._jdf.queryExecution().optimizedPlan().toString().split("\n")
        (at,) = [i for i, x in enumerate(plan) if "Aggregate [" in x and "part_block" in x]
        assert "LeftSemi" in "".join(plan[at : at + 3])
    assert got[0] == got[1] == got[2] and len(got[0]) == 231
    assert [r[2] for r in got[0] if r[0] == 3] == [2, 3, 4]


def test_range_position_equals_plain_window(spark):
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("a"), F.lit("x").alias("s"))
    got = range_position(df, ["s", "a"], total="n")
    want = F.row_number().over(W.orderBy("s", "a")) - 1
    assert got.withColumn("want", want).where("position <> want or n <> 2000").count() == 0


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    best = top_k(df, ["k"], [F.desc("id")], 2, rank="r")
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in best.collect())[:2] == [(0, 996, 1), (0, 999, 0)]


def test_last_orders_of_short_histories(placed):
    got = {r["user_id"]: tuple(r)[1:] for r in orders.last4_orders(placed).collect()}
    assert got[1] == (101, None, None, -1)
    assert got[3] == (303, 302, 301, -1)
    assert got[5] == (505, 504, 503, 502)


def test_history_is_chunked_and_ordered(placed):
    got = {r["user_id"]: r for r in orders.order_history(placed, 1024).collect()}
    assert got[4]["list_of_orders"] == [401, 402, 403, 404]
    assert got[4]["chunk"] == 0


def test_exclude_and_only_last_are_complements(lines, placed):
    kept = orders.exclude_last_order(lines, placed)
    last = orders.only_last_order(lines, placed)
    assert kept.count() + last.count() == lines.count()
    assert {r[0] for r in last.select("order_id").distinct().collect()} == {
        101, 202, 303, 404, 505,
    }


def test_14_day_rules_differ(spark, placed, lines):
    """A gap of 14 counts as within 14 days in the ratio, but not in the label."""
    one = lines.where("user_id = 5")
    ratio = orders.user_order_features(one).first()["reordered_w14d_ratio"]
    assert ratio == pytest.approx((1 + 2 + 3 + 5) / 15)  # weights 1..5, only gap 15 fails
    until_14 = placed.where("user_id = 5 and order_number <= 3")
    label = orders.returns_14d(one, until_14).first()
    assert label["days_lag_0"] == 14.0 and label["comes_within_14_days"] == 0
    until_13 = placed.where("user_id = 5 and order_number <= 2")
    assert orders.returns_14d(one, until_13).first()["comes_within_14_days"] == 1


def test_returns_table_small_users(placed, lines):
    got = {r["user_id"]: r for r in orders.returns_14d(lines, placed).collect()}
    assert got[1]["comes_within_14_days"] == 0  # an unknown gap is not below 14
    assert got[2]["order_frequency_without_lag_0"] is None  # n - 2 = 0
    assert got[5]["no_orders"] == 5.0
    mean = (13 + 14 + 15 + 3) / 4
    assert got[5]["order_frequency_without_lag_0"] == pytest.approx((mean * 4 - 3) / 3)


def test_line_weighted_features_match_pandas(lines):
    pdf = lines.toPandas()
    got = orders.user_order_features(lines).toPandas().set_index("user_id").sort_index()
    g = pdf.groupby("user_id")
    assert got["reordered_ratio"].tolist() == pytest.approx(g["reordered"].mean().tolist())
    assert got["inter_order_time"].tolist() == g["days_since_prior_order"].sum().tolist()
    assert got["avg_days_between_orders"].dropna().tolist() == pytest.approx(
        g["days_since_prior_order"].mean().dropna().tolist()
    )


def test_skewness_and_boxcox(spark):
    import pandas as pd

    values = [1.0, 2.0, 2.5, 4.0, 9.0, 30.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(stats.skewness_unbiased(F.col("x"))).first()[0]
    assert got == pytest.approx(pd.Series(values).skew())
    lam = stats.boxcox_mle(df, ["x"], [round(-2 + 0.1 * i, 1) for i in range(41)]).first()
    import numpy as np

    x = np.array(values)

    def loglik(g):
        y = np.log(x) if g == 0 else (x**g - 1) / g
        return (g - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())

    grid = [round(-2 + 0.1 * i, 1) for i in range(41)]
    assert lam["lam"] == max(grid, key=loglik)


def test_array_helpers(spark):
    df = spark.createDataFrame([([3, 1],)], "a array<int>")
    r = df.select(
        fx.pad("a", 4).alias("p"), fx.from_end("a", 1).alias("l"), fx.from_end("a", 3).alias("n"),
        fx.joined("a").alias("j"),
    ).first()
    assert (r["p"], r["l"], r["n"], r["j"]) == ([3, 1, 0, 0], 1, None, "3,1")


def test_describe_matches_pandas(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (None,), (10,)], "x int")
    got = stats.describe(df, ["x"]).first()
    want = df.toPandas()["x"].describe()
    assert [got[c] for c in ("n", "mean", "std", "lo", "q25", "q50", "q75", "hi")] == pytest.approx(
        want.tolist()
    )


def test_number_of_orders_with_gaps(spark):
    """Orders without lines leave gaps in the numbers; they do not count."""
    rows = [(10, 1, 1, 0, 9, None, 0, 1), (10, 1, 1, 0, 9, None, 1, 2), (12, 1, 4, 3, 9, 7.0, 1, 1)]
    schema = (
        "order_id long, user_id long, order_number int, order_dow int, order_hour_of_day int, "
        "days_since_prior_order double, reordered int, add_to_cart_order int"
    )
    got = orders.user_two_level_mean(spark.createDataFrame(rows, schema)).first()
    assert got.no_orders == 2.0 and got.item_count == 1.5


def test_time_series_split_of_few_rows(spark):
    from tillroll.operators import splits

    few = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], "week int, shopper int, product int")
    assert {r.test_fold for r in splits.split_timeseries(few, 5).collect()} == {0}


def test_boxcox_optimum_equals_a_direct_search(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    far = rng.normal(5, 0.6, 400)  # the power 1/3.5 of these needs lambda near 3.5
    columns = {"x": np.exp(rng.normal(0, 1, 400)), "y": far ** (1 / 3.5), "z": np.full(400, 2.0), "w": 1 / far**3}
    rows = [tuple(float(v) for v in r) for r in zip(*columns.values())] + [(None, -1.0, 2.0, 0.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    got = {c: (lam, ll) for c, lam, ll in stats.boxcox_optimum(df, list(columns), -0.5, 0.5)}

    def loglik(x, g):
        t = np.log(x) - np.log(x).mean()
        y = t if g == 0 else np.expm1(g * t) / g
        return -np.log(x).sum() - len(x) / 2 * np.log(y.var())

    for c in ("x", "y", "w"):
        x = columns[c]
        lam = max(np.arange(-12, 12, 0.01), key=lambda g: loglik(x, g))
        lam = max(np.arange(lam - 0.02, lam + 0.02, 2e-5), key=lambda g: loglik(x, g))
        assert got[c][0] == pytest.approx(lam, abs=1e-4)
        assert got[c][1] == pytest.approx(loglik(x, got[c][0]), rel=1e-9)
    assert got["y"][0] > 2 and got["z"] == (None, None)
    assert stats.boxcox_optimum(df.where("false"), ["x"]) == [("x", None, None)]


def test_exact_quantiles_equal_percentile(spark):
    import numpy as np

    from tillroll.functions.quantiles import exact_quantiles

    rng = np.random.default_rng(3)
    n = 20_000
    columns = {
        "even": rng.normal(0, 1, n),
        "wide": rng.choice([-1.0, 1.0], n) * 10.0 ** rng.uniform(-300, 300, n),
        "few": rng.integers(0, 3, n).astype(float),
        "same": np.full(n, 7.5),
        "huge": rng.choice([-1.7e308, 1.7e308, 5e-324, 0.0], n),
    }
    rows = [tuple(float(v) for v in r) for r in zip(*columns.values())] + [(None, float("nan"), None, None, 0.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).withColumn("none", F.lit(None).cast("int"))
    probs = [0.0, 0.013, 0.25, 0.5, 0.75, 0.987, 1.0]
    got = exact_quantiles(df, [*columns, "none"], probs)
    for c in ("even", "wide", "few", "same"):
        assert got[c] == pytest.approx(np.quantile(columns[c], probs).tolist(), rel=1e-12), c
    kept = np.sort(np.append(columns["huge"], 0.0))
    assert got["huge"][3] == kept[n // 2] and got["huge"][0] == -1.7e308 and got["huge"][-1] == 1.7e308
    assert got["none"] == [None] * len(probs)
