import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakesearch.errors import QueryError
from lakesearch.functions.predicates import Tag
from lakesearch.operators import aggregation as agg
from lakesearch.operators.aggregation import Aggregation
from lakesearch.operators.sketches import SketchTable
from lakesearch.operators.quantile import exact_quantile, sortable_digits

SALES = [
    ("1", "acme", "electronics", 1200.0, 2.0),
    ("2", "acme", "electronics", 25.0, 10.0),
    ("3", "omega", "electronics", 150.0, 4.0),
    ("4", "ergo", "furniture", 300.0, 3.0),
    ("5", "ergo", "furniture", 500.0, 1.0),
    ("6", "acme", "electronics", 400.0, 5.0),
]


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(SALES, "_key string, brand string, category string, price double, quantity double")


def rows(aggregation):
    return [tuple(r) for r in aggregation.to_df().collect()]


def test_known_answers(sales):
    by_brand = Aggregation(sales).group_by("@brand", [agg.count("n"), agg.sum_("price", "total")]).sort_by("brand")
    assert rows(by_brand) == [("acme", 3, 1625.0), ("ergo", 2, 800.0), ("omega", 1, 150.0)]
    some = Aggregation(sales, Tag("category").eq("electronics")).group_by("brand", agg.count()).sort_by("brand")
    assert rows(some) == [("acme", 3), ("omega", 1)]
    ratio = Aggregation(sales).group_by("brand", [agg.sum_("price", "p"), agg.sum_("quantity", "q")]).apply("@p / @q", "r")
    assert rows(ratio.sort_by([("r", "DESC")], max=1)) == [("ergo", 800.0, 4.0, 200.0)]
    having = Aggregation(sales).group_by("brand", agg.sum_("price", "revenue")).filter("@revenue > 200").sort_by("brand")
    assert [r[0] for r in rows(having)] == ["acme", "ergo"]
    bound = Aggregation(sales, "brand = $b").params({"b": "omega"}).group_by("brand", agg.count("n"))
    assert rows(bound) == [("omega", 1)]
    lists = Aggregation(sales).group_by("category", agg.to_list("brand", "brands")).sort_by("category")
    assert rows(lists) == [("electronics", ["acme", "omega"]), ("furniture", ["ergo"])]
    assert rows(Aggregation(sales).group_by([], [agg.sum_("price", "t"), agg.count("n")])) == [(2575.0, 6)]


def test_every_reducer_in_one_group(sales):
    reducers = [
        agg.count(), agg.count_distinct("brand"), agg.count_distinctish("brand"), agg.sum_("price"), agg.min_("price"), agg.max_("price"),
        agg.avg("price"), agg.stddev("price"), agg.quantile("price", 0.5), agg.quantile("price", 0.5, "exact", exact=True),
        agg.to_list("quantity"), agg.first_value("brand"), agg.first_value("brand", "price", "DESC", "dearest"), agg.random_sample("price", 2),
    ]
    row = Aggregation(sales).group_by("category", reducers).sort_by("category").to_df().first()
    assert (row["count"], row["count_distinct_brand"], row["count_distinctish_brand"], row["sum_price"]) == (4, 2, 2, 1775.0)
    assert (row["min_price"], row["max_price"], row["avg_price"]) == (25.0, 1200.0, 443.75)
    assert row["stddev_price"] == pytest.approx(835468.75**0.5 / 3**0.5)
    assert row["quantile_price"] == 150.0 and row["exact"] == 275.0
    assert row["to_list_quantity"] == [2.0, 4.0, 5.0, 10.0]
    assert (row["first_value_brand"], row["dearest"]) == ("acme", "acme")
    assert len(row["random_sample_price"]) == 2
    whole = Aggregation(sales).group_by([], reducers).to_df().first()
    assert whole["exact"] == 350.0 and len(whole["random_sample_price"]) == 2 and whole["count"] == 6


def test_null_groups_keep_their_samples_and_quantiles(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    found = Aggregation(df).group_by("g", [agg.quantile("v", 0.5, "m", exact=True), agg.random_sample("v", 5, "s")]).sort_by("g")
    assert [(r["g"], r["m"], sorted(r["s"])) for r in found.to_df().collect()] == [(None, 2.0, [1.0, 3.0]), ("a", 5.0, [5.0])]


@pytest.mark.parametrize("q", [0.0, 0.013, 0.5, 0.77, 1.0])
def test_exact_quantile_of_a_hot_group(spark, q):
    values = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(7.0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(9973)) / 10).alias("v"),
    )
    want = {r["g"]: r["p"] for r in values.groupBy("g").agg(F.percentile("v", q).alias("p")).collect()}
    got = {r["g"]: r["p"] for r in exact_quantile(values, ["g"], F.col("v"), q, "p").collect()}
    assert got == pytest.approx(want)


def test_samples_repeat_and_stay_inside_their_group(sales):
    def sample():
        return rows(Aggregation(sales).group_by("category", agg.random_sample("price", 3, "s")).sort_by("category"))

    assert sample() == sample()
    assert set(sample()[1][1]) <= {300.0, 500.0}


def test_load_selects_and_sorting_is_stable(sales):
    found = Aggregation(sales).load(["price", ("@brand", "maker")]).load("quantity").apply("price * quantity", "value")
    assert found.sort_by([("maker", "ASC")]).limit(1, 2).to_df().columns == ["price", "maker", "quantity", "value"]
    assert rows(found)[0] == (25.0, "acme", 10.0, 250.0)
    assert rows(Aggregation(sales).sort_by("price", max=0).limit(0, 0)) == []
    assert len(rows(Aggregation(sales).sort_by("price", max=0))) == 6


def test_quoted_text_is_not_a_reference(sales):
    one = Aggregation(sales, "_key = '1'").params(b="x").apply("concat(brand, ' @brand :b ', :b)", "c").to_df().first()
    assert one["c"] == "acme @brand :b x"


def test_scores_feed_the_groups(products, product_schema):
    found = Aggregation(products, Tag("category").eq("furniture"), product_schema).add_scores("ergonomic desks", "title", stem=True)
    assert {r["_key"] for r in found.to_df().collect()} == {"4", "5"}
    assert Aggregation(products, None, product_schema).add_scores("desks", "title", stem=True).verbatim().to_df().count() == 0


def test_argument_errors(sales):
    a = Aggregation(sales)
    for bad in (
        lambda: a.group_by("brand"), lambda: a.group_by([], []), lambda: a.group_by("", agg.count()), lambda: a.group_by("$x", agg.count()),
        lambda: a.apply("", "x"), lambda: a.apply("1", " "), lambda: a.filter(""), lambda: a.sort_by([]), lambda: a.sort_by([("a", "UP")]),
        lambda: a.sort_by("a", -1), lambda: a.limit(-1, 1), lambda: a.limit(0, -1), lambda: a.load(""), lambda: a.load([("a", "")]),
        lambda: agg.quantile("p", 1.5), lambda: agg.quantile("p", None), lambda: agg.random_sample("p", 0), lambda: agg.first_value("p", "q", "UP"),
    ):
        with pytest.raises(QueryError):
            bad()


def test_digits_order_doubles_as_spark_does(spark):
    rng = random.Random(3)
    extremes = [5e-324, 2.0**-1074, 2.0**-1022, 2.0**-1000, 1.7976931348623157e308, 2.0**1023, float("inf"), 0.0, 1.0, 1 - 2**-53, 1 + 2**-52, 3.0, 0.1]
    values = extremes + [-v for v in extremes] + [float("nan")] + [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(-310, 309) for _ in range(500)]
    values += [math.nextafter(v, math.inf) for v in values[:200]]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    digits = F.struct(*sortable_digits(F.col("v")))
    out = rows.select("v", digits.alias("d")).collect()
    same = [(tuple(r["d"]), r["v"]) for r in out]
    key = lambda v: (math.isnan(v), v if not math.isnan(v) else 0.0)
    assert [key(v) for _, v in sorted(same, key=lambda x: x[0])] == sorted(map(key, values))
    assert len({d for d, _ in same}) == len({0.0 if v == 0 else v for v in values if not math.isnan(v)}) + 1


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9999, 1.0])
def test_quantile_of_one_group_of_all_distinct_values_with_infinities(spark, q):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.normal(size=30_000) * 10.0 ** rng.integers(-20, 20, 30_000), [np.inf, -np.inf, 0.0, -0.0]])
    rows = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(8)
    found = exact_quantile(rows, [], F.col("v"), q, "x").first()["x"]
    assert found == sorted(values)[int(q * (len(values) - 1))] if (q * (len(values) - 1)) % 1 == 0 else np.isclose(found, np.quantile(values[np.isfinite(values)], q), rtol=0.2)
    plan = exact_quantile(rows, [], F.col("v"), q, "x")._jdf.queryExecution().toString()
    assert "percentile" not in plan


def test_quantile_of_many_groups_with_nulls(spark):
    rng = np.random.default_rng(5)
    rows = [(k if k else None, float(v) if v > -1 else None) for k, v in zip(rng.integers(0, 5, 4000).tolist(), rng.normal(size=4000).round(2).tolist())]
    rows += [(9, 1.5)] * 1000 + [(10, None)]
    df = spark.createDataFrame(rows, "k long, v double")
    for q in (0.1, 0.5, 0.77):
        found = {r["k"]: r["x"] for r in exact_quantile(df, ["k"], F.col("v"), q, "x").collect()}
        for k in {k for k, v in rows if v is not None}:
            assert np.isclose(found[k], np.quantile([v for g, v in rows if g == k and v is not None], q))
        assert 10 not in found


def test_stored_sketches_merge_replace_days_and_err_little(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(f"2024-01-0{d}", "a" if i % 3 else None, int(u) if u % 11 else None, float(v)) for d in range(1, 6) for i, (u, v) in enumerate(zip(rng.integers(0, 3000, 2000), rng.normal(size=2000), strict=True))]
    df = spark.createDataFrame(rows, "day string, g string, u long, v double").withColumn("day", F.to_date("day"))
    stored = SketchTable(spark, f"{tmp_path}/s", "day", ["g"], ["u"], ["v"])
    with pytest.raises(QueryError):
        stored.summary()
    stored.add(df.where("day = '2024-01-01'").limit(10))
    for day in range(1, 6):
        stored.add(df.where(f"day = '2024-01-0{day}'"))  # the first day replaces its half-loaded state
    direct = SketchTable(spark, f"{tmp_path}/d", "day", ["g"], ["u"], ["v"])
    direct.add(df)
    span = F.col("day") > "2024-01-02"
    for group in (["g"], []):
        for table in (stored, direct):
            got = {r["g"] if group else 0: r for r in table.summary(group, span, 0.25).collect()}
            for g in ("a", None) if group else (0,):
                mine = [r for r in rows if r[0] > "2024-01-02" and (not group or r[1] == g)]
                users, values = {r[2] for r in mine if r[2] is not None}, np.array([r[3] for r in mine])
                assert got[g]["rows"] == len(mine) and abs(got[g]["distinct_u"] - len(users)) <= 0.06 * len(users)
                assert abs((values <= got[g]["quantile_v"]).mean() - 0.25) <= 0.02


def test_a_sketch_beside_an_exact_count_is_not_kept_for_each_value(spark):
    rows = spark.createDataFrame([(i % 3, i % 40 if i % 7 else None, i) for i in range(600)], "g int, v int, n int")
    both = [agg.count_distinct("v", "exact"), agg.count_distinctish("v", "sketch"), agg.count_distinctish("n", "other"), agg.sum_("n", "total")]
    found = Aggregation(rows).group_by("g", both).to_df()
    alone = Aggregation(rows).group_by("g", both[1:]).to_df()
    assert sorted(found.drop("exact").collect()) == sorted(alone.collect())
    assert {r["exact"] for r in found.collect()} == {40}
    plan = Aggregation(rows).group_by("g", both[:2]).to_df()._jdf.queryExecution().executedPlan().toString()
    assert "partial_approx_count_distinct(distinct" in plan
    assert Aggregation(rows).group_by([], both).to_df().first()["sketch"] == alone.first()["sketch"]
