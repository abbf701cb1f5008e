from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from lakesearch.errors import QueryError
from lakesearch.functions.predicates import MATCH_ALL, Geo, GeoRadius, Num, Tag, Text, Timestamp
from lakesearch.operators.search import count_query, filter_query, select_where


def matching(products, schema, where):
    return sorted(r["_key"] for r in select_where(products, where, [], schema).collect())


@pytest.mark.parametrize(
    ("where", "keys"),
    [
        (None, "123456"),
        ("*", "123456"),
        (Tag("category").eq("furniture"), "45"),
        (Tag("category").eq("FURNITURE"), "45"),
        (Tag("category").eq("electronics") & Num("price").lt(200), "23"),
        (Tag("brand").eq(["omega", "ergo"]), "345"),
        (Tag("brand").eq([]), "123456"),
        (Tag("brand").ne([]), "123456"),
        (Tag("brand").ne("acme"), "345"),
        (Tag("brand").like("?rg*"), "45"),
        (Num("price").between(100, 500), "3456"),
        (Num("price").between(150, 500, "neither"), "46"),
        (Num("price").between(150, 500, "left"), "346"),
        (Num("price").between(150, 500, "right"), "456"),
        (Num("price").eq(25), "2"),
        (Num("price").ne(25), "13456"),
        (Text("title").eq("standing desk"), "5"),
        (Text("title").eq("desk standing"), ""),
        (Text("title").ne("desk"), "1236"),
        (Text("title").like("Monitor*"), "6"),
        (Text("title").like("%keybord%"), "3"),
        (Text("title").like("mouse|desk"), "245"),
        (Text("title").wildcard("m?nit*"), "6"),
        (MATCH_ALL | Num("price").lt(100), "2"),
        (MATCH_ALL & Num("price").lt(100), "2"),
        (MATCH_ALL & MATCH_ALL, "123456"),
        ("price > 400 AND @brand = 'acme'", "1"),
    ],
)
def test_predicates(products, product_schema, where, keys):
    assert "".join(matching(products, product_schema, where)) == keys


def test_column_filters_and_counts(products, product_schema):
    assert count_query(products, Tag("category").eq("electronics"), product_schema).first()[0] == 4
    assert count_query(products).first()[0] == 6
    assert count_query(products, Tag("brand").eq("acme") & Num("price").gt(100), product_schema).first()[0] == 2
    assert matching(products, product_schema, F.col("price") > 450) == ["1", "5"]


def test_nulls_fail_positive_and_pass_negative_operators(spark):
    rows = spark.createDataFrame(
        [("a", None, None, None, None, None)], "_key string, t string, n double, x string, g string, ts timestamp_ntz"
    )
    day = "2024-01-01"
    circle = GeoRadius(0, 0, 1)
    positive = [Tag("t").eq("a"), Num("n").eq(1), Text("x").eq("a"), Geo("g").eq(circle), Timestamp("ts").eq(day)]
    negative = [Tag("t").ne("a"), Num("n").ne(1), Text("x").ne("a"), Geo("g").ne(circle), Timestamp("ts").ne(day)]
    assert [select_where(rows, w).count() for w in positive] == [0] * 5
    assert [select_where(rows, w).count() for w in negative] == [1] * 5
    assert select_where(rows, Tag("t").is_missing()).count() == 1


def test_separated_tags_and_arrays(spark):
    rows = spark.createDataFrame([("a", "Red; blue", ["X", "y"])], "_key string, s string, l array<string>")
    from lakesearch.schema import DocumentSchema

    schema = DocumentSchema("t", [{"name": "s", "type": "tag", "attrs": {"separator": ";"}},
                                  {"name": "l", "type": "tag", "attrs": {"case_sensitive": True}}])
    assert select_where(rows, Tag("s").eq(["red"]) & Tag("s").eq("BLUE"), None, schema).count() == 1
    assert select_where(rows, Tag("l").eq("x"), None, schema).count() == 0
    assert select_where(rows, Tag("l").like("X*"), None, schema).count() == 1


@pytest.mark.parametrize(
    ("circle", "inside"),
    [
        (GeoRadius(179.9, 0, 50, "km"), {"east", "west"}),
        (GeoRadius(0, 89.9, 30, "km"), {"pole"}),
        (GeoRadius(0, 0, 1), {"zero"}),
        (GeoRadius(0, 0, 1000, "m"), {"zero"}),
        (GeoRadius(0, 0, 13000, "mi"), {"zero", "east", "west", "pole", "flip"}),
        (GeoRadius(0, 0, 0, "ft"), {"zero"}),
    ],
)
def test_geo_circles_wrap_and_widen(spark, circle, inside):
    rows = spark.createDataFrame(
        [("zero", "0,0"), ("east", "179.95, 0.1"), ("west", "-179.95,0"), ("pole", "170,89.95"), ("flip", "-170,-80"), ("bad", "x,1")],
        "_key string, g string",
    )
    found = {r["_key"] for r in select_where(rows, Geo("g").eq(circle)).collect()}
    assert found == inside
    pairs = rows.where("_key != 'bad'").select("_key", F.struct(
        F.split("g", ",")[0].cast("double").alias("lon"), F.trim(F.split("g", ",")[1]).cast("double").alias("lat")).alias("g"))
    assert {r["_key"] for r in select_where(pairs, Geo("g").eq(circle)).collect()} == inside


def test_geo_units_are_checked():
    with pytest.raises(QueryError):
        GeoRadius(0, 0, 1, "parsec")
    with pytest.raises(QueryError):
        Num("a").between(1, 2, "all")


def test_times_agree_on_every_column_type(spark):
    stamps = ["2024-01-14 23:59:59.9", "2024-01-15 00:00:00", "2024-01-15 00:00:00.7", "2024-01-15 23:59:59.9", "2024-01-16 00:00:00"]
    rows = spark.createDataFrame([(str(i), s) for i, s in enumerate(stamps)], "_key string, s string")
    rows = rows.select("_key", F.col("s").cast("timestamp_ntz").alias("naive"), F.col("s").cast("timestamp").alias("zoned"))
    rows = rows.withColumn("epoch", F.floor(F.unix_millis("zoned") / 1000))
    cases = {
        "123": lambda f: f.eq("2024-01-15"),
        "04": lambda f: f.ne("2024-01-15"),
        "12": lambda f: f.eq(datetime(2024, 1, 15, tzinfo=timezone.utc)),
        "34": lambda f: f.gt("2024-01-15"),
        "1234": lambda f: f.ge(date(2024, 1, 15)),
        "012": lambda f: f.le("2024-01-15"),
        "0": lambda f: f.lt("2024-01-15T00:00:00+00:00"),
        "0123": lambda f: f.between("2024-01-14", "2024-01-15"),
        "1": lambda f: f.between(1705276800, 1705276800.5).and_(Timestamp("zoned").lt(1705276801)) & Num("_n").eq(1),
    }
    rows = rows.withColumn("_n", F.col("_key").cast("int"))
    for column in ("naive", "zoned", "epoch"):
        for keys, case in cases.items():
            found = "".join(sorted(r["_key"] for r in select_where(rows, case(Timestamp(column))).collect()))
            assert found == keys, (column, keys)


def test_bad_times_are_rejected():
    for value in ("yesterday", None, [1]):
        with pytest.raises(QueryError):
            Timestamp("ts").eq(value)


def test_filter_query_pages_and_projects(products, product_schema):
    page = filter_query(products, None, ["title", "price"], k=2, offset=1, schema=product_schema)
    assert page.columns == ["_key", "title", "price"]
    assert [r["_key"] for r in page.collect()] == ["2", "3"]
    ordered = filter_query(products, None, ["price"], sort_by="price", sort_order="DESC", limit=2, schema=product_schema)
    assert [r["price"] for r in ordered.collect()] == [1200.0, 500.0]
    for bad in (dict(k=0), dict(offset=-1), dict(sort_by="price", sort_order="UP")):
        with pytest.raises(QueryError):
            filter_query(products, **bad)


def test_filters_reach_the_scan(spark):
    from lakesearch.plans.tables import EVENTS, PART

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = select_where(events, Timestamp("ts").eq("2024-01-15") & Tag("event_type").eq("click"), ["value"], EVENTS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text and "EqualTo(event_type,click)" in text and "props" not in text
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    plan = select_where(part, Tag("p_brand").like("Brand#1*"), ["p_size"], PART)
    assert "StringStartsWith(p_brand,Brand#1)" in plan._jdf.queryExecution().executedPlan().toString()
