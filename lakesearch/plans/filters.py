"""Reports for predicates, projection, counting, sorting and paging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.predicates import INCLUSIVE_MODES, MATCH_ALL, Geo, GeoRadius, Num, Predicate, Tag, Text, Timestamp
from ..operators.search import count_query, filter_query, paged, select_where
from .tables import CUSTOMERS, DOCUMENTS, EVENTS, ORDERS, PART, Report, table

TOKENS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_PADDED = f"(' ' || array_to_string({TOKENS}, ' ') || ' ')"

# The circle crosses the date line.
_CIRCLE = GeoRadius(172.5, 40.0, 3000, "km")
_LON, _LAT = "((c_custkey * 37) % 36000) / 100.0 - 180", "((c_custkey * 53) % 18000) / 100.0 - 90"
_GEO_SQL = (
    "SELECT c_custkey FROM (SELECT c_custkey, 2 * 6372797.560856 * asin(sqrt(least(1.0, "
    "pow(sin(radians(lat - 40.0) / 2), 2) + cos(radians(40.0)) * cos(radians(lat)) "
    "* pow(sin(radians(lon - 172.5) / 2), 2)))) AS d "
    f"FROM (SELECT c_custkey, {_LON} AS lon, {_LAT} AS lat FROM customer)) WHERE "
)


def _part(where: Predicate):
    return lambda spark, folder: select_where(
        table(spark, folder, "part"), where, ["p_name", "p_brand", "p_retailprice"], PART
    )


_PART_SQL = "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part"


def _documents(where: Predicate):
    def run(spark, folder) -> DataFrame:
        docs = table(spark, folder, "documents").withColumn("tags", F.concat_ws(",", "lang", "source"))
        return select_where(docs, where, ["lang", "source"], DOCUMENTS)

    return run


_DOC_SQL = "SELECT doc_id, lang, source FROM documents"


def _events(where: Predicate):
    def run(spark, folder) -> DataFrame:
        rows = table(spark, folder, "events").withColumn("kind", F.expr("nullif(event_type, 'error')"))
        return select_where(rows, where, ["ts", "kind", "value"], EVENTS)

    return run


_EVENT_SQL = "SELECT event_id, ts, kind, value FROM (SELECT *, nullif(event_type, 'error') AS kind FROM events)"


def _customers(where: Predicate):
    def run(spark, folder) -> DataFrame:
        lon, lat = F.expr(_LON).cast("double"), F.expr(_LAT).cast("double")
        rows = table(spark, folder, "customer").withColumn("geo", F.concat_ws(",", lon, lat))
        return select_where(rows, where, [], CUSTOMERS)

    return run


def _between_counts(spark, folder) -> DataFrame:
    parts = table(spark, folder, "part")
    counts = [
        count_query(parts, Num("p_size").between(10, 20, mode), PART).select(F.lit(mode).alias("mode"), "total")
        for mode in INCLUSIVE_MODES
    ]
    return reduce(DataFrame.union, counts)


def _between_sql() -> str:
    ends = {"both": (">=", "<="), "neither": (">", "<"), "left": (">=", "<"), "right": (">", "<=")}
    return " UNION ALL ".join(
        f"SELECT '{m}' AS mode, count(*) AS total FROM part WHERE p_size {a} 10 AND p_size {b} 20"
        for m, (a, b) in ends.items()
    )


def _orders_sorted(spark, folder) -> DataFrame:
    return filter_query(
        table(spark, folder, "orders"), Num("o_totalprice").gt(1000), ["o_custkey", "o_totalprice"], k=50,
        sort_by="o_totalprice", sort_order="DESC", schema=ORDERS,
    )


def _orders_paged(spark, folder) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return paged(rows.orderBy("o_orderdate", "o_orderkey"), 40, None)


REPORTS: dict[str, Report] = {
    "F1_tag_eq": Report(_part(Tag("p_brand").eq(["Brand#2", "Brand#17"])),
                        f"{_PART_SQL} WHERE p_brand IN ('Brand#2', 'Brand#17')"),
    "F1_tag_eq_many_values": Report(
        _documents(Tag("tags").eq(["FR", "Src3"])), f"{_DOC_SQL} WHERE lower(lang) = 'fr' OR lower(source) = 'src3'"),
    "F1_tag_eq_empty_list": Report(_part(Tag("p_brand").eq([])), _PART_SQL),
    "F2_tag_ne": Report(_part(Tag("p_brand").ne("Brand#2")), f"{_PART_SQL} WHERE p_brand <> 'Brand#2'"),
    "F2_tag_ne_keeps_missing": Report(
        _events(Tag("kind").ne("click")), f"{_EVENT_SQL} WHERE kind IS NULL OR kind <> 'click'"),
    "F3_tag_like_prefix": Report(_part(Tag("p_brand").like("Brand#1*")), f"{_PART_SQL} WHERE p_brand LIKE 'Brand#1%'"),
    "F3_tag_like": Report(
        _part(Tag("p_type").like(["?MALL", "*ON*"])), f"{_PART_SQL} WHERE p_type LIKE '_MALL' OR p_type LIKE '%ON%'"),
    "F4_num_eq": Report(_part(Num("p_size").eq(15)), f"{_PART_SQL} WHERE p_size = 15"),
    "F4_num_ne": Report(_part(Num("p_size").ne(15)), f"{_PART_SQL} WHERE p_size <> 15"),
    "F5_num_gt": Report(_part(Num("p_retailprice").gt(960)), f"{_PART_SQL} WHERE p_retailprice > 960"),
    "F5_num_lt": Report(_part(Num("p_retailprice").lt(950)), f"{_PART_SQL} WHERE p_retailprice < 950"),
    "F5_num_ge": Report(_part(Num("p_size").ge(40)), f"{_PART_SQL} WHERE p_size >= 40"),
    "F5_num_le": Report(_part(Num("p_size").le(5)), f"{_PART_SQL} WHERE p_size <= 5"),
    "F6_num_between": Report(_between_counts, _between_sql()),
    "F7_text_eq": Report(_documents(Text("text").eq("the and")), f"{_DOC_SQL} WHERE contains({_PADDED}, ' the and ')"),
    "F8_text_ne": Report(_documents(Text("text").ne("the and")), f"{_DOC_SQL} WHERE NOT contains({_PADDED}, ' the and ')"),
    "F9_text_prefix": Report(
        _documents(Text("text").like("her*")),
        f"{_DOC_SQL} WHERE len(list_filter({TOKENS}, lambda t: starts_with(t, 'her'))) > 0"),
    "F9_text_wildcard": Report(
        _documents(Text("text").like("er?nt*")),
        f"{_DOC_SQL} WHERE len(list_filter({TOKENS}, lambda t: t LIKE 'er_nt%')) > 0"),
    "F9_text_fuzzy": Report(
        _documents(Text("text").like("%%erestion%%")),
        f"{_DOC_SQL} WHERE len(list_filter({TOKENS}, lambda t: levenshtein(regexp_replace(t, '[^a-z0-9]', '?', 'g'), 'erestion') <= 2)) > 0"),
    "F9_text_any_of": Report(
        _documents(Text("text").like("heed|dans")), f"{_DOC_SQL} WHERE list_has_any({TOKENS}, ['heed', 'dans'])"),
    "F10_geo_within": Report(_customers(Geo("geo").eq(_CIRCLE)), f"{_GEO_SQL} d <= 3000000"),
    "F11_geo_outside": Report(_customers(Geo("geo").ne(_CIRCLE)), f"{_GEO_SQL} d > 3000000"),
    "F12_time_on_day": Report(
        _events(Timestamp("ts").eq("2024-01-15")),
        f"{_EVENT_SQL} WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'"),
    "F12_time_not_on_day": Report(
        _events(Timestamp("ts").ne("2024-01-15")),
        f"{_EVENT_SQL} WHERE NOT (ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16')"),
    "F12_time_at_second": Report(
        _events(Timestamp("ts").eq("2024-01-01T00:03:52")),
        f"{_EVENT_SQL} WHERE date_trunc('second', ts) = TIMESTAMP '2024-01-01 00:03:52'"),
    "F13_time_gt": Report(
        _events(Timestamp("ts").gt("2024-01-20T10:00:00")),
        f"{_EVENT_SQL} WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-20 10:00:00'"),
    "F13_time_lt": Report(
        _events(Timestamp("ts").lt("2024-01-03T10:00:00")),
        f"{_EVENT_SQL} WHERE date_trunc('second', ts) < TIMESTAMP '2024-01-03 10:00:00'"),
    "F13_time_ge": Report(
        _events(Timestamp("ts").ge("2024-01-29")), f"{_EVENT_SQL} WHERE ts >= TIMESTAMP '2024-01-29'"),
    "F13_time_le_day_start": Report(
        _events(Timestamp("ts").le("2024-01-02")),
        f"{_EVENT_SQL} WHERE date_trunc('second', ts) <= TIMESTAMP '2024-01-02'"),
    "F13_time_between_days": Report(
        _events(Timestamp("ts").between("2024-01-10", "2024-01-12")),
        f"{_EVENT_SQL} WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'"),
    "F14_is_missing": Report(_events(Tag("kind").is_missing()), f"{_EVENT_SQL} WHERE kind IS NULL"),
    "F15_and": Report(
        _part(Tag("p_brand").eq("Brand#2") & Num("p_size").gt(20)),
        f"{_PART_SQL} WHERE p_brand = 'Brand#2' AND p_size > 20"),
    "F15_or": Report(
        _part(Tag("p_brand").eq("Brand#2") | Num("p_size").gt(45)),
        f"{_PART_SQL} WHERE p_brand = 'Brand#2' OR p_size > 45"),
    "F15_or_with_match_all": Report(
        _part(MATCH_ALL | Num("p_size").gt(45)), f"{_PART_SQL} WHERE p_size > 45"),
    "F16_match_all": Report(_events(MATCH_ALL), _EVENT_SQL),
    "F17_projection": Report(
        lambda s, d: select_where(table(s, d, "lineitem"), Num("l_quantity").ge(49), ["l_orderkey", "l_linenumber", "@l_quantity"]),
        "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 49"),
    "F18_filter_page": Report(
        lambda s, d: filter_query(table(s, d, "part"), Num("p_size").gt(10), ["p_name"], k=20, offset=30, schema=PART),
        "SELECT p_partkey, p_name FROM part WHERE p_size > 10 ORDER BY p_partkey LIMIT 20 OFFSET 30"),
    "F19_count": Report(
        lambda s, d: count_query(table(s, d, "lineitem"), Num("l_quantity").gt(25)),
        "SELECT count(*) AS total FROM lineitem WHERE l_quantity > 25"),
    "O1_sorted_search": Report(
        _orders_sorted,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 1000 "
        "ORDER BY o_totalprice DESC, o_orderkey LIMIT 50"),
    "O2_paging": Report(
        _orders_paged, "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10 OFFSET 40"),
    "O3_top_k": Report(
        lambda s, d: filter_query(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").withColumn(
            "_key", F.struct("l_orderkey", "l_linenumber")), None, None, k=25, sort_by="l_extendedprice",
            sort_order="DESC").drop("_key"),
        "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
        "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 25"),
}
