"""Reports for the group/reduce aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.predicates import Num, Tag, Timestamp
from ..operators import aggregation as agg
from ..operators.aggregation import Aggregation
from ..operators.sketches import SketchTable
from ..runtime import shared_folder
from ..schema import DocumentSchema
from .tables import DOCUMENTS, EVENTS, ORDERS, Report, table
from .texts import scored_sql

LINES = DocumentSchema("lineitem", [], key="_line")
_OUT = 4


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, _OUT).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def _events(*reducers, by=("event_type",), where=None):
    def run(spark, folder) -> DataFrame:
        return _rounded(Aggregation(table(spark, folder, "events"), where, EVENTS).group_by(list(by), list(reducers)).to_df())

    return run


def _lines(*reducers, by=("l_returnflag", "l_linestatus"), where=None):
    def run(spark, folder) -> DataFrame:
        return _rounded(Aggregation(table(spark, folder, "lineitem"), where, LINES).group_by(list(by), list(reducers)).to_df())

    return run


def _summary(spark, folder) -> DataFrame:
    """Pricing summary: several reducers in one pass, then a computed column and an order."""
    lines = Aggregation(table(spark, folder, "lineitem"), Timestamp("l_shipdate").le("1998-09-02"), LINES)
    lines = lines.apply("l_extendedprice * (1 - l_discount)", "net")
    lines = lines.group_by(
        ["l_returnflag", "@l_linestatus"],
        [agg.sum_("l_quantity", "sum_qty"), agg.sum_("net", "sum_net"), agg.avg("l_discount", "avg_discount"), agg.count("n")],
    )
    lines = lines.apply("@sum_net / @sum_qty", "unit").sort_by(["l_returnflag", "l_linestatus"])
    return _rounded(lines.to_df())


def _approximate_distinct(spark, folder) -> DataFrame:
    """The sketch beside the exact count: within six of its standard deviations."""
    found = Aggregation(table(spark, folder, "lineitem"), None, LINES).group_by(
        "l_returnflag", [agg.count_distinct("l_orderkey", "exact"), agg.count_distinctish("l_orderkey", "sketch")]
    )
    return found.apply("abs(sketch - exact) <= 0.12 * exact", "close").to_df().drop("sketch")


def _samples(spark, folder) -> DataFrame:
    """Sample sizes, and whether every sampled value is a value of its group."""
    events = table(spark, folder, "events")
    found = Aggregation(events, None, EVENTS).group_by(
        "event_type", [agg.count("n"), agg.random_sample("user_id", 7, "sample"), agg.to_list("user_id", "users")]
    )
    found = found.apply("size(sample)", "sampled").apply("size(array_except(sample, users)) = 0", "inside")
    return found.to_df().select("event_type", "n", "sampled", "inside")


def _signed_zeros(spark, folder) -> DataFrame:
    """Events in groups 0.0, -0.0 (one group) and 1.0."""
    side = F.when(F.col("event_type") == "click", F.lit(1.0)).when(F.col("event_id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0))
    return table(spark, folder, "events").withColumn("side", side)


def _signed_zero_quantile(spark, folder) -> DataFrame:
    found = Aggregation(_signed_zeros(spark, folder), None, EVENTS).group_by("side", [agg.quantile("value", 0.5, "median", exact=True), agg.count("n")])
    return _rounded(found.to_df()).withColumn("side", F.abs("side"))


def _signed_zero_sample(spark, folder) -> DataFrame:
    """As many sampled values as asked for, and none for a group without values."""
    rows = _signed_zeros(spark, folder).withColumn("some", F.when(F.col("side") != 1, F.col("user_id")))
    found = Aggregation(rows, None, EVENTS).group_by("side", [agg.random_sample("some", 5, "sample"), agg.count("n")])
    return found.to_df().select(F.abs("side").alias("side"), F.size("sample").alias("sampled"), "n")


def _sketch_rank(spark, folder) -> DataFrame:
    """The sketch median lies between the exact quantiles one thousandth of the ranks to its sides."""
    found = Aggregation(table(spark, folder, "lineitem"), None, LINES).group_by(
        "l_returnflag",
        [agg.quantile("l_extendedprice", 0.5, "sketch"), agg.quantile("l_extendedprice", 0.499, "low", exact=True),
         agg.quantile("l_extendedprice", 0.501, "high", exact=True)],
    )
    return found.apply("sketch BETWEEN low AND high", "close").to_df().select("l_returnflag", "close")


def _stored_sketches(spark, folder) -> DataFrame:
    """Users and values of a range of days from stored sketches, beside the exact answers: within a few of their errors."""
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    stored = SketchTable(spark, shared_folder(spark, "sketches"), "day", ["event_type"], ["user_id"], ["value"])
    stored.add(events.where("day < DATE'2024-01-20'"))
    stored.add(events.where("day >= DATE'2024-01-20'"))
    span = F.col("day").between("2024-01-05", "2024-01-24")
    found = stored.summary(["event_type"], span, 0.9)
    rows = events.where(span)
    exact = rows.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    ranks = rows.join(F.broadcast(found.select("event_type", "quantile_value")), "event_type").groupBy("event_type").agg(F.avg((F.col("value") <= F.col("quantile_value")).cast("int")).alias("rank"))
    close = found.join(exact, "event_type").join(ranks, "event_type")
    return close.select("event_type", F.col("rows").alias("n"), "users", (F.abs(F.col("distinct_user_id") - F.col("users")) <= 0.06 * F.col("users") + 1).alias("users_close"), (F.abs(F.col("rank") - 0.9) <= 0.03).alias("rank_close"))


def _scores(spark, folder) -> DataFrame:
    docs = Aggregation(table(spark, folder, "documents"), Num("n_chars").gt(100), DOCUMENTS)
    docs = docs.add_scores("restin heed dans", "text").verbatim()
    docs = docs.group_by("lang", [agg.count("n"), agg.max_("__score", "best"), agg.avg("__score", "mean")])
    return _rounded(docs.to_df())


def _params(spark, folder) -> DataFrame:
    found = Aggregation(table(spark, folder, "orders"), "o_orderpriority = $level AND o_totalprice > :low", ORDERS)
    found = found.params(level="1-URGENT", low=50000.0).group_by("o_orderstatus", [agg.count("n")]).apply("n * :low", "scaled")
    return _rounded(found.to_df())


def _references(spark, folder) -> DataFrame:
    nested = table(spark, folder, "events").withColumn("detail", F.struct(F.col("value").alias("amount"), "event_type"))
    found = Aggregation(nested, None, EVENTS).load([("$.detail.amount", "amount"), "@user_id"])
    found = found.group_by("$.detail.event_type", [agg.sum_("amount", "total"), agg.count_distinct("@user_id", "users")])
    return _rounded(found.to_df())


def _load(spark, folder) -> DataFrame:
    rows = Aggregation(table(spark, folder, "events"), Num("value").gt(90), EVENTS)
    rows = rows.load(["event_id", ("user_id", "who")]).load("$.props.k").apply("cast(k as int) + 1", "next")
    return rows.to_df()


REPORTS: dict[str, Report] = {
    "A1_filtered_source": Report(
        _events(agg.count("n"), where=Tag("event_type").eq(["click", "view"])),
        "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY event_type"),
    "A2_group_by": Report(
        _summary,
        "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 4) AS sum_qty, round(sum(net), 4) AS sum_net, "
        "round(avg(l_discount), 4) AS avg_discount, count(*) AS n, round(sum(net) / sum(l_quantity), 4) AS unit "
        "FROM (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem "
        "WHERE date_trunc('second', l_shipdate) <= TIMESTAMP '1998-09-02') GROUP BY 1, 2"),
    "A3_global_group": Report(
        _lines(agg.count("n"), agg.sum_("l_quantity", "total"), by=()),
        "SELECT count(*) AS n, round(sum(l_quantity), 4) AS total FROM lineitem"),
    "A4_count": Report(_lines(agg.count("n")), "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2"),
    "A5_count_distinct": Report(
        _lines(agg.count_distinct("l_suppkey", "suppliers"), by=("l_returnflag",)),
        "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1"),
    "A6_count_distinctish": Report(
        _approximate_distinct,
        "SELECT l_returnflag, count(DISTINCT l_orderkey) AS exact, true AS close FROM lineitem GROUP BY 1"),
    "A7_sum": Report(_events(agg.sum_("value", "total")), "SELECT event_type, round(sum(value), 4) AS total FROM events GROUP BY 1"),
    "A8_min": Report(_events(agg.min_("value", "low")), "SELECT event_type, round(min(value), 4) AS low FROM events GROUP BY 1"),
    "A9_max": Report(_events(agg.max_("value", "high")), "SELECT event_type, round(max(value), 4) AS high FROM events GROUP BY 1"),
    "A10_avg": Report(_events(agg.avg("value", "mean")), "SELECT event_type, round(avg(value), 4) AS mean FROM events GROUP BY 1"),
    "A11_stddev": Report(
        _events(agg.stddev("value", "spread")), "SELECT event_type, round(stddev_samp(value), 4) AS spread FROM events GROUP BY 1"),
    "A12_stored_sketches": Report(
        _stored_sketches,
        "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS users_close, true AS rank_close FROM events "
        "WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-24' GROUP BY 1"),
    "A12_quantile_exact": Report(
        _lines(agg.quantile("l_extendedprice", 0.9, "q90", exact=True), agg.count("n"), by=("l_returnflag",)),
        "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 4) AS q90, count(*) AS n FROM lineitem GROUP BY 1"),
    "A12_quantile_sketch": Report(_lines(agg.quantile("l_extendedprice", 0.5, "median"), by=("l_returnflag",))),
    "A12_sketch_rank": Report(_sketch_rank, "SELECT DISTINCT l_returnflag, true AS close FROM lineitem"),
    "A12_signed_zero_groups": Report(
        _signed_zero_quantile,
        "SELECT CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END::DOUBLE AS side, round(quantile_cont(value, 0.5), 4) AS median, "
        "count(*) AS n FROM events GROUP BY 1"),
    "A15_signed_zero_groups": Report(
        _signed_zero_sample,
        "SELECT CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END::DOUBLE AS side, CASE WHEN min(event_type = 'click') THEN 0 ELSE 5 END::INTEGER "
        "AS sampled, count(*) AS n FROM events GROUP BY 1"),
    "A13_to_list": Report(
        _lines(agg.to_list("l_linestatus", "statuses"), by=("l_returnflag",)),
        "SELECT l_returnflag, list_sort(list(DISTINCT l_linestatus)) AS statuses FROM lineitem GROUP BY 1"),
    "A14_first_value": Report(
        _events(agg.first_value("user_id", by="value", direction="DESC", alias="top_user"),
                agg.first_value("user_id", by="ts", alias="first_user"), agg.first_value("user_id", alias="lowest_id_user")),
        "SELECT event_type, arg_max(user_id, row(value, event_id)) AS top_user, arg_min(user_id, row(ts, event_id)) "
        "AS first_user, arg_min(user_id, event_id) AS lowest_id_user FROM events GROUP BY 1"),
    "A15_random_sample": Report(
        _samples,
        "SELECT event_type, count(*) AS n, least(7, count(*))::INTEGER AS sampled, true AS inside FROM events GROUP BY 1"),
    "A16_apply": Report(
        lambda s, d: _rounded(Aggregation(table(s, d, "orders"), Num("o_totalprice").gt(100000), ORDERS).load("o_orderkey")
                              .apply("@o_totalprice * 1.1", "gross").apply("try_divide(1, o_custkey)", "share").to_df()),
        "SELECT o_orderkey, round(o_totalprice * 1.1, 4) AS gross, round(1.0::DOUBLE / nullif(o_custkey, 0), 4) AS share "
        "FROM orders WHERE o_totalprice > 100000"),
    "A17_having": Report(
        lambda s, d: Aggregation(table(s, d, "orders"), None, ORDERS).group_by("o_custkey", agg.count("n"))
        .filter("@n > 15").to_df(),
        "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 15"),
    "A18_sort_top": Report(
        lambda s, d: _rounded(Aggregation(table(s, d, "orders"), None, ORDERS).group_by("o_custkey", agg.sum_("o_totalprice", "spent"))
                              .sort_by([("spent", "DESC")], max=20).to_df()),
        "SELECT o_custkey, round(sum(o_totalprice), 4) AS spent FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"),
    "A19_limit": Report(
        lambda s, d: Aggregation(table(s, d, "orders"), None, ORDERS).group_by("o_custkey", agg.count("n"))
        .sort_by([("n", "DESC"), "o_custkey"]).limit(5, 10).to_df(),
        "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10 OFFSET 5"),
    "A20_load": Report(
        _load,
        "SELECT event_id, user_id AS who, (props::JSON ->> '$.k') AS k, CAST(props::JSON ->> '$.k' AS INTEGER) + 1 AS next "
        "FROM events WHERE value > 90"),
    "A21_params": Report(
        _params,
        "SELECT o_orderstatus, count(*) AS n, round(count(*) * 50000.0::DOUBLE, 4) AS scaled FROM orders "
        "WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 50000 GROUP BY 1"),
    "A22_text_scores": Report(
        _scores,
        "SELECT lang, count(*) AS n, round(max(score), 4) AS best, round(avg(score), 4) AS mean FROM ("
        + scored_sql("SELECT * FROM (VALUES (0, 'restin', 1, 1.0::DOUBLE), (0, 'heed', 1, 1.0::DOUBLE), "
                     "(0, 'dans', 1, 1.0::DOUBLE)) v(query_id, term, words, weight)")
        + ") JOIN documents USING (doc_id) WHERE n_chars > 100 GROUP BY lang"),
    "A23_field_references": Report(
        _references,
        "SELECT event_type, round(sum(value), 4) AS total, count(DISTINCT user_id) AS users FROM events GROUP BY 1"),
}
