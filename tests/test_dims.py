from decimal import Decimal

from pyspark.sql import functions as F
from test_sessions import events

from footfall.functions.rounding import percent, ratio
from footfall.operators.dims import dim_page, dim_product, dim_visitor


def test_equally_frequent_titles_give_the_lower(spark):
    rows = [(str(i), "v", i, "page_view", {"page_path": "/"}) for i in range(4)]
    title = F.when(F.col("event_id") < "2", "B").otherwise("A")
    page = dim_page(events(spark, rows).withColumn("page_title", title)).first()
    assert (page.page_title, page.page_type) == ("A", None)
    assert (page.lifetime_page_views, page.lifetime_visitors) == (4, 1)


def test_product_units_count_carts_once(spark):
    rows = [
        ("a", "v", 0, "product_view", {"product_id": "p"}),
        ("b", "v", 1, "add_to_cart", {"product_id": "p"}),
        ("c", "v", 2, "add_to_cart", {"product_id": "p"}),
        ("d", "v", 3, "search"),
    ]
    named = events(spark, rows).withColumns(
        {
            "quantity": F.lit(2),
            "product_name": F.when(F.col("event_id") == "a", "old").otherwise("new"),
            "product_category": F.col("product_id"),
            "product_price_usd": F.when(F.col("event_id") != "c", F.lit(Decimal("9.50"))),
        }
    )
    row = dim_product(named).first()
    assert (row.product_name, row.category) == ("new", "p")
    assert (row.lifetime_product_views, row.lifetime_add_to_carts) == (1, 2)
    assert (row.lifetime_units_added, row.latest_price_usd) == (4, Decimal("9.50"))


def test_visitor_keeps_first_touch_null_and_latest_login(spark):
    rows = [
        ("a", "v", 0, "search"),
        ("b", "v", 1, "search", {"utm_source": "s", "user_id": "u1"}),
        ("c", "v", 2, "search", {"user_id": "u2"}),
        ("d", "v", 3, "search"),
    ]
    row = dim_visitor(events(spark, rows)).first()
    assert (row.user_id, row.is_identified, row.first_utm_source) == ("u2", True, None)


def test_rates_round_halves_up(spark):
    row = (
        spark.range(1)
        .select(
            percent(F.lit(1), F.lit(800)).alias("a"),  # 0.125
            percent(F.lit(1), F.lit(0)).alias("b"),
            ratio(F.lit(5), F.lit(100), 1).alias("c"),  # 0.05
        )
        .first()
    )
    assert (row.a, row.b, row.c) == (Decimal("0.13"), None, Decimal("0.1"))
