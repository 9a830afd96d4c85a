import pytest
from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.functions import scalars as fn
from cartwheel.session import build_session


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("r, f, m, label", [
    (None, None, None, "Never Bought"), (5, 0, 900.0, "Never Bought"), (181, 9, 900.0, "Lost"), (180, 1, 100.5, "At Risk"),
    (61, 1, 100.0, "New"), (30, 5, 200.0, "Champions"), (30, 5, 199.0, "Loyal"), (60, 3, 1.0, "Loyal"),
    (30, 2, 1.0, "Promising"), (31, 2, 1.0, "New"), (45, 2, 999.0, "New"),
])
def test_rfm_segment(spark, r, f, m, label):
    args = [F.lit(v).cast(t) for v, t in ((r, "int"), (f, "bigint"), (m, "double"))]
    assert one(spark, fn.rfm_segment(*args)) == label


@pytest.mark.parametrize("referrer, category", [
    ("www.google.com", "organic_search"), ("yahoo", "organic_search"), ("m.facebook.com", "social"), ("Google", "other"),
    ("twitter.com", "social"), ("email", "email"), ("email.example", "other"), ("direct", "direct"), ("", "direct"),
    (None, "direct"), ("google.facebook", "organic_search"),
])
def test_referrer_category(spark, referrer, category):
    assert one(spark, fn.referrer_category(F.lit(referrer).cast("string"))) == category


@pytest.mark.parametrize("name, parts", [
    ("2019-Oct.csv", ("2019", "10")), ("a/b/2019-9.csv", ("2019", "09")), ("2019-11.csv", ("2019", "11")),
    ("2019-oct.csv", None), ("2019.csv", None), ("2019-10-01.csv", None), ("notes.txt", None),
])
def test_file_month(spark, name, parts):
    got = one(spark, fn.file_month(F.lit(name)))
    assert (tuple(got) if got else None) == parts


@pytest.mark.parametrize("x, want", [(1.005, 1.01), (2.675, 2.68), (0.125, 0.13), (33.333, 33.33), (-0.125, -0.13), (-1.005, -1.01), (0.0, 0.0), (None, None),
                                     (0.0249999995, 0.02), (-0.0249999995, -0.02), (93000000000000016.0, 93000000000000016.0), (1e27, 1e27), (1e30, None),
                                     (float("nan"), None), (float("inf"), None), (1e-20, 0.0)])
def test_half_up(spark, x, want):
    assert one(spark, fn.half_up(F.lit(x).cast("double"))) == want


@pytest.mark.parametrize("x, want, cents", [("92000000000000000.005", 92000000000000000.01, 9200000000000000001), ("0.0249999995", 0.02, 2),
                                            ("-2.675", -2.68, -268), ("1.0049999999", 1.0, 100)])
def test_decimals_are_rounded_exactly(spark, x, want, cents):
    exact = F.lit(x).cast("decimal(38,10)")
    assert one(spark, fn.half_up(exact)) == want and one(spark, fn.cents(exact)) == cents


def test_versions_of_a_schema():
    wide = schemas.resolved("a INT, b FLOAT, c DECIMAL(10,2), d DATE, e STRING, f INT", "f DECIMAL(12,4), a BIGINT, b DOUBLE, c DECIMAL(8,4), d TIMESTAMP, g INT")
    assert [(f.name, f.dataType.simpleString()) for f in wide] == [
        ("a", "bigint"), ("b", "double"), ("c", "decimal(12,4)"), ("d", "timestamp"), ("e", "string"), ("f", "decimal(14,4)"), ("g", "int")]
    for other in ("a STRING", "a BOOLEAN", "a DECIMAL(38,37)"):
        with pytest.raises(ValueError, match="^a: no type holds"):
            schemas.resolved("a INT", other)
    assert schemas.change_schema("orders", "channel STRING")["after"].dataType["channel"].dataType.simpleString() == "string"
    with pytest.raises(ValueError, match="quantity"):
        schemas.change_schema("orders", "quantity STRING")


def test_masks(spark):
    assert one(spark, fn.mask_phone(F.lit("+84 912-345-678"))) == "+** ***-***-678"
    masked = one(spark, fn.mask_email(F.lit("An.Person@shop.example")))
    assert masked.endswith("@shop.example") and "Person" not in masked
    assert masked == one(spark, fn.mask_email(F.lit("an.person@shop.example")))


def test_untrusted_input_gives_null_not_an_error(spark):
    assert one(spark, fn.iso_timestamp(F.lit("soon"))) is None
    assert one(spark, fn.pct(F.lit(1), F.lit(0))) is None


def test_change_schema():
    schema = schemas.change_schema("orders")
    assert schema.fieldNames() == ["before", "after", "op", "ts_ms", "source"]
    assert schema["before"].dataType == schema["after"].dataType
    assert sorted(schemas.PAYLOADS) == ["categories", "coupons", "order_items", "orders", "products", "reviews", "users"]
    with pytest.raises(ValueError, match="orders"):
        schemas.change_schema("nothing")


def test_silver_clicks_lose_the_pseudo_order():
    assert "pseudo_order_id" in schemas.click_schema().fieldNames()
    assert "pseudo_order_id" not in schemas.landed_click_schema().fieldNames()
    assert len(schemas.landed_click_schema()) == len(schemas.click_schema())


def test_a_job_needs_a_name():
    with pytest.raises(ValueError):
        build_session("")
