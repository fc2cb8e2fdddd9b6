import decimal
import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillscope.functions import (
    exact_money,
    cidr_contains,
    cidr_first,
    cidr_last,
    cidr_prefix,
    day_text,
    epoch_ms,
    ip_to_long,
    long_to_ip,
    money_of,
    parse_moment,
    register_functions,
)

# Addresses and their integers.
ADDRESSES = {
    "10.10.10.10": 168430090,
    " 0.166.68.89": 10896473,
    "249.5.128.6": 4177887238,
    "215.39.139.91": 3609693019,
    "249.70.127.130": 4182146946,
    "38.101.171.224": 644197344,
    "27.238.136.11": 468617227,
    "84.38.11.162": 1411779490,
    "116.48.124.164": 1949334692,
    "20.25.239.179": 337244083,
    "62.158.125.95": 1050574175,
    "176.154.86.16": 2962904592,
}

# Addresses and the blocks they lie in.
MEMBERS = {
    "215.39.139.91": "215.32.0.0/11",
    "38.101.171.224": "38.101.128.0/18",
    "27.238.136.11": "27.232.0.0/13",
    "84.38.11.162": "84.38.8.0/21",
    "116.48.124.164": "116.48.0.0/15",
    "20.25.239.179": "20.0.0.0/11",
    "62.158.125.95": "62.158.0.0/16",
    "176.154.86.16": "176.128.0.0/10",
}


def _values(spark, column, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, x STRING")
    return [r.v for r in rows.select("i", column.alias("v")).orderBy("i").collect()]


def test_addresses_to_integers(spark):
    assert _values(spark, ip_to_long("x"), ADDRESSES) == list(ADDRESSES.values())


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1.2", 16908288),  # left-aligned
        ("1.2.", 16908288),
        ("1.2.3.4.", 16909060),
        ("1.2.3.4.5", 16909060),
        ("1 . 2. 3 .4 ", 16909060),
        ("300.1.1.1", 738263297),  # octets wrap
        ("255.255.255.255", 4294967295),
        ("0.0.0.0", 0),
        ("a.b", None),
        ("1..2.3", None),
        ("", None),
        ("::1", None),
        (None, None),
    ],
)
def test_unusual_addresses(spark, text, expected):
    assert _values(spark, ip_to_long("x"), [text]) == [expected]


def test_null_as_zero(spark):
    texts = [None, "0.0.1.0", "x"]
    assert _values(spark, ip_to_long("x", null_as_zero=True), texts) == [0, 256, None]
    assert _values(spark, cidr_first("x", null_as_zero=True), [None]) == [0]
    assert _values(spark, cidr_last("x", null_as_zero=True), [None]) == [0]


def test_strict_address_fails(spark):
    assert _values(spark, ip_to_long("x", strict=True), [None, "1.2.3.4"]) == [None, 16909060]
    with pytest.raises(PySparkException, match="not an IPv4 address: a.b"):
        _values(spark, ip_to_long("x", strict=True), ["a.b"])


@pytest.mark.parametrize(
    ("cidr", "prefix", "first", "last"),
    [
        ("1.1.1.1/24", 24, 16843008, 16843263),
        ("1.1.1.1/32", 32, 16843009, 16843009),
        ("1.1.1.1/31", 31, 16843008, 16843009),
        ("255.255.255.255/0", 0, 0, 4294967295),
        (" 128.0.0.0/1 ", 1, 2147483648, 4294967295),
        ("1.1.1/24", None, None, None),
        ("1.1.1.256/24", None, None, None),
        ("1.1.1.1/33", None, None, None),
        ("1.1.1.1", None, None, None),
        ("2001:db8::/32", None, None, None),
        (None, None, None, None),
    ],
)
def test_block_bounds(spark, cidr, prefix, first, last):
    assert _values(spark, cidr_prefix("x"), [cidr]) == [prefix]
    assert _values(spark, cidr_first("x"), [cidr]) == [first]
    assert _values(spark, cidr_last("x"), [cidr]) == [last]


def test_members_and_bounds_are_inside(spark):
    pairs = [(ip, cidr, True) for ip, cidr in MEMBERS.items()]
    pairs += [
        ("215.32.0.0", "215.32.0.0/11", True),
        ("215.63.255.255", "215.32.0.0/11", True),
        ("215.64.0.0", "215.32.0.0/11", False),
        ("215.31.255.255", "215.32.0.0/11", False),
        ("1.2", "1.2.0.0/16", None),
        (None, "1.2.0.0/16", None),
    ]
    rows = spark.createDataFrame(pairs, "ip STRING, cidr STRING, expected BOOLEAN")
    for row in rows.select("*", cidr_contains("ip", "cidr").alias("got")).collect():
        assert row.got == row.expected, row


def test_dotted_text_returns(spark):
    texts = [t.strip() for t in ADDRESSES]
    rows = spark.createDataFrame([(t,) for t in texts], "x STRING").withColumn(
        "n", ip_to_long("x")
    )
    back = rows.select("x", long_to_ip("n").alias("y")).collect()
    assert all(r.x == r.y for r in back)
    assert rows.select(long_to_ip("CAST(NULL AS BIGINT)").alias("y")).first().y is None


def test_sql_functions_are_inlined(spark):
    register_functions(spark)
    row = spark.sql(
        """SELECT getIP('10.10.10.10') AS ip, getStartIP('1.1.1.1/24') AS lo,
                  getEndIP('1.1.1.1/24') AS hi, getNetworkAddress('1.1.1.1/24') AS lo_text,
                  getBroadcastAddress('1.1.1.1/24') AS hi_text,
                  isInRange('1.1.1.255', '1.1.1.1/24') AS inside, getIP(NULL) AS none"""
    ).first()
    assert tuple(row) == (168430090, 16843008, 16843263, "1.1.1.0", "1.1.1.255", True, None)
    spark.createDataFrame([("1.2.3.4",)], "ip STRING").createOrReplaceTempView("addresses")
    plan = spark.sql("SELECT getIP(ip) FROM addresses")._jdf.queryExecution().toString()
    assert "EvalPython" not in plan
    register_functions(spark, null_as_zero=True)
    row = spark.sql("SELECT getIP(NULL) a, getStartIP(NULL) b, getEndIP(NULL) c").first()
    assert tuple(row) == (0, 0, 0)
    register_functions(spark)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2010-10-15 04:52:40.388", datetime.datetime(2010, 10, 15, 4, 52, 40, 388000)),
        (" 2010-10-15 04:52:40 ", datetime.datetime(2010, 10, 15, 4, 52, 40)),
        ("2010-10-15", None),
        ("2010", None),
        ("soon:or:late", None),
        ("2010-13-15 04:52:40", None),
        (None, None),
    ],
)
def test_parse_moment(spark, text, expected):
    assert _values(spark, parse_moment("x"), [text]) == [expected]


def test_epoch_ms_ignores_the_session_zone(spark):
    text = "2010-10-15 04:52:40.388"
    moment = spark.createDataFrame([(text,), ("1969-12-31 23:59:59.999",)], "x STRING").select(
        parse_moment("x").alias("ts")
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            got = [r[0] for r in moment.select(epoch_ms("ts")).collect()]
            assert got == [1287118360388, -1]
            days = [r[0] for r in moment.select(day_text("ts")).collect()]
            assert days == ["2010-10-15", "1969-12-31"]
            moscow = moment.select(epoch_ms("ts", "Europe/Moscow")).first()[0]
            assert moscow == 1287118360388 - 4 * 3600_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_money_is_exact(spark):
    values = [532.1, 0.29, 1.005, 0.004, -2.5, 104949.5]
    prices = spark.createDataFrame([(v,) for v in values] + [(None,)], "price DOUBLE")
    got = [r[0] for r in prices.select(exact_money("price")).collect()]
    assert got == [decimal.Decimal(str(v)) for v in values] + [None]
    total = prices.agg(money_of(F.sum(exact_money("price"))).alias("m")).first().m
    assert total == float(sum(decimal.Decimal(str(v)) for v in values))
    small = spark.range(1000).select(F.lit(0.004).alias("price"))
    assert small.agg(money_of(F.sum(exact_money("price"))).alias("m")).first().m == 4.0

