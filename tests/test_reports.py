import collections
import random

import pytest

from tillscope.plans import reports
from tillscope.plans.views import register_views
from tillscope.sources import schemas

BLOCKS = [
    ("10.0.0.0/8", 1),
    ("10.1.0.0/16", 2),
    ("20.0.0.0/7", 2),
    ("30.0.0.0/24", 3),
    ("40.0.0.0/24", None),
    ("50.0.0.0/24", 99),
]
COUNTRIES = [(1, "Ones"), (2, "Twos"), (3, "Threes")]


def _purchases(seed=5, rows=2000):
    """A third of the rows share one product, one category and one address."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        price = round(rng.gauss(500, 10), 1)
        if i % 3 == 0:
            data.append(("hot", price, "hot", "10.1.0.7"))
            continue
        octet = rng.choice([10, 20, 21, 30, 40, 50, 60])
        category = rng.choice([None, "c0", "c1", "c2", "c3"])
        ip = f"{octet}.{rng.randrange(3)}.0.{rng.randrange(20)}"
        data.append((f"p{rng.randrange(15)}", price, category, ip))
    return data


@pytest.fixture(scope="module")
def data():
    return _purchases()


@pytest.fixture(scope="module")
def tables(spark, data):
    return (
        spark.createDataFrame(data, "name STRING, price DOUBLE, category STRING, ip STRING")
        .repartition(4)
        .cache(),
        spark.createDataFrame(BLOCKS, "network STRING, geoname_id LONG"),
        spark.createDataFrame(COUNTRIES, "geoname_id LONG, country_name STRING"),
    )


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _ranked(counter, k, order):
    return sorted(counter.items(), key=order)[:k]


def test_top_categories(tables, data):
    counts = collections.Counter(d[2] for d in data)
    expected = _ranked(counts, 3, lambda kv: (-kv[1], kv[0] or ""))
    assert _rows(reports.top_categories(tables[0], k=3)) == expected


def test_top_products(tables, data):
    counts = collections.Counter((d[0], d[2]) for d in data if d[2] is not None)
    expected = [(*k, v) for k, v in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))]
    assert _rows(reports.top_products(tables[0])) == expected[:10]
    assert _rows(reports.top_products(tables[0], k=None)) == expected


def test_top_products_per_category(tables, data):
    counts = collections.Counter((d[2], d[0]) for d in data if d[2] is not None)
    expected = []
    for category in {c for c, _ in counts}:
        mine = sorted(
            ((n, v) for (c, n), v in counts.items() if c == category), key=lambda nv: (-nv[1], nv[0])
        )
        expected += [(category, n, v, i + 1) for i, (n, v) in enumerate(mine[:4])]
    got = _rows(reports.top_products_per_category(tables[0], k=4))
    assert sorted(got) == sorted(expected)


def _spend(data):
    cents = collections.Counter()
    for _, price, _, ip in data:
        cents[ip] += round(price * 100)
    return cents


def test_top_ips(tables, data):
    expected = [
        (ip, c / 100) for ip, c in sorted(_spend(data).items(), key=lambda kv: (-kv[1], kv[0]))
    ]
    assert _rows(reports.top_ips(tables[0])) == expected[:10]
    assert expected[0][0] == "10.1.0.7"


def _found(ip, longest):
    o = [int(x) for x in ip.split(".")]
    found = []
    if o[0] == 10:
        found.append((8, "10.0.0.0/8", 1))
    if o[:2] == [10, 1]:
        found.append((16, "10.1.0.0/16", 2))
    if o[0] in (20, 21):
        found.append((7, "20.0.0.0/7", 2))
    if o[:3] == [30, 0, 0]:
        found.append((24, "30.0.0.0/24", 3))
    if longest and found:
        found = [max(found)]
    return found


@pytest.mark.parametrize("match", ["all", "longest"])
@pytest.mark.parametrize("pre_k", [5, 100, None])
def test_top_ip_countries(tables, data, match, pre_k):
    names = dict(COUNTRIES)
    top = sorted(_spend(data).items(), key=lambda kv: (-kv[1], kv[0]))[:pre_k]
    expected = [
        (c / 100, ip, g, names[g], network)
        for ip, c in top
        for _, network, g in _found(ip, match == "longest")
    ]
    expected.sort(key=lambda r: (-r[0], r[1], r[4], r[2]))
    got = reports.top_ip_countries(*tables, pre_k=pre_k, match=match)
    assert _rows(got) == expected[:10]
    assert [f.dataType for f in got.schema] == [f.dataType for f in schemas.TOP_IP_COUNTRIES]


@pytest.mark.parametrize("match", ["all", "longest"])
@pytest.mark.parametrize("small", [True, False])
def test_top_countries(tables, data, match, small):
    cents = collections.Counter()
    for ip, c in _spend(data).items():
        for _, _, g in _found(ip, match == "longest"):
            cents[dict(COUNTRIES)[g]] += c
    expected = [(n, c / 100) for n, c in sorted(cents.items(), key=lambda kv: (-kv[1], kv[0]))]
    purchases, blocks, countries = tables
    index = reports.block_index(blocks, broadcast_bytes=10**30 if small else 0)
    assert _rows(reports.top_countries(purchases, index, countries, match=match)) == expected


def test_sums_do_not_depend_on_partitions(spark, tables):
    one, many = (
        _rows(reports.top_ips(tables[0].repartition(n), k=None)) for n in (1, 7)
    )
    assert one == many


def test_reports_as_sql_over_views(spark, sf_dir, data, tables):
    """The queries of an SQL user give what the DataFrame reports give."""
    import datetime

    purchases = tables[0].withColumn("ts", reports.F.lit(datetime.datetime(2010, 10, 15, 1, 2, 3)).cast("timestamp_ntz"))
    register_views(spark, purchases, tables[2], tables[1])
    assert _rows(
        spark.sql(
            """SELECT category, count(*) AS cnt FROM product
               GROUP BY category ORDER BY cnt DESC, category LIMIT 10"""
        )
    ) == _rows(reports.top_categories(purchases))
    assert _rows(
        spark.sql(
            """SELECT name, category, count(*) AS cnt FROM product WHERE category IS NOT NULL
               GROUP BY name, category ORDER BY cnt DESC, name, category LIMIT 10"""
        )
    ) == _rows(reports.top_products(purchases))
    by_sql = spark.sql(
        """WITH spent AS (SELECT IP, first(IPAsLong) AS number, sum(price) AS total
                         FROM product GROUP BY IP)
           SELECT round(total, 2) AS sump, IP, geonameId, countryName, network
           FROM (SELECT * FROM spent ORDER BY total DESC LIMIT 100)
           JOIN countryip ON startIPAsLong <= number AND endIPAsLong >= number
           JOIN countryname USING (geonameId)
           ORDER BY sump DESC, IP, network LIMIT 10"""
    )
    assert _rows(by_sql) == _rows(reports.top_ip_countries(purchases, *tables[1:]))
    strict = spark.sql(
        """SELECT sump, geoname_id, country_name
           FROM vcountryip JOIN countryname USING (geoname_id)
           JOIN vproduct ON startip < iip AND iip < endip"""
    )
    frame = reports.top_ip_countries(purchases, *tables[1:], pre_k=10, k=None, bounds="strict")
    assert sorted(_rows(strict)) == sorted(
        _rows(frame.select("sump", "geoname_id", "country_name"))
    )
    row = spark.sql("SELECT dt, date, dateAsLong, priceAsFloat FROM product LIMIT 1").first()
    assert (row.dt, row.date, row.dateAsLong) == (
        "2010-10-15", "2010-10-15 01:02:03.000", 1287104523000,
    )
