from pyspark.sql import functions as F

from qatlam.functions import urls as U


def test_canonical(values):
    cases = {
        "https://Example.COM/Path/": "https://example.com/Path",
        "http://a.uz:80//x//y/?b=2&a=1&utm_source=z&fbclid=q#top": "http://a.uz/x/y?a=1&b=2",
        "https://a.uz:8443/": "https://a.uz:8443/",
        "ftp://a.uz/": None,
        "http://user:pw@a.uz/": None,
        "http://localhost/x": None,
        "http://192.168.1.4/": None,
        "http://a.uz/?a=1&b=1&c=1&d=1&e=1&f=1&g=1": None,
        "yo'q": None,
    }
    assert values(U.canonical, [*cases, None]) == [*cases.values(), None]


def test_sites(spark):
    rows = [("http://www.kun.uz/a", "https://kun.uz"), ("http://m.kun.uz/a.jpg", "https://kun.uz"), ("http://uz/a", "https://kun.uz"), ("http://akun.uz/", "https://kun.uz")]
    df = spark.createDataFrame(rows, "u string, s string")
    assert [tuple(r) for r in df.select(U.belongs(F.col("u"), F.col("s")), U.collectable(F.col("u"), F.col("s"))).collect()] == [(True, True), (True, False), (True, True), (False, False)]


def test_dates(values):
    assert values(U.url_date, ["http://a.uz/2024/5/31/x", "http://a.uz/2024/02/31/x", "http://a.uz/x"]) == ["2024-05-31T00:00:00+00:00", None, None]
    got = values(lambda c: F.date_format(U.parsed_time(c), "yyyy-MM-dd HH:mm"), ["2024-05-31T05:00:00+05:00", "2024-05-31", "kecha", None])
    assert got == ["2024-05-31 00:00", "2024-05-31 00:00", None, None]


def test_categories(values):
    urls = ["http://a.uz/texnologiya/ai", "http://a.uz/talim/maktab", "http://a.uz/random/slug"]
    assert values(U.category_from_url, urls) == ["technical", "education", None]
    assert values(U.folder, ["http://www.kun.uz:8080/a"]) == ["kun.uz_8080"]
