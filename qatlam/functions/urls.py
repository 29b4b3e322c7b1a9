"""URLs, dates and categories of pages as columns. A rejected or unusable value is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query keys that only track, and file endings that are no pages.
TRACKING = ["fbclid", "gclid", "yclid", "ref", "source", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term"]
SKIPPED = ("7z aac avi bmp css csv doc docx eot exe flac gif gz ico iso jar jpeg jpg js m4a m4v mkv mov mp3 mp4 mpeg mpg ogg otf pdf png ppt pptx "
           "rar rss svg tar tif tiff tsv ttf wav webm webp woff woff2 xls xlsx xml zip").split()  # fmt: skip
#: Parts of a path segment or section name that point to a category; the order decides.
HINTS = {
    "gov_legal": "qonun qonunchilik huquq hukumat davlat siyosat parlament farmon qaror закон право власть law gov politics".split(),
    "education": "talim ta-lim maktab universitet fan ilm oquv abituriyent образование наука education science school".split(),
    "technical": "texnologiya texnika it kompyuter internet gadjet dasturlash технологии tech technology digital ai".split(),
    "domain_haf": ("salomatlik tibbiyot sogliq qishloq dehqonchilik biznes iqtisodiyot moliya bank здоровье медицина бизнес экономика health business "
                   "economy finance agro").split(),
    "conversations": "intervyu suhbat podkast интервью interview podcast".split(),
}
MAX_LENGTH, MAX_PARAMS = 2048, 6
_URL = r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://([^/?#\s]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, _URL, i)


def host(url: Column) -> Column:
    """Host in lower case without port and final dot."""
    return F.regexp_replace(F.regexp_replace(F.lower(_part(url, 2)), r"^.*@", ""), r"(:[0-9]*)?$", "").alias("host")


def _bare_host(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(_part(url, 2)), r"^.*@", ""), r":[0-9]*$", ""), r"\.+$", "")


def prepared(url: Column) -> Column:
    u = F.regexp_replace(url, r"^\s+|\s+$", "")
    return F.when(u.rlike("(?i)^https?://"), u).otherwise(F.concat(F.lit("https://"), u))


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, default ports, doubled and final slashes, tracking keys and the fragment gone, other
    parameters sorted. Null for other schemes, credentials, local or private addresses, over six parameters or 2048 characters."""
    scheme, h = F.lower(_part(url, 1)), _bare_host(url)
    port = F.regexp_extract(F.lower(_part(url, 2)), r":([0-9]+)$", 1)
    keep = (port != "") & (port != "0") & ~((scheme == "http") & (port == "80")) & ~((scheme == "https") & (port == "443"))
    path = F.regexp_replace(F.regexp_replace(_part(url, 3), "/{2,}", "/"), "(?<=.)/$", "")
    path = F.when(path == "", "/").otherwise(path)
    pairs = F.filter(F.split(_part(url, 4), "&"), lambda p: (p != "") & ~F.lower(F.regexp_extract(p, "^([^=]*)", 1)).isin(TRACKING) & ~F.lower(p).startswith("utm_"))
    pairs = F.array_sort(F.transform(pairs, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("=")))))
    out = F.concat(scheme, F.lit("://"), h, F.when(keep, F.concat(F.lit(":"), port)).otherwise(""), path, F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise(""))
    private = h.rlike(r"^(?:10|127|0)\.[0-9.]+$|^192\.168\.[0-9.]+$|^172\.(?:1[6-9]|2[0-9]|3[01])\.[0-9.]+$|^169\.254\.[0-9.]+$|^(?:24[0-9]|25[0-5])\.[0-9.]+$|^\[(?:::1?|f[cd].*|fe[89ab].*)\]$")
    good = scheme.isin("http", "https") & (h != "") & ~_part(url, 2).contains("@") & (h != "localhost") & ~h.endswith(".localhost") & ~private
    return F.when(good & (F.size(pairs) <= MAX_PARAMS) & (F.length(out) <= MAX_LENGTH), out)


def host_key(url: Column) -> Column:
    return F.regexp_replace(_bare_host(url), r"^www\.", "")


def belongs(url: Column, seed: Column) -> Column:
    """Same host, a subdomain or a parent domain."""
    a, b = host_key(url), host_key(seed)
    return (a == b) | F.endswith(a, F.concat(F.lit("."), b)) | F.endswith(b, F.concat(F.lit("."), a))


def collectable(url: Column, seed: Column) -> Column:
    c = canonical(url)
    ending = F.regexp_extract(F.lower(_part(c, 3)), r"\.([^./]+)$", 1)
    return F.coalesce(c.isNotNull() & belongs(c, seed) & ~ending.isin(SKIPPED), F.lit(False))


def folder(url: Column) -> Column:
    port = F.regexp_extract(_part(url, 2), r":([1-9][0-9]*)$", 1)
    h = F.coalesce(F.nullif(host_key(url), F.lit("")), F.lit("website"))
    return F.regexp_replace(F.concat(h, F.when(port != "", F.concat(F.lit("_"), port)).otherwise("")), "[^a-zA-Z0-9._-]+", "_")


def url_date(url: Column) -> Column:
    """The date in a path like /2024/5/31/ as midnight UTC in ISO form."""
    pattern = r"/(20[0-9]{2})/(0?[1-9]|1[0-2])/(0?[1-9]|[12][0-9]|3[01])(?:/|$)"
    y, m, d = (F.regexp_extract(_part(url, 3), pattern, i) for i in (1, 2, 3))
    day = F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    return F.when(y != "", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00+00:00")))


def article_path(url: Column) -> Column:
    """Whether the url is dated and lies three folders deep at least, as articles do."""
    path = F.regexp_replace(_part(url, 3), "^/+|/+$", "")
    return url_date(url).isNotNull() & (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) >= 3)


def parsed_time(value: Column) -> Column:
    """An ISO time, or the date at its start, as UTC timestamp."""
    v = F.regexp_replace(value, r"^\s+|\s+$", "")
    full = F.when(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}"), F.try_to_timestamp(v))
    return F.coalesce(full, F.try_to_timestamp(F.when(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.left(v, F.lit(10)))))


def _hinted(text: Column) -> Column:
    t = F.translate(F.lower(text), "'’‘ʻʼ`", "")
    out = F.lit(None).cast("string")
    for category, hints in reversed(HINTS.items()):
        out = F.when(t.rlike("|".join(hints)), category).otherwise(out)
    return out


def category_from_url(url: Column) -> Column:
    """The first path segment with a hint decides; hints match anywhere in the segment."""
    segments = F.filter(F.split(F.lower(_part(url, 3)), "[/_-]+"), lambda s: s != "")
    return F.get(F.filter(F.transform(segments, _hinted), lambda x: x.isNotNull()), F.lit(0))


def category_from_section(section: Column) -> Column:
    return _hinted(section)


def resolved_category(url: Column, section: Column, domain_default: Column, suggested: Column, default: str = "web_news") -> Column:
    return F.coalesce(category_from_url(url), category_from_section(section), domain_default, suggested, F.lit(default))
