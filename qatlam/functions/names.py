"""Names of files, datasets and library categories: what they tell about a text's source and category.

Column builders; null in, null out unless a docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qatlam.functions.text import category_name

#: Datasets and the names under which their files are published.
DATASET_ALIAS = {"tahrirchi/uz-crawl": "corpus-a", "tahrirchi/uz-books-v2": "corpus-b", "yakhyo/uz-wiki": "corpus-c"}
#: Fixed value: file names of dataset shards.
SHARD = r"^(.+)__(.+)__shard-([0-9]+)\.txt$"
#: File endings that are downloaded, and the largest size.
DOWNLOADED = [".pdf", ".djvu", ".epub", ".docx", ".pptx", ".fb2", ".html", ".txt"]
MOST_BYTES = 200 * 1024 * 1024
#: The library's categories and the corpus categories they belong to.
LIBRARY = {
    "O'zbek xalq og'zaki ijodi": "books",
    "O'zbek mumtoz adabiyoti": "books",
    "Alisher Navoiy asarlari": "books",
    "O'zbek zamonaviy she'riyati": "books",
    "O'zbek nasri": "books",
    "O'zbek dramaturgiyasi": "books",
    "O'zbek adabiy tili": "reference",
    "O'zbek tilining izohli lug'ati": "reference",
    "O'zbekiston Milliy Ensiklopediyasi": "reference",
    "Jahon xalqlari og'zaki ijodi": "books",
    "Sharq mumtoz adabiyoti": "books",
    "Jahon nasri": "books",
    "Jahon she'riyati": "books",
    "Jahon dramaturgiyasi": "books",
    "Bolalar kutubxonasi": "books",
    "Tasavvufga oid kitoblar": "books",
    "Axloq-odobga oid kitoblar": "books",
    "Hikmatlar xazinasi (Aforizmlar)": "books",
    "Tarixga oid kitoblar": "books",
    "Prezident asarlari": "gov_legal",
    "Ilmiy-tarixiy, adabiy maqolalar, risolalar": "books",
    "Adabiyotshunoslik": "books",
    "Adabiy antologiya va to'plamlar": "books",
    "Adabiy, tarixiy bukletlar": "books",
    "Adabiy esdaliklar, xotiralar": "books",
    "Hajviyot": "web_news",
    "Tarjimashunoslik": "books",
    "Eski o'zbek yozuvi": "reference",
    "Lug'atlar": "reference",
    "Turli mavzulardagi kitoblar": "books",
    "Chet tillari": "education",
    "Tibbiyotga oid risolalar": "domain_haf",
    "Publitsistika": "web_news",
    "Falsafa": "books",
    "Aniq fanlar": "education",
    "Jurnalistika": "web_news",
    "San'atshunoslik": "books",
    "Statistika": "books",
    "Hunarmadchilik": "books",
    "Uzbek literature (in English)": "books",
    "Sport": "books",
    "\"Tafakkur\" jurnali": "web_news",
    "\"Sharq yulduzi\" jurnali": "web_news",
    "Журнал \"Звезда Востока\"": "web_news",
    "\"Yoshlik\" jurnali": "web_news",
    "\"Jahon adabiyoti\" jurnali": "web_news",
    "\"Hidoyat\" jurnali": "web_news",
    "\"Muloqot\" jurnali": "web_news",
    "\"Moziydan sado\" jurnali": "web_news",
    "\"Guliston\" jurnali": "web_news",
    "\"Vatandosh\" gazetasi": "web_news",
    "\"Yosh kuch\" jurnali": "web_news",
    "Журнал \"Молодая смена\"": "web_news",
    "\"Fan va turmush\" jurnali": "web_news",
    "\"Til va adabiyot ta'limi\" jurnali": "web_news",
    "\"O'zbekistonda ijtimoiy fanlar\" jurnali": "web_news",
    "\"O'zbekiston arxeologiyasi\" jurnali": "web_news",
    "\"O'zbekiston moddiy madaniyati tarixi\" to'plami": "web_news",
    "\"O'zbekistonda arxeologik tadqiqotlar\" to'plami": "web_news",
    "\"Saodat\" jurnali": "web_news",
    "\"Sirli olam\" jurnali": "web_news",
    "\"Iqtisod va hisobot\" jurnali": "domain_haf",
    "\"Ijod olami\" jurnali": "web_news",
    "Gazeta maqolalari solnomasi (1977)": "reference",
    "Jurnal maqolalari letopisi (1961-1967)": "reference",
    "Kitob letopisi (1932-1967)": "reference",
    "Sovet O'zbekiston kitobi (1917-1975)": "reference",
    "O'zbekiston kitoblarining yilnomasi (1976-1998)": "reference",
    "O'zbekiston matbuoti solnomasi (1968-2014)": "reference",
    "Aloqa va axborot texnologiyalari": "education",
    "Biologiya": "education",
    "Ekologiya": "education",
    "Geodeziya": "education",
    "Geografiya": "education",
    "Geologiya": "education",
    "Huquq": "education",
    "Iqtisodiyot": "education",
    "Jismoniy tarbiya": "education",
    "Kimyo": "education",
    "Mantiq": "education",
    "Ma'naviyat": "education",
    "Matematika": "education",
    "Me'morchilik": "education",
    "Ona tili va adabiyot": "education",
    "Pedagogika": "education",
    "Psixologiya": "education",
    "Qishloq xo'jaligi": "education",
    "San'at": "education",
    "Tabiiy fanlar": "education",
    "Tarix": "education",
    "Texnika va texnologiya": "education",
    "Tibbiyot": "education",
    "Alifbo": "education",
    "Adabiyot": "education",
    "Chizmachilik": "education",
    "Fizika": "education",
    "Fransuz tili": "education",
    "Informatika": "education",
    "Ingliz tili": "education",
    "Musiqa": "education",
    "Nemis tili": "education",
    "Odobnoma": "education",
    "O'zbek tili": "education",
    "Rus tili": "education",
    "Tasviriy san'at": "education",
    "Yangi darsliklar (2014-2023)": "education",
    "Tojik maktablari uchun darsliklar": "education",
    "Turkman maktablari uchun darsliklar": "education",
    "Badiiy kitoblar": "books",
    "Turli mavzudagi kitoblar": "books",
    "Android uchun kitoblar": "books",
    "E-readerlar uchun EPUB kitoblar": "books",
    "Узбекское устное народное творчество": "books",
    "Узбекская классическая литература": "books",
    "Узбекская современная проза": "books",
    "Узбекская современная поэзия": "books",
    "Узбекская драматургия": "books",
    "Узбекская детская литература": "books",
    "Сборники по узбекской литературы": "books",
    "Русскоязычная проза Узбекистана": "books",
    "Узбекский язык и литература": "reference",
    "Русскоязычная поэзия Узбекистана": "books",
    "Каракалпакская литература": "books",
    "Научные произведения великих мыслителей Узбекистана": "books",
    "Жизнь и деятельность великих предков Узбекистана": "books",
    "Литературы по истории тюркских народов": "books",
    "Словари тюркских языков": "reference",
    "Узбекская кулинария": "books",
    "Избранная лирика Востока": "books",
    "Qaraqalpaq folklorı": "books",
    "Qaraqalpaq poeziyası": "books",
    "Qaraqalpaq prozası": "books",
    "Qaraqalpaq tili sózlikleri": "reference",
    "Qaraqalpaqstan tariyxı": "books",
    "İlimiy kitaplar": "books",
    "Qaraqalpaqsha sabaqlıqlar": "education",
    "Jáhán ádebiyatı qaraqalpaq tilinde": "books",
    "Balalar ádebiyatı": "books",
}


def dataset_slug(dataset: Column) -> Column:
    return F.replace(dataset, F.lit("/"), F.lit("_"))


def shard_name(dataset: Column, split: Column, shard: Column) -> Column:
    """The file name of a dataset's shard."""
    return F.concat(dataset_slug(dataset), F.lit("__"), split, F.lit("__shard-"), F.lpad(shard.cast("string"), 6, "0"), F.lit(".txt"))


def _looked_up(c: Column, by: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(c == k, v) for k, v in by.items()]) if by else F.lit(None).cast("string")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0)


def shard_parts(name: Column) -> tuple[Column, Column, Column, Column]:
    """(dataset, slug, split, shard) of a shard's file name; all null for other names, the dataset also for unknown slugs."""
    part = lambda i: F.when(name.rlike(SHARD), F.regexp_extract(name, SHARD, i))
    return _looked_up(part(1), {d.replace("/", "_"): d for d in DATASET_ALIAS}), part(1), part(2), part(3)


def source_id(name: Column) -> Column:
    """The ledger path of a file: that of a known dataset's shard, or of a library file whose name begins with its number."""
    dataset, _, split, shard = shard_parts(name)
    of_shard = F.concat(F.lit("hf:"), dataset, F.lit(":"), split, F.lit(":shard-"), shard)
    return F.coalesce(of_shard, F.when(name.rlike("^[0-9]+_"), F.concat(F.lit("ziyouz:"), F.regexp_extract(name, "^([0-9]+)_", 1))))


def renamed(name: Column) -> Column:
    """A shard's file name with the dataset's public name; null for other names and unknown datasets."""
    dataset, _, split, shard = shard_parts(name)
    return F.concat(_looked_up(dataset, DATASET_ALIAS), F.lit("__"), split, F.lit("__shard-"), shard, F.lit(".txt"))


def is_from_dataset(name: Column) -> Column:
    """Whether a file comes from a known dataset, under its own or its public name."""
    _, slug, _, _ = shard_parts(name)
    return F.coalesce(slug.isin(*[d.replace("/", "_") for d in DATASET_ALIAS], *DATASET_ALIAS.values()), F.lit(False))


def downloadable(name: Column, size: Column) -> Column:
    """Whether a library file is of a wanted format and not too large; an unknown size is tried."""
    ending = F.lower(F.regexp_extract(name, r"\.[^.]+$", 0))
    return ending.isin(DOWNLOADED) & F.coalesce(size <= MOST_BYTES, F.lit(True))


def folder_category(path: Column) -> Column:
    """The first folder of a relative path."""
    return F.when(path.contains("/"), F.split(path, "/")[0]).otherwise("uncategorized")


def flat_category(path: Column, suggested: Column, valid: list[str]) -> Column:
    """The folder's category; of a file without a folder the suggested one if valid, else books if valid."""
    rest = "books" if "books" in valid else "uncategorized"
    return F.when(path.contains("/"), F.split(path, "/")[0]).otherwise(F.coalesce(F.when(suggested.isin(valid), suggested), F.lit(rest)))


def library_category(rows: DataFrame, name: str, to: str = "category") -> DataFrame:
    """``rows`` with the corpus category of the library category ``name``, whatever its apostrophes; null where it is unknown,
    so that callers can reject it. The map is a fixed list of about a hundred names."""
    known = rows.sparkSession.createDataFrame(list(LIBRARY.items()), f"_name string, {to} string").select(category_name(F.col("_name")).alias("_name"), to).dropDuplicates(["_name"])
    return rows.withColumn("_name", category_name(F.col(name))).join(F.broadcast(known), "_name", "left").drop("_name")
