from pyspark.sql import functions as F

from qatlam.functions import quality as Q


def test_reasons(values):
    cases = {
        "qisqa": "juda_qisqa",
        "Assalomu alaykum baxtiyor": "soz_kam",
        "abcd efgh ijkl mnop 1111111111111111111": "simvol_kop",
        "xatolik ×5 bir marta xatolik": "ortiqcha_takror",
        "Bu matnда aralash yozuv ishlatilgan ekan": "aralash_alifbo",
        "BU MATN FAQAT KATTA HARFLARDAN IBORAT": "katta_harf_kop",
        "Yaxshi odamlar bugun shaharda uchrashib uzoq suhbatlashdilar": None,
        "bir ikki uch https://juda-uzun-manzil.example/yol/yana/yol": "url_kop",
    }
    got = values(Q.quality_reason, [*cases, None])
    assert got == [*cases.values(), "juda_qisqa"]


def test_language(values):
    s = values(Q.language_score, ["bu kitob va uning daftari bilan", "the quick brown fox", ""])
    assert s[0] > 0.5 and s[1] == 0.0 and s[2] == 0.0


def test_model_label_counts(spark):
    df = spark.createDataFrame([("uz", 0.9, 0.0), ("uz", 0.5, 0.0), (None, None, 0.3)], "l string, c double, s double")
    assert [r[0] for r in df.select(Q.is_uzbek(F.col("s"), F.col("l"), F.col("c"))).collect()] == [True, False, True]


def test_structure_order(spark):
    rows = [("- 7 -", 9, False), ("Sarlavha", 9, True), ("Bob ..... 12", 9, False), ("ISBN 123", 1, False), ("ISBN 123", 9, False), ("Rashidov, A., Til nazariyasi, Toshkent, 2015, 45-bet.", 9, False), ("oddiy matn", 1, False)]
    df = spark.createDataFrame(rows, "t string, p int, r boolean")
    got = [r[0] for r in df.select(Q.structure_reason(F.col("t"), F.col("p"), F.col("r"))).collect()]
    assert got == ["sahifa_raqami", "kolontitul", "mundarija", "front_matter", None, "bibliografiya", None]


def test_trash(values):
    assert values(Q.is_trash, ["Reklama", "Foto: A. B.", "Oddiy matn"]) == [True, True, False]
