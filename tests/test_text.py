import pytest
from pyspark.sql import functions as F

from qatlam.functions import text as T


def test_to_latin(values):
    pairs = {"Ёшлик": "Yoshlik", "ЎЗБЕКИСТОН": "O'ZBEKISTON", "ЮНЕСКО": "YUNESKO", "ер": "yer", "ае": "aye", "ацо": "atso", "туц": "tus", "толь": "tol", "маъно": "ma'no", "Я": "YA",
             "цирк": "tsirk", "ее": "yeye", "Шаҳар ва mashina 5": "Shahar va mashina 5", "O'zbek": "O'zbek", "": ""}
    assert values(T.to_latin, [*pairs, None]) == [*pairs.values(), None]


def test_strip_garbage(values):
    cases = {
        "• kayta nshlaga1^ K r k -^.": "kayta",
        "Voqea 5-bet va 1991-yil haqida.": "Voqea 5-bet va 1991-yil haqida.",
        "1. Birinchi band va 2. ikkinchi band.": "1. Birinchi band va 2. ikkinchi band.",
        "  ": "  ",
        "a@b.uz bir\nikki/uch to'rt": "bir\nto'rt",
    }
    assert values(T.strip_garbage, list(cases)) == list(cases.values())


def test_normalized(values):
    cases = {
        "Bu so'z chi-\nroyli bo'ldi.": "Bu so'z chiroyli bo'ldi.",
        "Bo'lim[tahrir]": "Bo'lim",
        "Tarix[Tahrirlash | manbasini tahrirlash]": "Tarix",
        "o‘zbek «matn» – bu": "o'zbek \"matn\" - bu",
        "a  \t b \n\n\n\n c​": "a b\n\n c",
    }
    assert values(T.normalized, list(cases)) == list(cases.values())
    assert values(lambda c: T.normalized(c, "ʻ"), ["o'zbek"]) == ["oʻzbek"]


def test_nfc(values):
    assert values(T.nfc, ["é", None]) == ["é", None]


def test_hash_ignores_case_and_space(values):
    a, b, c = values(T.content_hash, ["Bu   Matn  BILAN sinov.", "bu matn bilan sinov.", "boshqa"])
    assert a == b != c


def test_pii(values):
    t = "a@b.com va +998901234567 va yana c@d.com"
    assert values(T.pii_count, [t, "hech narsa", "090 123 45 67"]) == [3, 0, 1]
    assert values(T.scrub_pii, [t]) == [" va  va yana "]


def test_lines(values):
    assert values(T.is_page_number, ["- 12 -", "12 bet", "2023", "12345", "bob 3"]) == [True, True, True, False, False]
    assert values(T.is_byline, ["Muallif: Abdulla", "Mas'ul muharrir: R. N.", "Abdulla Qahhor"]) == [True, True, False]
    assert values(T.denoised, ["- 3 -\nbir ikki\nMuallif: A B"]) == ["\nbir ikki\n"]


def test_token_estimate(values):
    assert values(T.token_estimate, ["x" * 40, "abc", "", "x" * 10, "x" * 14, None]) == [10, 1, 0, 2, 4, None]
    with pytest.raises(ValueError):
        T.token_estimate(F.lit("a"), 0)


def test_clean_lines(values):
    assert values(T.clean_lines, ["a  b ,\r\n\na  b,\n c"]) == ["a b,\n\nc"]
    assert values(T.title_with_stop, ["Sarlavha", "Nima?", ""]) == ["Sarlavha.", "Nima?", ""]


def test_corrections_capitalise(values):
    fixes = F.create_map(F.lit("kayta"), F.lit("qayta"))
    assert values(lambda c: T.corrected(c, fixes), ["u kayta, keldi"]) == ["u Qayta, keldi"]
