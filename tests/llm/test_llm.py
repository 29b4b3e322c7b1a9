"""The training-data operators against brute force, round trips and held-out accuracy, and on the cases that break things."""

import itertools
import json
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from qatlam.llm import codes, fold, history, language, leak, mainbody, mojibake, ocr, packing, quality, sitelines, tokens

DATA = Path("/root/testdata/sf0.01")


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def read(spark, name):
    return spark.read.parquet(str(DATA / f"{name}.parquet"))


# 1


COMMON = [("uz", w) for w in "va bilan uchun bu ham esa lekin".split()] + [("en", w) for w in "the and of a".split()]


def test_quality_kinds(spark):
    prose = ["Bu kitob va uning daftari bilan birga yangi maktab uchun olindi, lekin hali ochilmagan.", "Ular esa shahar bilan bog'liq ham katta, ham kichik ishlarni uchun tayyorladi."]
    data = [(i, random.Random(i).choice(prose)) for i in range(300)]
    odd = {900: "- olma\n- anor\n- nok\n- uzum", 901: "a\tb\tc\n1\t2\t3\n4\t5\t6", 902: "§$%& #@!* ^^^ ~~ ||| <<>> §§", 903: "olma anor " * 30, 904: "xkjq wrtp zzvb qpdfg mnbvc xzlkj qwrtp"}
    data += list(odd.items()) + [(990, None), (991, ""), (992, "   \n ")]
    df = spark.createDataFrame(data, "id long, text string").withColumn("extra", F.lit(1))
    got = {r.id: (r.kind, r.distance) for r in quality.text_quality(df, spark.createDataFrame(COMMON, "lang string, word string")).collect()}
    assert {k: got[k][0] for k in odd} == {900: "list", 901: "table", 902: "junk", 903: "junk", 904: "junk"}
    assert all(got[i][0] is None for i in range(300))
    assert got[990] == got[991] == got[992] == (None, None)


def test_contributions_sum_to_distance(spark):
    df = read(spark, "blocks").select("block_id", "text")
    out = quality.text_quality(df, read(spark, "common_words")).select("distance", "contributions").where("distance is not null").limit(200).collect()
    assert all(abs(sum(r.contributions) / len(quality.STATS) - r.distance) < 1e-6 * max(1, r.distance) for r in out)


def test_counts_by_plain_python():
    rng = random.Random(4)
    alphabet = "aAoOʻ'бВ19  \t\n\n;|·.,!:-•§(ZzXx)\U0001f600"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) + "x" for _ in range(300)] + ["1) olma\n2. anor\n• nok\n(3) uzum", "qwrtp bcdfghjklmn", "so'z  so'z   SO'Z"]
    got = quality.count(texts, {"uz": quality.word_hashes(["so'z", "aa"])})
    marks = {"n_commas": ",", "n_vowels": quality._SIGNS[quality.VOWEL]}
    for i, t in enumerate(texts):
        words = ["".join(g) for k, g in itertools.groupby(t, key=lambda c: c.isalpha() or c in "'’‘ʻʼ`") if k]
        lines = [x for x in t.split("\n") if x.strip()]
        want = {"n_chars": sum(not c.isspace() for c in t), "n_letters": sum(map(str.isalpha, t)), "n_digits": sum(c in "19" + "02345678" for c in t), "n_words": len(words),
                "n_distinct": len({w.lower() for w in words}), "n_lines": len(lines), "n_ends": sum(x.strip()[-1] in ".!?…:;»”\"" for x in lines),
                "common_uz": len({w.lower() for w in words} & {"so'z", "aa"})} | {k: sum(c in v for c in t) for k, v in marks.items()}
        assert {k: int(got[k][i]) for k in want} == want, t
    assert got["n_items"].tolist()[300:] == [4, 1, 0] and got["n_stops"][300] == 0 and got["n_clusters"].tolist()[301] == 3


def test_distance_alone_decides(spark):
    # the distance is a sum over any extra columns' rows alike, in one partition or many, and long texts are counted in parts
    df = read(spark, "blocks").select("block_id", "text")
    common = read(spark, "common_words")
    one = {r.block_id: (r.kind, r.distance) for r in quality.text_quality(df.coalesce(1), common).collect()}
    many = {r.block_id: (r.kind, r.distance) for r in quality.text_quality(df.repartition(9), common).collect()}
    assert all(one[k][0] == many[k][0] for k in one)
    assert all((x[0] is None) == (x[1] is None or x[1] <= quality.OUTLIER) for x in one.values())


def test_quality_of_nothing(spark):
    e = spark.createDataFrame([], "id long, text string")
    assert quality.text_quality(e, spark.createDataFrame(COMMON, "lang string, word string")).count() == 0


# 2 and 3


def pages_of(spark, n, site="a.uz"):
    return spark.createDataFrame([(i, f"http://www.{site}/p/{i}/?q={i}", f"Sarlavha {chr(97 + i)}bv") for i in range(n)], "page_id long, url string, title string")


def test_site_lines_by_brute_force(spark):
    c = read(spark, "candidates")
    pages = read(spark, "pages")
    page = {r.page_id: r.url for r in pages.collect()}
    key = lambda s: "".join(ch for ch in s.lower() if ch.isalpha() and ch not in "ʻʼ")
    host = lambda u: u.split("//")[1].split("/")[0].lower().removeprefix("www.")
    path = lambda u: "/".join(u.split("?")[0].split("#")[0].split("/")[3:]).rstrip("/")
    seen, lines = defaultdict(set), []
    for r in c.collect():
        for n, x in enumerate((r.text or "").split("\n")):
            if key(x):
                seen[host(page[r.page_id]), key(x)].add(path(page[r.page_id]))
                lines.append((r.page_id, r.candidate_id, n, (host(page[r.page_id]), key(x))))
    want = sorted((p, k, n) for p, k, n, x in lines if len(seen[x]) >= 5)
    assert rows(sitelines.boilerplate(c, pages)[1], "page_id", "candidate_id", "line_no") == want
    assert rows(sitelines.repeated_lines(c, pages), "page_id", "candidate_id", "line_no") == want


def test_site_blocks_are_components(spark):
    text = "Menyu bir\nMenyu ikki\n{}\nHuquqlar himoyalangan"
    c = spark.createDataFrame([(i, "c1", text.format("Matn " + "abcdef"[i] * 9)) for i in range(6)] + [(7, "c1", None), (99, "c1", "Menyu bir")], "page_id long, candidate_id string, text string")
    blocks, found = sitelines.boilerplate(c, pages_of(spark, 8))
    report = sitelines.block_report(found).collect()
    assert [(r.n_lines, r.n_pages, r.n_occurrences) for r in report] == [(3, 6, 18)]
    assert blocks.count() == 3 and blocks.select("block").distinct().count() == 1
    clean = {r.page_id: r.clean_text for r in sitelines.without_lines(c, found).collect()}
    assert clean[0] == "Matn aaaaaaaaa" and clean[7] is None and clean[99] == "Menyu bir"
    assert sitelines.boilerplate(c.where("page_id < 0"), pages_of(spark, 2))[1].count() == 0


def test_site_lines_come_from_blocks(spark, tmp_path, monkeypatch):
    from qatlam.llm.queries import QUERIES

    text = "Menyu bir\nMenyu ikki\n{}\n{}\n\n\n\nYakka satr"
    c = spark.createDataFrame([(i, "c1", text.format(*["Matn " + "abcdef"[i] * n for n in (9, 7)])) for i in range(6)], "page_id long, candidate_id string, text string")
    c.write.parquet(str(tmp_path / "candidates.parquet"))
    pages_of(spark, 6).write.parquet(str(tmp_path / "pages.parquet"))
    found = lambda: rows(QUERIES["p2_found"](spark, str(tmp_path)), "page_id", "line_no")
    assert found() == [(i, n) for i in range(6) for n in (0, 1, 7)]
    whole = sitelines.components
    monkeypatch.setattr(sitelines, "components", lambda kept, links: whole(kept, links).join(links.select("site", F.col("a").alias("block")), ["site", "block"]))
    assert found() == [(i, n) for i in range(6) for n in (0, 1)]


def test_shared_is_a_longest_common_subsequence():
    rng = random.Random(1)

    def brute(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y and x else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    for _ in range(200):
        a, b = [[rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2)]
        s = mainbody.shared(a, b)
        assert len(s) == brute(a, b) and all(a[i] in b for i in s)
        it = iter(b)
        assert all(a[i] in it for i in sorted(s))
    long = list(range(1, 5001))
    assert len(mainbody.shared(long, long[::2] + long[1::2])) == 2501


def test_page_furniture(spark):
    body = ["Bu birinchi paragraf bo'lib, unda {} haqida ancha so'z bor.", "Ikkinchi paragraf ham {} haqida uzoq va batafsil yozilgan edi."]
    names = ["olma", "anor", "nok", "uzum", "gilos", "shaftoli"]
    data = [(i, "c1", "\n".join(["Bosh sahifa", "Aloqa", f"Sarlavha {chr(97 + i)}bv", *[x.format(names[i]) for x in body], "Do'stlaringizga ulashing", "Barcha huquqlar himoyalangan"])) for i in range(6)]
    c = spark.createDataFrame(data + [(0, "c2", None), (1, "c2", "")], "page_id long, candidate_id string, text string")
    got = rows(mainbody.page_furniture(c, pages_of(spark, 6)), "page_id", "candidate_id", "line_no")
    assert got == sorted((i, "c1", n) for i in range(6) for n in (0, 1, 5, 6))
    body_only = {(r.page_id, r.candidate_id): r.clean_text for r in sitelines.without_lines(c, mainbody.page_furniture(c, pages_of(spark, 6))).collect()}
    assert body_only[0, "c1"].split("\n")[0] == "Sarlavha abv" and len(body_only[0, "c1"].split("\n")) == 3 and body_only[0, "c2"] is None and body_only[1, "c2"] == ""
    assert mainbody.page_furniture(c.where("page_id > 50"), pages_of(spark, 6)).count() == 0


def test_every_text_of_neighbouring_pages_meets(spark):
    # the longest and the first text of a page have no furniture; the shared line stands in the last one only
    long = lambda i: "\n".join(f"Matn {chr(97 + i)}{chr(97 + k)} yozildi." for k in range(9))
    data = [(i, "c0", long(i)) for i in range(6)]
    data += [(i, f"d{k:03}", f"Boshqa {chr(97 + i)}{chr(97 + k // 26)}{chr(97 + k % 26)} gap.") for i in range(6) for k in range(70)]
    data += [(i, "z", f"Qator {chr(97 + i)} bor.\nObuna boling {chr(97 + i // 2)}") for i in range(6)]
    c = spark.createDataFrame(data, "page_id long, candidate_id string, text string")
    for parts in ("1", "4"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            lines = mainbody.with_borders(mainbody.differenced(c, pages_of(spark, 6)).checkpoint())
            lines = lines.select("page_id", "candidate_id", F.posexplode("shared").alias("line_no", "shared"))
            assert rows(lines.where("shared"), "page_id", "candidate_id", "line_no") == [(i, "z", 1) for i in range(6)]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# 4 and 8


def test_longest_match_equals_greedy():
    rng = random.Random(2)
    for _ in range(60):
        vocabulary = {"".join(rng.choice("abc▁") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        m = tokens.LongestMatch(sorted(vocabulary))

        def greedy(w):
            n = i = 0
            while i < len(w):
                k = next((k for k in range(len(w), i, -1) if w[i:k] in vocabulary), None)
                n, i = (n + 1, k) if k else (n + len(w[i].encode()), i + 1)
            return n

        for _ in range(40):
            w = "▁" + "".join(rng.choice("abcdé") for _ in range(rng.randint(0, 9)))
            assert m.count(w) == greedy(w), (w, vocabulary)


def test_byte_counts_equal_the_library(spark):
    import base64

    import tiktoken

    sys.path.insert(0, "/opt/tokenizers/..")
    import public_tokenizers as P

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    d = read(spark, "documents").select("doc_id", "text").orderBy("doc_id").limit(60)
    text = {r.doc_id: r.text for r in d.collect()}
    got = {r.doc_id: r.n_tokens for r in tokens.with_tokens(d, "doc_id", "bytes").collect()}
    assert got == {k: len(own.encode_ordinary(t)) if t is not None else None for k, t in text.items()}


def test_piece_counts_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=f"{tokens.TOKENIZERS}/piece_bpe_32k.model")
    d = read(spark, "documents").select("doc_id", "text").orderBy("doc_id").limit(200)
    odd = ["", " ", "a  ", "  a b", "a\n\n b\t c", "a▁▁ b", "é ﬁ Ⅷ", None]
    d = d.union(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    text = {r.doc_id: r.text for r in d.collect()}
    want = {k: None if t is None else len(sp.encode(t)) for k, t in text.items()}
    assert {r.doc_id: r.n_tokens for r in tokens.with_tokens(d, "doc_id").collect()} == want
    part = packing.packed(d, read(spark, "containers")).groupBy("container_kind", "doc_id").agg(F.sum("tokens").alias("n")).collect()
    assert part and all(r.n == want[r.doc_id] for r in part)


def test_slices_add_up(spark):
    d = read(spark, "documents")
    s = tokens.slice_tokens(d)
    each = tokens.with_tokens(d, "doc_id").agg(F.sum("n_tokens")).first()[0]
    total = {r.level: (r.n, r.d) for r in s.groupBy("level").agg(F.sum("n_tokens").alias("n"), F.sum("n_documents").alias("d")).collect()}
    assert set(total.values()) == {(each, d.count())} and len(total) == 8
    assert tokens.slice_tokens(d.where("doc_id < 0")).where("level < 7").count() == 0


def test_packing(spark):
    d, c = read(spark, "documents").repartition(7), read(spark, "containers")
    out = packing.packed(d, c)
    n = tokens.with_tokens(d, "doc_id").where("n_tokens > 0")
    per = out.groupBy("container_kind", "doc_id").agg(F.sum("tokens").alias("t"), F.count("*").alias("pieces"))
    bad = per.join(n, "doc_id", "full").where("t is null or n_tokens is null or t <> n_tokens")
    assert bad.count() == 0 and per.count() == 3 * n.count()
    used = out.groupBy("container_kind", "capacity", "container").agg(F.sum("tokens").alias("u"))
    assert used.where("u > capacity").count() == 0
    split = per.where("pieces > 1").join(n, "doc_id").join(c, "container_kind").where("n_tokens <= capacity_tokens")
    assert split.count() == 0
    assert packing.fill(out).agg(F.min("fill")).first()[0] > 0.9
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id long, text string")
    assert packing.packed(odd, c).count() == 0


# 5


def test_a_book_has_any_number_of_headers(spark):
    heads = ["Toshkent tarixi", "Buyuk karvonlar yoli", "Samarqand ustalari", "Dengiz ortidagi yurtlar", "Qadimgi hunarmandlar haqida bir necha sozlar va ularning bugungi shogirdlari", "Bahor"]
    rng = random.Random(9)
    text = lambda: " ".join("".join(rng.choice("abdeghiklmnoqrstuxyz") for _ in range(6)) for _ in range(9))
    data = [(4 * c + i, "kitob", 4 * c + i, "\n".join([h.replace("a", "o", 1) if i == 3 else h, *(text() for _ in range(8))])) for c, h in enumerate(heads) for i in range(4)]
    df = spark.createDataFrame(data, "ocr_id long, path string, page int, text string")
    got = {(r.ocr_id, r.line_no) for r in ocr.Repaired(df).findings().where("kind = 'furniture'").collect()}
    assert got == {(i, 0) for i in range(24)}


def test_trie_finds_all_within_distance():
    rng = random.Random(3)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row2 = [i]
            for j, y in enumerate(b, 1):
                row2.append(min(row[j] + 1, row2[-1] + 1, row[j - 1] + (x != y)))
            row = row2
        return row[-1]

    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(150)})
    t = ocr.Trie([(w, rng.randint(1, 9)) for w in words])
    for _ in range(60):
        q = "".join(rng.choice("abc") for _ in range(rng.randint(1, 7)))
        for k in (1, 2):
            got = {(w, e) for w, _, e in t.near(q, k, 1)}
            assert got == {(w, distance(q, w)) for w in words if 0 < distance(q, w) <= k}


def test_ocr_pages(spark):
    good = "shahar kitob maktab bilan daraxt uchun yangi katta"
    filler = [("b0", i, "\n".join(["Katta Kitob", *[good] * 8, f"- {i} -"])) for i in range(1, 9)]
    page = "\n".join(["Katta Kitob", "shahar kitob mak-", "tab bilan dаraxt uchun", "", "yangi kat-", "- 9 -"])
    data = [*filler, ("b0", 9, page), ("b0", 10, "Katta Kitob\nta kitob bi1an\n- 10 -"), ("b0", 11, None), ("b1", 1, ""), ("b2", 1, "12")]
    df = spark.createDataFrame([(i, *x, None) for i, x in enumerate(data)], "ocr_id long, path string, page int, text string, confidence double")
    r = ocr.Repaired(df)
    got = Counter((a, c, n) for a, n, c in rows(r.findings(), "ocr_id", "line_no", "kind"))
    assert {k for k in got if k[0] in (8, 9, 12)} == {(8, "furniture", 0), (8, "furniture", 5), (8, "broken_word", 1), (8, "broken_word", 4), (8, "misread", 2), (9, "furniture", 0), (9, "furniture", 2), (9, "misread", 1), (12, "furniture", 0)}
    text = {a: b for a, b in r.text().select("ocr_id", "paragraphs").collect()}
    assert text[8] == ["shahar kitob maktab bilan daraxt uchun", "yangi katta"] and text[9] == ["kitob bilan"]


# 6


def test_language_accuracy_on_held_out_documents(spark):
    d = read(spark, "documents").where("lang in ('uz', 'ru', 'en', 'tr', 'kk') and text is not null").select("doc_id", "lang", "text").orderBy("doc_id").toPandas()
    parts, ys = [], []
    for t, y in zip(d["text"], d["lang"]):
        for s in language.sentences(t)[:4]:
            if len(s) > 30:
                parts.append(s)
                ys.append(language.LANGS.index(y))
    cut = len(parts) * 3 // 4
    m = language.train(parts[:cut], np.array(ys[:cut]))
    p = m.probabilities(parts[cut:])
    assert (p.argmax(axis=1) == np.array(ys[cut:])).mean() > 0.93
    assert np.allclose(p.sum(axis=1), 1) and 0.25 <= m.temperature <= 3
    one = np.concatenate([m.probabilities([s]) for s in parts[:50]])
    assert np.allclose(one, m.probabilities(parts[:50]), atol=1e-5)
    assert language.languages([None, "", "   "], m) == [[], [], []]
    assert [x[1] for x in language.segments("The writers opened an old mill in the city. Биз катта шаҳарга бориб китоб олдик ва қайтдик.", m)] == ["en", "uz"]


def test_labels(spark):
    names = ["__label__uz", "UZ ", "uz_Latn", "uzb", "rus", "und", "", None, "de"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(names)], "i int, x string")
    assert [r[0] for r in df.orderBy("i").select(language.label_code(F.col("x"))).collect()] == ["uz", "uz", "uz", "uz", "ru", None, None, None, "de"]


def test_relabelled(spark):
    seg = language.block_segments(read(spark, "blocks"), read(spark, "language_results")).where("block_id < 400").collect()
    assert all(0 < r.confidence <= 1 and r.n_sentences > 0 for r in seg) and len({r.lang for r in seg}) > 1
    out = language.relabelled(read(spark, "blocks"), read(spark, "language_results"), read(spark, "common_words"))
    got = rows(out, "block_id", "lang")
    assert len(got) == len(set(got)) > 200 and {x for _, x in got} == set(language.LANGS)


# 7


def test_repeats_by_brute_force(spark):
    r = read(spark, "results").selectExpr("result_id AS id", "kept_text AS text")
    text = {x.id: fold.plain_words(x.text) for x in r.collect() if x.text and fold.plain_words(x.text)}
    bags = {i: Counter(w) for i, w in text.items()}
    roots, want = [], []
    for b in sorted(text):
        n = len(text[b])
        most = lambda k: k // 8 + 6 * (k > 24)
        same = [a for a in roots if 0.7 < len(text[a]) / n < 1.4 and (bags[a] - bags[b]).total() <= most(len(text[a])) and (bags[b] - bags[a]).total() <= most(n)]
        if same:
            want.append((same[0], b))
        else:
            roots.append(b)
    assert rows(history.repeats(r), "result_id_a", "result_id_b") == sorted(want)


def test_repeats_of_odd_texts(spark):
    big = "bir xil uzun matn takrorlanadi har safar shu yerda yozilgan holda"
    data = [(i, big.upper() if i % 2 else big + ".") for i in range(1, 40)] + [(50, None), (51, ""), (52, "!!"), (53, "so'z"), (54, "So’z!")]
    df = spark.createDataFrame(data, "id long, text string")
    assert rows(history.repeats(df)) == [(1, i) for i in range(2, 40)] + [(53, 54)]
    assert history.repeats(df.where("id > 99")).count() == 0


def edited(words, rng, vocabulary, share, more):
    """A copy of ``words`` with ``share`` of them replaced and ``more`` added at the end."""
    out = list(words)
    for i in rng.sample(range(len(out)), int(len(out) * share)):
        out[i] = rng.choice(vocabulary)
    return out + rng.choices(vocabulary, k=more)


@pytest.mark.parametrize("least,most", [(18, 63), (64, 127), (128, 255), (256, 600)])
def test_edited_copies_of_every_length_meet(spark, least, most):
    rng = random.Random(least)
    vocabulary = [f"soz{i}" for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]
    texts = [rng.choices(vocabulary, weights, k=rng.randint(least, most)) for _ in range(60)]
    pairs = [(i, edited(t, rng, vocabulary, 0.1 if i % 2 else 0.12, 3)) for i, t in enumerate(texts)]
    data = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(1000 + i, " ".join(t)) for i, t in pairs]
    want = [(i, 1000 + i) for i, t in pairs if history.same_text(" ".join(texts[i]), " ".join(t))]
    assert len(want) > 50
    assert set(rows(history.repeats(spark.createDataFrame(data, "id long, text string")))) >= set(want)


@pytest.mark.parametrize("run,block", [(8, 20_000), (2, 25), (10**6, 10**6)])
def test_pairs_under_a_crowded_gram_all_meet(spark, monkeypatch, run, block):
    # all texts hold one passage, which counts as rare as all other words here, and the copies are far behind their originals
    monkeypatch.setattr(history, "RUN", run)
    monkeypatch.setattr(history, "BLOCK", block)
    rng = random.Random(3)
    vocabulary = [f"soz{i}" for i in range(400)]
    texts = [[f"shablon{i}" for i in range(12)] + rng.choices(vocabulary, k=30) for _ in range(150)]
    data = [(i, " ".join(t)) for i, t in enumerate(texts + [edited(t, rng, vocabulary, 0.1, 0) for t in texts])]
    table = history.pivot_table(df := spark.createDataFrame(data, "id long, text string"), history.word_order(df.limit(0)))
    want = [(a, b) for a, x in data for b, y in data if a < b and history.same_text(x, y)]
    assert len(want) >= 100
    assert rows(history.verified(history.candidate_pairs(table.select("id", "n", "parities"), history.keys_of(table)), [df]), "a", "b") == want


def test_words_by_plain_python():
    rng = random.Random(9)
    texts = ["".join(rng.choice("aBв9 '’ʻ\u200b-_.\n") for _ in range(rng.randint(0, 40))) for _ in range(400)] + ["", "O‘zbek o'ZBEK"]
    h, at = codes.words(texts)
    want = [(i, w) for i, t in enumerate(texts) for w in fold.plain_words(t)]
    assert at.tolist() == [i for i, _ in want]
    by = dict(zip([w for _, w in want], h.tolist()))
    assert len(set(by.values())) == len(by) and [by[w] for _, w in want] == h.tolist()


def test_chains_follow_accepted_texts(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (1, 4), (3, 4), (5, 6), (6, 7), (7, 8)], "a long, b long")
    assert rows(history.accepted_of(links)) == [(2, 1), (4, 1), (6, 5), (8, 7)]
    assert rows(history.accepted_of(links, since=4)) == [(4, 1), (6, 5), (8, 7)]


def test_history_in_batches_equals_all_at_once(spark, tmp_path):
    r = read(spark, "results").select(F.col("result_id").alias("id"), F.col("kept_text").alias("text"), F.col("batch_no").alias("batch"))
    whole = rows(history.repeats(r.select("id", "text")))
    assert rows(history.batches(r, spark, str(tmp_path / "a"))) == whole and whole
    # rows without a batch number belong to the batch they arrived with, and without any there is one batch
    some = r.withColumn("batch", F.when(F.col("id") % 3 > 0, F.col("batch")))
    assert rows(history.batches(some, spark, str(tmp_path / "b"))) == whole
    assert rows(history.batches(r.withColumn("batch", F.lit(None).cast("int")), spark, str(tmp_path / "c"))) == whole
    h = history.History(spark, str(tmp_path / "a"))
    kept = {x.id for x in h.read("texts").collect()}
    assert kept == {x.id for x in r.where("text is not null").collect()} - {b for _, b in whole}
    assert history.batches(r.where("id < 0"), spark, str(tmp_path / "d")).count() == 0


# 9


def test_leaks_by_brute_force(spark):
    items = read(spark, "benchmark").toPandas()
    body = {i: fold.words(t) for i, t in zip(items["item_id"], leak.passages(leak.with_shared(read(spark, "benchmark")).toPandas().set_index("item_id").loc[items["item_id"]].reset_index())["body"])}
    docs = read(spark, "documents").where("text is not null").orderBy("doc_id").limit(250)
    want = set()
    for r in docs.collect():
        w = fold.words(r.text)
        at = defaultdict(list)
        for k, x in enumerate(w):
            at[x].append(k)
        for i, b in body.items():
            for s in range(len(b) - 13):
                # same places but for two words; shifted ones are tested below
                starts = Counter(k - j for j in range(14) for k in at.get(b[s + j], ()))
                if starts and max(starts.values()) >= 12:
                    want.add((r.doc_id, i))
                    break
    got = set(rows(leak.leaked(docs, read(spark, "benchmark"))))
    assert want <= got and len(got - want) <= max(2, len(got) // 10)


def test_leak_of_three_words_in_twenty_one(spark):
    words = [f"so{chr(97 + i)}z" for i in range(25)]
    item = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    filler = ["boshqa"] * 30
    for gone in ((7, 10, 13), (8, 11, 12)):
        text = [x for x in words[:21]]
        for g in gone:
            text[g] = "xato"
        d = spark.createDataFrame([(1, " ".join(filler + text + filler)), (2, " ".join(filler + text[:20] + filler)), (3, " ".join(filler + [w for i, w in enumerate(words[:21]) if i not in gone] + filler))], "doc_id long, text string")
        assert rows(leak.leaked(d, item)) == [(1, 1), (3, 1)]


def test_leak_cases(spark):
    p = "Oltin vodiyda yashovchi qadimgi ustalar har bahorda yangi ko'prik qurib daryo bo'yida katta bayram o'tkazib mehmonlarni kutishgan edi".split()
    item = "Savolga javob bering: " + " ".join(p) + " A) bir B) ikki"
    items = spark.createDataFrame([(1, item), (2, "Savolga javob bering: qisqa"), (3, None)], "item_id long, text string")
    filler = "boshqa gaplar ham shu yerda bor " * 3
    cases = {
        1: filler + " ".join(p).upper() + filler,
        2: filler + " ".join(p[:14]) + filler,
        3: filler + " ".join(p[:11]) + filler,
        4: filler + " ".join(x for k, x in enumerate(p) if k not in (4, 9)) + filler,
        5: filler + " ".join("xato" if k % 3 == 0 else x for k, x in enumerate(p)) + filler,
        6: "Олтин водийда яшовчи қадимги усталар ҳар баҳорда янги кўприк қуриб дарё бўйида катта байрам ўтказиб меҳмонларни кутишган эди",
        7: "Savolga javob bering: qisqa",
        8: None,
        9: "",
    }
    docs = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    assert rows(leak.leaked(docs, items)) == [(1, 1), (2, 1), (4, 1), (6, 1)]
    assert rows(leak.leaked(docs, items, ship_words=10)) == [(1, 1), (2, 1), (4, 1), (6, 1)]
    assert leak.leaked(docs, items.where("item_id > 9")).count() == 0


# 10


def test_undo_round_trip():
    text = "Биз катта шаҳарда яшаймиз"
    assert mojibake.undo(text.encode("utf-8").decode("latin-1"), "utf-8 as latin-1") == text
    russian = "внезапно"
    for t, w in (("koi8-r", "cp1251"), ("cp1251", "cp1252"), ("cp866", "cp1251")):
        assert mojibake.undo(russian.encode(t).decode(w), f"{t} as {w}") == russian
    assert mojibake.undo("Ã-Đinh", "utf-8 as cp1252") is None


def test_garbled_documents(spark):
    words = ["шаҳарда", "қадимги", "ўқувчи", "китоблар", "мактабда", "дарахтлар"]
    rng = random.Random(5)
    clean = [(i, " ".join(rng.choice(words) for _ in range(12)) + " oʻquvchi gʻalaba.") for i in range(80)]
    bad = " ".join(words)
    cases = {
        200: bad.encode().decode("cp1252", "replace").replace("�", "\x90"),
        201: "Oddiy gap. " + "китоблар мактабда дарахтлар".encode("cp1251").decode("cp1252"),
        202: "Matnda o?quvchi va g???alaba bor",
        203: "Âlîşar, Côte-Brûlée, Ñandero / Ðalgarður",
        204: "Nima??? Qachon?! oʻquvchi &nbsp; keldi",
        205: "yo�qolgan harf",
        206: None,
        207: "",
        208: "Matn bor. ?????? ???? 19 ?? ???????, ???? ????????? bor",
        209: "??? ?? Nima? ??? Kim? ???? bor",
    }
    docs = spark.createDataFrame([*clean, *cases.items()], "doc_id long, text string")
    hits = mojibake.garbled(docs).cache()
    assert {r.doc_id for r in mojibake.found(hits).collect()} - {200} == {201, 202, 205, 208}
    fixed = {r.doc_id: (r.restored_text, r.complete) for r in mojibake.restored(docs, hits).collect()}
    assert fixed[201] == ("Oddiy gap. китоблар мактабда дарахтлар", True) and fixed[205][1] is False
    assert mojibake.found(mojibake.garbled(docs.where("doc_id > 999"))).count() == 0


def test_runs_of_question_marks_of_any_length(spark):
    docs = spark.createDataFrame([(1, "Matn bor. " + "????? ???, " * 10_000 + "oxiri"), (2, "?? ?? ??"), (3, "Nima? " * 20_000)], "doc_id long, text string")
    hits = mojibake.garbled(docs).cache()
    assert rows(mojibake.found(hits), "doc_id") == [(1,)]
    assert [len(r.token.split()) for r in hits.where("chain = 'only question marks'").collect()] == [20_000]


def test_twins_on_stripped_text(spark):
    assert mojibake.inferred("oâ€˜zbekâ€™", "o‘zbek’") and "utf-8 as cp1252" in mojibake.inferred("oâ€˜zbek", "o‘zbek")
    assert mojibake.inferred("yaðmur", "yağmur") == ["cp1254 as cp1252"] and mojibake.inferred("olma", "anor") == [] == mojibake.inferred("ğa", "ğa")
    types = [("o‘zbek", 30), ("oâ€˜zbek,", 2), ("yağmur.", 9), ("yaðmur", 1), ("yağmur?!", 1), ("ğ", 9), ("olma", 50)]
    got = rows(mojibake.stripped_twins(spark.createDataFrame(types, "token string, n long")), "token", "chain", "restored")
    assert {(t, r) for t, _, r in got} == {("oâ€˜zbek,", "o‘zbek,"), ("yaðmur", "yağmur")}


def test_no_query_needs_a_session_to_be_listed():
    from qatlam.llm import queries

    assert json.dumps(sorted(queries.QUERIES)) and {f"p{n}_found" for n in (1, 2, 3, 5, 6, 7, 9, 10)} <= set(queries.QUERIES)


def test_ocr_vocabulary_in_parts(spark, monkeypatch):
    good = "shahar kitob maktab bilan daraxt uchun yangi katta"
    data = [("b0", i, "\n".join([good] * 8)) for i in range(1, 9)] + [("b0", 9, "shahаr kit0b mаktab bi1an dаraxt\nkatta yan-"), ("b0", 10, "gi shahar.")]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(data)], "ocr_id long, path string, page int, text string")
    whole = ocr.Repaired(df)
    want = rows(whole.findings()), rows(whole.text(), "ocr_id", "paragraphs")
    monkeypatch.setattr(ocr, "SHIP_TYPES", 3)
    parts = ocr.Repaired(df)
    assert rows(parts.misread) == rows(whole.misread) and (rows(parts.findings()), rows(parts.text(), "ocr_id", "paragraphs")) == want
    assert dict(want[1])[8] == ["shahar kitob maktab bilan daraxt katta yangi"]


def test_ocr_candidates_are_complete():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, last = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
        return row[-1]

    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abo'") for _ in range(rng.randint(1, 8))) for _ in range(120)})
    trie = ocr.Trie([(w, 10 + len(w)) for w in words])
    for w in words[::3] + ["bab0ab", "ob", "aaaaaaaa"]:
        for k in (1, 2):
            assert {(c, e) for c, _, e in trie.near(w, k, 12)} == {(c, d) for c in words if len(c) >= 2 and 0 < (d := distance(w, c)) <= k}


def test_ocr_context_chooses_among_candidates(spark):
    # "h" and "b" are confused: the same misread word is "bar" or "har" by the words beside it
    lines = ["yangi bar joy", "eski har kuni"] * 12
    edge = lambda i: "\n".join(chr(97 + i * 2 + k % 2) * (5 + 4 * k) for k in range(3))
    data = [(i, "b0", i, "\n".join([edge(i), *lines, edge(i + 10)])) for i in range(2)]
    data += [(8, "b0", 8, f"{edge(4)}\nyangi 6ar joy\n{edge(5)}"), (9, "b0", 9, f"{edge(6)}\neski 6ar kuni\n{edge(7)}")]
    pages = spark.createDataFrame(data, "ocr_id long, path string, page int, text string")
    r = ocr.Repaired(pages)
    words = ocr.page_words(r.pages)
    two = spark.createDataFrame([("6ar", "bar", 9, 1, 0), ("6ar", "har", 9, 1, 0)], "word string, candidate string, n long, edits int, odd int")
    assert {x.ocr_id: dict(x.fixes) for x in ocr.page_fixes(words, two).collect()} == {8: {"6ar": "bar"}, 9: {"6ar": "har"}}
    assert rows(ocr.Repaired(pages.where("ocr_id > 99")).findings()) == []

