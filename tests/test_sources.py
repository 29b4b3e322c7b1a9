import gzip
import io
import zipfile
import zlib

import pytest

from qatlam import cli
from qatlam.functions import html as H
from qatlam.functions import names as N
from qatlam.sinks import files as K
from qatlam.sources import catalogue, scanned
from qatlam.sources import readers as R
from qatlam.streaming.incremental import run_available


def zipped(**files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for n, t in files.items():
            z.writestr(n.replace("__", "/").replace("--", "."), t)
    return b.getvalue()


W = 'xmlns:w="http://w" xmlns:a="http://a" xmlns:p="http://p"'
DOCX = zipped(**{"word/document.xml": f"<w:document {W}><w:p><w:t>Bir </w:t><w:t>ikki</w:t></w:p><w:p/><w:p><w:t>uch</w:t></w:p></w:document>"})
PPTX = zipped(**{f"ppt/slides/slide{i}.xml": f"<p:sld {W}><p:txBody><a:p><a:t>slayd {i}</a:t></a:p></p:txBody></p:sld>" for i in (1, 2, 10)})
EPUB = zipped(**{"mimetype": "application/epub+zip", "O/c.opf": "<package><manifest><item id='a' href='a.html'/></manifest><spine><itemref idref='a'/></spine></package>", "O/a.html": "<h1>Bob</h1><p>Matn &amp; yana</p>"})
FB2 = b'<FictionBook xmlns="http://f"><body><p>Bir <b>ikki</b></p><p> </p><p>uch</p></body></FictionBook>'
PAGE = "<html><head><title>S</title><meta property='og:title' content='Sarlavha'><meta property='article:published_time' content='2024-01-02'></head><body><nav>Menyu</nav><div class='article-body'>" + "<p>Bu uzun va mazmunli paragraf matni hisoblanadi, unda yetarlicha so'z bor.</p><p>Yana bir xil bo'lmagan paragraf ham shu yerda turibdi, u ham uzun.</p>" * 3 + "<script>x</script></div></body></html>"


def test_extractors():
    assert R.docx(DOCX) == [(0, "Bir ikki"), (2, "uch")]
    assert R.pptx(PPTX) == [(0, "slayd 1"), (1, "slayd 2"), (2, "slayd 10")]
    assert R.epub(EPUB) == [(0, "Bob"), (1, "Matn & yana")]
    assert R.fb2(FB2) == [(0, "Bir ikki"), (2, "uch")]
    assert R.txt("a\n\n\n\n b \n\nc".encode()) == [(0, "a"), (1, "b"), (2, "c")]


@pytest.mark.parametrize("path,content,kind", [("a.PDF", b"", "pdf"), ("a", b"%PDF-1.4", "pdf"), ("a", DOCX, "docx"), ("a", PPTX, "pptx"), ("a", EPUB, "epub"), ("a", b"  <p>", "html"), ("a", b"salom", "txt"), ("a", b"PK\x03\x04zz", "unknown")])
def test_sniffing(path, content, kind):
    assert R.sniffed(path, content) == kind


def test_file_blocks(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/a.docx").write_bytes(DOCX)
    (tmp_path / "x/b.docx").write_bytes(b"broken")
    (tmp_path / "c.txt").write_text("bir\n\nikki")
    rows = R.file_blocks(R.files(spark, str(tmp_path))).collect()
    assert sorted((r.path[-6:], r.block_idx, r.text) for r in rows if r.error is None) == [("a.docx", 0, "Bir ikki"), ("a.docx", 1, "uch"), ("/c.txt", 0, "bir"), ("/c.txt", 1, "ikki")][2:] + [("a.docx", 0, "Bir ikki"), ("a.docx", 1, "uch")]
    assert [r.path[-6:] for r in rows if r.error] == ["b.docx"]


def test_html():
    root = H.parse(PAGE)
    assert H.metadata(root)[:2] == ("Sarlavha", "2024-01-02T00:00:00+00:00")
    (method, selector, text, score, n, density), *_ = H.candidates(PAGE)
    assert (method, selector, n, density) == ("dom", ".article-body", 6, 0.0) and "Menyu" not in text
    ld = "<script type='application/ld+json'>{\"@type\":\"NewsArticle\",\"articleBody\":\"" + "so'z " * 80 + '"}</script>'
    assert H.candidates(ld)[0][0] == "jsonld" and H.is_article(H.parse(ld))
    assert H.blocks(H.parse("<p>a b<p>a b</p><div>c<br>dd</div>")) == ["a b", "dd"]
    assert H.first_json('x {"a": "}"} y') == '{"a": "}"}'
    assert H.candidates("") == []


def test_page_candidates(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "page_id long, html string")
    assert {r.page_id for r in H.page_candidates(df).collect()} == {1}


def test_sitemap(spark, tmp_path):
    xml = "<urlset><url><loc>http://a/1</loc></url><url><loc>http://a/2</loc><lastmod>2024-01-01</lastmod></url></urlset>"
    (tmp_path / "s.xml.gz").write_bytes(gzip.compress(xml.encode()))
    assert [tuple(r)[:2] for r in R.sitemap(spark, str(tmp_path / "s.xml.gz")).collect()] == [("http://a/2", "2024-01-01"), ("http://a/1", None)]


def test_parquet_texts(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2)], "text string, other int").coalesce(1).write.parquet(str(tmp_path / "w"))
    part = next((tmp_path / "w").glob("part-*.parquet"))
    (tmp_path / "d").mkdir()
    part.rename(tmp_path / "d/train-00003-of-00009.parquet")
    df = R.parquet_texts(spark, str(tmp_path / "d"), "train")
    assert sorted(tuple(r) for r in df.collect()) == [(3, 0, "a"), (3, 1, "b")]
    assert "other" not in df._jdf.queryExecution().executedPlan().toString()


def test_stream_keeps_each_paragraph_once(spark, tmp_path):
    uz = "Bu kitob va uning daftari bilan birga o'qiladi, lekin hali tugamagan."
    for i, t in enumerate([uz, uz.upper().lower(), "qisqa"]):
        spark.createDataFrame([(i, t)], "block_id long, text string").write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):
        run_available(spark, str(tmp_path / "in"), "block_id long, text string", str(tmp_path / "out"), str(tmp_path / "ck"), 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def pdf_of(*pages, pack=True):
    """A small PDF, one content stream a page, written as simple producers do."""
    objects = {1: b"<</Type/Catalog/Pages 2 0 R>>", 2: b"<</Type/Pages/Kids[%s]/Count %d>>" % (b" ".join(b"%d 0 R" % (10 + 2 * i) for i in range(len(pages))), len(pages))}
    objects[3] = b"<</Type/Font/ToUnicode 4 0 R>>"
    cmap = b"beginbfchar <01> <045E> endbfchar beginbfrange <02> <04> <0430> endbfrange"
    objects[4] = b"<</Length %d>>stream\n%s\nendstream" % (len(cmap), cmap)
    for i, text in enumerate(pages):
        data = zlib.compress(text) if pack else text
        objects[10 + 2 * i] = b"<</Type/Page/Parent 2 0 R/Resources<</Font<</F2 3 0 R>>>>/Contents %d 0 R>>" % (11 + 2 * i)
        objects[11 + 2 * i] = b"<<%s/Length %d>>stream\n%s\nendstream" % (b"/Filter/FlateDecode" if pack else b"", len(data), data)
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj %s endobj\n" % o for o in objects.items())


def test_pdf_text_layer():
    one = b"BT /F1 12 Tf 72 700 Td (Birinchi qator \\(a\\)) Tj 0 -14 Td [(ikkin) -20 (chi) -300 (qator)] TJ ET BT 72 100 Td (Yana bir blok) Tj ET"
    two = b"BT /F2 9 Tf 0 0 Td <01020304> Tj T* <0203040102030401020304010203> Tj T* <0203> Tj ET"
    for pack in (True, False):
        got = scanned.pdf(pdf_of(one, b"BT (kalta) Tj ET", two, pack=pack))
        assert got[:2] == [(1, "Birinchi qator (a)\nikkinchi qator"), (1, "Yana bir blok")]
        assert got[2] == (3, "ўабв\nабвўабвўабвўаб\nаб")
    assert scanned.pdf(b"%PDF-1.4 broken") == [] == scanned.pdf(pdf_of(one) + b"trailer<</Encrypt 9 0 R>>")
    with pytest.raises(ValueError):
        scanned.djvu(b"no")


def test_djvu_text_layer():
    text = "Birinchi sahifaning matni shu yerda.\n\nIkkinchi xatboshi.".encode()
    chunk = lambda name, data: name + len(data).to_bytes(4, "big") + data + b"\0" * (len(data) % 2)
    page = lambda t: chunk(b"FORM", b"DJVU" + chunk(b"INFO", b"12345") + chunk(b"TXTa", len(t).to_bytes(3, "big") + t + b"\1"))
    file = b"AT&T" + chunk(b"FORM", b"DJVM" + page(text) + page(b"kalta") + page(text))
    assert scanned.djvu(file) == [(1, "Birinchi sahifaning matni shu yerda."), (1, "Ikkinchi xatboshi."), (3, "Birinchi sahifaning matni shu yerda."), (3, "Ikkinchi xatboshi.")]


CATALOGUE = """<div class="pd-category"><h3> Jahon nasri </h3></div><a href="/kutubxona/a?utm_source=x&amp;p=2">A</a><a href="/kutubxona/a?p=2">yana</a>
<a href="?download=12:bir-kitob">yuklash</a><a href="/x?download=12:bir-kitob">saqlash</a><a href="https://boshqa.uz/kutubxona/b">tashqi</a><a href="/aloqa">aloqa</a>"""


def test_catalogue(spark):
    assert catalogue.heading(CATALOGUE) == "Jahon nasri" and catalogue.heading("<p>") is None
    assert catalogue.links(CATALOGUE, "https://k.uz/kutubxona/") == [("https://k.uz/kutubxona/a?p=2", None, None), ("https://k.uz/kutubxona/?download=12:bir-kitob", "12", "bir-kitob")]
    df = catalogue.catalogue_links(spark.createDataFrame([("https://k.uz/kutubxona/", CATALOGUE), ("https://k.uz/b", None)], "url string, html string"))
    got = {(r.category, r.item_id) for r in N.library_category(df, "category", "to").where("to = 'books'").collect()}
    assert got == {("Jahon nasri", None), ("Jahon nasri", "12")}
    robots = spark.createDataFrame([("a", "User-agent: *\nDisallow: /x\nSitemap: https://a/s.xml"), ("b", "")], "host string, rules string")
    urls = spark.createDataFrame([("a", "https://a/x/1"), ("a", "https://a/y"), ("b", "https://b/x"), ("c", "https://c/x")], "host string, url string")
    assert [r.allowed for r in catalogue.allowed(urls, robots).orderBy("url").collect()] == [False, True, True, True]
    assert sorted(r.sitemap for r in catalogue.sitemaps_of(robots).collect()) == ["https://a/s.xml", "https://b/sitemap.xml"]


def test_scores_of_candidates():
    p = "".join(f"<p>Bu {w} va mazmunli paragraf matni hisoblanadi, unda yetarlicha so'z bor.</p>" for w in ("uzun", "keng", "yangi", "eski", "oxirgi"))
    by = {s: score for _, s, _, score, _, _ in H.candidates(f"<div class='news-content'>{p}</div><div class='post sidebar comment'>{p}</div>")}
    assert by[".news-content"] - by["div.post.sidebar.comment"] == 2 * 800 - (800 - 2 * 2500)
    nuxt = lambda c: "<script id='__NUXT_DATA__'>" + __import__("json").dumps([f"<div class='{c}'>{p}</div>"]) + "</script>"
    scores = [H.candidates(nuxt(c))[0][3] for c in ("post-content", "boshqa")]
    assert scores[0] - scores[1] == 4000
    assert H.metadata(H.parse("<title>T</title>"), "https://x.uz/2024/5/31/a")[1] == "2024-05-31T00:00:00+00:00"
    assert H.is_article(H.parse(""), "https://x.uz/2024/5/31/a") and not H.is_article(H.parse(""), "https://x.uz/2024/a")


def test_names(spark, values):
    shard = "tahrirchi_uz-crawl__train_x__shard-000012.txt"
    assert values(N.source_id, [shard, "corpus-a__train__shard-000001.txt", "10763_kimdir.txt", "boshqa.txt"]) == ["hf:tahrirchi/uz-crawl:train_x:shard-000012", None, "ziyouz:10763", None]
    assert values(N.renamed, ["yakhyo_uz-wiki__train__shard-000002.txt", "x__y__shard-1.txt"]) == ["corpus-c__train__shard-000002.txt", None]
    assert values(N.is_from_dataset, ["corpus-b__a__shard-1.txt", "x__y__shard-1.txt", "k.txt"]) == [True, False, False]


def test_written_files_read_back(spark, tmp_path):
    d = spark.createDataFrame([("k/a.pdf", 0, "bir", "books"), ("k/a.pdf", 1, "ikki", "books"), ("c", 0, "uch", None)], "path string, part int, kept_text string, category string")
    K.write_texts(d, str(tmp_path / "t"))
    assert sorted((r.category, r.name, r.part, r.text) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [("books", "a", 0, "bir"), ("books", "a", 1, "ikki"), ("uncategorized", "c", 0, "uch")]
    out = {r.file: r.n_chars for r in K.export_texts(d, str(tmp_path / "e")).collect()}
    assert sorted(out.values()) == [3, 9] and (tmp_path / "e/books/a.txt").read_text() == "bir\n\nikki" and len(list((tmp_path / "e/books").iterdir())) == 1
    b = spark.createDataFrame([("p", 1, "x", "takror"), ("p", 2, "y", None)], "path string, page int, text string, drop_reason string")
    K.write_rejected(b, str(tmp_path / "r"))
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "r")).select("path", "page", "reason", "text").collect()] == [("p", 1, "takror", "x")]
    a = spark.createDataFrame([("s.uz", 1, i, 10 + i, f"matn {i}", "T", "2024-01-02T00", "u") for i in (2, 1, 3)] + [("s.uz", 2, 4, 14, "oxirgi", "T", None, "u")], "domain string, bundle int, seq int, article_id long, text string, title string, day string, url string")
    K.write_bundles(a, str(tmp_path / "b"))
    texts = spark.read.text(str(tmp_path / "b/text/domain=s.uz/bundle=1"))
    assert [r.value for r in texts.collect() if r.value] == ["matn 1", "matn 2", "matn 3"]
    table = spark.read.json(str(tmp_path / "b/table")).orderBy("id").collect()
    assert [(r.id, r.date, r.bundle) for r in table] == [(11, "2024-01-02", 1), (12, "2024-01-02", 1), (13, "2024-01-02", 1), (14, None, 2)]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in/books").mkdir(parents=True)
    good = "Bu kitob haqida yozilgan uzun gap bo'lib, unda ancha so'zlar va fikrlar bor."
    (tmp_path / "in/books/a.txt").write_text(f"{good}\n\nThe quick brown fox jumped over the lazy dog today.\n\n{good}")
    (tmp_path / "in/books/b.txt").write_text("qisqa")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    cli.run(spark, source, target)
    assert [(r.name, r.text) for r in spark.read.parquet(f"{target}/texts").collect()] == [("a", good)]
    assert sorted(r.reason for r in spark.read.json(f"{target}/rejected").collect()) == ["takror", "til_ozbekcha_emas", "til_ozbekcha_emas"]
    assert {(r.path, r.total_blocks, r.kept_blocks) for r in spark.read.json(f"{target}/reports").collect()} == {("books/a.txt", 3, 1), ("books/b.txt", 1, 0)}
    cli.stats(spark, target)
    cli.finalize(spark, target)
    assert "JAMI" in capsys.readouterr().out and spark.read.parquet(f"{target}/ledger-final").count() == 2
