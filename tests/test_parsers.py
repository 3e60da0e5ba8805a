import datetime as dt

import pytest
from pyspark.sql import functions as F

from hammerline.functions import parsers as P
from hammerline.functions import text as T
from hammerline.operators.search import search_index, inverted_index, search_texts
from hammerline.sources import html as H
from hammerline.sources.html import page_lots


def values(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in df.select("i", expr(F.col("t")).alias("v")).orderBy("i").collect()]


def test_parse_price(spark):
    texts = ["$1,234", "1.234.567,89", "100 - 150", "unsold", "", None, "€ 12.50"]
    assert values(spark, texts, P.parse_price) == [1234.0, 1234.56789, None, None, None, None, 12.5]


def test_parse_price_info(spark):
    rows = values(spark, ["$1,000 - $1,500", "Vendido $900", "unsold 1.500,00", "x"], P.parse_price_info)
    assert [(r["min_price"], r["max_price"], r["sold"], r["final_price"]) for r in rows] == [
        (1000.0, 1500.0, False, None), (900.0, 900.0, True, 900.0), (150000.0, 150000.0, True, 150000.0), (None, None, False, None),
    ]


def test_parse_date(spark):
    texts = ["2025-08-20", "20/08/2025 10:30", "8/20/2025", "August 20, 2025", "20 August 2025", "soon"]
    day = dt.datetime(2025, 8, 20)
    assert values(spark, texts, P.parse_date) == [day, day.replace(hour=10, minute=30), day, day, day, None]


def test_extract_dates(spark):
    texts = ["5 de agosto de 2025 19:00 y 6 de Agosto de 2025 20:00, 7/8/2025 21:30", "2025-08-05 10:00", None]
    rows = values(spark, texts, P.extract_dates)
    assert (rows[0]["start"], rows[0]["end"]) == (dt.datetime(2025, 8, 5, 19), dt.datetime(2025, 8, 7, 21, 30))
    assert (rows[1]["start"], rows[1]["end"]) == (None, None)


def test_extract_artist(spark):
    texts = ["Paisaje por Diego Rivera", "Cuadro de Botero", "Rivera, Diego", "DIEGO RIVERA (1886)", "nada"]
    assert values(spark, texts, P.extract_artist) == ["Diego Rivera", "Botero", "Rivera, Diego", "DIEGO RIVERA", None]


def test_external_id_and_page_type(spark):
    assert values(spark, ["/subasta/12/x", "/a/34", "?id=56", "subasta-ab", "none"], P.external_id) == ["12", "34", "56", "ab", None]
    assert values(spark, ["Online!", "en vivo presencial", "x"], P.page_type) == ["online", "live", "hybrid"]


def test_lot_details(spark):
    row = values(spark, ["Óleo sobre tela, pintura, 30 x 40 cm"], P.lot_details)[0]
    assert (row["dimensions"], row["medium"], row["category"]) == ("30 x 40", "Óleo", "Pintura")


def test_page_lots_selector_order():
    html = '<div class="lote"><span class="numero">7</span><h3>Vase</h3><p>by x</p><span class="precio">$5</span></div><article><h2>no</h2></article>'
    assert [(r[0], r[1], r[2], r[3]) for r in page_lots(html)] == [("7", "Vase", "by x", "$5")]
    assert [r[1] for r in page_lots("<article><h2>Only</h2></article>")] == ["Only"]
    assert page_lots(None) == []


def test_urls_and_slugs(spark):
    absolute = values(spark, ["//c/x", "/a", "http://b"], lambda c: T.absolute_url(c, "http://h/"))
    assert absolute == ["https://c/x", "http://h/a", "http://b"]
    assert values(spark, ["A & B"], T.slugify) == ["a-and-b"]


@pytest.mark.parametrize(("query", "terms"), [("de la", []), ("oil", ["oil"]), ("oil oil canvas", ["oil", "canvas"]), ("O'Brien & co", ["o", "brien"])])
def test_query_terms(query, terms):
    assert T.query_terms(query) == terms


def test_rank_and_index_agree(spark):
    docs = spark.createDataFrame([(1, "oil on oil canvas"), (2, "canvas"), (3, "paper"), (4, None)], "doc_id long, text string")
    plain = search_texts(docs, "oil canvas").collect()
    assert [r["doc_id"] for r in plain] == [1, 2]
    assert abs(plain[0]["rank"] - (1.25 + 1) * 0.1 / T.ZETA_2 / 2) < 1e-6
    assert search_index(inverted_index(docs), "oil canvas").collect() == plain
    assert search_texts(docs, "a b").count() == 0


def test_stems_of_the_published_rules():
    pairs = (
        "caresses caress ties tie cries cri gas gas kiwis kiwi agreed agre hopping hop hoping hope luxuriated luxuri happy happi "
        "generalization general generate generat relational relat conditional condit hopeful hope goodness good replacement replac adoption adopt "
        "controlling control knightly knight skies sky dying die news news inning inning communication communic sensational sensat "
        "consistently consist paintings paint galleries galleri rings ring released releas licenses licens"
    ).split()
    assert [T.stem(w) for w in pairs[::2]] == pairs[1::2]


def test_stemmed_search_meets_other_forms(spark):
    from hammerline.operators.search import search_texts_stemmed

    docs = spark.createDataFrame([(1, "The licenses were released"), (2, "a license"), (3, "the and of"), (4, None)], "doc_id long, text string")
    rows = search_texts_stemmed(docs, "license releasing").collect()
    assert [r["doc_id"] for r in rows] == [1, 2]
    assert abs(rows[0]["rank"] - 2 * T.WEIGHT / T.ZETA_2 / 2) < 1e-6
    assert search_texts_stemmed(docs, "the and").count() == 0


def test_lots_search_in_english_form_equals_a_plain_version(spark):
    from compare import SF
    from hammerline.operators.search import search_artists, search_lots
    from hammerline.plans.market import from_tables, lots_enriched

    m = from_tables(spark, SF)
    rows = lots_enriched(m).select("id", "title", "final_price", "category_name").collect()
    wanted = ["ring", "small"]
    hits = []
    for r in rows:
        words = [T.stem(w) for w in (r["title"] or "").lower().split() if w not in T.STOP_WORDS]
        n = [words.count(w) for w in wanted]
        if any(n) and "brand#1" in r["category_name"].lower() and r["final_price"] is not None and r["final_price"] >= 5000:
            rank = round(sum(sum(1 / i / i for i in range(1, k + 1)) for k in n) * T.WEIGHT / T.ZETA_2 / 2, 6)
            hits.append((-rank, -r["final_price"], r["id"]))
    got = search_lots(m, "the rings smalls", category="brand#1", price_min=5000, english=True).collect()
    assert hits and [r["id"] for r in got] == [i for _, _, i in sorted(hits)[:50]]
    assert search_artists(m, "the suppliers of", english=True).count() == min(20, m.artists.count())


def test_stored_index_reads_only_its_folders(spark, tmp_path):
    from hammerline.operators.search import search_stored, store_index

    docs = spark.createDataFrame([(1, "oil on oil canvas"), (2, "canvas"), (3, "paper"), (4, None)], "doc_id long, text string")
    store_index(docs, f"file://{tmp_path}/index")
    index = spark.read.parquet(f"file://{tmp_path}/index")
    assert search_stored(index, "oil canvas").collect() == search_texts(docs, "oil canvas").collect()
    assert search_stored(index, "a b").count() == 0


def test_links_images_and_descriptions_of_pages(spark):

    page = """<a class='x titulo-subasta' href='/es/subasta/12/arte'><b>Arte</b> vivo</a> <a href="/b">B</a><a href="">no</a><a name="x">no</a>
      <script>var a = "<a href='/c'>online</a>";</script><img data-src="//c/1.jpg" src="/2.jpg"><img lowsrc="/no.jpg" data-src='/3.jpg'>
      <div class="a descripcion-subasta">Una <i>venta</i></div><style>.live{}</style> en vivo"""
    df = spark.createDataFrame([(1, page, "https://h/subasta/7")], "page_id long, html string, url string")
    rows = [(r["href"], r["title"], r["status"], r["external_id"]) for r in H.links(df).collect()]
    assert rows[:2] == [("/es/subasta/12/arte", "Arte vivo", "active", "12"), ("/b", "B", None, None)]
    one = df.select(H.images(F.col("html"), "https://h").alias("i"), H.description(F.col("html")).alias("d"), P.page_type(T.page_text(F.col("html"))).alias("t")).first()
    assert (one["i"], one["d"], one["t"]) == (["https://h/2.jpg", "https://h/3.jpg"], "Una venta", "hybrid")
    lot = '<div class="lote"><span class="numero">7</span><h3>Vase</h3><img src="/v.jpg"></div>'
    own = H.lots(spark.createDataFrame([(1, lot, "https://h/subasta/7"), (2, lot, "https://h/x")], "page_id long, html string, url string"), "https://h")
    assert sorted((r["external_id"] or "", r["images"]) for r in own.collect()) == [("", ["https://h/v.jpg"]), ("7_7", ["https://h/v.jpg"])]


def test_auctions_take_the_details_of_the_page_they_lead_to(spark):
    listing = '<a class="titulo-subasta" href="/es/subasta/12">Spring</a><a href="/es/subasta/13">Autumn</a><a href="/x"></a>'
    page = '<div class="description">Fine <b>art</b></div><p>Subasta virtual, 3 de mayo de 2021 19:30</p>'
    df = spark.createDataFrame([(1, "https://h/list", listing), (2, "https://h/es/subasta/12", page), (3, "https://h/es/subasta/12", "live")], "page_id long, url string, html string")
    rows = {r["title"]: r for r in H.auctions(df, "https://h").collect()}
    assert {t: (r["status"], r["auction_type"], r["description"], r["external_id"]) for t, r in rows.items()} == {
        "Spring": ("active", "online", "Fine art", "12"), "Autumn": ("completed", "hybrid", None, "13"),
    }
    assert str(rows["Spring"]["start_date"]).startswith("2021-05-03")


def test_lots_by_strategy_leave_pages_without_a_parser(spark):
    html = '<div class="lote"><h2>Vase</h2></div>'
    df = spark.createDataFrame([(1, "/1", html, "html_static"), (2, "/2", html, "browser"), (3, "/3", html, None)], "page_id long, url string, html string, strategy string")
    assert [r["page_id"] for r in H.lots_by_strategy(df).collect()] == [1]


def test_no_text_reaches_python_for_stems(spark):
    """Stems are made of the corpus's different words; documents are matched without Python."""
    from hammerline.operators.search import search_texts_stemmed, word_forms

    rows = [(1, "Licenses licensed the license"), (2, "licensing " * 3000), (3, "the and"), (4, None), (5, "releases")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert word_forms(docs, ["licens", "the"]) == {w: "licens" for w in ("licenses", "licensed", "license", "licensing")}
    found = search_texts_stemmed(docs, "license releasing")
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r["doc_id"] for r in found.collect()] == [2, 1, 5]
    assert search_texts_stemmed(docs, "zebras").count() == 0
