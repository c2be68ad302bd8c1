"""Main text on hosts with many copies of a page, and on hosts with few pages."""

from patchlode.llm.wrappers import extract_main_text

PAGE = "<html><body><nav>{}</nav><div id=top>Fixed line</div><div class='{}'><p>{}</p></div></body></html>"


def found(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    return {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()}


def test_copies_of_one_page(spark):
    one = PAGE.format("menu", "story", "The only article here")
    rows = [(i, f"http://copies.example/{i}", one) for i in range(30)]
    rows += [(100 + i, None, "<p>hostless</p>") for i in range(30)]
    texts = found(spark, rows)
    assert all(texts[i] == "Fixed line The only article here" for i in range(30))
    assert all(texts[100 + i] == "hostless" for i in range(30))


def test_article_with_its_own_place_crawled_often(spark):
    rows = [(i, f"http://mixed.example/{i}", PAGE.format("menu", "story", f"Story {i} goes on")) for i in range(20)]
    rows += [(100 + i, "http://mixed.example/own", PAGE.format(f"menu of day {i}", "story special", "An article of its own")) for i in range(30)]
    texts = found(spark, rows)
    assert all(texts[i] == f"Story {i} goes on" for i in range(20))
    assert all(texts[100 + i] == "An article of its own" for i in range(30))


def test_fixed_text_on_a_small_host(spark):
    rows = [(i, f"http://small.example/{i}", PAGE.format("menu", "story", f"Story {i} goes on")) for i in range(4)]
    assert found(spark, rows) == {i: f"Story {i} goes on" for i in range(4)}
