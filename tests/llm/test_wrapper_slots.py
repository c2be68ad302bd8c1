"""Wrapper slots decide texts that no name or element tells."""

import json

from patchlode.llm.wrappers import _nodes, decide, extract_main_text, fold, main_text, regions

WORDS = "river stone cloud lamp garden winter market letter window bridge forest candle".split()


def words(seed, n):
    return " ".join(WORDS[(seed * 7 + i * (seed % 5 + 1) + i * i) % 12] + str(seed * 31 + i) for i in range(n))


def page(i):
    box = "<div class=box><h3>Top stories</h3><ul>" + "".join(f"<li>{words(900 + i + j, 5)}</li>" for j in range(2 + i % 3)) + "</ul></div>"
    said = "".join(f"<div><b>{words(500 + i + j, 2)}</b><p>{words(600 + 3 * i + j, 15)}</p></div>" for j in range(1 + i % 4))
    body = [f"<h1>{words(i, 4)}</h1>", *(f"<p>{words(i * 10 + j, 20)} <a href=x>{words(i, 2)}</a> on</p>" for j in range(2 + i % 3)), box, f"<p>{words(i + 77, 20)}</p>"]
    body += [f"<ul><li>{words(i + 200, 3)}</li><li>{words(i + 300, 3)}</li></ul>"] * (i % 2)
    html = f"<html><body><article>{''.join(body)}<div class=opinions>{said}</div></article></body></html>"
    kept = [words(i, 4), *(f"{words(i * 10 + j, 20)} {words(i, 2)} on" for j in range(2 + i % 3)), words(i + 77, 20)]
    kept += [words(i + 200, 3), words(i + 300, 3)] * (i % 2)
    return html, " ".join(kept)


def test_box_and_comments_that_vary(spark):
    rows = [(i, f"http://own.example/{i}", page(i)[0]) for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    found = {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()}
    assert found == {i: page(i)[1] for i in range(30)}
    # without the wrapper the same texts would hold the box and the comments
    assert all(main_text(page(i)[0], None, set(), {}, "h") != page(i)[1] for i in range(30))


def test_sections_with_headings_stay(spark):
    rows = []
    for i in range(12):
        parts = [(words(i + 50 * j, 3), words(i + 90 * j + 1, 20)) for j in range(2 + i % 3)]
        html = f"<article><p>{words(i, 30)}</p>" + "".join(f"<section><h2>{a}</h2><p>{b}</p></section>" for a, b in parts) + "</article>"
        rows.append((i, f"http://parts.example/{i}", html, " ".join([words(i, 30), *(x for p in parts for x in p)])))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, expected string")
    assert {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()} == {r[0]: r[3] for r in rows}


def test_long_pages_and_few_pages(spark):
    rows = [(1, "http://long.example/1", "<article>" + "".join(f"<p>{words(j, 30)}</p>" for j in range(8000)) + "</article>"), (2, "http://two.example/", page(3)[0])]
    found = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[1] == " ".join(words(j, 30) for j in range(8000))
    assert page(3)[1].split()[0] in found[2] and "Top stories" in found[2]  # one page tells nothing about its host


def test_regions_and_empty_wrappers():
    wrapper = _nodes(fold(["div", "p", "#", "/p", "ul", "li", "#", "/li", "li", "#", "/li", "/ul", "/div", "#"])[0])
    assert regions(wrapper) == [((1,), False), ((1, 5), True), ((), False)]
    assert regions([]) == [] and decide([], {}) == []
    assert json.loads(json.dumps(wrapper)) == wrapper
