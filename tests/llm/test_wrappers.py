import pytest

from patchlode.llm.wrappers import _nodes, align, extract_main_text, fold, main_text, slot_numbers


def test_folding_and_alignment():
    pattern, slots = fold(["ul", "li", "#", "/li", "li", "#", "/li", "li", "#", "/li", "/ul", "p", "#", "/p"])
    assert pattern == ("ul", ("li", "#", "/li"), "/ul", "p", "#", "/p") and slots == [[0, 1, 2], [3]]
    assert fold([]) == ((), [])
    one, two = _nodes(("h1", "#", "/h1", "p", "#", "/p")), _nodes(("h1", "#", "/h1", "div ad", "#", "/div ad", ("p", "#", "/p")))
    wrapper = align(align([], one), two)
    optional = [n[0] for n in wrapper if n[2]]
    assert "div ad" in optional and wrapper[:3] == [["h1", False, True]] + wrapper[1:3]
    assert None not in slot_numbers(wrapper, one) and None not in slot_numbers(wrapper, two)


@pytest.mark.parametrize("page, text", [
    ("", ""),
    ("plain &amp; simple\n text", "plain & simple text"),
    ("<p>one<b>two</b>&nbsp;three<br>four</p><p>  </p><p>five", "onetwo three four five"),
    ("<body><div class='cookie-notice'>c</div><main><h1>T</h1><p>x</p><aside>no</aside></main><p>out</p>", "T x"),
    ("<article><header><h1>Head</h1><span>meta</span></header><p>a<script>if (a<b) {'</p>'}</script></p><section class=comments>no</section></article>", "Head a"),
    ("<div><p>kept</p><form>f<input></form><style>p{}</style><!-- <p>no</p> --><nav>n</nav></div><footer>f</footer", "kept"),
    ("<p title='a>b'>x</p><p title=\"open>y</p> 1 < 2 <", "x y 1 < 2 <"),
    ("<div hidden>h</div><div style='display: none'>h</div><p>v</p>", "v"),
])
def test_single_pages(page, text):
    assert main_text(page, None, set(), {}, "h") == text


def test_hosts(spark):
    story = lambda i: f"<p>Story {i} goes on</p>" * (1 + i % 3)
    page = "<html><body><div id=top>Fixed line</div><ul>{}</ul><div id=text>{}</div></body></html>"
    links = "<li><a href=x>go there</a></li>"
    rows = [(i, f"http://A.example/{i}", page.format(links * (1 + i % 4), story(i)), 1, "w") for i in range(30)]
    rows += [(100, None, "<p>no host</p>", 1, "w"), (101, "nonsense", None, 1, "w"), (None, "http://b/", "<article>lone é</article>", 1, "w"), (0, rows[0][1], rows[0][2], 1, "w")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host int, wrapper string").repartition(6)
    found = [tuple(r) for r in extract_main_text(pages).collect()]
    plain = lambda i: " ".join([f"Story {i} goes on"] * (1 + i % 3))
    expected = [(i, f"http://A.example/{i}", plain(i)) for i in [*range(30), 0]]
    expected += [(100, None, "no host"), (101, "nonsense", ""), (None, "http://b/", "lone é")]
    assert sorted(found, key=str) == sorted([(*e, len(e[2])) for e in expected], key=str)
    assert extract_main_text(pages.limit(0)).count() == 0
