"""HTML extraction: field rules (nesting, order, white space, absence, letters) on pages
of our own, helpers and parser robustness."""

import random

import pandas as pd
import pytest

from offerlake.operators import html_extract as X
from offerlake.operators.html_extract import Field, Sel, extract_one, parse_html, text_of
from offerlake.sources import pages as P


def details(spark, htmls):
    df = spark.createDataFrame([(f"u{i}", h) for i, h in enumerate(htmls)], "job_url string, html string")
    rows = {r.job_url: r for r in P.detail_fields(df).collect()}
    return [rows[f"u{i}"] for i in range(len(htmls))]


def span(hook, inner, tag="span"):
    return f'<{tag} data-test="{hook}">{inner}</{tag}>'


ONE, TWO = "text-currentLocation1", "text-currentLocation2"


@pytest.mark.parametrize("html,a1,a2", [
    (span(ONE, "Gdynia") + span(TWO, "Plac 7"), "Gdynia", "Plac 7"),
    (span(TWO, "Plac 7") + span(ONE, "Gdynia"), "Gdynia", "Plac 7"),        # order on the page is free
    (f"<div><p>{span(TWO, 'Plac 7')}</p></div>", None, "Plac 7"),            # nested, first one absent
    (span(ONE, "\n  G\u0119si Staw \t"), "G\u0119si Staw", None),
    (span(ONE, "<b>Stary</b> <i>Rynek</i>"), "StaryRynek", None),      # pieces are stripped and joined
    ("<p>nothing of interest</p>", None, None),
    ("", None, None),
])
def test_addresses(spark, html, a1, a2):
    r = details(spark, [html])[0]
    assert (r.address_1, r.address_2) == (a1, a2)


def _single_field_cases(hook):
    return [(span(hook, "alpha"), "alpha"), (f"<main><section>{span(hook, ' beta ')}</section></main>", "beta"),
            (span(hook, "\u017b\u00f3\u0142w (x)"), "\u017b\u00f3\u0142w (x)"),
            (span(hook, "first") + span(hook, "second"), "first"),
            (span(hook, "gamma").replace('"', "'"), "gamma"), ("<p>other</p>", None), ("", None)]


CONTRACT_CASES = _single_field_cases("text-contractName")
LEVEL_CASES = _single_field_cases("content-positionLevels")


def test_contract_type_cases(spark):
    got = [r.contract_type for r in details(spark, [h for h, _ in CONTRACT_CASES])]
    assert got == [e for _, e in CONTRACT_CASES]


def test_job_level_cases(spark):
    got = [r.job_level for r in details(spark, [h for h, _ in LEVEL_CASES])]
    assert got == [e for _, e in LEVEL_CASES]


def test_several_fields_on_one_page(spark):
    html = ('<html><span data-test="text-currentLocation1">Kraków</span>'
            '<span data-test="text-contractName">Contract of employment</span>'
            '<span data-test="content-positionLevels">mid</span></html>')
    r = details(spark, [html])[0]
    assert (r.address_1, r.contract_type, r.job_level) == ("Kraków", "Contract of employment", "mid")


def test_bad_pages_never_fail_the_job(spark):
    rows = details(spark, [None, "<<<>>>&&&", "<span data-test=", "\x00\x01"])
    for r in rows:
        assert r.address_1 is None and r.contract_type is None and r.job_level is None
        assert list(r.expected_technologies) == [] and list(r.requirements) == []


def test_dates_after_first_colon(spark):
    html = ('<span data-test="text-expirationDate">Ważna do: <b>12 grudnia 2025</b></span>'
            '<span data-test="text-fromDate">5 maja 2025</span>')
    r = details(spark, [html, '<span data-test="text-expirationDate">a: b: c</span>'])
    assert (r[0].expiration_date, r[0].job_posting_date) == ("12 grudnia 2025", "5 maja 2025")
    assert r[1].expiration_date == "b: c" and r[1].job_posting_date is None


def test_salary_span_gates_units(spark):
    with_salary = ('<span data-test="text-contractSalary">20 000 - 23 500</span>'
                   '<span data-test="text-contractUnits">net</span>'
                   '<span data-test="text-contractTimeUnits">mth</span>')
    no_salary = ('<span data-test="text-contractUnits">net</span>'
                 '<span data-test="text-contractTimeUnits">mth</span>')
    a, b = details(spark, [with_salary, no_salary])
    assert (a.remuneration, a.gross_or_net, a.frequency) == ("20 000 - 23 500", "net", "mth")
    assert (b.remuneration, b.gross_or_net, b.frequency) == (None, None, None)


def test_technologies_title_then_text(spark):
    html = ('<div data-test="chip-technology" title="Outside">x</div>'
            '<div data-test="section-technologies">'
            '<div data-test="chip-technology" title="SQL"><img src="a"></div>'
            '<div data-test="chip-technology" title=""><span> Python </span></div>'
            '<div data-test="chip-technology"></div>'
            '<div data-test="chip-technology" title="SQL">ignored text</div></div>')
    r = details(spark, [html, "<div>no section</div>"])
    assert list(r[0].expected_technologies) == ["SQL", "Python", "SQL"]
    assert list(r[1].expected_technologies) == []


def test_requirements_expected_list_only(spark):
    html = ('<div data-test="section-requirements">'
            '<ul data-test="section-requirements-expected"><li class="lxul5ps a">SQL</li>'
            '<li class="other">skip</li><li class="lxul5ps"> </li><li class="lxul5ps">Python <b>3</b></li></ul>'
            '<ul data-test="section-requirements-optional"><li class="lxul5ps">Nice</li></ul></div>'
            '<div data-test="section-responsibilities"><ul><li class="lxul5ps">Build</li>'
            '<li class="lxul5ps">Test</li></ul></div>')
    r = details(spark, [html])[0]
    assert list(r.requirements) == ["SQL", "Python3"]
    assert list(r.responsibilities) == ["Build", "Test"]


def test_listing_cards(spark):
    html = ('<a data-test="list-item-offer" href="/praca/a,oferta,12345678-abcd-ef01-2345-6789abcdef01">'
            '<div class="p17ye701 x"><h2 data-test="text-jobTitle"> Analyst </h2>'
            '<div data-test="text-employerName">ACME</div><div data-test="text-workplaces">Kraków</div>'
            '<div data-test="text-workModes">zdalna</div></div></a>'
            '<a data-test="list-item-offer" href="https://x/promo"><div class="ad">Promoted</div></a>'
            '<a data-test="list-item-offer" href="https://site/b"><div class="p17ye701"></div></a>')
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    cards = sorted(P.listing_cards(df).collect(), key=lambda r: r.job_url)
    assert len(cards) == 2
    a = [c for c in cards if c.job_url.startswith("https://theprotocol.it")][0]
    assert a.job_listing_id == "12345678-abcd-ef01-2345-6789abcdef01"
    assert (a.job_title, a.company_name, a.location, a.work_mode) == ("Analyst", "ACME", "Kraków", "zdalna")
    b = [c for c in cards if c.job_url == "https://site/b"][0]
    assert b.job_listing_id is None and b.job_title is None


def test_assemble_keeps_cards_without_detail(spark):
    cards = spark.createDataFrame([("id1", "u1", "T", "C", "L", "W"), ("id2", "u2", "T2", "C2", None, None)],
                                  "job_listing_id string, job_url string, job_title string, company_name string, "
                                  "location string, work_mode string")
    det = P.detail_fields(spark.createDataFrame(
        [("u1", '<span data-test="content-positionLevels">mid</span><div data-test="section-technologies">'
                '<div data-test="chip-technology" title="SQL"></div><div data-test="chip-technology" title="R">'
                '</div></div>')], "job_url string, html string"))
    out = {r.job_url: r for r in P.assemble_listings(cards, det, "2025-01-01 00:00:00", "2025-01-01").collect()}
    assert out["u1"].job_level == "mid" and out["u1"].expected_technologies == "SQL, R"
    assert out["u2"].job_level is None and out["u2"].expected_technologies == ""
    assert out["u2"].ingestion_date == "2025-01-01"


def test_parser_robustness():
    html = ('<html><head><script>var t="</p><span data-test=\\"x\\">no</span>";</script>'
            '<style>p{}</style></head><body><!-- <span data-test="x">comment</span> -->'
            '<p><b>one<br>two<p>three &amp; four</p></b><span data-test="x">yes</span></body></html>')
    root = parse_html(html)
    assert text_of(root) == "onetwothree & fouryes"
    assert extract_one(html, (Field("x", (Sel("span", "data-test", "x"),)),)) == {"x": "yes"}
    br = [c for c in parse_html("<br>a<br/>b").children]
    assert br[0].children == [] and br[1] == "a"


def test_text_nodes_merge_like_one_string():
    # a stray '<' arrives as separate data events but is one text node
    assert text_of(parse_html("<p> a < b </p>")) == "a < b"
    # a comment splits the text into two nodes, each stripped
    assert text_of(parse_html("<p>a <!-- c -->  b</p>")) == "ab"
    assert text_of(parse_html("<p>x &amp; y</p>")) == "x & y"


def test_character_references():
    cases = {
        "<p>x &amp; y</p>": "x & y",
        "<p>a&amp<b>c</b></p>": "a&c",
        "<p>t&am</p>": "t&am",
        "<p>&ampx</p>": "&ampx",
        "<p>&#147;q&#148; &#x41;&#65;</p>": "\u201cq\u201d AA",
        "<p>&copy; &middot;</p>": "\u00a9 \u00b7",
    }
    for html_text, want in cases.items():
        assert text_of(parse_html(html_text)) == want, html_text


REGULAR = [
    "", "text", "a &amp; b & c &copy; &#147;&#x41; AT&T x<p>y", '<!DOCTYPE html><p class="lxul5ps z">a<!-- c --> b</p>',
    '<script>var t = "</span><b>";</script><SPAN Data-Test="x" data-test=y hidden>t</span></i><br/>z<img src="a>b">',
    "<div><p title='&lt;q&gt;'>one<p>two</div>three</p><style>p < q</STYLE><ul><li>1<li>2</ul>",
]
IRREGULAR = ["<a href=b/>x</a>", "<p>&amp<b>c</b></p>", "<script>x", "<p", "<a b = 'c'>x</a>", "<!-- a -- b -->c", "</ p>x", "<?pi?>x"]


def _tree_elements(root):
    left, out = [root], []
    while left:
        el = left.pop()
        out.append((el.pre, el.post, el.tag, el.attrs, text_of(el)))
        left += [c for c in reversed(el.children) if isinstance(c, X.Element)]
    return out


def _flat_elements(root):
    tag_of = {0: "[document]"} | {n: t for t, ns in root.page.index.items() for n in ns}
    nodes = [X.Node(root.page, n) for n in range(len(root.page.attrs))]
    return [(e.n, e.page.post[e.n], tag_of[e.n], e.attrs, text_of(e)) for e in nodes]


def test_regular_pages_need_no_tree():
    for html in REGULAR:
        root = X.parse_page(html)
        assert isinstance(root, X.Node), html
        assert _flat_elements(root) == _tree_elements(parse_html(html)), html
    for html in IRREGULAR:
        assert isinstance(X.parse_page(html), X.Element), html


def test_random_markup_reads_as_the_tree_does():
    pieces = [*REGULAR, *IRREGULAR, "<p>", "</p>", "<b x='1' X=\"2\">", "</b>", " & ", "&#12;", "&T ", "<br>", "<", ">", '"', "<SCRIPT/>",
              "</script >", "<!-->", "<!--x-->", "<li class=a>", "\x1f", "\x0b", "<x-y:z.q>", "</x-y:z.q>", "<a b=\"1\"c=2>"]
    rng = random.Random(7)
    flat = 0
    for _ in range(5000):
        html = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 6)))
        root = X.parse_page(html)
        if isinstance(root, X.Node):
            flat += 1
            assert _flat_elements(root) == _tree_elements(parse_html(html)), html
    assert flat > 500


def test_values_of_few_pages_are_held_at_a_time():
    pages = ["x" * 1000] * 10_000 + [None, "y" * (X.SLICE_BYTES + 1), ""]
    pdf = pd.DataFrame({"id": range(len(pages)), "html": pages})
    parts = list(X._slices(pdf, "html"))
    assert pd.concat(parts).equals(pdf)
    assert all(len(p) <= X.SLICE_ROWS for p in parts)
    assert all(len(p) == 1 or sum(len(v or "") for v in p["html"]) <= X.SLICE_BYTES for p in parts)
    wide = pd.DataFrame({"html": ["z" * 1_000_000] * 9})
    assert [len(p) for p in X._slices(wide, "html")] == [4, 4, 1]
    assert list(X._slices(pdf.iloc[:0], "html")) == []
