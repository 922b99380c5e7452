"""HTML, JSON and binary content on literal rows."""

from html.parser import HTMLParser

from hypothesis import HealthCheck, given, settings, strategies as st

from plenary.functions import html, jsons


def test_bill_content(column):
    block = '<div class="a textType02 b" id="summaryContentDiv">'
    values = [
        f"<html><div>x</div>{block} 제안이유<br> 가나　<b>다</b>라 </div><div>뒤</div></html>",
        f"{block}a<div>b<div>c</div></div>d</div>e",
        f"{block}a<script>var x='</div>';</script><!-- </div> --><style>p</style>b",
        '<div id="summaryContentDiv">a</div>',
        "<p>none</p>",
        f"{block}</div>",
        f"{block}A &amp; B &lt;c&gt; &amp;lt; &#44032;&#xAC01; &nbsp;&middot;&unknown; 5 &lt 6</div>",
        None,
        '<div id="summaryContentDivX" class="textType02">no</div><DIV ID=summaryContentDiv CLASS=textType02>yes</DIV>',
    ]
    assert column(html.bill_content, values) == [
        "제안이유 가나 다 라", "a b c d", "a b", None, None, "", "A & B <c> &lt; 가각 \xa0·&unknown; 5 < 6", None, "yes"]


def test_titles(column):
    values = ['<h3>first</h3><h3 class="bill_title"> [1] <b>법률</b>안 </h3>', "<h3> only </h3>", "<h1>x</h1>"]
    assert column(html.page_title, values) == ["[1]법률안", "only", "의안명 없음"]


def test_file_ids(column):
    good = "12345678-1234-1234-1234-123456789012"
    link = "<a class='x' href=\"javascript:openBillFile('http://f','{}','0')\">pdf</a>"
    values = [link.format("short") + link.format(good) + link.format(good[::-1]), "<a href='#'>none</a>",
              "openBillFile('a','" + good + "','c')", None]
    assert column(html.bill_file_id, values) == [good, None, None, None]


def test_pdf_magic(column):
    assert column(html.is_pdf, [b"%PDF-1.4", b"<html>", b"", None], "binary") == [True, False, False, None]


def test_classification(column):
    values = [
        'ok {"category": "교육정책", "subcategory": "학교", "confidence": 0.9} end',
        '```\n{"category": "교육정책",\n "nested": {"a": 1}}\n```',
        '{"category": "a"} and {"category": "b"}',
        '{"category": ', "none", None, '{"subcategory": "x"}', "{'category': 'a'}",
    ]
    default = ("기타", "일반", 0.5)
    assert [tuple(r) for r in column(jsons.classification, values)] == [
        ("교육정책", "학교", 0.9), ("교육정책", "일반", None), *[default] * 6]


def test_keyword_arrays(column):
    values = ['x ["a", "b","c" ,\n"d", "e"] y', "[1, 2]", '["only"]', None, '[["a"]]', '["a", b]', '["x　"　,"y"]']
    default = ["법안", "개정", "정책", "시행"]
    assert column(jsons.json_strings, values) == [
        ["a", "b", "c", "d"], default, ["only"], default, ["a"], default, default]


def test_subgroups(column):
    values = ['{"groups": [{"name": "a", "bills": [1, 2]}, {"bills": []}]}', "none", '{"x": 1}']
    got = column(jsons.subgroups, values)
    assert [[(g["name"], g["bills"]) for g in v] if v else v for v in got] == [[("a", [1, 2]), (None, [])], None, None]


def test_bill_fields(column):
    values = ['a {"bill_no": "제 2207521 호", "reason": " 이유\\n둘 ", "main": "내용\\r"} b', '{"bill_no": 12}', "broken {", None]
    assert [tuple(r) for r in column(jsons.bill_fields, values)] == [
        ("2207521", "이유 둘", "내용"), ("12", "", ""), ("", "", ""), ("", "", "")]


class Block(HTMLParser):
    """Text nodes of the first content block, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.nodes, self.buffer, self.done, self.hidden = 0, None, "", False, False

    def _flush(self):
        if self.nodes is not None and not self.done and self.buffer.strip():
            self.nodes.append(self.buffer.strip())
        self.buffer = ""

    def handle_starttag(self, tag, attrs):
        self._flush()
        self.hidden = tag in ("script", "style")
        if tag != "div" or self.done:
            return
        attrs = dict(attrs)
        if self.nodes is None and attrs.get("id") == "summaryContentDiv" and "textType02" in attrs.get("class", "").split():
            self.nodes, self.depth = [], 0
        if self.nodes is not None:
            self.depth += 1

    def handle_endtag(self, tag):
        self._flush()
        self.hidden = False
        if tag == "div" and self.nodes is not None:
            self.depth -= 1
            self.done = self.done or self.depth == 0

    def handle_comment(self, data):
        self._flush()

    def handle_data(self, data):
        if not self.hidden:
            self.buffer += data


def parsed_content(page):
    block = Block()
    block.feed(page)
    block.close()
    block._flush()
    return None if block.nodes is None else " ".join(block.nodes)


LEAF = st.sampled_from(["가나", " b ", "\n", "a &amp; b", "x < y", "5 > 3", "<br>", "<br/>", "<!-- </div> -->", "&middot;", "cut &amp<br>",
                        "<script>var t='</div>';</script>", "<style>p{}</style>", "<img alt=\"a > b\">", "　"])
NODES = st.recursive(
    st.lists(LEAF, max_size=4).map("".join),
    lambda inner: st.tuples(st.sampled_from(["div", "p", "b", "span", "DIV"]), st.lists(inner, max_size=3)).map(
        lambda x: f"<{x[0]} class='c'>{''.join(x[1])}</{x[0]}>"),
    max_leaves=8)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(NODES, NODES, NODES), min_size=20, max_size=40))
def test_bill_content_agrees_with_a_parser(column, pages):
    pages = [f"<html><body>{a}<div id='summaryContentDiv' class='x textType02'>{b}</div>{c}</body></html>" for a, b, c in pages]
    assert column(html.bill_content, pages) == [parsed_content(p) for p in pages]
