"""Element text and links from HTML held in a string column, with Spark expressions only."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from plenary.functions.lexicon import DEFAULT_TITLE
from plenary.functions.text import is_uuid_shaped, strip

_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
# A tag begins with a letter right after `<` or `</`; a `>` inside a quoted attribute does not end it.
_TAG = r"""</?[A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</?[A-Za-z][^>]*>|<[!?][^>]*>"""
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*+);?"


def _code_point(c: Column) -> Column:
    """The character of a code point; null outside the Unicode range."""
    valid = (c > 0) & (c < 0x110000) & ~c.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32"))


def _decode_reference(ref: Column) -> Column:
    named = F.create_map(*(x for name, code in sorted(name2codepoint.items())
                           for x in (F.lit(name), F.lit(chr(code)))))
    body = F.regexp_replace(ref, "^&|;$", "")
    number = F.when(
        body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 8), 16, 10)
    ).otherwise(F.regexp_extract(body, "^#([0-9]+)$", 1))
    numeric = _code_point(number.try_cast("bigint"))
    return F.coalesce(F.when(body.startswith("#"), numeric).otherwise(F.try_element_at(named, body)), ref)


def unescape(c: Column) -> Column:
    """Character references decoded in a single pass, so `&amp;lt;` gives `&lt;`.

    The closing semicolon is optional, as for a lenient HTML reader; unknown names stay as they are.
    """
    between = F.split(c, _REFERENCE)
    found = F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0))
    decoded = F.zip_with(
        between, found, lambda text, ref: F.concat(text, F.coalesce(_decode_reference(ref), F.lit("")))
    )
    return F.when(c.rlike(_REFERENCE), F.array_join(decoded, "")).otherwise(c)


def visible(html: Column) -> Column:
    """HTML with comments, scripts and styles as a bare tag: text on either side stays apart."""
    return F.regexp_replace(html, _HIDDEN, "<br>")


def inner_html(html: Column, tag: str, start_tag: str) -> Column:
    """Content of the first element whose start tag matches, up to its own end tag; null without one.

    Nested elements of the same name are balanced: the element ends at the first end tag where as
    many have closed as have opened.
    """
    rest = F.regexp_extract(html, f"(?is){start_tag}(.*)\\z", 1)
    pieces = F.split(rest, f"(?i)</{tag}\\s*>")
    opened = F.transform(pieces, lambda p: F.regexp_count(p, F.lit(f"(?i)<{tag}\\b")))
    # After n pieces, n end tags have been met; the element closes where as many have opened.
    start = F.struct(F.lit(1).alias("open"), F.lit(0).alias("seen"), F.lit(0).alias("end"))
    walk = F.aggregate(
        opened,
        start,
        lambda acc, nested: F.struct(
            (acc["open"] + nested).alias("open"),
            (acc["seen"] + 1).alias("seen"),
            F.when((acc["end"] == 0) & (acc["open"] + nested == acc["seen"] + 1), acc["seen"] + 1)
            .otherwise(acc["end"]).alias("end"),
        ),
        lambda acc: F.when(acc["end"] > 0, acc["end"]).otherwise(acc["seen"]),
    )
    balanced = F.array_join(F.slice(pieces, 1, walk), f"</{tag}>")
    simple = F.regexp_extract(html, f"(?is){start_tag}(.*?)(?:</{tag}\\s*>|\\z)", 1)
    return F.when(
        html.rlike(f"(?is){start_tag}"),
        F.when(simple.rlike(f"(?i)<{tag}\\b"), balanced).otherwise(simple),
    )


def inner_text(fragment: Column, separator: str = " ") -> Column:
    """Text nodes stripped, empty ones dropped, joined by the separator."""
    nodes = F.transform(F.split(fragment, _TAG), lambda node: strip(unescape(node)))
    return F.array_join(F.filter(nodes, lambda node: node != ""), separator)


def _start_tag(tag: str, *needs: str) -> str:
    return f"<{tag}\\b" + "".join(f"(?=[^>]*\\b{need})" for need in needs) + "[^>]*>"


def _has_class(name: str) -> str:
    return rf"class\s*=\s*[\"']?(?:[^\"'>]*\s)?{name}(?=[\s\"'>])"


def element_text(html: Column, tag: str, element_id: str | None = None,
                 css_class: str | None = None, separator: str = " ") -> Column:
    """Text of the first element of a tag, optionally with an id and a class; null if absent."""
    needs = []
    if element_id:
        needs.append(rf"id\s*=\s*[\"']?{element_id}(?=[\s\"'>])")
    if css_class:
        needs.append(_has_class(css_class))
    return inner_text(inner_html(visible(html), tag, _start_tag(tag, *needs)), separator)


def bill_content(html: Column) -> Column:
    """The bill page's reason-and-content block; null when the page lacks it."""
    return element_text(html, "div", "summaryContentDiv", "textType02")


def page_title(html: Column, tag: str = "h3", css_class: str = "bill_title",
               default: str = DEFAULT_TITLE) -> Column:
    """The classed heading, else the first heading, else a default."""
    return F.coalesce(
        element_text(html, tag, css_class=css_class, separator=""),
        element_text(html, tag, separator=""),
        F.lit(default),
    )


def bill_file_id(html: Column) -> Column:
    """Id of the first `openBillFile('..','id','..')` link whose id is UUID-shaped."""
    ids = F.regexp_extract_all(
        html,
        F.lit(r"(?i)<a\b[^>]*?\bhref\s*=\s*\"?[^\">]*?openBillFile\('([^']+)','([^']+)','[^']+'\)"),
        F.lit(2),
    )
    return F.get(F.filter(ids, is_uuid_shaped), F.lit(0))


def is_pdf(content: Column) -> Column:
    """Binary content that starts with the PDF magic number."""
    return F.startswith(content, F.lit(b"%PDF"))
