"""SQL spellings shared by the oracles (DuckDB dialect, RE2 patterns)."""

from __future__ import annotations

# Python's white space, once as a character class and once as a list of characters.
CHARS = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())
SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in CHARS) + "]"


def strip(x: str, chars: str = CHARS) -> str:
    return f"trim({x}, '" + chars.replace("'", "''") + "')"


def tidy(x: str) -> str:
    return strip(f"regexp_replace({x}, '{SPACE}+', ' ', 'g')")


def content_clean(x: str, headings=()) -> str:
    """Control characters, quotes, commas and the given headings out, longest heading first."""
    controls = "".join(map(chr, (0x200B, 0x200C, 0x200D, 0xFEFF, 0xA0, 13, 10, 9)))
    text = f"translate({x}, '{controls}', '{' ' * len(controls)}')"
    text = "replace(" + strip(strip(text, '"')) + ", ',', ' ')"
    for h in sorted(headings, key=len, reverse=True):
        text = f"regexp_replace({text}, '" + h.replace("\\s", SPACE) + "', '', 'g')"
    return tidy(text)


def article_text(html: str, tag: str = "article", separator: str = " ") -> str:
    """Text nodes of the first element of a tag, for pages without nested elements of that tag.

    References may lack their semicolon, as in headings cut short.
    """
    plain = f"regexp_replace({html}, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>', '', 'g')"
    inner = f"regexp_extract({plain}, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}>', 1)"
    decoded = "n"
    for ref, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        decoded = f"regexp_replace({decoded}, '&{ref};?', '{char}', 'g')"
    nodes = f"list_transform(string_split_regex({inner}, '<[^>]*>'), lambda n: {strip(decoded)})"
    return f"array_to_string(list_filter({nodes}, lambda n: n <> ''), '{separator}')"
