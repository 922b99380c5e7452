"""Text cleaning and key repair as Column -> Column functions.

White space, digits and word boundaries follow Python's Unicode rules, spelled out as character
classes so that the result does not depend on the JVM's regex flags.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from plenary.functions import lexicon

# Every character Python counts as white space.
SPACE_CHARS = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())
SPACE = r"[\t-\r\x1c- \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# The intersections let the regex engine pass over printable ASCII with a single range test.
_ODD_SPACE = f"[[\\x00-\\x1f\\x7f-\\x{{10ffff}}]&&{SPACE}]"
# A run that starts with an odd space, or a blank with more space behind it: a single blank between
# words is already right and needs no rewrite.
_UNTIDY_SPACE = f"{_ODD_SPACE}{SPACE}*| {SPACE}+"
# Zero-width characters, byte-order mark, no-break space and line controls.
_CONTROL = r"[[\x00-\x1f\x80-\x{10ffff}]&&[\x{200b}\x{200c}\x{200d}\x{feff}\xa0\r\n\t]]"
_WORD = r"[\p{L}\p{N}_]"
_BOUNDARY = f"(?:(?<!{_WORD})(?={_WORD})|(?<={_WORD})(?!{_WORD}))"
_JAVA_CLASSES = {r"\s": SPACE, r"\d": r"\p{Nd}", r"\b": _BOUNDARY}


def java_regex(pattern: str) -> str:
    r"""A Python pattern with its \s, \d and \b replaced by explicit Unicode classes."""
    return re.sub(r"\\[sdb]", lambda m: _JAVA_CLASSES[m.group()], pattern)


def any_of(patterns: Sequence[str], starters: str | None = None) -> str:
    """One alternation in the given order.

    `starters` lists the characters a match can begin with, as the inside of a character class; where
    every pattern begins with a plain character they are read off the patterns. Positions that cannot
    start a match are then passed over without trying each alternative.
    """
    choice = "|".join(java_regex(p) for p in patterns)
    if starters is None:
        if not all(re.match(r"[^\\\[(.^$|?*+{](?![?*{])", p) for p in patterns):
            return choice
        starters = re.sub(r"([\[\]\\^&-])", r"\\\1", "".join(sorted({p[0] for p in patterns})))
    ascii_part = re.sub(r"\\p\{Nd\}", "0-9", starters)
    ascii_part = "".join(c for c in ascii_part if c.isascii())
    return f"(?=[{ascii_part}\\x{{80}}-\\x{{10ffff}}])(?=[{starters}])(?:{choice})"


def strip(c: Column, chars: str = SPACE_CHARS) -> Column:
    return F.btrim(c, F.lit(chars))


def squeeze(c: Column) -> Column:
    """Each run of white space becomes one blank."""
    return F.regexp_replace(c, _UNTIDY_SPACE, " ")


def tidy(c: Column) -> Column:
    return strip(squeeze(c))


def clean_text(c: Column, headings: Sequence[str] = lexicon.HEADINGS) -> Column:
    """Control characters, outer quotes, commas and section headings removed; null stays null."""
    plain = F.regexp_replace(c, _CONTROL, " ")
    plain = F.replace(strip(strip(plain, '"')), F.lit(","), F.lit(" "))
    without = plain
    for heading in sorted(headings, key=len, reverse=True):
        without = F.regexp_replace(without, java_regex(heading), "")
    if headings:
        # Most texts hold no heading: one test then replaces the whole chain of passes.
        without = F.when(plain.rlike(any_of(headings)), without).otherwise(plain)
    return tidy(without)


def remove_law_patterns(c: Column, patterns: Sequence[str] = lexicon.LAW_PATTERNS,
                        starters: str | None = lexicon.LAW_STARTERS) -> Column:
    """One alternation, so an earlier pattern wins over a later one at the same position."""
    return tidy(F.regexp_replace(F.coalesce(c, F.lit("")), any_of(patterns, starters), " "))


def split_compounds(c: Column, compounds: Sequence[tuple[str, str]] = lexicon.COMPOUNDS) -> Column:
    dotless = F.regexp_replace(F.coalesce(c, F.lit("")), "[·？]", " ")
    spaced = dotless
    for pattern, replacement in compounds:
        spaced = F.regexp_replace(spaced, java_regex(pattern), replacement)
    if compounds:
        spaced = F.when(dotless.rlike(any_of([p for p, _ in compounds])), spaced).otherwise(dotless)
    return tidy(spaced)


def blank_markers_to_empty(c: Column, markers: Sequence[str] = ("nan", "None")) -> Column:
    """Null and whole-value markers become the empty string."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(text.isin(*markers), F.lit("")).otherwise(text)


def preprocess(c: Column) -> Column:
    """Statute references out, then compounds apart; blank text gives the empty string."""
    return split_compounds(remove_law_patterns(blank_markers_to_empty(c)))


def drop_stop_words(c: Column, stop: Sequence[str], preserve: Sequence[str] = (), phrases: Sequence[str] = ()) -> Column:
    """Blank-separated tokens without the caller's stop words and phrases; preserved words stay."""
    dropped = sorted(set(stop) - set(preserve))
    text = tidy(c)
    if phrases:
        text = F.regexp_replace(
            text, "(?<![^ ])(?:" + "|".join(re.escape(p) for p in phrases) + ")(?![^ ])", " "
        )
    kept = F.filter(F.split(text, " "), lambda t: (t != "") & ~t.isin(dropped))
    return F.array_join(kept, " ")


def convert_to_sentence(c: Column) -> Column:
    """Bullet characters out, and the closing form the summaries share."""
    text = strip(F.regexp_replace(c, "[→·|,]", ""))
    return F.regexp_replace(text, r"(?<![함요])\z", "함")


def clean_slogan(c: Column, label: str = lexicon.SLOGAN_LABEL) -> Column:
    text = strip(F.replace(F.replace(strip(c), F.lit("**"), F.lit("")), F.lit(label), F.lit("")))
    return strip(F.substring_index(text, "\n", 1))


# Join keys are inlined into the null filters Spark derives from a join, so the functions that make
# keys name their input once.


def split_title(c: Column) -> Column:
    """`[number] text` as a struct(bill_number, title); text without `]` has an empty number."""
    number = strip(F.regexp_extract(c, r"(?s)^([^\]]*)\]", 1), "[] ")
    title = F.regexp_replace(c, rf"(?s)^[^\]]*\]{SPACE}*(.*?){SPACE}*\z", "$1")
    return F.struct(F.coalesce(number, F.lit("")).alias("bill_number"), title.alias("title"))


def zero_fill(c: Column, width: int) -> Column:
    """Zeros to the left up to `width`, after a leading sign; longer text is not cut."""
    padded = F.regexp_replace(c.cast("string"), r"^([+-]?)", "$1" + "0" * width)
    surplus = rf"(?s)^(?:([+-])0{{0,{width}}}(?=.{{{width - 1},}}\z)|0{{0,{width}}}(?=.{{{width},}}\z))"
    return F.regexp_replace(padded, surplus, "$1")


def last4_key(c: Column) -> Column:
    return zero_fill(F.substring(c, -4, 4), 4)


def join_nullable(*columns: Column) -> Column:
    """Nullable texts with a blank between them, outer white space removed."""
    blank = F.lit("")
    return strip(F.concat_ws(" ", *(F.coalesce(c, blank) for c in columns)))


def format_keywords(c: Column) -> Column:
    text = F.regexp_replace(F.translate(c, "()", "  "), java_regex(r"^\s*\d+\s*"), "")
    text = strip(squeeze(strip(F.translate(text, '"', ""))), " ,")
    return F.coalesce(F.concat(F.lit("["), text, F.lit("]")), F.lit("[]"))


def repair_commas(line: Column, fields: int = 5) -> Column:
    """Commas beyond the last field separator removed; lines with fewer fields untouched."""
    parts = F.split(line, ",", fields)
    repaired = F.concat_ws(",", F.slice(parts, 1, fields - 1), F.translate(parts[fields - 1], ",", ""))
    return F.when(F.size(parts) == fields, repaired).otherwise(line)


def split_url_cell(c: Column) -> Column:
    """`url,text` cells as struct(url, content); a plain url has a null content."""
    parts = F.split(c, ",", 2)
    both = F.struct(strip(parts[0]).alias("url"), clean_text(parts[1]).alias("content"))
    only = F.struct(c.alias("url"), F.lit(None).cast("string").alias("content"))
    return F.when(c.contains(","), both).otherwise(only)


def query_param(url: Column, name: str) -> Column:
    """First non-blank value of a URL query parameter, decoded; the empty string without one."""
    query = F.concat(F.lit("&"), F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1))
    raw = F.regexp_extract(query, f"&{re.escape(name)}=([^&]+)", 1)
    return F.coalesce(F.try_url_decode(raw), F.translate(raw, "+", " "), F.lit(""))


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"\P{Nd}+", "")


def flatten_lines(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"[\r\n]", " "))


def names(c: Column, part: str) -> Column:
    """Whether a text holds a name; false for null."""
    return F.coalesce(c.contains(part), F.lit(False))


def split_district(c: Column, proportional: str = lexicon.PROPORTIONAL_SEAT,
                   special: str = lexicon.SEJONG, special_name: str = lexicon.SEJONG_SHORT) -> Column:
    """struct(sido, sgg) cut at the first blank; null for proportional seats and unspaced names."""
    parts = F.split(c, " ", 2)
    usable = ~names(c, proportional) & (F.size(parts) == 2)
    is_special = names(c, special)
    return F.struct(
        F.when(is_special, F.lit(special_name)).when(usable, F.get(parts, 0)).alias("sido"),
        F.when(is_special, c).when(usable, F.get(parts, 1)).alias("sgg"),
    )


def join_list(c: Column, default: str = ", ".join(lexicon.DEFAULT_KEYWORDS)) -> Column:
    return F.coalesce(F.nullif(F.array_join(c, ", "), F.lit("")), F.lit(default))


def is_uuid_shaped(c: Column) -> Column:
    return (F.length(c) == 36) & (F.length(F.translate(c, "-", "")) == 32)


def first_sentence(c: Column) -> Column:
    """Text up to the first full stop, exclamation or question mark that ends a sentence."""
    text = tidy(c)
    return F.coalesce(F.nullif(F.regexp_extract(text, r"^(.*?[.!?。])(?: |\z)", 1), F.lit("")), text)
