"""Scalar operators as Column builders: all built-in expressions, so that they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that are no keywords, in the order of their kinds.
STOP_WORDS = (
    "the a an is are was were be been being have has had do does did will would could should may might must shall can need "
    "to of in for on with at by from as into through during before after above below between under "
    "and or but if then else when where why how this that these those it its they them their which who whom what each all both any some"
).split()
# Access codes by what they mean; other codes are kept in lower case.
ACCESS = {
    "read-write": ("RW", "R/W", "READ-WRITE"), "read-only": ("RO", "R", "READ-ONLY"), "write-only": ("WO", "W", "WRITE-ONLY"),
    "read-only-clear": ("ROC",), "read-write-1-clear": ("RW1C",), "write-1-clear": ("W1C",), "reserved": ("RSVD",),
}


def norm_offset(c: Column) -> Column:
    """'0x28', '28h' or '028' as '028': upper case, at least three digits; longer ones stay whole."""
    u = F.regexp_replace(F.regexp_replace(F.upper(F.trim(c)), "^0X", ""), "H$", "")
    return F.lpad(u, F.greatest(F.length(u), F.lit(3)), F.lit("0"))


def format_offset(c: Column) -> Column:
    return F.concat(norm_offset(c), F.lit("h"))


def offset_int(c: Column) -> Column:
    """The offset as a number; null if it is not hexadecimal."""
    n = norm_offset(c)
    return F.when(n.rlike("^[0-9A-F]+$"), F.conv(n, 16, 10).cast("bigint"))


def section_key(c: Column) -> Column:
    """Dotted number as integers; a part that is no number counts as 0."""
    return F.transform(F.split(c, r"\."), lambda x: F.coalesce(F.when(x.rlike("^[0-9]+$"), x.try_cast("int")), F.lit(0)))


def appendix_key(c: Column, width: int = 10) -> Column:
    """Sort key with appendices after the numbers: 1000 and the letter's code, padded with zeros."""
    bare = F.regexp_replace(c, "^Appendix_", "")
    letter = bare.rlike("^[A-Z]")
    rest = F.filter(section_key(F.regexp_replace(bare, r"^[A-Z]\.?", "")), lambda x: x > 0)
    key = F.when(letter, F.concat(F.array(F.lit(1000), F.ascii(bare)), rest)).otherwise(section_key(bare))
    return F.concat(key, F.array_repeat(F.lit(0), F.greatest(F.lit(width) - F.size(key), F.lit(0)).cast("int")))


def section_id(c: Column) -> Column:
    return F.concat(F.lit("SEC_"), F.replace(F.regexp_replace(c, "^Appendix_", ""), F.lit("."), F.lit("_")))


def section_number(c: Column) -> Column:
    return F.replace(F.regexp_replace(c, "^SEC_", ""), F.lit("_"), F.lit("."))


def section_level(c: Column) -> Column:
    return F.size(F.split(c, r"\."))


def parent_section(c: Column) -> Column:
    """The section above; a letter's sub-section belongs to its appendix; null at the top."""
    return F.when(c.rlike(r"^[A-Z]\.[0-9]"), F.concat(F.lit("Appendix_"), F.left(c, F.lit(1)))).when(F.contains(c, F.lit(".")), F.regexp_replace(c, r"\.[^.]*$", ""))


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def count_words(c: Column) -> Column:
    return F.size(words(c))


#: A word of three letters or more that is no stop word, whole: not inside a longer run of word characters.
KEYWORD = r"(?<![\p{L}\p{N}\p{M}_])(?!(?:" + "|".join(STOP_WORDS) + r")(?![\p{L}\p{N}\p{M}_]))[a-z][a-z0-9_]{2,}+(?![\p{L}\p{N}\p{M}_])"


def keywords(c: Column, limit: int = 20) -> Column:
    """The first different words of three letters or more that are no stop words, in order; one pattern finds them."""
    return F.slice(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(KEYWORD), 0)), 1, limit)


def technical_terms(c: Column, limit: int = 15) -> Column:
    """Acronyms, hexadecimal numbers and bit ranges, in order of first occurrence by kind. The three patterns are fixed values."""
    acronyms = F.regexp_extract_all(c, F.lit(r"\b[A-Z]{2,}[0-9]*\b"), 0)
    numbers = F.filter(F.regexp_extract_all(c, F.lit(r"\b(?:0x)?[0-9A-Fa-f]+h?\b"), 0), lambda x: F.length(x) >= 2)
    bits = F.regexp_extract_all(c, F.lit(r"(?i)\b(?:D\d+-D\d+|bits?\s*\d+(?::\d+)?)\b"), 0)
    return F.slice(F.array_distinct(F.concat(acronyms, numbers, bits)), 1, limit)


def references(c: Column, word: str = "Table", prefix: str = "TABLE_", single: bool = False) -> Column:
    """Ids of mentions such as 'Table 2-5', duplicates kept; single: plain numbers where there is no such mention."""
    pairs = F.transform(F.regexp_extract_all(c, F.lit(rf"(?i){word}\s+\d+-\d+"), 0), lambda m: F.concat(F.lit(prefix), F.replace(F.regexp_extract(m, r"(\d+-\d+)$", 1), F.lit("-"), F.lit("_"))))
    if not single:
        return pairs
    plain = F.transform(F.regexp_extract_all(c, F.lit(rf"(?i){word}\s+\d+"), 0), lambda m: F.concat(F.lit(prefix), F.regexp_extract(m, r"(\d+)$", 1)))
    return F.when(F.size(pairs) > 0, pairs).otherwise(plain)


def section_references(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(r"(?i)Section\s+\d+(?:\.\d+)*"), 0), lambda m: F.regexp_extract(m, r"([\d.]+)$", 1))


def register_of_title(c: Column) -> Column:
    """{name, offset} of 'X Register (Offset 028h)'; null if the title is none. The pattern is a fixed value."""
    pattern = r"(?i)(.+?)\s+Register\s*\(Offset\s*([0-9A-Fa-f]+)h?\)"
    return F.when(c.rlike(pattern), F.struct(F.regexp_extract(c, pattern, 1).alias("name"), F.upper(F.regexp_extract(c, pattern, 2)).alias("offset")))


def clean_text(c: Column, noise: tuple[str, ...] = ()) -> Column:
    """Text without lines that match a pattern (headers, copyright), runs of blank lines and of spaces cut to two and one."""
    for pattern in noise:
        c = F.regexp_replace(c, rf"(?im)^[^\n]*(?:{pattern})[^\n]*$", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r" {2,}", " "), r"^\s+|\s+$", "")


def strip_fences(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"^```[^\n]*\n", ""), r"\n```\s*$", "")


def bit_range(c: Column, brackets: bool = True) -> Column:
    """{high, low, width} of '07-04', '7:4', '[127:120]' or '15'; zeros if it is none of them."""
    t = F.regexp_replace(F.trim(c), r"^\[|\]$", "") if brackets else F.trim(c)
    pair, one = r"^(\d+)\s*[-:]\s*(\d+)", r"^\d+$"
    high = F.when(t.rlike(pair), F.regexp_extract(t, pair, 1)).when(t.rlike(one), t).try_cast("int")
    low = F.when(t.rlike(pair), F.regexp_extract(t, pair, 2)).when(t.rlike(one), t).try_cast("int")
    return F.struct(F.coalesce(high, F.lit(0)).alias("high"), F.coalesce(low, F.lit(0)).alias("low"), F.coalesce(high - low + 1, F.lit(0)).alias("width"))


def access(c: Column) -> Column:
    code, found = F.upper(F.trim(c)), F.lower(F.trim(c))
    for meaning, codes in ACCESS.items():
        found = F.when(code.isin(*codes), meaning).otherwise(found)
    return found


def first_rule(c: Column, rules: list[tuple[str, str]], default: str = "OTHER") -> Column:
    """The type of the first rule (pattern, type) that matches the lower-cased text."""
    return F.coalesce(*[F.when(F.lower(c).rlike(pattern), kind) for pattern, kind in rules], F.lit(default))


# The first pattern that a title or an attribute matches gives its type.
TABLE_RULES = [("register.*(field|bit)|(field|bit).*register", "REGISTER_FIELDS"), ("register", "REGISTER_MAP"), ("signal|port", "SIGNAL_LIST"), ("timing", "TIMING")]
FIGURE_RULES = [
    ("state|machine|transition", "STATE_DIAGRAM"), ("timing|waveform", "TIMING_DIAGRAM"), ("register.*(bit|field|layout)|(bit|field|layout).*register", "REGISTER_LAYOUT"),
    ("flow|sequence", "FLOWCHART"), ("block|architecture|diagram", "BLOCK_DIAGRAM"),
]
ATTRIBUTE_RULES = [("rsvd|reserved", "reserved"), ("wo", "write-only"), ("ro|hwinit", "read-only")]


def access_of_attribute(c: Column) -> Column:
    """Access by words inside an attribute: reserved, write-only, read-only, else read-write."""
    return first_rule(F.coalesce(c, F.lit("")), ATTRIBUTE_RULES, "read-write")


def bit_range_or_null(c: Column) -> Column:
    """{high, low} of '7-4' or '15'; nulls if it is none of them."""
    one, pair = r"^\s*\d+\s*$", r"^\s*(\d+)\s*-\s*(\d+)\s*$"
    high = F.when(c.rlike(pair), F.regexp_extract(c, pair, 1)).when(c.rlike(one), F.trim(c))
    low = F.when(c.rlike(pair), F.regexp_extract(c, pair, 2)).when(c.rlike(one), F.trim(c))
    return F.struct(high.try_cast("int").alias("high"), low.try_cast("int").alias("low"))


def field_name(c: Column, bits: Column) -> Column:
    """A field's name out of its text: the first line if it is short and no sentence, else one made of its bits."""
    first = F.trim(F.substring_index(c, "\n", 1))
    return F.when((first != "") & (F.length(first) < 50) & ~F.contains(first, F.lit(".")), first).otherwise(F.concat(F.lit("Field_"), F.regexp_replace(bits, r"[^0-9A-Za-z]+", "_")))


def fenced_block(c: Column, language: str) -> Column:
    """What stands between ```language and ``` in a text; null if there is no such block."""
    return F.nullif(F.trim(F.regexp_extract(c, rf"(?s)```{language}[^\n]*\n(.*?)\n?```", 1)), F.lit(""))


def labelled_line(c: Column, label: str = "ABSTRACT") -> Column:
    """The rest of the first line that begins with a label and a colon."""
    return F.nullif(F.trim(F.regexp_extract(c, rf"(?im)^\s*{label}\s*:\s*([^\n]*)", 1)), F.lit(""))


def is_section_number(c: Column) -> Column:
    """'2.1', 'Appendix_A' or 'A.1'. The pattern is a fixed value."""
    return c.rlike(r"^(\d+(\.\d+)*|Appendix_[A-Z]|[A-Z](\.\d+)*)$")


def duration(seconds: Column) -> Column:
    """'42.0s', '3m 05s' or '1h 02m' of a number of seconds."""
    minutes = F.floor(seconds / 60)
    return F.when(seconds < 60, F.format_string("%.1fs", seconds.cast("double"))).when(seconds < 3600, F.format_string("%dm %02ds", minutes, F.floor(seconds % 60))).otherwise(F.format_string("%dh %02dm", F.floor(seconds / 3600), F.floor((seconds % 3600) / 60)))


def iso_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def pdf_page(spec_page: Column, offset: int) -> Column:
    return spec_page + offset


def spec_page(pdf: Column, offset: int) -> Column:
    return pdf - offset


def has_text(page: Column, wanted: str) -> Column:
    return F.contains(F.lower(page), F.lit(wanted.lower()))


def mentions_enough(c: Column, words: list[str], least: int = 2) -> Column:
    """Whether at least so many of the words stand in a text."""
    return F.size(F.filter(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.contains(F.lower(c), w))) >= least


def continues_table(page: Column, reference: Column) -> Column:
    """Whether a page looks like the continuation of a table: five lines or more, no figure caption, no section heading at its
    beginning, no other table's caption, and three lines or more of three words. The patterns are fixed values."""
    lines = F.filter(F.transform(F.split(page, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    caption = F.exists(lines, lambda x: x.rlike(r"(?i)Figure\s+\d+-\d+\s*:"))
    heading = F.exists(F.slice(lines, 1, 8), lambda x: x.rlike(r"^\d+\.\d+\.\d+\s+"))
    other = F.exists(F.slice(lines, 1, 10), lambda x: x.rlike(r"(?i)Table\s+\d+-\d+\s*:") & (reference != "") & ~F.contains(F.lower(x), F.lower(reference)))
    return (F.size(lines) >= 5) & ~caption & ~heading & ~other & (F.size(F.filter(lines, lambda x: F.size(words(x)) >= 3)) >= 3)


def excerpt(text: Column, query: str, around: int) -> Column:
    """What stands around the first occurrence, with dots where it is cut."""
    at = F.instr(F.lower(text), query.lower()) - 1
    start, end = F.greatest(at - around, F.lit(0)), F.least(at + len(query) + around, F.length(text))
    return F.concat(F.when(start > 0, "...").otherwise(""), F.substring(text, start + 1, end - start), F.when(end < F.length(text), "...").otherwise(""))


def ellipsis(c: Column, limit: int = 120) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit - 3)), F.lit("..."))).otherwise(c)


def cap_words(c: Column, limit: int = 8000) -> Column:
    w = words(c)
    return F.when(F.size(w) > limit, F.concat(F.array_join(F.slice(w, 1, limit), " "), F.lit(" ... [truncated]"))).otherwise(c)
