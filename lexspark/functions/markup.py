"""Inline markup as column expressions: tag inventory, classification, repair, links, citations, cross-references.

All take a string column; null gives null (or an empty array), never an error. Patterns are constant, so each is compiled once a task.
"""

from __future__ import annotations

import functools
import sys

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lexspark.functions.text import squeeze

PAIRED = "a b bibl del div em h1 h2 h3 h4 h5 h6 i li ol p span strong sub sup table td th title tr u ul".split()
VALID = sorted({*PAIRED, *"body br head html img link meta".split()})
LOOKS_VALID = ["bibl", "p", "br", "div"]


def _pairs(block: str) -> list[tuple[str, str]]:
    return [tuple(line.split(" => ")) for line in block.strip().splitlines()]


#: Known malformations and what they were meant to be, applied in this order.
FIXES = _pairs("""
</p</bibl> => </p></bibl>
<bibl< => <bibl>
</bibbl> => </bibl>
<bibbl> => <bibl>
<bobl> => <bibl>
</bobl> => </bibl>
<b9bl> => <bibl>
<bibi> => <bibl>
<bibl></p> => </bibl></p>
""")

#: The literal malformations that the cell-wise analysis looks for.
LITERALS = _pairs("""
</bibbl> => </bibl>
<bibbl> => <bibl>
</bobl> => </bibl>
<bobl> => <bibl>
<b9bl> => <bibl>
<bibi> => <bibl>
</p</bibl> => </p></bibl>
<p< => <p>
</p>p> => </p>
""")


def none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def all_of(c: Column, pattern: str, group: int = 0) -> Column:
    """All matches, an empty array for null."""
    return F.coalesce(F.regexp_extract_all(c, F.lit(pattern), group), none("string"))


def tags(c: Column) -> Column:
    """every angle-bracket token."""
    return all_of(c, "</?[^<>]+/?>")


def tag_name(tag: Column) -> Column:
    return F.lower(F.regexp_extract(tag, r"^</?([^>\s/]+)", 1))


def tag_type(tag: Column, strict: bool = False) -> Column:
    """valid_html, malformed_html or non_html. A name that merely contains p, br, div or bibl counts as malformed; with `strict` only one that contains bibl."""
    name = tag_name(tag)
    near = functools.reduce(lambda a, b: a | b, [F.contains(name, F.lit(x)) for x in (["bibl"] if strict else LOOKS_VALID)])
    return (F.when(tag.isin([x for x, _ in FIXES]), "malformed_html").when(name.isin(VALID), "valid_html")
            .when((name != "") & near, "malformed_html").otherwise("non_html"))


def tag_fix(tag: Column) -> Column:
    """the fix of a malformed tag (itself if none is known), null for others."""
    known = functools.reduce(lambda c, kv: c.when(tag == kv[0], kv[1]), FIXES[1:], F.when(tag == FIXES[0][0], FIXES[0][1]))
    name = tag_name(tag)
    bibl = F.when(F.contains(name, F.lit("bibl")) & ~name.isin(VALID), F.when(tag.startswith("</"), "</bibl>").otherwise("<bibl>"))
    return F.coalesce(known, bibl, F.when(tag_type(tag) == "malformed_html", tag))


def repair(c: Column) -> Column:
    """literal fixes in order, then doubled brackets."""
    fixed = functools.reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), FIXES, c)
    return F.regexp_replace(F.regexp_replace(fixed, r"(?U)<<(\w+)>", "<$1>"), r"(?U)<(\w+)>>", "<$1>")


def occurrences(c: Column, text: str) -> Column:
    """How often the literal text occurs, without overlaps; 0 for null."""
    n = (F.length(c) - F.length(F.replace(c, F.lit(text), F.lit("")))) / len(text)
    return F.coalesce(n.cast("int"), F.lit(0))


def repair_count(c: Column) -> Column:
    """the number of literal fixes made, each counted before its own replacement."""
    total, t = F.lit(0), c
    for bad, good in FIXES:
        total, t = total + occurrences(t, bad), F.replace(t, F.lit(bad), F.lit(good))
    return total


def encoded(tag: Column) -> Column:
    return F.replace(F.replace(tag, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def non_html_tags(c: Column) -> Column:
    """F8: tokens in angle brackets that are no markup, <> too."""
    return F.filter(all_of(c, "<[^<>]*>"), lambda t: tag_type(t) == "non_html")


def encode_non_html(c: Column, empty_too: bool = False) -> Column:
    """F4 (and F9 with `empty_too`, where <> counts): each non-markup tag as entities."""
    found = non_html_tags(c) if empty_too else F.filter(tags(c), lambda t: tag_type(t) == "non_html")
    return F.when(c.isNotNull(), F.aggregate(F.array_distinct(found), c, lambda acc, t: F.replace(acc, t, encoded(t))))


def open_count(c: Column, tag: str) -> Column:
    return F.regexp_count(c, F.lit(rf"(?i)<{tag}(?:\s[^>]*)?>"))


def close_count(c: Column, tag: str) -> Column:
    return F.regexp_count(c, F.lit(f"(?i)</{tag}>"))


def mismatches(c: Column, names: list[str] | None = None) -> Column:
    """array of (tag, open_count, close_count, issue) of the paired tags whose counts differ."""
    rows = [F.struct(F.lit(t).alias("tag"), open_count(c, t).alias("open_count"), close_count(c, t).alias("close_count")) for t in names or PAIRED]
    differ = F.filter(F.array(*rows), lambda r: r.open_count != r.close_count)
    full = F.transform(differ, lambda r: F.struct(r.tag.alias("tag"), r.open_count.alias("open_count"), r.close_count.alias("close_count"),
                       F.format_string("Mismatch: %d open, %d closed", r.open_count, r.close_count).alias("issue")))
    return F.when(c.isNotNull(), full).otherwise(F.slice(full, 1, 0))


def close_missing(text: str, tag: str, missing: int) -> str:
    """closing tags put before </p>, else before a new paragraph, else before a sentence's last stop, else at the end."""
    import re

    for rule in ("</p>", r"\n\s*<p", r"\.\s*(?=<|$)", "$"):
        places = [m.start() for m in re.finditer(rule, text)][:max(missing, 0)]
        for at in reversed(places):
            text = f"{text[:at]}</{tag}>{text[at:]}"
        missing -= len(places)
    return text


def open_missing(text: str, tag: str, missing: int) -> str:
    """opening tags put before the up to 100 plain characters that precede a closing tag; only for bibl."""
    import re

    if tag != "bibl":
        return text
    for m in reversed(list(re.finditer(r"[^\n<>]{1,100}\s*</bibl>", text))[:missing]):
        text = f"{text[:m.start()]}<bibl>{text[m.start():]}"
    return text


@F.pandas_udf(StringType())
def _balanced(texts, missing):
    """Positive counts want closing tags, negative ones opening tags."""
    return texts.combine(missing, lambda t, k: t if t is None or not k else close_missing(t, "bibl", k) if k > 0 else open_missing(t, "bibl", -k))


def balance_bibl(c: Column) -> Column:
    """F6 and F7, the direction taken from each cell's own counts. Only unbalanced cells carry text to Python."""
    short = open_count(c, "bibl") - close_count(c, "bibl")
    return F.when(short != 0, _balanced(F.when(short != 0, c), short)).otherwise(c)


def has_href(attrs: Column) -> Column:
    """F10."""
    return F.coalesce(attrs.rlike(r"""(?i)href\s*=\s*(?:"[^"']*["']|'[^"']*["'])"""), F.lit(False))


RAW_URL = r"<(https?://[^\s>]+)>"


def link_issues(c: Column) -> Column:
    """array of (issue, detail, opens, closes): raw URLs in brackets, <a…> without href (any tag that begins with a), unequal numbers of <a…> and </a>."""
    def row(issue, detail, opens=None, closes=None):
        return F.struct(F.lit(issue).alias("issue"), detail.alias("detail"), (F.lit(None).cast("int") if opens is None else opens).alias("opens"), (F.lit(None).cast("int") if closes is None else closes).alias("closes"))
    opens, closes = F.regexp_count(c, F.lit("(?i)<a[^>]*>")), F.regexp_count(c, F.lit("(?i)</a>"))
    raw = F.transform(all_of(c, RAW_URL, 1), lambda u: row("raw_url", u))
    bare = F.transform(F.filter(all_of(c, "(?i)<a([^>]*)>", 1), lambda a: ~has_href(a)), lambda a: row("missing_href", a))
    uneven = F.filter(F.array(row("unbalanced", F.lit("a"), opens, closes)), lambda r: r.opens != r.closes)
    return F.concat(raw, bare, uneven)


def anchor_raw_urls(c: Column) -> Column:
    """F12."""
    return F.regexp_replace(c, RAW_URL, '<a href="$1">$1</a>')


BIBL = r"(?is)<bibl[^>]*>.*?</bibl>"


def clean_citation(c: Column) -> Column:
    """F14."""
    return squeeze(F.regexp_replace(F.trim(c), r"(?U)>\s+<", "><"))


def citations(c: Column) -> Column:
    """the cleaned citation blocks, tags included, in text order."""
    return F.filter(F.transform(all_of(c, BIBL), clean_citation), lambda x: x != "")


def without_citations(c: Column) -> Column:
    """the text with the blocks taken out and white space squeezed."""
    return squeeze(F.regexp_replace(c, BIBL, ""))


CROSSREF = r"(?i)\((?:see|cf\.|compare|also|variant\s+of)\s+[^)]+\)|\[(?:see|cf\.)\s+[^\]]+\]"
SCHOLARS = ["molina", "karttunen", "carochi", "lockhart"]


def crossref_type(ref: Column) -> Column:
    """the label of one reference in brackets; scholars first, the more general after."""
    w = functools.reduce(lambda c, s: (F if c is None else c).when(ref.rlike(rf"(?i)^\(see\s+{s}"), f"{s}_ref"), SCHOLARS, None)
    for pattern, label in ((r"^[\(\[]see\s", "see"), (r"^[\(\[]cf\.", "cf"), (r"^\(compare", "compare"), (r"^\(also\s+see\s", "also_see"), (r"^\(variant", "variant")):
        w = w.when(ref.rlike("(?i)" + pattern), label)
    return w.otherwise("also")


def clean_crossref(c: Column) -> Column:
    """F16: tags out, squeezed, outer . , ; : off; null unless longer than one character with a letter or digit."""
    t = F.regexp_replace(squeeze(F.regexp_replace(c, "<[^>]+>", "")), "^[.,;:]+|[.,;:]+$", "")
    return F.when((F.length(t) > 1) & t.rlike(r"[\p{L}\p{N}]"), t)


def crossrefs(c: Column) -> Column:
    """array of (text, type) in text order; those without a usable text are left out."""
    def one(ref):
        kind = crossref_type(ref)
        inner = F.regexp_extract(ref, r"(?is)^[\(\[](?:also\s+see|see|cf\.|compare|also|variant\s+of)\s+(.*)[\)\]]$", 1)
        text = F.when(kind.endswith("_ref"), F.regexp_replace(ref, r"^[\(\[]+|[\)\]]+$", "")).otherwise(clean_crossref(inner))
        return F.struct(text.alias("text"), kind.alias("type"))
    return F.filter(F.transform(all_of(c, CROSSREF), one), lambda r: F.coalesce(r.text, F.lit("")) != "")


def without_crossrefs(c: Column) -> Column:
    """references taken out, with one blank before each, then runs of blanks squeezed."""
    return F.regexp_replace(F.regexp_replace(c, rf"(?i) ?(?:{CROSSREF[4:]})", ""), "  +", " ")


def drop_empty_p(c: Column) -> Column:
    """F17."""
    return squeeze(F.regexp_replace(c, r"(?iU)\s*<p>\s*</p>\s*", ""))


def strip_html(c: Column) -> Column:
    """tags and stray attributes out, squeezed."""
    t = F.regexp_replace(c, "<[^>]+>", "")
    return squeeze(F.regexp_replace(F.regexp_replace(t, r'(?U)\w+="[^"]*"', ""), r"(?U)\w+='[^']*'", ""))


def strip_div_br(c: Column) -> Column:
    """div and br out, white space squeezed and taken from beside tags; null becomes ''."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"<div[^>]*>|</div>|<br\s*/?>", "")
    t = F.regexp_replace(t, r"(?U)\s+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"\s+</", "</"), r">\s+", ">"))


def bibl_texts(c: Column) -> Column:
    """inner texts of citations, tags out, longer than five characters; the source keeps them."""
    inner = F.transform(all_of(c, BIBL), lambda b: squeeze(F.regexp_replace(b, "<[^>]+>", "")))
    return F.filter(inner, lambda x: F.length(x) > 5)


def bibl_row(cells: dict[str, Column]) -> Column:
    """'name: a | b' of every cell that has citations, joined by ' || '."""
    return F.concat_ws(" || ", *[F.when(F.size(bibl_texts(c)) > 0, F.concat(F.lit(f"{n}: "), F.array_join(bibl_texts(c), " | "))) for n, c in cells.items()])


LEGACY_REFS = [r"(?i)\(see\s+([^)]+)\)", r"(?i)\[see\s+([^\]]+)\]", r"(?i)\(cf\.\s+([^)]+)\)", r"(?i)see\s+also\s+([^.;,]+)", r"(?i)\(compare\s+([^)]+)\)", r"(?i)\(also\s+([^)]+)\)"]


def legacy_crossrefs(c: Column) -> Column:
    """distinct targets of six patterns that may overlap; the source keeps them."""
    return F.array_distinct(F.filter(F.transform(F.concat(*[all_of(c, p, 1) for p in LEGACY_REFS]), lambda x: F.trim(x)), lambda x: x != ""))


def legacy_crossref_class(c: Column) -> Column:
    """F24."""
    n = F.size(F.split(squeeze(c), " "))
    return (F.when(F.lower(c).rlike("molina|karttunen|carochi"), "Scholar_Reference").when(n == 1, "Single_Word")
            .when(n <= 3, "Short_Phrase").otherwise("Long_Phrase"))


def is_valid_tag(tag: Column) -> Column:
    """a whitelisted name, and neither '<//' nor '><' inside."""
    return tag_name(tag).isin(VALID) & ~F.contains(tag, F.lit("<//")) & ~F.contains(tag, F.lit("><"))


def tag_context(c: Column, tag: Column, around: int = 50) -> Column:
    """the text around the first occurrence, every occurrence in it marked [[[tag]]]; '' if there is none."""
    at = F.position(tag, c)
    start = F.greatest(at - around, F.lit(1))
    part = c.substr(start, at + F.length(tag) + around - start)
    return F.when(at > 0, F.replace(part, tag, F.concat(F.lit("[[["), tag, F.lit("]]]")))).otherwise("")


def malformed(c: Column) -> Column:
    """bracket tokens that classify as malformed markup."""
    return F.filter(all_of(c, "<[^<>]*>"), lambda t: tag_type(t) == "malformed_html")


register_pickle_by_value(sys.modules[__name__])
