"""Text, key and difference expressions. Null inputs are described with each function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"(?U)\s+"
#: Characters that first_diff compares at once.
BLOCK = 256


#: What SQL's trim takes off: all separators of the Unicode class Zs.
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def trim_spaces(c: Column) -> Column:
    """Without the spaces of SPACES at its ends; tabs and line ends stay."""
    return F.trim(c, F.lit(SPACES))


def squeeze(c: Column) -> Column:
    """White-space runs become one blank, ends are trimmed; null stays null."""
    return F.trim(F.regexp_replace(c, WS, " "))


def same_text(a: Column, b: Column) -> Column:
    """Equality after white-space normalisation; null equals ''."""
    return squeeze(F.coalesce(a, F.lit(""))) == squeeze(F.coalesce(b, F.lit("")))


def key_strip(c: Column) -> Column:
    """A reference without its dataset prefix."""
    return F.regexp_replace(c, "^(?:WHP|IDIEZ)-", "")


def strip_punctuation(c: Column) -> Column:
    """Without . , ; : ! ?, white space squeezed; null becomes ''."""
    return squeeze(F.translate(F.coalesce(c, F.lit("")), ".,;:!?", ""))


def items(c: Column, sep: str = "|", keep_blank: bool = False) -> Column:
    """Trimmed parts of a delimited text; blank parts only with `keep_blank`; null gives an empty array."""
    parts = F.transform(F.split(c, f"[{sep}]"), lambda x: F.trim(x))
    parts = parts if keep_blank else F.filter(parts, lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def item_diff(new: Column, old: Column) -> Column:
    """'ADDED: a | b || REMOVED: c' over pipe-separated sets; null if neither has a pipe or nothing differs."""
    a, b = F.array_distinct(items(new)), F.array_distinct(items(old))
    def side(label, x, y):
        d = F.array_sort(F.array_except(x, y))
        return F.when(F.size(d) > 0, F.concat(F.lit(f"{label}: "), F.array_join(d, " | ")))
    text = F.concat_ws(" || ", side("ADDED", a, b), side("REMOVED", b, a))
    piped = F.coalesce(F.contains(new, F.lit("|")), F.lit(False)) | F.coalesce(F.contains(old, F.lit("|")), F.lit(False))
    return F.when(piped & (text != ""), text)


def length_diff(new: Column, old: Column) -> Column:
    """The difference in characters with its sign, '0' if equal; null counts as ''."""
    d = F.length(F.coalesce(new, F.lit(""))) - F.length(F.coalesce(old, F.lit("")))
    return F.when(d == 0, "0").otherwise(F.format_string("%+d", d))


def first_diff(new: Column, old: Column) -> Column:
    """0-based place of the first differing character, the shorter length for a prefix, null if equal. Linear in the length."""
    a, b = F.coalesce(new, F.lit("")), F.coalesce(old, F.lit(""))

    def place(x, y):
        return F.array_position(F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: ~p.eqNullSafe(q)), F.lit(True)) - 1

    # blocks of characters first, then the characters of the first block that differs
    cut = F.lit(rf"(?s).{{1,{BLOCK}}}")
    blocks = F.zip_with(F.regexp_extract_all(a, cut, 0), F.regexp_extract_all(b, cut, 0), lambda p, q: ~p.eqNullSafe(q))
    found = bound(F.array_position(blocks, F.lit(True)), lambda n: (n - 1) * BLOCK + place(a.substr((n - 1).cast("int") * BLOCK + 1, F.lit(BLOCK)), b.substr((n - 1).cast("int") * BLOCK + 1, F.lit(BLOCK))))
    return F.when(a != b, found)


def diff_context(new: Column, old: Column, around: int = 30) -> Column:
    """A window around the first difference on both sides; null if equal. The end of both windows follows the new text's length."""
    a, b = F.coalesce(new, F.lit("")), F.coalesce(old, F.lit(""))

    def around_it(at):
        start = F.greatest(F.lit(0), at - around)
        end = F.least(F.length(a), at + around)
        theirs = F.when(at < F.length(b), b.substr(start + 1, F.greatest(end - start, F.lit(0)))).otherwise(b.substr(start + 1, F.length(b)))
        return F.when(at.isNotNull(), F.concat(F.lit("Scraped: ..."), a.substr(start + 1, end - start), F.lit("... | Local: ..."), theirs, F.lit("...")))

    return bound(first_diff(a, b).cast("int"), around_it)


def punctuation_only(new: Column, old: Column) -> Column:
    """True if the texts differ, but not without punctuation."""
    return ~F.coalesce(new, F.lit("")).eqNullSafe(F.coalesce(old, F.lit(""))) & (strip_punctuation(new) == strip_punctuation(old))


def recommended_action(new: Column, old: Column) -> Column:
    """What to do with a differing pair: keep the new text where only punctuation differs, fill blanks, else review."""
    blank_new, blank_old = F.trim(F.coalesce(new, F.lit(""))) == "", F.trim(F.coalesce(old, F.lit(""))) == ""
    return (F.when(blank_new & ~blank_old, "use_local").when(blank_old & ~blank_new, "use_scraped")
            .when(punctuation_only(new, old), "use_scraped").otherwise("manual_review"))


def safe_name(c: Column) -> Column:
    """A file name: other characters than letters, digits, _ - ( ) become one _."""
    return F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9_()-]", "_"), "_+", "_")


def audio_name(node: Column, url: Column) -> Column:
    """{node}_{last path segment} with unusual characters as _."""
    base = F.substring_index(F.regexp_replace(url, "[?#].*$", ""), "/", -1)
    return F.concat_ws("_", node.cast("string"), F.regexp_replace(base, r"[^\p{L}\p{N}_.-]", "_"))


def slug_of(url: Column) -> Column:
    """The last path segment of a URL, query and fragment aside."""
    return F.substring_index(F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "/+$", ""), "/", -1)


def slug_title(slug: Column) -> Column:
    """'field-crops' to 'Field Crops'."""
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def prefixed_id(c: Column, prefixes: tuple[str, ...] = ("page-node-", "taxonomy-term-", "node-")) -> Column:
    """The number behind one of the prefixes or /node/; null where there is none."""
    return F.nullif(F.regexp_extract(c, "(?:" + "|".join(prefixes) + "|/node/)([0-9]+)", 1), F.lit("")).try_cast("bigint")


def entry_count(text: Column, fallback: Column) -> Column:
    """The number before entries, items or results, else the fallback."""
    return F.coalesce(F.regexp_extract(text, r"(?i)([0-9]+)\s+(?:results|entries|items)", 1).try_cast("int"), fallback)


def headword(c: Column) -> Column:
    """Without trailing full stops and outer blanks."""
    return F.trim(F.regexp_replace(c, "[.]+$", ""))


def apostrophes(name: str) -> str:
    """A column name for comparison: lower case, typographic apostrophes taken out."""
    return name.lower().replace("’", "").replace("‘", "").replace("'", "")


def resolve_column(columns: list[str], wanted: str) -> str | None:
    """The column of that name, else the one equal to it but for case and apostrophes, else None."""
    if wanted in columns:
        return wanted
    return next((c for c in columns if apostrophes(c) == apostrophes(wanted)), None)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, null where whole is 0."""
    return F.round(F.try_divide(part * 100.0, whole), digits)


def stamp(c: Column, time: bool = True) -> Column:
    """A timestamp as a file suffix."""
    return F.date_format(c, "yyyyMMdd_HHmmss" if time else "yyyyMMdd")
