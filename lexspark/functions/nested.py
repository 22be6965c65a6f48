"""Expressions over nested values: glosses, source lists, maps, lookups."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexspark.functions.nulls import is_blank
from lexspark.functions.text import items, trim_spaces

GLOSS = "array<array<array<struct<translation:string,hint:string>>>>"


def gloss_text(glosses: Column) -> Column:
    """'t (hint)' joined ', ' within a sense, '; ' within a group, ' | ' between groups; items without a translation are skipped."""
    def one(x):
        return F.when(~is_blank(x.hint), F.concat(x.translation, F.lit(" ("), x.hint, F.lit(")"))).otherwise(x.translation)
    def sense(s):
        return F.array_join(F.transform(F.filter(s, lambda x: F.coalesce(x.translation, F.lit("")) != ""), one), ", ")
    def group(g):
        return F.array_join(F.filter(F.transform(g, sense), lambda x: x != ""), "; ")
    return F.array_join(F.filter(F.transform(glosses, group), lambda x: x != ""), " | ")


#: Author names as they occur in citations, and the source they stand for, in order of trial.
AUTHORITIES = {"molina": "VLM", "karttunen": "AND", "carochi": "GML", "olmos": "ALM", "lockhart": "NWN"}

PAGE_PATTERNS = [r"f\.\s*([0-9]+[rv]?)", r"p\.\s*([0-9]+)", r",\s*([0-9]+[rv]?)\.", r",\s*([0-9]+–[0-9]+)", r"([0-9]+–[0-9]+)\.", r"vol\.\s*[0-9]+,\s*([0-9]+–[0-9]+)"]


def page_number(citation: Column) -> Column:
    """the first pattern that matches gives the page; '' if none does."""
    hits = [F.nullif(F.regexp_extract(citation, p, 1), F.lit("")) for p in PAGE_PATTERNS]
    return F.coalesce(*hits, F.lit(""))


def authority(citation: Column) -> Column:
    """the source of the first author named; null if none is."""
    low = F.lower(citation)
    return functools.reduce(lambda w, kv: (F if w is None else w).when(F.contains(low, F.lit(kv[0])), kv[1]), AUTHORITIES.items(), None)


def parse_citations(c: Column) -> Column:
    """parts between pipes, trimmed, blank ones kept; empty for null and ''."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(items(c, keep_blank=True))


def _source(source, page, entry):
    return F.struct(source.alias("source"), page.alias("page_number"), entry.alias("original_entry"))


def authority_sources(contents: dict[str, Column], citation_list: Column) -> Column:
    """for each non-blank authority text (keyed by source) one struct per matching citation, or one without page."""
    parsed = parse_citations(citation_list)
    def of(abbrev, text):
        cited = F.filter(parsed, lambda x: authority(x) == abbrev)
        many = F.transform(cited, lambda x: _source(F.lit(abbrev), page_number(x), F.concat(text, F.lit(" "), x)))
        got = F.when(F.size(cited) > 0, many).otherwise(F.array(_source(F.lit(abbrev), F.lit(""), text)))
        return F.when((F.coalesce(text, F.lit("")) != "") & (text != "None"), got).otherwise(F.slice(got, 1, 0))
    return F.flatten(F.array(*[of(a, t) for a, t in contents.items()]))


def labelled_source(source: str, fields: dict[str, Column]) -> Column:
    """'label: text' of the filled fields joined '. ' with a stop at the end, as the one source; '' if none is filled."""
    parts = [F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{label}: "), c)) for label, c in fields.items()]
    text = F.concat_ws(". ", *parts)
    return F.array(_source(F.lit(source), F.lit(""), F.when(text == "", "").otherwise(F.concat(text, F.lit(".")))))


def export_entry(headword: Column, gloss: Column, language: Column, sources: Column, themes: Column | None = None) -> Column:
    """One entry as JSON; themes are left out where there are none."""
    cols = [headword.alias("Headwords"), gloss.alias("Gloss"), language.alias("Language"), sources.alias("Sources")]
    if themes is not None:
        cols.append(F.when(F.size(themes) > 0, themes).alias("Themes"))
    return F.to_json(F.struct(*cols))


def lookup(c: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """a small constant map as an expression."""
    pairs = [x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(default))


def content_hash(fields: Column) -> Column:
    """md5 of the first 'key:value' whose key is no metadata (leading _) and whose value isn't blank; null if there is none."""
    usable = F.filter(F.map_entries(fields), lambda e: ~e.key.startswith("_") & (trim_spaces(F.coalesce(e.value, F.lit(""))) != ""))
    first = F.get(usable, 0)
    return F.when(F.size(usable) > 0, F.md5(F.concat(trim_spaces(first.key), F.lit(":"), trim_spaces(first.value)).cast("binary")))


def matched_attestations(attestations: Column, original: Column, exact: bool = False) -> Column:
    """those of the ';' list that equal the source text, or occur in it."""
    o = F.trim(F.coalesce(original, F.lit("")))
    return F.filter(items(attestations, ";"), lambda a: (a == o) if exact else F.contains(o, a))


def source_class(has_headword: Column, has_modern: Column) -> Column:
    """P11."""
    return F.when(has_headword & has_modern, "HYBRID").when(has_modern, "IDIEZ").when(has_headword, "WHP").otherwise("UNKNOWN")
