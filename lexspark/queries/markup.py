"""Markup: inventory, mismatches, repair, links, citations, cross-references."""

from pyspark.sql import functions as F

from lexspark.functions import markup as M
from lexspark.operators import apply as A
from lexspark.operators.aggregate import extraction_stats
from lexspark.plans import processing as P
from lexspark.queries.registry import query
from lexspark.sources import pages as G

TAGS = "(SELECT page_id, unnest(regexp_extract_all(html, '</?[^<>]+/?>')) AS tag FROM pages)"


def _list(xs):
    return ", ".join(f"'{x}'" for x in xs)


def sql_name(t):
    return f"lower(regexp_extract({t}, '^</?([^>\\s/]+)', 1))"


def sql_type(t):
    n = sql_name(t)
    near = " OR ".join(f"contains({n}, '{x}')" for x in M.LOOKS_VALID)
    return f"CASE WHEN {t} IN ({_list(x for x, _ in M.FIXES)}) THEN 'malformed_html' WHEN {n} IN ({_list(M.VALID)}) THEN 'valid_html' WHEN {n} <> '' AND ({near}) THEN 'malformed_html' ELSE 'non_html' END"


def sql_fix(t):
    n = sql_name(t)
    known = " ".join(f"WHEN {t} = '{a}' THEN '{b}'" for a, b in M.FIXES)
    return f"CASE {known} WHEN {sql_type(t)} <> 'malformed_html' THEN NULL WHEN contains({n}, 'bibl') THEN CASE WHEN {t} LIKE '</%' THEN '</bibl>' ELSE '<bibl>' END ELSE {t} END"


def sql_squeeze(x):
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


@query("tag_inventory", f"SELECT tag, {sql_type('tag')} AS type, {sql_fix('tag')} AS fix, count(*) AS n, min(page_id) AS first_page FROM {TAGS} GROUP BY tag")
def tag_inventory(t):
    c = t.pages.select("page_id", F.explode(M.tags(F.col("html"))).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"), F.min("page_id").alias("first_page"))
    tag = F.col("tag")
    return c.select("tag", M.tag_type(tag).alias("type"), M.tag_fix(tag).alias("fix"), "n", "first_page").orderBy(F.desc("n"), "tag")


@query("tag_class_counts", f"SELECT {sql_type('tag')} AS type, count(*) AS n, count(DISTINCT tag) AS tags FROM {TAGS} GROUP BY 1")
def tag_class_counts(t):
    c = t.pages.select(F.explode(M.tags(F.col("html"))).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
    return c.groupBy(M.tag_type(F.col("tag")).alias("type")).agg(F.sum("n").alias("n"), F.count("*").alias("tags"))


@query("distinct_tags_per_page", "SELECT page_id, count(DISTINCT lower(x)) AS n, string_agg(DISTINCT lower(x), ' ' ORDER BY lower(x)) AS names FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][A-Za-z0-9_]*)', 1)) AS x FROM pages) GROUP BY page_id")
def distinct_tags_per_page(t):
    names = F.array_sort(F.array_distinct(F.transform(M.all_of(F.col("html"), "<([a-zA-Z][A-Za-z0-9_]*)", 1), F.lower)))
    return t.pages.select("page_id", F.size(names).alias("n"), F.array_join(names, " ").alias("names")).filter("n > 0")


@query("valid_tag_flags", f"SELECT DISTINCT tag, {sql_name('tag')} IN ({_list(M.VALID)}) AND NOT contains(tag, '<//') AND NOT contains(tag, '><') AS valid FROM {TAGS}")
def valid_tag_flags(t):
    return t.pages.select(F.explode(M.tags(F.col("html"))).alias("tag")).distinct().select("tag", M.is_valid_tag(F.col("tag")).alias("valid"))


def sql_counts(c, tag):
    return rf"len(regexp_extract_all({c}, '(?i)<{tag}(?:\s[^>]*)?>'))", f"len(regexp_extract_all({c}, '(?i)</{tag}>'))"


def sql_mismatches(keys, source, c, tags=M.PAIRED):
    each = " UNION ALL ".join(f"SELECT {keys}, '{t}' AS tag, {sql_counts(c, t)[0]} AS open_count, {sql_counts(c, t)[1]} AS close_count FROM {source}" for t in tags)
    return f"(SELECT *, 'Mismatch: ' || open_count || ' open, ' || close_count || ' closed' AS issue FROM ({each}) WHERE open_count <> close_count)"


MISMATCHES = sql_mismatches("page_id", "pages", "html")


@query("tag_mismatches", f"SELECT * FROM {MISMATCHES}")
def tag_mismatches(t):
    return t.pages.select("page_id", F.inline(M.mismatches(F.col("html"))))


@query("mismatch_summary", f"SELECT '<' || tag || '>' AS tag, issue, count(*) AS occurrences FROM {MISMATCHES} WHERE tag <> 'bibl' GROUP BY 1, 2")
def mismatch_summary(t):
    return P.manual_review(P.malformed_rows(t.pages, "page_id", ["html"]))


@query("mismatch_cells", f"SELECT page_id, 'html' AS column, left(html, 200) AS preview, tag, open_count, close_count, issue FROM {sql_mismatches('page_id, html', 'pages', 'html', ['b', 'p'])}")
def mismatch_cells(t):
    return P.mismatch_cells(t.pages, "page_id", ["html"], ["b", "p"])


def sql_occurrences(c, x):
    return f"((length({c}) - length(replace({c}, '{x}', ''))) / {len(x)})::BIGINT"


#: Parts with malformed markup around their columns: the driver's tables have none.
BROKEN = "concat('<bobl>', p_name, '</bobl> <<b>', p_brand, '</b> <i>>', p_type, CASE WHEN p_size % 3 = 0 THEN '</p</bibl>' WHEN p_size % 3 = 1 THEN '<bibl></p>' ELSE '<p<' END)"


def broken(t):
    return t.spread("part", "p_partkey").select("p_partkey", F.expr(BROKEN).alias("txt"))


def sql_rows(source, key, c):
    parts = [f"SELECT {key}, '{a}' AS tag, '{b}' AS suggestion, {sql_occurrences(c, a)} AS n FROM {source}" for a, b in M.LITERALS]
    parts += [f"SELECT {key}, 'REGEX:{n}', '<tag>', len(regexp_extract_all({c}, '{p}')) FROM {source}" for n, p in (("double_open", "<<[A-Za-z0-9_]+>"), ("double_close", "<[A-Za-z0-9_]+>>"))]
    return f"(SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n > 0 UNION ALL SELECT {key}, '<' || tag || '>', issue, 1 FROM {sql_mismatches(key, source, c)})"


BROKEN_ROWS = sql_rows(f"(SELECT p_partkey, {BROKEN} AS txt FROM part)", "p_partkey", "txt")


@query("malformed_summary", f"SELECT tag, sum(n)::BIGINT AS count, arg_min(suggestion, p_partkey) AS suggestion, min(p_partkey) AS first FROM {BROKEN_ROWS} GROUP BY tag")
def malformed_summary(t):
    return P.malformed_summary(P.malformed_rows(broken(t), "p_partkey", ["txt"]), "p_partkey")


@query("repair_stats", f"""WITH s AS (SELECT tag, sum(n)::BIGINT AS count, arg_min(suggestion, p_partkey) AS suggestion FROM {BROKEN_ROWS} GROUP BY tag)
SELECT sum(count)::BIGINT AS total, count(*) AS "unique", coalesce(sum(count) FILTER (suggestion NOT LIKE 'Mismatch:%' OR tag = '<bibl>'), 0)::BIGINT AS auto_fixable,
coalesce(sum(count) FILTER (suggestion LIKE 'Mismatch:%' AND tag <> '<bibl>'), 0)::BIGINT AS manual, count(*) FILTER (suggestion NOT LIKE 'Mismatch:%') AS literal_patterns, count(*) FILTER (suggestion LIKE 'Mismatch:%') AS mismatch_patterns FROM s""")
def repair_stats(t):
    return P.repair_statistics(P.malformed_summary(P.malformed_rows(broken(t), "p_partkey", ["txt"]), "p_partkey"))


def sql_repair(c):
    for a, b in M.FIXES:
        c = f"replace({c}, '{a}', '{b}')"
    return rf"regexp_replace(regexp_replace({c}, '<<([A-Za-z0-9_]+)>', '<\1>', 'g'), '<([A-Za-z0-9_]+)>>', '<\1>', 'g')"


def sql_repair_count(c):
    total = []
    for a, b in M.FIXES:
        total.append(sql_occurrences(c, a))
        c = f"replace({c}, '{a}', '{b}')"
    return " + ".join(total)


@query("literal_tag_repair", f"SELECT p_partkey, {sql_repair('txt')} AS repaired, {sql_repair_count('txt')} AS repairs FROM (SELECT p_partkey, {BROKEN} AS txt FROM part)")
def literal_tag_repair(t):
    return broken(t).select("p_partkey", M.repair(F.col("txt")).alias("repaired"), M.repair_count(F.col("txt")).alias("repairs"))


@query("bibl_balance")
def bibl_balance(t):
    """F6, F7 (no SQL: the number of insertions depends on the cell; tested by golden rows)."""
    c = F.concat(F.when(F.col("p_size") % 2 == 0, "<bibl>").otherwise(""), F.col("p_name"), F.lit(", "), F.col("p_size"), F.lit(". "), F.col("p_type"), F.when(F.col("p_size") % 3 == 0, "</bibl>").otherwise("</p>"))
    return t.spread("part", "p_partkey").select("p_partkey", M.balance_bibl(c).alias("balanced"))


PAIRS = {"widget": "<w/>", "ring": "<r/>", "o": "0"}


@query("batch_replace", "SELECT p_partkey, b AS p_name, ty AS p_type, ((b <> p_name)::BIGINT + (ty <> p_type)::BIGINT) AS changed_cells FROM (SELECT *, replace(replace(replace(p_name, 'widget', '<w/>'), 'ring', '<r/>'), 'o', '0') AS b, replace(replace(replace(p_type, 'widget', '<w/>'), 'ring', '<r/>'), 'o', '0') AS ty FROM part)")
def batch_replace(t):
    return A.batch_replace(t.part.select("p_partkey", "p_name", "p_type"), PAIRS, ["p_name", "p_type"])


@query("scoped_replace", "SELECT p_partkey, CASE WHEN p_size < 10 THEN replace(p_name, 'ring', 'band') ELSE p_name END AS p_name, p_brand, p_type, p_size::BIGINT AS p_size FROM part")
def scoped_replace(t):
    return A.scoped_replace(t.part.drop("p_retailprice"), "ring", "band", "p_name", F.col("p_size") < 10)


AUDIT = ["<b>", "</b>", "<br>", "<em>", "&amp;"]


@query("remaining_tag_audit", "SELECT tag, sum(n)::BIGINT AS occurrences, count(*) AS rows, min(page_id) AS first_row FROM (" + " UNION ALL ".join(f"SELECT page_id, '{x}' AS tag, {sql_occurrences('html', x)} AS n FROM pages" for x in AUDIT) + ") WHERE n > 0 GROUP BY tag")
def remaining_tag_audit(t):
    return A.remaining_tags(t.pages, "page_id", "html", AUDIT)


WRAPPED = "concat('<', p_name, '> <b>', p_brand, '</b> <', p_type, '> <>')"


@query("non_html_encode", f"""SELECT p_partkey, array_to_string(tags, ' ') AS tags, list_reduce(list_distinct(tags), lambda acc, x: replace(acc, x, replace(replace(x, '<', '&lt;'), '>', '&gt;')), txt) AS encoded
FROM (SELECT p_partkey, txt, list_filter(regexp_extract_all(txt, '<[^<>]*>'), lambda x: {sql_type('x')} = 'non_html') AS tags FROM (SELECT p_partkey, {WRAPPED} AS txt FROM part))""")
def non_html_encode(t):
    d = t.spread("part", "p_partkey").select("p_partkey", F.expr(WRAPPED).alias("txt"))
    return d.select("p_partkey", F.array_join(M.non_html_tags(F.col("txt")), " ").alias("tags"), M.encode_non_html(F.col("txt"), empty_too=True).alias("encoded"))


@query("legacy_malformed_tags", f"SELECT tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all({WRAPPED}, '<[^<>]*>')) AS tag FROM part) WHERE {sql_type('tag')} = 'malformed_html' GROUP BY tag")
def legacy_malformed_tags(t):
    return t.spread("part", "p_partkey").select(F.explode(M.malformed(F.expr(WRAPPED))).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query("tag_context", "SELECT page_id, replace(substr(html, greatest(strpos(html, '<h1>') - 50, 1), strpos(html, '<h1>') + 4 + 50 - greatest(strpos(html, '<h1>') - 50, 1)), '<h1>', '[[[<h1>]]]') AS context FROM pages WHERE contains(html, '<h1>')")
def tag_context(t):
    return t.pages.filter(F.contains("html", F.lit("<h1>"))).select("page_id", M.tag_context(F.col("html"), F.lit("<h1>")).alias("context"))


URLS = "concat('see <', url, '> and ', html)"


@query("link_issues", rf"""WITH p AS (SELECT page_id, {URLS} AS txt FROM pages)
SELECT page_id, 'raw_url' AS issue, unnest(regexp_extract_all(txt, '<(https?://[^\s>]+)>', 1)) AS detail, NULL::BIGINT AS opens, NULL::BIGINT AS closes FROM p
UNION ALL SELECT page_id, 'missing_href', a, NULL, NULL FROM (SELECT page_id, unnest(regexp_extract_all(txt, '(?i)<a([^>]*)>', 1)) AS a FROM p) WHERE NOT regexp_matches(a, '(?i)href\s*=\s*["''][^"'']*["'']')
UNION ALL SELECT page_id, 'unbalanced', 'a', o, c FROM (SELECT page_id, len(regexp_extract_all(txt, '(?i)<a[^>]*>')) AS o, len(regexp_extract_all(txt, '(?i)</a>')) AS c FROM p) WHERE o <> c""")
def link_issues(t):
    return t.pages.select("page_id", F.inline(M.link_issues(F.expr(URLS))))


@query("raw_url_anchor", rf"""SELECT page_id, regexp_replace({URLS}, '<(https?://[^\s>]+)>', '<a href="\1">\1</a>', 'g') AS anchored FROM pages""")
def raw_url_anchor(t):
    return t.pages.select("page_id", M.anchor_raw_urls(F.expr(URLS)).alias("anchored"))


@query("link_slugs", rf"""SELECT page_id, delta, slug, name FROM (SELECT page_id, unnest(range(len(l))) AS delta, unnest(l) AS a, regexp_extract(a, '(?is)href="([^"]*)"', 1) AS h, regexp_extract(h, '([^/]*)$', 1) AS slug,
{sql_squeeze("regexp_replace(a, '<[^>]*>', '', 'g')")} AS name FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>') AS l FROM pages)) WHERE slug <> ''""")
def link_slugs(t):
    return G.links(t.pages, "page_id", "html")


@query("strip_html", "SELECT page_id, " + sql_squeeze(r"""regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[\p{L}\p{N}_]+="[^"]*"', '', 'g'), '[\p{L}\p{N}_]+=''[^'']*''', '', 'g')""") + " AS plain FROM pages")
def strip_html(t):
    return t.pages.select("page_id", M.strip_html(F.col("html")).alias("plain"))


@query("strip_div_br", r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<div[^>]*>|</div>|<br\s*/?>', '', 'g'), '\s+', ' ', 'g'), '\s+</', '</', 'g'), '>\s+', '>', 'g')) AS cleaned FROM pages""")
def strip_div_br(t):
    return t.pages.select("page_id", M.strip_div_br(F.col("html")).alias("cleaned"))


PARAS = "concat(p_name, ' <p> </p> ', p_brand, CASE WHEN p_size % 2 = 0 THEN '<p></p>' ELSE '<p>x</p>' END)"


@query("empty_p_text", f"SELECT p_partkey, {sql_squeeze(chr(114)[:0] + 'regexp_replace(' + PARAS + ', ' + repr(chr(40) + '?i)' + chr(92) + 's*<p>' + chr(92) + 's*</p>' + chr(92) + 's*').replace(chr(92) * 2, chr(92)) + ', ' + repr('') + ', ' + repr('g') + ')')} AS cleaned FROM part")
def empty_p_text(t):
    return t.part.select("p_partkey", M.drop_empty_p(F.expr(PARAS)).alias("cleaned"))


@query("empty_p_sweep", rf"SELECT 'txt' AS column, count(*) FILTER (regexp_matches({PARAS}, '(?i)<p>\s*</p>')) AS changed FROM part UNION ALL SELECT 'absent', NULL")
def empty_p_sweep(t):
    return P.sweep_empty_p(t.part.select("p_partkey", F.expr(PARAS).alias("txt")), ["txt", "absent"])[1]


@query("title_extract", rf"""SELECT page_id, coalesce(nullif({sql_squeeze("regexp_replace(regexp_extract(html, '(?is)<h1(?:" + chr(92) + "s[^>]*)?>(.*?)</h1>', 1), '<[^>]*>', '', 'g')")}, ''), nullif({sql_squeeze("regexp_replace(regexp_extract(html, '(?is)<title(?:" + chr(92) + "s[^>]*)?>(.*?)</title>', 1), '<[^>]*>', '', 'g')")}, ''), '') AS title FROM pages""")
def title_extract(t):
    return t.pages.select("page_id", G.title(F.col("html")).alias("title"))


@query("theme_pages", r"""SELECT page_id, NULL::BIGINT AS tid, trim(replace(replace(replace(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS name, '' AS description FROM pages""")
def theme_pages(t):
    return G.themes(t.pages, "page_id", "html").drop("entry_count")


@query("entry_pages")
def entry_pages(t):
    """X2 to X5 over stored pages (no SQL: a parse of whole documents; tested on fixtures)."""
    e = G.entries(t.pages, "page_id", "html")
    return e.select("page_id", "status", "source_dataset", F.size("citations").alias("citations"), F.size("themes").alias("themes"))


#: Parts with citations and references in a text, as a dictionary has them.
CITED = "concat(p_name, ' <bibl>Molina, f. ', p_size, 'r.</bibl>  and', chr(10), '<BIBL x=\"1\"><em>', p_brand, '</em>  <i>p. ', p_partkey, '</i></BIBL> (see ', p_type, ') [cf. <b>', p_name, '</b>.] ', CASE WHEN p_size % 4 = 0 THEN '(see Karttunen 1983)' WHEN p_size % 4 = 1 THEN '(also see x)' ELSE '' END)"
BIBL_SQL = "(?is)<bibl[^>]*>.*?</bibl>"


def cited(t):
    return t.spread("part", "p_partkey").select("p_partkey", "p_size", F.expr(CITED).alias("txt"))


def sql_citations(c):
    clean = sql_squeeze(r"regexp_replace(trim(x), '>\s+<', '><', 'g')")
    return f"list_filter(list_transform(regexp_extract_all({c}, '{BIBL_SQL}'), lambda x: {clean}), lambda x: x <> '')"


CITED_SQL = f"(SELECT p_partkey, p_size::BIGINT AS p_size, {CITED} AS txt FROM part)"


@query("citations_extract", f"SELECT p_partkey, unnest(range(len(l))) AS pos, unnest(l) AS citation FROM (SELECT p_partkey, {sql_citations('txt')} AS l FROM {CITED_SQL})")
def citations_extract(t):
    return cited(t).select("p_partkey", F.posexplode(M.citations(F.col("txt"))).alias("pos", "citation"))


def sql_without(c):
    return sql_squeeze(f"regexp_replace({c}, '{BIBL_SQL}', '', 'g')")


@query("citation_columns", f"SELECT p_partkey, p_size, {sql_without('txt')} AS txt, array_to_string(l, ' | ') AS citations, len(l) AS number_of_citations FROM (SELECT *, {sql_citations('txt')} AS l FROM {CITED_SQL})")
def citation_columns(t):
    return P.citation_columns(cited(t), ["txt"])


@query("citation_stats", f"SELECT count(*) AS c_rows, count(*) FILTER (n > 0) AS c_rows_with, sum(n)::BIGINT AS c_total, max(n) AS c_max, avg(n) AS c_mean, median(n)::DOUBLE AS c_median FROM (SELECT len({sql_citations('CASE WHEN p_size % 5 = 0 THEN p_name ELSE txt END')}) AS n FROM (SELECT p_partkey, p_name, p_size, {CITED} AS txt FROM part))")
def citation_stats(t):
    n = F.size(M.citations(F.expr(f"CASE WHEN p_size % 5 = 0 THEN p_name ELSE {CITED} END")))
    return t.part.select(n.alias("n")).agg(*extraction_stats(None, F.col("n"), "c"))


@query("late_citations", f"""SELECT p_partkey, {sql_without('extra')} AS extra, CASE WHEN p_size % 2 = 0 THEN 'A | B | ' ELSE '' END || array_to_string(l, ' | ') AS citations, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 0 END + len(l) AS number_of_citations
FROM (SELECT p_partkey, p_size, txt AS extra, {sql_citations('txt')} AS l FROM {CITED_SQL})""")
def late_citations(t):
    even = F.col("p_size") % 2 == 0
    d = cited(t).select("p_partkey", F.col("txt").alias("extra"), F.when(even, "A | B").otherwise("").alias("citations"), F.when(even, 2).otherwise(0).alias("number_of_citations"))
    return P.append_citations(d, "extra")


REF_SQL = r"(?i)\((?:see|cf\.|compare|also|variant\s+of)\s+[^)]+\)|\[(?:see|cf\.)\s+[^\]]+\]"


def sql_reftype(x):
    whens = [(rf"^\(see\s+{s}", f"{s}_ref") for s in M.SCHOLARS] + [(r"^[\(\[]see\s", "see"), (r"^[\(\[]cf\.", "cf"), (r"^\(compare", "compare"), (r"^\(also\s+see\s", "also_see"), (r"^\(variant", "variant")]
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, '(?i){p}') THEN '{n}'" for p, n in whens) + " ELSE 'also' END"


def sql_reftext(x):
    inner = rf"regexp_extract({x}, '(?is)^[\(\[](?:also\s+see|see|cf\.|compare|also|variant\s+of)\s+(.*)[\)\]]$', 1)"
    clean = rf"regexp_replace({sql_squeeze(f'regexp_replace({inner}, ' + repr('<[^>]+>') + ', ' + repr('') + ', ' + repr('g') + ')')}, '^[.,;:]+|[.,;:]+$', '', 'g')"
    return rf"CASE WHEN {sql_reftype(x)} LIKE '%\_ref' ESCAPE '\' THEN regexp_replace({x}, '^[\(\[]+|[\)\]]+$', '', 'g') WHEN length({clean}) > 1 AND regexp_matches({clean}, '[\p{{L}}\p{{N}}]') THEN {clean} END"


REFS = f"(SELECT *, {sql_reftext('r')} AS text, {sql_reftype('r')} AS type FROM (SELECT p_partkey, unnest(range(len(l))) AS i, unnest(l) AS r FROM (SELECT p_partkey, regexp_extract_all(txt, '{REF_SQL}') AS l FROM {CITED_SQL})))"


@query("crossrefs_extract", f"SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey ORDER BY i) - 1 AS pos, text, type FROM {REFS} WHERE text <> ''")
def crossrefs_extract(t):
    return cited(t).select("p_partkey", F.posexplode(M.crossrefs(F.col("txt"))).alias("pos", "r")).select("p_partkey", "pos", "r.text", "r.type")


@query("crossref_columns", rf"""SELECT c.p_partkey, c.p_size, regexp_replace(regexp_replace(c.txt, '(?i) ?(?:{REF_SQL[4:]})', '', 'g'), '  +', ' ', 'g') AS txt, coalesce(s.x, '') AS cross_references, coalesce(s.n, 0) AS number_of_cross_references, coalesce(s.y, '') AS crossref_types
FROM {CITED_SQL} c LEFT JOIN (SELECT p_partkey, string_agg(text, ' | ' ORDER BY i) AS x, count(*) AS n, string_agg(DISTINCT type, ', ' ORDER BY type) AS y FROM {REFS} WHERE text <> '' GROUP BY p_partkey) s USING (p_partkey)""")
def crossref_columns(t):
    return P.crossref_columns(cited(t), ["txt"])


def sql_legacy(c):
    return "list_distinct(list_filter(list_transform(flatten([" + ", ".join(f"regexp_extract_all({c}, '{p}', 1)" for p in M.LEGACY_REFS) + "]), lambda x: trim(x)), lambda x: x <> ''))"


@query("legacy_crossrefs", f"""SELECT p_partkey, ref, CASE WHEN regexp_matches(lower(ref), 'molina|karttunen|carochi') THEN 'Scholar_Reference' WHEN len(string_split({sql_squeeze('ref')}, ' ')) = 1 THEN 'Single_Word'
WHEN len(string_split({sql_squeeze('ref')}, ' ')) <= 3 THEN 'Short_Phrase' ELSE 'Long_Phrase' END AS class FROM (SELECT p_partkey, unnest({sql_legacy('txt')}) AS ref FROM {CITED_SQL})""")
def legacy_crossrefs(t):
    return cited(t).select("p_partkey", F.explode(M.legacy_crossrefs(F.col("txt"))).alias("ref")).select("*", M.legacy_crossref_class(F.col("ref")).alias("class"))


@query("bibl_content", f"""SELECT p_partkey, CASE WHEN len(l) > 0 THEN 'txt: ' || array_to_string(l, ' | ') ELSE '' END AS bibl FROM (SELECT p_partkey, list_filter(list_transform(regexp_extract_all(txt, '{BIBL_SQL}'), lambda x: {sql_squeeze("regexp_replace(x, '<[^>]+>', '', 'g')")}), lambda x: length(x) > 5) AS l FROM {CITED_SQL})""")
def bibl_content(t):
    return cited(t).select("p_partkey", M.bibl_row({"txt": F.col("txt"), "none": F.lit(None).cast("string")}).alias("bibl"))
