"""Composite pipelines over whole tables."""

from pyspark.sql import functions as F

from lexspark.functions import markup as M
from lexspark.plans import processing as P
from lexspark.queries.markup import CITED, REF_SQL, URLS, WRAPPED, sql_citations, sql_mismatches, sql_repair, sql_rows, sql_type, sql_without
from lexspark.queries.registry import query

LIST = "list_filter(regexp_extract_all({c}, '<[^<>]*>'), lambda x: " + sql_type("x") + " = 'non_html')"


def sql_encode(c):
    return f"list_reduce(list_distinct({LIST.format(c=c)}), lambda acc, x: replace(acc, x, replace(replace(x, '<', '&lt;'), '>', '&gt;')), {c})"


def sql_literals(c):
    for a, b in M.LITERALS:
        c = f"replace({c}, '{a}', '{b}')"
    return c


@query("html_repair", rf"""SELECT p_partkey, {sql_encode('x')} AS txt FROM (SELECT p_partkey, regexp_replace({sql_repair(sql_literals('txt'))}, '<(https?://[^\s>]+)>', '<a href="\1">\1</a>', 'g') AS x FROM (SELECT p_partkey, concat('<bobl>x</bobl> <p<', p_name, '<http://a.b/', p_partkey, '> ', {WRAPPED}) AS txt FROM part))""")
def html_repair(t):
    d = t.spread("part", "p_partkey").select("p_partkey", F.expr(f"concat('<bobl>x</bobl> <p<', p_name, '<http://a.b/', p_partkey, '> ', {WRAPPED})").alias("txt"))
    return P.repair_html(d, ["txt"])


@query("union_reports", rf"""WITH p AS (SELECT page_id, {URLS} AS txt FROM pages)
SELECT page_id, 'txt' AS column, tag AS item, suggestion, NULL::BIGINT AS opens, NULL::BIGINT AS closes, 'malformed' AS issue_type FROM {sql_rows('p', 'page_id', 'txt')}
UNION ALL SELECT page_id, 'txt', unnest({LIST.format(c='txt')}), NULL, NULL, NULL, 'non_html' FROM p
UNION ALL SELECT page_id, 'txt', unnest(regexp_extract_all(txt, '<(https?://[^\s>]+)>', 1)), NULL, NULL, NULL, 'link_raw_url' FROM p
UNION ALL SELECT page_id, 'txt', a, NULL, NULL, NULL, 'link_missing_href' FROM (SELECT page_id, unnest(regexp_extract_all(txt, '(?i)<a([^>]*)>', 1)) AS a FROM p) WHERE NOT regexp_matches(a, '(?i)href\s*=\s*["''][^"'']*["'']')
UNION ALL SELECT page_id, 'txt', 'a', NULL, o, c, 'link_unbalanced' FROM (SELECT page_id, len(regexp_extract_all(txt, '(?i)<a[^>]*>')) AS o, len(regexp_extract_all(txt, '(?i)</a>')) AS c FROM p) WHERE o <> c""")
def union_reports(t):
    return P.unified_report(t.pages.select("page_id", F.expr(URLS).alias("txt")), "page_id", ["txt"])


@query("attestation_matrix", """WITH m AS (SELECT att, src, len(list_filter(list_filter(list_transform(string_split(a, ';'), lambda x: trim(x)), lambda x: x <> ''), lambda x: contains(trim(s), x))) AS m FROM
(SELECT 'att1' AS att, p_name || '; zzz' AS a, p_partkey, p_name || ' ' || p_brand AS s1, coalesce(CASE WHEN p_size % 2 = 0 THEN p_type END, '') AS s2 FROM part UNION ALL SELECT 'att2', p_brand || ';' || p_type, p_partkey, p_name || ' ' || p_brand, coalesce(CASE WHEN p_size % 2 = 0 THEN p_type END, '') FROM part) UNPIVOT (s FOR src IN (s1, s2)))
SELECT att AS attestation, src AS source, count(*) FILTER (m > 0) AS rows_matching, round(count(*) FILTER (m > 0) * 100.0 / count(*), 2)::DOUBLE AS pct, sum(m)::BIGINT AS matches FROM m GROUP BY 1, 2""")
def attestation_matrix(t):
    d = t.part.select(F.concat("p_name", F.lit("; zzz")).alias("att1"), F.concat("p_brand", F.lit(";"), "p_type").alias("att2"), F.concat("p_name", F.lit(" "), "p_brand").alias("s1"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("s2"))
    return P.attestation_matrix(d, ["att1", "att2"], ["s1", "s2"])


@query("quality_workflow", rf"""WITH c AS (SELECT p_partkey, {sql_citations('txt')} AS l, {sql_without('txt')} AS txt FROM (SELECT p_partkey, {CITED} AS txt FROM part))
SELECT count(*) AS entries, sum(len(l))::BIGINT AS citations, sum(len(list_filter(regexp_extract_all(txt, '{REF_SQL}'), lambda x: x <> '(also see x)')))::BIGINT AS crossrefs, count(*) FILTER (contains(txt, '(') OR contains(txt, '[')) AS with_refs FROM c""")
def quality_workflow(t):
    from lexspark.queries.markup import cited
    d = P.citation_columns(cited(t), ["txt"])
    before = d.withColumn("with_refs", F.contains("txt", F.lit("(")) | F.contains("txt", F.lit("[")))
    done = P.crossref_columns(before, ["txt"])
    return done.agg(F.count("*").alias("entries"), F.sum(F.col("number_of_citations").cast("bigint")).alias("citations"), F.sum(F.col("number_of_cross_references").cast("bigint")).alias("crossrefs"), F.count_if("with_refs").alias("with_refs"))


@query("mismatch_trend", "SELECT tag, count(*) AS pages, sum(open_count)::BIGINT AS opened, sum(close_count)::BIGINT AS closed FROM " + sql_mismatches("page_id", "pages", "html") + " GROUP BY tag")
def mismatch_trend(t):
    return t.pages.select(F.inline(M.mismatches(F.col("html")))).groupBy("tag").agg(F.count("*").alias("pages"), F.sum(F.col("open_count").cast("bigint")).alias("opened"), F.sum(F.col("close_count").cast("bigint")).alias("closed"))
