"""Text, key and number functions, projections and predicates."""

from pyspark.sql import functions as F

from lexspark.functions import markup as M
from lexspark.functions import nested as N
from lexspark.functions import nulls as U
from lexspark.functions import text as T
from lexspark.operators import diff as D
from lexspark.operators.aggregate import value_counts
from lexspark.queries.markup import sql_squeeze
from lexspark.queries.registry import query
from lexspark.sources import io

#: Cells as a spreadsheet export has them: tokens for null, blanks, white space.
RAW = "CASE p_size % 8 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN 'None' WHEN 4 THEN 'n/a' WHEN 5 THEN ' NA ' ELSE p_name END"
NA = ", ".join(f"'{x}'" for x in U.NA_TOKENS)


@query("null_tokens", f"SELECT p_partkey, CASE WHEN raw NOT IN ({NA}) THEN raw END AS raw FROM (SELECT p_partkey, {RAW} AS raw FROM part)")
def null_tokens(t):
    return U.null_tokens(t.part.select("p_partkey", F.expr(RAW).alias("raw")))


@query("blank_flags", f"SELECT p_partkey, trim(raw) = '' AS blank, trim(raw) IN ('', 'None') AS blank_or_none FROM (SELECT p_partkey, {RAW} AS raw FROM part)")
def blank_flags(t):
    r = F.expr(RAW)
    return t.part.select("p_partkey", U.is_blank(r).alias("blank"), U.is_blank(r, True).alias("blank_or_none"))


@query("null_fill", f"SELECT p_partkey, coalesce(CASE WHEN raw NOT IN ({NA}) THEN raw END, '') AS raw FROM (SELECT p_partkey, {RAW} AS raw FROM part)")
def null_fill(t):
    return U.fill_blank(U.null_tokens(t.part.select("p_partkey", F.expr(RAW).alias("raw"))))


NUM = "CASE p_size % 4 WHEN 0 THEN p_size::VARCHAR WHEN 1 THEN p_brand WHEN 2 THEN concat(' ', p_size, '.75') ELSE NULL END"


@query("coerced_numbers", f"SELECT p_partkey, coalesce(trunc(try_cast(trim({NUM}) AS DOUBLE))::BIGINT, 0) AS n FROM part")
def coerced_numbers(t):
    return t.part.select("p_partkey", U.coerce_int(F.expr(NUM.replace("p_size::VARCHAR", "string(p_size)"))).alias("n"))


@query("wide_projection", "SELECT p_brand AS \"Brand/Marke\", p_partkey AS ref, p_name AS headword FROM part WHERE p_type IN ('SMALL', 'ECONOMY') AND p_size >= 10")
def wide_projection(t):
    d = io.select_where(t.part, ["p_brand", "p_partkey", "p_name"], "p_type IN ('SMALL', 'ECONOMY') AND p_size >= 10")
    return d.withColumnsRenamed({"p_brand": "Brand/Marke", "p_partkey": "ref", "p_name": "headword"})


@query("dropped_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def dropped_columns(t):
    d = t.orders.withColumn("Unnamed: 7", F.lit(None).cast("string"))
    return d.select([F.col(f"`{c}`") for c in d.columns if not c.startswith("Unnamed")]).drop("o_totalprice", "o_orderdate", "o_orderpriority")


@query("top_limit", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_limit(t):
    return t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


REF = "concat(CASE WHEN c_custkey % 3 = 0 THEN 'WHP-' WHEN c_custkey % 3 = 1 THEN 'IDIEZ-' ELSE '' END, c_custkey)"


@query("key_strip", f"SELECT c_custkey, regexp_replace({REF}, '^(WHP|IDIEZ)-', '') AS node_id FROM customer")
def key_strip(t):
    return t.customer.select("c_custkey", T.key_strip(F.expr(REF)).alias("node_id"))


@query("squeezed_equality", f"SELECT doc_id, {sql_squeeze("coalesce(text, '')")} = {sql_squeeze("replace(coalesce(text, ''), chr(10), '  ')")} AS same FROM documents")
def squeezed_equality(t):
    c = F.col("text")
    return t.documents.select("doc_id", T.same_text(c, F.replace(c, F.lit("\n"), F.lit("  "))).alias("same"))


@query("safe_names", r"SELECT DISTINCT url, regexp_replace(regexp_replace(url, '[^a-zA-Z0-9_()-]', '_', 'g'), '_+', '_', 'g') AS name, regexp_replace(page_id || '_' || regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1), '[^\p{L}\p{N}_.-]', '_', 'g') AS audio FROM pages")
def safe_names(t):
    u = F.col("url")
    return t.pages.select("url", T.safe_name(u).alias("name"), T.audio_name(F.col("page_id"), u).alias("audio")).distinct()


PARSED = "concat('article node-', c_custkey, ' page-node-', c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN ' 12 results' WHEN c_custkey % 5 = 1 THEN ' 7  Entries' ELSE '' END)"


@query("slug_ids", rf"""SELECT c_custkey, try_cast(regexp_extract({PARSED}, '(?:page-node-|taxonomy-term-|node-|/node/)([0-9]+)', 1) AS BIGINT) AS id, coalesce(try_cast(regexp_extract({PARSED}, '(?i)([0-9]+)\s+(?:results|entries|items)', 1) AS BIGINT), c_nationkey) AS entries,
upper(left(lower(c_mktsegment), 1)) || substr(lower(c_mktsegment), 2) || ' Goods' AS title FROM customer""")
def slug_ids(t):
    p = F.expr(PARSED)
    return t.customer.select("c_custkey", T.prefixed_id(p).alias("id"), T.entry_count(p, F.col("c_nationkey")).alias("entries"), T.slug_title(F.concat(F.lower("c_mktsegment"), F.lit("-goods"))).alias("title"))


@query("headword_cleanup", "SELECT p_partkey, trim(regexp_replace(p_name || ' ' || repeat('.', p_size % 3), '[.]+$', '')) AS headword FROM part")
def headword_cleanup(t):
    return t.part.select("p_partkey", T.headword(F.concat("p_name", F.lit(" "), F.repeat(F.lit("."), F.col("p_size") % 3))).alias("headword"))


@query("percentages", "SELECT o_orderstatus AS status, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 1)::DOUBLE AS pct FROM orders GROUP BY 1")
def percentages(t):
    c = value_counts(t.orders, F.col("o_orderstatus"), "status")
    return c.crossJoin(F.broadcast(c.agg(F.sum("count").alias("t")))).select("status", T.percent(F.col("count"), F.col("t")).alias("pct"))


@query("timestamps", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, strftime(ts, '%Y%m%d') AS day FROM events")
def timestamps(t):
    return t.events.select("event_id", T.stamp(F.col("ts")).alias("stamp"), T.stamp(F.col("ts"), False).alias("day"))


@query("dict_lookup", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'BLD' WHEN 'MACHINERY' THEN 'MCH' ELSE 'UNK' END AS abbr FROM customer")
def dict_lookup(t):
    return t.customer.select("c_custkey", N.lookup(F.col("c_mktsegment"), {"BUILDING": "BLD", "MACHINERY": "MCH"}, "UNK").alias("abbr"))


@query("source_classes", "SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_nationkey % 2 = 0 THEN 'HYBRID' WHEN c_nationkey % 2 = 0 THEN 'IDIEZ' WHEN c_acctbal > 0 THEN 'WHP' ELSE 'UNKNOWN' END AS class FROM customer")
def source_classes(t):
    return t.customer.select("c_custkey", N.source_class(F.col("c_acctbal") > 0, F.col("c_nationkey") % 2 == 0).alias("class"))


@query("page_numbers", r"""SELECT p_partkey, coalesce(nullif(regexp_extract(c, 'f\.\s*([0-9]+[rv]?)', 1), ''), nullif(regexp_extract(c, 'p\.\s*([0-9]+)', 1), ''), nullif(regexp_extract(c, ',\s*([0-9]+[rv]?)\.', 1), ''),
nullif(regexp_extract(c, ',\s*([0-9]+–[0-9]+)', 1), ''), nullif(regexp_extract(c, '([0-9]+–[0-9]+)\.', 1), ''), nullif(regexp_extract(c, 'vol\.\s*[0-9]+,\s*([0-9]+–[0-9]+)', 1), ''), '') AS page,
CASE WHEN contains(lower(c), 'molina') THEN 'VLM' WHEN contains(lower(c), 'karttunen') THEN 'AND' WHEN contains(lower(c), 'carochi') THEN 'GML' WHEN contains(lower(c), 'olmos') THEN 'ALM' WHEN contains(lower(c), 'lockhart') THEN 'NWN' END AS authority
FROM (SELECT p_partkey, @@ AS c FROM part)""".replace("@@", (CITE := "CASE p_size % 6 WHEN 0 THEN concat('Molina, f. ', p_size, 'r.') WHEN 1 THEN concat('KARTTUNEN, pp. ', p_size, ', 3.') WHEN 2 THEN concat('Carochi (1645), ', p_size, '.') WHEN 3 THEN concat('Lockhart, ', p_size, '–', p_size + 1) WHEN 4 THEN concat('see Olmos vol. ', p_size, ' ', p_size, '–9.') ELSE p_name END")))
def page_numbers(t):
    c = F.expr(CITE)
    return t.part.select("p_partkey", N.page_number(c).alias("page"), N.authority(c).alias("authority"))


#: Two versions of every document's text.
OLD = "CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN replace(text, '.', '') WHEN 2 THEN replace(text, 'en', 'ne') WHEN 3 THEN concat(text, ' | added | x') ELSE NULL END"
VERSIONS = f"(SELECT doc_id, text AS a, {OLD} AS b, coalesce({OLD}, '') AS b0 FROM documents)"


def versions(t):
    return t.documents.select("doc_id", F.col("text").alias("a"), F.expr(OLD).alias("b"))


def sql_items(x):
    return f"list_distinct(list_filter(list_transform(string_split({x}, '|'), lambda x: trim(x)), lambda x: x <> ''))"


SQL_FIRST = "CASE WHEN a <> b0 THEN list_position(list_transform(list_zip(string_split(a, ''), string_split(b0, '')), lambda z: z[1] IS DISTINCT FROM z[2]), true)::BIGINT - 1 END"


def sql_punct(x):
    return sql_squeeze(f"translate({x}, '.,;:!?', '')")


PUNCT_ONLY = f"(a <> b0 AND {sql_punct('a')} = {sql_punct('b0')})"
ACTION = f"CASE WHEN trim(a) = '' AND trim(b0) <> '' THEN 'use_local' WHEN trim(b0) = '' AND trim(a) <> '' THEN 'use_scraped' WHEN {PUNCT_ONLY} THEN 'use_scraped' ELSE 'manual_review' END"


def sql_itemdiff():
    def side(label, x, y):
        return f"CASE WHEN len({(d := f'list_filter({sql_items(x)}, lambda v: NOT list_contains({sql_items(y)}, v))')}) > 0 THEN '{label}: ' || array_to_string(list_sort({d}), ' | ') END"
    return f"CASE WHEN contains(a, '|') OR contains(b0, '|') THEN nullif(concat_ws(' || ', {side('ADDED', 'a', 'b0')}, {side('REMOVED', 'b0', 'a')}), '') END"


LEN = "(length(a) - length(b0))"
LENGTH_DIFF = f"CASE WHEN {LEN} = 0 THEN '0' WHEN {LEN} > 0 THEN '+' || {LEN} ELSE {LEN}::VARCHAR END"
CONTEXT = "CASE WHEN p IS NOT NULL THEN 'Scraped: ...' || substr(a, greatest(p - 30, 0) + 1, least(length(a), p + 30) - greatest(p - 30, 0)) || '... | Local: ...' || CASE WHEN p < length(b0) THEN substr(b0, greatest(p - 30, 0) + 1, greatest(least(length(a), p + 30) - greatest(p - 30, 0), 0)) ELSE substr(b0, greatest(p - 30, 0) + 1) END || '...' END"


@query("text_differences", f"SELECT doc_id, {sql_itemdiff()} AS item_diff, {LENGTH_DIFF} AS length_diff, p AS first_diff, {CONTEXT} AS context, {PUNCT_ONLY} AS punctuation_only, {ACTION} AS action FROM (SELECT *, {SQL_FIRST} AS p FROM {VERSIONS})")
def text_differences(t):
    a, b = F.col("a"), F.col("b")
    return versions(t).select("doc_id", T.item_diff(a, b).alias("item_diff"), T.length_diff(a, b).alias("length_diff"), T.first_diff(a, b).alias("first_diff"), T.diff_context(a, b).alias("context"),
                              T.punctuation_only(a, b).alias("punctuation_only"), T.recommended_action(a, b).alias("action"))


@query("mismatch_report", f"""SELECT key, field, new_value, old_value, {PUNCT_ONLY} AS punctuation_only_diff, {ACTION} AS recommended_action, {sql_itemdiff()} AS item_diff, {LENGTH_DIFF} AS char_length_diff, p AS first_diff_at, {CONTEXT} AS diff_context
FROM (SELECT *, {SQL_FIRST} AS p FROM (SELECT doc_id::VARCHAR AS key, 'text' AS field, a AS new_value, b AS old_value, a, b0 FROM {VERSIONS}) WHERE {sql_squeeze('a')} <> {sql_squeeze('b0')})""")
def mismatch_report(t):
    v = versions(t)
    cells = D.pairs(v.withColumnRenamed("a", "text"), v.select(F.concat(F.lit("WHP-"), "doc_id").alias("ref"), "b"), {"text": "b"}, "doc_id", "ref")
    return D.mismatch_report(cells)


@query("attestation_match", """SELECT doc_id, coalesce(array_to_string(list_filter(list_filter(list_transform(string_split(concat(lang, ';', source, '; en;the'), ';'), lambda x: trim(x)), lambda x: x <> ''), lambda x: contains(trim(text), x)), ';'), '') AS matched FROM documents""")
def attestation_match(t):
    return t.documents.select("doc_id", F.array_join(N.matched_attestations(F.concat("lang", F.lit(";"), "source", F.lit("; en;the")), F.col("text")), ";").alias("matched"))


@query("tag_whitelist", "SELECT page_id, regexp_matches(html, '(?i)href\\s*=\\s*(?:\"[^\"'']*[\"'']|''[^\"'']*[\"''])') AS href FROM pages")
def tag_whitelist(t):
    return t.pages.select("page_id", M.has_href(F.col("html")).alias("href"))
