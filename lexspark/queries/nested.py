"""Glosses, source lists, exports, maps and trees, on nested values made from the driver's tables."""

from pyspark.sql import functions as F

from lexspark.functions import nested as N
from lexspark.operators import trees as R
from lexspark.plans import processing as P
from lexspark.queries.registry import query
from lexspark.sources import io
from lexspark.streaming import resume


@query("gloss_flatten", """SELECT p_partkey, concat_ws(' | ', nullif(concat_ws('; ', nullif(concat_ws(', ', p_name || CASE WHEN p_size % 2 = 0 THEN ' (' || p_type || ')' ELSE '' END, CASE WHEN p_size % 3 <> 0 THEN p_brand || ' (only a hint)' END), ''), CASE WHEN p_size % 5 <> 0 THEN p_type END), ''), CASE WHEN p_size % 7 = 0 THEN 'last' END) AS gloss FROM part""")
def gloss_flatten(t):
    s = F.col("p_size")
    none = F.lit(None).cast("string")
    def item(a, h=none):
        return F.struct(a.alias("translation"), h.alias("hint"))
    first = F.array(item(F.col("p_name"), F.when(s % 2 == 0, F.col("p_type"))), item(F.when(s % 3 != 0, F.col("p_brand")), F.lit("only a hint")))
    g = F.array(F.array(first, F.array(item(F.when(s % 5 != 0, F.col("p_type")).otherwise("")))), F.array(F.array(item(F.when(s % 7 == 0, "last")))))
    return t.part.select("p_partkey", N.gloss_text(g).alias("gloss"))


AUTH = {"VLM": "CASE WHEN p_size % 2 = 0 THEN p_name END", "AND": "CASE WHEN p_size % 3 = 0 THEN p_brand ELSE 'None' END", "GML": "''", "ALM": "p_type"}
CITES = "CASE WHEN p_size % 4 = 0 THEN '' ELSE concat('Molina, f. ', p_size, 'r. | Karttunen, p. ', p_partkey, ' |  OLMOS, 12. | Molina, p. 3') END"
MATCHES = {"VLM": "molina", "AND": "karttunen", "GML": "carochi", "ALM": "olmos"}


def sql_page(c):
    ps = [r"f\.\s*([0-9]+[rv]?)", r"p\.\s*([0-9]+)", r",\s*([0-9]+[rv]?)\."]
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({c}, '{p}', 1), '')" for p in ps) + ", '')"


def sql_sources():
    parts = []
    for i, (a, x) in enumerate(AUTH.items()):
        base = f"SELECT p_partkey, {i} AS a, '{a}' AS source, {x} AS content, list_filter(list_transform(string_split({CITES}, '|'), lambda x: trim(x)), lambda x: contains(lower(x), '{MATCHES[a]}')) AS l FROM part WHERE coalesce({x}, '') NOT IN ('', 'None')"
        parts.append(f"SELECT p_partkey, a, j, source, CASE WHEN c IS NULL THEN '' ELSE {sql_page('c')} END AS page_number, CASE WHEN c IS NULL THEN content ELSE content || ' ' || c END AS original_entry FROM (SELECT *, unnest(CASE WHEN len(l) = 0 THEN [NULL] ELSE l END) AS c, unnest(range(greatest(len(l), 1))) AS j FROM ({base}))")
    return " UNION ALL ".join(parts)


@query("whp_sources", f"SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey ORDER BY a, j) - 1 AS pos, source, page_number, original_entry FROM ({sql_sources()})")
def whp_sources(t):
    s = N.authority_sources({a: F.expr(x) for a, x in AUTH.items()}, F.expr(CITES))
    return t.part.select("p_partkey", F.posexplode(s).alias("pos", "s")).select("p_partkey", "pos", "s.*")


@query("idiez_sources", "SELECT p_partkey, 'IDIEZ' AS source, '' AS page_number, CASE WHEN x = '' THEN '' ELSE x || '.' END AS original_entry FROM (SELECT p_partkey, concat_ws('. ', 'IDIEZ morfema: ' || CASE WHEN p_size % 2 = 0 THEN p_name END, 'IDIEZ def: ' || CASE WHEN p_size % 3 = 0 THEN p_type END) AS x FROM part)")
def idiez_sources(t):
    s = F.col("p_size")
    f = {"IDIEZ morfema": F.when(s % 2 == 0, F.col("p_name")), "IDIEZ def": F.when(s % 3 == 0, F.col("p_type")).otherwise("")}
    return t.part.select("p_partkey", F.inline(N.labelled_source("IDIEZ", f)))


@query("combined_export", """SELECT 'WHP-' || p_partkey AS key, '{"Headwords":"' || p_name || '","Gloss":"' || p_type || '","Language":"Classical Nahuatl","Sources":[' || CASE WHEN p_size % 2 = 0 THEN '{"source":"VLM","page_number":"' || p_size || 'r","original_entry":"' || p_brand || ' Molina, f. ' || p_size || 'r."}' ELSE '' END || ']' || CASE WHEN p_size % 3 = 0 THEN ',"Themes":["water","' || p_type || '"]' ELSE '' END || '}' AS json FROM part
UNION ALL SELECT 'IDIEZ-' || s_suppkey, '{"Headwords":"' || s_name || '","Gloss":"gloss","Language":"Huasteca Nahuatl","Sources":[{"source":"IDIEZ","page_number":"","original_entry":"IDIEZ morfema: ' || s_name || '. IDIEZ traduc. inglés: gloss."}]}' FROM supplier""")
def combined_export(t):
    s, none = F.col("p_size"), F.lit(None).cast("string")
    whp = t.part.select(F.concat(F.lit("WHP-"), "p_partkey").alias("ref"), F.col("p_name").alias("headword"), F.col("p_type").alias("principal_english_translation"), F.when(s % 2 == 0, F.col("p_brand")).alias("molina"),
                        *[none.alias(c) for c in ("karttunen", "carochi", "olmos", "lockhart")], F.concat(F.lit("Molina, f. "), s, F.lit("r.")).alias("citations"), F.when(s % 3 == 0, F.concat(F.lit("water; "), "p_type", F.lit(";"))).alias("themes"))
    idiez = t.supplier.select(F.concat(F.lit("IDIEZ-"), "s_suppkey").alias("ref"), F.col("s_name").alias("ond_node_title"), F.col("s_name").alias("tlahtolli"), F.lit("gloss").alias("traduc_ingles"), *[none.alias(c) for c in ("def_nahuatl", "def_espanol", "morfologia", "gramatica")])
    return P.export_json(whp, idiez)


@query("content_hashes", "SELECT event_id, md5('k:' || regexp_extract(props, '[0-9]+')) AS h FROM events")
def content_hashes(t):
    return t.events.select("event_id", N.content_hash(F.from_json("props", "map<string,string>")).alias("h"))


@query("event_prop_values", "SELECT DISTINCT 'k' AS key, regexp_extract(props, '[0-9]+') AS value FROM events")
def event_prop_values(t):
    return R.distinct_values(R.nodes(t.events, "event_id", "props"))


#: A record of two levels and one below, from a part: head Tamil, reflexes Telugu and Toda, children.
RECORD = """concat('{"_page": 1, "Tamil": "', p_name, '", "Tamil meaning": "', CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END, '", "Meaning": "', p_type, '", "Telugu": "', p_brand, '", "Proto-Telugu derivates": "d", "Gondwan etymology": "e', p_size, '", "_sub_entries": [{"Proto Telugu": "', p_name, ' sub", "Notes": "n"}, {"Telugu": "', p_brand, '", "Telugu meaning": null, "_sub_entries": [{"Toda": "deep", "Meaning": 7}]}]}')"""


def trees(t):
    return R.nodes(t.spread("part", "p_partkey").select("p_partkey", F.expr(RECORD).alias("record")), "p_partkey", "record")


@query("tree_flatten", """SELECT p_partkey AS root, path, depth, fields, inherited FROM (SELECT p_partkey, '' AS path, 0::BIGINT AS depth, 7::BIGINT AS fields, NULL AS inherited FROM part UNION ALL SELECT p_partkey, '0', 1, 2, p_type FROM part UNION ALL SELECT p_partkey, '1', 1, 2, p_type FROM part UNION ALL SELECT p_partkey, '1.0', 2, 2, p_type FROM part)""")
def tree_flatten(t):
    return trees(t).select("root", F.array_join("path", ".").alias("path"), "depth", F.size("fields").alias("fields"), "inherited")


CENSUS = " UNION ALL ".join(f"SELECT '{k}' AS key, {n} * count(*) AS n, '{kind}' AS kind FROM part" for k, n, kind in (
    ("_page", 1, "metadata"), ("Tamil", 1, "language"), ("Tamil meaning", 1, "language"), ("Meaning", 2, "common"), ("Telugu", 2, "language"), ("Proto-Telugu derivates", 1, "language"), ("Gondwan etymology", 1, "language"),
    ("Proto Telugu", 1, "language"), ("Notes", 1, "common"), ("Telugu meaning", 1, "language"), ("Toda", 1, "language")))


@query("map_keys_census", CENSUS)
def map_keys_census(t):
    return R.key_census(trees(t))


STRUCTURE = "(SELECT regexp_replace(key, ' (meaning|derivates|etymology)$', '') AS language, coalesce(sum(n) FILTER (NOT regexp_matches(key, ' (meaning|derivates|etymology)$')), 0)::BIGINT AS count, bool_or(key LIKE '% meaning') AS has_meaning, bool_or(key LIKE '% derivates') AS has_derivates, bool_or(key LIKE '% etymology') AS has_etymology FROM (" + CENSUS + ") WHERE key NOT IN ('_page', 'Meaning', 'Notes', 'Gondwan etymology') GROUP BY 1)"


@query("language_structure", f"SELECT * FROM {STRUCTURE}")
def language_structure(t):
    return R.language_structure(R.key_census(trees(t)))


@query("merged_variants", f"SELECT trim(replace(language, '-', ' ')) AS canonical, sum(count)::BIGINT AS count, bool_or(has_meaning) AS has_meaning, bool_or(has_derivates) AS has_derivates, bool_or(has_etymology) AS has_etymology, string_agg(language, '; ' ORDER BY language) AS variants FROM {STRUCTURE} GROUP BY 1")
def merged_variants(t):
    return R.merged_variants(R.language_structure(R.key_census(trees(t))))


@query("language_entries", """SELECT p_partkey AS root, '' AS path, 0::BIGINT AS depth, p_brand AS "Word", p_type AS "Meaning", 'd' AS "Derivates", 'e' || p_size AS "Etymology", '' AS "Notes", '' AS "Number in DED" FROM part
UNION ALL SELECT p_partkey, '0', 1, p_name || ' sub', p_type, '', '', 'n', '' FROM part UNION ALL SELECT p_partkey, '1', 1, p_brand, p_type, '', '', '', '' FROM part""")
def language_entries(t):
    return R.language_entries(trees(t), ["Telugu", "Proto-Telugu", "Proto Telugu"]).withColumn("path", F.array_join("path", "."))


@query("language_summary", "SELECT 'Telugu' AS language, 2 * count(*) AS entries, count(DISTINCT p_brand) AS unique_words, 2 * count(*) AS with_meaning FROM part")
def language_summary(t):
    return R.language_summary(R.language_entries(trees(t), ["Telugu"]), "Telugu")


HEADS = """WITH x AS (SELECT p_partkey AS root, '' AS path, NULL AS parent, 0::BIGINT AS pos, 'TAM' AS abbr, p_name AS word, 'Tamil' AS lang, NULL AS pword FROM part UNION ALL SELECT p_partkey, '1', '', 0, 'TEL', p_brand, 'Telugu', p_name FROM part UNION ALL SELECT p_partkey, '1.0', '1', 0, 'TOD', 'deep', 'Toda', p_brand FROM part)
SELECT root, path, pos, abbr || lpad((row_number() OVER (PARTITION BY abbr ORDER BY root))::VARCHAR, greatest(3, length((row_number() OVER (PARTITION BY abbr ORDER BY root))::VARCHAR))::INT, '0') AS "ID", word AS "Headword", lang AS "Language", pword AS "Parent Word" FROM x"""


@query("heads_reflexes", HEADS)
def heads_reflexes(t):
    return R.heads_and_reflexes(trees(t)).select("root", F.array_join("path", ".").alias("path"), "pos", "ID", "Headword", "Language", "Parent Word")


#: Events as records scraped with child lists.
SCRAPED = """SELECT event_id AS node_id, CASE event_type WHEN 'error' THEN 'error' ELSE 'success' END AS status, event_type AS headword,
array(named_struct('authority_name', 'Molina', 'citation_text', props, 'citation_order', 0)) AS citations, CASE WHEN user_id % 2 = 0 THEN array(named_struct('language', 'English', 'attestation_text', event_type, 'source_field', 'f')) ELSE array() END AS attestations,
array(named_struct('theme_slug', event_type, 'theme_name', 'x', 'delta', 0), named_struct('theme_slug', 'all', 'theme_name', 'y', 'delta', 1)) AS themes, array(named_struct('audio_node_id', user_id, 'reference_type', 'headword', 'delta', 0)) AS audio FROM events"""


def store(t):
    t.events.createOrReplaceTempView("events")
    return io.normalised(t.spark.sql(SCRAPED))


@query("normalised_explode", "SELECT 'entry_themes' AS \"table\", event_id AS node_id, event_type AS item FROM events WHERE event_type <> 'error' UNION ALL SELECT 'entry_themes', event_id, 'all' FROM events WHERE event_type <> 'error' UNION ALL SELECT 'authority_citations', event_id, props FROM events WHERE event_type <> 'error' UNION ALL SELECT 'attestations', event_id, event_type FROM events WHERE event_type <> 'error' AND user_id % 2 = 0 UNION ALL SELECT 'entry_audio', event_id, user_id::VARCHAR FROM events WHERE event_type <> 'error' UNION ALL SELECT 'dictionary_entries', event_id, event_type FROM events WHERE event_type <> 'error'")
def normalised_explode(t):
    s, value = store(t), {"entry_themes": "theme_slug", "authority_citations": "citation_text", "attestations": "attestation_text", "entry_audio": "audio_node_id", "dictionary_entries": "headword"}
    out = None
    for name, c in value.items():
        one = s[name].select(F.lit(name).alias("table"), "node_id", F.col(c).cast("string").alias("item"))
        out = one if out is None else out.unionByName(one)
    return out


@query("store_violations", "SELECT 'entry_themes.theme_slug' AS check, 'all' AS key UNION ALL SELECT DISTINCT 'entry_audio.audio_node_id', user_id::VARCHAR FROM events WHERE event_type <> 'error' AND user_id % 5 = 0 UNION ALL SELECT 'dictionary_entries.source_dataset', event_id::VARCHAR FROM events WHERE event_type = 'view'")
def store_violations(t):
    s = store(t)
    tables = {**s, "entry_themes": s["entry_themes"].withColumnRenamed("node_id", "entry_node_id"), "entry_audio": s["entry_audio"].withColumnRenamed("node_id", "entry_node_id"),
              "themes": t.events.select(F.col("event_type").alias("slug")).distinct(), "audio_files": t.events.filter("user_id % 5 <> 0").select(F.col("user_id").alias("node_id")).distinct(),
              "dictionary_entries": s["dictionary_entries"].withColumn("source_dataset", F.when(F.col("headword") == "view", "OTHER").otherwise("WHP"))}
    return P.store_violations(tables)


@query("source_multiply", """SELECT p_partkey::VARCHAR AS base_ref, p_partkey::VARCHAR AS ref, '' AS source_title, 'base' AS entry_type FROM part
UNION ALL SELECT p_partkey::VARCHAR, p_partkey || '_alonso_molina', 'Alonso Molina', 'source' FROM part WHERE p_size % 6 = 0 UNION ALL SELECT p_partkey::VARCHAR, p_partkey || '_olmos', 'Olmos', 'source' FROM part WHERE p_size % 6 = 0""")
def source_multiply(t):
    d = t.part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("Alonso Molina"), F.when(F.col("p_size") % 3 == 0, F.col("p_type")).otherwise(" ").alias("Olmos"))
    return P.multiply_by_source(d, "p_partkey", ["Alonso Molina", "Olmos"])


@query("stream_resume")
def stream_resume(t):
    """The events as a stream of files, each event type's first batch, resumed at its checkpoint (no SQL: a running query)."""
    import tempfile
    import uuid

    base = t.spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not t.spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="lexspark-")
    at = f"{base}/lexspark/stream-{uuid.uuid4().hex}"
    t.events.select("event_id", "event_type", "user_id").repartition(4).write.parquet(f"{at}/in")
    source = resume.stream_parquet(t.spark, f"{at}/in", t.spark.read.parquet(f"{at}/in").schema, 2)
    for _ in range(2):
        resume.run_available(source, resume.write_batches(f"{at}/out"), f"{at}/checkpoint")
    return t.spark.read.parquet(f"{at}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("events"))
