"""Declared schemas: the wide dictionary tables, the normalised store, nested records and logs."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_TYPES = {"string": StringType(), "bigint": LongType(), "int": IntegerType(), "double": DoubleType(), "timestamp": TimestampType()}


def fields(ddl: str) -> StructType:
    """A flat schema from 'name type, …', without a session."""
    return StructType([StructField(n, _TYPES[t]) for n, t in (x.split() for x in ddl.split(","))])


WHP_COLUMNS = {
    "ref": "Ref", "headword": "Headword", "orthographic_variants": "Orthographic Variants", "principal_english_translation": "Principal English Translation",
    "attestations_english": "Attestations from sources in English", "attestations_spanish": "Attestations from sources in Spanish", "molina": "Alonso de Molina",
    "karttunen": "Frances Karttunen", "carochi": "Horacio Carochi / English", "olmos": "Andrés de Olmos", "lockhart": "Lockhart’s Nahuatl as Written", "themes": "themes", "spanish_loanword": "Spanish Loanword"}
CONTENT_COLUMNS = ["principal_english_translation", "attestations_english", "attestations_spanish", "molina", "karttunen", "carochi", "olmos", "lockhart"]

WHP = fields(", ".join(f"{c} string" for c in WHP_COLUMNS))
IDIEZ = fields("ref string, ond_node_title string, tlahtolli string, gramatica string, def_nahuatl string, def_espanol string, sshort string, traduc_ingles string, morfologia string, credit string")

STORE = {k: fields(v) for k, v in {
    "dictionary_entries": "node_id bigint, headword string, orthographic_variants string, ipa_spelling string, translation_english string, spanish_loanword string, headword_idiez string, "
                          "translation_english_idiez string, definition_nahuatl_idiez string, definition_spanish_idiez string, morfologia_idiez string, gramatica_idiez string, source_dataset string, url_alias string, created_timestamp string, scrape_timestamp string",
    "authority_citations": "node_id bigint, authority_name string, citation_text string, citation_order int",
    "attestations": "node_id bigint, language string, attestation_text string, source_field string",
    "themes": "tid bigint, name string, slug string, description string, vocabulary_id int",
    "entry_themes": "entry_node_id bigint, theme_slug string, theme_name string, delta int",
    "audio_files": "node_id bigint, headword string, file_wav string, file_mp3 string, file_aif string, speaker string, date_recorded string, url_alias string, scrape_timestamp string",
    "entry_audio": "entry_node_id bigint, audio_node_id bigint, reference_type string, delta int"}.items()}

#: (child, column, parent, column) of the store's foreign keys.
FOREIGN_KEYS = [("authority_citations", "node_id", "dictionary_entries", "node_id"), ("attestations", "node_id", "dictionary_entries", "node_id"),
                ("entry_themes", "entry_node_id", "dictionary_entries", "node_id"), ("entry_themes", "theme_slug", "themes", "slug"),
                ("entry_audio", "entry_node_id", "dictionary_entries", "node_id"), ("entry_audio", "audio_node_id", "audio_files", "node_id")]
ALLOWED = {("dictionary_entries", "source_dataset"): ["WHP", "IDIEZ", "HYBRID"], ("authority_citations", "authority_name"): [*"Molina Karttunen Carochi Olmos Lockhart Other".split()],
           ("attestations", "language"): ["English", "Spanish"], ("entry_audio", "reference_type"): ["headword", "example"]}
EXPORT = ("Headwords string, Gloss string, Language string, Sources array<struct<source:string,page_number:string,original_entry:string>>, Themes array<string>")
CHECKPOINT = fields("checkpoint_name string, table_name string, timestamp timestamp, row_count bigint, column_count int, columns string")
LOG = fields("stage string, status string, duration_seconds double, rows bigint, notes string, timestamp timestamp")
CHANGES = fields("key string, field string, action string, old_value string, new_value string")
