"""Schemas of the tables and their encoded values, as DDL for readers and tests."""

from __future__ import annotations

URLS = "id BIGINT, url STRING, context STRING, batch_id STRING, score DOUBLE, c_score DOUBLE, description STRING, flags INT, host_link_size INT, line_number_in_file INT, rank INT, resource_type STRING, resource_type_src INT, update_info STRING, doc_id BIGINT, registry_id BIGINT"
PAPER = "id BIGINT, file_path STRING, pubmed_id STRING, pmc_id STRING, doi STRING, title STRING, journal_title STRING, pubdate STRING"
REGISTRY = "id BIGINT, nif_id STRING, resource_name STRING, abbrev STRING, synonym STRING, url STRING, alt_url STRING, old_url STRING, availability STRING, description STRING, resource_type STRING, relatedto STRING, supercategory STRING, keyword STRING, resource_type_ids STRING, parent_organization STRING, supporting_agency STRING, curation_status STRING, date_created INT, date_updated INT, uuid STRING"
CANDIDATE = "id BIGINT, url_id BIGINT, batch_id STRING, score DOUBLE, resource_type STRING, title STRING, description STRING, status STRING, mod_time TIMESTAMP_NTZ"
ENTITY_MENTION = "id BIGINT, entity STRING, context STRING, start_idx INT, end_idx INT, c_score DOUBLE, flags INT, doc_id BIGINT, registry_id BIGINT"
REFERENCE = "id BIGINT, pubmed_id STRING, publisher_doc_id STRING, title STRING, publication_name STRING, publication_date STRING, genre STRING, authors STRING, mesh_headings STRING, description STRING, c_score DOUBLE, flags INT, publisher_id BIGINT, query_log_id BIGINT, registry_id BIGINT"
SITE_CONTENT = "id BIGINT, registry_id BIGINT, content STRING, title STRING, redirect_url STRING, flags INT, last_mod_time TIMESTAMP_NTZ"
PUBLISHER = "id BIGINT, publisher_name STRING, api_key STRING, connections_allowed INT"
QUERY_LOG = "id BIGINT, query_str STRING, exec_time TIMESTAMP_NTZ, publisher_id BIGINT, registry_id BIGINT"
VALIDATION = "id BIGINT, registry_id BIGINT, is_up BOOLEAN, message STRING, last_checked_time TIMESTAMP_NTZ"
COMBINED = "pubmed_id STRING, nif_id STRING, registry_id BIGINT, src STRING, confidence DOUBLE"
URL_STATUS = "id BIGINT, url_id BIGINT, alive BOOLEAN, flags INT, type INT, last_mod_time TIMESTAMP_NTZ"
DOWN_SITE = "nif_id STRING, num_of_consecutive_checks INT, message STRING, label STRING, batch_id STRING"
UPDATE_STATUS = "registry_id BIGINT, batch_id STRING, similarity DOUBLE, containment DOUBLE, cos_similarity DOUBLE, sem_similarity DOUBLE, update_year STRING, update_line STRING"
ACRONYMS = "pubmed_id STRING, acronym STRING, expansion STRING"
CHECKPOINT = "table_name STRING, batch_id STRING, status STRING, pk_value BIGINT, op_date TIMESTAMP_NTZ"
JOB_LOG = "batch_id STRING, operation STRING, status STRING, mod_time TIMESTAMP_NTZ"

# Bits of the flags columns.
REFERENCE_FLAGS = {"unique": 1, "url_search": 2}
URL_FLAGS = {"from_registry": 1, "from_similar": 2, "from_host": 4}
STATUS_FLAGS = {"checked": 1, "inferred": 2, "bad_url": 4}
STATUS_TYPES = {"journal": 1, "publisher": 2, "institution": 4, "supplement": 8}
CONTENT_FLAGS = {"original": 1, "latest": 2}
