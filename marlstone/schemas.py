"""Schemas of the engine's tables, as DDL."""

MANIFEST = "image_path string, output_text string, chandra_raw string, source string, img_w int, img_h int"
HASH_INDEX = "key string, sig bigint, sig_hex string, batch_id bigint"
OUTCOME = "page_uri string, source_file string, status string, error string"
