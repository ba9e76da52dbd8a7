"""Types of the spans, mappings and text records that the jobs exchange."""

ENTITY = (
    "struct<text:string,label:string,start_pos:int,end_pos:int,confidence:double,source:string>"
)
ENTITIES = f"array<{ENTITY}>"
MAPPING_ENTRY = "struct<placeholder:string,original:string>"
MAPPING = f"array<{MAPPING_ENTRY}>"

TEXTS = (
    "record_id string, channel string, session_id string, seq bigint, ts timestamp, "
    "tool_name string, channel_id string, text string"
)

# --- fixed values: the two span sources
SOURCE_STRUCTURED = "regex"
SOURCE_NER = "gliner"
# ---
