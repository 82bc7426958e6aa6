"""Schemas of stored documents' parts; metadata with open keys stays a VARIANT."""

BLOCK = (
    "block_id string, block_type string, content string, page_number int, source_file string, chunk_id string, sequence int, confidence double, "
    "heading_level int, is_truncated boolean, is_continuation boolean, bbox array<double>, extraction_method string, metadata string"
)
PAGE_PROFILE = (
    "page_number int, text_char_count int, image_count int, image_area_fraction double, table_count int, garble_rate double, is_scanned boolean, "
    "is_image_heavy boolean, is_table_heavy boolean, estimated_input_tokens int, page_width_pts double, page_height_pts double, max_font_size double, min_font_size double"
)
CHUNK_PLAN = "chunk_index int, chunk_id string, target_pages array<int>, context_before array<int>, context_after array<int>, estimated_input_tokens int, uses_vision boolean, has_boundary_risk boolean"
SECTION = "filename string, title string, page_start int, page_end int, pages string, heading_level int, parent_path string, block_ids array<string>, context_block_ids struct<before:array<string>,after:array<string>>"
MANIFEST = "source string, total_pages bigint, max_heading_level bigint, sections array<struct<sec:bigint,filename:string,title:string,level:bigint,parent_path:string,pages:string>>"
ELEMENTS = "document struct<elements:array<struct<id:bigint,type:string,content:string>>>"
