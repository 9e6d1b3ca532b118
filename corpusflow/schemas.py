"""Schemas of the corpus tables, one constant each. Order is data: every table carries its positions."""

PAGE_TEXT = "document_id string, pdf_page int, text string"
PAGEMAP = "document_id string, pdf_page int, manual_page string, evidence string"
TOC = "document_id string, ord int, name string, manual_page string, indent int"
SECTIONS = "document_id string, ord int, section_id string, keyword_id string, name string, volume int, kind string, parent_section_id string, section_number string, pages array<struct<pdf_page:int,manual_page:string>>"
PLAN_PAGES = "document_id string, pdf_page int, manual_page string, candidate_sections array<string>, volume int"
PLAN_BATCHES = "batch_id int, document_id string, pdf_pages array<int>, volume int"
RAW_PAGES = "document_id string, volume int, pdf_page int, provider string, model string, job_id string, batch_id int, source_layout_index int, transport string, layout_result string"
CELL = "struct<text:string,row:int,column:int,rowspan:int,colspan:int>"
BLOCK = f"struct<type:string,text:string,bbox:array<double>,rows:array<array<{CELL}>>>"
ISSUE_FIELDS = "severity:string,code:string,message:string,pdf_page:int,manual_page:string"
PAGEIR = f"document_id string, pdf_page int, manual_page string, blocks array<{BLOCK}>, issues array<struct<{ISSUE_FIELDS}>>"
ISSUES = "document_id string, manual_type string, volume int, pdf_page int, manual_page string, keyword_id string, section_id string, severity string, code string, message string"
PAGE_STATE = "document_id string, volume int, pdf_page int, status string, provider string, model string, source_sha256 string, source_file string, semantic_config_hash string, adapter_identity string, pageir_schema_version string, job_id string, batch_id int, raw_json_path string, raw_markdown_path string, pageir_path string, empty_parse_attempts int, error string, updated_at timestamp"
BATCH_STATE = "document_id string, plan_batch_id int, pdf_pages array<int>, status string, provider string, model string, source_sha256 string, semantic_config_hash string, job_id string, error_category string, business_code string, error string, updated_at timestamp"
MANIFEST = "document_id string, manual_type string, keyword_id string, name string, family string, legacy_ids array<string>, options array<string>, volume int, section_id string, section_number string, title string, parent_section_id string, source_pages array<struct<pdf_page:int,manual_page:string>>, markdown_path string, status string"
SAMPLE = "sample_id string, document_id string, section_id string, length_bucket string, page_count int, pdf_pages array<int>, feature_flags array<string>, feature_signals map<string,int>, selection_reasons array<string>"

#: Severities in rising order, and the versions that readers accept (fixed values).
SEVERITIES = ("info", "warning", "error")
NAVIGATION_VERSION, PAGEIR_VERSIONS, CHECKPOINT_VERSION, CORPUS_VERSION, SAMPLE_VERSION = "0.1", ("0.1", "0.2"), "0.2", "0.1", "0.1"
