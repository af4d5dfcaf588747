"""Schemas of the tables that jobs read and write, as DDL."""

DOCUMENTS = "doc_id bigint, load_seq bigint, title string, law_number string, content string"
ENTITIES = "doc_id bigint, pos bigint, article_number string, concept string, subject string, action string, object string, full_text string"
TRIPLETS = "doc_id bigint, pos bigint, subject string, relation string, object string, article_number string, confidence double"
PDF_PAGES = "path string, page_num int, text string"
PDF_META = "path string, title string, author string, subject string, pages int, filename string, error string"
