"""Record types of the scholarly corpus, as DDL. Schemas are always given, never inferred."""

CANDIDATE = (
    "title string, authors array<string>, year int, doi string, pmid string, pmcid string, arxiv_id string, field string, "
    "venue string, abstract string, url string, publisher_url string, pdf_url string, source string, keywords array<string>, citation_count int"
)
CANDIDATE_COLUMNS = tuple(part.split(" ")[0] for part in CANDIDATE.split(", "))
REFERENCE = (
    "struct<number:int,key:string,raw:string,title:string,authors:string,year:string,venue:string,doi:string,arxiv_id:string,pmid:string,url:string>"
)
CONTEXT = "struct<source_section:string,context_before:array<string>,citation_sentence:string,context_after:array<string>>"
CITED = f"struct<ord:int,id:string,title:string,raw:string,citation_context:string,citation_contexts:array<{CONTEXT}>,doi:string,arxiv_id:string,pmid:string,authors:string,year:string,venue:string,url:string>"
DOCUMENT = f"full_text string, sections map<string,string>, references array<{REFERENCE}>, parse_error string"
RESOLVED = f"array<struct<id:string,title:string,summary:string,citation_contexts:array<{CONTEXT}>>>"
INDEX = "title string, abstract string, arxiv_id string, doi string, pmid string, authors array<string>, year string"
PUBLICATION = "doi string, venue string, field string"
OUTPUT_COLUMNS = ("title", "abstract", "introduction", "field", "venue", "year", "method", "references")
OUTPUT = f"title string, abstract string, introduction string, field string, venue string, year int, method string, references {RESOLVED}"
PAGE = "struct<page_num:int,text:string,blocks:array<struct<type:string,bbox:array<double>,text:string,size:bigint>>,tables:array<array<array<string>>>,images:array<map<string,string>>>"
PARSED = f"file_path string, title string, authors string, abstract string, full_text string, pages array<{PAGE}>, sections map<string,string>, metadata map<string,string>, parse_errors array<string>"
PROGRESS = (
    "pipeline_version int, searches_done array<string>, processed_ids array<string>, papers_processed bigint, total_collected bigint, ok bigint, fail bigint, failure_reasons map<string,bigint>"
)
PROCESSED = "processed_id string, pipeline_version int, shard int, run int"
"""Extra columns: every reader adds ``seq LONG``, the order in which rows count."""
