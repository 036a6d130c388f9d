"""Closed schemas of nested packets and of what surrounds them; nothing is inferred."""

from __future__ import annotations

PROVENANCE = "struct<chunk_id:string,page_start:int,page_end:int,text_excerpt:string,paraphrased:boolean>"
DATASET = "struct<dataset_id:string,name:string,version_or_split:string,description:string>"
METHOD = "struct<method_id:string,name:string,protocol_description:string>"
RESULT = (
    "struct<result_id:string,metric_name:string,value_raw_text:string,quantitative_value:double,unit:string,p_value:double,"
    f"n_sample_size:int,provenance:{PROVENANCE},additional_provenance:array<{PROVENANCE}>>"
)
CLAIM = f"struct<claim_id:string,statement:string,polarity:string,inference_basis_ids:array<string>,provenance:{PROVENANCE},additional_provenance:array<{PROVENANCE}>>"
SPAN = f"struct<span_id:string,content:string,provenance:{PROVENANCE}>"
UNIT = (
    f"struct<unit_id:string,name:string,experiments_or_tasks:array<string>,datasets:array<{DATASET}>,methods:array<{METHOD}>,"
    f"results:array<{RESULT}>,claims:array<{CLAIM}>,evidence_spans:array<{SPAN}>>"
)
QUESTION = f"struct<question_id:string,statement:string,study_units:array<{UNIT}>>"
WARNING = "struct<code:string,message:string,json_path:string,repair:string>"
MERGE = "struct<surviving_id:string,merged_ids:array<string>,reason:string>"
ASSESSMENT = "struct<precision:double,recall:double,f1:double,extracted_item_count:int,incorrect_item_count:int,missed_core_item_count:int,deterministic_rule_score:double>"
PACKET = (
    "schema_version string, paper_id string, metadata map<string,string>, coverage_ledger map<string,string>, "
    f"research_questions array<{QUESTION}>, limitations_and_boundaries array<string>, quality_score double, status string, "
    f"requires_reconciliation boolean, validation_warnings array<{WARNING}>, merge_decisions array<{MERGE}>, quality_assessment {ASSESSMENT}"
)
CHUNK = "struct<id:string,ordinal:int,section_hint:string,page_start:int,page_end:int,char_count:int,token_estimate:int,content_sha256:string,text:string>"
ARTIFACT = (
    "schema_version string, paper_id string, source_file string, source_sha256 string, text_artifact string, text_artifact_sha256 string, "
    f"chunker string, chunker_version string, chunked_at string, chunk_count int, chunks array<{CHUNK}>"
)
STAGE = (
    "struct<model:string,attempts:int,prompt_tokens:bigint,completion_tokens:bigint,total_tokens:bigint,usage_complete:boolean,"
    "latency_seconds:double,estimated_cost_usd:double,finish_reason:string>"
)
RUN_RECORD = (
    "paper_id string, status string, source_sha256 string, quality_score double, precision double, recall double, deterministic_rule_score double, "
    f"incorrect_item_count bigint, missed_core_item_count bigint, extraction {STAGE}, quality_judge {STAGE}, output_file string, error_type string, error_message string"
)

POLARITIES = ("positive", "negative", "neutral")
COVERAGE = ("extracted", "irrelevant", "failed", "not_selected")
EVENT_KINDS = ("assertion_added", "evidence_added", "relation_added", "batch_committed")

#: What a delivered packet leaves out.
INTERNAL = ("status", "requires_reconciliation", "merge_decisions")
PACKET_FIELDS = (
    "schema_version", "paper_id", "metadata", "coverage_ledger", "research_questions", "limitations_and_boundaries", "quality_score", "status", "requires_reconciliation", "validation_warnings", "merge_decisions",
    "quality_assessment",
)
