"""Declared schemas of the fix database and of the files that are exchanged."""

from __future__ import annotations

FIX_TABLES: dict[str, str] = {
    "fixes": "cve_id string, hash string, repo_url string, rel_type string, score bigint, "
    "extraction_status string",
    "commits": "hash string, repo_url string, author string, committer string, msg string, "
    "parents string, author_date timestamp, committer_date timestamp, num_lines_added bigint, "
    "num_lines_deleted bigint, merge boolean, dmm_unit_complexity double, "
    "dmm_unit_interfacing double, dmm_unit_size double",
    "file_change": "file_change_id string, hash string, filename string, old_path string, "
    "new_path string, change_type string, diff string, diff_parsed string, code_before string, "
    "code_after string, programming_language string, num_lines_added int, "
    "num_lines_deleted int, nloc string, complexity string, token_count string",
    "method_change": "method_change_id string, file_change_id string, name string, "
    "signature string, parameters string, start_line string, end_line string, code string, "
    "before_change string, nloc string, complexity string, token_count string, "
    "top_nesting_level string",
    "cve": "cve_id string, published_date string, last_modified_date string, "
    "description string, severity string, cvss2_base_score string, cvss3_base_score string, "
    "cvss3_base_severity string, cvss2_vector_string string, cvss3_vector_string string, "
    "cvss2_access_vector string, cvss3_attack_vector string, cvss2_access_complexity string, "
    "cvss3_attack_complexity string, obtain_all_privilege string, obtain_user_privilege string, "
    "user_interaction_required string, reference_json string, problemtype_json string, "
    "nodes string",
    "cwe": "index bigint, cwe_id string, cwe_name string, description string, "
    "extended_description string, url string, is_category boolean",
    "cwe_classification": "cve_id string, cwe_id string",
    "cve_cpe_mapper": "id int, cve_id string, cpe_name string",
    "cve_project": "id int, cve string, project_url string, rel_type string, checked string",
    "cpe_project": "cpe_name string, repo_url string, rel_type string",
    "repository": "repo_url string, repo_name string, description string, "
    "date_created timestamp, date_last_push timestamp, homepage string, repo_language string, "
    "owner string, forks_count bigint, stars_count bigint",
}

INSTANCE_FILE = (
    "pattern_key string, cwe_id string, cwe_name string, sink_types string, "
    "source_types string, missing_sanitizers string, cve_id string, hash string, "
    "repo_url string, commit_link string, method_name string, signature string, "
    "code_diff string, github_query string"
)
RESULT_FILE = (
    "pattern_key string, cwe_id string, cwe_name string, github_query string, "
    "repository string, repository_url string, path string, html_url string, sha string, "
    "stars bigint, code_snippet string"
)
SEARCH_RESPONSE = (
    "items array<struct<repository:struct<full_name:string,html_url:string>,"
    "path:string,url:string,html_url:string,sha:string>>"
)
