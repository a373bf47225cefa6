"""DuckDB statements for the registered queries.

They follow the plain definitions: the join is run as a join and every count is
taken over its rows.
"""

from checks.fixtures import BATCH, DUCKDB_TEXTS, STARTED

# The characters Python's str.split() splits on.
_WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def _clean(x):
    return rf"regexp_replace(trim({x}, ' '), '[\t-\r ]+', ' ', 'g')"


def _normal(x):
    return rf"trim(regexp_replace(lower({x}), '[^\w\s\x0b]', '', 'g'), ' ')"


def _spaced(x):
    return f"cast(len(string_split({x}, ' ')) as integer)"


def _words(x):
    return f"len(regexp_extract_all({x}, '[^{_WS}]+'))"


def _blank(x):
    return f"({x} is null or not regexp_matches({x}, '[^{_WS}]'))"


def _seconds(start, end):
    return f"((epoch_us(cast({end} as timestamp)) - epoch_us(cast({start} as timestamp))) / 1e6)"


_AUDIO_NAME = r"regexp_matches(path, '(?i)\.(wav|mp3|flac|ogg|m4a)$')"

_TABLES = {
    **DUCKDB_TEXTS,
    "bronze": f"""
select *, audio_filename as audio_file, 'whisper-base' as model, '1.0' as pipeline_version,
       round({_seconds('ingestion_timestamp', 'processing_timestamp')}, 2)
           as processing_duration_seconds,
       cast(coalesce(length(transcription), 0) as bigint) as transcription_length,
       cast(coalesce({_words('transcription')}, 0) as bigint) as word_count
from fx_bronze""",
    "reference": "select audio_id, audio_file, expected_transcription from fx_reference",
    "cleaned": f"""
select *, {_clean('transcription')} as transcription_clean from bronze where status = 'success'""",
    "silver": f"""
select *, {_spaced('transcription_clean')} as cleaned_word_count from cleaned""",
    "joined": """
select silver.*, reference.expected_transcription
from silver join reference on silver.audio_id = reference.audio_id""",
    "normalized": f"""
select *, {_normal('transcription_clean')} as generated_normalized,
       {_normal('expected_transcription')} as expected_normalized,
       {_spaced('expected_transcription')} as expected_word_count,
       case when transcription_clean = expected_transcription then 'MATCH' else 'MISMATCH' end
           as transcription_match
from joined""",
    "counted": f"""
select *, {_spaced('generated_normalized')} as generated_normalized_word_count,
       {_spaced('expected_normalized')} as expected_normalized_word_count,
       abs(cleaned_word_count - expected_word_count) as word_count_difference,
       case when generated_normalized = expected_normalized then 'MATCH' else 'MISMATCH' end
           as normalized_match
from normalized""",
    "compared": """
select *, abs(generated_normalized_word_count - expected_normalized_word_count)
           as normalized_word_count_difference
from counted""",
    "validated": """
select *, case when normalized_match = 'MATCH' then 'PASS' else 'REVIEW' end as quality_status,
       case when normalized_match = 'MATCH' then 'TRANSCRIPTION_MATCH'
            when normalized_word_count_difference > 0 then 'WORD_COUNT_DIFFERENCE'
            else 'TRANSCRIPTION_REVIEW' end as quality_reason
from compared""",
    "audio": f"""
select *, split_part(path, '/', -1) as audio_file,
       regexp_extract(split_part(path, '/', -1), '^(.*)\\.[^.]*$', 1) as base_name,
       lower(regexp_extract(path, '\\.([^.]*)$', 1)) as file_type,
       sha256(content) as audio_id
from fx_files where {_AUDIO_NAME}""",
    # Recognized text by the rule the fixture's content was made with.
    "tried": """
select audio.*,
       case when audio.doc_id % 20 not in (9, 19) then documents.text end as transcription,
       case when audio.doc_id % 20 = 9
            then '''utf-8'' codec can''t decode byte 0xff in position 0: invalid start byte'
            when audio.doc_id % 20 = 19 then 'Transcription is empty.' end as error,
       case when audio.doc_id % 20 = 9 then 'UnicodeDecodeError'
            when audio.doc_id % 20 = 19 then 'EmptyTranscription' end as error_type
from audio join documents on audio.doc_id = documents.doc_id""",
    "done": "select distinct base_name from fx_prior where status = 'success' and audio_id <> ''",
    "worked": "select * from tried where base_name not in (select base_name from done)",
    "settled_all": """
select path, base_name, case when earlier then 'skipped' when error is null then 'success'
                             else 'failed' end as status
from (select *, coalesce(max(error is null) over (
                   partition by base_name order by path
                   rows between unbounded preceding and 1 preceding), false) as earlier
      from tried) as ordered""",
    "outcome": f"""
select path, base_name, audio_file, audio_id, transcription, error, error_type,
       case when earlier then 'skipped' when error is null then 'success' else 'failed' end
           as status
from (select *, coalesce(max(error is null) over (
                   partition by base_name order by path
                   rows between unbounded preceding and 1 preceding), false) as earlier
      from worked) as ordered
union all
select path, base_name, audio_file, audio_id, null, null, null, 'skipped'
from tried where base_name in (select base_name from done)""",
    "audit": f"""
select case when status = 'failed' and error_type = 'EmptyTranscription' then audio_id end
           as audio_id,
       audio_file, status, '{BATCH}' as batch_id, '{STARTED}' as processed_at,
       case when status = 'skipped' then 'Already successfully processed' end as reason,
       case when status = 'success' then transcription end as transcription,
       case when status = 'failed' then error end as error,
       case when status = 'failed' and error_type <> 'EmptyTranscription' then error_type end
           as error_type
from outcome""",
    "counts": """
select (select count(*) from bronze) as bronze_count,
       (select count(*) from silver) as silver_count,
       (select count(*) from reference) as reference_count,
       (select count(*) from joined) as joined_count,
       (select count(distinct audio_id) from joined) as after_dedup_count,
       (select count(*) from joined) as before_dedup_count,
       (select count(*) - count(distinct audio_id) from joined) as duplicates_removed,
       (select count(*) from joined) as gold_count""",
}

_BRONZE_COLUMNS = """audio_id, audio_filename, source, file_type, file_size_bytes, batch_id,
       ingestion_timestamp, processing_timestamp, model, language, status,
       processing_duration_seconds, transcription, transcription_length, word_count, error,
       error_type, pipeline_version"""

_GOLD_COLUMNS = """audio_id, audio_file, transcription_clean, expected_transcription,
       transcription_match, cleaned_word_count, expected_word_count, word_count_difference,
       generated_normalized, expected_normalized, normalized_match,
       generated_normalized_word_count, expected_normalized_word_count,
       normalized_word_count_difference, quality_status, quality_reason"""


def _duplicates(table):
    return f"select audio_id, count(*) as count from {table} group by audio_id having count(*) > 1"


def _run_audit(status, source):
    return f"""
select '{status}' as run_status, bronze_count as bronze_record_count,
       silver_count as silver_record_count, joined_count as joined_record_count,
       gold_count as final_record_count, cast(null as varchar) as error_message,
       cast(null as varchar) as error_type
from {source}"""


def _gate(table):
    return f"""
select '{table}_duplicates' as check_name, count(*) as failing_groups, count(*) = 0 as passed
from ({_duplicates(table)}) as {table}_groups"""


_FINAL = {
    "intake_discover": f"select path, length from fx_files where {_AUDIO_NAME}",
    "bronze_scan": f"select {_BRONZE_COLUMNS} from bronze",
    "reference_scan": "select * from fx_reference",
    "reference_smoke_count": "select count(*) as record_count from fx_reference",
    "audit_history_scan": "select * from audit",
    "intake_audit_append": """
select * from audit union all
select * replace ('20240102_000000' as batch_id) from audit""",
    "bronze_latest": """
select base_name, batch_id, audio_id, audio_filename, status, processing_timestamp
from (select *, row_number() over (
          partition by base_name
          order by processing_timestamp desc, batch_id desc, audio_filename desc) as place
      from (select * replace ('doc_' || (doc_id - doc_id % 3) || case doc_id % 3
                                  when 0 then '.wav' when 1 then '.mp3' else '.ogg' end
                              as audio_filename),
                   'doc_' || (doc_id - doc_id % 3) as base_name
            from fx_bronze) as named) as ranked
where place = 1""",
    "transcript_export": "select base_name, transcription from outcome where status = 'success'",
    "disposition_split": """
select path, status, case status when 'success' then 'processed' when 'failed' then 'failed'
                                 else 'incoming' end as disposition
from outcome""",
    "run_audit": _run_audit("SUCCESS", "counts"),
    "run_audit_failure": """
select 'FAILED' as run_status, bronze_count as bronze_record_count,
       silver_count as silver_record_count, cast(null as bigint) as joined_record_count,
       cast(null as bigint) as final_record_count,
       'reference table is not reachable' as error_message, 'ConnectionError' as error_type
from counts""",
    "run_audit_roundtrip": _run_audit("SUCCESS", "counts")
    + """
union all
select 'FAILED', null, null, null, null, 'no bronze', 'ValueError' from counts""",
    "bronze_view": """
select audio_file, status, transcription, word_count, processing_duration_seconds from bronze""",
    "bronze_dq": """
select count(*) as bronze_count,
       count(*) filter (status = 'success') as silver_count,
       count(*) filter (audio_filename is null) as null_audio_file,
       count(*) filter (status is null) as null_status,
       count(*) filter (transcription is null) as null_transcription,
       count(*) filter (word_count = 0) as zero_word_count,
       count(*) filter (status <> 'success') as non_success
from fx_gaps""",
    "silver": """
select audio_id, audio_file, batch_id, transcription_clean, cleaned_word_count from silver""",
    "silver_view": """
select audio_file, word_count, transcription_clean, cleaned_word_count from silver""",
    "reference_prepared": "select * from reference",
    "bronze_validate": f"""
select doc_id, case when {_blank('text')} then 'failed' else 'success' end as status,
       case when not {_blank('text')} then text end as transcription,
       cast(case when {_blank('text')} then 0 else length(text) end as bigint)
           as transcription_length,
       cast(case when {_blank('text')} then 0 else {_words('text')} end as bigint) as word_count,
       case when {_blank('text')} then 'Transcription is empty.' end as error,
       case when {_blank('text')} then 'EmptyTranscription' end as error_type
from fx_texts""",
    "bronze_metrics": f"""
select doc_id, cast(length(text) as integer) as transcription_length,
       cast({_words('text')} as integer) as word_count
from fx_texts""",
    "processing_duration": f"""
select audio_filename,
       round({_seconds('ingestion_timestamp', 'processing_timestamp')}, 2)
           as processing_duration_seconds,
       {_seconds('ingestion_timestamp', 'processing_timestamp')} as elapsed_seconds
from fx_bronze""",
    "text_clean": f"""
select doc_id, {_clean('text')} as cleaned, {_spaced(_clean('text'))} as word_count
from fx_texts""",
    "text_normalize": f"""
select doc_id, {_normal('text')} as normalized, {_spaced(_normal('text'))} as word_count
from fx_texts""",
    "silver_reference_join": """
select audio_id, audio_file, transcription_clean, expected_transcription from joined""",
    "transcription_match": """
select audio_file, transcription_clean, expected_transcription, transcription_match
from validated""",
    "normalized_match": """
select audio_file, generated_normalized, expected_normalized, normalized_match from validated""",
    "word_counts": """
select audio_file, cleaned_word_count, expected_word_count, word_count_difference,
       generated_normalized_word_count, expected_normalized_word_count,
       normalized_word_count_difference
from validated""",
    "quality_classification": """
select audio_id, audio_file, normalized_match, quality_status, quality_reason from validated""",
    "validation_view": """
select audio_id, audio_file, transcription_match, normalized_match, cleaned_word_count,
       expected_word_count, word_count_difference, generated_normalized_word_count,
       expected_normalized_word_count, normalized_word_count_difference, quality_status,
       quality_reason
from validated""",
    "gold": f"select {_GOLD_COLUMNS} from validated",
    "bronze_duplicates": _duplicates("bronze"),
    "reference_duplicates": _duplicates("reference"),
    "joined_duplicates": _duplicates("joined"),
    "stage_counts": "select * from counts",
    "dq_gate_results": " union all ".join(_gate(t) for t in ("bronze", "reference", "joined")),
    "dedup_counts": "select before_dedup_count, after_dedup_count, duplicates_removed from counts",
    "dedup_rows": """
select audio_id, audio_file, batch_id, transcription_match, normalized_match, quality_status,
       quality_reason
from (select *, row_number() over (
          partition by audio_id
          order by audio_file, batch_id, sha256(transcription_clean) nulls first,
                   sha256(expected_transcription) nulls first) as place
      from validated) as ranked
where place = 1""",
    "reconciliation_summary": """
select count(*) as total_records,
       cast(sum(case when transcription_match = 'MATCH' then 1 else 0 end) as bigint)
           as match_count,
       cast(sum(case when transcription_match = 'MISMATCH' then 1 else 0 end) as bigint)
           as mismatch_count,
       round(sum(case when transcription_match = 'MATCH' then 1 else 0 end) / count(*) * 100, 2)
           as match_percentage
from validated""",
    "quality_summary": """
select count(*) as total_records,
       cast(sum(case when quality_status = 'PASS' then 1 else 0 end) as bigint) as pass_count,
       cast(sum(case when quality_status = 'REVIEW' then 1 else 0 end) as bigint)
           as review_count,
       round(sum(case when quality_status = 'PASS' then 1 else 0 end) / count(*) * 100, 2)
           as pass_percentage,
       round(sum(case when quality_status = 'REVIEW' then 1 else 0 end) / count(*) * 100, 2)
           as review_percentage
from validated""",
    "quality_reason_breakdown": """
select quality_reason, count(*) as record_count from validated
group by quality_reason order by quality_reason""",
    "intake_file_metadata": f"""
select path, audio_id, audio_file, base_name, file_type, length as file_size_bytes,
       'local_audio' as source, '{BATCH}' as batch_id, '{STARTED}' as ingestion_timestamp,
       'whisper-base' as model, 'en' as language, '1.0' as pipeline_version
from audio""",
    "intake_pending": """
select path, base_name from audio where base_name not in (select base_name from done)""",
    "intake_skipped": """
select path, base_name from audio where base_name in (select base_name from done)""",
    "intake_done_index": """
select path, base_name, base_name in (select base_name from done) as done from audio""",
    "intake_second_run": """
select regexp_extract(path, '[^/]*$') as audio_file, status, cast(1 as bigint) as audit_rows,
       case status when 'success' then 'processed' when 'failed' then 'failed' else 'incoming' end
           as folder
from settled_all""",
    "intake_collision": "select path, base_name, status from settled_all",
    "intake_batch_summary": f"""
select '{BATCH}' as batch_id, count(*) as total_files,
       count(*) filter (status = 'success') as successful,
       count(*) filter (status = 'failed') as failed,
       count(*) filter (status = 'skipped') as skipped
from outcome""",
    "batch_transcribe": f"""
select path, audio_id, transcription,
       cast(coalesce(length(transcription), 0) as bigint) as transcription_length,
       cast(coalesce({_words('transcription')}, 0) as bigint) as word_count
from tried""",
    "batch_transcribe_errors": """
select path, audio_id, error, error_type from tried where error is not null""",
    # The first drop as settled. In the second drop all files of a base name that is
    # done are skipped; of any other name the first in path order succeeds.
    "intake_incremental": """
select base_name, cast(sum(ok) + 1 - max(ok) as bigint) as successful,
       cast(sum(bad) as bigint) as failed,
       cast(sum(passed_over) + count(*) - (1 - max(ok)) as bigint) as skipped,
       coalesce(max(transcription), 'again ' || min(again_path)) as transcription
from (select settled_all.base_name,
             case when status = 'success' then transcription end as transcription,
             replace(settled_all.path, 'incoming', 'incoming_again') as again_path,
             case when status = 'success' then 1 else 0 end as ok,
             case when status = 'failed' then 1 else 0 end as bad,
             case when status = 'skipped' then 1 else 0 end as passed_over
      from settled_all join tried on settled_all.path = tried.path) as drops
group by base_name""",
}


_FINAL["bronze_current"] = _FINAL["bronze_latest"]


def statements():
    """Query name -> one DuckDB statement; unused tables are dropped by its optimizer."""
    tables = ",\n".join(f"{name} as ({sql})" for name, sql in _TABLES.items())
    return {name: f"with {tables}\n{sql.strip()}" for name, sql in _FINAL.items()}
