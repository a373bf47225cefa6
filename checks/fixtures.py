"""Input tables of the registered queries, derived from the whole ``documents`` table.

Each table is one SQL text for Spark and DuckDB; the few functions that are named
differently are filled in per engine. ``doc_id`` only decides which variant of a
case a row stands for: no row is left out and no text is cut.
"""

from pyspark.sql import functions as F

from verbalance import fixed, session
from verbalance.functions import measures, text
from verbalance.schemas import BRONZE

_SPARK = {
    "documents": "{documents}",
    "sha": "sha2({0}, 256)",
    "bytes": "octet_length({0})",
    "clean": r"regexp_replace(trim({0}), r'\s+', ' ')",
    "to_bytes": "encode({0}, 'utf-8')",
    "bad_byte": "x'ff'",
    "bytes_of_blob": "octet_length({0})",
}
_DUCKDB = {
    "documents": "documents",
    "sha": "sha256({0})",
    "bytes": "strlen({0})",
    "clean": r"regexp_replace(trim({0}, ' '), '[\t-\r ]+', ' ', 'g')",
    "to_bytes": "encode({0})",
    "bad_byte": r"'\xFF'::blob",
    "bytes_of_blob": "octet_length({0})",
}

BATCH = "20240101_000000"
STARTED = "2024-01-01T00:00:00"


def _texts(d):
    sha, clean = d["sha"].format, d["clean"].format
    size, blob_size, to_bytes = d["bytes"].format, d["bytes_of_blob"].format, d["to_bytes"].format
    documents, bad = d["documents"], d["bad_byte"]
    return {
        # Exact copies among the documents give records with the same audio_id.
        "fx_bronze": f"""
select doc_id, {sha('text')} as audio_id,
       'doc_' || cast(doc_id as varchar(20)) || '.wav' as audio_filename,
       source, 'wav' as file_type,
       cast({size('text')} as bigint) as file_size_bytes,
       '20240101_00000' || cast(doc_id % 4 as varchar(1)) as batch_id,
       '2024-01-01T00:00:00' as ingestion_timestamp,
       '2024-01-01T00:' || lpad(cast(doc_id % 60 as varchar(2)), 2, '0') || ':07.250000'
           as processing_timestamp,
       lang as language,
       case when doc_id % 10 = 9 then 'failed' else 'success' end as status,
       case when doc_id % 10 = 9 then null
            when doc_id % 7 = 3 then '  ' || replace(text, ' ', '  ') || ' '
            else text end as transcription,
       case when doc_id % 10 = 9 then 'Transcription is empty.' end as error,
       case when doc_id % 10 = 9 then 'EmptyTranscription' end as error_type
from {documents}""",
        # 0 equal, 1 differs in case and punctuation, 2 one word more, 3 same word
        # count but other text, 4 expected for another file, 5 no expected text.
        "fx_reference": f"""
select case when doc_id % 6 = 4 then {sha("'other ' || text")} else {sha('text')} end as audio_id,
       'doc_' || cast(doc_id as varchar(20)) || '.wav' as audio_file,
       case doc_id % 6 when 0 then {clean('text')}
                       when 1 then lower({clean('text')}) || '!'
                       when 2 then {clean('text')} || ' extra'
                       when 3 then 'zz' || {clean('text')}
                       when 4 then {clean('text')}
                       else null end as expected_transcription,
       timestamp '2024-01-01 00:00:00' as created_at
from {documents}""",
        # Extensions in mixed case, one of them unsupported; two files per base
        # name where doc_id % 8 = 7; content that is blank or not valid UTF-8.
        "fx_files": f"""
select doc_id, path, content, cast({blob_size('content')} as bigint) as length
from (select doc_id,
             'data/incoming/doc_'
             || cast(case when doc_id % 8 = 7 then doc_id - 1 else doc_id end as varchar(20))
             || '.'
             || case doc_id % 7 when 0 then 'wav' when 1 then 'mp3' when 2 then 'FLAC'
                                when 3 then 'ogg' when 4 then 'm4a' when 5 then 'txt'
                                else 'Mp3' end as path,
             case when doc_id % 20 = 9 then {bad} || {to_bytes('text')}
                  when doc_id % 20 = 19 then {to_bytes("' '")}
                  else {to_bytes('text')} end as content
      from {documents}) as files""",
        # Earlier records: success, failure, success without id, or another name.
        "fx_prior": f"""
select case when doc_id % 3 = 0 then 'doc_' else 'old_' end
       || cast(doc_id as varchar(20)) as base_name,
       case when doc_id % 2 = 0 then 'success' else 'failed' end as status,
       case when doc_id % 12 = 0 then null else {sha('text')} end as audio_id
from {documents}""",
        # Edge cases of the text rules around whole texts.
        "fx_texts": f"""
select doc_id,
       case doc_id % 6 when 0 then text
                       when 1 then chr(10) || ' ' || text || ' ' || chr(9) || chr(11)
                       when 2 then chr(160) || replace(text, ' ', chr(160))
                       when 3 then 'École, 5 - déjà_vu! ' || text
                       when 4 then replace(text, ' ', ' - ') || '  '
                       else case doc_id % 4 when 0 then null when 1 then ''
                                            when 2 then '   ' else chr(160) || chr(10) end
       end as text
from {documents}""",
        # Records with gaps.
        "fx_gaps": f"""
select case when doc_id % 11 <> 5 then 'doc_' || cast(doc_id as varchar(20)) end as audio_filename,
       case when doc_id % 13 = 7 then null when doc_id % 10 = 9 then 'failed'
            else 'success' end as status,
       case when doc_id % 10 <> 9 then text end as transcription,
       cast(case when doc_id % 17 = 3 then null when doc_id % 10 = 9 then 0
                 else {size('text')} end as bigint) as word_count
from {documents}""",
    }


_SPARK_TEXTS = _texts(_SPARK)
DUCKDB_TEXTS = _texts(_DUCKDB)


def documents(spark, sf_dir):
    return session.spread(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")


def table(spark, sf_dir, name):
    return spark.sql(_SPARK_TEXTS[name], documents=documents(spark, sf_dir))


def bronze(spark, sf_dir):
    """``fx_bronze`` with the columns that the record rules derive."""
    words = F.col("transcription")
    return (
        table(spark, sf_dir, "fx_bronze")
        .withColumn("model", F.lit(fixed.MODEL))
        .withColumn("pipeline_version", F.lit(fixed.RECORD_VERSION))
        .withColumn(
            "processing_duration_seconds",
            measures.record_duration(F.col("ingestion_timestamp"), F.col("processing_timestamp")),
        )
        .withColumn(
            "transcription_length", F.coalesce(F.length(words), F.lit(0)).cast("bigint")
        )
        .withColumn(
            "word_count", F.coalesce(text.unicode_word_count(words), F.lit(0)).cast("bigint")
        )
        .select(*BRONZE.names)
    )
