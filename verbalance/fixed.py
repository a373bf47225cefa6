"""Values that stored records and labels depend on.

Every constant here is a fixed value: changing one changes stored data or
breaks comparison with records written earlier.
"""

# Audio file extensions taken in, compared in lower case.
AUDIO_EXTENSIONS = (".wav", ".mp3", ".flac", ".ogg", ".m4a")

# Stamps on every bronze record.
SOURCE = "local_audio"
MODEL = "whisper-base"
LANGUAGE = "en"
RECORD_VERSION = "1.0"
BATCH_ID_FORMAT = "%Y%m%d_%H%M%S"

# Status of a bronze record or an intake audit row.
SUCCESS = "success"
FAILED = "failed"
SKIPPED = "skipped"

# Texts stored for a blank transcription and for a skipped file.
EMPTY_ERROR = "Transcription is empty."
EMPTY_ERROR_TYPE = "EmptyTranscription"
SKIP_REASON = "Already successfully processed"

# Where a source file belongs after intake.
DISPOSITION_PROCESSED = "processed"
DISPOSITION_FAILED = "failed"
DISPOSITION_INCOMING = "incoming"

# Comparison labels and quality reasons.
MATCH = "MATCH"
MISMATCH = "MISMATCH"
PASS = "PASS"
REVIEW = "REVIEW"
REASON_MATCH = "TRANSCRIPTION_MATCH"
REASON_WORDS = "WORD_COUNT_DIFFERENCE"
REASON_REVIEW = "TRANSCRIPTION_REVIEW"

# Status of a run audit row.
RUN_SUCCESS = "SUCCESS"
RUN_FAILED = "FAILED"

# Patterns of the text rules. ``\s`` and ``\w`` are ASCII in Spark. The
# last class holds every character Python's ``str.split()`` splits on: Unicode white
# space and the four separator controls.
SPACE_RUN = r"\s+"
NOT_WORD_OR_SPACE = r"[^\w\s]"
PYTHON_SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
