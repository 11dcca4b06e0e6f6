"""File names and paths: what recordings are called, and where results go.
Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# --- Fixed values: names, markers and maps that results depend on. ---
TASKS_1 = [("grandfather", "Grandfather"), ("picnic", "Picnic"), ("spontaneous", "Spontaneous"), ("10minute|conversation", "10MinConversation")]
FOLDERS_1 = [("10minute|conversation", "10MinConversation"), ("grandfather", "Grandfather"), ("picnic", "Picnic"), ("spontaneous", "Spontaneous")]
TASKS_2 = [("grandfather|gfp", "Grandfather"), ("picnic", "Picnic"), ("spontaneous|spont", "Spontaneous"), ("conversation", "Conversation")]
TASKS_3 = [("grandfather|gfp", "Grandfather"), ("picnic", "Picnic"), ("spontaneous|spont", "Spontaneous"), ("conversation|10min", "Conversation")]
EXTENSION = r"(?i)(\.deid\.piiCategoryTag\.json|\.deid\.piiCategoryTag|\.json|\.wav|\.txt)$"
PREFIX = r"(?i)^(anon_|anonymized_|deidentified_)"
SUFFIX = r"(?i)(_clean|_cleaned|_processed|_transcript|_deidentified)$"
SPEECH_TASK = "mse|motorspeech|motor_speech|motor-speech|paralang|paralinguistic|para_ling"
DATED_NAME = r"^(\d+)-(\d{1,2})-(\d{1,2})-(\d{2,4})"
DIRECTORIES = {
    "ConflictConv": "ConflictConv",
    "GrandfatherPassage": "GrandfatherPassage",
    "MotorSpeechEval": "MotorSpeechEval",
    "PicnicDescription": "PicnicDescription",
    "SpontSpeech": "SpontSpeech",
    "Grandfather Passage": "GrandfatherPassage",
    "Motor Speech Evaluation": "MotorSpeechEval",
    "Picnic Description": "PicnicDescription",
    "Spontaneous Speech": "SpontSpeech",
    "Conflict Conversation": "ConflictConv",
    "Mac_Audacity_10MinConvo_withCoordinatorSpeech": "ConflictConv_Mac_WithCoord",
    "Mac_Audacity_10MinuteConvo_withoutCoordinatorSpeech": "ConflictConv_Mac_NoCoord",
    "PC_10MinuteConversations_WithoutCoordinatorSpeech": "ConflictConv_PC_NoCoord",
    "Mac_Audacity_Grandfather_Passage": "GrandfatherPassage_Mac",
    "PC_Audacity_Grandfather_Passage": "GrandfatherPassage_PC",
    "Mac_Audacity_Motor_Speech_Evaluation": "MotorSpeechEval_Mac",
    "PC_Audacity_Motor_Speech_Evaluation": "MotorSpeechEval_PC",
    "Mac_Audacity_Picnic_Description": "PicnicDescription_Mac",
    "PC_Audacity_Picnic_Description": "PicnicDescription_PC",
    "Mac_Audacity_Spontaneous_Speech": "SpontSpeech_Mac",
    "PC_Audacity_Spontaneous_Speech": "SpontSpeech_PC",
}
COHORTS = {"004": "CSA-004", "CSA-Clinical": "CSA-clinic", "CSA-Research": "CSA-research-X-section", "Clinic_Plus_segmented": "clinic_PLUS1", "FUsegmented": "CSA-research-long", "LIIA": "LIIA"}
# --- End of fixed values. ---


def _first_of(value: Column, rules: list[tuple[str, str]], other: Column) -> Column:
    out = other
    for pattern, name in reversed(rules):
        out = F.when(value.rlike(pattern), name).otherwise(out)
    return out


def _fill(value: Column, width: int) -> Column:
    return F.lpad(value, F.greatest(F.length(value), F.lit(width)), F.lit("0"))  # lpad alone would cut


def _digits(value: Column) -> Column:
    return F.coalesce(value.rlike(r"^\d+$"), F.lit(False))


def recording(name: Column, folder: Column) -> Column:
    """struct(participant, date, task) of `2-002-8-Task[-Mac]-M-D-YY-XX`: three
    parts are the participant, the date follows the task and an optional Mac,
    and the task falls back on the folder. A missing date is 'unknown'."""
    stem = F.replace(name, F.lit("_transcript.txt"), F.lit(""))
    p = F.split(stem, "-")
    part = lambda i: F.get(p, F.lit(i))
    n = F.size(p)
    fallback = _first_of(F.lower(folder), FOLDERS_1, F.lit("Unknown"))
    off = F.when(part(4) == "Mac", 1).otherwise(0)
    at = lambda i: F.get(p, off + i)
    date = F.when((n >= 7) & at(6).isNotNull(), F.concat(F.lit("20"), at(6), F.lit("-"), _fill(at(4), 2), F.lit("-"), _fill(at(5), 2))).otherwise("unknown")
    task = F.when(n >= 4, _first_of(F.lower(part(3)), TASKS_1, fallback)).otherwise(fallback)
    return (F.when(n >= 3, F.struct(F.concat_ws("-", part(0), part(1), part(2)).alias("participant"), date.alias("date"), task.alias("task")))
            .otherwise(F.struct(stem.alias("participant"), F.lit("unknown").alias("date"), F.lit("unknown").alias("task"))))


def stem_and_task(name: Column) -> Column:
    """struct(participant, date, task): the whole stem, no date."""
    stem = F.replace(F.replace(name, F.lit("_transcript.txt"), F.lit("")), F.lit(".txt"), F.lit(""))
    return F.struct(stem.alias("participant"), F.lit("unknown").alias("date"), _first_of(F.lower(name), TASKS_2, F.lit("Unknown")).alias("task"))


def numbered_recording(name: Column) -> Column:
    """struct(participant, date, task): three parts of digits are the
    participant; of seven parts or more, the first three of digits in a row are
    month, day and year, which are the participant's own parts as a rule."""
    p = F.split(F.replace(F.replace(name, F.lit("_transcript.txt"), F.lit("")), F.lit(".txt"), F.lit("")), "-")
    part = lambda i: F.get(p, F.lit(i))
    n, numbered = F.size(p), _digits(part(0)) & _digits(part(1)) & _digits(part(2))
    task = F.when(n > 3, _first_of(F.lower(part(3)), TASKS_3, F.lit("unknown"))).otherwise("unknown")
    # the participant's three parts are of digits, so the scan ends there
    year = F.when(F.length(part(2)) == 2, F.concat(F.lit("20"), part(2))).otherwise(part(2))
    date = F.when(n >= 7, F.concat(year, F.lit("-"), _fill(part(0), 2), F.lit("-"), _fill(part(1), 2))).otherwise("unknown")
    unknown = F.lit("unknown")
    first = F.when((n >= 3) & (part(0) != ""), part(0)).otherwise(unknown)
    return F.when((n >= 3) & numbered, F.struct(F.concat_ws("-", part(0), part(1), part(2)).alias("participant"), date.alias("date"), task.alias("task"))).otherwise(
        F.struct(first.alias("participant"), unknown.alias("date"), unknown.alias("task")))


def dated_name(name: Column) -> Column:
    """struct(mrn, date, full_date) of `MRN-M-D-YY...`, years from 31 being of
    the last century; null for other names."""
    g = lambda i: F.regexp_extract(name, DATED_NAME, i)
    month, day, year = _fill(g(2), 2), _fill(g(3), 2), g(4)
    whole = F.when(F.length(year) == 2, F.concat(F.when(year <= "30", "20").otherwise("19"), year)).otherwise(year)
    return F.when(name.rlike(DATED_NAME), F.struct(_fill(g(1), 4).alias("mrn"), F.concat_ws("-", month, day, year).alias("date"), F.concat_ws("/", month, day, whole).alias("full_date")))


def core_name(name: Column) -> Column:
    """A name without its extension, one prefix and one suffix."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(name, EXTENSION, ""), PREFIX, ""), SUFFIX, "")


def cleaned_name(name: Column) -> Column:
    return F.regexp_replace(name, r"(?i)\.wav$", "_cleaned.wav")


def base_stem(name: Column) -> Column:
    """The stem without what transcribing or cleaning adds."""
    return F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), "(_transcript|_cleaned)$", "")


def anonymous_stem(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, "^anon_", ""), r"_clean\.wav$", "")


def is_speech_task(path: Column) -> Column:
    return F.lower(path).rlike(SPEECH_TASK)


def is_follow_up(path: Column) -> Column:
    return F.exists(F.split(F.lower(path), "/"), lambda p: p.contains("follow") & p.contains("up"))


def in_directories(path: Column, names: list[str]) -> Column:
    return F.arrays_overlap(F.split(path, "/"), F.array(*map(F.lit, names)))


def has_part(path: Column, pattern: str) -> Column:
    """Whether a directory or file of the path matches a pattern."""
    return F.exists(F.split(path, "/"), lambda p: p.rlike(pattern))


def _mapped(value: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), value)


def standard_directory(name: Column) -> Column:
    """The standard name of a task's directory; null for other directories."""
    return _mapped(name, DIRECTORIES)


def cohort_of(path: Column) -> Column:
    """struct(cohort, task, turns_cohort) of a path relative to the root."""
    p = F.split(path, "/")
    cohort = F.when(F.size(p) > 1, F.get(p, F.lit(0))).otherwise("unknown")
    return F.struct(cohort.alias("cohort"), F.when(F.size(p) > 2, F.get(p, F.lit(1))).otherwise("unknown").alias("task"), _mapped(cohort, COHORTS).alias("turns_cohort"))


def clip(start: Column, end: Column, rate: int, n: Column) -> Column:
    """struct(start, end) in samples of an interval in seconds, within n."""
    return F.struct(F.greatest(F.lit(0), (start * rate).cast("long")).alias("start"), F.least(n, (end * rate).cast("long")).alias("end"))


def mirrored(files: DataFrame, path: str, source: str, target: str, name: Column, *then: str) -> DataFrame:
    """files with out: the path below target that mirrors the one below source,
    with the new name; of names that clash, those after the first get _001, _002
    and so on before the extension, by path and, where paths are equal, by the
    columns then."""
    below = F.regexp_replace(F.substring(F.col(path), len(source) + 1, 1 << 20), "(^/|[^/]*$)", "")
    out = F.concat(F.lit(target + "/"), below, name)
    same = F.row_number().over(W.partitionBy("_out").orderBy(path, *then)) - 1
    numbered = F.concat(F.regexp_replace("_out", r"(\.[^./]*)?$", ""), F.lit("_"), F.lpad(F.col("_k").cast("string"), 3, "0"), F.regexp_extract("_out", r"(\.[^./]*)?$", 0))
    return files.withColumn("_out", out).withColumn("_k", same).withColumn("out", F.when(F.col("_k") == 0, F.col("_out")).otherwise(numbered)).drop("_out", "_k")
