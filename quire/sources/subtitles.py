"""WebVTT subtitles as line tables, parsed into cue segments with windows.

A file is a set of lines (file_id, pos, line). A line containing '-->' is
always a cue boundary; it opens a cue when it does not start with WEBVTT or
NOTE and its timing parses. The cue's text is the run of following lines up
to the first blank line or the next arrow line, tags removed, joined by one
space; cues without text are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import text as T

# Fixed values
STRIP_CLASS = T.WS_CLASS + r"\x1C-\x1F"
TIMING_RE = r"^([0-9:.,]+)[\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]*-->[\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]*([0-9:.,]+)"
TAG_RE = r"<[^>]+>"


def strip(c) -> F.Column:
    return F.regexp_replace(T._c(c), rf"^[{STRIP_CLASS}]+|[{STRIP_CLASS}]+$", "")


def read_vtt_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed .vtt files -> lines(file_id, pos, line); one file per task at most."""
    files = (spark.read.text(path, wholetext=True)
             .select(F.col("_metadata.file_path").alias("file_id"), "value"))
    return files.select("file_id", F.posexplode(F.split("value", "\n")).alias("pos", "line"))


def segments(lines: DataFrame) -> DataFrame:
    """lines(file_id, pos, line) -> segments(file_id, seg_pos, start, end, text)."""
    w = Window.partitionBy("file_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    l1 = (lines.withColumn("_s", strip("line"))          # stripped once, read by every step below
          .withColumn("_arrow", F.col("line").contains("-->"))
          .withColumn("_blank", F.col("_s") == "")
          .withColumn("_grp", F.sum(F.col("_arrow").cast("int")).over(w)))
    wg = Window.partitionBy("file_id", "_grp").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    l2 = l1.withColumn("_blank_seen", F.max(F.col("_blank").cast("int")).over(wg))
    # one aggregation per cue group: its first line is the arrow line (the head),
    # the following non-blank lines up to the first blank one are its text
    body_part = F.when(~F.col("_arrow") & (F.col("_blank_seen") == 0),
                       F.struct("pos", F.regexp_replace("_s", TAG_RE, "").alias("_t")))
    g = (l2.where(F.col("_grp") > 0).groupBy("file_id", "_grp")
         .agg(F.min_by(F.struct("pos", "_s"), "pos").alias("_h"),
              F.sort_array(F.collect_list(body_part)).alias("_parts")))
    head = F.col("_h._s")
    # both timing groups need at least one char, so an empty first group means no match
    a = F.regexp_extract(head, TIMING_RE, 1)
    b = F.regexp_extract(head, TIMING_RE, 2)
    texts = F.filter(F.transform("_parts", lambda p: p["_t"]), lambda t: t != "")
    return (g.where(~head.startswith("WEBVTT") & ~head.startswith("NOTE"))
            .select("file_id", F.col("_h.pos").alias("seg_pos"),
                    F.when(a != "", T.vtt_seconds(a)).alias("start"),
                    F.when(a != "", T.vtt_seconds(b)).alias("end"),
                    F.array_join(texts, " ").alias("text"), F.size(texts).alias("_n"))
            .where(F.col("start").isNotNull() & F.col("end").isNotNull() & (F.col("_n") > 0))
            .drop("_n"))


def transcripts(segs: DataFrame, titles: DataFrame) -> DataFrame:
    """One transcription per file: title, language, segments in file order."""
    per = (segs.groupBy("file_id")
           .agg(F.sort_array(F.collect_list(F.struct("seg_pos", "start", "end", "text"))).alias("_s")))
    return (titles.join(per, "file_id", "left")
            .select("file_id", "title", "language",
                    F.coalesce(F.transform("_s", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"),
                                                                     x["text"].alias("text"))),
                               F.array().cast("array<struct<start:double,end:double,text:string>>"))
                    .alias("segments")))


def choose_file(files: DataFrame) -> DataFrame:
    """files(video, name) -> the manual English file, else an automatic one, else any (by name)."""
    manual = F.col("name").contains(".en.") & ~F.col("name").contains(".auto.")
    auto = F.col("name").contains(".auto.") | F.col("name").contains(".en.")
    rank = F.when(manual, 0).when(auto, 1).otherwise(2)
    return files.groupBy("video").agg(F.min_by("name", F.struct(rank, F.col("name"))).alias("name"))


# --- subtitle files derived from conversations -------------------------------

def vtt_lines_from_conversations(conv: DataFrame) -> DataFrame:
    """One subtitle file per conversation: header, then one cue per turn.

    Cue start = 5 s per turn, end = start + 4; time styles rotate between
    H:M:S with a dot, M:S with a comma and M:S with a dot; even turns wrap the
    first word in <i>; every fourth file has a NOTE line holding an arrow.
    """
    t = F.col("turn")
    style = F.col("conv_id") % 3

    def stamp(sec):
        hms = F.format_string("%02d:%02d:%06.3f", (sec / 3600).cast("int"), ((sec % 3600) / 60).cast("int"),
                              (sec % 60).cast("double"))
        ms = F.format_string("%02d:%06.3f", (sec / 60).cast("int"), (sec % 60).cast("double"))
        return F.when(style == 0, hms).when(style == 1, F.replace(ms, F.lit("."), F.lit(","))).otherwise(ms)

    start, end = t * 5, t * 5 + 4
    text_lines = F.split(T.s("text"), "\n")
    text_lines = F.when(t % 2 == 0, F.transform(text_lines, lambda x, i: F.when(
        i == 0, F.regexp_replace(x, r"^(\S+)", "<i>$1</i>")).otherwise(x))).otherwise(text_lines)
    cue = F.concat(F.array((t + 1).cast("string"), F.concat(stamp(start), F.lit(" --> "), stamp(end))),
                   text_lines, F.array(F.lit("")))
    header = F.when(t == 0, F.when(F.col("conv_id") % 4 == 0,
                                   F.array(F.lit("WEBVTT"), F.lit(""), F.lit("NOTE timing --> checked"), F.lit("")))
                    .otherwise(F.array(F.lit("WEBVTT"), F.lit("")))).otherwise(F.array().cast("array<string>"))
    rows = conv.select(F.col("conv_id").alias("file_id"), t, F.concat(header, cue).alias("_lines"))
    return rows.select("file_id", F.posexplode("_lines").alias("_i", "line"), "turn") \
        .select("file_id", (F.col("turn") * 100000 + F.col("_i")).alias("pos"), "line")
