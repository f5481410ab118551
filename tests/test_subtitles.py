"""Subtitle parsing edge cases."""

from quire.sources import subtitles as SUB


def parse(spark, text):
    lines = spark.createDataFrame([("f", i, l) for i, l in enumerate(text.split("\n"))], "file_id string, pos int, line string")
    return [(r.start, r.end, r.text) for r in SUB.segments(lines).orderBy("seg_pos").collect()]


def test_basic_and_formats(spark):
    vtt = "WEBVTT\n\n1\n00:00:01.000 --> 00:00:03,500\n<b>Hello</b> there\nworld\n\n2\n00:05.250 --> 00:07.000\nNext\n"
    assert parse(spark, vtt) == [(1.0, 3.5, "Hello there world"), (5.25, 7.0, "Next")]


def test_glued_number_empty_cue_note_malformed(spark):
    vtt = ("WEBVTT\nNOTE a --> b\nignored\n\n00:00:01.000 --> 00:00:02.000\nfirst\n2\n"
           "00:00:03.000 --> 00:00:04.000\n<i></i>\n\nbad --> time\nlost\n"
           "00:00:05.000 --> 00:00:06.000\n\nafter blank\n")
    # the cue number glued to the first cue becomes its text; the tag-only cue is dropped;
    # the malformed timing opens no cue; text after a blank line belongs to no cue
    assert parse(spark, vtt) == [(1.0, 2.0, "first 2")]


def test_choose_file(spark):
    files = spark.createDataFrame([("v", "a.de.vtt"), ("v", "a.en.auto.vtt"), ("v", "a.en.vtt"), ("w", "b.fr.vtt"),
                                   ("w", "b.en.auto.vtt"), ("x", "c.fr.vtt"), ("x", "c.de.vtt")], "video string, name string")
    got = {r.video: r.name for r in SUB.choose_file(files).collect()}
    assert got == {"v": "a.en.vtt", "w": "b.en.auto.vtt", "x": "c.de.vtt"}
