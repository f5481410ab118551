"""The command line over a landing folder: RSS + pages, channel messages, subtitles."""

import glob
import os

from quire import cli

RSS = """<rss version="2.0"><channel><title>Blog</title><description>d</description>
<item><title>Long post</title><link>https://b/1</link><description>{long}</description><guid>1</guid>
<pubDate>Mon, 01 Jan 2024 10:00:00 +0000</pubDate></item>
<item><title>Tiny</title><link>https://b/2</link><description>x</description><guid>2</guid>
<pubDate>Mon, 01 Jan 2024 11:00:00 +0000</pubDate></item>
</channel></rss>"""
VIDEOS = """<rss version="2.0"><channel><title>Videos</title>
<item><title>Talk</title><link>https://v/9</link><guid>9</guid><pubDate>Tue, 02 Jan 2024 10:00:00 +0000</pubDate></item>
</channel></rss>"""
VTT = "WEBVTT\n\n1\n00:00:01.000 --> 00:00:03.000\nHello <b>world</b>\n\n2\n00:01:05.000 --> 00:01:07.000\nBye\n"


def _landing(spark, root):
    land = os.path.join(root, "landing")
    for url, doc in (("https://b/feed", RSS.format(long="word " * 40)), ("https://v/feed", VIDEOS)):
        d = os.path.join(land, "rss", cli.key_of(url))
        os.makedirs(d)
        with open(os.path.join(d, "f.xml"), "w") as f:
            f.write(doc)
    sub = os.path.join(land, "subtitles", cli.key_of("https://v/9"))
    os.makedirs(sub)
    with open(os.path.join(sub, "talk.en.vtt"), "w") as f:
        f.write(VTT)
    spark.createDataFrame([("https://b/1", "<html><body><article><p>Full text.</p></article></body></html>")],
                          "url string, html string").write.parquet(os.path.join(land, "pages"))
    spark.createDataFrame([(5, 1704067300, "message", "**hi** there", None, None, 35, True),
                           (4, 1704067200, "service", "joined", None, None, 28, True)],
                          cli.MESSAGES_SCHEMA).write.parquet(
        os.path.join(land, "telegram_channel", cli.key_of("https://t.me/news")))
    conf = os.path.join(root, "feeds.toml")
    with open(conf, "w") as f:
        f.write(f'''output_directory = "{root}/out"
state_directory = "{root}/state"
landing_directory = "{land}"

[[resources]]
feed_url = "https://b/feed"
parser = "web"
type = "rss"
filters = ["min"]

[[resources]]
feed_url = "https://t.me/news"
parser = "telegram"
type = "telegram_channel"

[[resources]]
feed_url = "https://v/feed"
parser = "youtube"
type = "rss"

[filters.min]
min_length = 50
''')
    return conf


def test_cli_runs(spark, scratch):
    conf = _landing(spark, scratch)
    first = cli.main(["--config", conf, "--now", "1000"], spark=spark)
    got = {r.link: r.content for r in first.pages.collect()}
    assert got["https://b/1"] == "<p>Full text.</p>"
    assert got["https://t.me/news/5"] == "<p><strong>hi</strong> there</p>"
    assert got["https://v/9"] == ("# Talk\n\n**Language:** en\n\n## Transcription\n\n"
                                  "[00:01] Hello world\n\n[01:05] Bye\n\n")
    assert [r.reason for r in first.rejected.collect()] == ["min:min_length"]
    assert glob.glob(os.path.join(scratch, "out", "run_date=*", "part-*"))
    # rerun: every dated item is at or below its feed's mark
    assert cli.main(["--config", conf, "--now", "2000"], spark=spark).pages.count() == 0
    again = cli.main(["--config", conf, "--now", "3000", "--include-all"], spark=spark)
    assert again.pages.count() == 3
    cli.main(["--config", conf, "--clean"], spark=spark)
