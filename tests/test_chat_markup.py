"""Chat markup (cases made from its rules) and photo rendering."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import content as CT

GOLDEN = [
    ("**a __b__ c**", "<p><strong>a <em>b</em> c</strong></p>"),  # one mark inside another
    ("~~old **price**~~ new", "<p><del>old <strong>price</strong></del> new</p>"),
    ("two **stars and no end", "<p>two **stars and no end</p>"),  # never closed
    ("snake_case and a*b", "<p>snake_case and a*b</p>"),  # single marks are text
    ("`x` then `y`", "<p><code>x</code> then <code>y</code></p>"),
    ("[one](https://a.example/1) [two](https://b.example/2)",
     '<p><a href="https://a.example/1">one</a> <a href="https://b.example/2">two</a></p>'),
    ("a < b & c > d", "<p>a &lt; b &amp; c &gt; d</p>"),
    ("first\n\nthird", "<p>first<br>\n<br>\nthird</p>"),
    ("", ""),
    (None, ""),
]


def test_chat_goldens(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(GOLDEN)], "i int, t string")
    got = {r.i: r.h for r in df.select("i", T.chat_to_html("t").alias("h")).collect()}
    for i, (_, want) in enumerate(GOLDEN):
        assert got[i] == want, GOLDEN[i][0]


def test_markup_leaks_into_code(spark):
    df = spark.createDataFrame([("`a **b** c`",)], "t string")
    assert df.select(T.chat_to_html("t")).first()[0] == "<p><code>a <strong>b</strong> c</code></p>"


@pytest.mark.parametrize("media,want", [
    ([("photo", "/tmp/x/photo_1_7.jpg", 640, 750, "")],
     '<img src="media/photo_1_7.jpg" alt="" style="max-width: 100%; height: auto; margin-bottom: 1em;" '
     'width="640" height="750">\n<p>hi</p>'),
    ([("photo", "", 0, 0, "Error <x>")],
     '<div style="padding: 1em; background: #fee; border: 1em solid #fcc; margin-bottom: 1em;">Error &lt;x&gt;</div>\n<p>hi</p>'),
    ([("video", "/v.mp4", 1, 1, "")], "<p>hi</p>"),
])
def test_photo_render(spark, media, want):
    df = spark.createDataFrame([("hi", media)],
                               "t string, m array<struct<type:string,local_path:string,width:int,height:int,caption:string>>")
    assert df.select(CT.render_message("t", F.col("m"))).first()[0] == want
