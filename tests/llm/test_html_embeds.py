"""Embedded elements of a page: self-closed, left open, nested; the article stays whole and what they hold stays out."""

import pytest

from ratesmith.llm import html_extract

WANT = "First sentence of an article, which is long.\nAnother paragraph with bold words in it, long too."
BODY = "<p>First sentence of an article, which is long.</p><p>Another paragraph with <b>bold</b> words in it, long too.</p>"
HEADS = [
    "<svg class='icon'/>", "<svg viewBox='0 0 1 1' />", "<math/>", "<svg><path d='M0'/>", "<svg>", "<select><option>One<option>Two", "<object data='x'>", "<video src='x'>", "<audio src='x'>", "<canvas>",
    "<svg><title>no</title><text>no</text></svg>", "<svg><style/><text>no</text></svg>", "<svg><svg></svg><text>no</text></svg>", "<object><p>no</p><object><div>no</div></object>no</object>", "<select><option>no</option></select>", "<video><p>no</p><hr>no</video>",
]


@pytest.mark.parametrize("head", HEADS)
def test_the_article_stays(spark, head):
    pages = [f"<html><body><header class='masthead'>{head}</header><div class='main'>{BODY}</div><footer><svg><text>no</text></svg></footer></body></html>", f"<body>{head}<div class='main'>{BODY}</div><svg></svg></body>"]
    for page in pages:
        elements, stream = html_extract.parse(page)
        assert "\n".join(t for _, t, _ in html_extract.blocks(elements, stream) if t != "OneTwo") == WANT
        assert html_extract.main_text(page, None) == WANT


def test_an_embed_parts_no_paragraph():
    elements, stream = html_extract.parse("<p>Watch <video src='x'><p>no</p><ul><li>no</ul></video>it now</p>")
    assert [t for _, t, _ in html_extract.blocks(elements, stream)] == ["Watch it now"]


def test_query(spark, tmp_path):
    import __spark_entry__

    rows = [(i, f"http://h.example/{i}", f"<body><header><svg class='i'/></header><div class='main'>{BODY}</div></body>") for i in range(3)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = __spark_entry__.queries()["op3_html_extraction"](spark, str(tmp_path)).collect()
    assert [r.text for r in got] == [WANT] * 3
