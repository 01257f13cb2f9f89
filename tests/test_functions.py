"""Edge cases of the scalar rules."""

import datetime as dt
import unicodedata
import urllib.parse as up

import pytest
from pyspark.sql import functions as F

from threadsift import refdata
from threadsift.functions import json_text, tags, text, times, urls

URLS = [
    "http://a.com/x/", "http://a.com//", "http://a.com", "HTTP://A.com/", "http://a.com/?flag",
    "http://a.com/p?a=&b=1&&c", "http://a.com/?q=%zz", "http://a.com/?q=%E9",
    "http://a.com/?q=~a*b c", "http://a.com/?q=a=b=c", "http://a.com/?a=1&a=2",
    "http://a.com/?REF=3&x=1", "http://a.com/p#top", "javascript:alert(1)", "",
    "  http://a.com/ ", "http:/foo", "http:", "http:foo", "foo/bar/", "//h/p/",
    "http:////foo", "mailto:a@b", "http://a.com/?q=é+ü%20x", "http://[::1]/a/",
    "http://a.com/?a;b=1", "http://a.com/x?y#z?w", "http:/", "a:b:c", "http://a\tb.com/",
    "http://a.com/?x='1'&y=\\2", "\u00a0http://a.com/p/\u3000", "http://a.com?x=1/",
    "http://a.com/?", "http://a.com/p/?utm_source=x", ":x", "1a://h/",
]


def plain_url(url):
    """The same rule with the standard library, one URL at a time."""
    url = url.strip()
    if not url:
        return url
    parts = up.urlsplit(url)
    query = [
        (k, v) for k, v in up.parse_qsl(parts.query, keep_blank_values=True)
        if k.lower() not in refdata.TRACKING_PARAMS
    ]
    path = parts.path[:-1] if len(parts.path) > 1 and parts.path.endswith("/") else parts.path
    return up.urlunsplit((parts.scheme, parts.netloc, path, up.urlencode(query), ""))


def test_url_matches_the_standard_library(column):
    got = column(URLS, lambda df: urls.with_normal_url(df, "v"), "v")
    assert dict(zip(URLS, got)) == {u: plain_url(u) for u in URLS}


def test_url_is_idempotent(column):
    once = column(URLS, lambda df: urls.with_normal_url(df, "v"), "v")
    again = column(once, lambda df: urls.with_normal_url(df, "v"), "v")
    assert again == once


def test_url_with_broken_host_is_null(column):
    assert column(["http://[::1/x"], lambda df: urls.with_normal_url(df, "v"), "v") == [None]


STAMPS = [
    "2024", "2024-01", "2024-1-2", "now", "epoch", "2024-01-02", "2024-01-02T03",
    "2024-01-02T03:04", "2024-01-02 03:04:05", "2024-01-02T03:04:05Z",
    "2024-01-02T03:04:05.1234567+05:30", "2024-01-02T03:04:05,5", "20240102T030405",
    "20240102", "20240102T03:04:05-0830", "2024-13-01", "2024-02-30", "2024-02-29",
    "2023-02-29", "2024-01-02T24:00:00", "2024-01-02T23:60:00", "2024-01-02T03:04:05+23:59",
    "2024-01-02T03:04:05+24:00", "0000-01-01", "2024-01-02Z", "2024-01-02T03:04:05 UTC",
    "3 days ago", " 2024-01-02 ", "2024-01-02T03:04:05+05:30:15", "2024-0102",
    "2024-01-02T0304", "2024-01-02T", "2024-01-02T03:04:05+0530", "2024-01-02T03:04:05+5:30",
    "2024-01-02T03:04:05.", "2024-01-02x03:04", "2024-01-02T03:04:05+00", "", "|||||",
]


def plain_instant(value):
    try:
        at = dt.datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
    except ValueError:
        return None
    if at.tzinfo is None:
        at = at.replace(tzinfo=dt.timezone.utc)
    return at.astimezone(dt.timezone.utc).replace(tzinfo=None)


def test_iso_instants(column):
    got = column(
        STAMPS,
        lambda df: times.with_instant(df, "v", "t").withColumn("t", F.col("t").cast("timestamp_ntz")),
        "t",
    )
    assert dict(zip(STAMPS, got)) == {s: plain_instant(s) for s in STAMPS}


def test_epoch_that_is_no_number(column):
    got = column(
        ["0", "soon", None],
        lambda df: df.withColumn("t", times.epoch_to_timestamp(F.col("v")).cast("timestamp_ntz")),
        "t",
    )
    assert got == [dt.datetime(1970, 1, 1), None, None]


TITLES = [
    "abcdефгh" + "x" * 7, "abcdж", "abcdeж", "12345", "", "naïve café", "漢字", "Привет",
    "a𝒳bcd", "a𝒳bcde", "Ωabcdef", "\u024f\u0250abcdefg", "日本語 and English words here",
]


def test_latin_share(column):
    def plain(t):
        letters = [c for c in t if unicodedata.category(c).startswith("L")]
        return not letters or sum(ord(c) > 0x24F for c in letters) / len(letters) < 0.2

    got = column(TITLES, lambda df: df.withColumn("b", text.is_latin(F.col("v"))), "b")
    assert dict(zip(TITLES, got)) == {t: plain(t) for t in TITLES}


def test_strip_knows_all_white_space(column):
    spaces = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    assert set(text.WHITESPACE) == set(spaces)
    got = column([f"{spaces}a b{spaces}", spaces], lambda df: df.withColumn("s", text.strip(F.col("v"))), "s")
    assert got == ["a b", ""]


def test_html_snippet(column):
    got = column(
        ["<p>a\u00a0 b</p>\n<br>c", "<b></b>", None, "x" * 600, "1 < 2"],
        lambda df: df.withColumn("s", text.html_snippet(F.col("v"))), "s",
    )
    assert got == ["a b c", "", None, "x" * 500, "1 < 2"]


PLATFORMS = {
    " Reddit ": "reddit", "r/reddit": "reddit", "HN": "hackernews", "Hacker News": "hackernews",
    "so": "stackoverflow", "Stack Overflow": "stackoverflow", "x.com": "x", "twitter": "x",
    "bsky": "bluesky", "AWS re:Post": "vendor-forum", "microsoft q&a": "vendor-forum",
    "aws": "vendor-forum", "vendor": "vendor-forum", "ADE": "ade", "mastodon": "other",
    "": "other", "xx": "other", "other": "other", None: "other",
}


def test_platforms(column):
    got = column(list(PLATFORMS), lambda df: df.withColumn("p", tags.canonical_platform("v")), "p")
    assert dict(zip(PLATFORMS, got)) == PLATFORMS


def test_categories_keep_order_and_repeats(column):
    got = column(
        [["IDP", "bogus", "OCR", "IDP"], None],
        lambda df: df.withColumn("c", tags.known_categories("v")), "c", "array<string>",
    )
    assert got == [["IDP", "OCR", "IDP"], []]


def test_competitors_are_canonical_and_distinct(column):
    got = column(
        [[" uipath", "Reducto", "UIPATH ", None, "nobody"], None],
        lambda df: df.withColumn("c", tags.canonical_competitors("v")), "c", "array<string>",
    )
    assert got == [["UiPath", "Reducto"], []]


def test_fingerprint(column):
    import base64

    def plain(message, stack):
        frame = "".join((stack or "").split("\n")[1:2])
        raw = base64.b64encode(f"{message or ''}|{frame}".encode()).decode()
        return "".join(c for c in raw if c.isascii() and c.isalnum())[:64]

    stacks = ["Error\n  at f (é.js)\n at g", "one line", "", None, "a\n\nb"]
    got = column(
        stacks, lambda df: df.withColumn("f", text.fingerprint(F.lit("Boom ü"), F.col("v"))), "f"
    )
    assert got == [plain("Boom ü", s) for s in stacks]


JSON_TEXTS = {
    '```json\n{"a":1}\n```': '{"a":1}', '```JSON {"a":1}```': '{"a":1}',
    'prose {"a":{"b":2}} end': '{"a":{"b":2}}', "no json": None,
    '{"a":1} and {"b":2}': None, "[1,2]": "[1,2]", "": None, "1 2": None, '"x"': '"x"',
    '{"a":"ab {c} d"} tail': '{"a":"ab {c} d"}', "{": None, "}{": None,
}


def test_json_in_text(column):
    got = column(
        list(JSON_TEXTS),
        lambda df: json_text.with_json(df, "v", "j").withColumn("j", F.to_json("j")), "j",
    )
    assert dict(zip(JSON_TEXTS, got)) == JSON_TEXTS


_HEAD = '{"platform":"x","post_url":"u","post_title":"t","summary":"s"'
RECORDS = {
    _HEAD + "}": None,
    _HEAD + ',"extra":1}': None,
    _HEAD + ',"author_handle":null,"posted_at":null}': None,
    _HEAD + ',"opportunity":null}': "opportunity",
    _HEAD + ',"categories":null}': "categories",
    _HEAD + ',"categories":[1]}': "categories",
    _HEAD + ',"competitors":["a",null]}': "competitors",
    _HEAD + ',"categories":["a"],"competitors":[]}': None,
    _HEAD + ',"posted_at":5}': "posted_at",
    _HEAD.replace('"t"', "1") + "}": "post_title",
    '{"platform":"x"}': "post_url",
    '{"post_url":null,"platform":"x"}': "post_url",
    "1": "record", "[]": "record", "null": "record",
}


def test_record_faults(column):
    got = column(
        list(RECORDS),
        lambda df: df.withColumn(
            "f", json_text.record_fault(json_text.record_kinds(F.parse_json("v")))
        ),
        "f",
    )
    assert dict(zip(RECORDS, got)) == RECORDS


RESPONSES = {
    '{"output_text":"hi"}': "hi",
    '{"output_text":5,"output":[{"content":[{"type":"text","text":"a"},{"type":"z","text":"b"}]},'
    '{"x":1},{"content":[{"type":"output_text","text":"c"}]}]}': "a\nc",
    '{"output":[]}': None, "{}": None, '{"output":null}': None, "": None, "nonsense": None,
}


def test_response_text(column):
    got = column(list(RESPONSES), lambda df: json_text.with_response_text(df, "v", "t"), "t")
    assert dict(zip(RESPONSES, got)) == RESPONSES


@pytest.mark.parametrize("key, expected", [("x", "X"), ("unknown", "unknown")])
def test_label_falls_back_to_key(column, key, expected):
    got = column([key], lambda df: df.withColumn("l", text.label(F.col("v"), refdata.PLATFORM_LABELS)), "l")
    assert got == [expected]
