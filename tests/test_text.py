"""Text and JSON expressions on hand-made values."""

from __future__ import annotations

import html

import pytest
from pyspark.sql import functions as F

from layerwright.functions import text as X


def one(spark, column, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_localized_text(spark):
    values = ['{"pt-BR":"x"}', '{"en":"x"}', '{"pt-BR":null}', "not json", None, '{"pt-BR":{"a":1}}']
    assert one(spark, X.localized, *values) == ["x", None, None, None, None, '{"a":1}']
    assert one(spark, X.invalid_json, *values) == [False, False, False, True, False, False]


def test_segments(spark):
    values = ["Decidim::Proposals::Proposal", "Plain", None]
    assert one(spark, X.last_segment, *values) == ["proposal", "plain", None]
    assert one(spark, X.last_segment_lower_first, "A::ParticipatoryProcess") == ["participatoryProcess"]
    assert one(spark, X.last_word_of_camel, "participatoryProcess", "Assembly") == ["process", "assembly"]
    assert one(spark, X.plural, "process", "assembly", "conference", "day") == [
        "processes", "assemblies", "conferences", "days"]


def test_url_part(spark):
    urls = [
        "https://h/processes/a/f/1/proposals/77", "https://h/processes/a?x=1", "https://h/PROCESSES/a",
        "https://h/processes/", "https://h/processes/a/processes/b", None,
    ]
    assert one(spark, lambda c: X.url_part(c, "processes"), *urls) == [
        "a", "a?x=1", "https://h/PROCESSES/a", None, "b", None]
    assert one(spark, lambda c: X.url_part(c, "processes", parity=False), *urls) == ["a", "a", "a", None, "b", None]


def test_digits(spark):
    assert one(spark, X.is_digits, "77", "07", "77?x", "77\n", "") == [True, True, False, False, False]


def test_html_to_text(spark):
    texts = [
        "<p>a<br/>b</p><p>c</p>", "<script>var x='</p>';</script>k", "<style>p{}</style>&lt;b&gt; &amp;amp;",
        "x<!-- <b>no</b> -->y", "1 < 2 & 3 > 2", "&eacute;&#233;&#xE9;&#x1F600; &unknown; &amp", "&copy<b>it</b> &no<i>x</i>", "plain", None,
        "<!DOCTYPE html><a href='x'>t</a>",
    ]
    assert one(spark, X.html_to_text, *texts) == [
        "abc", "k", "<b> &amp;", "xy", "1 < 2 & 3 > 2", "ééé😀 &unknown &", "©it &nox", "plain", None, "t"]


def test_entities_match_the_standard_table(spark):
    names = ["&" + n for n in sorted(html.entities.html5) if n.endswith(";")]
    assert one(spark, X.decode_entities, *names) == [html.unescape(n) for n in names]


def test_drop_hashtags(spark):
    texts = ["a gid://decide/Decidim::Hashtag/1/tag b\n", "gid://decide/Decidim::Hashtag/12/x", "a\n\n", "a\nb"]
    assert one(spark, X.drop_hashtags, *texts) == ["a  b", "gid://decide/Decidim::Hashtag/12/x", "a", "a\nb"]


@pytest.mark.parametrize(("value", "expected"), [
    ("Ação e Reação", "ACAO_E_REACAO"), ("plano-2024 (v1)", "PLANO_2024__V1"), ("straße", "STRASSE"),
    ("  x  ", "X"), ("Œuvre Æ Ø", "OEUVRE_AE_O"),
])
def test_identifier(spark, value, expected):
    assert one(spark, X.identifier, value) == [expected]


def test_title(spark):
    assert one(spark, X.title_from_identifier, "PLANO_2A_B__C_", "AB") == ["Plano 2A B  C", "Ab"]
    assert "PLANO 2A B  C".title() == "Plano 2A B  C"


def test_defaults(spark):
    assert one(spark, X.blank_to_dash, "", None, "x") == ["-", "-", "x"]
    assert one(spark, lambda c: X.first_filled(F.lit(None).cast("string"), c), "", "y") == ["-", "y"]
    assert one(spark, lambda c: X.lookup(c, {"a": "1"}, "z"), "a", "b", None) == ["1", "z", "z"]
    assert one(spark, lambda c: X.blank_where(c, ["-", "us"]), "us", "them") == ["", "them"]


def test_first_matching_column():
    pattern = "(start|creation).*Date"
    assert X.first_matching_column(["id", "endDate", "creationDate", "startDate"], pattern) == "creationDate"
    assert X.first_matching_column(["STARTVOTINGDATE", 3], pattern) == "STARTVOTINGDATE"
    assert X.first_matching_column([1, "id"], pattern) is None


def test_component_link(spark):
    link = X.component_link("https://h/api", F.lit("X::Assembly"), F.col("v"), F.lit(5), F.lit("Proposals"))
    assert one(spark, lambda c: link, "s") == ["https://h/assemblies/s/f/5/proposals"]
    bare = X.component_link("https://h", F.lit("Initiative"), F.col("v"), F.lit(5), F.lit("Proposals"))
    assert one(spark, lambda c: bare, "s") == ["https://h/initiatives/s/f/5/proposals"]
