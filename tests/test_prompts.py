import pytest

from seawarden import fixed_values as fixed
from seawarden.functions.text import quote, template, template_fields
from seawarden.operators import prompts


def rendered(spark, data, messages):
    df = spark.createDataFrame(data, "topic string, audience string")
    return [(r.error, r.messages and [tuple(m) for m in r.messages]) for r in prompts.render(df, messages).collect()]


def test_fills_and_reports_missing(spark):
    messages = [("system", "Be brief."), ("human", "{topic} for {audience}, {topic}!")]
    got = rendered(spark, [("a", "b"), (None, "b"), (None, None), ("", "b")], messages)
    assert got == [
        (None, [("system", "Be brief."), ("human", "a for b, a!")]),
        ("missing variable: topic", None),
        ("missing variable: topic, audience", None),
        (None, [("system", "Be brief."), ("human", " for b, !")]),
    ]


def test_values_are_not_read_as_templates(spark):
    got = rendered(spark, [("{audience}", "it's \\n 'x' {topic}")], [("human", "{topic}|{audience}")])
    assert got == [(None, [("human", "{audience}|it's \\n 'x' {topic}")])]


def test_literal_braces_and_quotes(spark):
    got = rendered(spark, [("t", "a")], [("human", "{{\"k\": '{topic}'}} \\ \n{audience}")])
    assert got == [(None, [("human", "{\"k\": 't'} \\ \na")])]


def test_default_prompt(spark):
    (error, messages), = rendered(spark, [("Spark", "sailors")], fixed.OUTLINE_PROMPT)
    assert error is None and messages[0] == ("system", "You are an expert educational content creator.")
    assert "on the topic of\n            Spark for sailors." in messages[1][1]


def test_messages_without_variables(spark):
    assert rendered(spark, [(None, None)], [("system", "Hi")]) == [(None, [("system", "Hi")])]


@pytest.mark.parametrize("text", ["plain", "it's", "back\\slash", "new\nline", "percent %s", "", "unicode é 船"])
def test_quote(spark, text):
    assert spark.sql(f"SELECT {quote(text)} AS x").first().x == text


def test_template_helpers(spark):
    assert template_fields("{b} {a} {b} {{c}}") == ["b", "a"]
    assert spark.sql(f"SELECT {template('{v:%.1f} kn')} AS x FROM (SELECT cast(NULL AS double) AS v)").first().x is None
