from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions import text


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", fn("v").alias("out")).orderBy("i").collect()]


def test_present(spark):
    values = [None, "", "  ", "null", " NULL ", "nulls", "x", "0"]
    assert apply(spark, text.is_present, values) == [False, False, False, False, False, True, True, True]


def test_mask_account(spark):
    cases = {
        "123456789012345": "123456|9012345",
        "234567890123456": "234567|0123456",
        "98765432109876": "987654|2109876",
        "87654321098765": "876543|1098765",
        "12345": "12345",
        "1234567890123": "1234567890123",
        "": "",
        None: None,
    }
    assert apply(spark, text.mask_account, cases) == list(cases.values())


def test_clip_amount(spark):
    cases = {
        "100000.50": "100000.50",
        "1234567890121212.34": "123456789012",
        "123233333333332222222222111111.45": "123233333333",
        "123456789012.5": None,
        "12345678901.99": "12345678901.99",
        "": "",
        None: None,
    }
    assert apply(spark, text.clip_amount, cases) == list(cases.values())
    kept = apply(spark, lambda c: text.clip_amount(c, keep_exact_12=True), cases)
    assert kept == [v if k != "123456789012.5" else k for k, v in cases.items()]


def test_quote_before_braces(spark):
    cases = {
        "Hello}}": 'Hello"}}',
        "Test}}}": 'Test"}}}',
        "No braces": "No braces",
        "Multiple}}}}": 'Multiple"}}}}',
        "Single}": 'Single"}',
        "Middle}Text": "Middle}Text",
        "a}b}}": 'a}b"}}',
        "}}": '"}}',
        "one}\ntwo}": 'one}\ntwo"}',
        "": "",
        None: None,
    }
    assert apply(spark, text.quote_before_braces, cases) == list(cases.values())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='a}{" \n', max_size=12).filter(lambda t: not t.endswith("\n")), max_size=200))
def test_quote_before_braces_equals_plain_pattern(spark, values):
    plain = lambda c: F.regexp_replace(c, "(.*?)(\\}{1,})$", '$1"$2')
    if values:
        assert apply(spark, text.quote_before_braces, values) == apply(spark, plain, values)


def test_quote_before_braces_is_linear(spark):
    """A long text full of braces in the middle costs no more than its length."""
    long = "}" * 200_000 + "x"
    assert apply(spark, text.quote_before_braces, [long, long[:-1]]) == [long, '"' + long[:-1]]


def test_extract_quoted_all(spark):
    values = ['a "b" c "d e" ""', 'one " only', "none", "", None, '"two\nlines" "x"']
    want = [["b", "d e", ""], [], [], [], None, re.findall(r'"(.*?)"', '"two\nlines" "x"')]
    assert apply(spark, text.extract_quoted_all, values) == want


def test_extract_quoted_styles(spark):
    cases = [
        ("plain", 'a "b" "c"', "b"),
        ("plain", "nothing", ""),
        ("backslash", r"say \"hi there\" and \"no\"", "hi there"),
        ("backslash", 'plain "quote"', ""),
        ("backslash_apostrophe", r"""x \'"inner"\' y""", "inner"),
        ("backslash_apostrophe", """'"inner"'""", ""),
        ("doubled", r'k=""value\"" rest', "value"),
        ("doubled", '""value""', ""),
    ]
    for style, value, want in cases:
        assert apply(spark, lambda c: text.extract_quoted(c, style), [value]) == [want], (style, value)  # noqa: B023
    assert apply(spark, lambda c: text.extract_quoted(c, "plain"), [None]) == [None]


def test_keep_chars(spark):
    values = ["A-12 3", "abc", " ", None]
    assert apply(spark, text.keep_chars, values) == ["123", None, None, None]
    assert apply(spark, lambda c: text.keep_chars(c, blank_as_null=False), values) == ["123", "", "", None]


def test_row_json_and_pair_map(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "z")], "n int, k string, v string")
    out = df.select(text.row_json("n", "k", "v").alias("j"), text.pair_map("k", "v").alias("m")).collect()
    assert [r.j for r in out] == ['{"n":1,"k":"a"}', '{"n":2,"v":"z"}']
    assert [r.m for r in out] == [{"a": None}, None]
    whole = df.select(text.row_json(*df.columns).alias("j")).collect()
    assert [r.j for r in whole] == [r.j for r in out]
