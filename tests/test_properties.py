"""Property tests: the column expressions against plain-Python models of the
source semantics, on generated inputs (each batch evaluated in one Spark job)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.functions import bucketize, split_fields, tokenize

SETTINGS = settings(max_examples=25, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXT = st.text(alphabet=st.sampled_from(list('ab ,|"()*\tÉé.\n')), max_size=12)


def java_split(s: str, sep: str) -> list[str]:
    """Java String.split(literal): trailing empty strings removed; "" -> [""]."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def pig_tokens(s: str) -> list[str]:
    return [t for t in re.split(r'[ ",()*]+', s.lower()) if t]


def evaluate(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.r for r in df.select("i", expr.alias("r")).orderBy("i").collect()]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=30), st.sampled_from([",", "|", " "]))
def test_split_dialects_match_models(spark, lines, sep):
    assert evaluate(spark, lines, split_fields("v", sep, drop_trailing_empty=True)) == [java_split(s, sep) for s in lines]
    assert evaluate(spark, lines, split_fields("v", sep)) == [s.split(sep) for s in lines]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_tokenize_matches_model(spark, texts):
    assert evaluate(spark, texts, tokenize("v")) == [pig_tokens(t) for t in texts]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-5, 70)), min_size=1, max_size=40))
def test_bucketize_matches_model(spark, ages):
    def right(a):
        return None if a is None else "0-18" if a <= 18 else "18-35" if a <= 35 else "35-50" if a <= 50 else "50+"

    def left(a):
        if a is None:
            return "Unknown"
        for edge, label in zip((18, 25, 35, 45, 55), ("<18", "18-24", "25-34", "35-44", "45-54")):
            if a < edge:
                return label
        return "55+"
    r = bucketize("v", (18, 35, 50), ("0-18", "18-35", "35-50", "50+"), closed="right")
    lft = bucketize("v", (18, 25, 35, 45, 55), ("<18", "18-24", "25-34", "35-44", "45-54", "55+"),
                    closed="left", default="Unknown")
    assert evaluate(spark, ages, r, "v int") == [right(a) for a in ages]
    assert evaluate(spark, ages, lft, "v int") == [left(a) for a in ages]
