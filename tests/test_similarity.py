import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goldweave.functions.similarity import bound_traits, jaro_winkler, jaro_winkler_array, jaro_winkler_bound
from tests.build import jaro_winkler as textbook

texts = st.text(alphabet="abcdé😀 12", max_size=20)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=20))
def test_array_equals_textbook(pairs):
    got = jaro_winkler_array([a for a, _ in pairs], [b for _, b in pairs])
    assert got == pytest.approx([textbook(a, b) for a, b in pairs], abs=1e-12)


def test_long_texts_keep_short_ones_right():
    left, right = ["abc" * 7000, "dixon", ""], ["abc" * 6999 + "x", "dicksonx", "x"]
    got = jaro_winkler_array(left, right)
    assert got[0] > 0.99 and got[1] == pytest.approx(0.8133333, abs=1e-6) and got[2] == 0.0


def test_bound_is_never_below(spark):
    random.seed(5)
    word = lambda: "".join(random.choice("abcdefgh é😀") for _ in range(random.randint(0, 16)))
    pairs = pd.DataFrame([(word(), word()) for _ in range(4000)], columns=["a", "b"])
    df = spark.createDataFrame(pairs)
    sided = df.select(
        "a", "b", F.struct(*[c.alias(n) for n, c in bound_traits("a", "t").items()]).alias("l"),
        F.struct(*[c.alias(n) for n, c in bound_traits("b", "t").items()]).alias("r"),
    )
    low = sided.withColumn("s", jaro_winkler("a", "b")).withColumn("bound", F.expr(jaro_winkler_bound("t")))
    assert low.filter("bound < s - 1e-9").count() == 0
    assert low.filter("bound < 0.8").count() > 0
