import json
import re

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evenkeel.functions import patterns as P
from evenkeel.functions import text as X
from evenkeel.operators import phrases


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_clean_html(spark):
    cases = {
        "a |\t b": "a b",
        '<script>var t="</p>";</script>x': "x",
        "<SCRIPT>\n1\n</SCRIPT >x": "x",
        "a<style media='x'>p{}</style>b": "ab",
        "<!-- <script> -->kept<script>gone</script>": "<!-- <script> -->kept",
        "<scripty>kept</scripty>": "<scripty>kept</scripty>",
        "a<script>never closed": "a",
        "a<!-- never closed <script>1</script>": "a<!-- never closed <script>1</script>",
        "<script-x>kept</script-x>": "<script-x>kept</script-x>",
        "<a title='<script>'>kept</a><p>b</p>": "<a title='<script>'>kept</a><p>b</p>",
        '<script data-a="x > y">gone</script>kept': "kept",
        "<script>s = '<style>'; t = '<!--'</script>kept</style>": "kept</style>",
        "<title>On <script> and <style></title><style>gone</style>": "<title>On <script> and <style></title>",
        "<textarea><script>shown</script></textarea>": "<textarea><script>shown</script></textarea>",
        "<a title=it's>b</a><script>'</script>c": "<a title=it's>b</a>c",
        "1 < 2 <3 <script src=x": "1 < 2 <3 ",
        "<p class='open>a</p><style>b</style>c": "<p class='open>a</p>c",
        "a\r\nb": "a\r b",
        "": "",
        None: None,
    }
    assert apply(spark, list(cases), X.clean_html) == list(cases.values())
    assert apply(spark, ["a | b\n"], lambda c: X.clean_html(c, keep_pipes=True)) == ["a | b "]


def test_clean_html_keeps_long_pages_whole(spark):
    body = "<p>x</p>" * 200_000
    page = "<script>" + "y" * 1_000_000 + "</script>" + body
    assert apply(spark, [page], X.clean_html) == [body]
    values = "<img " + "".join(f"a{i}='{i}>' " for i in range(50_000)) + "src=data:" + "z" * 500_000 + "=>"
    assert apply(spark, [values + page, page + values[:-1]], X.clean_html) == [values + body, body + values[:-1]]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="ab.; \n 　", max_size=12), max_size=20))
def test_sentences_match_a_plain_split(spark, steps):
    def expected(step):
        return [s.strip(P.WHITE_SPACE) for s in re.findall(r"[^.]*\.|[^.]+", step.replace("; ", ". "))]
    assert apply(spark, steps, X.step_sentences) == [expected(s) for s in steps]


def test_direction_sentences(spark):
    rows = [(1, json.dumps(["Mix; stir. Bake.", ""])), (2, "[]"), (3, None), (4, json.dumps(["\n a."]))]
    df = spark.createDataFrame(rows, "k int, directions string")
    got = {tuple(r) for r in phrases.direction_sentences(df, "k").collect()}
    assert got == {(1, 0, 0, "Mix."), (1, 0, 1, "stir."), (1, 0, 2, "Bake."), (1, 1, None, None),
                   (2, None, None, None), (3, None, None, None), (4, 0, 0, "a.")}
    kept = phrases.direction_sentences(df, "k", keep_empty=False).collect()
    assert {r.sentence for r in kept} == {"Mix.", "stir.", "Bake.", "a."}


def test_phrasal_pairs(spark):
    steps = ["Turn the oven off. Cool down", "Stir; take it out; up", "Put a very big red lid on",
             "Mix and pour in"]
    df = spark.createDataFrame([(1, json.dumps(steps)), (2, "[]"), (3, None)], "k int, directions string")
    got = {r.k: r.pairs for r in phrases.phrasal_pairs(df).collect()}
    assert got == {1: ["turn off", "cool down", "take out", "pour in"], 2: [], 3: None}


def test_annotator_is_loaded_once_per_task(spark):
    df = spark.range(100).repartition(2)

    def load():
        state = {"loads": 1}

        def annotate(batch: pd.DataFrame) -> pd.DataFrame:
            return batch.assign(loads=state["loads"], double=batch["id"] * 2)
        return annotate

    out = phrases.annotate(df, load, "id long, loads long, double long")
    assert out.filter("double = id * 2 and loads = 1").count() == 100
