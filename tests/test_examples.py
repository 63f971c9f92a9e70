import json
import random
from collections import defaultdict
from pathlib import Path
from statistics import median

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import chat as C
from evenkeel.functions.order import seeded_order
from evenkeel.operators import examples
from evenkeel.sources import shuffled

MESSAGES = "k int, input array<struct<role:string,content:string>>"


def prompts(spark, rows, template=C.CHATML):
    df = spark.createDataFrame(rows, MESSAGES)
    return [r.prompt for r in examples.chat_render(df, "input", template).orderBy("k").collect()]


def test_chat_render(spark):
    assert prompts(spark, [
        (0, [("user", "hi")]), (1, [("system", "s"), ("user", "u")]), (2, [("user", None)]), (3, None),
        (4, [])]) == [
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n",
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\n",
        None, None, "<|im_start|>assistant\n"]


def test_default_system_message(spark):
    template = C.ChatTemplate(default_system="D")
    assert prompts(spark, [(0, [("user", "u")]), (1, [("system", "s")])], template) == [
        "<|im_start|>system\nD<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\n",
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>assistant\n"]


def test_json_round_trip(spark):
    rows = [(1, ("user", 'say "hi"\n<b>é')), (2, ("user", None))]
    df = spark.createDataFrame(rows, "k int, input struct<role:string,content:string>")
    stored = examples.encode_message(df)
    assert json.loads(stored.filter("k = 1").first().input)["content"] == rows[0][1][1]
    back = {r.k: r.input for r in examples.decode_messages(stored).collect()}
    assert [(m.role, m.content) for m in back[1]] == [rows[0][1]]
    assert [(m.role, m.content) for m in back[2]] == [("user", None)]


def test_labels_and_padding(spark):
    df = spark.createDataFrame([(1, [1, 2], [3]), (2, [], [4]), (3, [5], [])],
                               "k int, prompt_ids array<int>, response_ids array<int>")
    got = {r.k: (r.input_ids, r.labels) for r in examples.label_mask(df).collect()}
    assert got == {1: ([1, 2, 3], [-100, -100, 3]), 2: ([4], [4]), 3: ([5], [-100])}
    joined = examples.join_examples(df).select("k", "input_ids", C.masked_labels(
        F.col("input_ids"), F.col("prompt_size")).alias("labels"))
    assert {r.k: (r.input_ids, r.labels) for r in joined.collect()} == got
    wide = df.select("k", C.padded(F.col("prompt_ids"), F.lit(3), 0).alias("r"),
                     C.padded(F.col("prompt_ids"), F.lit(3), -100, "left").alias("l"))
    assert wide.filter("k = 1").first()[1:] == ([1, 2, 0], [-100, 1, 2])


def test_tokenizer(spark):
    df = spark.createDataFrame([("ab, ab c", "x")], "prompt string, response string")
    row = examples.tokenize_examples(df).first()
    a, comma, b, c = row.prompt_ids
    assert a == b and len({a, comma, c}) == 3 and min(row.prompt_ids) >= C.HASH_TOKENIZER.reserved
    assert row.response_ids[-1] == C.HASH_TOKENIZER.eos_id and len(row.response_ids) == 2
    assert df.select(C.HASH_TOKENIZER.count(F.col("prompt"))).first()[0] == 4


def test_model_tokenizer(spark):
    def load():
        from tokenizers import Tokenizer, models, pre_tokenizers
        model = Tokenizer(models.WordLevel({"a": 0, "b": 1, "</s>": 2, "?": 3}, unk_token="?"))
        model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return lambda texts: [e.ids for e in model.encode_batch(texts)]

    df = spark.createDataFrame([("a b", "b"), ("z", None)], "prompt string, response string")
    rows = examples.tokenize_with_model(df, load, " </s>").collect()
    assert [(r.prompt_ids, r.response_ids) for r in rows] == [([0, 1], [1, 2]), ([3], None)]


@pytest.mark.parametrize("n,size", [(1, 8), (7, 8), (64, 8), (1000, 8), (1000, 64), (50, 100)])
def test_batches_against_brute_force(spark, n, size):
    rng = random.Random(n)
    rows = [(f"k{i}", [i] * rng.randrange(1, 9)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    got = {r.k: r for r in examples.training_batches(df, "k", size).collect()}
    order = {r.k: r.o for r in df.select("k", seeded_order(F.col("k"), 42).alias("o")).collect()}
    batches = defaultdict(list)
    for at, k in enumerate(sorted(order, key=order.get)):
        assert (got[k].position, got[k].batch) == (at + 1, at // size)
        batches[at // size].append(k)
    ids = dict(rows)
    for keys in batches.values():
        width = max(len(ids[k]) for k in keys)
        for k in keys:
            pad = width - len(ids[k])
            assert got[k].input_ids == ids[k] + [0] * pad
            assert got[k].labels == ids[k] + [-100] * pad
            assert got[k].attention_mask == [1] * len(ids[k]) + [0] * pad


def test_examples_are_shuffled_once(spark):
    df = spark.range(10).select("id", F.array(F.lit(1)).alias("input_ids"), F.array(F.lit(1)).alias("labels"))
    plan = examples.training_batches(df, "id")._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(_shard" in line]
    assert len(moved) == 1
    wide = [line for line in plan.splitlines() if "Sort [_shard" in line]
    assert len(wide) == 1


def test_ordered_batches_are_written_where_they_are_made(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"k{i}", [i] * rng.randrange(1, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    path = f"{tmp_path}/b"
    shuffled.write_ordered_batches(df, "k", path, per_file=7)
    files = sorted(Path(path).glob("start=*/*.parquet"))
    assert len(files) == len(set(f.parent for f in files)) == -(-500 // 56)
    held = [r for f in files for r in pq.read_table(f, partitioning=None).to_pylist()]
    assert [r["position"] for r in held] == list(range(1, 501))
    expected = {r.k: r.asDict() for r in examples.training_batches(df, "k").collect()}
    assert held == [expected[r["k"]] for r in held]
    schema = T.StructType.fromDDL("k string, batch bigint, input_ids array<int>")
    rest = shuffled.read_shuffled(spark, path, schema, after=60).orderBy("position").collect()
    assert [(r.position, r.k, r.batch) for r in rest] == [(r["position"], r["k"], r["batch"]) for r in held[60:]]


def test_ids_are_joined_without_a_string_each(spark):
    from evenkeel.plans import queries

    df = spark.createDataFrame([([1, 20, -100],), ([],), (None,), ([7],)], "ids array<int>")
    got = df.select(queries.joined_ids("ids"), queries.joined("ids")).collect()
    assert [a for a, _ in got] == [b for _, b in got] == ["1,20,-100", "", None, "7"]
    for name in ("training_batches", "ordered_batches", "tokenize_examples", "label_mask"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "array_join(cast" not in plan


def test_token_stats(spark):
    texts = ["a b c", "a", "a b", "", None, "a b c d e f"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    row = examples.token_stats(df, F.col("t")).first()
    counts = [3, 1, 2, 0, 6]
    assert (row.rows, row.max_tokens, row.mean_tokens, row.median_tokens) == (
        5, 6, sum(counts) / 5, median(counts))
    assert row.attn_matrix_bytes_fp16_max == 72
    assert examples.token_stats(df, F.col("t"), first=2, key="k").first().max_tokens == 3
