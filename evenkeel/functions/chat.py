"""Column expressions for chat prompts, token ids, labels and padding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import patterns as P

MESSAGE = T.StructType([
    T.StructField("content", T.StringType()),
    T.StructField("role", T.StringType()),
])


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around a message; ChatML by default.

    `default_system` is put in front when the first message is no system
    message, as some models' own templates do.
    """

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    answer_role: str = "assistant"
    default_system: str | None = None


CHATML = ChatTemplate()


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def render_prompt(messages: Column, template: ChatTemplate = CHATML) -> Column:
    """Messages to one prompt that asks for an answer.

    Null when a role or content is null: a message is never left out silently.
    """
    def turn(role: Column, content: Column) -> Column:
        return F.concat(F.lit(template.start), role, F.lit("\n"), content, F.lit(template.end))

    body = F.array_join(F.transform(messages, lambda m: turn(m["role"], m["content"])), "")
    ask = F.lit(f"{template.start}{template.answer_role}\n")
    if template.default_system is not None:
        system = turn(F.lit("system"), F.lit(template.default_system))
        first_role = F.try_element_at(messages, F.lit(1))["role"]
        body = F.concat(F.when(first_role.eqNullSafe("system"), F.lit("")).otherwise(system), body)
    incomplete = F.exists(messages, lambda m: m["role"].isNull() | m["content"].isNull())
    return F.when(~incomplete, F.concat(body, ask))


@dataclass(frozen=True)
class HashTokenizer:
    """Words and marks with hashed ids: the default, built from SQL functions.

    Ids below `reserved` are left for special tokens.
    """

    vocab_size: int = 32_768
    reserved: int = 16
    pad_id: int = 0
    eos_id: int = 1

    def ids(self, text: Column) -> Column:
        tokens = F.regexp_extract_all(text, F.lit(P.RX_TOKEN), F.lit(0))
        return F.transform(tokens, self._id)

    def count(self, text: Column) -> Column:
        return F.regexp_count(text, F.lit(P.RX_TOKEN))

    def _id(self, token: Column) -> Column:
        digest = F.conv(F.substring(F.md5(token), 1, 7), 16, 10).cast("int")
        return digest % (self.vocab_size - self.reserved) + self.reserved


HASH_TOKENIZER = HashTokenizer()


def repeated(value: int, times: Column) -> Column:
    return F.array_repeat(F.lit(value), times.cast("int"))


def example_ids(prompt_ids: Column, response_ids: Column) -> Column:
    return F.concat(prompt_ids, response_ids)


def example_labels(prompt_ids: Column, response_ids: Column) -> Column:
    """Loss on the response only."""
    return F.concat(repeated(P.IGNORED_LABEL, F.size(prompt_ids)), response_ids)


def masked_labels(input_ids: Column, prompt_size: Column) -> Column:
    """The same labels from joined ids and the length of their prompt."""
    answer = F.slice(input_ids, prompt_size + 1, F.greatest(F.size(input_ids) - prompt_size, F.lit(0)))
    return F.concat(repeated(P.IGNORED_LABEL, prompt_size), answer)


def padded(values: Column, width: Column, fill: int, side: str = "right") -> Column:
    pad = repeated(fill, width - F.size(values))
    return F.concat(values, pad) if side == "right" else F.concat(pad, values)
