"""Reading of model responses and request bookkeeping, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fragments of error messages after which a call may be tried again: fixed values
RETRIABLE = ("timeout", "timed out", "rate limit", "429", "500", "502", "503", "504", "overloaded", "connection")


def content(body: Column) -> Column:
    """The answer's text: the message's content, else its reasoning, else the first part that is not a thought."""
    get = lambda path: F.nullif(F.get_json_object(body, path), F.lit(""))
    parts = F.from_json(F.get_json_object(body, "$.candidates[0].content.parts"), "array<struct<text:string,thought:boolean>>")
    shown = F.filter(parts, lambda p: ~F.coalesce(p["thought"], F.lit(False)))
    return F.coalesce(get("$.choices[0].message.content"), get("$.choices[0].message.reasoning_content"), F.try_element_at(F.transform(shown, lambda p: p["text"]), F.lit(1)))


def request(model: Column, system: Column, user: Column, most_tokens: Column) -> Column:
    """The body of a chat request as JSON."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.to_json(F.struct(model.alias("model"), F.array(message("system", system), message("user", user)).alias("messages"), most_tokens.alias("max_tokens")))


def filled(template: str, **fields: Column) -> Column:
    """A prompt template with {name} replaced by the field of that name; null fields are blank, other braces stay."""
    parts, rest = [], template
    while (at := re.search(r"\{(\w+)\}", rest)) is not None:
        parts += [F.lit(rest[: at.start()]), F.coalesce(fields[at[1]].cast("string"), F.lit("")) if at[1] in fields else F.lit(at[0])]
        rest = rest[at.end() :]
    return F.concat(*parts, F.lit(rest))


def usage(body: Column) -> Column:
    """struct(prompt, candidate, total) of token counts in either of two shapes, 0 where missing."""
    n = lambda *paths: F.coalesce(*[F.get_json_object(body, p).try_cast("bigint") for p in paths], F.lit(0)).cast("bigint")
    return F.struct(
        n("$.usage.prompt_tokens", "$.usageMetadata.promptTokenCount").alias("prompt"), n("$.usage.completion_tokens", "$.usageMetadata.candidatesTokenCount").alias("candidate"),
        n("$.usage.total_tokens", "$.usageMetadata.totalTokenCount").alias("total"),
    )


def items(payload: Column, schema: str) -> Column:
    """The rows of a payload that is a list, or an object with rows, items or concepts; null for anything else."""
    wrapped = [F.get_json_object(payload, f"$.{k}") for k in ("rows", "items", "concepts")]
    body = F.when(F.ltrim(payload).startswith("["), payload).otherwise(F.coalesce(*wrapped))
    return F.from_json(body, f"array<{schema}>")


def flat_items(payload: Column) -> Column:
    """array<struct<key, value>> of a payload that is one object of texts, such as {"3": "Hund"}; null for any other shape."""
    return F.map_entries(F.from_json(F.when(F.ltrim(payload).startswith("{"), payload), "map<string,string>"))


def same_json(a: Column, b: Column) -> Column:
    """Whether two texts are the same JSON value, whatever the blanks and the order of keys; texts that are no JSON compare as they stand."""
    form = lambda c: F.coalesce(F.to_json(F.try_parse_json(c)), c)
    return form(a).eqNullSafe(form(b))


def slot_round(id_: Column) -> Column:
    """struct(slot, round) numbers inside an id such as "novel:slot:3:round:2", null where absent."""
    part = lambda k: F.nullif(F.regexp_extract(id_, rf"{k}:(\d+)", 1), F.lit("")).cast("int")
    return F.struct(part("slot").alias("slot"), part("round").alias("round"))


def hint(values: list[str], slot: Column, round_: Column, stride: int = 1) -> Column:
    """A value that walks through the list with slot and round."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(slot + round_ * stride, F.lit(len(values))) + 1).cast("int"))


def canonical_json(pairs: dict[str, Column]) -> Column:
    """JSON object with its keys in order."""
    return F.to_json(F.struct(*[pairs[k].alias(k) for k in sorted(pairs)]), {"ignoreNullFields": "false"})


def retriable(error: Column) -> Column:
    low = F.lower(error)
    out = F.lit(False)
    for needle in RETRIABLE:
        out = out | low.contains(needle)
    return F.coalesce(out, F.lit(False))
