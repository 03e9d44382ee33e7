"""Pages that a vision model reads: requests, replies, one retry, and the elements they give.

A provider is any object with `chat(payload) -> dict` (choices, usage, elapsed_seconds) that may raise
`ProviderError`; it is made in the worker.  Failures become an error column, never a failed job.
"""

from __future__ import annotations

import base64
import json
import math
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.provider import BAD_CONFIDENCE, BAD_TYPE, COMPACT, ELEMENT_TYPES, EMPTY, NO_CHOICES, NO_TEXT, NOT_JSON, PROMPT, REFUSED, RETRY, TRUNCATED, chat_content, chat_error, element_error, page_schema
from ..functions.text import strip
from ..options import Options

REPLY = "summary string, elements array<struct<type:string,text:string,confidence:double>>, unresolved_visuals array<string>"


class ProviderError(RuntimeError):
    """A request or a reply that cannot be used."""


class Provider(Protocol):
    def chat(self, payload: dict) -> dict: ...


def recover_json(content: str) -> dict:
    """The first JSON object of a reply, fences taken off, that holds a list of elements; prose before it is skipped."""
    if content.startswith("```"):
        content = content.partition("\n")[2].rpartition("```")[0].strip() or content.partition("\n")[2]
    decode, at = json.JSONDecoder().raw_decode, content.find("{")
    while at >= 0:
        try:
            found = decode(content[at:])[0]
        except json.JSONDecodeError:
            found = None
        if isinstance(found, dict) and isinstance(found.get("elements"), list):
            return found
        at = content.find("{", at + 1)
    raise ProviderError(NOT_JSON)


def checked(reply: dict) -> dict:
    """The reply, if each of its elements has a known type, a text and a confidence from 0 to 1."""
    for e in reply["elements"]:
        if not isinstance(e, dict) or e.get("type") not in ELEMENT_TYPES:
            raise ProviderError(BAD_TYPE)
        if not isinstance(e.get("text"), str):
            raise ProviderError(NO_TEXT)
        sure = e.get("confidence")
        if not isinstance(sure, (int, float)) or math.isnan(sure) or not 0 <= sure <= 1:
            raise ProviderError(BAD_CONFIDENCE)
    return reply


def parse_replies(replies: DataFrame, content: str = "content") -> DataFrame:
    """Adds reply (summary, elements, unresolved_visuals) and error; rows keep their other columns."""
    columns = [c for c in replies.columns if c not in ("reply", "error")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in replies.select(*columns).schema)

    def one(text: str | None) -> tuple[str | None, str | None]:
        try:
            return (json.dumps(checked(recover_json(text))), None) if text is not None else (None, None)
        except ProviderError as e:
            return None, str(e)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [one(t) for t in batch[content]]
            yield batch.assign(__reply=pd.Series([x for x, _ in found], dtype=object, index=batch.index), error=pd.Series([y for _, y in found], dtype=object, index=batch.index))

    parsed = replies.select(*columns).mapInPandas(run, f"{schema}, __reply string, error string")
    return parsed.withColumn("reply", F.from_json("__reply", REPLY)).drop("__reply")


def read_response(responses: DataFrame, response: str = "response") -> DataFrame:
    """Adds content and error of chat responses, and where there is content its reply, recovered and checked."""
    opened = responses.withColumns({"content": chat_content(F.col(response)), "chat_error": chat_error(F.col(response))})
    return parse_replies(opened).withColumn("error", F.coalesce("chat_error", "error")).drop("chat_error")


def valid_elements(rows: DataFrame, elements: str = "elements") -> DataFrame:
    """Adds error for element arrays that are columns already; nothing leaves the JVM."""
    return rows.withColumn("error", element_error(F.col(elements)))


def payload(options: Options, page: int, image: bytes, retry: bool = False) -> dict:
    """The chat request for a page; a strict schema for the hosted provider, a shorter prompt and a larger limit on retry."""
    prompt = (RETRY if retry else PROMPT + (COMPACT if options.provider == "local" else "")) % page
    content = [{"type": "text", "text": prompt}, {"type": "image_url", "image_url": {"url": "data:image/png;base64," + base64.b64encode(image).decode()}}]
    request = {"model": options.model(), "messages": [{"role": "user", "content": content}]}
    if options.provider == "openai":
        form = {"type": "json_schema", "json_schema": {"name": "page", "strict": True, "schema": json.loads(page_schema())}}
        return request | {"max_completion_tokens": options.vlm_max_tokens, "response_format": form}
    return request | {"max_tokens": max(options.vlm_max_tokens, options.retry_max_tokens) if retry else options.vlm_max_tokens}


def content_of(response: dict) -> str:
    choices = response.get("choices") or []
    first = choices[0] if choices else {}
    message = first.get("message") or {}
    text = message.get("content")
    problems = [
        (not choices, NO_CHOICES),
        (first.get("finish_reason") == "length", TRUNCATED),
        (bool(message.get("refusal")), REFUSED),
        (not isinstance(text, str) or not text.strip(), EMPTY),
    ]
    for bad, why in problems:
        if bad:
            raise ProviderError(why)
    return text.strip()


def extract_page(provider: Provider, options: Options, page: int, image: bytes) -> tuple[dict, dict]:
    """(reply, response) of a page.  A local provider's unusable reply is asked for once more; a failed request is not."""
    response = provider.chat(payload(options, page, image))
    try:
        return checked(recover_json(content_of(response))), response
    except ProviderError:
        if options.provider != "local" or options.vlm_retries < 1:
            raise
    response = provider.chat(payload(options, page, image, retry=True))
    try:
        return checked(recover_json(content_of(response))), response
    except ProviderError as e:
        raise ProviderError(f"Local VLM returned invalid JSON after retry: {e}") from e


def extract_pages(pages: DataFrame, make_provider: Callable[[], Provider], options: Options) -> DataFrame:
    """(doc_id, page_num, elements, usage, elapsed_seconds, error) of pages (doc_id, page_num, image binary).

    Filter to the pages to send first: no filter passes through a Python map.  Each page is asked for by itself,
    and any failure is that page's error.
    """
    schema = "doc_id long, page_num int, elements array<struct<type:string,text:string,confidence:double>>, usage struct<prompt_tokens:int,completion_tokens:int,total_tokens:int>, elapsed_seconds double, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make_provider()
        for batch in batches:
            out = []
            for doc_id, page, image in batch.itertuples(index=False):
                try:
                    reply, response = extract_page(provider, options, int(page), bytes(image or b""))
                    usage = response.get("usage") or {}
                    elements = [{"type": e["type"], "text": e["text"].strip(), "confidence": float(e["confidence"])} for e in reply["elements"]]
                    out.append((doc_id, page, elements, {k: usage.get(k) for k in ("prompt_tokens", "completion_tokens", "total_tokens")}, response.get("elapsed_seconds"), None))
                except Exception as e:  # one page's failure is a row, whatever it was
                    out.append((doc_id, page, None, None, None, str(e) if isinstance(e, ProviderError) else f"unexpected failure: {type(e).__name__}"))
            yield pd.DataFrame(out, columns=["doc_id", "page_num", "elements", "usage", "elapsed_seconds", "error"])

    return pages.select("doc_id", "page_num", "image").mapInPandas(run, schema)


def vision_elements(extractions: DataFrame, options: Options = Options()) -> DataFrame:
    """One row an element of (doc_id, page_num, elements), numbered from 1 on each page; they have no order and no box."""
    rows = extractions.select("doc_id", "page_num", F.posexplode("elements").alias("at", "e"))
    return rows.select("doc_id", "page_num", F.format_string("p%04d_vlm_e%04d", F.col("page_num"), F.col("at") + 1).alias("element_id"), "e.type", strip("e.text").alias("text"), F.lit("vlm").alias("source_parser"), F.lit(options.provider).alias("provider"), F.lit(options.model()).cast("string").alias("model"), "e.confidence")


def stream_reply(lines: DataFrame) -> DataFrame:
    """Replies of captured event streams: lines (request, seq, line) to (request, content, usage, error).

    Data lines up to the end mark count, in order; what is no JSON is skipped; the last usage wins.
    """
    data = lines.filter(F.startswith(strip("line"), F.lit("data:"))).withColumn("data", strip(F.substring(strip("line"), 6, 1 << 30)))
    ended = F.max(F.col("data") == "[DONE]").over(Window.partitionBy("request").orderBy("seq"))
    chunk = F.from_json("data", "choices array<struct<delta:struct<content:string>>>, usage struct<prompt_tokens:int,completion_tokens:int,total_tokens:int>")
    live = data.withColumn("ended", ended).filter("not ended").withColumn("c", chunk)
    part = F.get(F.col("c.choices"), F.lit(0))["delta"]["content"]
    joined = live.groupBy("request").agg(F.array_sort(F.collect_list(F.when(F.coalesce(part, F.lit("")) != "", F.struct("seq", part.alias("part"))))).alias("parts"), F.max_by("c.usage", F.when(F.col("c.usage").isNotNull(), F.col("seq"))).alias("usage"))
    text = F.array_join(F.transform("parts", lambda p: p["part"]), "")
    return joined.select("request", F.nullif(text, F.lit("")).alias("content"), "usage", F.when(text == "", "Streaming provider returned no assistant text.").alias("error"))


def gateway_error(models: DataFrame, model: str) -> DataFrame:
    """Why a gateway is not healthy, of its sorted model ids (models array): null if it lists the model."""
    return models.withColumn("error", F.when(~F.array_contains("models", model), F.concat(F.lit(f"Configured local model '{model}' was not returned by /models. Available models: "), F.array_join("models", ", "))))
