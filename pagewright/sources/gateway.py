"""A chat gateway over HTTP: the provider that `vision.extract_pages` makes in a worker, and its checks.

What the outside sees of a failure is one of a few messages; replies' bodies and keys are never in them.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

from ..functions.provider import STATUS_MESSAGES
from ..operators.vision import ProviderError
from ..options import first_of


def base_url(url: str) -> str:
    """Ends in exactly one /v1."""
    url = url.rstrip("/")
    while url.endswith("/v1"):
        url = url.removesuffix("/v1")
    return f"{url}/v1"


def failure(status: int) -> str:
    server = f"gateway server error (HTTP {status}); retry later or inspect server logs" if status // 100 == 5 else f"provider request failed with HTTP {status}"
    return STATUS_MESSAGES.get(status, server)


class Gateway:
    """An OpenAI-compatible gateway; `opener` stands in for the network in tests."""

    def __init__(self, url: str, key: str, timeout: int = 120, stream: bool = False, opener=urllib.request.urlopen):
        self.url, self.key, self.timeout, self.stream, self.opener = base_url(url), key, timeout, stream, opener

    def _open(self, path: str, payload: dict | None):
        body = None if payload is None else json.dumps(payload).encode()
        request = urllib.request.Request(self.url + path, body, {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"})
        try:
            return self.opener(request, timeout=self.timeout)
        except urllib.error.HTTPError as e:
            raise ProviderError(failure(e.code)) from None
        except (urllib.error.URLError, TimeoutError) as e:
            raise ProviderError(f"provider connection or timeout failure: {getattr(e, 'reason', e)}") from None

    def models(self) -> list[str]:
        """Sorted ids of the models that the gateway lists."""
        with self._open("/models", None) as reply:
            return sorted(str(m["id"]) for m in json.load(reply).get("data", []) if m.get("id"))

    def require(self, model: str) -> list[str]:
        found = self.models()
        if model not in found:
            raise ProviderError(f"Configured local model '{model}' was not returned by /models. Available models: {', '.join(found)}")
        return found

    def chat(self, payload: dict) -> dict:
        """One chat completion, with the seconds it took; streamed replies are put together and timed to the first token."""
        began = time.perf_counter()
        if not self.stream:
            with self._open("/chat/completions", payload) as reply:
                try:
                    found = json.load(reply)
                except ValueError:
                    raise ProviderError("Provider response was not valid JSON.") from None
            return found | {"elapsed_seconds": round(time.perf_counter() - began, 3)}
        with self._open("/chat/completions", payload | {"stream": True}) as reply:
            text, usage, first = assembled(reply)
        ended = time.perf_counter()
        if not text:
            raise ProviderError("Streaming provider returned no assistant text.")
        seconds = ended - first if first else None
        done = usage.get("completion_tokens")
        speed = round(done / seconds, 3) if isinstance(done, int) and seconds else None
        return {"choices": [{"message": {"content": text}}], "usage": usage, "elapsed_seconds": round(ended - began, 3), "time_to_first_token_seconds": round(first - began, 3) if first else None, "decode_tps": speed}


def assembled(lines: Iterator[bytes]) -> tuple[str, dict, float | None]:
    """Text, last usage and time of the first token of an event stream; what is no JSON is skipped."""
    parts: list[str] = []
    usage: dict = {}
    first = None
    for line in lines:
        kind, _, data = line.decode("utf-8", "replace").strip().partition(":")
        if kind != "data":
            continue
        if data.strip() == "[DONE]":
            break
        try:
            event = json.loads(data)
        except ValueError:
            continue
        usage = event.get("usage") or usage
        delta = ((event.get("choices") or [{}])[0].get("delta") or {}).get("content")
        if isinstance(delta, str) and delta:
            first = first or time.perf_counter()
            parts.append(delta)
    return "".join(parts), usage, first


def from_environment(env: dict[str, str], timeout: int = 120, stream: bool = False) -> Gateway:
    """The local gateway that the environment names; the key comes from nowhere else."""
    url, key = first_of("VLM_LOCAL_BASE_URL", "OPENAI_BASE_URL", env=env), first_of("VLM_LOCAL_API_KEY", "OPENAI_API_KEY", env=env)
    if not url or not key:
        raise ProviderError("Local gateway requires VLM_LOCAL_BASE_URL and VLM_LOCAL_API_KEY (or OPENAI_BASE_URL and OPENAI_API_KEY).")
    return Gateway(url, key, timeout, stream)
