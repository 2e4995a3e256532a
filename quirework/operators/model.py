"""The model operator: prompts to responses, by a pluggable backend.

A backend is a picklable object with ``call(system, user) -> str``. The default is a stub, a
pure function of the prompt. Rows keep their key through the operator, so responses need no
positional join; errors are a column and never fail a task.

A partition keeps ``concurrency`` requests under way, in threads of its own, and hands rows on
as they are answered, in their order; ``partitions`` bounds how many partitions ask at once, so
that a server sees at most partitions x concurrency requests. A task that is run again asks
again for its own rows alone.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import urllib.error
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

RESPONSE = "success boolean, raw_text string, error string, duration_seconds double, retry_count integer"


@dataclass(frozen=True)
class StubBackend:
    """A deterministic answer in the shape the generator or the verifier is asked for."""

    role: str = "generate"

    def call(self, system: str, user: str) -> str:
        h = int(hashlib.md5(user.encode()).hexdigest()[:8], 16)
        if self.role == "verify":
            problems = [] if h % 3 else [{"category": "unsupported", "claim": f"c{h % 97}", "issue": "not in source", "severity": ("critical", "major", "minor")[h % 7 % 3]}]
            return json.dumps({"decision": "FLAG" if problems else "PASS", "problems": problems})
        if h % 5 == 0:
            return json.dumps({"decision": "skip", "skip_reason": "cross-reference only"})
        return json.dumps({"decision": "generate", "kb_type": ("config", "theory", "troubleshooting", "other")[h % 4], "kb_filename": f"unit-{h % 1000}.md", "kb_content": f"---\nid: unit-{h}\n---\n\nbody {h}"})


@dataclass(frozen=True)
class HttpBackend:
    """An OpenAI-style chat endpoint (``chat=True``) or a plain generate endpoint."""

    host: str
    model: str
    chat: bool = True
    temperature: float = 0.1
    top_p: float = 0.9
    max_tokens: int = 4096
    context: int = 8192
    timeout: float = 300.0
    thinking: bool = False

    def payload(self, system: str, user: str) -> dict:
        if self.chat:
            return {
                "model": self.model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}],
                "temperature": self.temperature, "top_p": self.top_p, "max_tokens": self.max_tokens,
                "response_format": {"type": "json_object"}, "chat_template_kwargs": {"enable_thinking": self.thinking}, "stream": False,
            }
        prompt = "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in (("system", system), ("user", user))) + "<|im_start|>assistant\n"
        options = {"temperature": self.temperature, "top_p": self.top_p, "num_predict": self.max_tokens, "num_ctx": self.context}
        return {"model": self.model, "prompt": prompt, "stream": False, "raw": True, "options": options}

    def call(self, system: str, user: str) -> str:
        path = "/v1/chat/completions" if self.chat else "/api/generate"
        request = urllib.request.Request(self.host.rstrip("/") + path, json.dumps(self.payload(system, user)).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as r:
            data = json.load(r)
        return data["choices"][0]["message"]["content"] if self.chat else data["response"]

    def available(self, timeout: float = 5.0) -> tuple[bool, str]:
        """Whether the server answers and serves the model: for a check before a run."""
        path = "/v1/models" if self.chat else "/api/tags"
        try:
            with urllib.request.urlopen(self.host.rstrip("/") + path, timeout=timeout) as r:
                data = json.load(r)
        except (OSError, ValueError) as e:
            return False, f"no answer from {self.host}: {e}"
        names = [m.get("id") or m.get("name") for m in data.get("data", data.get("models", []))]
        return (True, "ok") if self.model in names else (False, f"{self.model} isn't served; there are {names}")


def backend_from_env(role: str = "generate", model: str = "") -> StubBackend | HttpBackend:
    """By LLM_BACKEND: stub (default), ollama or vllm; VLLM_HOST and VLLM_ENABLE_THINKING."""
    kind = os.environ.get("LLM_BACKEND", "stub").lower()
    tokens = 2048 if role == "verify" else 4096
    if kind == "stub":
        return StubBackend(role)
    if kind == "ollama":
        return HttpBackend(os.environ.get("OLLAMA_HOST", "http://localhost:11434"), model, chat=False, max_tokens=tokens)
    if kind == "vllm":
        thinking = os.environ.get("VLLM_ENABLE_THINKING", "").lower() in ("1", "true", "yes")
        return HttpBackend(os.environ.get("VLLM_HOST", "http://localhost:8000"), model, max_tokens=tokens, thinking=thinking)
    raise ValueError(f"unknown LLM_BACKEND: {kind}")


def concurrency_from_env(default: int = 32) -> int:
    """VLLM_CONCURRENCY if it is a number of at least 1, else the default."""
    try:
        n = int(os.environ.get("VLLM_CONCURRENCY", default))
    except ValueError:
        return default
    return n if n >= 1 else default


def describe_error(e: Exception) -> str:
    """The kind of failure as a short text."""
    if isinstance(e, TimeoutError) or "timed out" in str(e):
        return "timeout"
    if isinstance(e, urllib.error.HTTPError):
        return f"HTTP {e.code}"
    if isinstance(e, (urllib.error.URLError, ConnectionError)):
        return f"connection failed: {getattr(e, 'reason', e)}"
    if isinstance(e, (KeyError, IndexError, TypeError, ValueError)):
        return f"malformed response: {e}"
    return f"unexpected: {type(e).__name__}: {e}"


def call_with_retry(backend, system: str, user: str, attempts: int = 3, waits: tuple[float, ...] = (2.0, 5.0)) -> dict:
    """One response; an empty one counts as a failure and is tried again."""
    began, error = time.monotonic(), ""
    for i in range(attempts):
        try:
            text = backend.call(system, user)
            if text and text.strip():
                return {"success": True, "raw_text": text, "error": None, "duration_seconds": time.monotonic() - began, "retry_count": i}
            error = "empty response"
        except Exception as e:  # a server can fail in any way; the row carries what happened
            error = describe_error(e)
        if i + 1 < attempts:
            time.sleep(waits[min(i, len(waits) - 1)])
    return {"success": False, "raw_text": "", "error": error, "duration_seconds": time.monotonic() - began, "retry_count": attempts}


def call_model(df: DataFrame, backend, system: str = "", prompt_col: str = "user_prompt", concurrency: int = 1, attempts: int = 3, waits: tuple[float, ...] = (2.0, 5.0), partitions: int | None = None, progress: Callable[[int], None] | None = None) -> DataFrame:
    """``df`` with the response's fields. A null prompt isn't sent and gives null fields.

    ``progress`` is called in the task with the number of answers it has so far.
    """
    names = [f.split()[0] for f in RESPONSE.split(", ")]
    empty = dict.fromkeys(names)

    def ask(prompt: str | None) -> dict:
        return empty if prompt is None else call_with_retry(backend, system, prompt, attempts, waits)

    def answered(rows: Iterator[dict]) -> Iterator[dict]:
        """Rows with their answers, in order; at most 2 x concurrency of them are held."""
        with ThreadPoolExecutor(concurrency) as pool:
            waiting: deque = deque()
            for row in rows:
                waiting.append((row, pool.submit(ask, row[prompt_col])))
                if len(waiting) >= 2 * concurrency:
                    first, got = waiting.popleft()
                    yield first | got.result()
            for first, got in waiting:
                yield first | got.result()

    schema = StructType(list(df.schema.fields))  # add() changes a schema in place
    for field in RESPONSE.split(", "):
        name, kind = field.split()
        schema = schema.add(name, kind)
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in b.to_pylist())
        done, out = 0, []
        for row in answered(rows):
            out.append(row)
            done += 1
            if progress is not None:
                progress(done)
            if len(out) >= 64:
                yield pa.RecordBatch.from_pylist(out, schema=target)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=target)

    return (df.repartition(partitions) if partitions else df).mapInArrow(run, schema)
