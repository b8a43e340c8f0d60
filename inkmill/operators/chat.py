"""A generation backend over HTTP: a chat endpoint that takes messages and a JSON schema for the answer.

Two kinds of endpoint are spoken to, told apart by the address: `…/api/chat` (schema in `format`, answer in `message`) and
`…/chat/completions` (schema in `response_format`, answer in `choices`). Standard library only; prompts are those of
`functions.prompts`.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from dataclasses import dataclass, field

from inkmill.functions import prompts
from inkmill.operators.generate import GenerationError

URL = "http://localhost:11434/api/chat"


def _list_of(name: str, item: dict) -> dict:
    return {"type": "object", "properties": {name: {"type": "array", "items": item}}, "required": [name]}


_TEXT = {"type": "string"}
_PAIR = {"type": "object", "properties": {"prompt": _TEXT, "completion": _TEXT}, "required": ["prompt", "completion"]}


@dataclass
class ChatGenerator:
    """The six methods of a backend. A call is tried `tries` times if the endpoint can't be reached or is overloaded."""

    model: str
    url: str = URL
    key: str = ""
    timeout: float = 600.0
    tries: int = 3
    pause: float = 1.0
    options: dict = field(default_factory=dict)

    def rewrite(self, text: str) -> str:
        return self._say(prompts.REWRITE, text=text)

    def summarize(self, text: str) -> str:
        return self._say(prompts.SUMMARIZE, text=text)

    def reasoning(self, question: str, answer: str, source: str) -> str:
        return self._say(prompts.REASONING, question=question, answer=answer, source=source)

    def qa(self, text: str) -> list[dict[str, str]]:
        pairs = self._listed("pairs", _PAIR, prompts.QUESTIONS_AND_ANSWERS, text=text)
        if not all(isinstance(p, dict) and isinstance(p.get("prompt"), str) and isinstance(p.get("completion"), str) for p in pairs):
            raise GenerationError("a pair without a prompt or a completion")
        return [{"prompt": p["prompt"], "completion": p["completion"]} for p in pairs]

    def questions(self, text: str, count: int = 3) -> list[str]:
        return self._strings("questions", prompts.RETRIEVAL_QUESTIONS, text=text, count=count)

    def variants(self, question: str, count: int = 2) -> list[str]:
        return self._strings("variants", prompts.VARIANTS, question=question, count=count)

    def _say(self, template: str, **values: object) -> str:
        return self._ask(prompts.render_text(template, **values), None)

    def _strings(self, name: str, template: str, **values: object) -> list[str]:
        found = self._listed(name, _TEXT, template, **values)
        if not all(isinstance(x, str) for x in found):
            raise GenerationError(f"{name} are not all text")
        return found

    def _listed(self, name: str, item: dict, template: str, **values: object) -> list:
        body = self._ask(prompts.render_text(template, **values), _list_of(name, item))
        try:
            found = json.loads(body)[name]
        except (ValueError, KeyError, TypeError) as e:
            raise GenerationError(f"no {name} in the answer: {body[:200]!r}") from e
        if not isinstance(found, list):
            raise GenerationError(f"{name} is no list")
        return found

    def _ask(self, prompt: str, schema: dict | None) -> str:
        completions = self.url.rstrip("/").endswith("/completions")
        request: dict = {"model": self.model, "messages": [{"role": "user", "content": prompt}], "stream": False, **self.options}
        if schema and completions:
            request["response_format"] = {"type": "json_schema", "json_schema": {"name": "answer", "schema": schema}}
        elif schema:
            request["format"] = schema
        got = self._post(request)
        try:
            content = got["choices"][0]["message"]["content"] if completions else got["message"]["content"]
        except (KeyError, IndexError, TypeError) as e:
            raise GenerationError(f"unexpected answer: {str(got)[:200]}") from e
        if not isinstance(content, str):
            raise GenerationError("an answer without text")
        return content

    def _post(self, request: dict) -> dict:
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        sent = urllib.request.Request(self.url, json.dumps(request, ensure_ascii=False).encode(), headers)
        for left in range(self.tries - 1, -1, -1):
            try:
                with urllib.request.urlopen(sent, timeout=self.timeout) as answer:
                    return json.loads(answer.read())
            except urllib.error.HTTPError as e:
                if not left or not (e.code == 429 or e.code >= 500):
                    raise GenerationError(f"HTTP {e.code}") from e
            except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
                if not left:
                    raise GenerationError(f"no answer: {e}") from e
            except ValueError as e:
                raise GenerationError("the answer is no JSON") from e
            time.sleep(self.pause * 2 ** (self.tries - 1 - left))
        raise GenerationError("no try left")
