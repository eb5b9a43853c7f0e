"""A client of an HTTP model service, to be given to the scoring operators as a judge."""

from __future__ import annotations

import dataclasses
import json
import urllib.error
import urllib.request

from colloqua.operators.scoring import with_retries


@dataclasses.dataclass(frozen=True)
class ModelClient:
    """Plain values only, so that it travels to the executors."""

    base_url: str
    model: str
    api_key: str = ""
    timeout: float = 20.0
    retries: int = 3
    delay: float = 1.0
    service_tier: str = ""

    def _send(self, path: str, body: dict | None, timeout: float) -> dict:
        headers = {"Content-Type": "application/json"}
        if self.api_key:
            headers["Authorization"] = f"Bearer {self.api_key}"
        data = None if body is None else json.dumps(body).encode()
        request = urllib.request.Request(self.base_url.rstrip("/") + path, data=data, headers=headers)
        with urllib.request.urlopen(request, timeout=timeout) as reply:  # noqa: S310 - the address is configured
            return json.loads(reply.read() or b"{}")

    def chat(self, messages: list[dict], temperature: float = 0.0, max_tokens: int = 1024) -> str | None:
        """The reply's text, or None after all tries."""
        body = {"model": self.model, "messages": messages, "temperature": temperature, "max_tokens": max_tokens, "stream": False}
        if self.service_tier:
            body["service_tier"] = self.service_tier
        found = with_retries(lambda: json.dumps(self._send("/v1/chat/completions", body, self.timeout)), self.retries, self.delay)
        return None if found is None else json.loads(found)["choices"][0]["message"]["content"]

    def score(self, pairs: list[tuple[str, str]]) -> str:
        """A judge for :func:`colloqua.operators.scoring.score_pairs`."""
        asked = json.dumps([{"id": i, "dialogue": text} for i, text in pairs], ensure_ascii=False)
        prompt = 'Score each dialogue from 1 to 5. Answer with a JSON array of {"id", "score"} only.'
        reply = self.chat([{"role": "system", "content": prompt}, {"role": "user", "content": asked}])
        if reply is None:
            raise ConnectionError(self.base_url)
        return reply

    def remove(self, prompt: str) -> str:
        """A judge for :func:`colloqua.operators.scoring.segment_conversations`."""
        ask = 'Name the messages that are no talk (calls, notices, gibberish). Answer with {"removed_indices": [...], "reason": ""} only.'
        reply = self.chat([{"role": "system", "content": ask}, {"role": "user", "content": prompt}])
        if reply is None:
            raise ConnectionError(self.base_url)
        return reply

    def models(self) -> list[str]:
        """Ids of the models served; empty if the service fails."""
        try:
            return [m["id"] for m in self._send("/v1/models", None, self.timeout)["data"]]
        except (OSError, ValueError, KeyError, urllib.error.URLError):
            return []

    def healthy(self) -> bool:
        try:
            self._send("/v1/models", None, 5.0)
        except (OSError, ValueError, urllib.error.URLError):
            return False
        return True
