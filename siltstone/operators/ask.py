"""Requests to a vision model: messages with worked examples, and a client that gives up what an API refuses."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

#: Settings that some APIs do not take.
OPTIONAL = ("temperature", "top_p")


def messages(system: str, reminder: str, image_url: str, examples: tuple[tuple[str, str | None, dict], ...] = ()) -> list[dict]:
    """System text, then a question and an answer for each example (text, image, reply) that has an image, then the picture."""

    def asked(text: str, url: str) -> dict:
        return {"role": "user", "content": [{"type": "input_text", "text": text}, {"type": "input_image", "image_url": url}]}

    out = [{"role": "system", "content": [{"type": "input_text", "text": system}]}]
    for text, url, reply in examples:
        if url is not None:
            out += [asked(text, url), {"role": "assistant", "content": [{"type": "output_text", "text": json.dumps(reply, ensure_ascii=False)}]}]
    return [*out, asked(reminder, image_url)]


def _in_words(payload: dict[str, Any], demand: str) -> dict[str, Any]:
    """The payload without a reply format; the first question asks for it in words instead."""
    out = json.loads(json.dumps({k: v for k, v in payload.items() if k != "response_format"}))
    for message in out.get("input", []):
        if message["role"] == "user":
            text = next((part for part in message["content"] if part.get("type") in ("input_text", "text")), None)
            if text is not None:
                text["text"] = f"{text['text'].rstrip()}\n\n{demand}"
            break
    return out


def send_adapted(send: Callable[..., Any], payload: dict[str, Any], demand: str) -> tuple[Any, bool]:
    """(reply, whether the request was changed).

    A client that does not know the reply format (``TypeError``) is asked in words; settings that an error names, or
    all of ``OPTIONAL`` where it speaks of an unsupported parameter, are left out.  Anything else is raised.
    """
    now, changed = payload, False
    while True:
        try:
            return send(**now), changed
        except TypeError:
            if "response_format" not in now:
                raise
            now = _in_words(now, demand)
        except Exception as refused:
            said = str(refused).lower()
            out = [k for k in OPTIONAL if k in now and (f"'{k}'" in said or "unsupported parameter" in said)]
            if not out:
                raise
            now = {k: v for k, v in now.items() if k not in out}
        changed = True
