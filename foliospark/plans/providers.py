"""Model calls behind one interface, one client per partition, errors returned as a column."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

QA = "struct<question:string,answer:string,question_type:string,difficulty:string,citation_quote:string>"
CROSS_QA = "struct<question:string,answer:string,question_type:string,difficulty:string,source_pages:array<int>,evidence_quotes:array<struct<page:int,quote:string>>,synthesis_type:string>"
VERDICT = "struct<grounding_score:double,usefulness_score:double,multi_page_score:double,grounded:boolean,useful:boolean,truly_multi_page:boolean>"
CALL_SCHEMA = "attempts array<struct<attempt:int,dpi:int,timestamp_epoch:bigint,latency_ms:bigint,input_tokens:bigint,output_tokens:bigint>>, payload string, error string"


class Provider(Protocol):
    """What a model client offers: a payload (JSON) with numbers of tokens for a request (JSON)."""

    def call(self, request: dict) -> tuple[dict, int, int]: ...


class OfflineProvider:
    """A deterministic client without a model: questions are asked about sentences of the page itself."""

    def __init__(self, per_page: int = 2):
        self.per_page = per_page

    def call(self, request: dict) -> tuple[dict, int, int]:
        if request.get("kind") == "critique":
            return {"grounding_score": 1.0, "usefulness_score": 1.0, "multi_page_score": 1.0, "grounded": True, "useful": True, "truly_multi_page": True}, len(json.dumps(request)), 1
        if request.get("kind") == "synthesis":
            return self._across(request)
        text = (request.get("text") or "").strip()
        if len(text) <= 20:
            return {"page_status": "unreadable" if text else "blank", "page_status_reason": "too little text", "items": []}, len(text), 0
        sentences = [s.strip() for s in text.replace("\n", " ").split(".") if len(s.split()) >= 8]
        items = [{"question": f"What does the page say about {' '.join(s.split()[:4])}?", "answer": f"According to the page: {s}. This is stated in the text itself and nowhere else in it.",
                  "question_type": "factual", "difficulty": "easy", "citation_quote": s} for s in sentences[: self.per_page]]
        return {"page_status": "usable", "page_status_reason": "", "items": items}, len(text), sum(len(i["answer"]) for i in items)

    @staticmethod
    def _across(request: dict) -> tuple[dict, int, int]:
        """An item that quotes the first sentences of the pack's first two pages that have text."""
        quotes = [{"page": p["page"], "quote": p["text"].split(".")[0].strip()} for p in request["page_texts"] if (p["text"] or "").split(".")[0].strip()][:2]
        if len(quotes) < 2:
            return {"pack_status": "insufficient_evidence", "pack_status_reason": "", "items": []}, len(json.dumps(request)), 0
        first, second = (q["quote"] for q in quotes)
        item = {"question": f"How does '{' '.join(first.split()[:6])}' go with '{' '.join(second.split()[:6])}'?", "answer": f"One page says: {first}. Another page says: {second}.", "question_type": "synthesis", "difficulty": "medium",
                "source_pages": [q["page"] for q in quotes], "evidence_quotes": quotes, "synthesis_type": "cross_page_multi_hop"}
        return {"pack_status": "usable", "pack_status_reason": "", "items": [item]}, len(json.dumps(request)), len(item["answer"])


def _answer(client: Provider, raw: str, retries: int, dpis: tuple[int, int], pause: float, render: Callable[[dict, int], str] | None) -> tuple[list, dict | None, str | None]:
    tries, payload = [], None
    try:
        for n in range(retries + 1):
            dpi = dpis[min(n, 1)]
            request = {**json.loads(raw), "dpi": dpi}
            if n and render:
                request["image"] = render(request, dpi)
            began = time.monotonic()
            payload, tokens_in, tokens_out = client.call(request)
            tries.append({"attempt": n + 1, "dpi": dpi, "timestamp_epoch": int(time.time()), "latency_ms": int((time.monotonic() - began) * 1000), "input_tokens": tokens_in or 0, "output_tokens": tokens_out or 0})
            time.sleep(pause)
            if payload.get("page_status", "unreadable") not in ("blank", "unreadable"):
                break
    except Exception as e:
        return tries, payload, f"{type(e).__name__}: {e}"
    return tries, payload, None


def called(requests: DataFrame, provider: Callable[[], Provider], request_column: str = "request", retries: int = 1, dpis: tuple[int, int] = (150, 220), pause: float = 0.0,
           workers: int = 1, patience: float | None = None, render: Callable[[dict, int], str] | None = None) -> DataFrame:
    """Adds attempts, payload and error to requests (JSON strings in ``request_column``).

    A page found blank or unreadable is tried again at the higher resolution, with the image that ``render`` makes of the
    request and the resolution, and the last attempt counts. Materialise the result before it is used twice: a call isn't repeated
    then. The client is made once per partition; ``workers`` threads share it, and a call that isn't done after ``patience``
    seconds of waiting for it is an error.
    """
    names = requests.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = provider()
        for pdf in batches:
            if workers <= 1:
                done = [_answer(client, raw, retries, dpis, pause, render) for raw in pdf[request_column]]
            else:
                pool, done = ThreadPoolExecutor(workers), []
                for future in [pool.submit(_answer, client, raw, retries, dpis, pause, render) for raw in pdf[request_column]]:
                    try:
                        done.append(future.result(patience))
                    except Late:
                        future.cancel()
                        done.append(([], None, "call_timeout_or_cancelled"))
                pool.shutdown(wait=False, cancel_futures=True)
            yield pdf.assign(attempts=[d[0] for d in done], payload=[json.dumps(d[1], ensure_ascii=False) if d[1] is not None else None for d in done], error=[d[2] for d in done])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields)
    return requests.select(*names).mapInPandas(run, f"{schema}, {CALL_SCHEMA}")
