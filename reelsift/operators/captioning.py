"""Captioners by name, and the keyed caption cache."""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift import fixed
from reelsift.functions import text
from reelsift.operators import measures
from reelsift.ship import ship

#: Sends a JSON message list, returns the model's text.  One with a method ``batch``
#: takes a list of them at once and returns as many texts.
Transport = Callable[[str], str]


def secret(name: str, file: str | None = None) -> str | None:
    """A value of the environment, else of a JSON file of names and values, else None."""
    if value := os.environ.get(name):
        return value
    if not file or not Path(file).is_file():
        return None
    try:
        value = json.loads(Path(file).read_text(encoding="utf-8")).get(name)
    except (ValueError, AttributeError):
        return None
    return str(value) if value else None


@dataclass(frozen=True)
class ChatTransport:
    """Posts message lists to a chat address; any failure is a RuntimeError and isn't tried again."""

    address: str
    model: str
    key: str
    size_parameter: str = "max_tokens"
    size: int = 160
    timeout: float = 90.0

    def __call__(self, messages: str) -> str:
        body = {"model": self.model, "messages": json.loads(messages), self.size_parameter: self.size, "temperature": 0.2}
        headers = {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json", "User-Agent": "reelsift"}
        request = urllib.request.Request(self.address, json.dumps(body).encode(), headers, method="POST")
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as response:
                answer = json.loads(response.read().decode("utf-8"))
        except urllib.error.HTTPError as e:
            raise RuntimeError(f"captioning failed: {e.code} {e.read().decode('utf-8', 'replace')}") from e
        except urllib.error.URLError as e:
            raise RuntimeError(f"captioning failed: {e.reason}") from e
        try:
            return answer["choices"][0]["message"]["content"]
        except (KeyError, IndexError, TypeError) as e:
            raise RuntimeError(f"unexpected answer: {answer}") from e


def chat(settings: dict, secrets: str | None = None) -> tuple[ChatTransport, int]:
    """Transport of a remote provider's settings, and the most key frames that it takes."""
    name = str(settings.get("provider", "")).lower()
    address, model, key_name, parameter, size, frames = fixed.REMOTE[name]
    key = settings.get("api_key") or secret(key_name, secrets)
    if not key:
        raise ValueError(f"provider {name} needs {key_name}")
    most = int(settings.get("max_keyframes", frames))
    sent = ChatTransport(settings.get("base_url", address), settings.get("model_name") or model, key, parameter, int(settings.get("max_new_tokens", size)), float(settings.get("timeout_sec", 90.0)))
    return sent, min(most, frames) if name == "groq" else most


def key_frame_urls(images: DataFrame, most: int) -> DataFrame:
    """(clip_id, urls): data URLs of at most ``most`` evenly spaced image rows a clip, in order."""
    shots = measures.jpegs(measures.selected_frames(images, most))
    ordered = F.array_sort(F.collect_list(F.struct("frame_pos", text.data_url(F.col("jpeg")).alias("u"))))
    return shots.groupBy("clip_id").agg(F.transform(ordered, lambda x: x["u"]).alias("urls"))


def answers(transport: Transport, messages: list[str]) -> list[str]:
    """One text a message list; another number of texts or an empty one is an error."""
    out = list(transport.batch(messages)) if hasattr(transport, "batch") else [transport(m) for m in messages]
    if len(out) != len(messages):
        raise ValueError("the caption model gave another number of answers")
    if not all(a and a.strip() for a in out):
        raise RuntimeError("the caption model gave an empty answer")
    return out


def cache_hits(clips: DataFrame, cache: DataFrame) -> DataFrame:
    return clips.join(cache.select("clip_id", "caption"), "clip_id")


def cache_misses(clips: DataFrame, cache: DataFrame) -> DataFrame:
    return clips.join(cache.select("clip_id"), "clip_id", "left_anti")


def captioned(clips: DataFrame, provider: str = "heuristic", transport: Transport | None = None, cache: DataFrame | None = None, clean: bool = True) -> DataFrame:
    """Adds caption to (clip_id, mean_pixel, motion_caption[, messages]).

    ``heuristic`` is an expression.  Remote and local models need a transport that
    takes a message list; an empty answer is an error.  With a cache only misses
    are asked.
    """
    name = provider.lower()
    if cache is not None:
        fresh = captioned(cache_misses(clips, cache), provider, transport, None, clean)
        return cache_hits(clips, cache).select(*clips.columns, "caption").unionByName(fresh)
    if name == "heuristic":
        return clips.withColumn("caption", text.plain_caption(F.col("mean_pixel"), F.col("motion_caption")))
    if name not in ("openai", "groq", "transformers"):
        raise ValueError(f"unknown caption provider: {provider}")
    if transport is None:
        raise ValueError(f"provider {provider} needs a transport")
    ship(clips.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(caption=answers(transport, pdf["messages"].tolist()))

    out = clips.mapInPandas(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in clips.schema) + ", caption string")
    return out.withColumn("caption", text.sanitised(F.col("caption"))) if clean and name != "transformers" else out


def merge_cache(cache: DataFrame | None, captions: DataFrame) -> DataFrame:
    """The cache with the new rows it lacks."""
    new = captions.select("clip_id", "caption").dropDuplicates(["clip_id"])
    return new if cache is None else cache.unionByName(new.join(cache.select("clip_id"), "clip_id", "left_anti"))
