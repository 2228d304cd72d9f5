"""Seams to models: text generation and embedding, with offline stand-ins."""

from __future__ import annotations

import os
import random
import time
from collections.abc import Callable, Iterator
from hashlib import md5
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import fixed_values as fixed
from corpusloom.functions.prompts import summarize_prompt
from corpusloom.functions.slices import by_slices
from corpusloom.functions.text import as_col


class TextGenerator(Protocol):
    def generate(self, prompt: str, max_new_tokens: int) -> str: ...


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class LeadGenerator:
    """Deterministic stand-in: the first words of the text the prompt presents."""

    def generate(self, prompt: str, max_new_tokens: int) -> str:
        for label in (fixed.CHUNK_LABEL, fixed.FINAL_LABEL):
            prompt = prompt.rpartition(label + "\n")[2]
        return " ".join(prompt.split()[:max_new_tokens])


class PretrainedGenerator:
    """A causal model from the optional ``transformers`` package, loaded once per task."""

    def __init__(self, model_name: str | None = None) -> None:
        from transformers import AutoModelForCausalLM, AutoTokenizer  # optional dependency

        name = model_name_or_default(model_name)
        self.tokenizer = AutoTokenizer.from_pretrained(name)
        self.model = AutoModelForCausalLM.from_pretrained(name)

    def generate(self, prompt: str, max_new_tokens: int) -> str:
        encoded = self.tokenizer(prompt, return_tensors="pt")
        window = self.tokenizer.model_max_length or 0
        used = encoded["input_ids"].shape[1]
        if window and used >= window:
            used = max(window - max_new_tokens, max(1, window // 2))
            encoded = self.tokenizer(prompt, return_tensors="pt", truncation=True, max_length=used)
        allowed = min(max_new_tokens, max(1, window - used)) if window else max_new_tokens
        ids = self.model.generate(**encoded, max_new_tokens=allowed, **fixed.SAMPLING)
        text = self.tokenizer.decode(ids[0], skip_special_tokens=True)
        return text[len(prompt) :].strip() if text.startswith(prompt) else text


def model_name_or_default(model_name: str | None = None) -> str:
    """Explicit name, else the environment's, else the default."""
    return model_name or os.getenv(fixed.MODEL_ENV) or fixed.DEFAULT_MODEL


class RetryingGenerator:
    """Retries a generator on transient failures, then falls back or reports in-band."""

    def __init__(
        self,
        primary: TextGenerator,
        fallback: TextGenerator | None = None,
        max_retries: int = 3,
        base_delay: float = 1.0,
        sleep: Callable[[float], None] = time.sleep,
    ) -> None:
        self.primary, self.fallback = primary, fallback
        self.max_retries, self.base_delay, self.sleep = max_retries, base_delay, sleep

    def generate(self, prompt: str, max_new_tokens: int = fixed.MAX_NEW_TOKENS) -> str:
        failure: Exception | str = "Generation failed and no fallback available"
        for attempt in range(self.max_retries):
            try:
                return self.primary.generate(prompt, max_new_tokens)
            except Exception as error:  # noqa: BLE001 - any provider failure
                failure = error
            transient = any(word in str(failure).lower() for word in fixed.TRANSIENT_WORDS)
            if not transient or attempt == self.max_retries - 1:
                break
            self.sleep(self.base_delay * 2**attempt + random.uniform(0, 1))
        if self.fallback is not None and isinstance(failure, Exception):
            return self.fallback.generate(prompt, max_new_tokens)
        return f"{fixed.ERROR_PREFIX} {failure}"


def generated(prompt: Column | str, load: Callable[[], TextGenerator], max_new_tokens: int) -> Column:
    """struct(text, failed) of a generation call; the model is loaded once per task."""

    def start():
        model = load()

        def answer(value):
            try:
                return {"text": model.generate(value or "", max_new_tokens), "failed": False}
            except Exception as error:  # noqa: BLE001 - failures travel in-band
                return {"text": f"{fixed.ERROR_PREFIX} {error}", "failed": True}

        return answer

    run = by_slices(T.StructType().add("text", "string").add("failed", "boolean"), pa.struct({"text": pa.string(), "failed": pa.bool_()}), start)
    # A model may sample: the optimizer must neither repeat nor move the call.
    return run.asNondeterministic()(as_col(prompt))


def summarized(text: Column | str, load: Callable[[], TextGenerator], max_new_tokens: int = 150) -> Column:
    """struct(text, failed): a short summary of any text."""
    return generated(summarize_prompt(text), load, max_new_tokens)


class WordCountEmbedder:
    """Deterministic stand-in: words counted in 256 buckets, by the first byte of their MD5."""

    def embed(self, texts: list[str]) -> list[list[float]]:
        vectors = []
        for text in texts:
            vector = [0.0] * 256
            for word in text.lower().split():
                vector[md5(word.encode()).digest()[0]] += 1.0
            vectors.append(vector)
        return vectors


class SentenceEmbedder:
    """Embeddings from the optional ``sentence-transformers`` package."""

    def __init__(self, name: str = "all-MiniLM-L6-v2") -> None:
        from sentence_transformers import SentenceTransformer  # optional dependency

        self.model = SentenceTransformer(name)

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [list(map(float, vector)) for vector in self.model.encode(texts)]


def embedder_or_none(load: Callable[[], Embedder]) -> Callable[[], Embedder] | None:
    """The loader if its model can be had, else None: checks that need it are skipped."""
    try:
        load()
    except Exception:  # noqa: BLE001 - a missing package or model only disables the check
        return None
    return load


def _embedded_alone(model: Embedder, text: str):
    try:
        return model.embed([text])[0]
    except Exception:  # noqa: BLE001
        return None


def embedded(text: Column | str, load: Callable[[], Embedder]) -> Column:
    """Embedding of each text; null for a text that fails, whatever the others of its batch do."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            plain = texts.fillna("").tolist()
            try:
                yield pd.Series(model.embed(plain))
            except Exception:  # noqa: BLE001 - then one by one
                yield pd.Series([_embedded_alone(model, one) for one in plain])

    return run(as_col(text))
