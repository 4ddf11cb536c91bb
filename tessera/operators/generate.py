"""Batch text generation through a plug-in model.

``make_generator()`` returns ``g(prompt: str, **params) -> str``; it is built
once per task's Arrow batch stream (not per row).  Each row's wall-clock
generation time is measured inside the task.  A model that also has
``generate_batch(prompts: list[str], **params) -> list[str]`` gets whole Arrow
batches (``batch_size`` rows) at once; each row is then charged an equal share
of its batch's time.  The built-in ``EchoExtract``
stands in for a model in tests: deterministic, and its answers are a
function of the prompt that SQL can recompute.

Options follow the answering scripts (``max_tokens`` new tokens); a model that
counts the prompt is given ``max_length`` (512 in the chat form) instead.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Generation defaults of the answering scripts.
DEFAULT_PARAMS = {"max_tokens": 256, "temperature": 0.1, "top_p": 0.85,
                  "repetition_penalty": 1.15}


@dataclass(frozen=True)
class EchoExtract:
    """Stub model: echoes the prompt, then the first ``n_words`` words that
    follow ``marker`` in it (or of the whole prompt without the marker)."""
    n_words: int = 16
    marker: str = "Context:\n"

    def __call__(self, prompt: str, **_params) -> str:
        at = prompt.find(self.marker)
        tail = prompt[at + len(self.marker):] if at >= 0 else prompt
        return prompt + " " + " ".join(tail.split()[: self.n_words])


@dataclass(frozen=True)
class DigestExtract:
    """Stub model whose answer depends on all of its context: echoes the
    prompt, then the MD5 of the words that follow ``marker`` in it (or of the
    whole prompt), how many they are, and the last ``n_words`` of them."""
    n_words: int = 8
    marker: str = "Context:\n"

    def __call__(self, prompt: str, **_params) -> str:
        import hashlib
        at = prompt.find(self.marker)
        words = (prompt[at + len(self.marker):] if at >= 0 else prompt).split()
        digest = hashlib.md5(" ".join(words).encode()).hexdigest()
        return " ".join([prompt, digest, str(len(words)), *words[-self.n_words:]])


def generation_params(**params) -> dict:
    """Options a model gets: the defaults, the caller's, and ``do_sample``,
    which holds if the temperature is above 0 (unless the caller sets it)."""
    p = {**DEFAULT_PARAMS, **params}
    p.setdefault("do_sample", p["temperature"] > 0)
    return p


def generate(df: DataFrame, make_generator: Callable, prompt_col: str = "prompt",
             out_col: str = "output", time_col: str = "generation_time",
             batch_size: int | None = None, **params) -> DataFrame:
    """Adds ``out_col`` (raw generation) and ``time_col`` (seconds per row)."""
    p = generation_params(**params)
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType()),
                                              T.StructField(time_col, T.DoubleType())])

    def run(batches):
        model = make_generator()
        batched = hasattr(model, "generate_batch")
        for pdf in batches:
            prompts = list(pdf[prompt_col])
            if batched:
                step = batch_size or max(len(prompts), 1)
                outs, secs = [], []
                for lo in range(0, len(prompts), step):
                    part = prompts[lo:lo + step]
                    t0 = time.perf_counter()
                    outs.extend(model.generate_batch(part, **p))
                    secs.extend([(time.perf_counter() - t0) / len(part)] * len(part))
            else:
                outs, secs = [], []
                for prompt in prompts:
                    t0 = time.perf_counter()
                    outs.append(model(prompt, **p) if prompt is not None else None)
                    secs.append(time.perf_counter() - t0)
            pdf[out_col] = outs
            pdf[time_col] = secs
            yield pdf

    return df.mapInPandas(run, schema)
