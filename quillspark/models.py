"""Encoders and generators as exchangeable parts; a model is loaded once for each Python worker."""

from __future__ import annotations

import sys
import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import fold
from quillspark.operators import chunking as K
from quillspark.operators.registry import embedding_text

#: Functions of this module travel whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Encoder(Protocol):
    def encode(self, texts: list[str]) -> np.ndarray:
        """One row for each text."""


class Generator(Protocol):
    def generate(self, messages: list[dict[str, str]]) -> str:
        """The answer to a conversation."""


class HashingEncoder:
    """Unit vectors of hashed words: deterministic, for tests and where no model is at hand."""

    def __init__(self, dimensions: int = 64):
        self.dimensions = dimensions

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions), np.float32)
        for k, text in enumerate(texts):
            for word in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "big")
                out[k, h % self.dimensions] += 1 if h >> 63 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def encoder_udf(load: Callable[[], Encoder], batch: int = 32) -> Callable[[Column], Column]:
    """A column function from text to vector; ``load`` runs once in a worker."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            rows = []
            for at in range(0, len(texts), batch):
                rows += [v.astype(np.float32) for v in np.asarray(model.encode([t or "" for t in texts.iloc[at : at + batch]]))]
            yield pd.Series(rows)

    return encode


def safe_encoder_udf(load: Callable[[], Encoder], batch: int = 32) -> Callable[[Column], Column]:
    """As :func:`encoder_udf` from text to struct(v, error): a batch that fails is encoded text by text, and a text that fails has an error."""

    @F.pandas_udf("v array<float>, error string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()

        def one(text: str) -> tuple:
            try:
                return np.asarray(model.encode([text]))[0].astype(np.float32), None
            except Exception as problem:
                return None, f"{type(problem).__name__}: {problem}"

        for texts in batches:
            rows = []
            for at in range(0, len(texts), batch):
                part = [t or "" for t in texts.iloc[at : at + batch]]
                try:
                    rows += [(v.astype(np.float32), None) for v in np.asarray(model.encode(part))]
                except Exception:
                    rows += [one(t) for t in part]
            yield pd.DataFrame(rows, columns=["v", "error"])

    return encode


def embed(chunks: DataFrame, load: Callable[[], Encoder] = HashingEncoder, into: str = "embedding") -> DataFrame:
    """chunks with the vector of their embedding text."""
    return chunks.withColumn(into, encoder_udf(load)(embedding_text()))


def embed_queries(queries: DataFrame, load: Callable[[], Encoder] = HashingEncoder, query: str = "query", into: str = "embedding") -> DataFrame:
    """Questions are encoded as texts of their own kind."""
    return queries.withColumn(into, encoder_udf(load)(F.concat(F.lit("Text: "), fold(query))))


def semantic_cuts(sections: DataFrame, load: Callable[[], Encoder] = HashingEncoder, limits: K.Limits = K.EN, glue: str = " ", key: list[str] | None = None) -> DataFrame:
    """Sections (with sentences: array<struct<text, ...>>) and their scores and cuts, by the similarity of the windows around each gap.

    Windows are exploded so that a section of any length is encoded in batches, and only vectors' cosines come back to it. A section one of whose
    windows can't be encoded has an error and no cuts; the others go on.
    """
    key = key or ["pmcid", "section"]
    texts = F.transform("sentences", lambda s: s["text"])
    gaps = sections.select(*key, F.posexplode(K.windows_of(texts, limits.window, glue)).alias("gap", "w"))
    encode = safe_encoder_udf(load)
    scored = gaps.withColumns({"a": encode(F.col("w.left")), "b": encode(F.col("w.right"))})
    from quillspark.functions.vectors import cosine

    scored = scored.select(*key, "gap", F.coalesce("a.error", "b.error").alias("error"), F.when(F.col("a.error").isNull() & F.col("b.error").isNull(), cosine("a.v", "b.v")).alias("s"))
    scores = scored.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("gap", "s"))), lambda x: x["s"]).alias("scores"), F.max("error").alias("error"))
    joined = sections.join(scores, key, "left").withColumn("scores", F.when(F.col("error").isNotNull() | F.col("scores").isNull(), F.array().cast("array<double>")).otherwise(F.col("scores")))
    return joined.withColumn("cuts", F.when(F.col("error").isNull(), K.boundaries("scores", limits)).otherwise(F.array().cast("array<int>")))


def chunk_manifest(sections: DataFrame, chunks: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(key, sentences, similarity_gaps, semantic_boundaries, chunks, status, error) of the sections that :func:`semantic_cuts` gave: failed ones made no chunks."""
    key = key or ["pmcid", "section"]
    made = chunks.groupBy(*key).agg(F.count("*").alias("__c"))
    failed = F.col("error").isNotNull()
    return sections.join(made, key, "left").select(
        *key, F.size("sentences").alias("sentences"), F.size("scores").alias("similarity_gaps"), F.size("cuts").alias("semantic_boundaries"), F.when(failed, 0).otherwise(F.coalesce("__c", F.lit(0))).alias("chunks"),
        F.when(failed, "failed").otherwise("parsed").alias("status"), F.coalesce("error", F.lit("")).alias("error"),
    )


SYSTEM = "角色：严谨的医学文献助手。只凭用户给的 Evidence 作答并保留编号。IGM 译作特发性肉芽肿性乳腺炎，NPM 译作非哺乳期乳腺炎。"


def messages(prompt: str, system: str = SYSTEM) -> list[dict[str, str]]:
    return [dict(role=role, content=said) for role, said in (("system", system), ("user", prompt))]


def generate(prompts: DataFrame, load: Callable[[], Generator], key: str = "query_id", prompt: str = "prompt", system: str = SYSTEM) -> DataFrame:
    """(key, answer, error) of prompts; a prompt that fails has an error and the others go on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            rows = []
            for k, p in zip(batch[key], batch[prompt]):
                try:
                    rows.append((k, model.generate(messages(p, system)), None))
                except Exception as problem:
                    rows.append((k, None, f"{type(problem).__name__}: {problem}"))
            yield pd.DataFrame(rows, columns=[key, "answer", "error"])

    return prompts.select(key, prompt).mapInPandas(run, f"{key} {prompts.schema[key].dataType.simpleString()}, answer string, error string")


def generation_settings(config: dict) -> dict:
    """Model path and decoding settings from an llm section, with defaults; a missing path is an error."""
    llm = config.get("llm") or {}
    if not llm.get("local_model_path"):
        raise ValueError("llm.local_model_path is missing")
    own = llm.get("generation") or {}
    defaults = {"max_new_tokens": 768, "temperature": 0.2, "top_p": 0.9, "repetition_penalty": 1.05, "do_sample": False}
    return {"model_path": str(llm["local_model_path"]), "backend": llm.get("backend", "local_hf"), "quantization": llm.get("quantization", "8bit"), "generation": {k: type(v)(own.get(k, v)) for k, v in defaults.items()}}


def retrieve_evidence(index: DataFrame, questions: DataFrame, load: Callable[[], Encoder] = HashingEncoder, top_k: int = 8) -> DataFrame:
    """Numbered evidence of each question (query_id, query): encoded, searched for among the index's vectors, joined with its metadata."""
    from quillspark.operators import retrieval

    hits = retrieval.search(index, embed_queries(questions, load), top_k)
    return retrieval.evidence(retrieval.with_metadata(hits, index.drop("embedding")))


def judge(answers: DataFrame, load: Callable[[], Generator], key: str = "query_id") -> DataFrame:
    """(key, judgement) of answers (key, question, evidence: array<struct<evidence_id, citation, text>>, answer): asked, generated and parsed.

    A model that fails, or says nothing that can be read, gives a warning and not an error.
    """
    from quillspark.operators import evaluate

    asked = answers.select(key, evaluate.judge_prompt("question", "evidence", "answer").alias("prompt"))
    said = generate(asked, load, key, system=evaluate.JUDGE_SYSTEM)
    return said.select(key, evaluate.parse_judgement(F.coalesce("answer", "error")).alias("judgement"))


def quantization(kind: str):
    """The loader's setting for a kind of quantization: none, or eight bits."""
    if kind == "none":
        return None
    if kind != "8bit":
        raise ValueError(f"no such quantization here: {kind}")
    from transformers import BitsAndBytesConfig

    return BitsAndBytesConfig(load_in_8bit=True)


class LocalModel:
    """A causal language model from a local folder. Its libraries are imported when it is loaded, so that nothing else needs them."""

    def __init__(self, settings: dict):
        import torch
        from transformers import AutoModelForCausalLM, AutoTokenizer

        self.torch, self.settings = torch, settings
        options = {"device_map": "auto", "trust_remote_code": True}
        if (small := quantization(settings["quantization"])) is not None:
            options["quantization_config"] = small
        else:
            options["torch_dtype"] = torch.bfloat16 if torch.cuda.is_available() else torch.float32
        self.tokenizer = AutoTokenizer.from_pretrained(settings["model_path"], trust_remote_code=True)
        self.model = AutoModelForCausalLM.from_pretrained(settings["model_path"], **options).eval()

    def generate(self, messages: list[dict[str, str]]) -> str:
        ids, mask = model_inputs(self.tokenizer, messages)
        own = self.settings["generation"]
        choices = {k: own[k] for k in (("max_new_tokens", "repetition_penalty", "temperature", "top_p") if own["do_sample"] else ("max_new_tokens", "repetition_penalty"))}
        end = self.tokenizer.eos_token_id
        with self.torch.inference_mode():
            out = self.model.generate(input_ids=ids.to(self.model.device), attention_mask=mask.to(self.model.device), do_sample=own["do_sample"], pad_token_id=end, eos_token_id=end, **choices)
        return self.tokenizer.decode(out[0, ids.shape[-1] :], skip_special_tokens=True).strip()


def model_inputs(tokenizer, messages: list[dict[str, str]]):
    """(input_ids, attention_mask) of a conversation by the tokenizer's chat template, without thinking where it knows of that; else as plain text."""
    if getattr(tokenizer, "chat_template", None):
        try:
            made = tokenizer.apply_chat_template(messages, add_generation_prompt=True, return_tensors="pt", enable_thinking=False)
        except TypeError:
            made = tokenizer.apply_chat_template(messages, add_generation_prompt=True, return_tensors="pt")
    else:
        made = tokenizer("\n\n".join(f"{m['role']}: {m['content']}" for m in messages), return_tensors="pt")
    ids = made["input_ids"] if isinstance(made, dict) or hasattr(made, "keys") else made
    if not hasattr(ids, "shape"):
        raise TypeError(f"no input ids in {type(made).__name__}")
    mask = made.get("attention_mask") if hasattr(made, "get") else None
    return ids, ids * 0 + 1 if mask is None else mask
