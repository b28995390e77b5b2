"""Imports every module that registers queries."""

from llm import embeddings, history, jaccard, lines, mixing, negatives, packing, phrases, quality, repeats, secrets, tokenfile, warc  # noqa: F401
from llm.registry import ORACLES, QUERIES  # noqa: F401
