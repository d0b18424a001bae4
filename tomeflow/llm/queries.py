"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from tomeflow.llm import bpe, chat, decontam, exact, html, lm, minhash, quality, substring, wavelet

_MODULES = (bpe, quality, exact, minhash, substring, lm, html, chat, decontam, wavelet)

QUERIES = {name: fn for module in _MODULES for name, fn in vars(module).items() if name.startswith("op") and name[2].isdigit()}
SQL = {name: text for module in _MODULES for name, text in module.SQL.items()}
