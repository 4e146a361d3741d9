"""All queries of the subpackage."""

from __future__ import annotations

from voltloom.llm import base, chat, decontam, langid, licenses, minmax, mixing, quality, secret_scan, simhash, token_files, turn_repair, urls, vector_codes  # noqa: F401


def registry():
    """(queries, oracle texts)."""
    return dict(base.QUERIES), dict(base.ORACLES)
