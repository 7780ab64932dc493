from __future__ import annotations


def text_of(value) -> str:
    return value if isinstance(value, str) else ""


def words_of(value) -> list[bytes]:
    return text_of(value).encode().split()
