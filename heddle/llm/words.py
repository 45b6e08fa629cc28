"""Words of a text as the corpus operators see them: lower case, without ASCII punctuation."""

from __future__ import annotations

_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words of ``text``; null and empty texts have none."""
    return (text or "").lower().encode("utf-8", "replace").translate(_PLAIN).split()
