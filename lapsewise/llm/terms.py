"""Terms of a text: maximal runs of ASCII letters (and digits, if asked) and of all other non-ASCII characters."""

from __future__ import annotations


def byte_table(digits: bool) -> bytes:
    """What each UTF-8 byte becomes: letters in lower case, bytes above ASCII as they are, the rest a space."""
    keeps = lambda b: b > 0x7F or chr(b).isalpha() or (digits and chr(b).isdigit())
    return bytes(ord(chr(b).lower()) if b < 0x80 and keeps(b) else b if keeps(b) else 0x20 for b in range(256))


def terms(data: bytes | None, table: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, repeats included; no text has none."""
    return data.translate(table).split() if data else []
