"""Checksums in DuckDB's SQL, which has no function for them."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of the expression ``text``: bit by bit with the reversed polynomial 0xEDB88320."""
    taken = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    bits = "list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b))"
    return f"xor(list_reduce({taken}, lambda c, b: {bits}, 4294967295), 4294967295)"
