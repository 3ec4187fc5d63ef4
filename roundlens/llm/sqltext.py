"""Pieces of DuckDB SQL that several statements of this subpackage share."""

CRC_TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table)"""


def crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII string; the statement must have ``CRC_TABLE`` in scope."""
    return (f"xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT), "
            f"lambda c, b: xor(c >> 8, crc_table[((xor(c, b) & 255) + 1)::INT])), 4294967295)")
