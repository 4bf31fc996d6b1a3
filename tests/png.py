"""A tiny PNG writer for tests."""

import struct
import zlib


def png(rows: list[bytes], width: int, colour: bool = False) -> bytes:
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, len(rows), 8, 2 if colour else 0, 0, 0, 0)
    data = zlib.compress(b"".join(b"\0" + r for r in rows))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", data) + chunk(b"IEND", b"")
