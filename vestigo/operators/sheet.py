"""Contact sheets: a document's first pages as one picture for whoever labels it, never with the verdict."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np

from .model import resize

#: Pages on a sheet; the widest a page may be in one, two or three columns; white between pages.
PAGES, WIDTHS, GAP = 6, (1400, 1100, 900), 12


def columns(pages: int) -> int:
    return 1 if pages <= 1 else 2 if pages <= 4 else 3


def compose(pages: list[np.ndarray]) -> np.ndarray:
    """Pages (rows, columns, 3) side by side on white; wide ones are reduced, none is enlarged."""
    across = columns(len(pages))
    most = WIDTHS[across - 1]
    small = [p if p.shape[1] <= most else resize(p, max(1, round(p.shape[0] * most / p.shape[1])), most) for p in pages]
    height, width = (max(p.shape[k] for p in small) for k in (0, 1))
    down = -(-len(small) // across)
    sheet = np.full((GAP + down * (height + GAP), GAP + across * (width + GAP), 3), 255, np.uint8)
    for k, p in enumerate(small):
        top, left = GAP + k // across * (height + GAP), GAP + k % across * (width + GAP)
        sheet[top : top + p.shape[0], left : left + p.shape[1]] = p
    return sheet


def png(picture: np.ndarray, note: str = "") -> bytes:
    """An RGB picture as PNG, with a note in its text chunk."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    height, width, _ = picture.shape
    rows = np.concatenate([np.zeros((height, 1), np.uint8), picture.reshape(height, -1)], axis=1)
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    text = chunk(b"tEXt", b"Comment\0" + note.encode("latin-1", "replace")) if note else b""
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + text + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def contact_sheet(draw: Callable[[bytes, str], list[np.ndarray]], most: int = PAGES) -> Callable[[bytes, str], bytes]:
    """A renderer for ``render_sample``: the first pages on one sheet; its note tells how many there are."""

    def render(data: bytes, extension: str) -> bytes:
        pages = list(draw(data, extension))
        if not pages:
            raise ValueError("a document without pages")
        shown = pages[:most]
        return png(compose(shown), f"{len(shown)} de {len(pages)} paginas" if len(pages) > len(shown) else f"{len(pages)} pagina(s)")

    return render
