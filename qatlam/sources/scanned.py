"""Text layers of PDF and DjVu files with the standard library only. A page without a text layer has no block; it is left to an
OCR extractor given to ``readers.register``."""

from __future__ import annotations

import re
import zlib

#: A page's text layer counts from so many characters.
LEAST_CHARS = 20

_OBJECT = re.compile(rb"(?<!\d)(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj\b", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_REF = re.compile(rb"(\d+)\s+\d+\s+R")
_TOKEN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/\[\]()<>]+|[-+]?\d*\.?\d+|[A-Za-z'\"*]+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _data(body: bytes) -> bytes:
    m = _STREAM.search(body)
    if not m:
        return b""
    raw = m.group(1)
    if b"FlateDecode" in body[: m.start()]:
        try:
            return zlib.decompressobj().decompress(raw)
        except zlib.error:
            return b""
    return raw


def _objects(content: bytes) -> dict[int, bytes]:
    out = {int(n): body for n, _, body in _OBJECT.findall(content)}
    # objects packed in streams
    for body in list(out.values()):
        if b"/ObjStm" in body:
            data = _data(body)
            first, count = re.search(rb"/First\s+(\d+)", body), re.search(rb"/N\s+(\d+)", body)
            if data and first and count:
                head = [int(x) for x in data[: int(first.group(1))].split()[: 2 * int(count.group(1))]]
                starts = head[1::2] + [len(data)]
                for k, n in enumerate(head[::2]):
                    out.setdefault(n, data[int(first.group(1)) + starts[k] : int(first.group(1)) + starts[k + 1] if k + 1 < len(head) // 2 else len(data)])
    return out


def _pages(objects: dict[int, bytes]) -> list[bytes]:
    """Page objects in the order of the page tree; in file order where the tree is broken."""
    roots = [b for b in objects.values() if re.search(rb"/Type\s*/Pages\b", b) and not re.search(rb"/Parent\b", b)]
    out: list[bytes] = []
    seen: set[int] = set()

    def go(body: bytes) -> None:
        kids = re.search(rb"/Kids\s*\[(.*?)\]", body, re.S)
        for ref in _REF.findall(kids.group(1)) if kids else ():
            n = int(ref)
            if n in seen or n not in objects:
                continue
            seen.add(n)
            if re.search(rb"/Type\s*/Page\b", objects[n]):
                out.append(objects[n])
            else:
                go(objects[n])

    for r in roots:
        go(r)
    return out or [b for b in objects.values() if re.search(rb"/Type\s*/Page\b", b)]


def _hex(s: bytes) -> bytes:
    s = re.sub(rb"\s+", b"", s)
    return bytes.fromhex((s + b"0" * (len(s) % 2)).decode())


def _cmap(data: bytes) -> dict[bytes, str]:
    """Codes and their text from a font's ToUnicode table."""
    out: dict[bytes, str] = {}
    text = lambda h: _hex(h).decode("utf-16-be", "replace")
    for part in re.findall(rb"beginbfchar(.*?)endbfchar", data, re.S):
        for a, b in re.findall(rb"<([^>]*)>\s*<([^>]*)>", part):
            out[_hex(a)] = text(b)
    for part in re.findall(rb"beginbfrange(.*?)endbfrange", data, re.S):
        for a, b, c in re.findall(rb"<([^>]*)>\s*<([^>]*)>\s*<([^>]*)>", part):
            lo, hi, size = int(a, 16), int(b, 16), len(_hex(a))
            base = text(c)
            for k in range(min(hi - lo + 1, 1 << 16)):
                out[(lo + k).to_bytes(size, "big")] = base[:-1] + chr(ord(base[-1]) + k) if base else ""
    return out


def _fonts(page: bytes, objects: dict[int, bytes]) -> dict[bytes, dict[bytes, str]]:
    resources = page
    m = re.search(rb"/Resources\s+(\d+)\s+\d+\s+R", page)
    if m:
        resources = objects.get(int(m.group(1)), b"")
    m = re.search(rb"/Font\s+(\d+)\s+\d+\s+R", resources)
    if m:
        fonts = objects.get(int(m.group(1)), b"")
    else:
        m = re.search(rb"/Font\s*<<(.*?)>>", resources, re.S)
        fonts = m.group(1) if m else b""
    out = {}
    for name, ref in re.findall(rb"/([^\s/<>]+)\s+(\d+)\s+\d+\s+R", fonts):
        u = re.search(rb"/ToUnicode\s+(\d+)\s+\d+\s+R", objects.get(int(ref), b""))
        if u:
            out[b"/" + name] = _cmap(_data(objects.get(int(u.group(1)), b"")))
    return out


def _string(token: bytes, font: dict[bytes, str]) -> str:
    if token[:1] == b"<":
        raw = _hex(token[1:-1])
    else:
        raw = re.sub(rb"\\(\d{1,3}|\r?\n|.)", lambda m: bytes([int(m.group(1), 8) & 255]) if m.group(1).isdigit() else b"" if m.group(1).strip() == b"" and b"\n" in m.group(1) else _ESCAPES.get(m.group(1), m.group(1)), token[1:-1], flags=re.S)
    if not font:
        return raw.decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("cp1252", "replace")
    size = max(map(len, font))
    return "".join(font.get(raw[i : i + size], "") for i in range(0, len(raw), size))


def _text(stream: bytes, fonts: dict[bytes, dict[bytes, str]]) -> list[tuple[float, str]]:
    """(height, line) of the text that a page's stream shows; a block of text is one line list, blocks are split by ET."""
    blocks: list[tuple[float, str]] = []
    parts: list[str] = []
    font: dict[bytes, str] = {}
    stack: list[bytes] = []
    y = 0.0
    number = lambda t: float(t) if re.fullmatch(rb"[-+]?\d*\.?\d+", t) else 0.0
    for t in _TOKEN.findall(stream):
        if not re.fullmatch(rb"[A-Za-z'\"*]+", t):
            stack.append(t)
            continue
        if t == b"Tf" and len(stack) >= 2:
            font = fonts.get(stack[-2], {})
        elif t in (b"Td", b"TD") and len(stack) >= 2:
            dy = number(stack[-1])
            y += dy
            if abs(dy) > 0.1 and parts:
                parts.append("\n")
        elif t == b"Tm" and len(stack) >= 6:
            new = number(stack[-1])
            if abs(new - y) > 0.1 and parts:
                parts.append("\n")
            y = new
        elif t == b"T*":
            parts.append("\n")
        elif t in (b"Tj", b"'", b'"') and stack:
            parts.append(("\n" if t != b"Tj" and parts else "") + _string(stack[-1], font))
        elif t == b"TJ":
            at = max((i for i, x in enumerate(stack) if x == b"["), default=-1)
            for x in stack[at + 1 :]:
                if x[:1] in b"(<":
                    parts.append(_string(x, font))
                elif number(x) < -200:
                    parts.append(" ")
        elif t == b"ET":
            text = "".join(parts).strip()
            if text:
                blocks.append((y, text))
            parts = []
        stack.clear()
    return blocks


def pdf(content: bytes) -> list[tuple[int, str]]:
    """(page from 1, text) of the blocks of each page whose text layer is long enough. Encrypted files have none."""
    if re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", content):
        return []
    objects = _objects(content)
    out: list[tuple[int, str]] = []
    for n, page in enumerate(_pages(objects), 1):
        m = re.search(rb"/Contents\s*(\[.*?\]|\d+\s+\d+\s+R)", page, re.S)
        streams = b"\n".join(_data(objects.get(int(r), b"")) for r in _REF.findall(m.group(1))) if m else b""
        blocks = _text(streams, _fonts(page, objects))
        if sum(len(t) for _, t in blocks) >= LEAST_CHARS:
            out.extend((n, p.strip()) for _, t in blocks for p in t.split("\n\n") if p.strip())
    return out


def djvu(content: bytes) -> list[tuple[int, str]]:
    """(page from 1, text) of each page with an uncompressed text layer; compressed layers need a library of their own and raise."""
    if content[:8] != b"AT&TFORM":
        raise ValueError("no DjVu file")
    out: list[tuple[int, str]] = []
    page = 0

    def chunks(a: int, b: int):
        while a + 8 <= b:
            size = int.from_bytes(content[a + 4 : a + 8], "big")
            yield content[a : a + 4], a + 8, min(b, a + 8 + size)
            a += 8 + size + size % 2

    def form(a: int, b: int) -> None:
        nonlocal page
        kind = content[a : a + 4]
        page += kind == b"DJVU"
        for name, x, y in chunks(a + 4, b):
            if name == b"FORM":
                form(x, y)
            elif name == b"TXTa":
                n = int.from_bytes(content[x : x + 3], "big")
                text = content[x + 3 : x + 3 + n].decode("utf-8", "replace")
                if len(text.strip()) >= LEAST_CHARS:
                    out.extend((page, p.strip()) for p in re.split(r"\n\n|\x0b|\x1d|\x1f", text) if p.strip())
            elif name == b"TXTz":
                raise ValueError("compressed DjVu text layer: register an extractor")

    form(12, len(content))
    return out
