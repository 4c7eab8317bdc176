"""Words of PDF documents with their places, for those that are born digital and not encrypted.

Objects are found by their marks and not by the cross-reference table, so a document whose table is
broken can be read; object streams are unpacked.  Content streams give words by the text matrix, and
character codes become text through a font's ToUnicode map or as Latin-1.  Pictures and scans have no words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.functions import udtf

_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"^(.*?)\bstream\r?\n(.*?)\r?\n?endstream", re.S)
_TOKEN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/\[\]()<>]+|[-+]?\d*\.?\d+|[A-Za-z'\"*]+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
#: Kerning beyond this many thousandths of the font's size is a space.
GAP = 180


@dataclass(frozen=True)
class Word:
    page: int
    x: float
    y: float
    size: float
    text: str


def _inflated(head: bytes, data: bytes) -> bytes:
    if b"FlateDecode" not in head:
        return data
    try:
        return zlib.decompressobj().decompress(data)
    except zlib.error:
        return b""


class Document:
    def __init__(self, raw: bytes):
        self.objects: dict[int, tuple[bytes, bytes]] = {}
        for number, _, body in _OBJECT.findall(raw):
            found = _STREAM.match(body)
            self.objects[int(number)] = (found[1], _inflated(found[1], found[2])) if found else (body, b"")
        for head, data in list(self.objects.values()):
            if b"/ObjStm" in head and (first := re.search(rb"/First\s+(\d+)", head)):
                at = int(first[1])
                pairs = [int(x) for x in data[:at].split()]
                places = list(zip(pairs[::2], pairs[1::2]))
                for (number, start), (_, end) in zip(places, [*places[1:], (0, len(data) - at)]):
                    self.objects.setdefault(number, (data[at + start : at + end], b""))

    def _refs(self, head: bytes, name: bytes) -> list[int]:
        found = re.search(rb"/" + name + rb"\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", head)
        return [int(x) for x in re.findall(rb"(\d+)\s+\d+\s+R", found[1])] if found else []

    def pages(self) -> list[int]:
        """Page objects in the order of the page tree, or by number where the tree is lost."""
        every = [n for n, (head, _) in self.objects.items() if re.search(rb"/Type\s*/Page\b(?!s)", head)]
        out, seen = [], set()

        def down(number: int) -> None:
            if number in seen or number not in self.objects:
                return
            seen.add(number)
            head = self.objects[number][0]
            if number in every:
                out.append(number)
            for kid in self._refs(head, b"Kids"):
                down(kid)

        for root, (head, _) in sorted(self.objects.items()):
            if re.search(rb"/Type\s*/Pages\b", head) and b"/Parent" not in head:
                down(root)
        return out + sorted(set(every) - set(out))

    def _fonts(self, head: bytes) -> dict[bytes, dict[int, str]]:
        found = head
        for number in self._refs(head, b"Resources"):
            found += self.objects.get(number, (b"", b""))[0]
        fonts = re.search(rb"/Font\s*<<(.*?)>>", found, re.S)
        listed = fonts[1] if fonts else b"".join(self.objects.get(n, (b"", b""))[0] for n in self._refs(found, b"Font"))
        return {name: self._unicode(int(number)) for name, number in re.findall(rb"/(\S+)\s+(\d+)\s+\d+\s+R", listed)}

    def _unicode(self, font: int) -> dict[int, str]:
        """The codes of a font and their text; under -1 how many bytes a code has."""
        out: dict[int, str] = {}
        head = self.objects.get(font, (b"", b""))[0]
        for number in self._refs(head, b"ToUnicode"):
            data = self.objects.get(number, (b"", b""))[1]
            text = lambda x: bytes.fromhex(x.decode()).decode("utf-16-be", "replace")
            for block in re.findall(rb"beginbfchar(.*?)endbfchar", data, re.S):
                for code, to in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
                    out[int(code, 16)], out[-1] = text(to), str(len(code) // 2)
            for block in re.findall(rb"beginbfrange(.*?)endbfrange", data, re.S):
                for low, high, to in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
                    out[-1] = str(len(low) // 2)
                    for i in range(int(low, 16), min(int(high, 16), int(low, 16) + 0xFFFF) + 1):
                        out[i] = chr(int(to, 16) + i - int(low, 16))
        return out

    def words(self) -> Iterator[Word]:
        for number, page in enumerate(self.pages(), 1):
            head = self.objects[page][0]
            content = b"\n".join(self.objects.get(n, (b"", b""))[1] for n in self._refs(head, b"Contents"))
            yield from _shown(content, number, self._fonts(head))


def _bytes(token: bytes) -> bytes:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1]).decode()
        return bytes.fromhex(digits + "0" * (len(digits) % 2))
    return re.sub(rb"\\([nrtbf()\\]|[0-7]{1,3}|\r?\n)", lambda m: _ESCAPES.get(m[1], bytes([int(m[1], 8) & 255]) if m[1].isdigit() else b"" if m[1].strip() == b"" else m[1]), token[1:-1])


def _text(raw: bytes, font: dict[int, str]) -> str:
    if not font:
        return raw.decode("latin-1")
    width = int(font[-1])
    return "".join(font.get(int.from_bytes(raw[i : i + width], "big"), "") for i in range(0, len(raw), width))


def _shown(content: bytes, page: int, fonts: dict[bytes, dict[int, str]]) -> Iterator[Word]:
    """Words at the places of the text matrix; the width of a letter is taken for half its size."""
    stack: list = []
    x = y = left = leading = 0.0
    size, scale, font = 1.0, 1.0, {}

    def put(text: str) -> Iterator[Word]:
        nonlocal x
        for part in re.split(r"(\s+)", text):
            if part.strip():
                yield Word(page, round(x, 2), round(y, 2), round(size * scale, 2), part)
            x += len(part) * size * scale / 2

    for token in _TOKEN.findall(content):
        if token[:1] in b"(<[]/+-.0123456789":
            stack.append(token)
            continue
        op, numbers = token.decode("latin-1"), [float(t) for t in stack if re.fullmatch(rb"[-+]?\d*\.?\d+", t)]
        if op == "BT":
            x = y = left = 0.0
            scale = 1.0
        elif op == "Tf" and len(stack) >= 2:
            font, size = fonts.get(stack[-2][1:], {}), numbers[-1]
        elif op == "TL" and numbers:
            leading = numbers[-1]
        elif op in ("Td", "TD") and len(numbers) >= 2:
            left, y = left + numbers[-2] * scale, y + numbers[-1] * scale
            x, leading = left, -numbers[-1] if op == "TD" else leading
        elif op == "Tm" and len(numbers) >= 6:
            scale, left, y = abs(numbers[-3]) or 1.0, numbers[-2], numbers[-1]
            x = left
        elif op in ("T*", "'", '"'):
            x, y = left, y - leading * scale
        if op in ("Tj", "'", '"') and stack:
            yield from put(_text(_bytes(stack[-1]), font))
        elif op == "TJ":
            text = ""
            for t in stack:
                if t[:1] in b"(<":
                    text += _text(_bytes(t), font)
                elif t not in (b"[", b"]") and -float(t) > GAP:
                    text += " "
            yield from put(text)
        stack = []


@udtf(returnType="page int, x double, y double, size double, text string, error string")
class PdfWords:
    """A row for each word of a document; one that has none says so."""

    def eval(self, content: bytes) -> Iterator[tuple]:
        raw, found = bytes(content or b""), False
        if b"/Encrypt" not in raw:
            for w in Document(raw).words():
                found = True
                yield w.page, w.x, w.y, w.size, w.text, None
        if not found:
            yield None, None, None, None, None, "encrypted" if b"/Encrypt" in raw else "no words"


def written(pages: list[list[tuple[float, float, float, str]]]) -> bytes:
    """A small document of words (x, y, size, text) by page: for tests and demonstrations."""
    out, objects = b"%PDF-1.4\n", []
    kids = " ".join(f"{3 + 2 * i} 0 R" for i in range(len(pages)))
    objects += [b"<< /Type /Catalog /Pages 2 0 R >>", f"<< /Type /Pages /Kids [{kids}] /Count {len(pages)} >>".encode()]
    for i, words in enumerate(pages):
        escaped = lambda t: t.replace("\\", "\\\\").replace("(", "\\(").replace(")", "\\)")
        lines = "".join(f"BT /F1 {size:g} Tf 1 0 0 1 {x:g} {y:g} Tm ({escaped(text)}) Tj ET\n" for x, y, size, text in words).encode("latin-1", "replace")
        data = zlib.compress(lines)
        objects.append(f"<< /Type /Page /Parent 2 0 R /Contents {4 + 2 * i} 0 R /Resources << /Font << /F1 << /Type /Font /Subtype /Type1 /BaseFont /Helvetica >> >> >> >>".encode())
        objects.append(f"<< /Length {len(data)} /Filter /FlateDecode >>\nstream\n".encode() + data + b"\nendstream")
    for number, body in enumerate(objects, 1):
        out += f"{number} 0 obj\n".encode() + body + b"\nendobj\n"
    return out + b"trailer << /Root 1 0 R >>\n%%EOF"
