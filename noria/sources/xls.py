"""The first sheet of a binary workbook (.xls, BIFF8): a stream of records in a compound document."""

from __future__ import annotations

import struct

MAGIC = bytes.fromhex("D0CF11E0A1B11AE1")
_END, _CONTINUE = 0xFFFFFFFA, 0x3C


def stream(content: bytes, *names: str) -> bytes:
    """The first of the named streams of a compound document."""
    if content[:8] != MAGIC:
        raise ValueError("no compound document")
    size, small = 1 << struct.unpack_from("<H", content, 30)[0], 1 << struct.unpack_from("<H", content, 32)[0]
    directory, cutoff, mini, more = struct.unpack_from("<I4xI4xI", content, 48)[0], *struct.unpack_from("<II", content, 56), struct.unpack_from("<I", content, 68)[0]

    def sector(i: int) -> bytes:
        return content[(i + 1) * size : (i + 2) * size]

    tables = [x for x in struct.unpack_from("<109I", content, 76) if x < _END]
    for _ in range(len(content) // size):  # further lists of tables, each naming the next
        if more >= _END:
            break
        *listed, more = struct.unpack(f"<{size // 4}I", sector(more))
        tables += [x for x in listed if x < _END]
    fat = [x for t in tables for x in struct.unpack(f"<{size // 4}I", sector(t))]

    def chain(start: int, table: list[int], part, width: int) -> bytes:
        out, seen = [], 0
        while start < _END:
            seen += 1
            if start >= len(table) or seen > len(table):
                raise ValueError("a broken chain of sectors")
            out.append(part(start))
            start = table[start]
        return b"".join(out)

    entries = chain(directory, fat, sector, size)
    found, root = {}, b""
    for at in range(0, len(entries), 128):
        e = entries[at : at + 128]
        length, kind, start, extent = *struct.unpack_from("<HB", e, 64), *struct.unpack_from("<II", e, 116)
        if kind == 5:
            root = chain(start, fat, sector, size) if start < _END else b""
        elif kind == 2:
            found[e[: max(0, length - 2)].decode("utf-16-le")] = start, extent
    for name in names:
        if name in found:
            start, extent = found[name]
            if extent >= cutoff:
                return chain(start, fat, sector, size)[:extent]
            table = chain(mini, fat, sector, size) if mini < _END else b""
            return chain(start, list(struct.unpack(f"<{len(table) // 4}I", table)), lambda i: root[i * small : (i + 1) * small], small)[:extent]
    raise ValueError(f"no stream {' or '.join(names)}")


def records(data: bytes, at: int = 0):
    """(kind, parts): a record's body, and those of the records that continue it."""
    kind, parts = None, []
    while at + 4 <= len(data):
        now, n = struct.unpack_from("<HH", data, at)
        body, at = data[at + 4 : at + 4 + n], at + 4 + n
        if now == _CONTINUE and kind is not None:
            parts.append(body)
            continue
        if kind is not None:
            yield kind, parts
        kind, parts = now, [body]
    if kind is not None:
        yield kind, parts


class _Shared:
    """Reads the shared strings, which may be cut by the ends of records; text that goes on begins with a byte that says its width."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.part, self.at = parts, 0, 0

    def take(self, n: int) -> bytes:
        out = b""
        while n:
            if self.at >= len(self.parts[self.part]):
                self.part, self.at = self.part + 1, 0
            got = self.parts[self.part][self.at : self.at + n]
            out, self.at, n = out + got, self.at + len(got), n - len(got)
        return out

    def text(self, n: int, wide: bool) -> str:
        out = ""
        while n:
            left = len(self.parts[self.part]) - self.at
            if left <= 0:
                self.part, self.at = self.part + 1, 1
                wide = bool(self.parts[self.part][0] & 1)
                continue
            some = min(n, left // 2 if wide else left)
            out += self.take(some * 2 if wide else some).decode("utf-16-le" if wide else "latin-1")
            n -= some
        return out

    def string(self) -> str:
        n, flags = struct.unpack("<HB", self.take(3))
        runs = struct.unpack("<H", self.take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", self.take(4))[0] if flags & 4 else 0
        out = self.text(n, bool(flags & 1))
        self.take(4 * runs + extra)
        return out


def _number(x: float) -> str:
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else f"{x:.15g}"


def _packed(raw: int) -> float:
    """A number in 30 bits: an integer, or the front of a double; in hundredths if the lowest bit is set."""
    value = float((raw - (1 << 32) if raw >> 31 else raw) >> 2) if raw & 2 else struct.unpack("<d", struct.pack("<Q", (raw & 0xFFFFFFFC) << 32))[0]
    return value / 100 if raw & 1 else value


def rows(content: bytes) -> list[dict[int, str | None]]:
    """Rows of the first worksheet, column -> text; rows without cells are left out."""
    data = stream(content, "Workbook", "Book")
    shared, begin = [], None
    for kind, parts in records(data):
        body = parts[0]
        if kind == 0x809 and struct.unpack_from("<H", body)[0] != 0x600:
            raise ValueError("an older workbook than BIFF8")
        if kind == 0x2F:
            raise ValueError("the workbook is encrypted")
        if kind == 0x85 and begin is None and body[5] == 0:
            begin = struct.unpack_from("<I", body)[0]
        if kind == 0xFC:
            reader = _Shared([body[8:], *parts[1:]])
            shared = [reader.string() for _ in range(struct.unpack_from("<I", body, 4)[0])]
        if kind == 0x0A:
            break
    if begin is None:
        raise ValueError("no worksheet")
    out: dict[int, dict[int, str | None]] = {}
    depth, waits = 0, None
    for kind, parts in records(data, begin):
        body = b"".join(parts) if kind != 0x207 else b""
        depth += (kind == 0x809) - (kind == 0x0A)
        if depth == 0:
            break
        if depth > 1:  # a chart within the sheet
            continue
        if kind == 0x207 and waits:
            reader = _Shared(parts)
            n, flags = struct.unpack("<HB", reader.take(3))
            out.setdefault(waits[0], {})[waits[1]], waits = reader.text(n, bool(flags & 1)), None
        if kind not in (0xFD, 0x203, 0x27E, 0xBD, 0x204, 0x06, 0x205) or len(body) < 6:
            continue
        row, column = struct.unpack_from("<HH", body)
        cells = out.setdefault(row, {})
        if kind == 0xFD:
            cells[column] = shared[struct.unpack_from("<I", body, 6)[0]]
        elif kind == 0x203:
            cells[column] = _number(struct.unpack_from("<d", body, 6)[0])
        elif kind == 0x27E:
            cells[column] = _number(_packed(struct.unpack_from("<I", body, 6)[0]))
        elif kind == 0xBD:
            for i in range((len(body) - 6) // 6):
                cells[column + i] = _number(_packed(struct.unpack_from("<I", body, 6 + 6 * i)[0]))
        elif kind == 0x204:
            reader = _Shared([body[6:]])
            n, flags = struct.unpack("<HB", reader.take(3))
            cells[column] = reader.text(n, bool(flags & 1))
        elif kind == 0x205:
            cells[column] = str(body[6]) if not body[7] else None
        elif body[12:14] != b"\xff\xff":
            cells[column] = _number(struct.unpack_from("<d", body, 6)[0])
        elif body[6] == 0:
            waits = row, column
        else:
            cells[column] = str(body[8]) if body[6] == 1 else None
    return [out[r] for r in sorted(out) if out[r]]
