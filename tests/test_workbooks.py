"""Binary workbooks against equal .xlsx files; the writer here makes compound documents with the records a spreadsheet has."""

import struct

import pytest

from noria.sources import files, xls


def rec(kind, body):
    return struct.pack("<HH", kind, len(body)) + body


def wide(text):
    return struct.pack("<HB", len(text), 1) + text.encode("utf-16-le")


def shared_strings(texts, cut):
    """SST, cut after `cut` bytes of a body into records that continue it, also inside a string's text."""
    out, body, head = [], struct.pack("<II", len(texts), len(texts)), 0xFC
    for i, t in enumerate(texts):
        rich = i % 3 == 1
        piece = struct.pack("<HBH", len(t), 9, 1) if rich else struct.pack("<HB", len(t), 1)
        if len(body) + len(piece) > cut:
            out.append(rec(head, body))
            head, body = 0x3C, b""
        body += piece
        for c in t:
            if len(body) + 2 > cut:
                out.append(rec(head, body))
                head, body = 0x3C, b"\x01"
            body += c.encode("utf-16-le")
        if rich:
            if len(body) + 4 > cut:
                out.append(rec(head, body))
                head, body = 0x3C, b""
            body += b"\0\0\1\0"
    return b"".join([*out, rec(head, body)])


def workbook(rows, cut=8000, encrypted=False):
    """rows of str, int, float, bool, None, or ("=", text) for a formula."""
    texts = list(dict.fromkeys(v for r in rows for v in r if isinstance(v, str)))
    bof = rec(0x809, struct.pack("<HHHHII", 0x600, 5, 0, 0, 0, 6))
    sst = shared_strings(texts, cut)
    name = b"s"
    bound = lambda at, kind: rec(0x85, struct.pack("<IBBBB", at, 0, kind, len(name), 0) + name)
    size = len(bof) + 2 * len(bound(0, 0)) + len(sst) + 4 + (8 if encrypted else 0)
    sheet = rec(0x809, struct.pack("<HHHHII", 0x600, 0x10, 0, 0, 0, 6))
    for i, r in enumerate(rows):
        for j, v in enumerate(r):
            at = struct.pack("<HHH", i, j, 15)
            if v is None:
                sheet += rec(0x201, at)
            elif isinstance(v, bool):
                sheet += rec(0x205, at + bytes([v, 0]))
            elif isinstance(v, str):
                sheet += rec(0xFD, at + struct.pack("<I", texts.index(v)))
            elif isinstance(v, int):
                sheet += rec(0x27E, at + struct.pack("<I", (v << 2 & 0xFFFFFFFF) | 2)) if j % 2 else rec(0xBD, struct.pack("<HHHIH", i, j, 15, (v * 100 << 2 & 0xFFFFFFFF) | 3, j))
            elif isinstance(v, float):
                sheet += rec(0x203, at + struct.pack("<d", v))
            else:
                sheet += rec(0x06, at + b"\0\0\0\0\0\0\xff\xff" + b"\0" * 8) + rec(0x207, wide(v[1]))
        if i == 0:  # a chart within the sheet, whose cells are none of it
            sheet += rec(0x809, struct.pack("<HHHHII", 0x600, 0x20, 0, 0, 0, 6)) + rec(0x203, struct.pack("<HHHd", 0, 0, 15, 9.0)) + rec(0x0A, b"")
    sheet += rec(0x0A, b"")
    crypt = rec(0x2F, b"\0\0\0\0") if encrypted else b""
    chart = len(bof) + len(crypt)
    return bof + crypt + bound(chart, 2) + bound(size, 0) + sst + rec(0x0A, b"") + sheet


def compound(data, name="Workbook"):
    """A compound document; a stream under 4,096 bytes lies in the small sectors."""
    small = len(data) < 4096
    pad = lambda x, n: x + b"\0" * (-len(x) % n)
    body = pad(data, 64 if small else 512)
    n_small = len(body) // 64 if small else 0
    stored = pad(body, 512)
    main = list(range(len(stored) // 512))
    fat, sectors = [x + 1 for x in main[:-1]] + [0xFFFFFFFE], [stored[i * 512 : i * 512 + 512] for i in main]
    mini = 0xFFFFFFFE
    if small:
        mini = len(sectors)
        table = struct.pack(f"<{n_small}I", *range(1, n_small), 0xFFFFFFFE)
        table += b"\xff" * (-len(table) % 512)
        for i in range(0, len(table), 512):
            sectors.append(table[i : i + 512])
            fat.append(len(sectors) if i + 512 < len(table) else 0xFFFFFFFE)

    def entry(text, kind, start, size):
        raw = text.encode("utf-16-le") + b"\0\0"
        return raw.ljust(64, b"\0") + struct.pack("<HBB", len(raw), kind, 1) + b"\xff" * 12 + b"\0" * 36 + struct.pack("<IQ", start, size)

    directory = len(sectors)
    sectors.append((entry("Root Entry", 5, 0 if small else 0xFFFFFFFE, len(stored) if small else 0) + entry(name, 2, 0, len(data))).ljust(512, b"\0"))
    fat.append(0xFFFFFFFE)
    n = 1
    while (len(fat) + n) * 4 > n * 512:
        n += 1
    at = list(range(len(sectors), len(sectors) + n))
    fat += [0xFFFFFFFD] * n
    raw = struct.pack(f"<{len(fat)}I", *fat).ljust(n * 512, b"\xff")
    sectors += [raw[i * 512 : i * 512 + 512] for i in range(n)]
    head = xls.MAGIC + b"\0" * 16 + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + b"\0" * 6 + struct.pack("<IIIIIIIIII", 0, n, directory, 0, 4096, mini, 1 if small else 0, 0xFFFFFFFE, 0, 0)[:36]
    return head + struct.pack("<109I", *at, *[0xFFFFFFFF] * (109 - n)) + b"".join(sectors)


ROWS = [["제목", "연도", "점수", "ok", "f"], ["가나다 <b>", 2020, 3.25, True, ("=", "공식")], [None, 1999, -0.5, False, None], ["e" * 300, 7, 1e20, None, ("=", "")]]


def plain(v):
    return v[1] if isinstance(v, tuple) else str(int(v)) if isinstance(v, bool) else None if v is None else str(v) if isinstance(v, (str, int)) else f"{v:.15g}"


@pytest.mark.parametrize("cut", [8000, 60, 25])
@pytest.mark.parametrize("many", [1, 40])
def test_rows_equal_those_of_an_xlsx(tmp_path, cut, many):
    rows = ROWS[:1] + [[v if not isinstance(v, str) else f"{v}{i}" for v in r] for i in range(many) for r in ROWS[1:]]
    data = workbook(rows, cut)
    files.write_xlsx([[plain(v) for v in r] for r in rows], str(tmp_path / "x.xlsx"))
    want = files.read_workbook((tmp_path / "x.xlsx").read_bytes())
    got = files.read_workbook(compound(data))
    assert list(got.columns) == list(want.columns) and (len(data) < 4096) == (len(compound(data)) < 8000)
    same = lambda t: [[v or None for v in r] for r in t.to_numpy().tolist()]  # noqa: E731  an empty text is no cell in an .xlsx
    assert same(got) == same(want)


def test_both_kinds_in_a_folder(spark, tmp_path):
    (tmp_path / "a.xls").write_bytes(compound(workbook([["id", "x"], ["1", "a"]])))
    files.write_xlsx([["id", "y"], ["2", "b"]], str(tmp_path / "b.xlsx"))
    got = sorted(map(tuple, files.read_exports(spark, str(tmp_path)).select("id", "x", "y", "source_file").collect()))
    assert got == [("1", "a", None, "a.xls"), ("2", None, "b", "b.xlsx")]
    assert sorted(r["path"].rsplit("/", 1)[-1] for r in files.list_exports(spark, str(tmp_path)).collect()) == ["a.xls", "b.xlsx"]


def test_what_is_no_workbook():
    good = compound(workbook(ROWS))
    with pytest.raises(ValueError, match="encrypted"):
        files.read_workbook(compound(workbook(ROWS, encrypted=True)))
    with pytest.raises(ValueError, match="no stream"):
        files.read_workbook(compound(workbook(ROWS), "Other"))
    with pytest.raises(ValueError, match="BIFF8"):
        files.read_workbook(compound(workbook(ROWS).replace(struct.pack("<HH", 0x600, 5), struct.pack("<HH", 0x500, 5), 1)))
    broken = bytearray(good)
    broken[48:52] = struct.pack("<I", 70000)
    with pytest.raises(ValueError, match="broken"):
        files.read_workbook(bytes(broken))
