"""Harmonic packing of tokenised documents into sequences."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noria.llm.common import slices
from noria.session import ship_package

CAPACITY = 2048
#: Lengths under this are not cut any further.
LEAST_CUT = 64
#: Words a worker remembers the ids of, in two generations; older ones are tokenised again when met.
CACHE_WORDS = 700_000

OUT = "id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Texts with other white space than single spaces and line ends are cut with more care.
_PAIRS = ("  ", " \n", "\n ", "\n\n")
_OTHER = re.compile("[\x00-\x09\x0b-\x1f\x7f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CUT = re.compile(r" (?!\s|\Z)")
#: The characters of a part whose pieces are found here, and the pieces: those of byte-level BPE, for these characters.
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WORD = re.compile(f"[{_LETTER}]+")
_PLAIN = re.compile(f"\n?[!-~{_LETTER}]*")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[!-/:-@\\[-`{{-~]+|[ \n]")


def _letters() -> dict[int, str]:
    """Byte -> the character that stands for it in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Known(dict):
    """What `find` gives for each key that was asked for of late, in two generations of at most half of `most` each."""

    def __init__(self, find, most: int):
        super().__init__()
        self.find, self.half, self.old = find, max(1, most // 2), {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.find(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordTokenizer:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    Byte-level BPE splits a text into pieces before it merges.  A space that stands
    before anything but white space always begins a piece, and so does a line end
    between two characters that are no white space.  So a text is cut there, each
    distinct part is tokenised once and remembered, and the ids of a text are those of
    its parts in turn.  The pieces of a part of Latin letters and ASCII go to the
    tokenizer's model as they are, all other parts through the whole tokenizer.  A text
    that holds one of the tokenizer's added tokens is tokenised as a whole.
    """

    def __init__(self, source: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.byte = _letters()
        self.first = _Known(lambda w: self._part(w, ""), cache_words // 8)
        self.inner = _Known(lambda w: self._part(w, " "), cache_words)
        self.marks = _Known(self._piece, 4096)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _piece(self, text: str) -> bytes:
        """Ids of a text that is one piece."""
        shown = text if text.isascii() else text.encode().decode("latin-1")
        return array("I", [t.id for t in self.tokenizer.model.tokenize(shown.translate(self.byte))]).tobytes()

    def _part(self, part: str, before: str) -> bytes:
        """Ids of a part that begins with a line end, or that `before` comes before."""
        if _WORD.fullmatch(part):
            return self._piece(before + part)
        text = part if part[:1] == "\n" else before + part
        if _PLAIN.fullmatch(part):
            return b"".join([self._piece(x) if len(x) > 4 else self.marks[x] for x in _PIECES.findall(text)])
        return self._whole(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        out, first, inner = [], self.first, self.inner.__getitem__
        for text in texts:
            if any(a in text for a in self.added):
                out.append(self._whole(text))
                continue
            head, *parts = split_parts(text)
            out.append(first[head] + b"".join(map(inner, parts)))
        return out


def split_parts(text: str) -> list[str]:
    """A text's parts: the first, and those that a space comes before (left out) or that begin with a line end."""
    if any(p in text for p in _PAIRS) or _OTHER.search(text):
        return _CUT.split(text)
    return text.replace("\n", " \n").split(" ")


def cuts(n: int, capacity: int = CAPACITY, least: int = LEAST_CUT) -> list[int]:
    """Piece lengths of a document: whole sequences, then falling powers of two, then what is under `least`."""
    out = [capacity] * (n // capacity)
    n %= capacity
    size = capacity >> 1
    while n >= least:
        if n >= size:
            out.append(size)
            n -= size
        size >>= 1
    return out + [n] if n else out


class HarmonicPacker:
    """Bins of one worker.

    A piece of length n is of class j = capacity // n, and a bin of class j takes
    exactly j pieces.  At most one bin of each class is open, holding fewer than j
    pieces; when the input ends, the open bins' pieces are packed by first fit, the
    longest first.
    """

    def __init__(self, first_id: int, capacity: int = CAPACITY):
        self.next_id, self.capacity, self.open = first_id, capacity, {}

    def add(self, piece: tuple, n: int) -> list[tuple]:
        """Pieces that are placed by now, each with its sequence and offset."""
        j = self.capacity // n
        bin_ = self.open.setdefault(j, [])
        bin_.append((piece, n))
        if len(bin_) < j:
            return []
        del self.open[j]
        return self._close(bin_)

    def _close(self, bin_: list) -> list[tuple]:
        out, at = [], 0
        for piece, n in bin_:
            out.append((*piece, self.next_id, at))
            at += n
        self.next_id += 1
        return out

    def finish(self) -> list[tuple]:
        rest = sorted((x for b in self.open.values() for x in b), key=lambda x: -x[1])
        bins: list[list] = []
        room: list[int] = []
        for x in rest:
            at = next((i for i, r in enumerate(room) if r >= x[1]), None)
            if at is None:
                bins.append([])
                room.append(self.capacity)
                at = len(bins) - 1
            bins[at].append(x)
            room[at] -= x[1]
        self.open = {}
        return [y for b in bins for y in self._close(b)]


_TOKENIZERS: dict[int, WordTokenizer] = {}


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """-> one row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    A document is its token ids and then `end_id`.  It is cut into whole sequences
    and a rest, the rest into powers of two while it is at least 64 long.  Powers of
    two fill the bins of their reciprocal class exactly, and a shorter rest wastes
    under 1/32 of a bin, so only a task's last sequences hold padding.

    Each task packs what it reads and shuffles nothing.  Sequence ids are
    partition * 2**32 + count, so a task that is run again gives the same rows.
    Memory is one open bin per class, a slice of text and the remembered words.
    The vocabulary's file is read by the driver.

    Nulls: a null text is empty and gives one piece, the end id; a null id stays
    null.  Repeated rows are packed each.  An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    source = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))  # a vocabulary, of fixed size
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}" + OUT[len("id {id}") :] + (", ids array<int>" if with_ids else "")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        key = zlib.crc32(source.value.encode())
        if key not in _TOKENIZERS:
            _TOKENIZERS.clear()
            _TOKENIZERS[key] = WordTokenizer(source.value)
        words = _TOKENIZERS[key]
        packer, arrow = HarmonicPacker(TaskContext.get().partitionId() << 32, capacity), None
        for batch in batches:
            arrow = batch.schema.field(0).type
            for lo, texts in slices(batch.column(1)):
                ids = batch.column(0).slice(lo, len(texts)).to_pylist()
                placed = []
                for i, data in zip(ids, words.encode([t or "" for t in texts.to_pylist()]), strict=True):
                    data += end
                    total, start = len(data) // 4, 0
                    for n in cuts(total, capacity):
                        piece = data[4 * start : 4 * (start + n)]
                        row = (i, start, n, zlib.crc32(piece), total, *((piece,) if with_ids else ()))
                        placed += packer.add(row, n)
                        start += n
                yield from _batch(placed, arrow, with_ids)
        if arrow is not None:
            yield from _batch(packer.finish(), arrow, with_ids)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def _batch(rows: list[tuple], arrow, with_ids: bool):
    if rows:
        cols = list(zip(*rows, strict=True))
        ids = [cols.pop(5)] if with_ids else []
        out = [pa.array(cols[0], arrow), *(pa.array(c, pa.int64()) for c in cols[1:])]
        out += [pa.array([np.frombuffer(x, dtype="<i4") for x in c], pa.list_(pa.int32())) for c in ids]
        yield pa.RecordBatch.from_arrays(out, [f"c{i}" for i in range(len(out))])
