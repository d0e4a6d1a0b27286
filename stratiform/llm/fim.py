"""Fill-in-middle transformation on piece tables.

A document is a list of descriptors (buffer, start, length) over two buffers that never change: its
own UTF-8 bytes and the bytes of the sentinels. Cutting splits a descriptor, an arrangement
permutes them and puts sentinels between, the inverse permutation restores the document, and
hashes are fed descriptor by descriptor. Texts are copied only where an output is asked for as a
text, or read back. Rows do not depend on each other: nothing is shuffled, and a lost task is simply run again.

Where to cut, and into which form, is decided by the SHA-256 of the seed and the row's key, so that
a run can be repeated. Units are lines, each with its line end; the last may lack it.

Defined results: NULL text is the empty text, which stays plain, as does a text that holds a
sentinel, since the output could not be told apart; a NULL key counts as the empty text in the
hash; rows of one key are cut by the same fractions; repeated rows give repeated rows; very long
texts are handled whole, one at a time; an empty table gives an empty result; input columns but the text ride along in
``row``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from stratiform.llm.base import filled

# Sentinels of prefix, suffix and middle, and the parts of the two arrangements in order.
SENTINELS = ("<P>", "<S>", "<M>")
ARRANGEMENTS = {"psm": (("<P>", "prefix"), ("<S>", "suffix"), ("<M>", "middle")), "spm": (("<S>", "suffix"), ("<P>", "prefix"), ("<M>", "middle"))}
PARTS = ("prefix", "middle", "suffix")
TEXT, MARKS = "text", "marks"

Piece = tuple[str, int, int]  # buffer, start, length; in bytes

_MARKS = "".join(SENTINELS).encode()
_MARK_AT = {s: ("".join(SENTINELS).index(s), len(s)) for s in SENTINELS}
PIECES = ArrayType(StructType([StructField("buffer", StringType()), StructField("start", LongType()), StructField("length", LongType())]))


@dataclass(frozen=True)
class PieceTable:
    """Descriptors over an immutable text and the sentinels."""

    text: memoryview
    pieces: tuple[Piece, ...]

    @classmethod
    def of(cls, text: bytes | memoryview) -> PieceTable:
        view = memoryview(text)
        return cls(view, ((TEXT, 0, len(view)),))

    def views(self) -> Iterator[memoryview]:
        marks = memoryview(_MARKS)
        for buffer, start, length in self.pieces:
            yield (self.text if buffer == TEXT else marks)[start : start + length]

    def cut(self, at: Sequence[int]) -> list[PieceTable]:
        """The parts between the places ``at`` (ascending, in bytes of what the table stands for)."""
        parts, own, left = [], [], 0
        ends = iter(at)
        end = next(ends, None)
        for buffer, start, length in self.pieces:
            while end is not None and end <= left + length:
                own.append((buffer, start, end - left))
                parts.append(own)
                start, length, left, own = start + end - left, length - (end - left), end, []
                end = next(ends, None)
            own.append((buffer, start, length))
            left += length
        parts.append(own)
        return [PieceTable(self.text, tuple(p for p in part if p[2])) for part in parts]

    def digest(self) -> str:
        """SHA-256 of what the table stands for, without putting it together."""
        out = hashlib.sha256()
        for view in self.views():
            out.update(view)
        return out.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.views())


def arranged(parts: Sequence[PieceTable], form: str) -> PieceTable:
    """Prefix, middle and suffix in the order of ``form``, each behind its sentinel."""
    by_name, pieces = dict(zip(PARTS, parts)), []
    for mark, name in ARRANGEMENTS[form]:
        pieces += [(MARKS, *_MARK_AT[mark]), *by_name[name].pieces]
    return PieceTable(parts[0].text, tuple(pieces))


def restored(output: bytes, form: str) -> PieceTable:
    """The document again, as descriptors over an output, by the inverse of its arrangement.

    A sentinel can neither begin inside the part before it nor end inside the part behind it, so
    the first place of each is its own.
    """
    table = PieceTable.of(output)
    if form == "plain":
        return table
    starts = [output.index(mark.encode()) for mark, _ in ARRANGEMENTS[form]]
    between = table.cut(sorted([*starts, *(s + len(mark) for s, (mark, _) in zip(starts, ARRANGEMENTS[form]))]))
    found = {name: part for (_, name), part in zip(ARRANGEMENTS[form], between[2::2])}
    return PieceTable(table.text, tuple(p for name in PARTS for p in found[name].pieces))


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends, line end included."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def _chars(table: PieceTable) -> int:
    """Code points of a table: bytes that do not continue one."""
    return sum(int(np.count_nonzero((np.frombuffer(v, np.uint8) & 0xC0) != 0x80)) for v in table.views())


@dataclass(frozen=True)
class Choice:
    """How documents are dealt out: to the transformation at all, and then to suffix-first."""

    seed: int = 7
    percent: int = 100
    suffix_first: int = 50


@dataclass(frozen=True)
class Transformed:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    table: PieceTable


def transform(text: bytes, key: str, choice: Choice = Choice()) -> Transformed:
    """One document cut at two lines and rearranged."""
    ends = line_ends(text)
    n = len(ends)
    digest = hashlib.sha256(f"{choice.seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    whole = PieceTable.of(text)
    if not text or any(s.encode() in text for s in SENTINELS) or h3 % 100 >= choice.percent:
        return Transformed(n, "plain", None, None, whole)
    edges = np.concatenate(([0], ends))
    parts = whole.cut([int(edges[h]) for h in sorted((h1 % (n + 1), h2 % (n + 1)))])
    form = "spm" if h4 % 100 < choice.suffix_first else "psm"
    return Transformed(n, form, _chars(parts[0]), _chars(parts[1]), arranged(parts, form))


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", choice: Choice = Choice(), with_output: bool = False) -> DataFrame:
    """All rows as ``row`` (without the text) with ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``pieces``, ``output_sha256``, ``restored_sha256`` and, if asked for, ``output``.

    ``restored_sha256`` is that of the document as rebuilt from the output and the form alone.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("row")
    rows = docs.select(row, filled(F.col(f"`{key}`").cast("string")).alias("key"), filled(text).alias("text"))
    fields = [("n", LongType()), ("form", StringType()), ("prefix_chars", LongType()), ("middle_chars", LongType()), ("pieces", PIECES), ("output_sha256", StringType()), ("restored_sha256", StringType())]
    fields += [("output", StringType())] * with_output
    schema = StructType([rows.schema["row"], *(StructField(n, t) for n, t in fields)])
    piece = pa.struct([("buffer", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
    types = {LongType(): pa.int64(), StringType(): pa.string(), PIECES: pa.list_(piece)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name, _ in fields}
            for name, value in zip(batch.column(1), batch.column(2)):
                done = transform(value.as_buffer().to_pybytes(), name.as_py(), choice)
                output = done.table.bytes()
                for field in ("n", "form", "prefix_chars", "middle_chars"):
                    out[field].append(getattr(done, field))
                out["pieces"].append([dict(zip(("buffer", "start", "length"), p)) for p in done.table.pieces])
                out["output_sha256"].append(done.table.digest())
                out["restored_sha256"].append(restored(output, done.form).digest())
                if with_output:
                    out["output"].append(output)
            made = [pa.array(out[n], pa.binary() if n == "output" else types[t]) for n, t in fields]
            made = [a.cast(pa.string()) if a.type == pa.binary() else a for a in made]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["row", *out])

    return rows.mapInArrow(work, schema)


def restored_texts(outputs: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``outputs`` with ``restored``, the document rebuilt from an output and its form; NULL for NULLs, unknown forms and lost sentinels."""

    def back(text: pa.StringScalar, kind: str | None) -> bytes | None:
        if not text.is_valid or kind not in (*ARRANGEMENTS, "plain"):
            return None
        data = text.as_buffer().to_pybytes()
        return None if kind != "plain" and any(m.encode() not in data for m, _ in ARRANGEMENTS[kind]) else restored(data, kind).bytes()

    schema = StructType([*outputs.schema.fields, StructField("restored", StringType())])
    at = [outputs.columns.index(c) for c in (output, form)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [back(t, kind) for t, kind in zip(batch.column(at[0]), batch.column(at[1]).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], schema.names)

    return outputs.mapInArrow(work, schema)
