"""Fill-in-middle transformation of whole batches by displacement.

A text is cut at two of its units into prefix, middle and suffix, which change places with a mark before each. No
text is cut or joined one by one: every segment moves by one distance, so a difference array over the
batch's bytes, summed up, gives each byte its place in the output, and one scatter writes them all. The way back scans the
output for the marks and gathers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.llm.byte_batches import binary_array, byte_groups, lead_bytes, owners
from churnkit.llm.frames import text_or_empty

# Marks of prefix, suffix and middle, and the order of the segments in each form.
MARKS = (b"<P>", b"<S>", b"<M>")
PREFIX, SUFFIX, MIDDLE = range(3)
FORMS = ("plain", "psm", "spm")
_ORDER = {1: (PREFIX, SUFFIX, MIDDLE), 2: (SUFFIX, PREFIX, MIDDLE)}
_MARK = len(MARKS[0])
_LETTERS = np.array([m[1] for m in MARKS], np.uint8)


def marks_in(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, owner and kind of every mark that lies inside one value."""
    at = np.flatnonzero((data[:-2] == MARKS[0][0]) & (data[2:] == MARKS[0][2]) & np.isin(data[1:-1], _LETTERS))
    owner = owners(offsets, at)
    inside = at + _MARK <= offsets[owner + 1]
    at, owner = at[inside], owner[inside]
    return at, owner, np.argmax(data[at + 1][:, None] == _LETTERS, axis=1)


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin: a run of ASCII letters is one, any other code point is one."""
    letter = ((data | 0x20) - np.uint8(97)) < 26
    after_letter = np.append(False, letter[:-1])
    after_letter[offsets[:-1][offsets[:-1] < len(data)]] = False
    return np.flatnonzero(lead_bytes(data) & ~(letter & after_letter))


def moved(starts: np.ndarray, distance: np.ndarray, total: int) -> np.ndarray:
    """Each of ``total`` places plus the distance of the segment it lies in; segments are in order and may be empty."""
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, starts, np.diff(distance, prepend=0))
    return np.cumsum(steps[:total]) + np.arange(total)


def laid_out(form: np.ndarray, base: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Start in the output of each text's segments (columns: prefix, suffix, middle); a plain text has marks of no length."""
    starts = np.empty_like(lengths)
    for code in range(len(FORMS)):
        rows = np.flatnonzero(form == code)
        order = _ORDER.get(code, (PREFIX, MIDDLE, SUFFIX))
        at = base[rows]
        for kind in order:
            at = at + (_MARK if code else 0)
            starts[rows, kind] = at
            at = at + lengths[rows, kind]
    return starts


def fill(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, plain_from: int, spm_below: int):
    """Outputs of adjacent texts: (bytes, offsets, n, form, prefix_chars, middle_chars); ``draws`` has four numbers a text."""
    starts = unit_starts(data, offsets)
    first = np.searchsorted(starts, offsets)
    n = np.diff(first)
    cuts = np.sort(draws[:, :2] % (n[:, None] + 1), axis=1)
    low, high = np.append(starts, len(data))[first[:-1, None] + cuts].T
    begin, end = offsets[:-1], offsets[1:]

    form = np.where(draws[:, 3] % 100 < spm_below, 2, 1)
    form[(draws[:, 2] % 100 >= plain_from) | (begin == end)] = 0
    form[marks_in(data, offsets)[1]] = 0

    out_offsets = np.append(0, np.cumsum(end - begin + 3 * _MARK * (form > 0)))
    target = laid_out(form, out_offsets[:-1], np.stack([low - begin, end - high, high - low], axis=1))
    segments = np.stack([begin, low, high], axis=1)
    distance = target[:, [PREFIX, MIDDLE, SUFFIX]] - segments
    out = np.empty(out_offsets[-1], np.uint8)
    out[moved(segments.ravel(), distance.ravel(), len(data))] = data
    cut = np.flatnonzero(form)
    for kind, mark in enumerate(MARKS):
        for i, byte in enumerate(mark):
            out[target[cut, kind] - _MARK + i] = byte
    points = np.append(0, np.cumsum(lead_bytes(data)))
    return out, out_offsets, n, form, points[low] - points[begin], points[high] - points[low]


def unfill(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts behind adjacent outputs and their forms: (bytes, offsets)."""
    at, owner, kind = marks_in(data, offsets)
    kept = form[owner] > 0
    at, owner, kind = at[kept], owner[kept], kind[kept]
    cut = np.flatnonzero(form)
    if len(at) != 3 * len(cut) or (owner != np.repeat(cut, 3)).any() or (kind != np.array([_ORDER[f] for f in form[cut]]).ravel()).any():
        raise ValueError("an output lacks the marks of its form")
    begin, end = offsets[:-1], offsets[1:]
    # A plain output is all prefix.
    source = np.repeat(begin[:, None], 3, axis=1)
    lengths = np.zeros((len(form), 3), np.int64)
    lengths[:, PREFIX] = end - begin
    at, kind = at.reshape(-1, 3), kind.reshape(-1, 3)
    for place, stop in enumerate((at[:, 1], at[:, 2], end[cut])):
        source[cut, kind[:, place]] = at[:, place] + _MARK
        lengths[cut, kind[:, place]] = stop - at[:, place] - _MARK
    out_offsets = np.append(0, np.cumsum(lengths.sum(axis=1)))
    target = laid_out(np.zeros(len(form), np.int64), out_offsets[:-1], lengths)
    in_turn = [PREFIX, MIDDLE, SUFFIX]
    distance = (source - target)[:, in_turn]
    return data[moved(target[:, in_turn].ravel(), distance.ravel(), out_offsets[-1])], out_offsets


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n (units), form, prefix_chars, middle_chars (null if plain), output (UTF-8).

    The cuts and the form are drawn by the SHA-256 of ``seed``, a colon and the id, so any task at any time draws the same.
    A text is left plain if it is empty, holds a mark, or its third number modulo 100 is ``plain_from`` or more; of the others
    those whose fourth modulo 100 is under ``spm_below`` put the suffix first. Null texts count as empty. Rows that repeat an id are
    drawn alike; rows without one draw as an empty id. Other columns are not read. An empty table gives an empty one.
    """
    hexes = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(hexes, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"_h{i}") for i in range(4)]
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).cast("binary").alias("_text"), *draws)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(FORMS, object)
        for batch in batches:
            drawn = np.stack([batch.column(2 + i).to_numpy() for i in range(4)], axis=1)
            for k, data, offsets in byte_groups(batch.column(1)):
                out, bounds, n, form, *sizes = fill(data, offsets, drawn[k], plain_from, spm_below)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[k], pa.array(n, pa.int64()), pa.array(names[form], pa.string()),
                        *(pa.array(s, pa.int64(), mask=form == 0) for s in sizes), binary_array(out, bounds),
                    ],
                    names=schema.names,
                )

    made = T.StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, output binary")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *made])
    return rows.mapInArrow(cut, schema)


def restore_texts(filled: DataFrame, form_col: str = "form", output_col: str = "output", restored: str = "restored") -> DataFrame:
    """All rows and columns, with the exact text (UTF-8) rebuilt from ``output_col`` and ``form_col`` alone.

    A null output counts as empty and a null form as plain; an output without the marks of its form fails the job. A
    column named ``restored`` is replaced. An empty table gives an empty one.
    """
    others = [c for c in filled.columns if c != restored]
    code = F.coalesce(F.array_position(F.array(*map(F.lit, FORMS)), F.col(form_col)) - 1, F.lit(0)).cast("int")
    # Under names of their own: columns of the table may have any name.
    named = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)]
    output = F.coalesce(F.col(output_col).cast("binary"), F.lit(b""))
    named[others.index(output_col)] = output.alias(f"_{others.index(output_col)}")
    rows = filled.select(*named, code.alias("_form"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form = batch.column("_form").to_numpy()
            for k, data, offsets in byte_groups(batch.column(others.index(output_col))):
                texts = binary_array(*unfill(data, offsets, form[k]))
                part = batch.slice(k.start, k.stop - k.start)
                yield part.set_column(len(others), "_form", texts)

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("_form", T.BinaryType())])
    return rows.mapInArrow(gather, schema).toDF(*others, restored)
