"""Gap coding of posting lists: variable-byte (VB) and Elias gamma.

Encoders and decoders are Arrow-batched pandas UDFs that code a whole batch
of segments (at most SEGMENT ids each) with vectorised numpy. The expression
forms (``vb_hex``, ``gamma_bits``, ...) do the same with SQL functions, which
Spark interprets; the tests hold the two against each other.

Format facts (must equal the reference's bytes):

* gaps are first differences with base 0 for a whole list, so the first gap
  is the first doc id; a segment's base is the last id of the previous
  segment of the same term;
* VB: base-128 digits of a gap, most significant first, 128 added to the
  LAST byte of each number (0 -> 80, 127 -> ff, 128 -> 0180);
* gamma: for gap g >= 1 with binary form 1b: |b| ones, one zero, then b
  (1 -> 0, 2 -> 100, 4 -> 11000); the bits of a list are packed into bytes
  with 0-7 zero bits of padding IN FRONT; the pad length is stored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- C1 / C2

def gaps_array(dids, base) -> Column:
    """First differences of a sorted id array, starting from ``base``."""
    d = _c(dids)
    b = _c(base)
    return F.transform(d, lambda x, i: x - F.when(i == 0, b).otherwise(F.element_at(d, i)))


def ungap_array(gaps, base) -> Column:
    """Running sum of gaps plus ``base`` (inverse of ``gaps_array``).
    Quadratic in the segment length, which is bounded by SEGMENT."""
    g = _c(gaps)
    b = _c(base)
    return F.transform(g, lambda x, i: b + F.aggregate(F.slice(g, 1, i + 1), F.lit(0).cast("bigint"),
                                                       lambda acc, y: acc + y))


# ---------------------------------------------------------------- C3 VB

def _hex2(n: Column) -> Column:
    return F.lpad(F.lower(F.hex(n)), 2, "0")


def vb_hex_number(g: Column) -> Column:
    """VB bytes of one number as lower-case hex, exact for every
    non-negative bigint. One- and two-byte numbers (the common case) take a
    direct expression; longer ones enumerate their (bits - 1) div 7 + 1
    digits."""
    one = _hex2(g + F.lit(128))
    two = F.concat(_hex2(F.shiftright(g, 7)), _hex2(g.bitwiseAND(F.lit(127)) + F.lit(128)))
    return F.when(g < F.lit(128), one).when(g < F.lit(16384), two).otherwise(_vb_hex_long(g))


def _vb_hex_long(g: Column) -> Column:
    ndig = F.floor((F.length(F.bin(g)) - 1) / 7).cast("int") + 1
    digits = F.sequence(ndig - 1, F.lit(0), F.lit(-1))
    return F.array_join(
        F.transform(
            digits,
            lambda j: _hex2(
                F.call_function("shiftright", g, j * 7).bitwiseAND(F.lit(127))
                + F.when(j == 0, F.lit(128)).otherwise(F.lit(0))
            ),
        ),
        "",
    )


def vb_hex(gaps) -> Column:
    """VB encoding of a gap array as one hex string."""
    return F.array_join(F.transform(_c(gaps), vb_hex_number), "")


# ---------------------------------------------------------------- C5 gamma

def gamma_bits_number(g: Column) -> Column:
    """Gamma code of one gap (>= 1) as a '0'/'1' string."""
    b = F.bin(g)
    off = F.substring(b, 2, 1 << 20)
    return F.concat(F.repeat(F.lit("1"), F.length(b) - 1), F.lit("0"), off)


def gamma_bits(gaps) -> Column:
    """Concatenated gamma codes of a gap array (before padding)."""
    return F.array_join(F.transform(_c(gaps), gamma_bits_number), "")


def gamma_pad(bits) -> Column:
    """Number of zero bits put in front so the length is a multiple of 8."""
    return F.pmod(F.lit(8) - F.pmod(F.length(_c(bits)), F.lit(8)), F.lit(8))


def bits_to_hex(bits, pad) -> Column:
    """Pad in front, then every 8 bits -> one byte, as lower-case hex.
    Converted 32 bits (8 hex digits) at a time."""
    padded = F.concat(F.repeat(F.lit("0"), _c(pad)), _c(bits))
    nbits = F.length(padded)
    idx = F.sequence(F.lit(0), F.floor((nbits - 1) / 32).cast("int"))

    def chunk(i: Column) -> Column:
        width = F.least(F.lit(32), nbits - i * 32)
        return F.lpad(F.lower(F.conv(F.substring(padded, i * 32 + 1, 32), 2, 16)), (width / 4).cast("int"), "0")

    return F.when(nbits == 0, F.lit("")).otherwise(F.array_join(F.transform(idx, chunk), ""))


# ---------------------------------------------------------------- batch encoders

def _flat(lists: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a batch of lists, and the numbers per list."""
    counts = np.fromiter((len(x) for x in lists), np.int64, len(lists))
    flat = np.concatenate([np.asarray(x, np.int64) for x in lists]) if counts.sum() else np.zeros(0, np.int64)
    return flat, counts


def _batch_gaps(ids: np.ndarray, counts: np.ndarray, base: np.ndarray) -> np.ndarray:
    """First differences inside each list; the first id against its base."""
    gaps = np.diff(ids, prepend=0)
    full = counts > 0
    first = (np.cumsum(counts) - counts)[full]
    gaps[first] = ids[first] - base[full]
    return gaps


def _cut(data: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    raw, ends = data.astype(np.uint8).tobytes(), np.cumsum(sizes)
    return [raw[e - n:e] for e, n in zip(ends.tolist(), sizes.tolist())]


def _per_list(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``x`` over each list."""
    run = np.concatenate(([0], np.cumsum(x)))
    ends = np.cumsum(counts)
    return run[ends] - run[ends - counts]


def _log2(g: np.ndarray) -> np.ndarray:
    """floor(log2(g)) for g >= 1, exact for every bigint."""
    b = np.minimum(np.frexp(g.astype(np.float64))[1].astype(np.int64) - 1, 62)
    return b - ((np.int64(1) << b) > g)


def _within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For parts of the given sizes: owner and position of every element."""
    own = np.repeat(np.arange(len(sizes)), sizes)
    return own, np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _vb(gaps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all lists, bytes per list)."""
    if (gaps < 0).any():
        raise ValueError("VB codes numbers from 0 up")
    digits = _log2(np.maximum(gaps, 1)) // 7 + 1
    own, pos = _within(digits)
    place = digits[own] - 1 - pos
    data = ((gaps[own] >> (7 * place)) & 127) + 128 * (place == 0)
    return data.astype(np.uint8), _per_list(digits, counts)


def vb_encode_batch(gaps: np.ndarray, counts: np.ndarray) -> list[bytes]:
    return _cut(*_vb(gaps, counts))


def gamma_encode_batch(gaps: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(bytes, pad) of each list."""
    data, sizes, pad = _gamma(gaps, counts)
    return _cut(data, sizes), pad


def _gamma(gaps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all lists, bytes per list, pads); every list starts on a byte,
    its pad in front."""
    if (gaps < 1).any():
        raise ValueError("gamma codes numbers from 1 up")
    b = _log2(np.maximum(gaps, 1))
    bits = _per_list(2 * b + 1, counts)
    pad = -bits % 8
    own, pos = _within(2 * b + 1)
    low = 2 * b[own] - pos  # place of an offset bit
    value = np.where(pos < b[own], 1, np.where(pos == b[own], 0, (gaps[own] >> np.maximum(low, 0)) & 1))
    of_list = np.repeat(np.repeat(np.arange(len(counts)), counts), 2 * b + 1)
    out = np.zeros(int((bits + pad).sum()), np.uint8)
    out[np.arange(len(value)) + np.cumsum(pad)[of_list]] = value
    return np.packbits(out), (bits + pad) // 8, pad


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _encoded(b: pa.RecordBatch, ids: np.ndarray, gaps: np.ndarray, counts: np.ndarray, vb: pa.Array) -> pa.RecordBatch:
    data, sizes, pad = _gamma(gaps, counts)
    ends = np.cumsum(counts)
    return pa.RecordBatch.from_arrays(
        [b.column("term_id"), b.column("seg"), b.column("base"), pa.array(counts), pa.array(ids[ends - counts]), pa.array(ids[ends - 1]),
         vb, _binary(data, sizes), pa.array(pad.astype(np.int32))],
        names=["term_id", "seg", "base", "n", "first", "last", "vb", "gamma", "gamma_pad"])


def encode_batches(batches):
    """C1 + C3 + C5 as a mapInArrow function: (term_id, seg, base, dids) to
    (term_id, seg, base, n, first, last, vb, gamma, gamma_pad), without a Python
    object per list. Lists aren't empty."""
    for b in batches:
        lists = b.column("dids")
        counts = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        ids = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64)
        gaps = _batch_gaps(ids, counts, b.column("base").to_numpy(zero_copy_only=False))
        yield _encoded(b, ids, gaps, counts, _binary(*_vb(gaps, counts)))


def recode_batches(batches):
    """As ``encode_batches``, from lists in their VB code: (term_id, seg, base, vb)."""
    for b in batches:
        gaps, counts = _vb_column(b)
        yield _encoded(b, _ids(gaps, counts, _numbers(b.column("base"))), gaps, counts, b.column("vb").cast(pa.binary()))


@F.pandas_udf(BinaryType())
def vb_encode_gaps(gaps: pd.Series) -> pd.Series:
    """C3 of each gap list."""
    return pd.Series(vb_encode_batch(*_flat(gaps)), dtype=object)


# ---------------------------------------------------------------- C4 / C6 decoders

def _ids(gaps: np.ndarray, counts: np.ndarray, base: np.ndarray) -> np.ndarray:
    """C2 for a whole batch: one running sum, restarted at each list's base."""
    run = np.cumsum(gaps)
    starts = np.cumsum(counts) - counts
    before = np.where(starts > 0, run[np.maximum(starts - 1, 0)], 0) if len(run) else np.zeros(len(counts), np.int64)
    return run + np.repeat(base - before, counts)


def _vb_decode_batch(a: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all lists, numbers per list) from the bytes of all lists:
    every byte >= 128 ends a number, digits are summed with their place value."""
    ends = np.flatnonzero(a >= 128)
    if not len(ends):
        return np.zeros(0, np.int64), np.zeros(len(lens), np.int64)
    starts = np.concatenate(([0], ends[:-1] + 1))
    place = np.repeat(ends, ends - starts + 1) - np.arange(ends[-1] + 1)
    vals = np.add.reduceat(np.left_shift(a[:ends[-1] + 1].astype(np.int64) & 127, 7 * place), starts)
    stops = np.cumsum(lens)
    return vals, np.diff(np.concatenate(([0], np.searchsorted(ends, stops - 1, side="right"))))


@F.pandas_udf(ArrayType(LongType()))
def vb_decode_ids(buf: pd.Series, base: pd.Series) -> pd.Series:
    """C4 + C2: VB bytes of one segment -> its doc ids (base + running sum)."""
    lens = np.fromiter((len(b) for b in buf), dtype=np.int64, count=len(buf))
    gaps, counts = _vb_decode_batch(np.frombuffer(b"".join(buf), np.uint8), lens)
    return pd.Series(np.split(_ids(gaps, counts, base.to_numpy(dtype=np.int64)), np.cumsum(counts)[:-1]))


def _gamma_decode_batch(data: np.ndarray, lens: np.ndarray, pads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decode the gamma bit strings of many segments at once.

    Returns (values, counts): all gaps in segment order and the number of
    gaps per segment. Every step decodes the next code of every segment that
    still has bits, so the Python loop runs once per code position (at most
    the segment width), not once per number."""
    n = len(lens)
    if n == 0 or lens.sum() == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(n, dtype=np.int64)
    bits = np.unpackbits(data)
    ends = np.cumsum(lens) * 8
    pos = ends - lens * 8 + np.asarray(pads, dtype=np.int64)
    # run of ones starting at every bit: distance to the next zero
    size = bits.size
    idx = np.arange(size + 1, dtype=np.int64)
    zero_at = np.where(np.concatenate((bits, [0])) == 0, idx, size + 1)
    next_zero = np.minimum.accumulate(zero_at[::-1])[::-1]
    ones = next_zero[:-1] - idx[:-1]
    padded = np.concatenate((bits, np.zeros(64, dtype=np.uint8))).astype(np.int64)
    cols, rows = [], []
    active = np.flatnonzero(pos < ends)
    while active.size:
        p = pos[active]
        k = ones[p]
        start = p + k + 1
        val = np.ones(active.size, dtype=np.int64)
        for j in range(int(k.max())):
            take = j < k
            val = np.where(take, (val << 1) | padded[start + j], val)
        cols.append(val)
        rows.append(active)
        pos[active] = start + k
        active = active[pos[active] < ends[active]]
    seg = np.concatenate(rows)
    vals = np.concatenate(cols)
    order = np.argsort(seg, kind="stable")   # stable: keeps code order inside a segment
    return vals[order], np.bincount(seg, minlength=n).astype(np.int64)


@F.pandas_udf(ArrayType(LongType()))
def gamma_decode_ids(buf: pd.Series, pad: pd.Series, base: pd.Series) -> pd.Series:
    """C6 + C2: gamma bytes of one segment (with its front pad) -> doc ids."""
    lens = np.fromiter((len(b) for b in buf), dtype=np.int64, count=len(buf))
    gaps, counts = _gamma_decode_batch(np.frombuffer(b"".join(buf), np.uint8), lens, pad.to_numpy(dtype=np.int64))
    return pd.Series(np.split(_ids(gaps, counts, base.to_numpy(dtype=np.int64)), np.cumsum(counts)[:-1]))


# ---------------------------------------------------------------- whole batches

def _raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, bytes per value) of a binary column."""
    col = col.cast(pa.binary())
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    return data[off[0]:off[-1]], np.diff(off)


def _numbers(col: pa.Array) -> np.ndarray:
    return np.asarray(col.to_numpy(zero_copy_only=False), np.int64)


def _vb_column(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return _vb_decode_batch(*_raw(b.column("vb")))


def _gamma_column(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return _gamma_decode_batch(*_raw(b.column("gamma")), _numbers(b.column("gamma_pad")))


def _gap_column(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return _numbers(b.column("gaps").flatten()), _numbers(b.column("gaps").value_lengths())


# how each stored form gives its gaps; with the column(s) it is read from
FORMS = {"vb": (_vb_column, ["vb"]), "gamma": (_gamma_column, ["gamma", "gamma_pad"]), "gaps": (_gap_column, ["gaps"])}


def _changes(col: pa.Array) -> np.ndarray:
    """Where a value differs from the one before (the first one does)."""
    codes = pc.fill_null(col.dictionary_encode().indices, -1).to_numpy()
    return np.concatenate(([True], codes[1:] != codes[:-1]))


PIECE = 1 << 20  # ids of coded runs that are decoded at once
ROWS = 1 << 16   # decoded rows handed on at once


def _runs(ids: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    """(first, n, vb) of each run of ascending ids: the gaps from its first id, VB coded."""
    counts = np.diff(np.append(starts, len(ids)))
    gaps = np.diff(ids, prepend=0)
    gaps[starts] = 0
    return [pa.array(ids[starts]), pa.array(counts), _binary(*_vb(gaps, counts))]


def _run_pieces(b: pa.RecordBatch):
    """A batch of runs, cut where more than ``PIECE`` ids come together."""
    ends, at = np.cumsum(_numbers(b.column("n"))), 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, PIECE + (ends[at - 1] if at else 0), side="right")))
        yield b.slice(at, end - at)
        at = end


def _run_ids(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all runs, ids per run)."""
    gaps, counts = _vb_column(b)
    return _ids(gaps, counts, _numbers(b.column("first"))), counts


def run_batches(names: list[str]):
    """mapInArrow: rows (names..., did) to runs (names..., first, n, vb): the ids that
    a batch has under the same names, in order. Runs are what is shuffled and sorted."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            rows = pa.Table.from_batches([b]).sort_by([(c, "ascending") for c in [*names, "did"]])
            cols = [rows.column(c).combine_chunks() for c in names]
            starts = np.flatnonzero(np.logical_or.reduce([_changes(c) for c in cols]))
            at = pa.array(starts)
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in cols), *_runs(rows.column("did").to_numpy(), starts)],
                                             names=[*names, "first", "n", "vb"])

    return run


def run_rows(batches):
    """mapInArrow: runs (term_id, first, n, vb) to (term_id, did), in the runs' order."""
    for b in batches:
        for piece in _run_pieces(b):
            ids, counts = _run_ids(piece)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(_numbers(piece.column("term_id")), counts)), pa.array(ids)],
                                             names=["term_id", "did"])


def _sorted_rows(batches, names: list[str]):
    """Runs (names..., first, n, vb), sorted by the names, to rows (names..., did) sorted
    by (names, did). The runs of the last names wait, coded, for those of the next piece."""

    def rows(runs: pa.RecordBatch, new: np.ndarray):
        ids, counts = _run_ids(runs)
        own = np.repeat(np.arange(len(counts)), counts)
        group = np.cumsum(new)[own]
        if ((ids[1:] < ids[:-1]) & (group[1:] == group[:-1])).any():
            order = np.lexsort((ids, group))
            ids, own = ids[order], own[order]
        for k in range(0, len(ids), ROWS):
            at = pa.array(own[k:k + ROWS])
            yield pa.RecordBatch.from_arrays([*(runs.column(c).take(at) for c in names), pa.array(ids[k:k + ROWS])], names=[*names, "did"])

    held = None
    for b in batches:
        for piece in _run_pieces(b):
            runs = piece if held is None else pa.Table.from_batches([held, piece]).combine_chunks().to_batches()[0]
            new = np.logical_or.reduce([_changes(runs.column(c)) for c in names])
            last = int(np.flatnonzero(new)[-1])
            held = runs.slice(last)
            if last:
                yield from rows(runs.slice(0, last), new[:last])
    if held is not None:
        yield from rows(held, np.arange(held.num_rows) == 0)


def segment_batches(keys: list[str], width: int):
    """mapInArrow: runs (keys..., _hi, first, n, vb), sorted by (keys, _hi), to one row per
    (keys, seg): (keys..., _hi, seg, _prev, _last, dids), ``_prev`` being the id before
    the list in its (keys, _hi), if there is one. A list that reaches a batch's end
    waits for the next batch."""

    def lists(rows: pa.Table, prev: int | None, done: bool):
        did, hi = (rows.column(c).combine_chunks() for c in ("did", "_hi"))
        ids = did.to_numpy()
        seg = np.trunc((ids - 1) / width).astype(np.int64) if ids.min() < 1 else (ids - 1) // width  # as ``seg_of``
        groups = np.logical_or.reduce([_changes(c) for c in (*(rows.column(k).combine_chunks() for k in keys), hi)])
        new = groups.copy()
        new[1:] |= seg[1:] != seg[:-1]
        starts = np.flatnonzero(new)
        n = len(starts) if done else len(starts) - 1  # lists that are complete
        ends = np.append(starts[1:], len(ids))
        first = groups[starts]
        before = np.where(first, 0, ids[starts - 1])
        if prev is not None:  # the first row goes on with a group
            first[0], before[0] = False, prev
        at = pa.array(starts[:n])
        out = pa.RecordBatch.from_arrays(
            [*(rows.column(k).combine_chunks().take(at) for k in keys), hi.take(at), pa.array(seg[starts[:n]]),
             pa.array(before[:n], mask=first[:n]), pa.array(ids[ends[:n] - 1]),
             pa.ListArray.from_arrays(pa.array(np.append(starts[:n], ends[n - 1] if n else 0).astype(np.int32)), pa.array(ids))],
            names=[*keys, "_hi", "seg", "_prev", "_last", "dids"])
        return out, rows.slice(starts[n]) if n < len(starts) else None, None if n == len(starts) or first[n] else int(before[n])

    def run(batches):
        held, prev = None, None
        for b in _sorted_rows(batches, [*keys, "_hi"]):
            new = pa.Table.from_batches([b])
            out, held, prev = lists(new if held is None else pa.concat_tables([held, new]), prev, False)
            if out.num_rows:
                yield out
        if held is not None:
            yield lists(held, prev, True)[0]

    return run


def invert_batches(batches):
    """mapInArrow: (did, terms) to runs (token, first, n, vb), a token once per batch."""
    for b in batches:
        terms = b.column("terms")
        token = pc.list_flatten(terms).dictionary_encode()
        if not len(token):
            continue
        code = token.indices.to_numpy()
        ids = b.column("did").to_numpy()[pc.list_parent_indices(terms).to_numpy()]
        counts = np.bincount(code, minlength=len(token.dictionary))
        runs = _runs(ids[np.lexsort((ids, code))], np.cumsum(counts) - counts)
        yield pa.RecordBatch.from_arrays([token.dictionary, *runs], names=["token", "first", "n", "vb"])


def id_batches(form: str):
    """C4 or C6 and C2 as a mapInArrow function: lists of gaps in that form to
    (term_id, did) rows, without a Python object per list."""
    read = FORMS[form][0]

    def run(batches):
        for b in batches:
            gaps, counts = read(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(_numbers(b.column("term_id")), counts)),
                                              pa.array(_ids(gaps, counts, _numbers(b.column("base"))))], names=["term_id", "did"])

    return run


def list_batches(form: str):
    """As ``id_batches``, but one row per list: (term_id, seg, dids)."""
    read = FORMS[form][0]

    def run(batches):
        for b in batches:
            gaps, counts = read(b)
            ends = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            ids = pa.ListArray.from_arrays(ends, pa.array(_ids(gaps, counts, _numbers(b.column("base")))))
            yield pa.RecordBatch.from_arrays([b.column("term_id"), b.column("seg"), ids], names=["term_id", "seg", "dids"])

    return run


# ---------------------------------------------------------------- merging coded lists

def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the pieces [start, start + size), one piece after another."""
    own, pos = _within(sizes)
    return starts[own] + pos


def _paste(pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]], lists: np.ndarray, front: np.ndarray) -> np.ndarray:
    """Pieces (data, start, size) of every part, joined per list: part after part,
    within a part in the given order, each list behind ``front`` zeros."""
    per_part = sum(size for _, _, size in pieces)
    shift = np.cumsum(front)[np.repeat(np.arange(len(lists)), lists)]
    at = np.cumsum(per_part) - per_part + shift
    out = np.zeros(int(per_part.sum() + front.sum()), np.uint8)
    for data, start, size in pieces:
        out[_spread(at, size)] = data[_spread(start, size)]
        at = at + size
    return out


def merge_batches(batches):
    """A4 on coded lists, as a mapInArrow function. Rows are the parts' lists, sorted by
    (term_id, first), where a list reaching a batch's end waits for the next batch;
    ``_hi_prev`` is the last id of the groups before, if there are any. Only the first
    gap of a part is coded anew; what follows is copied, VB by bytes, gamma by bits
    behind the new pad."""
    held, prev = None, None  # prev: (term_id, _hi, last) before the held rows
    for b in batches:
        if not b.num_rows:
            continue
        rows = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        starts = np.flatnonzero(_list_starts(rows))
        held = rows.slice(int(starts[-1]))
        if starts[-1]:
            out = rows.slice(0, int(starts[-1]))
            yield _merged(out, prev)
            prev = tuple(out.column(c)[-1].as_py() for c in ("term_id", "_hi", "last"))
    if held is not None:
        yield _merged(held, prev)


def _list_starts(b: pa.RecordBatch) -> np.ndarray:
    term, seg = (_numbers(b.column(c)) for c in ("term_id", "seg"))
    return np.concatenate(([True], (term[1:] != term[:-1]) | (seg[1:] != seg[:-1])))


def _merged(b: pa.RecordBatch, prev: tuple | None) -> pa.RecordBatch:
    """Whole lists' parts joined; ``prev``: (term_id, _hi, last) of the row before them."""
    term, seg, hi, first, last, n = (_numbers(b.column(c)) for c in ("term_id", "seg", "_hi", "first", "last", "n"))
    starts = np.flatnonzero(_list_starts(b))
    lists = np.diff(np.append(starts, len(term)))
    ends = np.cumsum(lists)
    base = np.concatenate(([0], last[:-1]))
    new = np.concatenate(([True], (term[1:] != term[:-1]) | (hi[1:] != hi[:-1])))
    base[new] = _numbers(b.column("_hi_prev").fill_null(0))[new]
    if prev is not None and prev[:2] == (term[0], hi[0]):
        base[0] = prev[2]
    ones = np.ones(len(first), np.int64)
    # VB: the bytes after the first that ends a number
    data, lens = _raw(b.column("vb"))
    begin = np.cumsum(lens) - lens
    stops = np.flatnonzero(data >= 128)
    cut = stops[np.searchsorted(stops, begin)] + 1 - begin
    code, size = _vb(first - base, ones)
    vb = _paste([(code, np.cumsum(size) - size, size), (data, begin + cut, lens - cut)], lists, np.zeros(len(lists), np.int64))
    vb_sizes = _per_list(size + lens - cut, lists)
    # gamma: the bits after the pad and the first code
    data, lens = _raw(b.column("gamma"))
    bits = np.unpackbits(data)
    begin = 8 * (np.cumsum(lens) - lens) + _numbers(b.column("gamma_pad"))
    zeros = np.flatnonzero(bits == 0)
    cut = 2 * (zeros[np.searchsorted(zeros, begin)] - begin) + 1
    rest = 8 * np.cumsum(lens) - begin - cut
    code, size, pad = _gamma(first - base, ones)
    code_bits = np.unpackbits(code)
    size_bits = 8 * size - pad
    total = _per_list(size_bits + rest, lists)
    front = -total % 8
    gamma = _paste([(code_bits, 8 * (np.cumsum(size) - size) + pad, size_bits), (bits, begin + cut, rest)], lists, front)
    return pa.RecordBatch.from_arrays(
        [pa.array(term[starts]), pa.array(seg[starts]), pa.array(base[starts]), pa.array(_per_list(n, lists)), pa.array(first[starts]),
         pa.array(last[ends - 1]), _binary(vb, vb_sizes), _binary(np.packbits(gamma), (total + front) // 8), pa.array(front.astype(np.int32))],
        names=["term_id", "seg", "base", "n", "first", "last", "vb", "gamma", "gamma_pad"])
