"""Frame splitters (B1, B2).

A frame is a concatenation of variable-length packets; each packet names its
own length.  Price frames are cut over Arrow buffers: all frames of a batch
step from packet to packet together, and since packets lie in a frame without
gaps, the packets' bytes are the frames' bytes under finer offsets; nothing is
copied and the work is linear in packets.  Order frames hold records of one
length, whose offsets are plain arithmetic (a native expression; the walk over
declared lengths is left to frames that are not whole).

Output: one row per packet ``(frame_id, recv_ts, packet_seq, packet,
split_error)``; a non-null ``split_error`` marks the bytes that could not be
cut into a packet (quarantined downstream, D2/D6).  Null and empty frames hold
no packets.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import HEADER_LEN, ORDER_PACKET_LEN

_PART = "array<struct<off:int,len:int,err:string>>"


def _walk(frame_col: str, step_len_sql: str, min_room: int, max_steps_sql: str,
          bad_len_sql: str, stop_sql: str) -> str:
    L = f"length({frame_col})"
    part = "named_struct('off', acc.pos, 'len', {len}, 'err', {err})"
    append = "array_append(acc.parts, " + part + ")"
    return f"""aggregate(
      sequence(0, {max_steps_sql}),
      named_struct('pos', 0, 'done', false, 'parts', CAST(array() AS {_PART})),
      (acc, i) -> CASE
        WHEN acc.done OR acc.pos >= {L} THEN acc
        WHEN {L} - acc.pos < {min_room} THEN named_struct('pos', acc.pos, 'done', true,
             'parts', {append.format(len=f'{L} - acc.pos', err="'short_frame'")})
        WHEN {bad_len_sql} THEN named_struct('pos', acc.pos, 'done', true,
             'parts', {append.format(len=f'{L} - acc.pos', err="'bad_length'")})
        ELSE named_struct('pos', acc.pos + {step_len_sql}, 'done', {stop_sql},
             'parts', {append.format(len=f'least({step_len_sql}, {L} - acc.pos)',
                                     err=f"CASE WHEN {step_len_sql} > {L} - acc.pos THEN 'truncated' END")})
      END).parts"""


def _u8_at(frame_col: str, pos_sql: str) -> str:
    return f"CAST(conv(hex(substring({frame_col}, {pos_sql} + 1, 1)), 16, 10) AS INT)"


def _i16_at(frame_col: str, pos_sql: str) -> str:
    u = (f"CAST(conv(concat(substring(hex(substring({frame_col}, {pos_sql} + 1, 2)), 3, 2), "
         f"substring(hex(substring({frame_col}, {pos_sql} + 1, 2)), 1, 2)), 16, 10) AS INT)")
    return f"(CASE WHEN {u} >= 32768 THEN {u} - 65536 ELSE {u} END)"


def _explode_parts(frames: DataFrame, parts_sql: str, frame_col: str) -> DataFrame:
    return (frames.select("frame_id", "recv_ts", frame_col,
                          F.posexplode(F.expr(parts_sql)).alias("packet_seq", "_p"))
            .select("frame_id", "recv_ts", "packet_seq",
                    F.expr(f"substring({frame_col}, _p.off + 1, _p.len)").alias("packet"),
                    F.col("_p.err").alias("split_error")))


def split_price_frames(frames: DataFrame, frame_col: str = "frame") -> DataFrame:
    """B1: cut by the length byte at offset 9.  A length below the header
    size ends the frame ('bad_length'); fewer than 10 bytes left cannot hold
    the length byte ('short_frame'); a packet running past the end is kept
    as 'truncated'."""
    length_at, shortest, rows_out = 9, HEADER_LEN, 65536

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        reasons = np.array([None, "short_frame", "bad_length", "truncated"], object)
        for batch in batches:
            frame = batch.column(2).cast(pa.large_binary())  # 64-bit offsets for batches of any size
            _, offset_buffer, bytes_buffer = frame.buffers()
            ends = np.frombuffer(offset_buffer, np.int64)[frame.offset:frame.offset + len(frame) + 1]
            if not len(frame) or ends[0] == ends[-1]:
                continue
            data = np.frombuffer(bytes_buffer, np.uint8)
            owner = np.flatnonzero(ends[:-1] < ends[1:])
            at, end = ends[owner], ends[owner + 1]
            owners, starts, errors = [], [], []
            while len(owner):
                room = end - at
                size = data[np.minimum(at + length_at, end - 1)].astype(np.int64)
                error = np.select([room <= length_at, size < shortest, size > room], [1, 2, 3], 0)
                owners.append(owner)
                starts.append(at)
                errors.append(error)
                at = np.where(error == 0, at + size, end)
                more = at < end
                owner, at, end = owner[more], at[more], end[more]
            start = np.concatenate(starts)
            order = np.argsort(start)
            start, owner, error = start[order], np.concatenate(owners)[order], np.concatenate(errors)[order]
            seq = np.arange(len(owner)) - np.searchsorted(owner, owner)
            bounds = np.append(start, ends[-1])
            for lo in range(0, len(owner), rows_out):
                hi = min(lo + rows_out, len(owner))
                cuts = bounds[lo:hi + 1]
                packets = pa.Array.from_buffers(pa.binary(), hi - lo, [
                    None, pa.py_buffer((cuts - cuts[0]).astype(np.int32)), bytes_buffer.slice(cuts[0], cuts[-1] - cuts[0])])
                of = pa.array(owner[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), batch.column(1).take(of), pa.array(seq[lo:hi], pa.int32()), packets,
                     pa.array(reasons[error[lo:hi]], pa.string())],
                    names=["frame_id", "recv_ts", "packet_seq", "packet", "split_error"])

    found = frames.where(F.col(frame_col).isNotNull()).select("frame_id", "recv_ts", frame_col)
    schema = T.StructType([found.schema["frame_id"], found.schema["recv_ts"], T.StructField("packet_seq", T.IntegerType()),
                           T.StructField("packet", T.BinaryType()), T.StructField("split_error", T.StringType())])
    return found.mapInArrow(cut, schema)


def split_order_frames(frames: DataFrame, frame_col: str = "frame") -> DataFrame:
    """B2: walk by the signed 16-bit length at offset 2.  A length that is not
    a whole order packet ends the walk ('bad_length': zero would never
    advance, D6); a packet running past the end is 'truncated'."""
    ln = _i16_at(frame_col, "acc.pos + 2")
    walk = _walk(frame_col, step_len_sql=ln, min_room=4,
                 max_steps_sql=f"CAST(length({frame_col}) DIV {ORDER_PACKET_LEN} AS INT) + 1",
                 bad_len_sql=f"{ln} <> {ORDER_PACKET_LEN}", stop_sql="false")
    # fast path: a whole number of records, each declaring a whole record —
    # offsets by arithmetic, no accumulator
    n = f"CAST(length({frame_col}) DIV {ORDER_PACKET_LEN} AS INT)"
    whole = (f"length({frame_col}) > 0 AND length({frame_col}) % {ORDER_PACKET_LEN} = 0 AND "
             f"forall(sequence(0, {n} - 1), i -> {_i16_at(frame_col, f'i * {ORDER_PACKET_LEN} + 2')} "
             f"= {ORDER_PACKET_LEN})")
    fast = (f"transform(sequence(0, {n} - 1), i -> named_struct('off', i * {ORDER_PACKET_LEN}, "
            f"'len', {ORDER_PACKET_LEN}, 'err', CAST(NULL AS STRING)))")
    parts = f"CASE WHEN {whole} THEN {fast} ELSE {walk} END"
    return _explode_parts(frames.where(F.col(frame_col).isNotNull()), parts, frame_col)
