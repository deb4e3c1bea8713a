"""FLAC media columns (operator 10).

``encode``: 8-bit mono FLAC streams (STREAMINFO with the MD5 of the samples, a SEEKTABLE with a
point for every frame, constant / verbatim / fixed-predictor subframes of orders 0 to 4 and linear
predictors of order 4, whichever seems shortest, with Rice residuals).
``decode``: reads such streams and any mono stream of constant, verbatim, fixed or general
linear-predictor subframes; verifies each header's CRC-8, each frame's CRC-16 and the MD5.

The work on a batch is done for all frames at once in numpy: the encoder by bit positions, the
decoder in lockstep, one sample of every frame a step. Frames are independent, so a frame is
also the unit of seeking: ``pcm_blocks`` gives a row a frame with its sample offset.

Edge cases: null text is empty; the empty payload is padded to 64 zero bytes (constant
subframe); texts of any length are cut into frames of 2048 samples; equal texts give equal
bytes; a damaged stream raises ``FlacError`` in ``decode`` and gives a row with an error and
no samples in ``pcm_blocks``; repeated rows and null ids are kept; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import tune

BLOCK = 2048
RATE = 8000
UNIT = 64
#: Fixed predictors have orders below LINEAR, which stands for the linear one; that has LPC coefficients of PRECISION bits.
LINEAR, LPC, PRECISION = 5, 4, 8


class FlacError(ValueError):
    pass


def crc_table(poly: int, width: int) -> np.ndarray:
    top, mask = 1 << (width - 1), (1 << width) - 1
    out = []
    for b in range(256):
        c = b << (width - 8)
        for _ in range(8):
            c = ((c << 1) ^ poly if c & top else c << 1) & mask
        out.append(c)
    return np.array(out, np.uint32)


CRC8, CRC16 = crc_table(0x07, 8), crc_table(0x8005, 16)
_C8 = CRC8.tolist()


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _C8[c ^ b]
    return c


def crc16_many(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-16 of data[start:end] for every pair, all in lockstep (longest first, so finished ones fall off the end)."""
    order = np.argsort(starts - ends, kind="stable")
    at, size = starts[order].astype(np.int64), (ends - starts)[order]
    crc = np.zeros(len(at), np.uint32)
    live = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
    for i, n in enumerate(live.tolist()):
        c = crc[:n]
        crc[:n] = CRC16[(c >> 8) ^ data[at[:n] + i]] ^ ((c << 8) & 0xFFFF)
    out = np.empty_like(crc)
    out[order] = crc
    return out


def utf8_number(n: int) -> bytes:
    """The coded frame number."""
    if n < 0x80:
        return bytes([n])
    tail = []
    limit = 0x40
    while True:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        limit >>= 1
        if n < limit:
            return bytes([(0xFF << (7 - len(tail))) & 0xFF | n, *reversed(tail)])


def frame_header(number: int, samples: int) -> bytes:
    """Fixed block size stream, sample count in 16 bits, rate and depth (8 bits) stated, mono."""
    h = bytes([0xFF, 0xF8, 0x70 | 0x04, 0x02]) + utf8_number(number) + (samples - 1).to_bytes(2, "big")
    return h + bytes([crc8(h)])


def encode(payloads: list[bytes], block: int = BLOCK) -> list[bytes]:
    """The FLAC stream of each payload; a payload's bytes are unsigned 8-bit samples."""
    if not payloads:
        return []
    data = np.frombuffer(b"".join(payloads), np.uint8)
    samples = data.astype(np.int32) - 128
    sizes = [len(p) for p in payloads]
    starts, counts, owner, number = [], [], [], []
    at = 0
    for k, n in enumerate(sizes):
        for j, s in enumerate(range(0, n, block)):
            starts.append(at + s)
            counts.append(min(block, n - s))
            owner.append(k)
            number.append(j)
        at += n
    bodies = _frames(samples, np.array(starts), np.array(counts), number)
    out: list[bytes] = []
    frames: list[list[bytes]] = [[] for _ in payloads]
    for k, b in zip(owner, bodies):
        frames[k].append(b)
    for p, fs in zip(payloads, frames):
        lens = [len(f) for f in fs]
        info = (min(block, max(len(p), 16)).to_bytes(2, "big") if len(p) < block else block.to_bytes(2, "big")) * 2
        info += min(lens, default=0).to_bytes(3, "big") + max(lens, default=0).to_bytes(3, "big")
        info += (RATE << 44 | 0 << 41 | 7 << 36 | len(p)).to_bytes(8, "big")
        signed = np.frombuffer(p, np.uint8) ^ 0x80
        info += hashlib.md5(signed.tobytes()).digest()
        seek, offset = b"", 0
        for j, n in enumerate(lens):
            seek += (j * block).to_bytes(8, "big") + offset.to_bytes(8, "big") + min(block, len(p) - j * block).to_bytes(2, "big")
            offset += n
        head = b"fLaC" + bytes([0x00]) + len(info).to_bytes(3, "big") + info
        out.append(head + bytes([0x83]) + len(seek).to_bytes(3, "big") + seek + b"".join(fs))
    return out


def predictors(x: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, shift) of each frame's linear predictor: Levinson and Durbin on exact integer autocorrelations, then rounded.

    The newest sample's coefficient comes first. Frames are treated apart, so a frame's predictor doesn't depend on its neighbours.
    """
    r = []
    for lag in range(LPC + 1):
        product = x * np.roll(x, lag)
        for j in range(lag):
            product[starts[counts > j] + j] = 0
        r.append(np.add.reduceat(product, starts, dtype=np.int64).astype(np.float64))
    a, err = np.zeros((LPC, len(starts))), r[0].copy()
    for i in range(LPC):
        acc = r[i + 1] - sum((a[j] * r[i - j] for j in range(i)), np.zeros(len(starts)))
        k = np.divide(acc, err, out=np.zeros_like(acc), where=err > 0)
        a[:i], a[i] = a[:i] - k * a[:i][::-1], k
        err = err * (1 - k * k)
    shift, top = np.zeros(len(starts), np.int32), np.abs(a).max(axis=0)
    for s in range(1, 16):
        shift[top * (1 << s) <= (1 << PRECISION - 1) - 1] = s
    limit = 1 << PRECISION - 1
    return np.clip(np.rint(a * (1 << shift)), -limit, limit - 1).astype(np.int32), shift


def residuals(x: np.ndarray, starts: np.ndarray, counts: np.ndarray, coefficients: np.ndarray, shift: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(order, zigzag residuals) of each predictor, zero at the warm-up samples: fixed ones by repeated differences, then the linear one."""
    for order in range(LINEAR):
        r = x if order == 0 else np.diff(r, prepend=np.int32(0))
        z = (r << 1) ^ (r >> 31)
        for j in range(order):
            z[starts[counts > j] + j] = 0
        yield order, z
    guess = np.zeros(len(x), np.int32)
    for j, c in enumerate(coefficients):
        guess[j + 1 :] += np.repeat(c, counts)[j + 1 :] * x[: len(x) - j - 1]
    r = x - (guess >> np.repeat(shift, counts))
    z = (r << 1) ^ (r >> 31)
    for j in range(LPC):
        z[starts[counts > j] + j] = 0
    yield LPC, z


def _frames(x: np.ndarray, starts: np.ndarray, counts: np.ndarray, number: list[int]) -> list[bytes]:
    """Encode each frame as constant, by one predictor with one Rice parameter, or verbatim, whichever seems shortest."""
    n_frames = len(starts)
    spread = lambda v: np.repeat(v, counts)
    x = x.astype(np.int32)
    coefficients, shift_of = predictors(x, starts, counts)
    # Which predictor: a fixed one's order, or LINEAR for the linear one. -1 verbatim, -2 constant.
    best_bits, best_k, kind = counts * 8.0, np.zeros(n_frames, np.int32), np.full(n_frames, -1)
    z = np.zeros(len(x), np.int32)
    for i, (order, own) in enumerate(residuals(x, starts, counts, coefficients, shift_of)):
        total, n = np.add.reduceat(own, starts, dtype=np.int64), np.maximum(counts - order, 1)
        head = 8 * order + 10 + (9 + LPC * PRECISION if i == LINEAR else 0)
        chosen = np.zeros(n_frames, bool)
        for k in range(1, 9):
            bits = n * (k + 0.5) + total / (1 << k) + head
            better = (bits < best_bits) & (counts > order)
            best_bits[better], best_k[better], kind[better] = bits[better], k, i
            chosen |= better
        if chosen.any():
            z = np.where(spread(chosen), own, z)
    constant = np.maximum.reduceat(x, starts) == np.minimum.reduceat(x, starts)
    kind[constant] = -2
    rice, linear = kind >= 0, kind == LINEAR
    order = np.where(linear, LPC, np.maximum(kind, 0))
    k = np.where(rice, best_k, 0).astype(np.int32)

    # Each sample's code: q zero bits, then `value` in `size` bits. Frames start at bytes of one bit string.
    kind_s, k_s = spread(kind), spread(k)
    q = z >> k_s
    value = (z & ((1 << k_s) - 1)) | (1 << k_s)
    size = k_s + 1
    place = np.arange(len(x)) - spread(starts)
    warm = (kind_s >= 0) & (place < spread(order))
    plain = (kind_s < 0) | warm
    value[plain], size[plain], q[plain] = x[plain] & 0xFF, 8, 0
    rest = kind_s == -2
    rest[starts] = False
    value[rest], size[rest] = 0, 0
    width = q + size
    ends = np.cumsum(width)
    # Before the first residual: precision, shift and coefficients of a linear predictor; coding method, partition order, parameter.
    extra = np.where(rice, 10, 0) + np.where(linear, 9 + LPC * PRECISION, 0)
    frame_bits = np.add.reduceat(width, starts) + extra + 8
    frame_bytes = (frame_bits + 7) // 8
    base = np.cumsum(frame_bytes) - frame_bytes
    shift = base * 8 + 8 + extra - (ends - width)[starts]
    at = ends - size + spread(shift)
    at -= np.where(warm, spread(extra), 0)
    window = value << (24 - (at & 7) - size)
    byte, n_bytes = at >> 3, int(frame_bytes.sum()) + 8
    packed = np.bincount(byte, window >> 16, n_bytes) + np.bincount(byte + 1, window >> 8 & 255, n_bytes) + np.bincount(byte + 2, window & 255, n_bytes)
    packed = packed.astype(np.uint8)
    packed[base] |= np.select([kind == -2, kind == -1, linear], [0, 1, 31 + LPC], 8 + kind).astype(np.uint8) << 1
    between = np.zeros(n_frames, np.int64)
    for bits, n in ((PRECISION - 1, 4), (shift_of, 5), *((c & (1 << PRECISION) - 1, PRECISION) for c in coefficients)):
        between = np.where(linear, between << n | bits, 0)
    between = (between << 10 | k) << 56 - extra
    for j in range(7):
        packed[(base + 1 + order + j)[rice]] |= (between[rice] >> 48 - 8 * j & 255).astype(np.uint8)
    raw = packed.tobytes()

    body = [frame_header(j, n) + raw[f : f + m] for j, n, f, m in zip(number, counts.tolist(), base.tolist(), frame_bytes.tolist())]
    lens = np.array([len(f) for f in body])
    crc = crc16_many(np.frombuffer(b"".join(body), np.uint8), np.cumsum(lens) - lens, np.cumsum(lens))
    return [f + c.to_bytes(2, "big") for f, c in zip(body, crc.tolist())]


def parse(stream: bytes) -> tuple[int, bytes, list[tuple[int, int, int]], int]:
    """(samples, MD5, seek points (sample, offset, samples), place of the first frame) of a stream's metadata."""
    if stream[:4] != b"fLaC":
        raise FlacError("no fLaC marker")
    at, last, points, total, md5 = 4, False, [], None, b""
    while not last:
        if at + 4 > len(stream):
            raise FlacError("metadata ends early")
        kind, n = stream[at], int.from_bytes(stream[at + 1 : at + 4], "big")
        body, at, last = stream[at + 4 : at + 4 + n], at + 4 + n, kind >= 0x80
        if len(body) != n:
            raise FlacError("metadata ends early")
        if kind & 0x7F == 0:
            packed = int.from_bytes(body[10:18], "big")
            if packed >> 41 & 7 or (packed >> 36 & 31) != 7:
                raise FlacError("only mono of 8 bits is read")
            total, md5 = packed & (1 << 36) - 1, body[18:34]
        elif kind & 0x7F == 3:
            points = [(int.from_bytes(body[i : i + 8], "big"), int.from_bytes(body[i + 8 : i + 16], "big"), int.from_bytes(body[i + 16 : i + 18], "big")) for i in range(0, n, 18)]
            points = [p for p in points if p[0] != (1 << 64) - 1]
    if total is None:
        raise FlacError("no STREAMINFO")
    return total, md5, points, at


def header_at(stream: bytes, at: int) -> tuple[int, int, int]:
    """(samples, sample offset's frame number, length of the header) of the frame at ``at``; checks CRC-8."""
    h = stream[at : at + 16]
    if len(h) < 7 or h[0] != 0xFF or h[1] & 0xFE != 0xF8:
        raise FlacError("no frame sync")
    lead = h[4]
    n = 1 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length()
    number = lead if n == 1 else lead & (0x7F >> n)
    for b in h[5 : 4 + n]:
        number = number << 6 | b & 0x3F
    code, p = h[2] >> 4, 4 + n
    if code == 6:
        count, p = h[p] + 1, p + 1
    elif code == 7:
        count, p = int.from_bytes(h[p : p + 2], "big") + 1, p + 2
    elif code == 1:
        count = 192
    elif 2 <= code <= 5:
        count = 576 << (code - 2)
    elif code >= 8:
        count = 256 << (code - 8)
    else:
        raise FlacError("reserved block size")
    p += {12: 1, 13: 2, 14: 2}.get(h[2] & 15, 0)
    if crc8(h[:p]) != h[p]:
        raise FlacError("CRC-8 of a frame header differs")
    return count, number, p + 1


def decode_frames(streams: list[bytes], spots: list[tuple[int, int, int]]) -> list[np.ndarray]:
    """Samples (unsigned bytes) of frames at (stream number, start, end); all in lockstep."""
    if not spots:
        return []
    heads = [header_at(streams[s], a) for s, a, _ in spots]
    joined = np.frombuffer(b"".join(streams[s][a:b] for s, a, b in spots) + bytes(16), np.uint8)
    size = np.array([b - a for _, a, b in spots])
    begin = np.cumsum(size) - size
    crc = crc16_many(joined, begin, begin + size - 2)
    stored = joined[begin + size - 2].astype(np.uint32) << 8 | joined[begin + size - 1]
    if (crc != stored).any():
        raise FlacError("CRC-16 of a frame differs")
    counts = np.array([h[0] for h in heads])
    byte = begin + np.array([h[2] for h in heads])
    kind = (joined[byte] >> 1) & 0x3F
    if (joined[byte] & 0x81).any():
        raise FlacError("padding bit or wasted bits are set")
    n_frames, width = len(spots), int(counts.max())
    out = np.zeros((n_frames, width), np.int32)
    signed = joined.view(np.int8)
    for f in np.flatnonzero(kind == 0).tolist():
        out[f, : counts[f]] = signed[byte[f] + 1]
    for f in np.flatnonzero(kind == 1).tolist():
        out[f, : counts[f]] = signed[byte[f] + 1 : byte[f] + 1 + counts[f]]
    fixed, lpc = (kind >= 8) & (kind <= 12), kind >= 32
    if not ((kind < 2) | fixed | lpc).all():
        raise FlacError("reserved subframe type")
    # The common subframe, with one partition of 4-bit parameters, has a loop of its own; samples come back from all residuals after it.
    order = np.where(lpc, kind - 31, np.where(fixed, kind - 8, 0)).astype(np.int64)
    after = (byte.astype(np.int64) + 1 + order) * 8
    tail = np.concatenate([joined, np.zeros(8, np.uint8)]).astype(np.int64)

    def bits(at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Up to 17 bits at bit places."""
        b = np.minimum(at >> 3, len(joined))
        return (tail[b] << 16 | tail[b + 1] << 8 | tail[b + 2]) >> (24 - (at & 7) - n) & ((1 << n) - 1)

    precision, shift = bits(after, 4) + 1, np.where(lpc, bits(after + 4, 5), 0)
    rice_at = after + np.where(lpc, 9 + order * precision, 0)
    head = bits(rice_at, 10)
    simple = (fixed | lpc) & (head >> 4 == 0) & (head & 15 != 15) & (shift < 16) & (counts > order)
    lot = np.flatnonzero(simple)
    if len(lot):
        _one_partition(joined, lot, order, counts, rice_at, head & 15, out)
        for i in range(int(order[lot].max())):
            w = lot[order[lot] > i]
            out[w, i] = signed[byte[w] + 1 + i]
        first = lot[kind[lot] == 9]
        out[first] = np.cumsum(out[first], axis=1)
        out[first] *= np.arange(width) < counts[first][:, None]
        higher = lot[order[lot] + lpc[lot] > 1]
        if len(higher):
            coef = np.zeros((len(higher), int(order[higher].max())), np.int64)
            for i in range(coef.shape[1]):
                w = np.flatnonzero(lpc[higher] & (order[higher] > i))
                f = higher[w]
                v = bits(after[f] + 9 + i * precision[f], precision[f])
                coef[w, i] = np.where(v >> (precision[f] - 1) & 1, v - (1 << precision[f]), v)
            for o, c in enumerate(FIXED[2:], 2):
                coef[np.flatnonzero(~lpc[higher] & (order[higher] == o))[:, None], np.arange(o)] = c
            _restore(higher, order, counts, coef, shift, out)
    todo = np.flatnonzero((fixed | lpc) & ~simple)
    if len(todo):
        _residuals(joined, todo, kind, counts, byte, out)
    result = (out + 128).astype(np.uint8)
    return [result[f, :n] for f, n in enumerate(counts.tolist())]


#: Leading zeros of a 16-bit number.
ZEROS = np.array([16 - i.bit_length() for i in range(1 << 16)], np.int32)


def _restore(rows: np.ndarray, order: np.ndarray, counts: np.ndarray, coef: np.ndarray, shift: np.ndarray, out: np.ndarray) -> None:
    """Samples from the residuals in ``out``, whose first ``order`` are samples already: every step predicts the next one of each frame."""
    sort = np.argsort(-counts[rows], kind="stable")
    rows, coef = rows[sort], np.ascontiguousarray(coef[sort, ::-1].T)  # oldest sample first
    n, order, shift, top = counts[rows], order[rows], shift[rows], len(coef)
    width = int(n.max())
    left = np.ascontiguousarray(out[rows, :width].T)
    samples = np.zeros((top + width, len(rows)), np.int64)
    for i, m in enumerate(np.searchsorted(-n, -np.arange(width), side="left").tolist()):
        guess = (samples[i : i + top, :m] * coef[:, :m]).sum(axis=0) >> shift[:m]
        if i < top:
            guess[order[:m] > i] = 0
        np.add(guess, left[i, :m], out=samples[top + i, :m])
    out[rows, :width] = samples[top:].T


def _one_partition(data: np.ndarray, lot: np.ndarray, order: np.ndarray, counts: np.ndarray, rice_at: np.ndarray, k: np.ndarray, out: np.ndarray) -> None:
    """Residuals of frames with one Rice partition: every step reads the next code of each unfinished frame."""
    lot = lot[np.argsort(order[lot] - counts[lot], kind="stable")]
    warm = order[lot]
    n = counts[lot] - warm
    cursor = rice_at[lot] + 10
    k = k[lot].astype(np.int32)
    mask = ((1 << k) - 1).astype(np.uint32)
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
    four = wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]
    steps = int(n.max())
    got = np.zeros((steps, len(lot)), np.int32)
    limit, last = len(data) * 8, len(four) - 1
    for i, m in enumerate(np.searchsorted(-n, -np.arange(steps), side="left").tolist()):
        cur = cursor[:m]
        win = four[np.minimum(cur >> 3, last)] << (cur & 7).astype(np.uint32)
        zeros = ZEROS[win >> 16]
        used = zeros + k[:m]
        value = (win >> np.maximum(31 - used, 0).astype(np.uint32) & mask[:m]).astype(np.int32) | zeros << k[:m]
        if int(used.max()) > 23 or int(zeros.max()) == 16:
            for j in np.flatnonzero((used > 23) | (zeros == 16)).tolist():
                value[j], bits = _one(data, int(cur[j]), int(k[j]), -1, limit)
                used[j] = bits - 1
        got[i, :m] = value
        cur += used + 1
    if (cursor > limit).any():
        raise FlacError("residuals end early")
    got = (got >> 1) ^ -(got & 1)
    for w in np.unique(warm).tolist():
        rows = warm == w
        out[lot[rows], w : w + steps] = got[: out.shape[1] - w, rows].T


#: Coefficients of the fixed predictors of order 0 to 4, nearest sample first.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


def _residuals(data: np.ndarray, todo: np.ndarray, kind: np.ndarray, counts: np.ndarray, byte: np.ndarray, out: np.ndarray) -> None:
    """Rice codes in lockstep: every frame has a bit cursor; a 40-bit window at the cursor gives its next code."""
    todo = todo[np.argsort(-counts[todo], kind="stable")]
    n = counts[todo]
    order = np.where(kind[todo] >= 32, kind[todo] - 31, kind[todo] - 8).astype(np.int64)
    top = int(order.max())
    coef = np.zeros((len(todo), top), np.int64)
    shift = np.zeros(len(todo), np.int64)
    padded = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
    # The five bytes from each place as one number: one gather a read instead of five.
    five = padded[:-8] << np.uint64(32)
    for i in range(1, 5):
        five |= padded[i : len(padded) - 8 + i] << np.uint64(8 * (4 - i))

    def window(bit: np.ndarray) -> np.ndarray:
        return (five[bit >> 3] << (bit & 7).astype(np.uint64)) & np.uint64((1 << 40) - 1)

    def read(which: np.ndarray, bits: np.ndarray | int) -> np.ndarray:
        got = window(cursor[which]) >> np.asarray(40 - bits, np.uint64)
        cursor[which] += bits
        return got.astype(np.int64)

    every = np.arange(len(todo))
    cursor = (byte[todo].astype(np.int64) + 1) * 8
    samples = np.zeros((top + int(n.max()), len(todo)), np.int64)  # by sample, so that a step reads rows
    for i in range(top):
        w = every[order > i]
        v = read(w, 8)
        samples[top + i, w] = np.where(v > 127, v - 256, v)
    linear = every[kind[todo] >= 32]
    if len(linear):
        precision = read(linear, 4) + 1
        shift[linear] = read(linear, 5)
        for i in range(top):
            w = linear[order[linear] > i]
            p = precision[order[linear] > i]
            v = read(w, p)
            coef[w, i] = np.where(v >> (p - 1) & 1, v - (1 << p), v)
    for o, c in enumerate(FIXED):
        w = every[(kind[todo] < 32) & (order == o)]
        coef[w[:, None], np.arange(o)] = np.array(c, np.int64) if o else 0
    method = read(every, 2)
    if (method > 1).any():
        raise FlacError("reserved residual coding")
    parts = np.int64(1) << read(every, 4)
    if (n % parts).any():
        raise FlacError("partitions don't divide the block")
    per = n // parts
    bits_k, escape = np.where(method == 0, 4, 5), np.where(method == 0, 15, 31)
    k, raw = np.zeros(len(todo), np.int64), np.full(len(todo), -1)
    fresh = order.copy()  # sample at which a frame's next partition starts
    fresh[:] = order
    live = np.searchsorted(-n, -np.arange(int(n.max())), side="left").tolist()
    same = bool((order == top).all()) and int(parts.max()) == 1
    limit = len(data) * 8
    for i, m in enumerate(live):
        act = every[:m]
        if not same:
            act = act[order[:m] <= i]
        starting = act[(fresh[act] == i)] if (not same or i == top) and len(act) else act[:0]
        if len(starting):
            k[starting] = read(starting, bits_k[starting])
            esc = starting[k[starting] == escape[starting]]
            raw[starting] = -1
            if len(esc):
                raw[esc] = read(esc, np.full(len(esc), 5))
            fresh[starting] = (i // per[starting] + 1) * per[starting]
        if same and i < top or not len(act):
            continue
        cur = cursor[act] if len(act) < len(todo) else cursor
        win = (five[cur >> 3] << (cur & 7).astype(np.uint64)) & np.uint64((1 << 40) - 1)
        # Leading zeros of 40 bits, by the exponent of a float (exact below 2**53).
        zeros = 40 - np.frexp(win.astype(np.float64))[1].astype(np.int64)
        kk = k[act]
        slow = (zeros + 1 + kk > 32) | (raw[act] >= 0)
        value = ((win >> np.maximum(39 - zeros - kk, 0).astype(np.uint64)).astype(np.int64) & ((np.int64(1) << kk) - 1)) | zeros << kk
        step = zeros + 1 + kk
        if slow.any():
            for j in np.flatnonzero(slow).tolist():
                f, p = int(act[j]), int(cur[j])
                value[j], step[j] = _one(data, p, int(k[f]), int(raw[f]), limit)
        cursor[act] += step
        res = value >> 1 ^ -(value & 1)
        if top:
            guess = samples[top + i - 1, act] * coef[act, 0]
            for j in range(1, top):
                guess = guess + samples[top + i - 1 - j, act] * coef[act, j]
            res = res + (guess >> shift[act])
        samples[top + i, act] = res
    if (cursor > limit).any():
        raise FlacError("residuals end early")
    out[todo, : int(n.max())] = samples[top:].T


def _one(data: np.ndarray, p: int, k: int, raw: int, limit: int) -> tuple[int, int]:
    """A code too long for the window, or an escaped sample, bit by bit: (zigzag value, bits)."""
    bit = lambda i: int(data[i >> 3]) >> (7 - (i & 7)) & 1
    start = p
    if raw >= 0:
        v = 0
        for _ in range(raw):
            v, p = v << 1 | bit(p), p + 1
        v = v - (1 << raw) if raw and v >> (raw - 1) else v
        return (-2 * v - 1 if v < 0 else 2 * v), p - start
    while p < limit and not bit(p):
        p += 1
    q, p = p - start, p + 1
    v = 0
    for _ in range(k):
        if p >= limit:
            raise FlacError("residuals end early")
        v, p = v << 1 | bit(p), p + 1
    return q << k | v, p - start


def frame_spots(number: int, stream: bytes) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Places of a stream's frames, by its seek table, and their sample offsets."""
    total, _, points, first = parse(stream)
    if [p[0] for p in points] != sorted({p[0] for p in points}) or sum(p[2] for p in points) != total:
        raise FlacError("the seek table doesn't have every frame")
    edges = [first + p[1] for p in points] + [len(stream)]
    return [(number, a, b) for a, b in zip(edges, edges[1:])], [p[0] for p in points]


def decode_blocks(streams: list[bytes]) -> list[list[tuple[int, np.ndarray]]]:
    """The PCM blocks (sample offset, unsigned samples) of each stream, with every checksum verified."""
    spots, owner, place = [], [], []
    for i, s in enumerate(streams):
        own, offsets = frame_spots(i, s)
        spots += own
        place += offsets
        owner += [i] * len(own)
    out: list[list[tuple[int, np.ndarray]]] = [[] for _ in streams]
    for i, at, x in zip(owner, place, decode_frames(streams, spots)):
        out[i].append((at, x))
    for s, blocks in zip(streams, out):
        total, md5, _, _ = parse(s)
        signed, at = hashlib.md5(), 0
        for offset, x in blocks:
            if offset != at:
                raise FlacError("a frame's length and the seek table differ")
            signed.update((x ^ 0x80).tobytes())
            at += len(x)
        if at != total or signed.digest() != md5:
            raise FlacError("the MD5 of the samples differs")
    return out


def decode(streams: list[bytes]) -> list[bytes]:
    """The samples of each stream."""
    return [b"".join(x.tobytes() for _, x in blocks) for blocks in decode_blocks(streams)]


def features(payload: bytes) -> str:
    """Audio features of the samples: mean and mean square, zero crossings, peak."""
    raw = np.frombuffer(payload, np.uint8)
    negative = raw < 128
    crossings = int(np.count_nonzero(negative[1:] != negative[:-1]))
    count = np.bincount(raw, minlength=256)
    level = np.arange(-128, 128)
    peak = int(np.abs(level[count > 0]).max())
    return f"n={len(raw)};sum={int(count @ level)};energy={int(count @ (level * level))};zc={crossings};peak={peak}"


def padded(text: str | None, unit: int = UNIT) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + bytes((-len(raw)) % unit if raw else unit)


#: Payload bytes that are encoded or decoded at once.
GROUP_BYTES = 3 << 19


def groups(sizes: list[int], most: int = GROUP_BYTES) -> Iterator[range]:
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > most:
            yield range(at, i)
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield range(at, len(sizes))


def to_media(docs: DataFrame, unit: int = UNIT) -> DataFrame:
    """doc_id, n_bytes, media: each text's padded UTF-8 bytes as a FLAC stream."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            made = [padded(t, unit) for t in batch.column(1).to_pylist()]
            for g in groups([len(p) for _, p in made]):
                media = encode([made[i][1] for i in g])
                yield pa.RecordBatch.from_pydict({"doc_id": ids.slice(g.start, len(g)), "n_bytes": pa.array([made[i][0] for i in g], pa.int64()), "media": pa.array(media, pa.binary())})

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def digest(media: DataFrame, unit: int = UNIT) -> DataFrame:
    """Decode each stored stream to PCM blocks and describe what came back; ``block_offsets`` lists each block's first sample."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, block_offsets array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            streams = batch.column(2).to_pylist()
            for g in groups([len(s) for s in streams]):
                own = [streams[i] for i in g]
                blocks = decode_blocks(own)
                back = [b"".join(x.tobytes() for _, x in b) for b in blocks]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(g.start, len(g)),
                        "n_bytes": batch.column(1).slice(g.start, len(g)),
                        "payload_bytes": pa.array([len(p) for p in back], pa.int64()),
                        "payload_sha256": [hashlib.sha256(p).hexdigest() for p in back],
                        "tail_crc32": pa.array([zlib.crc32(p[-unit:]) for p in back], pa.int64()),
                        "media_bytes": pa.array([len(s) for s in own], pa.int64()),
                        "media_sha256": [hashlib.sha256(s).hexdigest() for s in own],
                        "feature": [features(p) for p in back],
                        "block_offsets": pa.array([[at for at, _ in b] for b in blocks], pa.list_(pa.int64())),
                    }
                )

    return media.mapInArrow(run, schema)


def pcm_blocks(media: DataFrame) -> DataFrame:
    """One row a frame: doc_id, block, sample_offset, n_samples, pcm (unsigned 8-bit), error (null if the stream is sound)."""
    schema = "doc_id long, block int, sample_offset long, n_samples int, pcm binary, error string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, s in zip(batch.column(0).to_pylist(), batch.column("media").to_pylist()):
                try:
                    spots, offsets = frame_spots(0, s or b"")
                    rows = [(doc_id, i, o, len(x), x.tobytes(), None) for i, (o, x) in enumerate(zip(offsets, decode_frames([s], spots)))]
                except (FlacError, IndexError) as e:
                    rows = [(doc_id, None, None, None, None, str(e))]
                cols = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.string()))], ["doc_id", "block", "sample_offset", "n_samples", "pcm", "error"])

    return media.mapInArrow(run, schema)


def read_samples(stream: bytes, start: int, count: int) -> bytes:
    """Samples [start, start + count) by seeking: only the frames that hold them are decoded."""
    spots, offsets = frame_spots(0, stream)
    ends = [*offsets[1:], parse(stream)[0]]
    need = [i for i, (a, b) in enumerate(zip(offsets, ends)) if a < start + count and b > start]
    if not need:
        return b""
    x = np.concatenate(decode_frames([stream], [spots[i] for i in need])).tobytes()
    return x[max(0, start - offsets[need[0]]) :][:count]
