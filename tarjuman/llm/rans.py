"""Static range asymmetric numeral coding of token ids, many interleaved lanes at a time.

A block's ids are dealt round-robin to ``LANES`` lanes, each a 64-bit rANS state with a
word stream of its own. Payload, little-endian: number of ids and of lanes (u32 each),
crc32 of the ids as u32 (u32), words per lane (u32 each), end states (u64 each), words
(u32), lane after lane. States and stream lengths are the checkpoints from which lanes
decode independently. The frequency table is shared by all blocks.
"""

import zlib

import numpy as np

PRECISION = 20
LANES = 64
FLOOR = np.uint64(1 << 31)
_WORD = np.uint64(32)
_P = np.uint64(PRECISION)


class Table:
    """Frequencies of ids, scaled to sum to 2**PRECISION; every counted id keeps at least 1."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        ids, counts = np.asarray(ids, np.int64)[order], np.asarray(counts, np.int64)[order]
        if len(ids) > 1 << (PRECISION - 1):
            raise ValueError(f"{len(ids)} ids are too many for {PRECISION} bits")
        size = 1 << PRECISION
        scaled = np.maximum(1, (counts.astype(float) / max(counts.sum(), 1) * size).astype(np.int64))
        # What rounding added or left goes from or to the most frequent ids.
        while (extra := int(scaled.sum()) - size) != 0 and len(ids):
            largest = int(scaled.argmax())
            scaled[largest] -= min(extra, int(scaled[largest]) // 2) if extra > 0 else extra
        self.ids = ids
        self.freq = np.zeros(int(ids.max(initial=0)) + 1, np.uint64)
        self.freq[ids] = scaled
        self.start = np.zeros_like(self.freq)
        self.start[ids] = np.concatenate([[0], np.cumsum(scaled)[:-1]]) if len(ids) else 0
        self.symbol = np.repeat(ids, scaled).astype(np.uint32)
        self.most = int(ids[scaled.argmax()]) if len(ids) else 0


def encode(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    """The payload of each block of ids."""
    if not blocks:
        return []
    steps = np.array([-(-len(b) // LANES) for b in blocks])
    order = np.argsort(-steps, kind="stable")
    most = int(steps.max(initial=0))
    symbols = np.full((most, len(blocks), LANES), table.most, np.uint32)
    for row, b in enumerate(order):
        padded = np.full(steps[b] * LANES, table.most, np.uint32)
        padded[:len(blocks[b])] = blocks[b]
        symbols[:steps[b], row] = padded.reshape(-1, LANES)
    active = np.searchsorted(-steps[order], -np.arange(most), side="left")
    states = np.full((len(blocks), LANES), FLOOR, np.uint64)
    words = np.zeros(symbols.shape, np.uint32)
    spilled = np.zeros(symbols.shape, bool)
    for t in range(most - 1, -1, -1):
        n = active[t]
        s, x = symbols[t, :n], states[:n]
        f = table.freq[s]
        full = x >= f << np.uint64(63 - PRECISION)
        words[t, :n] = x & np.uint64(0xFFFFFFFF)
        spilled[t, :n] = full
        x = np.where(full, x >> _WORD, x)
        q = x // f
        states[:n] = (q << _P) + (x - q * f) + table.start[s]
    payloads: list[bytes] = [b""] * len(blocks)
    for row, b in enumerate(order):
        kept = spilled[:steps[b], row].T
        ids = np.ascontiguousarray(blocks[b], "<u4")
        head = np.array([len(ids), LANES, zlib.crc32(ids.tobytes())], "<u4")
        payloads[b] = b"".join((
            head.tobytes(), kept.sum(axis=1).astype("<u4").tobytes(), states[row].astype("<u8").tobytes(),
            words[:steps[b], row].T[kept].astype("<u4").tobytes(),
        ))
    return payloads


def decode(payloads: list[bytes], table: Table) -> list[np.ndarray]:
    """The ids of each block; raises if a checksum or an end state is wrong."""
    if not payloads:
        return []
    heads = [np.frombuffer(p, "<u4", 3) for p in payloads]
    sizes = np.array([int(h[0]) for h in heads])
    lanes = {int(h[1]) for h in heads}
    if len(lanes) != 1:
        raise ValueError("blocks of different numbers of lanes")
    lanes = lanes.pop()
    steps = -(-sizes // lanes)
    order = np.argsort(-steps, kind="stable")
    streams, places, base = [], np.zeros((len(payloads), lanes), np.int64), 0
    states = np.zeros((len(payloads), lanes), np.uint64)
    for row, b in enumerate(order):
        counts = np.frombuffer(payloads[b], "<u4", lanes, 12).astype(np.int64)
        states[row] = np.frombuffer(payloads[b], "<u8", lanes, 12 + 4 * lanes)
        places[row] = base + np.concatenate([[0], np.cumsum(counts)[:-1]])
        streams.append(np.frombuffer(payloads[b], "<u4", -1, 12 + 12 * lanes))
        base += len(streams[-1])
    stream = np.concatenate([*streams, np.zeros(1, np.uint32)]).astype(np.uint64)
    active = np.searchsorted(-steps[order], -np.arange(int(steps.max(initial=0))), side="left")
    out = np.zeros((len(active), len(payloads), lanes), np.uint32)
    mask = np.uint64((1 << PRECISION) - 1)
    for t, n in enumerate(active):
        x, at = states[:n], places[:n]
        slot = x & mask
        s = table.symbol[slot]
        x = table.freq[s] * (x >> _P) + slot - table.start[s]
        empty = x < FLOOR
        states[:n] = np.where(empty, (x << _WORD) | stream[np.minimum(at, base)], x)
        at += empty
        out[t, :n] = s
    if (states != FLOOR).any():
        raise ValueError("a block does not end in its start state")
    blocks: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(payloads)
    for row, b in enumerate(order):
        blocks[b] = np.ascontiguousarray(out[:steps[b], row].reshape(-1)[:sizes[b]])
        if zlib.crc32(blocks[b].astype("<u4").tobytes()) != int(heads[b][2]):
            raise ValueError("a block's checksum does not match its ids")
    return blocks
