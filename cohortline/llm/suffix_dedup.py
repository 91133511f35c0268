"""Removal of byte strings that also start in a document with a smaller id.

Documents are dealt to buckets; a bucket's texts are cut into shards of at most
``SHARD_BYTES``.

1. In a shard, all suffixes are sorted by Larsson-Sadakane refinement (sort by five
   bytes, then double the depth for the groups that are still tied), until the depth
   reaches the match length. Kasai's common prefixes give the runs of suffixes that
   share it; in a run, every start outside the smallest document is marked.
2. Across shards, suffixes meet at anchors: the anchor of a window of the match length
   is its 16-byte string of the smallest hash, so equal windows have equal anchors
   wherever they are. Shards send their sorted anchors, 4 bytes each, to parts by range;
   a part finds by binary search which of them another shard holds too. Only there do
   shards send the text around the anchor, once per shard and string, and parts merge
   these runs: the windows of all shards are sorted once, and each shard's windows are
   found in the merged run by binary search, which gives their smallest document.
3. The marks return to the documents' bucket, where the covered bytes are removed.

What is sent is bounded by the anchors, about one in 18 bytes, and by the text that
shards do share, however often it occurs in one shard. Everything is one plan; the
texts are shuffled once and that exchange is read three times.

Defined results: a null or empty text has no bytes and nothing is removed; rows with one
id never remove from each other; a document of null id neither loses nor causes removal;
a text of fewer bytes than the match length loses nothing; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.textscan import SpanHash, mix, texts_as_bytes

LENGTH = 50
GRAM = 16
BUCKET_BYTES = 2 << 20
PART_BYTES = 2 << 20
# Windows that a part merges at once; those of one anchor stay together.
SLICE_WINDOWS = 1 << 19
INDEX_BITS = 20
SHARD_BYTES = (1 << INDEX_BITS) - 1
_INDEX = np.uint64((1 << INDEX_BITS) - 1)
_SHIFT = np.uint64(INDEX_BITS)


def suffix_ranks(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes sorted to at least ``depth`` bytes, their ranks, and the slots tied before
    the last step, which hold all neighbours that share ``depth`` bytes.

    A rank is the slot of the first suffix of its group. Larsson-Sadakane: groups of one
    are never touched again.
    """
    size = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.arange(size, dtype=np.uint64)
    for k in range(5):
        key |= padded[k : k + size] << np.uint64(INDEX_BITS + 8 * (4 - k))
    key.sort()
    order = (key & _INDEX).astype(np.int64)
    leads = np.append(True, (key[1:] >> _SHIFT) != (key[:-1] >> _SHIFT)) if size else np.zeros(0, bool)
    rank = np.zeros(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(leads, np.arange(size), 0))
    slots = np.flatnonzero(~(leads & np.append(leads[1:], True)))
    reached, tied = 5, slots
    while reached < depth and len(slots):
        tied = slots
        members = order[slots]
        ahead = np.minimum(members + reached, size - 1)
        key = (rank[members].astype(np.uint64) << np.uint64(2 * INDEX_BITS)) | (
            rank[ahead].astype(np.uint64) << _SHIFT
        )
        key |= members.astype(np.uint64)
        key.sort()
        members = (key & _INDEX).astype(np.int64)
        order[slots] = members
        pair = key >> _SHIFT
        leads = np.append(True, pair[1:] != pair[:-1])
        rank[members] = slots[np.maximum.accumulate(np.where(leads, np.arange(len(slots)), 0))]
        slots = slots[~(leads & np.append(leads[1:], True))]
        reached *= 2
    return order, rank, tied


def common_prefixes(data: np.ndarray, order: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Kasai's common prefix of the suffix in each slot with the one before it.

    In text order a suffix shares at least one byte less than the suffix one byte before
    it did. Where both move on together (the same byte before both, and neighbours
    before) it is exactly one less; only the other suffixes are compared, all at once.
    """
    size = len(data)
    before = np.full(size, -1, np.int64)
    inner = slots[slots > 0]
    before[order[inner]] = order[inner - 1]
    here = np.flatnonzero(before >= 0)
    other = before[here]
    follows = np.zeros(len(here), bool)
    chained = (here > 0) & (other > 0)
    follows[chained] = before[here[chained] - 1] == other[chained] - 1
    follows &= (here > 0) & (other > 0) & (data[here - 1] == data[other - 1])
    heads = np.flatnonzero(~follows)
    shared = np.zeros(len(heads), np.int64)
    # Neither suffix is longer than the later one.
    limit = size - np.maximum(here[heads], other[heads])
    active = np.arange(len(heads))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # The eight bytes from each position on, the first in the lowest bits.
    eights = np.ndarray((size + 1,), "<u8", padded, strides=(1,)).copy()
    while len(active):
        at = heads[active]
        differ = eights[here[at] + shared[active]] ^ eights[other[at] + shared[active]]
        lowest = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64) >> 3)
        shared[active] = np.minimum(shared[active] + equal, limit[active])
        active = active[(differ == 0) & (shared[active] < limit[active])]
    head_of = np.maximum.accumulate(np.where(~follows, np.arange(len(here)), 0))
    place = np.cumsum(~follows) - 1
    lengths = np.zeros(size, np.int64)
    lengths[here] = shared[place] - (here - here[head_of])
    return lengths[order[slots]]


class Shard:
    """Pieces of a bucket's texts as one byte array."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, texts: np.ndarray, shifts: np.ndarray, ids: np.ndarray):
        self.data, self.starts, self.texts, self.shifts = data, starts, texts, shifts
        lengths = np.diff(np.append(starts, len(data)))
        self.piece = np.repeat(np.arange(len(starts)), lengths)
        ends = np.repeat(starts + lengths, lengths)
        self.whole = np.arange(len(data)) + LENGTH <= ends
        self.ids = ids

    def id_at(self, positions: np.ndarray) -> np.ndarray:
        return self.ids[self.texts[self.piece[positions]]]

    def place(self, positions: np.ndarray) -> np.ndarray:
        """Byte positions in the texts."""
        piece = self.piece[positions]
        return positions - self.starts[piece] + self.shifts[piece]

    def marked(self) -> np.ndarray:
        """Starts of strings that also start in a smaller document of this shard."""
        marks = np.zeros(len(self.data), bool)
        order, _, slots = suffix_ranks(self.data, LENGTH)
        if not len(slots):
            return marks
        joined = common_prefixes(self.data, order, slots) >= LENGTH
        run = np.cumsum(~joined)
        members = order[slots]
        kept = self.whole[members]
        members, run = members[kept], run[kept]
        if not len(members):
            return marks
        heads = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        ids = self.id_at(members)
        least = np.repeat(np.minimum.reduceat(ids, heads), np.diff(np.append(heads, len(ids))))
        marks[members[ids > least]] = True
        return marks

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor hash and position, and first and last window start, of each stretch."""
        size = len(self.data)
        starts = np.flatnonzero(self.whole)
        if not len(starts):
            return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
        at = np.arange(size - GRAM + 1)
        hashes = SpanHash(self.data)(at, at + GRAM)
        least = (hashes & ~_INDEX) | at.astype(np.uint64)
        span, width = 1, LENGTH - GRAM + 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: -(width - span)], least[width - span :])
        anchor = (least[starts] & _INDEX).astype(np.int64)
        heads = np.append(True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1))
        first = np.flatnonzero(heads)
        last = np.append(first[1:], len(starts)) - 1
        return hashes[anchor[first]], anchor[first], starts[first], starts[last]


def shards_of(texts: pa.Array, ids: pa.Array) -> list[Shard]:
    """A bucket's texts in shards; a long text is cut into pieces that overlap by LENGTH - 1.

    Texts of null id are left out.
    """
    data, offsets = texts_as_bytes(texts)
    known = np.array(ids.is_valid())
    numbers = np.array(ids.fill_null(0)).astype(np.int64)
    step = SHARD_BYTES - LENGTH
    shards, parts, starts, owners, shifts, size = [], [], [], [], [], 0

    def close():
        nonlocal parts, starts, owners, shifts, size
        if parts:
            shards.append(
                Shard(np.concatenate(parts), np.array(starts), np.array(owners), np.array(shifts), numbers)
            )
        parts, starts, owners, shifts, size = [], [], [], [], 0

    for text in np.flatnonzero(known & (np.diff(offsets) >= LENGTH)).tolist():
        low, high = int(offsets[text]), int(offsets[text + 1])
        for shift in range(0, max(1, high - low - LENGTH + 1), step):
            piece = data[low + shift : min(high, low + shift + step + LENGTH - 1)]
            if size + len(piece) > SHARD_BYTES:
                close()
            parts.append(piece)
            starts.append(size)
            owners.append(text)
            shifts.append(shift)
            size += len(piece)
    close()
    return shards


def _anchor_runs(shards: list[Shard], bits: int):
    """Per shard its stretches; the bucket's sorted distinct anchors; those two shards hold."""
    stretches = [shard.anchors() for shard in shards]
    # An anchor is told by its part and 32 more bits; a chance meeting only costs a look.
    codes = [np.unique(hashes >> np.uint64(32 - bits)) for hashes, *_ in stretches]
    every = np.sort(np.concatenate(codes)) if codes else np.zeros(0, np.uint64)
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    return stretches, every[np.append(True, every[1:] != every[:-1])] if len(every) else every, twice


def _send_anchors(bits: int):
    def send(group: pa.Table) -> pa.Table:
        bucket = group["bucket"][0].as_py()
        shards = shards_of(group["text"], group["doc_id"].combine_chunks())
        _, run, _ = _anchor_runs(shards, bits)
        parts = (run >> np.uint64(32)).astype(np.int64)
        heads = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if len(run) else np.zeros(0, np.int64)
        ends = np.append(heads[1:], len(run))
        values = run.astype(np.uint32)
        return pa.table(
            {
                "part": pa.array(parts[heads], pa.int64()),
                "bucket": pa.array(np.full(len(heads), bucket), pa.int64()),
                "run": pa.array([values[a:b].tobytes() for a, b in zip(heads, ends, strict=True)], pa.binary()),
            }
        )

    return send


def _find_shared(group: pa.Table) -> pa.Table:
    """For each bucket's run of anchors, a bit for each that another bucket holds."""
    runs = [np.frombuffer(run.as_py(), np.uint32) for run in group["run"]]
    every = np.sort(np.concatenate(runs))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    bits = []
    for run in runs:
        at = np.searchsorted(twice, run)
        at[at == len(twice)] = 0
        bits.append(np.packbits(twice[at] == run if len(twice) else np.zeros(len(run), bool)).tobytes())
    return pa.table({"part": group["part"], "bucket": group["bucket"], "bits": pa.array(bits, pa.binary())})


def _pack(**arrays: np.ndarray) -> bytes:
    sizes = np.array([len(a) for a in arrays.values()], np.int64)
    return sizes.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays.values())


def _unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    sizes, at, arrays = np.frombuffer(blob, np.int64, len(kinds)), 8 * len(kinds), []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        arrays.append(np.frombuffer(blob, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return arrays


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans of ``data`` one after the other."""
    if not len(starts):
        return data[:0]
    ends = np.cumsum(lengths)
    at = np.arange(int(ends[-1])) - np.repeat(ends - lengths - starts, lengths)
    return data[at]


_MARKS = (np.int64, np.int64, np.int64)
_RECORDS = (np.uint64, np.int64, np.int64, np.int16, np.int16, np.uint8)


def _mark_runs(ids: np.ndarray, places: np.ndarray) -> bytes:
    """Marked starts as (document, first, last) of maximal runs."""
    heads = np.append(True, (ids[1:] != ids[:-1]) | (places[1:] != places[:-1] + 1)) if len(ids) else np.zeros(0, bool)
    first = np.flatnonzero(heads)
    last = np.append(first[1:], len(ids)) - 1 if len(ids) else first
    return _pack(ids=ids[first], first=places[first], last=places[last])


def _send_contexts(bits: int):
    def send(texts: pa.Table, shared: pa.Table) -> pa.Table:
        source = texts if len(texts) else shared
        bucket = source["bucket"][0].as_py()
        shards = shards_of(texts["text"], texts["doc_id"].combine_chunks()) if len(texts) else []
        stretches, run, twice = _anchor_runs(shards, bits)
        flags = np.zeros(len(run), bool)
        parts = (run >> np.uint64(32)).astype(np.int64)
        for part, packed in zip(shared["part"].to_pylist(), shared["bits"].to_pylist(), strict=True):
            low, high = np.searchsorted(parts, [part, part + 1])
            flags[low:high] = np.unpackbits(np.frombuffer(packed, np.uint8))[: high - low]
        wanted = np.union1d(run[flags], twice)
        rows: dict[int, list[list[np.ndarray]]] = {}
        marks: list[tuple[np.ndarray, np.ndarray]] = []
        for shard, (hashes, anchor, low, high) in zip(shards, stretches, strict=True):
            marked = shard.marked()
            at = np.flatnonzero(marked)
            marks.append((shard.id_at(at), shard.place(at)))
            codes = hashes >> np.uint64(32 - bits)
            at = np.searchsorted(wanted, codes)
            at[at == len(wanted)] = 0
            chosen = wanted[at] == codes if len(wanted) else np.zeros(len(codes), bool)
            hashes, anchor, low, high = hashes[chosen], anchor[chosen], low[chosen], high[chosen]
            # Only the windows that this shard has not marked itself are still open.
            open_before = np.concatenate([[0], np.cumsum(~marked)])
            keep = open_before[high + 1] > open_before[low]
            hashes, anchor, low, high = hashes[keep], anchor[keep], low[keep], high[keep]
            if not len(low):
                continue
            part = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            ordered = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.append(True, part[ordered][1:] != part[ordered][:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(ordered)), strict=True):
                rows.setdefault(int(part[ordered[a]]), []).append(
                    [
                        hashes[ordered[a:b]],
                        shard.id_at(low[ordered[a:b]]),
                        shard.place(low[ordered[a:b]]),
                        (anchor - low)[ordered[a:b]].astype(np.int16),
                        (high - low + 1)[ordered[a:b]].astype(np.int16),
                        _gather(shard.data, low[ordered[a:b]], (high - low + LENGTH)[ordered[a:b]]),
                    ]
                )
        parts_out = list(rows)
        blobs = [
            _pack(**{str(k): np.concatenate([one[k] for one in rows[part]]) for k in range(6)}) for part in parts_out
        ]
        own = _mark_runs(*(np.concatenate(column) for column in zip(*marks, strict=True))) if marks else b""
        return pa.table(
            {
                "part": pa.array([*parts_out, bucket % (1 << bits)], pa.int64()),
                "bucket": pa.array([bucket] * (len(blobs) + 1), pa.int64()),
                "records": pa.array([*blobs, None], pa.binary()),
                "marks": pa.array([None] * len(blobs) + [own], pa.binary()),
            }
        )

    return send


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of spans in order of their starts, a few bytes of data at a time."""
    one, two = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        low = int(starts[a])
        b = max(a + 1, int(np.searchsorted(starts, low + (1 << 20))))
        high = int((starts[a:b] + lengths[a:b]).max())
        part = data[low:high]
        at, to = starts[a:b] - low, starts[a:b] + lengths[a:b] - low
        one[a:b], two[a:b] = SpanHash(part)(at, to), SpanHash(part, seed=23)(at, to)
        a = b
    return one, two


def _stretches_by_anchor(anchors: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Stretches in slices of about ``SLICE_WINDOWS`` windows, those of one anchor together."""
    order = np.argsort(anchors, kind="stable")
    heads = np.flatnonzero(np.append(True, anchors[order][1:] != anchors[order][:-1])) if len(order) else order
    before = np.concatenate([[0], np.cumsum(counts[order])])[heads]
    cuts = np.append(True, before[1:] // SLICE_WINDOWS != before[:-1] // SLICE_WINDOWS) if len(heads) else heads
    return np.split(order, heads[np.flatnonzero(cuts)][1:])


def _row_chunks(counts: np.ndarray) -> list[tuple[int, int]]:
    """Neighbouring stretches of about ``SLICE_WINDOWS`` windows together."""
    total = np.cumsum(counts)
    cuts = np.searchsorted(total, np.arange(SLICE_WINDOWS, int(total[-1]), SLICE_WINDOWS)) if len(counts) else []
    cuts = np.unique(np.concatenate([[0], cuts, [len(counts)]])).astype(np.int64).tolist()
    return list(zip(cuts, cuts[1:]))


def _join_runs(ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> bytes:
    """Runs of marked starts, those that follow each other in a document made one."""
    heads = np.append(True, (ids[1:] != ids[:-1]) | (first[1:] != last[:-1] + 1)) if len(ids) else np.zeros(0, bool)
    at = np.flatnonzero(heads)
    return _pack(ids=ids[at], first=first[at], last=last[np.append(at[1:], len(ids)) - 1] if len(at) else last)


def merge_records(blobs: list) -> list[bytes]:
    """Marked starts of each bucket's records: windows that start in a smaller document too.

    Equal windows have equal anchors, so stretches are merged a slice of anchors at a time;
    only the slice's texts are copied, and marks are kept as runs.
    """
    unpacked = [_unpack(blob, *_RECORDS) for blob in blobs]
    anchors, ids, places, lead, windows = (np.concatenate([one[k] for one in unpacked]) for k in range(5))
    counts = windows.astype(np.int64)
    lengths = counts + LENGTH - 1
    limits = np.cumsum([0, *(len(one[0]) for one in unpacked)])
    begins = np.concatenate([np.cumsum(own) - own for own in np.split(lengths, limits[1:-1])])
    found: list[list[np.ndarray]] = []
    for chosen in _stretches_by_anchor(anchors, counts):
        chosen = np.sort(chosen)
        at = np.searchsorted(chosen, limits)
        texts = np.concatenate(
            [
                _gather(one[5], begins[chosen[a:b]], lengths[chosen[a:b]])
                for one, a, b in zip(unpacked, at, at[1:])
                if a < b
            ]
            or [np.zeros(0, np.uint8)]
        )
        for row, first, last in _merge_stretches(texts, anchors[chosen], ids[chosen], lead[chosen], counts[chosen]):
            found.append([chosen[row], places[chosen[row]] + first, places[chosen[row]] + last])
    row, first, last = (np.concatenate(column) for column in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
    order = np.argsort(row, kind="stable")
    row, first, last = row[order], first[order], last[order]
    bounds = np.searchsorted(row, limits)
    return [_join_runs(ids[row[a:b]], first[a:b], last[a:b]) for a, b in zip(bounds, bounds[1:])]


def _merge_stretches(data: np.ndarray, anchors: np.ndarray, ids: np.ndarray, lead: np.ndarray, counts: np.ndarray):
    """Stretch, first and last window of runs that start in a smaller document too.

    A frequent anchor may have many more windows than a slice: hashes and the smallest
    document of each are held for all, everything else for some stretches or for a range
    of hashes at a time.
    """
    lengths = counts + LENGTH - 1
    begins = np.cumsum(lengths) - lengths
    # Equal stretches are merged as wholes; only one of each is opened into windows.
    whole, check = _hashes(data, begins, lengths)
    whole = mix(whole ^ (lead.astype(np.uint64) << np.uint64(48)) ^ anchors)
    _, leader, same = np.unique(whole, return_index=True, return_inverse=True)
    if (check[leader][same] != check).any():
        both = np.stack([whole, check], 1).view("u8,u8").ravel()
        _, leader, same = np.unique(both, return_index=True, return_inverse=True)
    least = np.full(len(leader), np.iinfo(np.int64).max)
    np.minimum.at(least, same, ids)
    opened = counts[leader]
    ends = np.cumsum(opened)
    window, control = np.empty(int(ends[-1]), np.uint64), np.empty(int(ends[-1]), np.uint64)
    for a, b in _row_chunks(opened):
        low, high = int(ends[a] - opened[a]), int(ends[b - 1])
        texts = _gather(data, begins[leader[a:b]], lengths[leader[a:b]])
        own = np.cumsum(lengths[leader[a:b]]) - lengths[leader[a:b]]
        starts = np.arange(low, high) + np.repeat(own - (ends[a:b] - opened[a:b]), opened[a:b])
        window[low:high], control[low:high] = _hashes(texts, starts, np.full(len(starts), LENGTH))
    smallest = np.empty(len(window), np.int64)
    ranges = max(0, (len(window) // SLICE_WINDOWS).bit_length())
    for k in range(1 << ranges):
        at = np.flatnonzero(window >> np.uint64(64 - ranges) == k) if ranges else np.arange(len(window))
        if not len(at):
            continue
        order = at[np.argsort(window[at], kind="stable")]
        heads = np.append(True, window[order][1:] != window[order][:-1])
        if (control[order][1:] != control[order][:-1])[~heads[1:]].any():
            order = at[np.lexsort((control[at], window[at]))]
            one, two = window[order], control[order]
            heads = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
        documents = least[np.searchsorted(ends, order, side="right")]
        smallest[order] = np.minimum.reduceat(documents, np.flatnonzero(heads))[np.cumsum(heads) - 1]
    del window, control

    firsts = ends - opened
    for a, b in _row_chunks(counts):
        owner = np.repeat(np.arange(a, b), counts[a:b])
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts[a:b]) - counts[a:b], counts[a:b])
        smaller = smallest[firsts[same[owner]] + within] < ids[owner]
        owner, within = owner[smaller], within[smaller]
        if len(owner):
            heads = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (within[1:] != within[:-1] + 1)))
            yield owner[heads], within[heads], within[np.append(heads[1:], len(owner)) - 1]


def _merge(group: pa.Table) -> pa.Table:
    buckets, marks = group["bucket"].to_pylist(), group["marks"].to_pylist()
    # The records are read where they lie.
    blobs = [record.as_buffer() for record in group["records"]]
    rows = [k for k, blob in enumerate(blobs) if blob is not None]
    results = merge_records([blobs[k] for k in rows]) if rows else []
    out = [(buckets[k], result) for k, result in zip(rows, results, strict=True)]
    out += [(buckets[k], mark) for k, mark in enumerate(marks) if mark]
    return pa.table(
        {"bucket": pa.array([b for b, _ in out], pa.int64()), "marks": pa.array([m for _, m in out], pa.binary())}
    )


OUTPUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _remove(keep_text: bool):
    def remove(texts: pa.Table, marks: pa.Table) -> pa.Table:
        data, offsets = texts_as_bytes(texts["text"]) if len(texts) else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        ids = texts["doc_id"].combine_chunks() if len(texts) else pa.array([], pa.int64())
        parts = [_unpack(blob.as_py(), *_MARKS) for blob in marks["marks"]]
        owner, first, last = (
            (np.concatenate([part[k] for part in parts]) if parts else np.zeros(0, np.int64)) for k in range(3)
        )
        order = np.argsort(owner, kind="stable")
        owner, first, last = owner[order], first[order], last[order]
        rows: list[tuple] = []
        for k, key in enumerate(ids.to_pylist()):
            text = data[offsets[k] : offsets[k + 1]]
            low, high = (0, 0) if key is None else np.searchsorted(owner, [key, key + 1])
            if low == high:
                rows.append((len(text), 0, 0, text.tobytes()))
                continue
            steps = np.zeros(len(text) + 1, np.int64)
            np.add.at(steps, first[low:high], 1)
            np.add.at(steps, np.minimum(last[low:high] + LENGTH, len(text)), -1)
            gone = np.cumsum(steps[:-1]) > 0
            spans = int(np.count_nonzero(gone & np.append(True, ~gone[:-1])))
            rows.append((len(text), int(np.count_nonzero(gone)), spans, text[~gone].tobytes()))
        sizes, removed, spans, kept = (list(column) for column in zip(*rows, strict=True)) if rows else ([], [], [], [])
        return pa.table(
            {
                "doc_id": ids.cast(pa.int64()),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                "kept": pa.array(kept if keep_text else [None] * len(kept), pa.binary()),
            }
        )

    return remove


def remove_repeats(documents: DataFrame, keep_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes."""
    total = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-total // BUCKET_BYTES))
    bits = max(3, (total // PART_BYTES).bit_length())
    # Texts without an id are dealt by what they are, so that they do not meet in one bucket.
    dealt = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    texts = documents.select(
        F.pmod(dealt, F.lit(buckets)).alias("bucket"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    tasks = max(1, min(buckets, 4096))
    texts = texts.repartition(tasks, "bucket")
    runs = texts.groupBy("bucket").applyInArrow(_send_anchors(bits), "part bigint, bucket bigint, run binary")
    shared = runs.groupBy("part").applyInArrow(_find_shared, "part bigint, bucket bigint, bits binary")
    records = (
        texts.groupBy("bucket")
        .cogroup(shared.repartition(tasks, "bucket").groupBy("bucket"))
        .applyInArrow(_send_contexts(bits), "part bigint, bucket bigint, records binary, marks binary")
    )
    marks = records.groupBy("part").applyInArrow(_merge, "bucket bigint, marks binary")
    result = (
        texts.groupBy("bucket")
        .cogroup(marks.repartition(tasks, "bucket").groupBy("bucket"))
        .applyInArrow(_remove(keep_text), OUTPUT)
    )
    return result if keep_text else result.drop("kept")
