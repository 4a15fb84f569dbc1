"""Exact removal of repeated byte strings by a distributed merge sort of suffixes.

A task sorts the suffixes of its texts and deals them out as front-coded
runs: each suffix with the length of the prefix it shares with the one before,
and the bytes after it. A part merges the runs of all tasks with a loser tree
that carries common-prefix lengths: of two candidates the one that shares more
with the last suffix given out comes first, and only if both share the same
length their bytes are compared, from there on. No known prefix is compared again.

Not every suffix has to travel. Every string of ``width`` bytes (a window)
contains the ``seed``-byte string whose hash is the smallest in it, the leftmost
one of equals. Equal windows choose the same one, at the same place within
them. So only suffixes that start at a chosen place are sorted, about
one in (width - seed + 2) / 2, and each brings the bytes before it that its
windows need. Before that, the hashes of all chosen seeds are compared, sorted and
as differences, about four bytes each: a suffix whose seed occurs in no other document stays at home. Suffixes with the same first
``seed`` bytes meet in one part, and every window is judged there, byte by byte.

Texts are dealt out once, compressed, to homes of some megabytes; a home makes one run.
There is at most one row per home and part, and never more of them than suffixes.
Suffixes that are equal within a home, bytes before them included, are settled
there: the smallest document's goes out for all. A passage that a third of all
documents share sends one suffix per home.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches, whole
from tidewatch.llm.tokens import mixed

WIDTH, SEED = 50, 20
#: Bits of a seed's hash that are compared before suffixes travel; more of them spare only suffixes.
HASH_BITS = 48
#: Bytes of text a task holds before it deals them out.
HELD_BYTES = 16 << 20
#: Bytes hashed at once.
BLOCK_BYTES = 1 << 20
#: Text per home and per part, about.
PART_BYTES = 16 << 20

RUN_SCHEMA = "part int, n int, m int, body binary"
#: Kinds of the arrays in a body, in their order there.
RUN_KINDS = {"lcp": "u1", "right": "u1", "left": "u1", "doc": "<i8", "none": "u1", "tag": "<u8", "pos": "<u4"}
SPAN_KINDS = {"doc": "<i8", "none": "u1", "tag": "<u8", "start": "<u4", "end": "<u4"}
TEXT_KINDS = {"doc": "<i8", "none": "u1", "tag": "<u8", "len": "<u4"}
ASK_KINDS = {"step": "<u8", "several": "u1"}
BASE = 0x9E3779B97F4A7C15 | 1


# ---- bodies: columns as byte planes, then compressed text


def planes(arrays: dict, kinds: dict) -> bytes:
    """Arrays one after the other, the first bytes of all values before the second ones: ids and places shrink well."""
    out = []
    for name, kind in kinds.items():
        a = np.ascontiguousarray(arrays[name], kind)
        out.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return b"".join(out)


def unplanes(data: bytes, at: int, n: int, kinds: dict) -> tuple[dict, int]:
    out = {}
    for name, kind in kinds.items():
        size = np.dtype(kind).itemsize
        a = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        out[name] = np.ascontiguousarray(a.T).reshape(-1).view(kind)
        at += n * size
    return out, at


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


# ---- sorted runs


def tag_of(doc_id: int | None, text: bytes) -> int:
    """Tells texts of one id apart; documents without an id are many, so they get 64 bits."""
    return zlib.crc32(text) if doc_id is not None else int.from_bytes(hashlib.md5(text).digest()[:8], "little")


def chosen(a: np.ndarray, doc: np.ndarray, width: int, seed: int):
    """(place, lo, hi, hash) of the seeds chosen by the windows of ``a``.

    ``doc`` numbers the document of every byte, -1 outside; windows lie within one document.
    A seed's windows start lo to hi bytes before it.
    """
    n = len(a) - width + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    power = np.full(len(a) + 1, BASE, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    back = np.full(len(a) + 1, pow(BASE, -1, 1 << 64), np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    run = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(mixed(a.astype(np.uint64) + np.uint64(1)) * power[:-1], out=run[1:])
    h = mixed((run[seed:] - run[:-seed]) * back[: len(a) - seed + 1])
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span, step = width - seed + 1, 1
    while step < span:
        shift = min(step, span - step)
        key = np.minimum(key[:-shift], key[shift:])
        step += shift
    at = np.flatnonzero((doc[:n] == doc[width - 1 :]) & (doc[:n] >= 0))
    place = (key[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    return place[first], place[first] - at[last], place[first] - at[first], h[place[first]]


def chosen_of_run(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, width: int, seed: int):
    """As :func:`chosen` for all texts of a run, block by block; long texts are cut into blocks that share width - 1 bytes."""
    found, i = [], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + BLOCK_BYTES)))
        begin, end = starts[i], starts[j - 1] + lens[j - 1]
        doc = np.repeat(np.arange(i, j), lens[i:j] + 1)[: end - begin]
        doc[(starts[i + 1 : j] - 1) - begin] = -1
        for at in range(0, max(1, end - begin - width + 1), BLOCK_BYTES):
            part = slice(at, at + BLOCK_BYTES + width - 1)
            place, lo, hi, h = chosen(data[begin:end][part], doc[part], width, seed)
            found.append((place + begin + at, lo, hi, h))
        i = j
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else chosen(data[:0], data[:0], width, seed)


KEEP = np.array([0] + [(1 << 64) - (1 << 8 * (8 - r)) for r in range(1, 9)], np.uint64)


def words_of(data: np.ndarray):
    """word(places, lengths, level): bytes 8 * level and on of strings, as big-endian numbers, zero beyond their ends."""
    at = np.ndarray(len(data) - 7, ">u8", data.data, strides=(1,))

    def word(places, lengths, level):
        rest = np.clip(lengths - 8 * level, 0, 8)
        return at[np.minimum(places + 8 * level, len(at) - 1)].astype(np.uint64) & KEEP[rest]

    return word


def sorted_suffixes(part, place, right, left, refs, word):
    """(order, lcp with the one before in the part, first one equal in all bytes, first one equal in ``refs`` too).

    Sorted by part, bytes from ``place`` on (``right`` of them), bytes before it (``left``), then ``refs``, the document's
    rank first. Each step looks only at suffixes that are still equal.
    """
    n = len(place)
    rights, lefts = -(-int(right.max(initial=0)) // 8), -(-int(left.max(initial=0)) // 8)
    steps = [lambda r: part[r].astype(np.uint64)]
    steps += [lambda r, k=k: word(place[r], right[r], k) for k in range(rights)]
    steps += [lambda r: right[r].astype(np.uint64)]
    steps += [lambda r, k=k: word(place[r] - left[r], left[r], k) for k in range(lefts)]
    steps += [lambda r: left[r].astype(np.uint64)]
    alike = len(steps)
    steps += [lambda r, x=x: x[r].astype(np.uint64) for x in refs]
    order, lcp, group = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    group_all = None
    active = np.arange(n)
    for number, step in enumerate(steps):
        if number == alike:
            group_all = group.copy()
        if not len(active):
            break
        rows = order[active]
        key = step(rows)
        g = group[active]
        by = np.lexsort((key, g)) if number else np.argsort(key, kind="stable")
        key, order[active] = key[by], rows[by]
        same = g[1:] == g[:-1]
        differs = np.append(True, ~same | (key[1:] != key[:-1]))
        if 0 < number <= rights:
            pair = np.flatnonzero(differs[1:] & same) + 1
            x = key[pair] ^ key[pair - 1]
            zero = sum((x < np.uint64(1 << 8 * b)).astype(np.int64) for b in range(1, 8))
            lcp[active[pair]] = 8 * (number - 1) + zero
        elif number == rights + 1:  # what is equal up to the shorter one's end
            pair = np.flatnonzero(same) + 1
            lcp[active[pair]] = np.minimum(right[order[active[pair]]], right[order[active[pair - 1]]])
        group[active] = active[np.maximum.accumulate(np.where(differs, np.arange(len(active)), 0))]
        alone = differs & np.append(differs[1:], True)
        active = active[~alone]
    lcp[1:] = np.minimum(lcp[1:], np.minimum(right[order[1:]], right[order[:-1]]))
    return order, lcp, group if group_all is None else group_all, group


def union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch as one, in order."""
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by]) if len(end) else end
    first = np.flatnonzero(np.append(True, start[1:] > end[:-1])) if len(start) else np.empty(0, np.int64)
    return start[first], end[np.append(first[1:], len(start)) - 1] if len(first) else end


def ragged(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> bytes:
    """The bytes of many slices, one after the other."""
    ends = np.cumsum(lens)
    index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lens), lens)
    return data[index].tobytes()


def ref_part(doc: np.ndarray, tag: np.ndarray, parts: int) -> np.ndarray:
    h = mixed(doc.astype(np.int64).view(np.uint64) * np.uint64(BASE) + tag)
    return (h % np.uint64(parts)).astype(np.int64)


def cuts_of(part: np.ndarray, wanted: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(part, begin, end) of the parts that occur in sorted numbers, or of those ``wanted``; parts without rows cost nothing."""
    found = np.unique(part) if wanted is None else wanted
    ends = np.searchsorted(part, found, "right")
    return list(zip(found.tolist(), np.searchsorted(part, found).tolist(), ends.tolist(), strict=True))


class Texts:
    """Documents held until they are dealt out: their bytes with one byte between them, ids and tags."""

    def __init__(self):
        self.texts, self.ids, self.size = [], [], 0

    def add(self, doc_id, text: bytes) -> None:
        self.texts.append(text)
        self.ids.append(doc_id)
        self.size += len(text) + 1

    def arrays(self):
        data = np.frombuffer(b"\0".join(self.texts) + bytes(72), np.uint8)
        lens = np.array([len(t) for t in self.texts], np.int64)
        starts = np.cumsum(lens + 1) - lens - 1
        none = np.array([i is None for i in self.ids])
        doc = np.array([0 if i is None else i for i in self.ids], np.int64)
        tag = np.array([tag_of(i, t) for i, t in zip(self.ids, self.texts, strict=True)], np.uint64)
        return data, starts, lens, doc, none, tag


class Home:
    """Texts of one home as :func:`text_writer` has written them, and the seeds their windows choose."""

    def __init__(self, rows: list[tuple[int, bytes]], width: int, seed: int, parts: int):
        found, texts = [], []
        for m, body in rows:
            data = unsqueezed(body)
            columns, at = unplanes(data, 0, m, TEXT_KINDS)
            found.append(columns)
            texts.append(data[at:])
        self.doc, self.none, self.tag, self.lens = (
            np.concatenate([np.empty(0, kind), *[f[k] for f in found]]) for k, kind in TEXT_KINDS.items()
        )
        self.lens = self.lens.astype(np.int64)
        self.starts = np.cumsum(self.lens + 1) - self.lens - 1
        self.data = np.frombuffer(b"".join(texts) + bytes(72), np.uint8)
        self.place, self.lo, self.hi, h = chosen_of_run(self.data, self.starts, self.lens, width, seed)
        self.owner = np.searchsorted(self.starts, self.place, "right") - 1
        self.key = h >> np.uint64(64 - HASH_BITS)
        self.part = (mixed(self.key) % np.uint64(parts)).astype(np.int64)

    def seeds(self):
        """(order of the seeds by part, key and document, where each distinct one begins in it)."""
        order = np.lexsort((self.owner, self.key, self.part))
        key = self.key[order]
        return order, np.flatnonzero(np.append(len(key) > 0, key[1:] != key[:-1]))

    def keep(self, wanted: np.ndarray) -> None:
        self.place, self.lo, self.hi, self.owner, self.part = (
            x[wanted] for x in (self.place, self.lo, self.hi, self.owner, self.part)
        )


def asker(parts: int, width: int, seed: int):
    """Per home and part: its distinct seeds as differences of sorted hashes, and which of them are in two of its documents."""

    def run(key, t):
        home = Home(list(zip(t["m"].to_pylist(), t["body"].to_pylist(), strict=True)), width, seed, parts)
        order, first = home.seeds()
        last = np.append(first[1:], len(order)) - 1 if len(first) else first
        several = home.owner[order[first]] != home.owner[order[last]]
        keys, part = home.key[order[first]], home.part[order[first]]
        cuts = cuts_of(part)
        bodies = [
            squeezed(planes({"step": np.diff(keys[a:b], prepend=np.uint64(0)), "several": several[a:b]}, ASK_KINDS)) for _, a, b in cuts
        ]
        return pa.table({
            "part": pa.array([p for p, _, _ in cuts], pa.int32()),
            "home": pa.array([key[0].as_py()] * len(cuts), pa.int32()),
            "n": pa.array([b - a for _, a, b in cuts], pa.int32()),
            "body": pa.array(bodies, pa.binary()),
        })

    return run


def answer(key, t):
    """Per home: a bit for each seed it asked for, set if another document has it."""
    homes, n = t["home"].to_pylist(), t["n"].to_pylist()
    asked = [unplanes(unsqueezed(b), 0, m, ASK_KINDS)[0] for m, b in zip(n, t["body"].to_pylist(), strict=True)]
    keys = np.concatenate([np.cumsum(a["step"]) for a in asked])
    order = np.argsort(keys, kind="stable")
    same = np.append(keys[order[1:]] == keys[order[:-1]], False)
    repeated = np.concatenate([a["several"] for a in asked]).astype(bool)
    repeated[order[:-1][same[:-1]]] = True
    repeated[order[1:][same[:-1]]] = True
    # one of several homes with the key may know of two documents by itself
    number = np.cumsum(np.append(True, ~same[:-1])) - 1
    of_key = np.zeros(number[-1] + 1, bool)
    of_key[number[repeated[order]]] = True
    repeated[order] = of_key[number]
    cuts = np.cumsum([0, *n])
    bits = [np.packbits(repeated[a:b]).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
    part = [key[0].as_py()] * len(homes)
    return pa.table({"home": pa.array(homes, pa.int32()), "part": pa.array(part, pa.int32()), "n": pa.array(n, pa.int32()), "bits": pa.array(bits, pa.binary())})


def runs_of(home: Home, parts: int, width: int) -> Iterator[tuple]:
    """(part, n, m, body): for each part the home's front-coded run, and spans that were settled here."""
    data, starts, doc, none, tag = home.data, home.starts, home.doc, home.none, home.tag
    place, lo, owner, part = home.place, home.lo, home.owner, home.part
    if not len(place):
        return
    # rank of a document: ids ascending, those without one behind, all alike
    ids, rank = np.unique(doc, return_inverse=True)
    rank = np.where(none == 1, len(ids), rank)[owner]
    right, left = width - lo, home.hi
    order, lcp, alike, same = sorted_suffixes(part, place, right, left, (rank, tag[owner], place - starts[owner]), words_of(data))
    settled = rank[order] > rank[order[alike]]
    again = ~settled & (same != np.arange(len(same)))  # the same place of an equal row
    out = order[settled]
    start, end = union(place[out] - left[out], place[out] - lo[out] + width)
    own = np.searchsorted(starts, start, "right") - 1
    spans = {"doc": doc[own], "none": none[own], "tag": tag[own], "start": start - starts[own], "end": end - starts[own]}
    span_part = ref_part(spans["doc"], spans["tag"], parts)
    # what stays between two kept suffixes shares all their bytes with the first one
    keep = np.flatnonzero(~settled & ~again)
    order, lcp = order[keep], lcp[keep]
    part, by = part[order], np.argsort(span_part, kind="stable")
    both = np.union1d(part, span_part)
    for (p, a, b), (_, c, d) in zip(cuts_of(part, both), cuts_of(span_part[by], both), strict=True):
        rows, shared = order[a:b], lcp[a:b]
        own = owner[rows]
        body = planes({"lcp": shared, "right": right[rows], "left": left[rows], "doc": doc[own], "none": none[own],
                       "tag": tag[own], "pos": place[rows] - starts[own]}, RUN_KINDS)
        body += planes({k: v[by[c:d]] for k, v in spans.items()}, SPAN_KINDS)
        body += ragged(data, place[rows] - left[rows], left[rows])
        body += ragged(data, place[rows] + shared, right[rows] - shared)
        yield p, b - a, d - c, squeezed(body)


def run_writer(parts: int, width: int, seed: int):
    def run(key, texts, answers):
        home = Home(list(zip(texts["m"].to_pylist(), texts["body"].to_pylist(), strict=True)), width, seed, parts)
        order, first = home.seeds()
        told = sorted(zip(answers["part"].to_pylist(), answers["n"].to_pylist(), answers["bits"].to_pylist(), strict=True))
        repeated = [np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool) for _, n, bits in told]
        wanted = np.zeros(len(order), bool)
        if len(first):
            wanted[order] = np.repeat(np.concatenate(repeated), np.diff(np.append(first, len(order))))
        home.keep(wanted)
        rows = list(runs_of(home, parts, width))
        kinds = {"part": pa.int32(), "n": pa.int32(), "m": pa.int32(), "body": pa.binary()}
        return pa.table({c: pa.array([r[i] for r in rows], kind) for i, (c, kind) in enumerate(kinds.items())})

    return run


# ---- merging


class Run:
    """A front-coded run, read from front to end."""

    def __init__(self, n: int, m: int, body: bytes):
        data = unsqueezed(body)
        self.columns, at = unplanes(data, 0, n, RUN_KINDS)
        self.spans, at = unplanes(data, at, m, SPAN_KINDS)
        left, right = self.columns["left"].astype(np.int64), self.columns["right"].astype(np.int64)
        self.lcp = self.columns["lcp"].tolist()
        self.lefts = (at + np.cumsum(left) - left).tolist()
        at += int(left.sum())
        tails = right - self.columns["lcp"]
        self.ends = (at + np.cumsum(tails)).tolist()
        self.data, self.at, self.end, self.n, self.now = data, at, at, n, b""
        self.index = -1

    def advance(self) -> int:
        """To the next suffix; what it shares with the one before, -1 at the end."""
        self.index += 1
        if self.index >= self.n:
            return -1
        shared, begin, self.end = self.lcp[self.index], self.end, self.ends[self.index]
        self.now = self.now[:shared] + self.data[begin : self.end]
        return shared

    def item(self, i: int):
        """(bytes before, document, None if it has none, tag, place in the document) of the i-th suffix."""
        c = self.columns
        begin = self.lefts[i]
        doc = None if c["none"][i] else int(c["doc"][i])
        return self.data[begin : begin + int(c["left"][i])], doc, int(c["tag"][i]), int(c["pos"][i])


def common_prefix(x: bytes, y: bytes, at: int) -> int:
    """Length of the common prefix, of which ``at`` bytes are known."""
    end = min(len(x), len(y))
    while at + 8 <= end and x[at : at + 8] == y[at : at + 8]:
        at += 8
    while at < end and x[at] == y[at]:
        at += 1
    return at


def merged(runs: list[Run]) -> Iterator[tuple[int, int]]:
    """(run, lcp with the suffix before) for all suffixes of the runs in order; the run stands on the suffix.

    A loser tree. ``shared`` has for each run what its current suffix has in common with the one that beat
    it; on the path of the last winner that is the last winner for all of them.
    """
    k = 1 << max(0, len(runs) - 1).bit_length()
    shared = [min(r.advance(), 0) for r in runs] + [-1] * (k - len(runs))
    losers = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        if shared[a] < 0:
            return a, b
        x, y = runs[a].now, runs[b].now
        p = common_prefix(x, y, shared[a])
        if p == len(x) or p < len(y) and x[p] < y[p]:
            shared[b] = p
            return a, b
        shared[a] = p
        return b, a

    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    w = winners[1] if k > 1 else 0
    while shared[w] >= 0:
        yield w, shared[w]
        shared[w] = runs[w].advance()
        node = (w + k) >> 1
        while node:
            o = losers[node]
            if shared[w] < shared[o]:
                losers[node], w = w, o
            elif shared[w] == shared[o] >= 0:
                w, losers[node] = play(w, o)
            node >>= 1


def earlier(a: int | None, b: int | None) -> bool:
    """Whether document a comes before b; one without an id comes behind all others and before none."""
    return a is not None and (b is None or a < b)


def judge(group: list, width: int, removed: list) -> None:
    """Add to ``removed`` (doc, tag, start, end) what the suffixes of one seed show to be repeated.

    ``group``: (lcp, bytes from the seed on, run, number in the run), sorted.
    """
    alike: dict = {}
    shared, least = [], width
    for lcp, right, run, number in group:
        left, doc, tag, place = run.item(number)
        least = min(least, lcp)
        members = alike.get((right, left))
        if members is None:
            alike[right, left] = [(doc, tag, place)]
            shared.append(least)
            least = width
        else:
            members.append((doc, tag, place))
    shared.append(0)
    shared[0] = 0
    firsts = []
    for (right, left), members in alike.items():
        first = members[0][0]
        for doc, _, _ in members:
            if earlier(doc, first):
                first = doc
        firsts.append(first)
        for doc, tag, place in members:
            if earlier(first, doc):
                removed.append((doc, tag, place - len(left), place + len(right)))
    if len(alike) == 1:
        return
    # a window needs as many bytes from the seed on as some other suffix shares
    windows, seen = [], {}
    for n, (right, left) in enumerate(alike):
        hi, todo = len(left), []
        for i in range(max(width - len(right), width - max(shared[n], shared[n + 1])), hi + 1):
            w = left[hi - i :] + right[: width - i]
            todo.append((i, w))
            if w not in seen or earlier(firsts[n], seen[w]):
                seen[w] = firsts[n]
        windows.append(todo)
    for first, todo, members in zip(firsts, windows, alike.values(), strict=True):
        hits = [i for i, w in todo if earlier(seen[w], first)]
        if hits:  # all of them contain the seed, so their union is one span
            removed += [(doc, tag, place - hits[-1], place - hits[0] + width) for doc, tag, place in members if doc == first]


def merger(parts: int, width: int, seed: int):
    def run(key, t):
        runs = [Run(n, m, body) for n, m, body in zip(*(t[c].to_pylist() for c in ("n", "m", "body")), strict=True)]
        removed: list = []
        group: list = []
        for w, lcp in merged(runs):
            r = runs[w]
            if lcp < seed:
                if len(group) > 1:
                    judge(group, width, removed)
                group = []
            group.append((lcp, r.now, r, r.index))
        if len(group) > 1:
            judge(group, width, removed)
        del group
        doc, tag, start, end = zip(*removed, strict=True) if removed else ((),) * 4
        mine = {"doc": [0 if d is None else d for d in doc], "none": [d is None for d in doc], "tag": tag, "start": start, "end": end}
        spans = {k: np.concatenate([np.array(mine[k], kind), *[r.spans[k] for r in runs]]) for k, kind in SPAN_KINDS.items()}
        home = ref_part(spans["doc"], spans["tag"], parts)
        by = np.argsort(home, kind="stable")
        cuts = cuts_of(home[by])
        bodies = [squeezed(planes({k: v[by[a:b]] for k, v in spans.items()}, SPAN_KINDS)) for _, a, b in cuts]
        return pa.table({
            "home": pa.array([p for p, _, _ in cuts], pa.int32()),
            "m": pa.array([b - a for _, a, b in cuts], pa.int32()),
            "body": pa.array(bodies, pa.binary()),
        })

    return run


# ---- cutting


def text_writer(parts: int):
    """Texts by home, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Texts()

        def flush():
            if not held.texts:
                return
            data, starts, lens, doc, none, tag = held.arrays()
            home = ref_part(doc, tag, parts)
            by = np.argsort(home, kind="stable")
            for p, a, b in cuts_of(home[by]):
                rows = by[a:b]
                body = planes({"doc": doc[rows], "none": none[rows], "tag": tag[rows], "len": lens[rows]}, TEXT_KINDS)
                body = squeezed(body + ragged(data, starts[rows], lens[rows] + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), pa.array([len(rows)], pa.int32()), pa.array([body], pa.binary())], names=["home", "m", "body"]
                )

        for batch in batches:
            for i, t in zip(batch["doc_id"], batch["text"], strict=True):
                held.add(i.as_py(), t.as_py())
                if held.size >= HELD_BYTES:
                    yield from flush()
                    held = Texts()
        yield from flush()

    return run


CUT_SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def cutter(keep_text: bool):
    def run(key, texts, spans):
        found = [unplanes(unsqueezed(b), 0, m, SPAN_KINDS)[0] for m, b in zip(spans["m"].to_pylist(), spans["body"].to_pylist(), strict=True)]
        s = {k: np.concatenate([np.empty(0, kind), *[f[k] for f in found]]) for k, kind in SPAN_KINDS.items()}
        by = np.lexsort((s["none"], s["tag"], s["doc"]))
        doc, tag, no_id = s["doc"][by], s["tag"][by], s["none"][by]
        start, end = s["start"][by].astype(np.int64), s["end"][by].astype(np.int64)
        new = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (no_id[1:] != no_id[:-1])
        heads = np.flatnonzero(np.append(len(doc) > 0, new))
        refs = zip(doc[heads].tolist(), tag[heads].tolist(), no_id[heads].tolist(), strict=True)
        of = dict(zip(refs, zip(heads, np.append(heads[1:], len(doc))[: len(heads)], strict=True), strict=True))
        out = {c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if keep_text else []))}
        for m, body in zip(texts["m"].to_pylist(), texts["body"].to_pylist(), strict=True):
            data = unsqueezed(body)
            c, at = unplanes(data, 0, m, TEXT_KINDS)
            for d, t, none, n in zip(c["doc"].tolist(), c["tag"].tolist(), c["none"].tolist(), c["len"].tolist(), strict=True):
                text, at = data[at : at + n], at + n + 1
                a, b = of.get((d, t, none), (0, 0))
                cut, upto = union(start[a:b], end[a:b])
                rest = b"".join(text[i:j] for i, j in zip([0, *upto.tolist()], [*cut.tolist(), n], strict=True))
                out["doc_id"].append(None if none else d)
                out["n_bytes"].append(n)
                out["n_removed"].append(n - len(rest))
                out["n_spans"].append(len(cut))
                out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
                if keep_text:
                    out["kept_text"].append(rest)
        kinds = {"kept_sha256": pa.string(), "kept_text": pa.binary()}
        return pa.table({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})

    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED, keep_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept_text (binary).

    A byte goes if it lies in a string of ``width`` bytes that also starts in a document with a smaller
    doc_id. Texts are UTF-8 bytes, null ones are empty; a span may begin or end within a character. A null doc_id comes behind all
    others and before none, so texts without an id lose what those with one have, and nothing to each other. Repeated
    rows and texts of one id lose nothing to each other. Texts shorter than ``width`` stay whole. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").cast("binary").alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    texts = d.mapInArrow(text_writer(parts), "home int, m int, body binary").groupBy("home")
    asked = texts.applyInArrow(asker(parts, width, seed), "part int, home int, n int, body binary").groupBy("part")
    told = asked.applyInArrow(answer, "home int, part int, n int, bits binary").groupBy("home")
    runs = texts.cogroup(told).applyInArrow(run_writer(parts, width, seed), RUN_SCHEMA).groupBy("part")
    spans = runs.applyInArrow(merger(parts, width, seed), "home int, m int, body binary").groupBy("home")
    return texts.cogroup(spans).applyInArrow(
        cutter(keep_text), CUT_SCHEMA + (", kept_text binary" if keep_text else "")
    )
