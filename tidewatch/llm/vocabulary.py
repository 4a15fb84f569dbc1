"""How sources of a language differ in their words, counted by a minimal acyclic transducer.

The terms a language keeps are sorted and built into the smallest acyclic automaton that
accepts them. Every arc carries how many terms sort before those behind it, so the sum
along a term's path is its ordinal in the sorted list. Texts are streamed
through it, all words of a block side by side and one byte further per step: words outside
the vocabulary drop out at the first missing arc, the others end with their
ordinal. Counts, comparisons and ties then work on ordinals; the automaton, walked the
other way, turns the few that are reported into terms again.

A vocabulary of any size is cut into slices with an automaton each. As
many slices as fit :data:`BROADCAST_BYTES` go to the tasks at once, and the texts are
streamed once for each such load.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches, stage

LEAST_DOCS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TOP = 50
#: Terms per automaton, and bytes of automata a task holds at a time.
SLICE_TERMS = 200_000
BROADCAST_BYTES = 32 << 20
#: Terms a task counts, and numbers it adds up, before it hands them on.
HELD_TERMS = 300_000
HELD_CELLS = 4 << 20
BLOCK_BYTES = 1 << 20

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Bytes of terms, lower-cased, in order: a-z, then all above 127.
LETTERS = bytes([*range(97, 123), *range(128, 256)])
CLASS = np.full(256, -1, np.int64)
CLASS[list(LETTERS)] = np.arange(len(LETTERS))
WORDS = -(-len(LETTERS) // 64)


# ---- document frequencies


def document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, number of documents with it), added up within the task as far as :data:`HELD_TERMS` allows."""
    term = re.compile(rb"[a-z\x80-\xff]+")
    held: dict = defaultdict(Counter)

    def flush():
        for lang, counts in held.items():
            terms, n = list(counts), list(counts.values())
            for i in range(0, len(terms), 50_000):
                part = terms[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array(n[i : i + 50_000], pa.int64())],
                    names=["lang", "term", "n"],
                )
        held.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
            held[lang].update(set(term.findall(text.as_py().translate(LOWER))))
            if sum(map(len, held.values())) > HELD_TERMS:
                yield from flush()
    yield from flush()


# ---- the transducer


class Transducer:
    """Minimal acyclic automaton of sorted terms with their ordinals.

    ``bitmap`` has WORDS 64-bit words per state with a bit per outgoing letter; the arc of a letter
    is number ``first`` of the word plus the bits below the letter's.
    """

    FIELDS = {"bitmap": "<u8", "first": "<i4", "target": "<i4", "before": "<i8", "final": "u1", "letter": "u1"}

    def __init__(self, arrays: dict):
        self.bitmap, self.first, self.target, self.before, self.final, self.letter = (arrays[f] for f in self.FIELDS)

    @classmethod
    def build(cls, terms: list[bytes]) -> Transducer:
        """From ascending, distinct, non-empty terms. Only the path of the last term is open; behind it
        every state is looked up among those known and becomes one of them if it is equal."""
        known: dict = {}
        states: list = []  # (final, ((letter, state), ...))
        sizes: list[int] = []
        path: list = [[False, []]]
        last = b""

        def close(node) -> int:
            key = (node[0], tuple(node[1]))
            if key not in known:
                known[key] = len(states)
                states.append(key)
                sizes.append(key[0] + sum(sizes[s] for _, s in key[1]))
            return known[key]

        def close_to(depth: int) -> None:
            while len(path) > depth + 1:
                state = close(path.pop())
                path[-1][1].append((last[len(path) - 1], state))

        for term in terms:
            p = 0
            while p < len(last) and p < len(term) and last[p] == term[p]:
                p += 1
            close_to(p)
            path += [[False, []] for _ in term[p:]]
            path[-1][0] = True
            last = term
        close_to(0)
        root = close(path.pop())
        # the root comes first
        number = np.arange(len(states))
        number[root], number[0] = 0, root
        states[root], states[0] = states[0], states[root]
        sizes[root], sizes[0] = sizes[0], sizes[root]
        n_arcs = sum(len(arcs) for _, arcs in states)
        out = {f: np.zeros(n, kind) for (f, kind), n in zip(
            cls.FIELDS.items(), (len(states) * WORDS, len(states) * WORDS, n_arcs, n_arcs, len(states), n_arcs), strict=True)}
        at = 0
        for s, (final, arcs) in enumerate(states):
            out["final"][s] = final
            before, bits, firsts = int(final), [0] * WORDS, [at] * WORDS
            for letter, target in arcs:
                word, bit = divmod(int(CLASS[letter]), 64)
                bits[word] |= 1 << bit
                for later in range(word + 1, WORDS):
                    firsts[later] += 1
                out["target"][at], out["letter"][at], out["before"][at] = number[target], letter, before
                before += sizes[number[target]]
                at += 1
            out["bitmap"][s * WORDS : (s + 1) * WORDS] = np.array(bits, np.uint64)
            out["first"][s * WORDS : (s + 1) * WORDS] = firsts
        return cls(out)

    def to_bytes(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, f), kind).tobytes() for f, kind in self.FIELDS.items()]
        return np.array([len(self.final), len(self.target)], "<i8").tobytes() + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        n, m = np.frombuffer(data, "<i8", 2).tolist()
        at, out = 16, {}
        for (f, kind), size in zip(cls.FIELDS.items(), (n * WORDS, n * WORDS, m, m, n, m), strict=True):
            out[f] = np.frombuffer(data, kind, size, at)
            at += out[f].nbytes
        return cls(out)

    def ordinals(self, letters: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Ordinal of each word, -1 if it is no term; ``letters`` are classes of bytes."""
        result = np.full(len(starts), -1, np.int64)
        who, state, sums, at, left = np.arange(len(starts)), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), starts, lens
        one = np.uint64(1)
        while len(who):
            c = letters[at]
            slot, bit = state * WORDS + (c >> 6), (c & 63).astype(np.uint64)
            bits = self.bitmap[slot]
            on = np.flatnonzero((bits >> bit) & one)
            slot, bits, bit = slot[on], bits[on], bit[on]
            arc = self.first[slot] + np.bitwise_count(bits & ((one << bit) - one))
            who, at, left, sums, state = who[on], at[on] + 1, left[on] - 1, sums[on] + self.before[arc], self.target[arc].astype(np.int64)
            ended = left == 0
            if ended.any():
                accepted = ended & (self.final[state] == 1)
                result[who[accepted]] = sums[accepted]
                going = np.flatnonzero(~ended)
                who, at, left, sums, state = who[going], at[going], left[going], sums[going], state[going]
        return result

    def term(self, ordinal: int) -> bytes:
        """The term with an ordinal."""
        state, out = 0, bytearray()
        while ordinal or not self.final[state]:
            begin = int(self.first[state * WORDS])
            n = int(np.bitwise_count(self.bitmap[state * WORDS : (state + 1) * WORDS]).sum())
            arc = begin + int(np.searchsorted(self.before[begin : begin + n], ordinal, "right")) - 1
            ordinal -= int(self.before[arc])
            out.append(self.letter[arc])
            state = int(self.target[arc])
        return bytes(out)


def build_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Automata of sorted (lang, term) rows, at most :data:`SLICE_TERMS` of one language in each."""
    held, lang = [], None

    def flush():
        if held:
            body = Transducer.build(held).to_bytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([held[0]], pa.binary()).cast(pa.string()), pa.array([len(held)], pa.int64()), pa.array([body], pa.binary())],
                names=["lang", "head", "n_terms", "body"],
            )

    for batch in batches:
        for of, term in zip(batch["lang"].to_pylist(), batch["term"].to_pylist(), strict=True):
            if of != lang or len(held) == SLICE_TERMS:
                yield from flush()
                held, lang = [], of
            held.append(term.encode())
    yield from flush()


# ---- recounting


def recounter(slices: list[tuple[str, int, bytes]]):
    """Counts of a load of slices (lang, ordinal of the first term, automaton) per source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = defaultdict(list)
        for lang, offset, body in slices:
            automata[lang].append((offset, Transducer.from_bytes(body)))
        counts: dict = {}  # (lang, source, slice) -> count of each of its terms
        cells = 0

        def flush():
            for (lang, source, number), c in counts.items():
                at = np.flatnonzero(c)
                for i in range(0, len(at), 10_000):
                    part = at[i : i + 10_000]
                    lists = [pa.array([(part + automata[lang][number][0]).tolist()], pa.list_(pa.int64())), pa.array([c[part].tolist()], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([source]), *lists], names=["lang", "source", "ordinals", "counts"])
            counts.clear()

        def count(lang: str, sources: list[str], texts: list[bytes]) -> int:
            """Adds up a block of texts; the number of new cells."""
            letters = CLASS[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
            edges = np.flatnonzero(np.diff((letters >= 0).astype(np.int8), prepend=np.int8(0)))
            starts, lens = edges[::2], edges[1::2] - edges[::2]
            ends = np.cumsum([len(t) + 1 for t in texts])
            names = sorted(set(sources))
            group = np.array([names.index(s) for s in sources])[np.searchsorted(ends, starts, "right")]
            new = 0
            for number, (_, automaton) in enumerate(automata[lang]):
                size = automaton_size(automaton)
                ordinal = automaton.ordinals(letters, starts, lens)
                hit = ordinal >= 0
                keys, times = np.unique(group[hit] * size + ordinal[hit], return_counts=True)
                cuts = np.searchsorted(keys, np.arange(len(names) + 1) * size)
                for g, name in enumerate(names):
                    a, b = cuts[g], cuts[g + 1]
                    if a < b:
                        key = (lang, name, number)
                        if key not in counts:
                            counts[key] = np.zeros(size, np.int64)
                            new += size
                        counts[key][keys[a:b] - g * size] += times[a:b]
            return new

        for batch in batches:
            blocks: dict = defaultdict(lambda: ([], [], [0]))
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"], strict=True):
                if lang not in automata:
                    continue
                t = text.as_py().translate(LOWER)
                sources, texts, size = blocks[lang]
                sources.append(source)
                texts.append(t)
                size[0] += len(t)
                if size[0] > BLOCK_BYTES:
                    cells += count(lang, sources, texts)
                    del blocks[lang]
            for lang, (sources, texts, _) in blocks.items():
                cells += count(lang, sources, texts)
            if cells > HELD_CELLS:
                yield from flush()
                cells = 0
        yield from flush()

    return run


def automaton_size(a: Transducer) -> int:
    """Number of terms: those behind all arcs of the root, and what is before its last one."""
    if not len(a.target):
        return int(a.final[0])
    sizes: dict[int, int] = {}

    def size(state: int) -> int:
        if state not in sizes:
            begin = int(a.first[state * WORDS])
            n = int(np.bitwise_count(a.bitmap[state * WORDS : (state + 1) * WORDS]).sum())
            last = begin + n - 1
            sizes[state] = int(a.before[last]) + size(int(a.target[last])) if n else int(a.final[state])
        return sizes[state]

    return size(0)


def namer(slices: list[tuple[str, int, int, bytes]]):
    """(lang, source, ordinal, value) with their terms, for ordinals in a load of slices (lang, offset, terms, automaton)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [(lang, offset, n, Transducer.from_bytes(body)) for lang, offset, n, body in slices]
        for batch in batches:
            terms = []
            for lang, ordinal in zip(batch["lang"].to_pylist(), batch["ordinal"].to_pylist(), strict=True):
                found = [a.term(ordinal - o) for of, o, n, a in automata if of == lang and o <= ordinal < o + n]
                terms.append(found[0] if found else None)
            t = pa.array(terms, pa.binary()).cast(pa.string())
            kept = pa.RecordBatch.from_arrays([*batch.columns, t], names=[*batch.schema.names, "item"])
            yield kept.filter(t.is_valid())

    return run


# ---- comparison


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * n / total) for n <= total, exact below 9 * 10^15: three digits at a time."""
    out, rest = np.zeros(np.broadcast_shapes(n.shape, total.shape), np.int64), n
    for _ in range(3):
        digit, rest = np.divmod(rest * 1_000, total)
        out = out * 1_000 + digit
    return out + 1


def comparer(totals: dict[str, list[tuple[str, int]]], terms: dict[str, int]):
    """From (lang, ordinal, sources, counts): sums over terms for each pair of sources, and each source's terms above the language.

    ``totals``: words of every source of a language, ``terms``: terms it keeps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        names = {lang: [s for s, _ in of] for lang, of in totals.items()}

        def rows(lang, source, item, ordinal, value):
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = (lang, source, item, ordinal, value)
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["lang", "source", "item", "ordinal", "value"]
            )

        for batch in batches:
            langs = np.array(batch["lang"].to_pylist())
            lists = batch["sources"]
            lens = lists.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(langs)), lens)
            sources, counts = lists.flatten(), batch["counts"].flatten().to_numpy(zero_copy_only=False)
            ordinals = batch["ordinal"].to_numpy(zero_copy_only=False)
            for lang in np.unique(langs).tolist():
                mine = langs == lang
                at = np.flatnonzero(mine[row])
                number = {s: k for k, s in enumerate(names[lang])}
                column = np.array([number[s] for s in sources.take(pa.array(at)).to_pylist()])
                n = np.zeros((mine.sum(), len(number)), np.int64)
                n[(np.cumsum(mine) - 1)[row[at]], column] = counts[at]
                v = terms[lang]
                total = np.array([t for _, t in totals[lang]], np.int64) + SMOOTHING * v
                p = shares(n + SMOOTHING, total)
                whole_lang = np.array([sum(t for _, t in totals[lang])]) + SMOOTHING * v
                over = p - shares(n.sum(1) + SMOOTHING, whole_lang)[:, None]
                if lang not in sums:
                    sums[lang] = np.zeros((len(number), len(number)), np.int64)
                for k in range(len(number)):
                    sums[lang][k] += np.abs(p - p[:, k : k + 1]).sum(0)
                i, k = np.nonzero((n > 0) & (over > 0))
                yield rows([lang] * len(i), [names[lang][x] for x in k], [None] * len(i), ordinals[mine][i], over[i, k])
        for lang, s in sums.items():
            i, k = np.nonzero(~np.eye(len(s), dtype=bool))
            yield rows([lang] * len(i), [names[lang][x] for x in i], [names[lang][x] for x in k], [None] * len(i), s[i, k])

    return run


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of a language differs from the others and from the language.

    Null text, lang and source are ''. A language keeps the terms (runs of ASCII letters, A-Z as a-z, and of
    all characters beyond ASCII) that at least ``least_docs`` of its documents have. With count of N kept words, p = 1 + floor(10^9 (count
    + 5) / (N + 5 V)) for each of the V kept terms. Part ``pair``: the sum of |p - q| over all kept terms for each other source of
    the language, 0 where it keeps none. Part ``term``: the ``top`` terms a source uses more than the
    language as a whole, by p - q. Order: value descending, item ascending by UTF-8 bytes. Repeated rows count as
    often as they occur; an empty table gives no rows; other columns are not read.

    The driver holds one row per source and language, of which the result lists all pairs, and one load of automata.
    Counts are exact up to 9 * 10^15 words of a language.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    d = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))
    found = d.select("lang", "text").mapInArrow(document_terms, "lang string, term string, n bigint")
    kept = found.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least_docs).select("lang", "term")
    kept = stage(kept, "terms")
    ordered = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    slices = stage(
        ordered.mapInArrow(build_slices, "lang string, head string, n_terms bigint, body binary").withColumn("id", F.monotonically_increasing_id()),
        "automata",
    )
    loads, terms = [[]], defaultdict(int)
    room = BROADCAST_BYTES
    for r in slices.select("id", "lang", "head", "n_terms", F.octet_length("body").alias("size")).orderBy("lang", "head").collect():
        if loads[-1] and r["size"] > room:
            loads.append([])
            room = BROADCAST_BYTES
        loads[-1].append((r["id"], r["lang"], terms[r["lang"]], r["n_terms"]))
        room -= r["size"]
        terms[r["lang"]] += r["n_terms"]

    def bodies(load) -> dict[int, bytes]:
        return {r["id"]: bytes(r["body"]) for r in slices.where(F.col("id").isin([x[0] for x in load])).select("id", "body").collect()}

    parts = []
    for load in loads if loads[0] else []:
        body = bodies(load)
        run = recounter([(lang, offset, body[i]) for i, lang, offset, _ in load])
        n = d.mapInArrow(run, "lang string, source string, ordinals array<bigint>, counts array<bigint>")
        n = n.select("lang", "source", F.inline(F.arrays_zip("ordinals", "counts")))
        parts.append(stage(n.groupBy("lang", "source", F.col("ordinals").alias("ordinal")).agg(F.sum("counts").alias("n")), "counts"))
    groups = d.select("lang", "source").distinct()
    pairs = groups.join(groups.withColumnRenamed("source", "item"), "lang").where("source <> item")
    pairs = pairs.select("lang", "source", "item", F.lit(0).cast("bigint").alias("value"))
    by_value = lambda item: F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), item))
    if not parts:
        return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", by_value("item").alias("rank"))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    totals = defaultdict(list)
    used = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    for r in groups.join(used, ["lang", "source"], "left").orderBy("lang", "source").collect():
        totals[r["lang"]].append((r["source"], r["n"] or 0))
    rows = counts.groupBy("lang", "ordinal").agg(F.collect_list(F.struct("source", "n")).alias("by"))
    rows = rows.select("lang", "ordinal", F.col("by.source").alias("sources"), F.col("by.n").alias("counts"))
    compared = rows.mapInArrow(comparer(dict(totals), dict(terms)), "lang string, source string, item string, ordinal bigint, value bigint")
    compared = stage(compared, "compared")
    sums = compared.where("ordinal IS NULL").select("lang", "source", "item", "value").unionByName(pairs)
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    out = sums.select("lang", "source", F.lit("pair").alias("part"), "item", "value", by_value("item").alias("rank"))
    best = compared.where("ordinal IS NOT NULL").select("lang", "source", "ordinal", "value", by_value("ordinal").alias("rank"))
    best = stage(best.where(F.col("rank") <= top), "best")
    for load in loads:
        body = bodies(load)
        named = best.mapInArrow(
            namer([(lang, offset, n, body[i]) for i, lang, offset, n in load]),
            "lang string, source string, ordinal bigint, value bigint, rank int, item string",
        )
        out = out.unionByName(named.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    return out
