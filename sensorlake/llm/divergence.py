"""How the sources of a language differ in their words, by a minimal acyclic transducer of the vocabulary.

A language keeps the terms that enough of its documents hold. Sorted, they become the smallest
acyclic automaton that accepts just them; a number on every edge makes the sum along a path the
term's place in the sorted vocabulary, its ordinal. All texts stream through the automaton to
be counted per source, so terms are small numbers from then on, and ties fall by ordinals, which
ascend as the terms do.

The vocabulary is sorted over all tasks, each of which builds automata of a bounded number of bytes.
What is broadcast at a time has a fixed size: a larger vocabulary takes further passes over the texts
of its languages. Counts, shares and divergences are whole numbers throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.llm.rows import list_array
from sensorlake.llm.words import Words, byte_set, mixed, pieces
from sensorlake.sources.shared import stored

#: ASCII letters and everything outside ASCII.
LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Shares are counted in parts of this.
SCALE = 1_000_000_000
#: Bytes of terms in one automaton, and of automata broadcast at a time.
PART_BYTES, PASS_BYTES = 1 << 20, 32 << 20
#: Counts that a task gathers before it passes them on.
_GATHERED = 1 << 19
#: Bits for an ordinal; a key is the number of a source of a language, and the ordinal of a term.
_ORDINAL_BITS = 40


# --- the transducer -------------------------------------------------------------------------


@dataclass
class Transducer:
    """Edges sorted by state and byte, each with its target and what it adds to the ordinal, as 32-bit numbers."""

    edges: np.ndarray
    target: np.ndarray
    adds: np.ndarray
    final: np.ndarray
    root: int

    @classmethod
    def of(cls, terms: list[bytes]) -> Transducer:
        """The smallest one of sorted, distinct terms, built as they come.

        The states of the last term's path are open. Where the next term leaves that path, the states
        behind are closed, from the end: one like an earlier state becomes that state.
        """
        closed: dict[tuple, int] = {}
        path: list[list] = [[False]]  # whether the state is final, then its bytes and targets in turn
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                state = tuple(path.pop())
                path[-1] += (last[len(path) - 1], closed.setdefault(state, len(closed)))

        for term in terms:
            shared = 0
            for a, b in zip(last, term, strict=False):
                if a != b:
                    break
                shared += 1
            close(shared)
            path += [[False] for _ in range(len(term) - shared)]
            path[-1][0] = True
            last = term
        close(0)
        root = closed.setdefault(tuple(path[0]), len(closed))
        edges, target, adds, reach = [], [], [], []
        # Targets are closed before the states that lead to them.
        for number, state in enumerate(closed):
            below = int(state[0])
            for byte, to in zip(state[1::2], state[2::2], strict=True):
                edges.append(number << 8 | byte)
                target.append(to)
                adds.append(below)
                below += reach[to]
            reach.append(below)
        whole = [np.array(x, dtype="<u4") for x in (edges, target, adds)]
        return cls(*whole, np.array([state[0] for state in closed]), root)

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place of each word ``data[start:end]`` among the terms, -1 for other words; all words walk in step."""
        out = np.full(starts.size, -1, dtype=np.int64)
        word, state, place, sums = np.arange(starts.size), np.full(starts.size, self.root, dtype=np.uint32), starts.copy(), np.zeros(starts.size, np.int64)
        while word.size:
            over = place == ends[word]
            accepted = over & self.final[state]
            out[word[accepted]] = sums[accepted]
            word, state, place, sums = (x[~over] for x in (word, state, place, sums))
            if not word.size or not self.edges.size:
                break
            wanted = state << np.uint32(8) | data[place]
            edge = np.minimum(np.searchsorted(self.edges, wanted), self.edges.size - 1)
            known = self.edges[edge] == wanted
            word, edge = word[known], edge[known]
            state, place, sums = self.target[edge], place[known] + 1, sums[known] + self.adds[edge]
        return out

    def packed(self) -> dict[str, bytes]:
        return {
            "edges": self.edges.tobytes(), "target": self.target.tobytes(), "adds": self.adds.tobytes(),
            "final": self.final.astype(bool).tobytes(), "root": self.root,
        }

    @classmethod
    def unpacked(cls, row) -> Transducer:
        numbers = (np.frombuffer(row[name], dtype="<u4") for name in ("edges", "target", "adds"))
        return cls(*numbers, np.frombuffer(row["final"], dtype=bool), row["root"])


def _separator(before: bytes, first: bytes) -> bytes:
    """The shortest beginning of ``first`` that sorts behind ``before``."""
    same = next((i for i, (a, b) in enumerate(zip(before, first, strict=False)) if a != b), min(len(before), len(first)))
    return first[: same + 1]


class Vocabulary:
    """The parts of one language that are broadcast together, and their ordinals' beginnings."""

    def __init__(self, rows: list):
        self.parts = [Transducer.unpacked(row) for row in rows]
        self.base = [row["base"] for row in rows]
        cuts = [_separator(a["last"].encode(), b["first"].encode()) for a, b in zip(rows[:-1], rows[1:], strict=True)]
        self.cuts = np.array(cuts, dtype=bytes)

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        part = self._part_of(data, starts, ends)
        out = np.full(starts.size, -1, dtype=np.int64)
        for number in np.unique(part):
            own = np.flatnonzero(part == number)
            found = self.parts[number].ordinals(data, starts[own], ends[own])
            out[own] = np.where(found >= 0, found + self.base[number], -1)
        return out

    def _part_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The part that a word would lie in, told by its first bytes."""
        out = np.zeros(starts.size, dtype=np.int64)
        if not self.cuts.size:
            return out
        width = self.cuts.dtype.itemsize
        step = max(1, (8 << 20) // width)
        for i in range(0, starts.size, step):
            place = starts[i : i + step, None] + np.arange(width)
            shown = np.where(place < ends[i : i + step, None], data[np.minimum(place, data.size - 1)], 0).astype(np.uint8)
            out[i : i + step] = np.searchsorted(self.cuts, shown.view(f"S{width}").ravel(), side="right")
        return out


# --- the vocabulary -------------------------------------------------------------------------


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lengths = ends - starts
    bounds = np.zeros(starts.size + 1, dtype=np.int64)
    np.cumsum(lengths, out=bounds[1:])
    place = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], lengths)
    return pa.Array.from_buffers(pa.large_string(), starts.size, [None, pa.py_buffer(bounds), pa.py_buffer(data[place])]).cast(pa.string())


def _codes(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    encoded = column.fill_null("").dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.to_pylist()


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): how many of a slice's documents of a language hold a term."""
    for piece in pieces(batches, "text"):
        words = Words.of(piece.column("text"), LETTERS, lower=True)
        lang, names = _codes(piece.column("lang"))
        _, once = np.unique(mixed(words.hashes ^ mixed(words.text_of.astype(np.uint64))), return_index=True)
        spoken = lang[words.text_of[once]]
        _, one, n = np.unique(mixed(words.hashes[once] ^ mixed(spoken.astype(np.uint64))), return_index=True, return_counts=True)
        word = once[one]
        term = _strings(words.data, words.starts[word], words.ends[word])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(spoken[one])), term, pa.array(n)], ["lang", "term", "n"])


_PART = "lang string, first string, last string, n long, terms array<string>, edges binary, target binary, adds binary, final binary, root long"


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Automata of the sorted rows (lang, term), each of one language and of a bounded number of bytes."""

    def part(lang: str, terms: list[str]) -> pa.RecordBatch:
        row = {"lang": lang, "first": terms[0], "last": terms[-1], "n": len(terms), **Transducer.of([t.encode() for t in terms]).packed()}
        columns = {name: pa.array([value]) for name, value in row.items()} | {"terms": list_array(pa.array(terms, pa.string()), [len(terms)])}
        names = [field.split()[0] for field in _PART.split(", ")]
        return pa.RecordBatch.from_arrays([columns[name] for name in names], names)

    lang, terms, size = "", [], 0
    for batch in batches:
        for said, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist(), strict=True):
            if terms and (said != lang or size >= PART_BYTES):
                yield part(lang, terms)
                terms, size = [], 0
            lang = said
            terms.append(term)
            size += len(term.encode())
    if terms:
        yield part(lang, terms)


def vocabulary(docs: DataFrame, least: int) -> DataFrame:
    """The parts of every language's sorted vocabulary of (lang, text)."""
    counted = docs.mapInArrow(_document_counts, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    kept = stored(counted.where(F.col("n") >= least).select("lang", "term"))
    size = kept.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    ordered = kept.repartitionByRange(1 + size // PART_BYTES, "lang", "term").sortWithinPartitions("lang", "term")
    return stored(ordered.mapInArrow(_built, _PART))


@dataclass
class Place:
    """A part of the vocabulary: the ordinal of its first term, its number of terms, and its size in bytes.

    Ordinals run through all languages, in the order of language and term.
    """

    lang: str
    first: str
    base: int
    n: int
    size: int


def places(parts: DataFrame) -> list[Place]:
    """The parts in order. A part holds ``PART_BYTES`` of terms, so their number is small."""
    size = F.octet_length("edges") * 3 + F.octet_length("final")
    out: list[Place] = []
    for row in parts.select("lang", "first", "n", size.alias("size")).orderBy("lang", "first").collect():
        base = out[-1].base + out[-1].n if out else 0
        out.append(Place(row["lang"], row["first"], base, row["n"], row["size"]))
    return out


# --- counting -------------------------------------------------------------------------------


def _passes(found: list[Place]) -> list[list[Place]]:
    """The parts that are broadcast together: of ``PASS_BYTES``, or one."""
    out: list[list[Place]] = []
    total = 0
    for place in found:
        if not out or total + place.size > PASS_BYTES:
            out.append([])
            total = 0
        out[-1].append(place)
        total += place.size
    return out


def _recounted(known: dict[str, Vocabulary], group_of: dict[tuple[str, str], int]):
    """(key, n): how often the known terms of its language occur in a source's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[np.ndarray, np.ndarray]] = []

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(gathered)], ["key", "n"])

        for piece in pieces(batches, "text"):
            words = Words.of(piece.column("text"), LETTERS, lower=True)
            lang, langs = _codes(piece.column("lang"))
            source, sources = _codes(piece.column("source"))
            pair, pair_of = np.unique(lang * len(sources) + source, return_inverse=True)
            group = np.array([group_of[langs[p // len(sources)], sources[p % len(sources)]] for p in pair.tolist()], dtype=np.int64)
            spoken = lang[words.text_of]
            # Equal words of a language walk once.
            _, one, same = np.unique(mixed(words.hashes ^ mixed(spoken.astype(np.uint64))), return_index=True, return_inverse=True)
            ordinal = np.full(one.size, -1, dtype=np.int64)
            for code, name in enumerate(langs):
                own = np.flatnonzero(spoken[one] == code)
                if name in known and own.size:
                    ordinal[own] = known[name].ordinals(words.data, words.starts[one[own]], words.ends[one[own]])
            place = ordinal[same]
            hit = np.flatnonzero(place >= 0)
            gathered.append(np.unique(group[pair_of[words.text_of[hit]]] << _ORDINAL_BITS | place[hit], return_counts=True))
            if sum(keys.size for keys, _ in gathered) > _GATHERED:
                gathered[:] = [_merged(gathered)]
                if gathered[0][0].size > _GATHERED // 2:
                    yield told()
                    gathered.clear()
        if gathered:
            yield told()

    return run


def _merged(gathered: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([keys for keys, _ in gathered])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([counts for _, counts in gathered])[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if keys.size else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if first.size else counts


def recounted(docs: DataFrame, parts: DataFrame, found: list[Place], groups: list[tuple[str, str]]) -> DataFrame:
    """(source, ordinal, n) over all documents, n above 0; ``source`` is a place in ``groups``."""
    spark = docs.sparkSession
    group_of = spark.sparkContext.broadcast({group: i for i, group in enumerate(groups)})
    counted = spark.createDataFrame([], "key long, n long")
    for together in _passes(found):
        bases = {(place.lang, place.first): place.base for place in together}
        langs = sorted({place.lang for place in together})
        low, high = (F.struct(F.lit(p.lang).alias("lang"), F.lit(p.first).alias("first")) for p in (together[0], together[-1]))
        rows = parts.where(F.struct("lang", "first").between(low, high)).drop("terms").orderBy("lang", "first").collect()
        packed = [row.asDict() | {"base": bases[row["lang"], row["first"]]} for row in rows]
        known = spark.sparkContext.broadcast({lang: [row for row in packed if row["lang"] == lang] for lang in langs})

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            return _recounted({lang: Vocabulary(part) for lang, part in known.value.items()}, group_of.value)(batches)

        counted = counted.unionByName(docs.where(F.col("lang").isin(langs)).mapInArrow(run, "key long, n long"))
    whole = counted.groupBy("key").agg(F.sum("n").alias("n"))
    return whole.select(F.shiftright("key", _ORDINAL_BITS).alias("source"), F.col("key").bitwiseAND((1 << _ORDINAL_BITS) - 1).alias("ordinal"), "n")


# --- divergences ----------------------------------------------------------------------------


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exact at any count."""
    over = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return (F.call_function("div", over, (total + terms).cast("decimal(20,0)")) + 1).cast("long")


def scaled(above: np.ndarray, below: np.ndarray) -> np.ndarray:
    """floor(SCALE * above / below) for ``above <= below < 9e15``, three digits at a time so that nothing overflows."""
    out = np.zeros(np.broadcast(above, below).shape, dtype=np.int64)
    rest = above
    for _ in range(3):
        part, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + part
    return out


@dataclass
class Sources:
    """The sources in the order of language and name: where each language's begin and end, and each one's N + V."""

    begin: np.ndarray
    end: np.ndarray
    below: np.ndarray


def _pair_sums(sources: Sources):
    """(one, other, value): parts of the divergence of two sources.

    Rows hold a term's counts in the sources that have it; the others of its language count 0. A task
    keeps a table of sums for languages of up to 1,024 sources, and passes on those of each block of terms
    for others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}

        def told(begin: int, one: int, sums: np.ndarray) -> pa.RecordBatch:
            other = np.flatnonzero(sums)
            return pa.RecordBatch.from_arrays([pa.array(np.full(other.size, begin + one)), pa.array(begin + other), pa.array(sums[other])], ["one", "other", "value"])

        for batch in batches:
            lists = batch.column("counts")
            bounds = lists.offsets.to_numpy()
            # Every term has a source; the first tells the language.
            lang = sources.begin[lists.flatten().field("source").to_numpy()[bounds[:-1] - bounds[0]]]
            for begin in np.unique(lang).tolist():
                size = int(sources.end[begin]) - begin
                below = sources.below[begin : begin + size]
                rows = lists.filter(pa.array(lang == begin))
                step = max(1, (1 << 18) // size)
                for i in range(0, len(rows), step):
                    block = rows.slice(i, step)
                    flat = block.flatten()
                    count = np.zeros((len(block), size), dtype=np.int64)
                    row = np.repeat(np.arange(len(block)), np.diff(block.offsets.to_numpy()))
                    count[row, flat.field("source").to_numpy() - begin] = flat.field("n").to_numpy()
                    p = 1 + scaled(count + 1, below)
                    for one in range(size):
                        apart = p[:, one, None] - p
                        sums = (apart * apart // p).sum(axis=0)
                        if size > 1024:
                            yield told(begin, one, sums)
                        else:
                            kept.setdefault(begin, np.zeros((size, size), dtype=np.int64))[one] += sums
        for begin, table in kept.items():
            for one in range(len(table)):
                yield told(begin, one, table[one])

    return run


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets the sources of a language apart.

    Null texts, languages and sources are empty strings. A language keeps the terms, runs of letters in lower
    case, that at least ``least`` of its documents hold. Each source of a language, and the language
    itself, gives a kept term the share p = 1 + floor(10^9 (n + 1) / (N + V)) of its n occurrences among N of the
    V kept terms. The divergence of p from q is floor((p - q)^2 / q). Part ``pair``: every other source,
    with the divergence summed over all kept terms, 0 where none are kept; all ranks. Part ``term``: the terms that the
    source has and prefers to its language, with theirs; ranks to ``top``. Ranks run by falling value, then by item.
    Documents count as often as they stand there. Further columns are ignored; no rows give no rows.

    The names of the sources come to the driver: the result has a row for every two of a language, so they
    are far fewer than its rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(text).alias("text"), F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source"))
    parts = vocabulary(docs.select("lang", "text"), least)
    found = places(parts)
    groups = [(row["lang"], row["source"]) for row in docs.select("lang", "source").distinct().orderBy("lang", "source").collect()]
    # A row per kept term: its counts in the sources that have it.
    gathered = F.collect_list(F.struct("source", "n")).alias("counts")
    terms = stored(recounted(docs, parts, found, groups).groupBy("ordinal").agg(gathered, F.sum("n").alias("n")))
    totals = {row["source"]: row["total"] for row in terms.select(F.inline("counts")).groupBy("source").agg(F.sum("n").alias("total")).collect()}
    kept = {place.lang: 0 for place in found}
    for place in found:
        kept[place.lang] += place.n
    whole = {spoken: 0 for spoken, _ in groups}
    for number, (spoken, _) in enumerate(groups):
        whole[spoken] += totals.get(number, 0)
    named = [(i, spoken, name, totals.get(i, 0), kept.get(spoken, 0), whole[spoken]) for i, (spoken, name) in enumerate(groups)]
    sizes = spark.createDataFrame(named, "number long, lang string, source string, total long, terms long, lang_total long")
    return _pairs(terms, sizes, named).unionByName(_terms(terms, sizes, parts, found, top))


def _ranked(rows: DataFrame, by: list[str], item: str) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("value"), item)))


def _terms(terms: DataFrame, sizes: DataFrame, parts: DataFrame, found: list[Place], top: int) -> DataFrame:
    counts = terms.select("ordinal", F.col("n").alias("lang_n"), F.inline("counts")).withColumnRenamed("source", "number")
    known = counts.join(sizes.select("number", "total", "terms", "lang_total"), "number")
    shares = known.select(
        "number", "ordinal",
        _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    ).where("p > q")
    # Ordinals ascend as terms do.
    best = _ranked(shares.selectExpr("number", "ordinal", "(p - q) * (p - q) div q AS value"), ["number"], "ordinal").where(F.col("rank") <= top)
    bases = parts.sparkSession.createDataFrame([(place.lang, place.first, place.base) for place in found], "lang string, first string, base long")
    listed = parts.select("lang", "first", "terms").join(bases, ["lang", "first"]).select("base", F.posexplode("terms").alias("nth", "item"))
    names = listed.select((F.col("base") + F.col("nth")).alias("ordinal"), "item")
    told = best.join(names, "ordinal").join(sizes.select("number", "lang", "source"), "number")
    return told.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pairs(terms: DataFrame, sizes: DataFrame, named: list[tuple]) -> DataFrame:
    langs = [row[1] for row in named]
    begin = np.zeros(len(langs), dtype=np.int64)
    for i in range(1, len(langs)):
        begin[i] = begin[i - 1] if langs[i] == langs[i - 1] else i
    end = np.searchsorted(begin, begin, side="right")
    shared = terms.sparkSession.sparkContext.broadcast(Sources(begin, end, np.array([row[3] + row[4] for row in named], dtype=np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pair_sums(shared.value)(batches)

    sums = terms.select("counts").mapInArrow(run, "one long, other long, value long").groupBy("one", "other").agg(F.sum("value").alias("value"))
    one = sizes.select("lang", "source", F.col("number").alias("one"))
    other = sizes.select("lang", F.col("source").alias("item"), F.col("number").alias("other"))
    both = one.join(other, "lang").where("one <> other").join(sums, ["one", "other"], "left")
    ranked = _ranked(both.withColumn("value", F.coalesce("value", F.lit(0).cast("long"))), ["lang", "source"], "item")
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
