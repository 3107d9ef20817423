"""Personal data: base patterns, and terms that give the protected values away.

Base spans come from four patterns. Beyond them, terms near a protected value (within ``NEAR``
words) are weighed by what the whole corpus says about both. With N windows of text, a value e has
the information content IC(e) = -log p(e), and a term w tells PMI(w; e) = log p(e | w) - log p(e)
of it, where p(e | w) is the share of all occurrences of w that lie near e, drawn to p(e) with the
weight of ``PRIOR`` contexts, so that values with one or two contexts are judged as well, by weaker
evidence. A term is generalised where PMI reaches ``GENERALISE`` of IC(e), and removed where it
reaches ``REMOVE``. Contexts are counted by content, so that copies
are no evidence; occurrences are counted, and the found terms marked, over all documents.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from sensorlake.llm.bits import BitTable
from sensorlake.llm.rows import annotate, list_array, set_aside
from sensorlake.llm.words import ALPHANUMERIC, Words, column_bytes, pieces
from sensorlake.sources.shared import stored

NEAR = 12
PRIOR = 2.0
GENERALISE = 0.9
REMOVE = 0.98
TABLE_BITS = 24

#: Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def emails(text: str) -> Iterator[Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` in linear time.

    A local part ends at its ``@`` and cannot contain one, so it is looked up backwards from there.
    """
    bound, at = 0, text.find("@")
    while at >= 0:
        before = text[bound:at]
        start = bound + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
        bound = domain.end() if domain else at + 1
        at = text.find("@", bound)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def addresses(text: str) -> Iterator[Span]:
    # A match that starts inside a run of digits would also start at the run's first digit.
    for m in _IP.finditer(text):
        if all(map(_small, m.groups())):
            yield "ip", m.start(), m.end()


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield "phone", m.start(), m.end()


def base_spans(text: str) -> list[Span]:
    """Spans by kind as listed in ``KINDS``, then by start; code points, end exclusive."""
    return [*emails(text), *addresses(text), *cards(text), *phones(text)]


def _value(kind: str, said: str) -> str:
    """A protected value however it is written."""
    return f"{kind}:{said.lower() if kind == 'email' else _NOT_DIGIT.sub('.' if kind == 'ip' else '', said)}"


class _Cover:
    """The places that spans cover, to ask whether another range touches one."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray):
        order = np.argsort(starts, kind="stable")
        self._starts, self._reach = starts[order], np.maximum.accumulate(ends[order]) if ends.size else ends

    def touches(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of the spans that begin before a range ends, the furthest end lies behind its start."""
        before = np.searchsorted(self._starts, ends, side="left")
        return (before > 0) & (np.append(0, self._reach)[before] > starts)


class _Near:
    """Terms within ``NEAR`` words of a span of one text, outside all spans: letters, three characters at least.

    Words are found once per text, however many spans it has. One that runs into a span ends, or begins, there.
    """

    def __init__(self, text: str, spans: list[Span]):
        self._text = text
        words = np.array([m.span() for m in _WORD.finditer(text)], dtype=np.int64).reshape(-1, 2)
        self._starts, self._ends = words[:, 0].tolist(), words[:, 1].tolist()
        places = np.array([span[1:] for span in spans], dtype=np.int64).reshape(-1, 2)
        self._free = (~_Cover(places[:, 0], places[:, 1]).touches(words[:, 0], words[:, 1])).tolist()
        self._cover = _Cover(places[:, 0], places[:, 1])

    def of(self, span: Span) -> list[tuple[str, int]]:
        _, start, end = span
        last, first = bisect_left(self._starts, start), bisect_right(self._ends, end)
        near = [(self._starts[i], min(self._ends[i], start), i) for i in range(max(0, last - NEAR), last)]
        near += [(max(self._starts[i], end), self._ends[i], i) for i in range(first, min(first + NEAR, len(self._ends)))]
        return [(self._text[s:e], s) for s, e, i in near if e - s >= 3 and self._outside(s, e, i) and not self._text[s:e].isdigit()]

    def _outside(self, start: int, end: int, word: int) -> bool:
        if self._free[word]:
            return True
        return not self._cover.touches(np.array([start]), np.array([end]))[0]


_SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
_NEAR_TERM = StructType([StructField("value", LongType()), StructField("context", LongType()), StructField("word", LongType())])
_SAID = StructType([StructField("word", LongType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
#: Names of the columns this module makes.
_OWN = ("pii_base", "pii_said", "pii_row", "pii_spans")
_NEAR = [StructField("pii_terms", ArrayType(_NEAR_TERM)), StructField("pii_words", LongType())]
_FOUND = [StructField("pii_base", ArrayType(_SPAN)), StructField("pii_said", ArrayType(_SAID))]


def _hashes(texts: list[str]) -> np.ndarray:
    """Hashes of whole strings, none of them empty, in lower case, as ``_words`` hashes a word of that spelling."""
    words = Words.of(pc.utf8_lower(pa.array(texts, pa.large_string())), np.ones(256, dtype=bool))
    return words.hashes.view(np.int64)


def _words(texts: pa.Array) -> Words:
    """Words in lower case; it keeps the number of code points."""
    return Words.of(pc.utf8_lower(texts), ALPHANUMERIC)


def _structs(kind: StructType, *columns) -> pa.Array:
    """Rows of a struct from its columns."""
    fields = to_arrow_schema(kind)
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], fields=list(fields))


def _scan(piece: pa.RecordBatch, text: str) -> dict[str, pa.Array]:
    names, contexts, words, counts, lengths = [], [], [], [], []
    for said in piece.column(text).to_pylist():
        spans = base_spans(said) if said else []
        before, met = len(words), set()
        near = _Near(said, spans) if spans else None
        for span in spans:
            name = _value(span[0], said[span[1] : span[2]])
            found = near.of(span)
            # An occurrence near two spans of one value is one piece of evidence.
            fresh = [w for w, at in found if (name, at) not in met]
            met.update((name, at) for _, at in found)
            if fresh:
                names.append(name)
                contexts.append(" ".join(w for w, _ in found))
                words += fresh
                counts.append(len(fresh))
        lengths.append(len(words) - before)
    value, context = (np.repeat(_hashes(texts), counts) for texts in (names, contexts))
    return {
        "pii_terms": list_array(_structs(_NEAR_TERM, value, context, _hashes(words)), lengths),
        "pii_words": pa.array(_words(piece.column(text)).counts),
    }


def _mark(piece: pa.RecordBatch, text: str, table: BitTable | None) -> dict[str, pa.Array]:
    """Base spans, and the words outside them that ``table`` may hold."""
    base = [base_spans(said) if said else [] for said in piece.column(text).to_pylist()]
    flat = [span for spans in base for span in spans]
    places = np.array([span[1:] for span in flat], dtype=np.int64).reshape(-1, 2)
    n_base = np.array([len(spans) for spans in base], dtype=np.int64)
    word = start = end = np.zeros(0, dtype=np.int64)
    n_said = np.zeros(len(base), dtype=np.int64)
    if table is not None:
        words = _words(piece.column(text))
        # Code points ahead of each byte, and of each text.
        points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
        _, bounds = column_bytes(pc.utf8_lower(piece.column(text)))
        ahead = points[bounds][:-1]
        of_text = np.repeat(ahead, n_base)
        at = np.flatnonzero(table.holds(words.hashes))
        start, end = points[words.starts[at]], points[words.ends[at]]
        free = ~_Cover(places[:, 0] + of_text, places[:, 1] + of_text).touches(start, end)
        at, start, end = at[free], start[free], end[free]
        own = words.text_of[at]
        word, start, end = words.hashes[at].view(np.int64), start - ahead[own], end - ahead[own]
        n_said = np.bincount(own, minlength=len(base))
    return {
        "pii_base": list_array(_structs(_SPAN, [k for k, _, _ in flat], places[:, 0], places[:, 1]), n_base),
        "pii_said": list_array(_structs(_SAID, word, start, end), n_said),
    }


def _occurrences(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(word, n) over all documents for the wanted word hashes."""
    table = docs.sparkSession.sparkContext.broadcast(BitTable.of(wanted.select(F.col("word").alias("h")), TABLE_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            words = _words(piece.column(text))
            known, counts = np.unique(words.hashes[table.value.holds(words.hashes)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "n"])

    return docs.select(text).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _disclosures(docs: DataFrame, text: str) -> DataFrame | None:
    """(word, told): the largest share of a value's information that the word gives, where at least ``GENERALISE``."""
    rows = stored(annotate(docs.select(text), text, _NEAR, lambda piece: _scan(piece, text), []))
    near = rows.select(F.explode("pii_terms").alias("t")).select("t.value", "t.context", "t.word")
    windows = max((rows.agg(F.sum("pii_words")).first()[0] or 0) / (2 * NEAR), 1.0)
    values = near.select("value", "context").distinct().groupBy("value").agg(F.count("*").alias("value_n"))
    share = F.least(F.col("value_n") / F.lit(windows), F.lit(0.5))

    def told(given: Column) -> Column:
        """Of the value's information, the share that a word gives whose occurrences lie near it by the share ``given``."""
        drawn = (F.col("contexts") * given + PRIOR * share) / (F.col("contexts") + PRIOR)
        return (F.log(drawn) - F.log(share)) / -F.log(share)

    # Contexts are counted by content, and a word twice in one context is one piece of evidence.
    seen = near.groupBy("value", "context", "word").agg(F.count("*").alias("n"))
    pairs = seen.groupBy("value", "word").agg(F.count("*").alias("contexts"), F.sum("n").alias("together")).join(values, "value")
    # No word tells more than one that occurs near the value alone.
    pairs = stored(pairs.where(told(F.lit(1.0)) >= GENERALISE))
    if pairs.isEmpty():
        return None
    counts = _occurrences(docs, text, pairs.select("word").distinct())
    given = F.least(F.col("together") / F.col("n"), F.lit(1.0))
    found = pairs.join(counts, "word").withColumn("told", told(given)).where(F.col("told") >= GENERALISE)
    return stored(found.groupBy("word").agg(F.max("told").alias("told")))


def with_spans(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``pii_spans``: kind, start, end and, for terms, ``told``.

    Base spans by kind as listed, then by start, then terms by start. Offsets are code points, end
    exclusive. A null or empty text has none. Repeated rows have the same spans. Columns named
    ``pii_base``, ``pii_said``, ``pii_row`` or ``pii_spans`` are replaced.
    """
    own = [c for c in (docs.columns if keep is None else keep) if c.lower() not in _OWN]
    carried = docs.select(*dict.fromkeys([*own, text]))
    told = _disclosures(docs, text)
    # All texts are read again: a word that tells a value is marked wherever it stands.
    table = None if told is None else docs.sparkSession.sparkContext.broadcast(BitTable.of(told.select(F.col("word").alias("h")), TABLE_BITS))
    rows = annotate(carried, text, _FOUND, lambda piece: _mark(piece, text, None if table is None else table.value), own)
    shown = "array<struct<kind:string,start:int,end:int,told:double>>"
    base = F.transform("pii_base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(None).cast("double").alias("told")))
    if told is None:
        return stored(rows).withColumn("pii_spans", base.cast(shown)).select(*own, "pii_spans")
    rows = stored(rows.withColumn("pii_row", F.monotonically_increasing_id()))
    said = rows.select("pii_row", F.explode("pii_said").alias("t")).select("pii_row", "t.*")
    most = said.join(told, "word").select("pii_row", F.struct(F.lit(TERM).alias("kind"), "start", "end", "told").alias("term"))
    terms = most.groupBy("pii_row").agg(F.array_sort(F.collect_list("term")).alias("found"))
    # Only rows with such a word can have any of these, and are shuffled with their texts.
    plain = rows.where(F.size("pii_said") == 0).withColumn("pii_spans", base.cast(shown))
    joined = rows.where(F.size("pii_said") > 0).join(terms, "pii_row", "left")
    spans = F.concat(base.cast(shown), F.coalesce(F.col("found").cast(shown), F.array().cast(shown)))
    return plain.select(*own, "pii_spans").unionByName(joined.withColumn("pii_spans", spans).select(*own, "pii_spans"))


def _instead(span: dict, said: str) -> str:
    if span["kind"] != TERM:
        return f"<{span['kind'].upper()}>"
    return "" if span["told"] >= REMOVE else general(said[span["start"] : span["end"]])


def general(term: str) -> str:
    """What kind of word a term is, in its place: its letters go, its shape stays."""
    if any(c.isdigit() for c in term):
        return "<CODE>"
    if len(term) > 1 and term.isupper():
        return "<ACRONYM>"
    return "<NAME>" if term[:1].isupper() else "<WORD>"


def sanitised(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced by its kind in angle brackets.

    Terms that tell a protected value are replaced by their shape, as ``general`` has it, or removed where
    they tell nearly all of it. Where spans overlap, the first, then the longest, is replaced and the rest of the
    others goes with it. ``length`` names a column that holds the text's length in code points.
    All other columns come back as they were.
    """

    def run(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        out = []
        for said, spans in zip(piece.column(text).to_pylist(), piece.column("pii_spans").to_pylist(), strict=True):
            if spans:
                parts, at = [], 0
                for span in sorted(spans, key=lambda s: (s["start"], -s["end"], s["kind"])):
                    if span["start"] >= at:
                        parts += [said[at : span["start"]], _instead(span, said)]
                    at = max(at, span["end"])
                said = "".join([*parts, said[at:]])
            out.append(said)
        return {text: pa.array(out, pa.string())}

    docs, own = set_aside(docs, _OWN)
    result = annotate(with_spans(docs, text), text, [StructField(text, StringType())], run)
    if length:
        result = result.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return result.select(*own)
