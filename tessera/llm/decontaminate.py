r"""Operator 13: benchmark decontamination with one Aho-Corasick automaton.

Benchmark questions and answers are normalised to words (A-Z lower-cased, runs
of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``); every window of 10 consecutive words is
a pattern, and an item with fewer words is one pattern as a whole.  All
patterns go into one automaton over word numbers.  A task scans each whole text
of ``documents`` once: words are found and numbered with numpy on the UTF-8
bytes (a word that no pattern holds is number 0, which no pattern matches), the
texts of a slice lie one behind the other with a 0 between them, and every
match is mapped back to words and to code points of the original text.

Words are compared by length and a 64-bit hash of their bytes.

The automaton is broadcast, so its size is checked: up to ``MAX_WINDOWS``
windows go into one; a larger set of distinct windows is dealt by hash into
parts, and the documents are scanned once for each part, carrying the words
hit and the items found so far.

Defined results: a null or empty text has no words and is not contaminated; an
item without words has no window; items with a null id count as one item with
the empty string as its id; items that share an id are one item with the
windows of all; repeated documents get a row each; null doc_ids stay null; an
empty benchmark leaves every document clean; an empty ``documents`` gives an
empty result; :func:`contamination` ignores extra columns, :func:`masked` keeps
them whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import materialise
from tessera.llm.textbytes import IS_WORDY, LOWER, SpanHash, slices, spans, utf8

WINDOW = 10
#: Windows of one automaton: about a million states.
MAX_WINDOWS = 100_000

#: The state that a scan adds to a document: its number of words, the hit words
#: (runs, as word numbers and as code points) and the distinct item ids as text.
STATE = ("n_words long, hit_first array<long>, hit_end array<long>, "
         "char_first array<long>, char_end array<long>, items array<string>")


def words(raw: np.ndarray, offsets: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, hash of every word, and the words of each text."""
    starts, ends, per_text = spans(raw, offsets, IS_WORDY)
    return starts, ends, SpanHash(LOWER[raw])(starts, ends), per_text


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(w, item): distinct windows, a window as the hashes and byte lengths of
    its words (16 bytes a word), with the id of an item that holds it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in slices(batch.column(1)):
                first, end, h, per_text = words(*utf8(batch.column(1).slice(start, n)))
                coded = np.empty((len(h), 2), "<u8")
                coded[:, 0], coded[:, 1] = h, end - first
                items = batch.column(0).slice(start, n).to_pylist()
                found: set[tuple[bytes, str]] = set()
                at = 0
                for item, count in zip(items, per_text.tolist()):
                    for i in range(min(count, 1) if count < size else count - size + 1):
                        found.add((coded[at + i:at + min(count, i + size)].tobytes(), item or ""))
                    at += count
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in found], pa.binary()),
                     pa.array([i for _, i in found], pa.string())], names=["w", "item"])

    return (benchmark.select(F.col("item_id").cast("string"), "text")
            .mapInArrow(run, "w binary, item string").distinct())


class Patterns:
    """The automaton and what its windows stand for."""

    def __init__(self, rows: list[tuple[bytes, str]]):
        rows = sorted(rows)
        keys = sorted({w for w, _ in rows})
        number = {w: i for i, w in enumerate(keys)}
        self.items = sorted({i for _, i in rows})
        place = {x: i for i, x in enumerate(self.items)}
        # Items of window k: held[cut[k]:cut[k + 1]].
        self.held = np.array([place[i] for _, i in rows], np.int64)
        self.cut = np.searchsorted([number[w] for w, _ in rows], np.arange(len(keys) + 1))
        coded = [np.frombuffer(w, "<u8").reshape(-1, 2) for w in keys]
        self.length = np.array([len(c) for c in coded], np.int64)
        every = np.concatenate(coded) if coded else np.zeros((0, 2), np.uint64)
        self.vocabulary, first = np.unique(every[:, 0], return_index=True)
        self.bytes = every[first, 1].astype(np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        pairs, singles = {0}, set()
        for k, c in enumerate(coded):
            key = (np.searchsorted(self.vocabulary, c[:, 0]) + 1).tolist()
            self.automaton.add_word(tuple(key), k)
            pairs.update(a * (len(self.vocabulary) + 1) + b for a, b in zip(key, key[1:]))
            singles.update(key if len(key) == 1 else ())
        if coded:
            self.automaton.make_automaton()
        self.pairs = np.array(sorted(pairs), np.int64)       # 0: the pair of two zeros
        self.singles = np.array(sorted(singles), np.int64)

    def numbers(self, h: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Word numbers from 1; 0 for words that no window holds."""
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where((self.vocabulary[at] == h) & (self.bytes[at] == length), at + 1, 0)

    def in_question(self, row: np.ndarray) -> np.ndarray:
        """Marks the words that a window can cover: single-word windows, and
        words whose pair with a neighbour stands in some window."""
        pair = row[:-1] * (len(self.vocabulary) + 1) + row[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        known = (self.pairs[at] == pair) & (pair > 0)
        out = np.isin(row, self.singles)
        out[:-1] |= known
        out[1:] |= known
        return out

    def scan(self, raw: np.ndarray, offsets: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        """Words of each text, hit mark of every word, item ids of each text."""
        first, end, h, per_text = words(raw, offsets)
        hit, found = np.zeros(len(h), bool), [[] for _ in per_text]
        if not len(h) or not len(self.length):
            return per_text, hit, found
        text = np.repeat(np.arange(len(per_text)), per_text)
        row = np.zeros(len(h) + len(per_text), np.int64)     # a 0 between two texts
        row[np.arange(len(h)) + text] = self.numbers(h, end - first)
        # Runs of words in question, each with a 0 behind it, go through the automaton.
        kept = self.in_question(row)
        row[~kept] = 0
        kept[1:] |= kept[:-1]
        at = np.flatnonzero(kept)
        matches = np.array(list(self.automaton.iter(tuple(row[at].tolist()))),
                           np.int64).reshape(-1, 2)
        if not len(matches):
            return per_text, hit, found
        word_at = np.zeros(len(row), np.int64)
        word_at[np.arange(len(h)) + text] = np.arange(len(h))
        last, window = word_at[at[matches[:, 0]]], matches[:, 1]
        edge = np.zeros(len(h) + 1, np.int64)
        np.add.at(edge, last - self.length[window] + 1, 1)
        np.add.at(edge, last + 1, -1)
        hit = np.cumsum(edge[:-1]) > 0
        met = np.unique(np.stack([text[last], window], 1), axis=0)
        for t, group in zip(*_groups(met)):
            ids = np.unique(np.concatenate([self.held[self.cut[k]:self.cut[k + 1]] for k in group]))
            found[t] = [self.items[i] for i in ids.tolist()]
        return per_text, hit, found


def _groups(pairs: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Rows (text, window), sorted: each text with its windows."""
    texts, at = np.unique(pairs[:, 0], return_index=True)
    return texts.tolist(), np.split(pairs[:, 1], at[1:])


def runs(mark: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked words within a text: first word and end, counted
    from the text's own first word, and the number of runs of each text."""
    base = np.concatenate([[0], np.cumsum(per_text)])
    first, end, each = spans(mark.astype(np.uint8), base, np.array([False, True]))
    shift = np.repeat(base[:-1], each)
    return first - shift, end - shift, each


def _lists(values: np.ndarray, each: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(each)]), pa.int32()), pa.array(values, pa.int64()))


def _scanned(docs: DataFrame, rows: list[tuple[bytes, str]]) -> DataFrame:
    """*docs* (text, other columns, the state of earlier passes if any) with
    the state after a pass of the automaton of *rows*."""
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    state = {f.split()[0] for f in STATE.split(", ")}
    rest = [c for c in docs.columns if c not in state]
    again = len(rest) < len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Patterns(shared.value)
        for batch in batches:
            for start, n in slices(batch.column("text")):
                part = batch.slice(start, n)
                raw, offsets = utf8(part.column("text"))
                per_text, hit, found = held.scan(raw, offsets)
                if again:
                    base = np.concatenate([[0], np.cumsum(per_text)])
                    before = (part.column(c).to_pylist() for c in ("hit_first", "hit_end", "items"))
                    for t, (a, b, old) in enumerate(zip(*before)):
                        for x, y in zip(a, b):
                            hit[base[t] + x:base[t] + y] = True
                        found[t] = sorted({*found[t], *old})
                first, end, each = runs(hit, per_text)
                chars = code_points(raw, offsets, per_text, first, end, each)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in rest), pa.array(per_text, pa.int64()),
                     *(_lists(x, each) for x in (first, end, *chars)),
                     pa.array(found, pa.list_(pa.string()))],
                    names=[*rest, *(f.split()[0] for f in STATE.split(", "))])

    out = StructType([*docs.select(*rest).schema.fields, *StructType.fromDDL(STATE).fields])
    return docs.mapInArrow(run, out)


def code_points(raw: np.ndarray, offsets: np.ndarray, per_text: np.ndarray, first: np.ndarray,
                end: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of words as code points of their original text."""
    starts, ends, _ = spans(raw, offsets, IS_WORDY)
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    text = np.repeat(np.arange(len(each)), each)
    base = np.concatenate([[0], np.cumsum(per_text)])[text]
    zero = points[offsets[text]]
    return points[starts[base + first]] - zero, points[ends[base + end - 1]] - zero


def scanned(docs: DataFrame, benchmark: DataFrame, most: int = MAX_WINDOWS,
            size: int = WINDOW) -> DataFrame:
    """*docs* with the columns of ``STATE``; *docs* holds text, and no column
    of these names."""
    found = materialise(windows(benchmark, size), "windows")
    parts = max(1, -(-found.select("w").distinct().count() // most))
    for part in range(parts):
        rows = found.filter(F.pmod(F.xxhash64("w"), F.lit(parts)) == part).toArrow()
        docs = _scanned(docs, list(zip(*(rows.column(c).to_pylist() for c in ("w", "item")))))
        if part + 1 < parts:
            docs = materialise(docs, "scanned")
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, most: int = MAX_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, and spans: the hit runs as code points of the original text."""
    rows = scanned(docs.select("doc_id", "text"), benchmark, most)
    hits = F.aggregate(F.arrays_zip("hit_first", "hit_end"), F.lit(0).cast("long"),
                       lambda n, x: n + x["hit_end"] - x["hit_first"])
    return rows.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_first") > 0).alias("contaminated"),
        F.arrays_zip("char_first", "char_end").alias("spans"))


def masked(docs: DataFrame, benchmark: DataFrame, mask: str = " ",
           most: int = MAX_WINDOWS) -> DataFrame:
    """All documents and columns, every hit run of words replaced by *mask*."""
    rows = scanned(docs.select("text", F.struct(*docs.columns).alias("row")), benchmark, most)
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col("char_end"))
    ends = F.concat(F.col("char_first"), F.array(F.char_length("text").cast("long")))
    pieces = F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda x: F.substr(
        F.col("text"), (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")))
    text = F.when(F.size("char_first") > 0, F.concat_ws(mask, pieces)).otherwise(F.col("text"))
    return rows.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c)
                         for c in docs.columns])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT d.r, d.w, s.n, unnest(range(1, len(d.w) - s.n + 2)) AS i
        FROM d JOIN sizes s ON len(d.w) >= s.n)),
m AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
it AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hit.n_hit, 0) AS n_hit,
       coalesce(it.n_items, 0) AS n_items, coalesce(it.items_sha256, sha256('')) AS items_sha256,
       hit.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit ON d.r = hit.r LEFT JOIN it ON d.r = it.r
"""
