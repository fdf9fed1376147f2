"""Benchmark passages in documents, found by a prefix-filtered join of shingles.

An item gives windows of ten consecutive words, a window gives shingles of three. The shingles of a
window are ordered by rarity, counted over all documents. An occurrence of which at least a share of
the shingles agree must hold one of the window's rarest shingles (its prefix: one alone if all have to
agree), so only those are looked up. A shingle met at its place leaves one start for the window; starts
that don't leave room for it within the document are ruled out by length and position, and the rest is
verified word by word. Documents are never shuffled for that: the windows travel to them, in blocks of
a fixed size, however large the benchmark is.
"""

from __future__ import annotations

import sys
from itertools import repeat

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.llm._common import appended, attach_unique, column
from tidecart.operators.attach import fits_broadcast
from tidecart.session import pin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10               # words
SHINGLE = 3               # words
SHARE = 1.0               # of a window's shingles that have to agree at their places
BLOCK_BYTES = 8 * 1024 * 1024  # of windows that travel to the tasks at a time
BROADCAST_BYTES = 16 * 1024 * 1024
_CHUNK = 4 * 1024 * 1024  # bytes of text divided into words at a time
_PAIRS = 200_000          # candidates verified at a time

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TABLE = bytes(b if b > 0x7F or chr(b).isalnum() else 32 for b in range(256)).lower()


def windows_of(benchmark: DataFrame, item_column: str, text_column: str, window: int) -> DataFrame:
    """(item, window) of every item: its words, ten at a time, joined by blanks; a shorter item is one window."""
    lowered = F.translate(column(text_column).cast("string"), UPPER, UPPER.lower())
    words = benchmark.select(column(item_column).cast("string").alias("item"),
                             F.filter(F.split(lowered, _NO_WORD), lambda w: w != "").alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    cut = F.transform(starts, lambda i: F.array_join(F.slice("words", i, F.lit(window)), " "))
    return words.where(F.size("words") > 0).select("item", F.explode(F.array_distinct(cut)).alias("window"))


def shingle_codes(numbers, width: int):
    """A code for the ``width`` word numbers from each place on, along the last axis; different shingles may share one."""
    import numpy as np

    numbers = numbers.astype(np.uint64)
    n = numbers.shape[-1] - width + 1
    codes = np.zeros(numbers.shape[:-1] + (max(0, n),), np.uint64)
    for k in range(width):
        codes = codes * np.uint64(0x9E3779B97F4A7C15) + numbers[..., k:k + max(0, n)]
    return codes


class Windows:
    """The windows of a block as word numbers, those of one length together."""

    def __init__(self, rows: list[tuple[int, str]], shingle: int, share: float) -> None:
        import numpy as np

        self.vocabulary: dict[bytes, int] = {b"\xff": -1}
        of_length: dict[int, list] = {}
        for w, text in rows:
            words = text.encode("utf-8", "surrogatepass").split(b" ")
            of_length.setdefault(len(words), []).append((w, [self.vocabulary.setdefault(x, len(self.vocabulary)) for x in words]))
        self.groups = []
        for n, found in sorted(of_length.items()):
            numbers = np.array([x for _, x in found], np.int32)
            codes = shingle_codes(numbers, min(shingle, n))
            need = max(1, -int(-share * codes.shape[1] // 1))
            self.groups.append({"n": n, "width": min(shingle, n), "ids": np.array([w for w, _ in found], np.int64),
                                "numbers": numbers, "codes": codes, "need": need})

    def shingles(self, width: int):
        """All shingles of this width, each once."""
        import numpy as np

        return np.unique(np.concatenate([g["codes"].ravel() for g in self.groups if g["width"] == width]))

    def widths(self) -> list[int]:
        return sorted({g["width"] for g in self.groups})

    def order(self, seen: dict[int, dict[int, int]]) -> None:
        """Choose each window's prefix: its rarest shingles, as many as the share leaves no way around."""
        import numpy as np

        for g in self.groups:
            codes = g.pop("codes")
            known = seen.get(g["width"], {})
            keys, inverse = np.unique(codes, return_inverse=True)
            rarity = np.array([known.get(int(k), 0) for k in keys], np.int64)[inverse.reshape(codes.shape)]
            length = codes.shape[1] - g["need"] + 1
            places = np.argsort(rarity, axis=1, kind="stable")[:, :length]
            prefix = np.take_along_axis(codes, places, axis=1).ravel()
            by_code = np.argsort(prefix, kind="stable")
            g["prefix"], g["first"], g["count"] = np.unique(prefix[by_code], return_index=True, return_counts=True)
            g["window"], g["place"] = by_code // length, places.ravel()[by_code]


def numbered(texts: list, vocabulary: dict):
    """Word numbers of the texts one after the other (0: a word of no window, -1 before each text), and where each begins and ends."""
    import numpy as np

    found = []
    waiting: list[bytes] = []

    def flush() -> None:
        words = b" ".join(waiting).split()
        found.append(np.fromiter(map(vocabulary.get, words, repeat(0)), np.int32, len(words)))
        waiting.clear()

    held = 0
    for text in texts:
        plain = (text or b"").translate(_TABLE)
        waiting.append(b"\xff")
        at = 0
        while at < len(plain):
            end = plain.find(b" ", at + _CHUNK)
            end = len(plain) if end < 0 else end
            waiting.append(plain[at:end])
            held, at = held + end - at, end
            if held > _CHUNK:
                flush()
                held = 0
    flush()
    numbers = np.concatenate(found)
    begins = np.flatnonzero(numbers == -1) + 1
    return numbers, begins, np.append(begins[1:] - 1, len(numbers))


def document_codes(numbers, width: int):
    """Codes of the shingles that consist of known words, and their places."""
    import numpy as np

    known, n = numbers > 0, max(0, len(numbers) - width + 1)
    whole = known[:n].copy()
    for k in range(1, width):
        whole &= known[k:n + k]
    at = np.flatnonzero(whole)
    codes = np.zeros(len(at), np.uint64)
    for k in range(width):
        codes = codes * np.uint64(0x9E3779B97F4A7C15) + numbers[at + k].astype(np.uint64)
    return codes, at


def occurrences(numbers, begins, ends, windows: Windows):
    """(text, window, start) of each occurrence of each window."""
    import numpy as np

    found = []
    for width in windows.widths():
        codes, at = document_codes(numbers, width)
        for g in (g for g in windows.groups if g["width"] == width):
            n, slot = g["n"], np.searchsorted(g["prefix"], codes)
            slot[slot == len(g["prefix"])] = 0
            met = np.flatnonzero(g["prefix"][slot] == codes)
            counts = g["count"][slot[met]]
            cuts = np.searchsorted(np.cumsum(counts), np.arange(_PAIRS, counts.sum() + _PAIRS, _PAIRS)) + 1
            for part in np.split(met, np.minimum(cuts, len(met))):
                if not len(part):
                    continue
                times = g["count"][slot[part]]
                entry = np.repeat(g["first"][slot[part]] - np.cumsum(times) + times, times) + np.arange(times.sum())
                start = np.repeat(at[part], times) - g["place"][entry]
                text = np.searchsorted(begins, np.repeat(at[part], times), side="right") - 1
                fits = (start >= begins[text]) & (start + n <= ends[text])
                start, text, which = start[fits], text[fits], g["window"][entry[fits]]
                same = numbers[start[:, None] + np.arange(n)] == g["numbers"][which]
                agree = same[:, :n - width + 1].copy()
                for k in range(1, width):
                    agree &= same[:, k:n - width + 1 + k]
                sure = agree.sum(axis=1) >= g["need"]
                found.append(np.stack([text[sure], g["ids"][which[sure]], start[sure] - begins[text[sure]], np.full(sure.sum(), n)]))
    return np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)


def merged_spans(starts, stops):
    """Sorted spans without overlap that cover the same words; touching ones become one."""
    import numpy as np

    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] > reach[:-1]
    last = np.append(first[1:], True) if len(first) else first
    return starts[first], reach[last]


def count_shingles(docs: DataFrame, text_column: str, windows: Windows) -> dict[int, dict[int, int]]:
    """How often each shingle of the block's windows occurs in all documents, by width."""
    tables = {w: windows.shingles(w) for w in windows.widths()}
    vocabulary = windows.vocabulary

    def run(batches):
        import numpy as np
        import pyarrow as pa

        counts = {w: np.zeros(len(t), np.int64) for w, t in tables.items()}
        for batch in batches:
            step = max(1, int(batch.num_rows * _CHUNK / max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, step):
                numbers, _, _ = numbered(batch.column(0).slice(at, step).to_pylist(), vocabulary)
                for width, table in tables.items():
                    codes, _ = document_codes(numbers, width)
                    slot = np.searchsorted(table, codes)
                    slot[slot == len(table)] = 0
                    counts[width] += np.bincount(slot[table[slot] == codes], minlength=len(table))
        for width, table in tables.items():
            some = counts[width] > 0
            yield pa.RecordBatch.from_pydict({
                "width": pa.array(np.full(some.sum(), width, np.int32)), "code": pa.array(table[some].view(np.int64)),
                "n": pa.array(counts[width][some])})

    texts = docs.select(column(text_column).cast("string").cast("binary").alias("t"))
    total = texts.mapInArrow(run, "width int, code long, n long").groupBy("width", "code").agg(F.sum("n").alias("n"))
    seen: dict[int, dict[int, int]] = {}
    for r in total.collect():  # no more rows than the block has shingles
        seen.setdefault(r.width, {})[r.code & (2 ** 64 - 1)] = r.n
    return seen


def located(docs: DataFrame, id_column: str, text_column: str, windows: Windows) -> DataFrame:
    """(id, h, n_words, starts, stops, windows) of every row: merged spans of hit words and the windows that occur."""

    def run(texts: list) -> list:
        import numpy as np

        numbers, begins, ends = numbered(texts, windows.vocabulary)
        text, window, start, length = occurrences(numbers, begins, ends, windows)
        order = np.argsort(text, kind="stable")
        text, window, start, length = text[order], window[order], start[order], length[order]
        empty = np.zeros(0, np.int64)
        starts, stops, which = [empty] * len(texts), [empty] * len(texts), [empty] * len(texts)
        rows, first = np.unique(text, return_index=True)
        for i, a, b in zip(rows.tolist(), first, np.append(first[1:], len(text))):
            starts[i], stops[i] = merged_spans(start[a:b], start[a:b] + length[a:b])
            which[i] = np.unique(window[a:b])
        return [ends - begins, starts, stops, which]

    source = docs.select(column(id_column).alias("id"), F.xxhash64(column(text_column)).alias("h"),
                         column(text_column).cast("string").cast("binary").alias("t"))
    fields = "n_words long, starts array<long>, stops array<long>, windows array<long>"
    return appended(source, [F.col("t")], run, fields, ["id", "h"], _CHUNK)


def over_blocks(parts: list[DataFrame]) -> DataFrame:
    """One row per document from what was located for each block; rows that repeat id and text stay as many as they are."""

    def run(found: list) -> list:
        import numpy as np

        starts, stops, which = [], [], []
        for blocks in found:
            of = lambda name: np.array([x for b in blocks for x in b[name]], np.int64)  # noqa: E731, B023
            a, b = merged_spans(of("starts"), of("stops"))
            starts.append(a), stops.append(b), which.append(np.unique(of("windows")))
        return [starts, stops, which]

    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    grouped = rows.groupBy("id", "h").agg(
        F.max("n_words").alias("n_words"), (F.count("*") / len(parts)).cast("int").alias("copies"),
        F.collect_set(F.struct("starts", "stops", "windows")).alias("blocks"))
    whole = appended(grouped, [F.col("blocks")], run, "starts array<long>, stops array<long>, windows array<long>", ["id", "h", "n_words", "copies"])
    return whole.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text_column: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                  share: float = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, spans, contaminated) of every row of ``docs``.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z count as a-z.
    ``spans`` are the words hit as [start, stop), merged; ``items`` the ids, as sorted strings, of the
    items with a window that occurs. Null, empty and wordless texts have no words, such items no window.
    Rows of ``docs`` that repeat are rows of their own; items that repeat an id are one item, items
    without an id hit words but are not listed. Empty tables give no rows, or no hits. Other columns
    are ignored, whatever their names. With a ``share`` below one, windows occur where that share of
    their shingles agrees place by place.
    """
    links = pin(windows_of(benchmark, item_column, item_text_column, window))
    distinct = pin(links.select("window").distinct().withColumn("w", F.monotonically_increasing_id()))
    size = distinct.agg(F.sum(F.octet_length("window") + 16)).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    parts = []
    for b in range(n_blocks):
        block = distinct.where(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == b) if n_blocks > 1 else distinct
        windows = Windows([(r.w, r.window) for r in block.select("w", "window").collect()], shingle, share)
        windows.order(count_shingles(docs, text_column, windows))
        parts.append(located(docs, id_column, text_column, windows))
    found = pin(parts[0] if n_blocks == 1 else over_blocks(parts))

    # documents with the same windows are one class, so that a passage in many copies meets its items once
    found = found.withColumn("key", F.when(F.size("windows") > 0, F.sha2(F.array_join("windows", ","), 256)))
    classes = found.where("key is not null").groupBy("key").agg(F.first("windows").alias("windows"), F.count("*").alias("n_rows"))
    classes = pin(classes)
    named = links.where("item is not null").join(distinct, "window").select("w", "item")
    named = F.broadcast(named) if size <= block_bytes and fits_broadcast(named, BROADCAST_BYTES) else named
    items = classes.select("key", F.explode("windows").alias("w")).join(named, "w").groupBy("key").agg(F.collect_set("item").alias("items"))
    items = pin(classes.select("key", "n_rows").join(items, "key", "left").select("key", "n_rows", F.sort_array("items").alias("items")))
    listed = attach_unique(found.drop("windows", "h"), items, ["key"], "n_rows")
    none = F.array().cast("array<string>")
    spans = F.transform(F.arrays_zip("starts", "stops"), lambda s: F.struct(s["starts"].alias("start"), s["stops"].alias("stop")))
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    listed = listed.select(F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"), spans.alias("spans"))
    return listed.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans",
                         (F.col("n_hit") > 0).alias("contaminated"))


def joined_items(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)


def benchmark_decontamination(spark, folder: str) -> DataFrame:
    """Query op11: every document with its words that lie in an occurrence of a benchmark window."""
    found = contamination(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", joined_items(F.col("items")).alias("items_sha256"), "contaminated")


DECONTAMINATION_SQL = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(translate(text, '{UPPER}', '{UPPER.lower()}'), ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(coalesce(translate(text, '{UPPER}', '{UPPER.lower()}'), ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
i AS (
    SELECT item_id, words, least(len(words), {WINDOW}) AS n, unnest(range(1, greatest(len(words) - {WINDOW} + 2, 2))) AS pos
    FROM b WHERE len(words) > 0),
v AS (
    SELECT DISTINCT item_id, n, array_to_string(words[pos:pos + n - 1], ' ') AS win FROM i),
l AS (
    SELECT DISTINCT n FROM v),
p AS (
    SELECT d.doc_id, l.n, d.words, unnest(range(1, len(d.words) - l.n + 2)) AS pos FROM d, l WHERE len(d.words) >= l.n),
o AS (
    SELECT p.doc_id, p.pos, p.n, v.item_id FROM p JOIN v ON p.n = v.n AND array_to_string(p.words[p.pos:p.pos + p.n - 1], ' ') = v.win),
h AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS place FROM o) GROUP BY doc_id),
x AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(x.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(x.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN x USING (doc_id)
"""
