"""Quality rules that reject texts which repeat themselves, found with a suffix array.

Documents of a batch are laid out one after the other as word numbers, with a number of its own
after each. Prefix doubling sorts the suffixes that share three words with another one; the longest
common prefixes of neighbours in that order are the repeats that cannot be extended to the right, and
as every repeat lies within a maximal one, the spans of each suffix's longest repeat have the same
union as the spans of all maximal repeats. Word numbers are made per document, so nothing is compared
across documents.
"""

from __future__ import annotations

import sys
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm._common import appended, column

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 3
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_CHUNK_WORDS = 150_000
_BATCH_BYTES = 4e6        # of text that a worker has in hand at a time

MIN_WORDS = 50
MAX_REPEAT_WORDS_PERCENT = 50
MIN_REPEAT = 8
MAX_COVERED_PERCENT = 40
MAX_LONGEST_PERCENT = 25

FIGURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "covered_words long, longest_repeat long")


def text_figures(text: str | None) -> tuple[list[bytes], int, int, int]:
    """Words, code points in words, symbols and repeated lines of a text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return words, chars, symbols, len(lines) - len(set(lines))


def doubling(codes, first):
    """Suffix order of the positions whose first window is not unique, and the ranks of each step.

    ``codes`` numbers the window of ``first`` words at each position. Returns the list of ranks (one
    array per doubling; equal ranks mean equal prefixes of first, 2*first, ... words) and the
    positions of repeated windows in suffix order.
    """
    import numpy as np

    n = len(codes)
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    shared = ~new
    shared[:-1] |= ~new[1:]
    repeated = np.sort(order[shared])
    ranks, active, k = [rank], repeated, first
    while len(active):
        keys = rank[active] * n + rank[active + k]
        o = np.argsort(keys, kind="stable")
        active, keys = active[o], keys[o]
        group = rank[active]
        at = np.arange(len(active))
        new_group = np.ones(len(active), bool)
        new_group[1:] = group[1:] != group[:-1]
        new = np.ones(len(active), bool)
        new[1:] = keys[1:] != keys[:-1]
        refined = group + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(new_group, at, 0))
        rank = rank.copy()
        rank[active] = refined
        ranks.append(rank)
        shared = ~new
        shared[:-1] |= ~new[1:]
        active, k = active[shared], 2 * k
    return ranks, repeated[np.argsort(rank[repeated], kind="stable")]


def repeats(ids, codes):
    """For each position the longest prefix, in words, that occurs elsewhere (0 below a window), and the repeated windows."""
    import numpy as np

    best = np.zeros(len(codes), np.int64)
    ranks, order = doubling(codes, WINDOW)
    if len(order) < 2:
        return best, order
    a, b = order[:-1], order[1:]
    same = ranks[0][a] == ranks[0][b]
    a, b = a[same], b[same]
    length = np.zeros(len(a), np.int64)
    for j in range(len(ranks) - 1, -1, -1):
        length += np.where(ranks[j][a + length] == ranks[j][b + length], WINDOW << j, 0)
    going = np.ones(len(a), bool)
    for _ in range(WINDOW - 1):
        going &= ids[a + length] == ids[b + length]
        length += going
    best[a] = length
    best[b] = np.maximum(best[b], length)
    return best, order


def covered(starts, lengths, n):
    """How many spans lie over each of n positions."""
    import numpy as np

    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1])


def chunk_figures(texts: list[list[bytes]], min_repeat: int):
    """(n_repeat_words, covered_words, longest_repeat) of each list of words."""
    import numpy as np

    ids, total = [], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        ids += [total + seen.setdefault(w, len(seen)) for w in words]
        total += len(seen)
        ids.append(total)  # of its own: nothing reaches across the end of a text
        total += 1
    ids = np.array(ids + [total, total + 1], np.int64)
    ends = np.cumsum([len(words) + 1 for words in texts])
    starts = ends - [len(words) + 1 for words in texts]
    pair = ids[:-2] * (total + 2) + ids[1:-1]
    if total > 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    best, order = repeats(ids, pair * (total + 2) + ids[2:])
    n = len(best)
    in_window = covered(order, np.full(len(order), WINDOW), n) > 0
    long = np.flatnonzero(best >= min_repeat)
    in_repeat = covered(long, best[long], n) > 0
    return (np.add.reduceat(in_window.astype(np.int64), starts), np.add.reduceat(in_repeat.astype(np.int64), starts),
            np.maximum.reduceat(best, starts))


def figures(docs: DataFrame, keep: list[str], text_column: str = "text", min_repeat: int = MIN_REPEAT) -> DataFrame:
    """The columns ``keep`` and the figures of every whole text; null texts have no words.

    ``covered_words`` are words within a repeat of ``min_repeat`` words or more, ``longest_repeat`` is
    the longest repeat in words (0 below three), which may overlap itself.
    """

    def run(texts: list) -> list:
        found = []
        at = 0
        while at < len(texts):
            rows, size = [], 0
            while at + len(rows) < len(texts) and size < _CHUNK_WORDS:
                rows.append(text_figures(texts[at + len(rows)]))
                size += len(rows[-1][0]) + 1
            repeated = chunk_figures([r[0] for r in rows], min_repeat)
            found += [(len(words), *counts, *more) for (words, *counts), more in zip(rows, zip(*(x.tolist() for x in repeated)))]
            at += len(rows)
        return list(zip(*found)) or [[]] * 7

    return appended(docs, [column(text_column).cast("string")], run, FIGURES, keep, _BATCH_BYTES)


def verdicts(measured: DataFrame) -> DataFrame:
    """Add base_failed and kept.

    The base rule wants ``MIN_WORDS`` words and at most half of them in repeated three-word windows.
    The suffix-array rule then limits the share of words in long repeats and, against the length of
    the text, the longest repeat.
    """
    base = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_WORDS_PERCENT} * n_words")
    over = F.expr(f"100 * covered_words > {MAX_COVERED_PERCENT} * n_words or 100 * longest_repeat > {MAX_LONGEST_PERCENT} * n_words")
    return measured.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~over)


def without_repetitive(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes both rules; texts without words and null texts don't.

    The figures are worked out beside the row itself: nothing is shuffled. Other columns, also those
    named like a figure, pass through as they are.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.select(*[column(c).alias(n) for c, n in zip(docs.columns, names)])
    text = names[docs.columns.index(text_column)]
    kept = verdicts(figures(plain, names, text)).where("kept")
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])


def repetition_rules(spark, folder: str) -> DataFrame:
    """Query op10: the figures and verdicts of all documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return verdicts(figures(docs, ["doc_id"]))
