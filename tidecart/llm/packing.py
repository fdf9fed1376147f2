"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become pieces of at most ``capacity`` tokens. Each task packs its pieces best-fit, largest
first, and emits the bins that are full or nearly so. What is underfull goes to the next round, in
which a task merges the bins of ``FAN_IN`` tasks as items: best-fit again, fullest first, and a bin
that is at most half full is dissolved so that its pieces find gaps of their own. Rounds end when one
task is left or a round no longer saves a hundredth of the open bins, so what meets in one task is
never more than a bounded number of bins however large the corpus is.
"""

from __future__ import annotations

import sys
import zlib
from array import array

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm._common import appended, column, kept_in_worker
from tidecart.session import pin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 1024
END_ID = 2
SLACK = 4            # tokens that a bin may lack and still be called full
FAN_IN = 8           # tasks merged into one by a round
TASK_PIECES = 200_000  # pieces that a task holds at a time
CACHED_WORDS = 150_000  # a worker remembers their ids: about 20 MB
BATCH_BYTES = 4e6        # of text that a worker has in hand at a time

# fixed values: white space besides the blank and the newline, as tokenizers and Python see it
OTHER_BLANKS = ("\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0            "
                "    　")


def merger(definition: str):
    """A function from a word to its ids, or None where ids don't follow the order of the merges."""
    import json

    import tiktoken

    model = json.loads(definition)
    vocab, merges = model["model"]["vocab"], model["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    # fixed values: how byte-level vocabularies write bytes, and how they divide texts
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    pre = model.get("pre_tokenizer") or {}
    ordered = all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs))
    if not ordered or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or model.get("normalizer"):
        return None
    ranks = {bytes(byte_of[c] for c in word): i for word, i in vocab.items() if i < 256 + len(pairs)}
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Words(dict):
    """Token ids of words, as little-endian 32-bit bytes, worked out when first asked for."""

    def __init__(self, encode) -> None:
        super().__init__({"": b""})
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if word[-1] in ".," and word[-2:-1].isalpha():  # a token never joins a letter and a mark
            ids = self[word[:-1]] + self[word[-1]]
        else:
            ids = array("I", self.encode(word)).tobytes()
        self[word] = ids
        return ids


class WordEncoder:
    """Token ids of texts as little-endian 32-bit bytes, with the ids of words remembered.

    The byte-level pattern never lets a token cross a single blank or newline, so most texts are the
    joined ids of their words, each with its leading blank. Texts with other white space, with longer
    runs of it, or with the text of a special token are encoded whole. Where the ids of the vocabulary
    follow its merges, new words are merged by the ``tiktoken`` library, which gives the same ids for
    a third of the time.
    """

    def __init__(self, definition: str) -> None:
        import json

        self.definition, self.tokenizer = definition, None
        special = [t["content"] for t in json.loads(definition).get("added_tokens") or []]
        runs = [a + b + c for a in " \n" for b in " \n" for c in " \n"]
        self.odd = ["\x01", *special, *runs, *OTHER_BLANKS]
        self.words = Words(merger(definition) or self.whole)

    def whole(self, text: str) -> list[int]:
        if self.tokenizer is None:  # most workers never need it
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.definition)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        if any(o in text for o in self.odd) or not text[-2:].strip(" \n"):
            return array("I", self.whole(text)).tobytes()
        if len(self.words) > CACHED_WORDS:
            self.words = Words(self.words.encode)
        return b"".join(map(self.words.__getitem__, text.replace(" ", "\x01 ").replace("\n", "\x01\n\x01").split("\x01")))


def pieces_of(ids: bytes, capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Start, length and crc32 of each piece of a document's ids; the first takes what is left over."""
    n = len(ids) // 4
    starts = [0, *range(n % capacity or capacity, n, capacity)]
    lengths = [b - a for a, b in zip(starts, [*starts[1:], n])]
    return starts, lengths, [zlib.crc32(ids[4 * s:4 * (s + k)]) for s, k in zip(starts, lengths)]


def tokenised(docs: DataFrame, tokenizer_file: str, keep: list[str], text_column: str = "text", capacity: int = CAPACITY,
              end_id: int = END_ID) -> DataFrame:
    """One row per piece: the kept columns, piece, start, length, ids_crc32. Null texts are empty ones."""
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    version = zlib.crc32(definition.encode())
    end = end_id.to_bytes(4, "little")

    def run(texts: list) -> list:
        encoder = kept_in_worker("encoder", version, lambda: WordEncoder(definition))
        found = [pieces_of(encoder.encode(t or "") + end, capacity) for t in texts]
        return list(zip(*found)) or [[], [], []]

    plain = docs.select(*[column(c).alias(c) for c in keep], column(text_column).cast("string").alias("__t"))
    cut = appended(plain, [F.col("__t")], run, "__s array<long>, __n array<long>, __c array<long>", keep, BATCH_BYTES)
    rows = cut.select(*[column(c) for c in keep], F.posexplode(F.arrays_zip("__s", "__n", "__c")).alias("piece", "__p"))
    return rows.select(*[column(c) for c in keep], "piece", F.col("__p.__s").alias("start"), F.col("__p.__n").alias("length"),
                       F.col("__p.__c").alias("ids_crc32"))


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: largest first, each into the fullest bin that still takes it."""
    open_bins: dict[int, list[int]] = {}
    gaps = 0  # bit g is set where a bin has a gap of g
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fitting = gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[gap].pop()
            if not open_bins[gap]:
                gaps ^= 1 << gap
            bins[b].append(i)
        else:
            gap, b = capacity, len(bins)
            bins.append([i])
        if gap > size:
            left = open_bins.setdefault(gap - size, [])
            left.append(b)
            gaps |= 1 << (gap - size)
    return bins


def merged(bins: list[list[tuple[int, int]]], capacity: int) -> list[list[tuple[int, int]]]:
    """Pack bins, each a list of (length, row), once more; those at most half full fall apart first."""
    items = []
    for b in bins:
        items += [b] if 2 * sum(n for n, _ in b) > capacity else [[piece] for piece in b]
    loads = [sum(n for n, _ in item) for item in items]
    return [[piece for i in found for piece in items[i]] for found in best_fit(loads, capacity)]


def _round(bins: DataFrame, number: int, capacity: int, slack: int) -> DataFrame:
    """(rows, load, done, sequence) after one round over (rows): rows are (row, length) of the pieces of a bin."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        count = 0

        def out(found, done):
            nonlocal count
            ids = [(number << 56) + (part << 32) + count + i for i in range(len(found))]
            count += len(found)
            return pa.RecordBatch.from_pydict({
                "rows": pa.array([[r for _, r in b] for b in found], pa.list_(pa.int64())),
                "lengths": pa.array([[n for n, _ in b] for b in found], pa.list_(pa.int64())),
                "load": pa.array([sum(n for n, _ in b) for b in found], pa.int64()),
                "done": pa.array([done] * len(found), pa.bool_()), "sequence": pa.array(ids, pa.int64())})

        held, size = [], 0
        for batch in batches:
            for rows, lengths in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append(list(zip(lengths, rows)))
                size += len(rows)
            if size >= TASK_PIECES:
                packed = merged(held, capacity)
                full = [b for b in packed if sum(n for n, _ in b) >= capacity - slack]
                held = [b for b in packed if sum(n for n, _ in b) < capacity - slack]
                yield out(full, True)
                if sum(map(len, held)) > TASK_PIECES // 2:
                    yield out(held, False)
                    held = []
                size = sum(map(len, held))
        packed = merged(held, capacity)
        yield out([b for b in packed if sum(n for n, _ in b) >= capacity - slack], True)
        yield out([b for b in packed if sum(n for n, _ in b) < capacity - slack], False)

    return bins.select("rows", "lengths").mapInArrow(
        run, "rows array<long>, lengths array<long>, load long, done boolean, sequence long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """The rows of ``pieces`` (column ``length``, 1 to capacity) with sequence_id and offset.

    No piece is lost or cut. An empty table gives an empty result. Sequence numbers are unique and
    have no further meaning.
    """
    rows = pin(pieces.withColumn("__row", F.monotonically_increasing_id()))
    bins = rows.select(F.array("__row").alias("rows"), F.array("length").alias("lengths"))
    closed, number, tasks, before = None, 1, None, None
    while True:
        state = pin(_round(bins, number, capacity, slack))
        done, waiting = state.where("done"), state.where("not done")
        closed = done if closed is None else closed.unionAll(done)
        left, held, met = waiting.agg(F.count("*"), F.sum(F.size("rows")), F.countDistinct(F.shiftright("sequence", 32))).first()
        if left == 0 or tasks == 1 or (before is not None and left > 0.99 * before):
            closed = closed.unionAll(waiting)
            break
        tasks = max(-(-met // FAN_IN), -(-held // (TASK_PIECES // 2)))
        before, number = left, number + 1
        bins = waiting.select("rows", "lengths").repartition(tasks)
    offsets = F.expr("transform(lengths, (n, i) -> aggregate(slice(lengths, 1, i), 0L, (a, b) -> a + b))")
    placed = closed.select(F.col("sequence").alias("sequence_id"), F.explode(F.arrays_zip("rows", offsets.alias("offsets"))).alias("__p"))
    placed = placed.select("sequence_id", F.col("__p.rows").alias("__row"), F.col("__p.offsets").alias("offset"))
    return rows.join(placed, "__row").drop("__row")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def packed_documents(docs: DataFrame, keep: list[str], tokenizer_file: str | None = None, text_column: str = "text") -> DataFrame:
    """Pieces of all documents with the sequence and the place in it that each was given."""
    return pack(tokenised(docs, tokenizer_file or default_tokenizer(), keep, text_column))


def best_fit_packing(spark, folder: str) -> DataFrame:
    """Query op9: every piece of every document and its place."""
    return packed_documents(spark.read.parquet(f"{folder}/documents.parquet"), ["doc_id"])
