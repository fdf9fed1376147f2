"""CSV records with quoted newlines, cut in parallel within large files.

Whether a line begins inside a quoted field depends on all lines before it. So a first pass tells, for
each split of a file, what becomes of either state (outside or inside quotes) on the way through it;
chaining these small functions in file order gives the state at the start of every split. With that
each split cuts its own records in a second pass. A record that runs over the end of a split is put
together from its pieces, of which the first pass has at most two per split.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecart.operators.attach import BROADCAST_BYTES, fits_broadcast
from tidecart.session import pin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATES = "path string, block long, from_outside boolean, from_inside boolean, crlf boolean, head binary, tail_outside binary, tail_inside binary"


def _closed_at(line: bytes, at: int) -> int:
    """Where the quoted field that holds ``at`` ends: the place of its closing quote, or -1. Doubled quotes don't close."""
    while True:
        at = line.find(b'"', at)
        if at < 0 or line[at + 1:at + 2] != b'"':
            return at
        at += 2


def open_after(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open at the end of the line. Only a quote at the start of a field opens one."""
    if inside:
        at = _closed_at(line, 0)
        if at < 0:
            return True
    elif line[:1] == b'"' or line[:4] == b'\xef\xbb\xbf"':
        at = _closed_at(line, 1 if line[:1] == b'"' else 4)
        if at < 0:
            return True
    else:
        at = 0
    while True:
        at = line.find(b',"', at)
        if at < 0:
            return False
        at = _closed_at(line, at + 2)
        if at < 0:
            return True


class _Hypothesis:
    """What a split looks like if it begins in a state: the state now, the piece that belongs to an
    earlier record, and the lines of the record that is open."""

    def __init__(self, inside: bool) -> None:
        self.inside, self.head, self.open = inside, None, [] if inside else None
        self.began_before = inside

    def pass_plain(self, lines) -> None:
        """Lines without a quote: they change nothing, but belong to the open record."""
        if self.inside:
            self.open += lines()

    def pass_quoted(self, line: bytes) -> None:
        was, self.inside = self.inside, open_after(line, self.inside)
        if was:
            self.open.append(line)
            if not self.inside:
                if self.began_before:
                    self.head, self.began_before = b"\n".join(self.open), False
                self.open = None
        elif self.inside:
            self.open = [line]

    def pieces(self) -> tuple[bytes | None, bytes | None]:
        """The piece at the start (all of it, where the split lies within one record) and the one at the end."""
        rest = b"\n".join(self.open) if self.inside else None
        return (rest, None) if self.began_before else (self.head, rest)


def _runs(batch):
    """(path, block, from, to) of the rows of each split in a batch."""
    import numpy as np

    if not batch.num_rows:
        return
    paths, blocks = batch.column(1).dictionary_encode(), batch.column(2).to_numpy()
    numbers = paths.indices.to_numpy()
    new = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(blocks) != 0)) + 1
    for a, b in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
        yield paths.dictionary[int(numbers[a])].as_py(), int(blocks[a]), a, b


def _quoted_lines(batch):
    import numpy as np
    import pyarrow.compute as pc

    return np.flatnonzero(pc.match_substring(batch.column(0), '"').to_numpy(zero_copy_only=False))


def _states(batches):
    """A row of STATES for each split of the task."""
    import pyarrow as pa

    found: dict[tuple[str, int], tuple[_Hypothesis, _Hypothesis, bool]] = {}
    for batch in batches:
        lines, quoted = batch.column(0), _quoted_lines(batch)
        for path, block, a, b in _runs(batch):
            if (path, block) not in found:
                found[path, block] = (_Hypothesis(False), _Hypothesis(True), block == 0 and lines[a].as_py().endswith(b"\r"))
            both, at = found[path, block][:2], a
            for i in [*quoted[(quoted >= a) & (quoted < b)].tolist(), b]:
                for h in both:
                    h.pass_plain(lambda: lines.slice(at, i - at).to_pylist())  # noqa: B023
                if i < b:
                    line = lines[i].as_py()
                    for h in both:
                        h.pass_quoted(line)
                at = i + 1
    rows = []
    for (path, block), (outside, inside, crlf) in found.items():
        head, tail_inside = inside.pieces()
        rows.append((path, block, outside.inside, inside.inside, crlf, head, outside.pieces()[1], tail_inside))
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    names = [f.split(" ")[0] for f in STATES.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _whole_records(batches):
    """The records that begin and end within a split, without the first of a file: (record, path, crlf)."""
    import numpy as np
    import pyarrow as pa

    last, inside, crlf, header, held = None, False, False, False, []
    for batch in batches:
        lines, quoted = batch.column(0), _quoted_lines(batch)
        whole, joined, of, flags = [], [], [], []
        for path, block, a, b in _runs(batch):
            if last != (path, block):
                last, crlf, held = (path, block), batch.column(4)[a].as_py(), None
                inside, header = batch.column(3)[a].as_py(), block == 0
            after = np.zeros(b - a, bool)  # whether a field is open at the end of each line
            state, at = inside, 0
            for i in (quoted[(quoted >= a) & (quoted < b)] - a).tolist():
                after[at:i] = state
                state = open_after(lines[a + i].as_py(), state)
                after[i], at = state, i + 1
            after[at:] = state
            before = np.append(inside, after[:-1])
            single = np.flatnonzero(~before & ~after)
            starts, ends = np.flatnonzero(~before & after), np.flatnonzero(before & ~after)
            many = []
            if inside and len(ends):  # goes on from the batch before, or from the split before
                if held is not None:
                    many.append(b"\n".join(held + lines.slice(a, int(ends[0]) + 1).to_pylist()))
                held, ends = None, ends[1:]
            elif inside and held is not None:
                held += lines.slice(a, b - a).to_pylist()
            many += [b"\n".join(lines.slice(a + s, e - s + 1).to_pylist()) for s, e in zip(starts.tolist(), ends.tolist())]
            if len(starts) > len(ends):
                held = lines.slice(a + int(starts[-1]), b - a - int(starts[-1])).to_pylist()
            if header:  # the first record with anything in it
                first = next((int(i) for i in single if lines[a + int(i)].as_py().strip()), b)
                if many and (len(starts) == 0 or starts[0] < first or not len(single)):
                    many, header = many[1:], False
                elif first < b:
                    single, header = single[single > first], False
            whole.append(lines.take(pa.array(single + a)))
            joined.append(pa.array(many, pa.binary()))
            n = len(single) + len(many)
            of.append(pa.array([path] * n, pa.string()))
            flags.append(pa.array(np.full(n, crlf)))
            inside = state
        if whole:
            records = [x for pair in zip(whole, joined) for x in pair]
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(records), pa.concat_arrays(of), pa.concat_arrays(flags)], names=["record", "path", "crlf"])


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text(paths, lineSep="\n").select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def split_states(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A row per split: whether it begins ``inside`` a quoted field, and its pieces ``head`` and ``tail`` of records that go over its ends."""
    found = pin(_lines(spark, paths).mapInArrow(_states, STATES))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    settled = F.col("from_outside") == F.col("from_inside")
    turns = F.coalesce(F.sum(F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)).over(before), F.lit(0))
    turned = found.withColumn("turns", turns)
    last_state = F.coalesce(F.last(F.when(settled, F.col("from_outside")), ignorenulls=True).over(before), F.lit(False))
    turns_then = F.coalesce(F.last(F.when(settled, F.col("turns")), ignorenulls=True).over(before), F.lit(0))
    odd = (F.col("turns") - turns_then) % 2 == 1
    state = turned.withColumn("inside", last_state != odd).withColumn("crlf", F.max("crlf").over(Window.partitionBy("path")))
    return state.select("path", "block", "inside", "crlf", F.when(F.col("inside"), F.col("head")).alias("head"),
                        F.when(F.col("inside"), F.col("tail_inside")).otherwise(F.col("tail_outside")).alias("tail"))


def records(spark: SparkSession, paths: list[str], max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(record binary, path) of all CSV records of the files but for their headers and blank lines.

    Lines end at newlines; files whose first line ends in CR LF lose the CR at the ends of lines. The
    states of the splits are broadcast where they are measured to fit; else each half of the files is read for itself.
    """
    states = pin(split_states(spark, paths))
    narrow = states.select("path", "block", "inside", "crlf")
    if len(paths) > 1 and not fits_broadcast(narrow, max_bytes):
        half = len(paths) // 2
        return records(spark, paths[:half], max_bytes).unionAll(records(spark, paths[half:], max_bytes))
    known = _lines(spark, paths).join(F.broadcast(narrow), ["path", "block"], "left")
    changed = F.raise_error(F.lit("the splits of a file changed between two passes; read it again"))
    inside = F.when(F.col("inside").isNull(), changed.cast("boolean")).otherwise(F.col("inside"))
    whole = known.select("value", "path", "block", inside.alias("inside"), "crlf").mapInArrow(_whole_records, "record binary, path string, crlf boolean")
    # a record over several splits: the end of one, any whole splits, and the start of the last
    pieces = states.select("path", "crlf", "block", F.posexplode(F.array("head", "tail")).alias("side", "piece")).where("piece is not null")
    upto = Window.partitionBy("path").orderBy("block", "side")
    numbered = pieces.withColumn("number", F.sum("side").over(upto))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block", "side", "piece"))), lambda x: x["piece"])
    one = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.element_at(parts, 1), lambda a, b: F.concat(a, F.lit(b"\n"), b))
    crossing = numbered.groupBy("path", "crlf", "number").agg(one.alias("record")).select("record", "path", "crlf")
    return whole.unionAll(crossing)


def texts(found: DataFrame, charset: str) -> DataFrame:
    """(record string, path) of the records that are not blank, decoded and with line ends as newlines."""
    text = F.col("record").cast("string") if charset == "UTF-8" else F.decode("record", charset)
    plain = F.when(F.col("crlf"), F.regexp_replace(text, "\r(?=\n|$)", "")).otherwise(text)
    return found.select(plain.alias("record"), "path").where(F.col("record").rlike("[^\\x00-\\x20]"))
