"""JSON arrays in any layout, split into tasks wherever their line breaks are.

A file is read in the pieces between its commas, which text blocks can be cut at like at line ends. Whether
a comma parts two elements depends on all text before it: on whether a string is open and on the depth of
brackets. So a first pass notes for each block what it does to either state it may begin in, windows over
this small table put the blocks of a file together, and a second pass, knowing each block's true beginning,
cuts at the commas of depth one. Elements within a block leave it whole; only the two at its ends are put
together with those of its neighbours.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pairloom.session import new_folder

# The functions travel to the executors whole, wherever the package is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Blocks up to which their beginnings are broadcast; a row takes its path and some 30 bytes.
BROADCAST_BLOCKS = 100_000
# Bytes looked at together (working on them takes some 60 times as much), and elements sent together, at most.
STRETCH = 1 << 19
SENT = 2_000
SENT_BYTES = 4 << 20

BLANK = b" \t\r\n"
BOM = b"\xef\xbb\xbf"
# What a text between two cuts of a block is: an element, the end of one, an inner part or beginning, or
# the end of the last one of its file.
WHOLE, ENDS, GOES_ON, CLOSES = range(4)

EFFECTS = "file string, block long, quotes int, outside long, inside long"
ELEMENTS = "file string, block long, pos long, kind int, raw string"


def structure(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte 1 if it opens or closes a string, and +1 or -1 for an opening or closing bracket."""
    quotes = data == 0x22
    slashes = data == 0x5C
    if slashes.any():
        place = np.arange(len(data))
        other = np.maximum.accumulate(np.where(slashes, -1, place))
        before = np.concatenate([[-1], other[:-1]])
        # A quote after an odd number of backslashes is a character of its string.
        quotes &= (place - 1 - before) % 2 == 0
    brackets = ((data | 0x20) == 0x7B).astype(np.int8) - ((data | 0x20) == 0x7D)
    return quotes, brackets


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int, np.ndarray, np.ndarray]]:
    """Runs of pieces of one block: file, block, first and last row, their bytes and where each ends."""
    value = batch.column(2).cast(pa.large_binary())
    ends = np.frombuffer(value.buffers()[1], np.int64)[value.offset : value.offset + len(value) + 1]
    data = np.frombuffer(value.buffers()[2] or b"", np.uint8)
    files, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    codes = files.indices.to_numpy()
    starts = np.flatnonzero((np.diff(codes, prepend=-1) != 0) | (np.diff(blocks, prepend=-1) != 0))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(blocks)]):
        while a < b:
            upto = min(b, max(a + 1, int(np.searchsorted(ends, ends[a] + STRETCH))))
            yield files.dictionary[int(codes[a])].as_py(), int(blocks[a]), a, upto, data[ends[a] : ends[upto]], ends[a + 1 : upto + 1] - ends[a]
            a = upto


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does to the number of open strings and to the depth, outside of strings if it begins
    outside of one and if it begins inside."""
    found: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for file, block, _, _, data, _ in _stretches(batch):
            quotes, brackets = structure(data)
            parity = np.cumsum(quotes) & 1
            change = [int(brackets[parity == k].sum()) for k in (0, 1)]
            so_far = found.setdefault((file, block), [0, 0, 0])
            now = so_far[0]
            so_far[1] += change[now]
            so_far[2] += change[1 - now]
            so_far[0] = (now + int(quotes.sum())) & 1
    rows = [(*key, *effect) for key, effect in found.items()]
    if rows:
        columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["file", "block", "quotes", "outside", "inside"])


def _cutter(complete: bool):
    """Elements that lie within a block, or else the parts at its ends."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at, state, held, cuts, ready = None, None, [], 0, 0

        def rows() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            columns = [pa.array(x, t) for x, t in zip(zip(*out), kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays([*columns[:4], columns[4].view(pa.string())], ["file", "block", "pos", "kind", "raw"])

        def rest() -> None:
            """What follows the last cut of a block."""
            if held and not complete:
                text = b",".join(held)
                if state[1] == 0:
                    text = text.rstrip(BLANK)
                    if not text.endswith(b"]"):
                        raise ValueError(f"{at[0]}: text after the end of the array")
                out.append((*at, cuts, CLOSES if state[1] == 0 else GOES_ON, text[:-1] if state[1] == 0 else text))

        for batch in batches:
            pieces = batch.column(2).cast(pa.binary())
            for file, block, a, b, data, ends in _stretches(batch):
                if at != (file, block):
                    rest()
                    at, held, cuts = (file, block), [], 0
                    state, fresh = (batch.column(3)[a].as_py(), batch.column(4)[a].as_py()), True
                    closed = block > 0 and state[1] == 0
                quotes, brackets = structure(data)
                parity = np.concatenate([[0], np.cumsum(quotes)]) + state[0] & 1
                depth = np.concatenate([[0], np.cumsum(np.where(parity[1:] == 0, brackets, 0))]) + state[1]
                for text, open_string, level in zip(pieces.slice(a, b - a).to_pylist(), parity[ends].tolist(), depth[ends].tolist()):
                    if closed or (held and state[1] == 0):
                        raise ValueError(f"{file}: text after the end of the array")
                    if fresh and block == 0:
                        text = text.removeprefix(BOM).lstrip(BLANK)
                        if not text.startswith(b"["):
                            raise ValueError(f"{file} does not begin with an array")
                        text = text[1:]
                    fresh = False
                    held.append(text)
                    state = (open_string, level)
                    if state == (0, 1):
                        if complete == (cuts > 0):
                            out.append((file, block, cuts, WHOLE if complete else ENDS, b",".join(held)))
                            ready += len(out[-1][-1])
                        held, cuts = [], cuts + 1
                    if len(out) >= SENT or ready >= SENT_BYTES:
                        yield rows()
                        ready = 0
        rest()
        if out:
            yield rows()

    return cut


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, pos, raw``: the text of every element of the arrays, one array in each file.

    ``block`` is where the block begins that an element ends in, ``pos`` its place among those. A file that is
    no single array, or is cut off, is an error; what an element itself holds is left to its reader.
    """
    pieces = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    is_open = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int")
    change = F.when(F.col("open") == 0, F.col("outside")).otherwise(F.col("inside"))
    blocks = (
        pieces.mapInArrow(_effects, EFFECTS)
        .withColumn("open", is_open)
        .withColumn("change", change)
        .withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    )
    folder = new_folder(spark, "blocks")
    blocks.write.parquet(folder)
    blocks = spark.read.schema(blocks.schema).parquet(folder)
    broken = blocks.groupBy("file").agg(F.sum("change").alias("depth"), (F.sum("quotes") % 2).alias("open")).where("depth <> 0 OR open <> 0").head()
    if broken:
        raise ValueError(f"{broken.file} is cut off, or closes what it has not opened")

    starts = blocks.select("file", "block", "open", "depth")
    if blocks.count() <= BROADCAST_BLOCKS:
        begun = pieces.join(F.broadcast(starts), ["file", "block"])
    else:
        # Text moves to its block's task here; what a task reads is in order again after sorting.
        numbered = pieces.withColumn("row", F.monotonically_increasing_id())
        begun = numbered.join(starts, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "row")
    begun = begun.select("file", "block", "value", "open", "depth")

    # The second pass runs twice, so that only the few parts at the ends of blocks are shuffled.
    in_order = Window.partitionBy("file").orderBy("block", "pos").rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum((F.col("kind") == ENDS).cast("int")).over(in_order), F.lit(0))
    parts = begun.mapInArrow(_cutter(complete=False), ELEMENTS).withColumn("number", number)
    joined = parts.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "pos", "kind", "raw"))).alias("parts"))
    last = F.element_at("parts", -1)
    at_ends = joined.select(
        "file", last.block.alias("block"), last.pos.alias("pos"), F.concat_ws(",", F.transform("parts", lambda x: x.raw)).alias("raw"),
        ((F.col("number") == 0) & (last.kind == CLOSES)).alias("only"),
    ).where(~(F.col("only") & (F.btrim("raw", F.lit(BLANK.decode())) == "")))
    whole = begun.mapInArrow(_cutter(complete=True), ELEMENTS)
    return whole.select("file", "block", "pos", "raw").unionByName(at_ends.drop("only"))
