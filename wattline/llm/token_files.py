"""Token ids in ORC files.

Documents are sorted by id over range partitions, encoded with the tokenizers library and written as one ORC file per
partition: integer columns in run-length encoding, row indexes, and a Bloom filter on the document id, so that readers
split files by stripe, read single columns and skip stripes by metadata. Each row also has its place within its file;
the place in the whole corpus follows from the files' totals.

The library encodes every distinct unit (a blank and the characters up to the next) once per worker; texts are put
together from the units' ids. Units of Latin letters, ASCII digits and signs are cut into the matches of the pre-splitting
pattern here and each match goes to the library's model; all others go through the whole library, many at a time. A single blank between two other characters always begins a match of the
pre-splitting pattern, and a single line break between two others is one, so the ids are those of the whole text. Texts
with an added token of the vocabulary (``<|endoftext|>``) are encoded whole, as the library treats these first.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from wattline.llm.common import in_batches
from wattline.session import scratch_path

END = 2
STRIPE = 64 << 20
#: Units kept per generation of the cache; two generations are held.
KEPT = 600_000
#: Units encoded in one call.
CALL = 2000

MEETING = re.compile(r"\s\s")
LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
BLANK = re.compile(r"\s")

#: Letters, digits and signs in runs: each run is a match of the pre-splitting pattern, as no apostrophe and no blank is
#: among them. Characters beyond these are left to the library, which knows the classes of its own Unicode version.
RUNS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[0-9]+|[!-&(-/:-@\[-`{-~]+")
_ANY = RUNS.pattern.replace("]+|[", "").removesuffix("]+")
SIMPLE, SIMPLE_TEXT = re.compile(f"{_ANY}]+"), re.compile(f"{_ANY} \\n]*")

_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The character that stands for each byte in a byte-level vocabulary; ASCII letters, digits and signs stand for themselves.
SIGNS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class Known(dict):
    """Ids by unit; the owner finds those of a unit that is asked for and missing."""

    def __init__(self, owner: Units):
        super().__init__()
        self.owner = owner

    def __missing__(self, unit: str) -> bytes:
        ids = self[unit] = self.owner.found(unit)
        return ids


class Units:
    """Little-endian 32-bit ids of units, encoded by the library when first seen."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.new, self.old = Known(self), Known(self)
        self.line = self.ids("\n")
        self.model, cut = self.library.model, self.library.pre_tokenizer
        #: Whether the library cuts by the byte-level pattern alone before its model.
        self.apt = (
            self.library.normalizer is None and isinstance(cut, pre_tokenizers.ByteLevel) and cut.use_regex and not cut.add_prefix_space
            and isinstance(self.model, models.BPE)
        )

    def ids(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def apart(self, units: list[str], before: str) -> list[bytes]:
        """The ids of units without blanks inside, each after ``before``, in calls of many with a line break between
        them: that is always a match of its own there and gives an id that no such unit contains."""
        out, mark = [], np.frombuffer(self.line, "<u4")[0]
        for at in range(0, len(units), CALL):
            found = np.frombuffer(self.ids(before + ("\n" + before).join(units[at : at + CALL])), "<u4")
            begin = 0
            for end in [*np.flatnonzero(found == mark).tolist(), len(found)]:
                out.append(found[begin:end].tobytes())
                begin = end + 1
        return out

    def match(self, text: str) -> bytes:
        """The ids of one match of the pre-splitting pattern."""
        signs = text.replace(" ", SIGNS[32]) if text.isascii() else "".join(map(SIGNS.__getitem__, text.encode()))
        found = [token.id for token in self.model.tokenize(signs)]
        return struct.pack(f"<{len(found)}I", *found)

    def simple(self, unit: str) -> bytes:
        """The ids of a unit of ``SIMPLE`` characters. Its first match is a unit of its own, and so are the others, which
        no blank precedes."""
        head = unit[:1] == "\n"
        runs = RUNS.findall(unit)
        if len(runs) == 1:
            return self.match(runs[0] if head else " " + runs[0])
        first = self.new["\n" + runs[0] if head else runs[0]]
        return first + b"".join([self.new["\n" + run] for run in runs[1:]])

    def found(self, unit: str) -> bytes:
        """The ids of a unit: with a blank before it, or, if its key begins with a line break, alone."""
        ids = self.old.get(unit)
        if ids is not None:
            return ids
        head = unit[:1] == "\n"
        if self.apt and unit.isascii() and unit.isalpha():
            return self.match(" " + unit)
        if self.apt and SIMPLE.fullmatch(unit, head):
            return self.simple(unit)
        return self.ids(unit[1:] if head else " " + unit)

    def learn(self, units: set[str]) -> None:
        """Make sure that the units that are not for ``simple`` and have no blank inside are known."""
        plain, heads = [], []
        for unit in units:
            head = unit[:1] == "\n"
            if unit in self.new or unit in self.old or self.apt and SIMPLE.fullmatch(unit, head):
                continue
            if len(unit) > head and not BLANK.search(unit, head):
                (heads if head else plain).append(unit)
        self.new.update(zip(plain, self.apart(plain, " "), strict=True))
        self.new.update(zip(heads, self.apart([h[1:] for h in heads], ""), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts. Where no two blanks meet, a line break is a match of its own and lines are apart."""
        if len(self.new) > KEPT:
            self.old, self.new = self.new, Known(self)
        split, wanted = [], set()
        for text in texts:
            if any(token in text for token in self.added):
                split.append(self.ids(text))
                continue
            if MEETING.search(text):
                parts = [LONE_BLANK.split(text)]
            else:
                parts = [line.split(" ") for line in text.split("\n")]
            few = self.apt and SIMPLE_TEXT.fullmatch(text)
            for line in parts:
                line[0] = "\n" + line[0]
                if not few:
                    wanted.update(line)
            split.append(parts)
        self.learn(wanted)
        known = self.new.__getitem__
        return [parts if isinstance(parts, bytes) else self.line.join([b"".join(map(known, line)) for line in parts]) for parts in split]


@functools.lru_cache(maxsize=2)
def units(path: str) -> Units:
    """One cache per worker process and vocabulary."""
    return Units(path)


def write(docs: DataFrame, vocabulary: str, folder: str, text: str = "text", id_col: str = "doc_id", stripe: int = STRIPE) -> None:
    """Write ``doc_id, in_file, n_tokens, ids`` in ascending order of the id (nulls first; equal ids by text).

    A null text is empty; every document ends with ``END``. ``in_file`` is the number of ids before the document in its
    file. Repeated rows are written as often as they come.
    """

    def encoded(batches):
        own, place = units(vocabulary), 0
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = [np.frombuffer(x, "<i4") for x in own.encode([t or "" for t in batch.column(1).to_pylist()])]
                counts = np.array([len(r) + 1 for r in rows], np.int64)
                offsets = np.concatenate([[0], np.cumsum(counts)])
                values = np.full(offsets[-1], END, np.int32)
                for row, begin in zip(rows, offsets, strict=False):
                    values[begin : begin + len(row)] = row
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
                before = pa.array(offsets[:-1] + place)
                place += int(offsets[-1])
                yield pa.RecordBatch.from_arrays([batch.column(0), before, pa.array(counts), lists], ["doc_id", "in_file", "n_tokens", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    # The text breaks ties, so that the order does not depend on how rows arrive.
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "t")
    (
        in_batches(ranged, encoded, "doc_id bigint, in_file bigint, n_tokens bigint, ids array<int>")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.stripe.size", stripe)
        .orc(folder)
    )


def file_number(name: str) -> int:
    """The number of the task that wrote a file; names sort by it only up to five digits."""
    return int(re.match(r"part-(\d+)-", name)[1])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: ``start`` counts the ids of all documents before, over all files.

    The files' totals come from their integer columns alone; there is one row per file on the driver.
    """
    stored = spark.read.schema("doc_id bigint, in_file bigint, n_tokens bigint, ids array<int>").orc(folder)
    stored = stored.select("*", F.col("_metadata.file_name").alias("file"))
    totals = stored.groupBy("file").agg(F.max(F.col("in_file") + F.col("n_tokens"))).collect()
    totals = sorted(totals, key=lambda row: file_number(row[0]))
    starts = [0, *accumulate(total for _, total in totals)]
    before = spark.createDataFrame([(name, at) for (name, _), at in zip(totals, starts, strict=False)], "file string, before bigint")
    start = (F.col("before") + F.col("in_file")).alias("start")
    return stored.join(F.broadcast(before), "file").select("doc_id", start, "n_tokens", "ids")


def lookup(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """The documents with these ids; stripes are skipped by their statistics and Bloom filters."""
    return read(spark, folder).filter(F.col("doc_id").isin(ids))


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens`` and the unsigned checksum of the ids as little-endian 32-bit integers."""

    def summed(batches):
        for batch in batches:
            lists = batch.column(3)
            values, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return in_batches(tokens, summed, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, vocabulary: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Write the files to the shared folder, read them back, and return ``checksums`` of what was read.

    One row per row; an empty table gives no rows. Of equal ids, the smaller text comes first.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "orc")
    write(docs, vocabulary, folder, text, id_col)
    return checksums(read(spark, folder))
