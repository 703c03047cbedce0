"""BAM files: blocks are inflated and records decoded as a stream, in Arrow batches, one task for each file.

A file comes as one value of Spark's binary source, which bounds it to 2 GB compressed; larger ones raise there. What is
inflated is never held whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seq as S
from ..durable import ship
from . import textual

#: Fixed values of the format: base codes and CIGAR operations.
BASES, OPERATIONS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
_BATCH, _PIECE = 10_000, 1 << 16


def inflate(raw: bytes | memoryview) -> Iterator[bytes]:
    """The contents of a file's gzip members, in pieces; each byte is looked at once."""
    view, at = memoryview(raw), 0
    while at < len(view):
        member = zlib.decompressobj(31)
        while not member.eof and at < len(view):
            part = view[at : at + _PIECE]
            out = member.decompress(part)
            at += len(part) - len(member.unused_data)
            if out:
                yield out


def _int_tags(raw: bytes) -> str:
    """The NM tag of a record's tag block, as text; '' if it has none."""
    at = raw.find(b"NM")
    while at >= 0:
        kind = raw[at + 2 : at + 3].decode("ascii", "replace")
        if kind in "cCsSiI" and kind:
            return f"NM:i:{struct.unpack_from({'c': '<b', 'C': '<B', 's': '<h', 'S': '<H', 'i': '<i', 'I': '<I'}[kind], raw, at + 3)[0]}"
        at = raw.find(b"NM", at + 1)
    return ""


class _Stream:
    """Bytes of inflated blocks, taken as they are needed."""

    def __init__(self, blocks: Iterator[bytes]):
        self.blocks, self.held, self.at = blocks, b"", 0

    def take(self, n: int) -> bytes:
        """The next n bytes; fewer only at the end."""
        while len(self.held) - self.at < n:
            more = next(self.blocks, None)
            if more is None:
                break
            self.held, self.at = self.held[self.at :] + more, 0
        out = self.held[self.at : self.at + n]
        self.at += len(out)
        return out


def header(stream: _Stream) -> list[str]:
    """Names of the reference sequences; the stream is then at the first record."""
    if stream.take(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    stream.take(struct.unpack("<i", stream.take(4))[0])
    names = []
    for _ in range(struct.unpack("<i", stream.take(4))[0]):
        size = struct.unpack("<i", stream.take(4))[0]
        names.append(stream.take(size)[:-1].decode())
        stream.take(4)
    return names


def records(raw: bytes | memoryview) -> Iterator[tuple]:
    """(name, flag, chrom, pos 0-based, cigar, seq, NM tag) of a whole file's records, in order."""
    stream = _Stream(inflate(raw))
    names = header(stream)
    while len(size := stream.take(4)) == 4:
        data = stream.take(struct.unpack("<i", size)[0])
        ref, pos, l_name, _, _, n_cigar, flag, l_seq = struct.unpack_from("<iiBBHHHi", data)
        cigar_at = 32 + l_name
        ops = struct.unpack_from(f"<{n_cigar}I", data, cigar_at)
        seq_at = cigar_at + 4 * n_cigar
        packed = data[seq_at : seq_at + (l_seq + 1) // 2]
        seq = "".join(BASES[b >> 4] + BASES[b & 15] for b in packed)[:l_seq]
        tags = data[seq_at + len(packed) + l_seq :]
        yield data[32 : 31 + l_name].decode(), flag, names[ref] if ref >= 0 else "*", pos, "".join(f"{x >> 4}{OPERATIONS[x & 15]}" for x in ops) or "*", seq, _int_tags(tags)


_DDL = "row_key long, name string, flag int, chrom string, s long, cigar string, seq string, tag string"
_KINDS = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]


def _decoded(batches: Iterator[pa.RecordBatch], limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """(content) of whole files -> their records, or the first ``limit`` of each."""
    names = [x.split(" ")[0] for x in _DDL.split(", ")]
    for batch in batches:
        for raw in batch.column(0):
            found = islice(enumerate(records(raw.as_buffer())), limit)
            while held := [(i, *r) for i, r in islice(found, _BATCH)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), _KINDS, strict=True)], names)


def alignments(spark: SparkSession, path: str, library: str) -> DataFrame:
    """Mapped alignments of a BAM file, like ``textual.alignments``."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    rows = files.mapInArrow(_decoded, _DDL)
    first = files.mapInArrow(partial(_decoded, limit=1), _DDL).head()  # decodes one record
    if first is None:
        raise ValueError(f"alignment file is empty: {path}")
    if not first["seq"]:
        raise ValueError(f"alignments without sequences: {path}")
    kind = textual.collapser_kind(first["name"])
    edits = S.tag_edits(F.array("tag")) if first["tag"] else S.cigar_edits(F.col("cigar"))
    fwd = S.on_forward_strand(F.col("flag"))
    return rows.where(S.is_mapped(F.col("flag"))).select(
        F.lit(library).alias("library"), "name", "row_key", "chrom", "s", (F.col("s") + F.length("seq")).alias("e"), fwd.alias("fwd"), S.five_prime_base(F.col("seq"), fwd).alias("nt5"),
        F.length("seq").alias("length"), edits.alias("nm"), S.collapsed_count(F.col("name"), kind).alias("read_count"), "seq",
    )
