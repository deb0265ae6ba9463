"""Reading BAM: the blocks of a file are inflated one after the other in a worker."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidlake.runtime import map_arrow

from .text import with_flags

#: Letters of packed bases and of packed CIGAR operations, in the order of their numbers.
BASES = "=ACMGRSVTWYHKDBN"
CIGAR = "MIDNSHP=X"
RAW = "path string, qname string, flag int, rname string, pos int, mapq int, cigar string, mate_rname string, mate_pos int, tlen int, seq string, qual string, tags array<string>"
#: Alignments sent to Spark at once.
ROWS = 2000


def inflated(data: bytes) -> Iterator[bytes]:
    """The contents of the gzip members of a file, each a block of at most 64 KB."""
    view = memoryview(data)
    while len(view):
        engine = zlib.decompressobj(31)
        yield engine.decompress(view) + engine.flush()
        view = view[len(view) - len(engine.unused_data) :]


class Stream:
    """Bytes of successive blocks, as they are asked for."""

    def __init__(self, blocks: Iterator[bytes]):
        self.blocks, self.held = blocks, bytearray()

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            block = next(self.blocks, None)
            if block is None:
                break
            self.held += block
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def number(self) -> int | None:
        got = self.take(4)
        return struct.unpack("<i", got)[0] if len(got) == 4 else None


SIZES = {"A": (1, "c"), "c": (1, "b"), "C": (1, "B"), "s": (2, "h"), "S": (2, "H"), "i": (4, "i"), "I": (4, "I"), "f": (4, "f")}


def tags_of(data: bytes) -> list[str]:
    """Typed tags as in SAM text."""
    out, at = [], 0
    while at + 3 <= len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            value, at = data[at:end].decode(), end + 1
        elif kind == "B":
            inner, count = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            size, code = SIZES[inner]
            value = ",".join([inner, *map(str, struct.unpack_from(f"<{count}{code}", data, at + 5))])
            at += 5 + count * size
        else:
            size, code = SIZES[kind]
            got = struct.unpack_from("<" + code, data, at)[0]
            value, at = got.decode() if kind == "A" else str(got), at + size
        out.append(f"{name}:{'i' if kind in 'cCsSiI' else kind}:{value}")
    return out


def alignment(data: bytes, names: list[str]) -> tuple:
    """One alignment from its bytes after the length."""
    tid, pos, l_name, mapq, _, n_cigar, flag, l_seq, mate, mate_pos, tlen = struct.unpack_from("<iiBBHHHiiii", data)
    at = 32 + l_name
    cigar = "".join(f"{x >> 4}{CIGAR[x & 15]}" for x in struct.unpack_from(f"<{n_cigar}I", data, at)) or "*"
    at += 4 * n_cigar
    packed = data[at : at + (l_seq + 1) // 2]
    seq = "".join(BASES[b >> 4] + BASES[b & 15] for b in packed)[:l_seq]
    at += len(packed)
    quals = data[at : at + l_seq]
    qual = "*" if not quals or quals[0] == 255 else "".join(chr(q + 33) for q in quals)
    name_of = lambda i: names[i] if i >= 0 else "*"
    return data[32 : 31 + l_name].decode(), flag, name_of(tid), pos, mapq, cigar, name_of(mate), mate_pos, tlen, seq, qual, tags_of(data[at + l_seq :])


def bam(spark: SparkSession, *paths: str) -> DataFrame:
    """Alignments of BAM files, with the columns of ``text.sam`` and the file's path. A file is one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_out = [f.split()[0] for f in RAW.split(", ")]
        kinds = [{"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}[f.split()[1]] for f in RAW.split(", ")]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names_out)

        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stream = Stream(inflated(content))
                if stream.take(4) != b"BAM\1":
                    raise ValueError(f"{path} isn't BAM")
                stream.take(stream.number())
                names = []
                for _ in range(stream.number()):
                    names.append(stream.take(stream.number())[:-1].decode())
                    stream.number()
                rows = []
                while (size := stream.number()) is not None:
                    rows.append((path, *alignment(stream.take(size), names)))
                    if len(rows) == ROWS:
                        yield out(rows)
                        rows = []
                yield out(rows)

    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return with_flags(map_arrow(files, run, RAW))
