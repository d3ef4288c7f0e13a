"""Records of large text files, read in splits.

Spark reads a file's splits apart, cut at a separator. Whether a split starts inside a
record is settled first: each split tells, for every state it may start in (in quotes, in a
comment), which state it ends in and how far its nesting went, and these small rows are
strung together by file. Then each split gives its whole records, and what goes over its
ends is put together by the split the record began in. No file is one task's, however large.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.session import shared_dir
from terralode.sources.listing import source_path

# The functions run in tasks travel with the job: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Records are handed back once they come to so many bytes or rows.
BATCH_BYTES = 16 * 1024 * 1024
BATCH_ROWS = 8192
# Of a JSON file's outermost object so much is looked at, within its first split, to tell what it holds.
SKELETON_BYTES = 64 * 1024


class Cutter:
    """How a format is cut. ``states`` are the flags a split may start with, 0 the plain one.

    ``base`` is the nesting between records. A token ends with the separator.
    """

    states = 1
    base = 0
    separator = "\n"

    def sums(self, token: bytes, flag: int) -> list[tuple[int, int, int]]:
        """Flag, change of nesting and change of all elements' nesting after each step of a token."""
        return [(after, delta, extra) for _, after, delta, extra in self.steps(token, flag)]

    def steps(self, token: bytes, flag: int) -> list[tuple[bytes, int, int, int]]:
        """The token's pieces, a record ending at the end of a piece if at all, with what ``sums`` tells."""
        raise NotImplementedError

    def inside(self, flag: int, depth: int, base: int) -> bool:
        """Whether a split that starts so starts inside a record."""
        return depth > base

    def opens(self, piece: bytes, flag: int, depth: int, base: int) -> int | None:
        """Where in a piece that follows a record's end the next record starts."""
        raise NotImplementedError

    def base_of(self, head: bytes) -> int | None:
        """Nesting between a file's records, from its beginning; null for a file of another kind."""
        return self.base

    def whole(self, flag: int, depth: int, extra: int, missing: bool | None) -> bool:
        """Whether a file that ends so is complete; ``missing`` tells that its last token has no separator, null if unknown."""
        return flag == 0

    def trimmed(self, record: bytes) -> bytes:
        return record

    def skips(self, between: bytes, base: int) -> bool:
        """Whether this may stand between two records."""
        return True


class DelimitedLines(Cutter):
    """Delimited text: a record goes on where a line ends inside a quoted field."""

    states = 2

    def __init__(self, delimiter: str = ","):
        self.quoted = delimiter.encode() + b'"'

    def after(self, line: bytes, flag: int) -> int:
        """Whether the line ends inside quotes; only a quote at a field's start opens them."""
        at, first = 0, not flag
        while True:
            if flag:
                at = line.find(b'"', at)
                while at != -1 and line[at + 1 : at + 2] == b'"':
                    at = line.find(b'"', at + 2)
                if at == -1:
                    return 1
                flag, at = 0, at + 1
            elif first and line.startswith(b'"'):
                flag, at = 1, 1
            else:
                at = line.find(self.quoted, at)
                if at == -1:
                    return 0
                flag, at = 1, at + len(self.quoted)
            first = False

    def steps(self, token: bytes, flag: int) -> list[tuple[bytes, int, int, int]]:
        if b"\r" not in token:
            return [(token, self.after(token, flag) if flag or b'"' in token else 0, 0, 0)]
        lines = token[:-1].split(b"\r")  # a line may end with either sign, or both
        if len(lines) > 1 and not lines[-1]:
            lines[-2:] = [lines[-2] + b"\r\n"]
        else:
            lines[-1] += b"\n"
        lines = [line + b"\r" for line in lines[:-1]] + lines[-1:]
        out = []
        for line in lines:
            flag = self.after(line, flag)
            out.append((line, flag, 0, 0))
        return out

    def inside(self, flag: int, depth: int, base: int) -> bool:
        return flag == 1

    def opens(self, piece: bytes, flag: int, depth: int, base: int) -> int | None:
        return 0 if piece.strip() else None

    def trimmed(self, record: bytes) -> bytes:
        for end in (b"\r\n", b"\n", b"\r"):
            if record.endswith(end):
                return record[: -len(end)]
        return record


STRING = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
STRING_END = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
BRACKET = re.compile(rb"[{}\[\]]")


class JsonElements(Cutter):
    """The elements of the one array a file holds, or the one object; with ``features`` those of a GeoJSON collection."""

    separator = "}"
    states = 2
    base = 1

    def __init__(self, features: bool = False):
        self.features = features
        self.base = 2 if features else 1

    def plain(self, token: bytes, flag: int) -> tuple[bytes, int]:
        """The token with its strings blanked, and whether it ends in one."""
        lead = 0
        if flag:
            end = STRING_END.match(token)
            if end is None:
                return b"", 1
            lead, token = end.end(), token[end.end() :]
        if b'"' in token:
            token = STRING.sub(lambda m: b" " * len(m[0]), token)
            open_ = token.find(b'"')
            if open_ != -1:
                return b" " * lead + token[:open_], 1
        return b" " * lead + token, 0

    def steps(self, token: bytes, flag: int) -> list[tuple[bytes, int, int, int]]:
        text, after = self.plain(token, flag)
        return [(token, after, text.count(b"{") + text.count(b"[") - text.count(b"}") - text.count(b"]"), 0)]

    def opens(self, piece: bytes, flag: int, depth: int, base: int) -> int | None:
        for found in BRACKET.finditer(self.plain(piece, flag)[0]):
            if found[0] in b"{[":
                if depth == base:
                    return found.start()
                depth += 1
            else:
                depth -= 1
        return None

    def base_of(self, head: bytes) -> int | None:
        head = head.removeprefix(b"\xef\xbb\xbf").strip()
        if not self.features:
            return 1 if head.startswith(b"[") else 0 if head.startswith(b"{") else None
        outer = self.outermost(head)
        if re.search(rb'"features"\s*:', outer):
            return 2
        return 0 if re.search(rb'"type"\s*:\s*"Feature"', outer) else None

    def outermost(self, head: bytes) -> bytes:
        """What stands directly in the outermost object."""
        blanked, depth, start, out = self.plain(head, 0)[0], 0, 0, []
        for found in BRACKET.finditer(blanked):
            if found[0] in b"{[":
                if depth == 1:
                    out.append(head[start : found.start()])
                depth += 1
            else:
                if depth == 1:
                    out.append(head[start : found.start()])
                depth -= 1
            if depth == 1:
                start = found.end()
        if depth == 1:
            out.append(head[start:])
        return b" ".join(out)

    def skips(self, between: bytes, base: int) -> bool:
        return self.features or not between.strip(b"[]},\xef\xbb\xbf \t\r\n")

    def whole(self, flag: int, depth: int, extra: int, missing: bool | None) -> bool:
        # The separator that the last token may lack was counted all the same.
        ends = (0, -1) if missing is None else (-1,) if missing else (0,)
        return flag == 0 and depth in ends


TAG = re.compile(rb"<(/?)[A-Za-z_:\x80-\xff][^\s/>]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(/?)>")
HIDDEN = {b"<!--": (1, b"-->"), b"<![CDATA[": (2, b"]]>")}


class XmlElements(Cutter):
    """The elements of one name, the outermost where they are nested."""

    states = 3

    def __init__(self, tag: str):
        name = re.escape(tag.encode())
        self.separator = f"</{tag}>"
        self.event = re.compile(rb"<!--|<!\[CDATA\[|<" + name + rb"(?=[\s/>])|</" + name + rb"\s*>")
        self.rest_of_tag = re.compile(rb"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>")

    def steps(self, token: bytes, flag: int) -> list[tuple[bytes, int, int, int]]:
        out, at, start, delta, visible = [], 0, 0, 0, []
        if flag:
            end = b"-->" if flag == 1 else b"]]>"
            at = token.find(end)
            if at == -1:
                return [(token, flag, 0, 0)]
            at += len(end)
        seen, flag = at, 0
        while (found := self.event.search(token, at)) is not None:
            if found[0] in HIDDEN:
                flag, end = HIDDEN[found[0]]
                visible.append(token[seen : found.start()])
                stop = token.find(end, found.end())
                if stop == -1:
                    seen = len(token)
                    break
                flag, at = 0, stop + len(end)
                seen = at
            elif found[0].startswith(b"</"):
                at = found.end()
                visible.append(token[seen:at])
                out.append((token[start:at], 0, delta - 1, self.nesting(visible)))
                start = seen = at
                delta, visible = 0, []
            else:
                rest = self.rest_of_tag.match(token, found.end())
                at = rest.end() if rest else len(token)
                if rest and token[at - 2 : at] == b"/>":
                    visible.append(token[seen:at])
                    out.append((token[start:at], 0, delta, self.nesting(visible)))
                    start = seen = at
                    delta, visible = 0, []
                else:
                    delta += 1
        if start < len(token):
            visible.append(token[seen:])
            out.append((token[start:], flag, delta, self.nesting(visible)))
        return out

    def nesting(self, visible: list[bytes]) -> int:
        """Elements opened less elements closed."""
        return sum(-1 if closing else 0 if empty else 1 for part in visible for closing, empty in TAG.findall(part))

    def opens(self, piece: bytes, flag: int, depth: int, base: int) -> int | None:
        at = 0
        if flag:
            at = piece.find(b"-->" if flag == 1 else b"]]>")
            if at == -1:
                return None
        while (found := self.event.search(piece, at)) is not None:
            if found[0] in HIDDEN:
                stop = piece.find(HIDDEN[found[0]][1], found.end())
                if stop == -1:
                    return None
                at = stop + 3
            elif found[0].startswith(b"</"):
                at = found.end()
            else:
                return found.start()
        return None

    def whole(self, flag: int, depth: int, extra: int, missing: bool | None) -> bool:
        # Only the separator a last token lacks may have been closed too much.
        return flag == 0 and depth in (0, -1) and depth == extra


def tokens(spark: SparkSession, path: str | list[str], cutter: Cutter) -> DataFrame:
    """``key, path, block, size, value`` of every token; a split's stand in order."""
    text = spark.read.option("lineSep", cutter.separator).text(path)
    found = text.select(
        source_path().alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").cast("binary").alias("value"),
    )
    return found.select(F.xxhash64("path", "block").alias("key"), "path", "block", "size", "value")


SUMMARY = "path string, block bigint, size bigint, ends array<int>, deltas array<bigint>, extras array<bigint>, lows array<bigint>, n_tokens bigint, n_bytes bigint, head binary"
SUMMARY_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary()]


class Summary:
    """What a split does to each state it may start in; states that have come together are followed once."""

    def __init__(self, path: str, block: int, size: int, states: int):
        self.place = (path, block, size)
        # By flag now: the starts that lead here, with nesting, all elements' nesting, and least nesting at a record's possible end.
        self.now: dict[int, list[list]] = {flag: [[flag, 0, 0, None]] for flag in range(states)}
        self.n_tokens = self.n_bytes = 0
        self.head = b""

    def take(self, cutter: Cutter, token: bytes) -> None:
        self.n_tokens += 1
        self.n_bytes += len(token)
        if self.place[1] == 0 and len(self.head) < SKELETON_BYTES:
            self.head += token[:SKELETON_BYTES]
        after: dict[int, list[list]] = {}
        for flag, starts in self.now.items():
            end = flag
            for end, delta, extra in cutter.sums(token, flag):
                for start in starts:
                    start[1] += delta
                    start[2] += extra
                    if end == 0 and (start[3] is None or start[1] < start[3]):
                        start[3] = start[1]
            after.setdefault(end, []).extend(starts)
        self.now = after

    def row(self) -> tuple:
        by_start = sorted((start, end, *rest) for end, starts in self.now.items() for start, *rest in starts)
        _, ends, deltas, extras, lows = map(list, zip(*by_start))
        return (*self.place, ends, deltas, extras, lows, self.n_tokens, self.n_bytes, self.head)


def summariser(cutter: Cutter):
    separator = cutter.separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, rows = None, None, []
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at, (key, value) in enumerate(zip(keys, batch.column(4))):
                if key != last:
                    if held is not None:
                        rows.append(held.row())
                    held, last = Summary(batch.column(1)[at].as_py(), batch.column(2)[at].as_py(), batch.column(3)[at].as_py(), cutter.states), key
                held.take(cutter, value.as_py() + separator)
        if held is not None:
            rows.append(held.row())
        columns = list(zip(*rows)) or [()] * len(SUMMARY_KINDS)
        names = [c.split(" ")[0] for c in SUMMARY.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, SUMMARY_KINDS)], names=names)

    return run


STARTS = "path string, block bigint, flag int, depth bigint, owner bigint, base int, complete boolean"
COMPRESSED = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst")


def stringer(cutter: Cutter):
    """A file's splits strung together: how each starts, and on the last row whether the file is complete."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("block").to_pylist()
        path, size = rows[0]["path"], rows[0]["size"]
        base = cutter.base_of(rows[0]["head"])
        flag = depth = extra = owner = 0
        out = []
        for row in rows:
            out.append([path, row["block"], flag, depth, owner, base, None])
            low = row["lows"][flag]
            # A record that is open at the end began here if any ended, or none was open, before.
            if low is not None and depth + low <= (base or 0) or not cutter.inside(flag, depth, base or 0):
                owner = row["block"]
            depth, extra, flag = depth + row["deltas"][flag], extra + row["extras"][flag], row["ends"][flag]
        held = sum(r["n_bytes"] for r in rows)
        # Of a compressed file, or one whose byte-order mark was taken off, that is not known.
        missing = None if path.lower().endswith(COMPRESSED) or held < size else held > size
        out.append([path, -1, flag, depth, owner, base, base is not None and cutter.whole(flag, depth, extra, missing)])
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
        return pa.table([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=[c.split(" ")[0] for c in STARTS.split(", ")])

    return run


CUT = "path string, owner bigint, block bigint, nth bigint, whole boolean, record binary"
CUT_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]


class Block:
    """One split being cut."""

    def __init__(self, cutter: Cutter, path: str, block: int, flag: int, depth: int, owner: int, base: int):
        self.cutter, self.path, self.block, self.base = cutter, path, block, base
        self.flag, self.depth, self.nth = flag, depth, 0
        self.open = cutter.inside(flag, depth, base)
        # Of a record that began in an earlier split only its owner is known.
        self.owner, self.earlier, self.pieces = owner, self.open, []

    def take(self, token: bytes) -> Iterator[tuple]:
        for piece, flag, delta, _ in self.cutter.steps(token, self.flag):
            if not self.open:
                at = self.cutter.opens(piece, self.flag, self.depth, self.base)
                if not self.cutter.skips(piece if at is None else piece[:at], self.base):
                    raise ValueError(f"{self.path}: other things than objects between its elements")
                if at is not None:
                    self.open, self.earlier, self.owner = True, False, self.block
                    piece = piece[at:]
            if self.open:
                self.pieces.append(piece)
            self.flag, self.depth = flag, max(self.depth + delta, 0)
            if self.open and flag == 0 and self.depth <= self.base:
                yield self.row(not self.earlier)
                self.open, self.earlier, self.pieces = False, False, []

    def row(self, whole: bool) -> tuple:
        nth = None if self.earlier else self.nth
        self.nth += 1
        record = b"".join(self.pieces)
        return self.path, self.owner, self.block, nth, whole, self.cutter.trimmed(record) if whole else record

    def rest(self) -> Iterator[tuple]:
        if self.open and self.pieces:
            yield self.row(False)


def block_cutter(cutter: Cutter, starts, wanted: bool):
    """Records that are whole in a split, or the parts of the others."""
    separator = cutter.separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, flags, depths, owners, bases = starts.value
        held, last, rows, size = None, None, [], 0

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(CUT_KINDS)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, CUT_KINDS)], names=[c.split(" ")[0] for c in CUT.split(", ")])

        for batch in batches:
            for at, (key, value) in enumerate(zip(batch.column(0).to_pylist(), batch.column(4))):
                if key != last:
                    if held is not None:
                        rows += [r for r in held.rest() if r[4] == wanted]
                    place, last = int(np.searchsorted(keys, key)), key
                    held = Block(cutter, batch.column(1)[at].as_py(), batch.column(2)[at].as_py(), int(flags[place]), int(depths[place]), int(owners[place]), int(bases[place]))
                for row in held.take(value.as_py() + separator):
                    if row[4] == wanted:
                        rows.append(row)
                        size += len(row[5])
                if size > BATCH_BYTES or len(rows) > BATCH_ROWS:
                    yield batch_of()
                    rows, size = [], 0
        if held is not None:
            rows += [r for r in held.rest() if r[4] == wanted]
        yield batch_of()

    return run


class Records:
    """The records of files and what is wrong with files.

    ``rows`` has ``path, block, nth, record``: by block and nth they stand as in the file.
    ``broken`` are the paths that are not of the format or end too early; their records are left out.
    ``single`` are the paths that hold one record as a whole.
    """

    def __init__(self, rows: DataFrame, broken: list[str], single: list[str]):
        self.rows, self.broken, self.single = rows, broken, single

    def texts(self) -> DataFrame:
        """``path, text`` of all records; fails where a file is broken or its bytes are not UTF-8."""
        if self.broken:
            raise ValueError(f"malformed or not complete: {', '.join(self.broken)}")
        return self.rows.select("path", F.validate_utf8(F.col("record").cast("string")).alias("text"))


def read_records(spark: SparkSession, path: str | list[str], cutter: Cutter) -> Records:
    """Records of all files of a path, cut in splits.

    The driver holds some 32 bytes a split of the input, and the names of the files.
    """
    found = tokens(spark, path, cutter)
    summary = found.mapInArrow(summariser(cutter), SUMMARY)
    strung = summary.groupBy("path").applyInArrow(stringer(cutter), STARTS)
    starts = strung.select(F.xxhash64("path", "block").alias("key"), "flag", "depth", "owner", F.coalesce("base", F.lit(0)).alias("base"), "block", "complete", F.when(F.col("block") == -1, F.col("path")).alias("path")).toArrow()
    ends = starts.filter(pc.equal(starts["block"], -1)).select(["path", "complete", "base"]).to_pylist()
    starts = starts.filter(pc.not_equal(starts["block"], -1)).sort_by("key")
    broken = sorted(r["path"] for r in ends if not r["complete"])
    arrays = [starts[c].to_numpy().astype(k) for c, k in zip(("key", "flag", "depth", "owner", "base"), ("i8", "i1", "i8", "i8", "i1"))]
    shared = spark.sparkContext.broadcast(arrays)
    whole = found.mapInArrow(block_cutter(cutter, shared, True), CUT).select("path", "block", "nth", "record")
    # A split that starts inside a record has the one before end there.
    if any(cutter.inside(flag, depth, base) for flag, depth, base in set(zip(*(arrays[i].tolist() for i in (1, 2, 4))))):
        fragments = shared_dir(spark, "fragments")
        found.mapInArrow(block_cutter(cutter, shared, False), CUT).write.parquet(fragments)
        parts = spark.read.schema(CUT).parquet(fragments).groupBy("path", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"), F.max("nth").alias("nth"))
        record = F.expr("aggregate(parts, cast('' as binary), (held, p) -> concat(held, p.record))")
        whole = whole.union(parts.select("path", F.col("owner").alias("block"), "nth", trim_record(cutter, record).alias("record")))
    if broken:
        # Names of broken files only: they come from the listing the driver holds anyway.
        whole = whole.where(~F.col("path").isin(broken))
    return Records(whole, broken, sorted(r["path"] for r in ends if r["complete"] and r["base"] < cutter.base))


def trim_record(cutter: Cutter, record):
    """A delimited record without its line end, as ``trimmed`` gives whole ones."""
    if not isinstance(cutter, DelimitedLines):
        return record
    return F.regexp_replace(record.cast("string"), r"(\r\n|\n|\r)\z", "").cast("binary")
