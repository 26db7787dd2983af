"""Binary shard formats as Python Data Sources.

Token shards: ``<prefix>_%05d.bin`` — headerless little-endian uint16 token ids —
plus ``<prefix>_manifest.json`` (``[{path, num_tokens, dtype}]``).

Fine-tuning shards: ``<prefix>_input_ids.bin`` (uint16) and ``<prefix>_labels.bin``
(int32), row-major ``(num_examples, seq_len)``, plus ``<prefix>_metadata.json``.
Metadata with a list of ``parts`` (one contiguous row range a file) can be read too.

Writers take Arrow buffers, write to temporary files and the driver-side ``commit``
renames them, so retried or speculative tasks never leave partial files; a write
replaces what is there, appending is refused. Readers split each
file into byte ranges, one input partition each, and return Arrow batches.

The output folder must be visible to every executor (a shared file system).
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

MAX_UINT16 = 65535
TASK_TOKENS = 1 << 20  # of small shards that share a task


# ---------------------------------------------------------------- manifests


def shard_name(prefix: str, index: int) -> str:
    return f"{prefix}_{index:05d}.bin"


def find_manifests(data_dir: str, split: str) -> list[str]:
    """Manifests of a split: the one in ``data_dir`` that bears its name; in a folder named
    like the split, and in a sub-folder so named, every manifest counts."""

    def listed(folder: str, name: str = "") -> list[str]:
        names = os.listdir(folder) if os.path.isdir(folder) else []
        return [os.path.join(folder, n) for n in sorted(names) if n.endswith("_manifest.json") and (not name or n == f"{name}_manifest.json")]

    own_folder = listed(data_dir) if os.path.basename(os.path.abspath(data_dir)) == split else []
    for choice in (listed(data_dir, split), own_folder, listed(os.path.join(data_dir, split))):
        if choice:
            return choice
    raise FileNotFoundError(f"no shard manifest for split {split!r} in or below {data_dir}")


def load_manifest(data_dir: str, split: str) -> list[dict]:
    """Entries of the split's manifests with ``absolute_path``, in manifest order."""
    shards = []
    for path in find_manifests(data_dir, split):
        with open(path, encoding="utf-8") as f:
            shards += [{**item, "absolute_path": os.path.join(os.path.dirname(os.path.abspath(path)), item["path"])} for item in json.load(f)]
    if not shards:
        raise RuntimeError(f"the shard manifest of split {split!r} in {data_dir} lists no shard")
    return shards


# ---------------------------------------------------------------- token shards


@dataclass
class TokenRange(InputPartition):
    split: str
    shard: int
    path: str
    start: int  # first token
    stop: int  # one past the last token
    first_window: int = 0


@dataclass
class TokenRanges(InputPartition):
    """What one task reads: a range of a large shard or several small shards."""

    ranges: list


class TokenShardSource(DataSource):
    """``spark.read.format("token_shards").option("split", "train").load(dir)``

    Options: ``split``; ``mode`` = ``chunks`` (default; ``chunk_tokens`` tokens per row)
    or ``windows`` (sequential windows of ``seq_len + 1`` tokens: starts 0, L, 2L, …
    below ``num_tokens - L - 1``, numbered across shards, ``max_windows``);
    ``partition_tokens`` (tokens per input partition; small shards share one)."""

    @classmethod
    def name(cls):
        return "token_shards"

    def schema(self):
        if self.options.get("mode", "chunks") == "windows":
            return "split string, shard int, start long, window_idx long, input_ids array<int>, labels array<int>"
        return "split string, shard int, start long, tokens array<int>"

    def reader(self, schema):
        return TokenShardReader(self.options)

    def writer(self, schema, overwrite):
        return TokenShardWriter(self.options, overwrite)


class TokenShardReader(DataSourceReader):
    def __init__(self, options):
        self.dir = options.get("path")
        self.split = options.get("split", "train")
        self.mode = options.get("mode", "chunks")
        self.chunk = int(options.get("chunk_tokens", 65536))
        self.seq_len = int(options.get("seq_len", 2048))
        self.max_windows = int(options["max_windows"]) if "max_windows" in options else None
        self.part_tokens = int(options.get("partition_tokens", 8 << 20))

    def partitions(self):
        # The manifest is one entry per shard: small, read on the driver.
        parts = []
        window_base = 0
        L = self.seq_len
        for i, item in enumerate(load_manifest(self.dir, self.split)):
            n = int(item["num_tokens"])
            if self.mode == "windows":
                max_start = n - L - 1
                n_win = 0 if max_start <= 0 else (max_start - 1) // L + 1
                per = max(1, self.part_tokens // L)
                for w0 in range(0, n_win, per):
                    w1 = min(n_win, w0 + per)
                    parts.append(TokenRange(self.split, i, item["absolute_path"], w0 * L, w1 * L, window_base + w0))
                window_base += n_win
            else:
                step = max(self.chunk, (self.part_tokens // self.chunk) * self.chunk)
                for s in range(0, n, step):
                    parts.append(TokenRange(self.split, i, item["absolute_path"], s, min(n, s + step)))
        return self._packed(parts)

    def _packed(self, parts: list[TokenRange]) -> list[TokenRanges]:
        """Small ranges share a task, up to ``TASK_TOKENS`` tokens."""
        out, have = [], 0
        for p in parts:
            if not out or have + p.stop - p.start > min(TASK_TOKENS, self.part_tokens):
                out.append(TokenRanges([]))
                have = 0
            out[-1].ranges.append(p)
            have += p.stop - p.start
        return out

    def read(self, partition: TokenRanges):
        for part in partition.ranges:
            yield from self._read(part)

    def _read(self, partition: TokenRange):
        arr = np.memmap(partition.path, dtype="<u2", mode="r")
        L = self.seq_len
        if self.mode == "windows":
            starts = np.arange(partition.start, partition.stop, L, dtype=np.int64)
            idx = partition.first_window + np.arange(len(starts), dtype=np.int64)
            if self.max_windows is not None:
                keep = idx < self.max_windows
                starts, idx = starts[keep], idx[keep]
            if len(starts) == 0:
                return
            win = np.stack([np.asarray(arr[s : s + L + 1], dtype=np.int32) for s in starts])
            offsets = pa.array(np.arange(len(starts) + 1, dtype=np.int32) * L)
            inputs = pa.ListArray.from_arrays(offsets, pa.array(win[:, :-1].reshape(-1)))
            labels = pa.ListArray.from_arrays(offsets, pa.array(win[:, 1:].reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([partition.split] * len(starts)), pa.array([partition.shard] * len(starts), pa.int32()),
                 pa.array(starts), pa.array(idx), inputs, labels],
                names=["split", "shard", "start", "window_idx", "input_ids", "labels"],
            )
        else:
            starts = np.arange(partition.start, partition.stop, self.chunk, dtype=np.int64)
            data = np.asarray(arr[partition.start : partition.stop], dtype=np.int32)
            offsets = np.append(starts - partition.start, partition.stop - partition.start).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([partition.split] * len(starts)), pa.array([partition.shard] * len(starts), pa.int32()),
                 pa.array(starts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(data))],
                names=["split", "shard", "start", "tokens"],
            )


@dataclass
class ShardFiles(WriterCommitMessage):
    files: list  # (shard, tmp_path, num_tokens)


def _no_append(overwrite: bool, what: str) -> None:
    if not overwrite:
        raise ValueError(f"{what} are written whole: use mode('overwrite')")


def _uint16(values: np.ndarray) -> np.ndarray:
    if values.size and (values.max() > MAX_UINT16 or values.min() < 0):
        raise ValueError("token id does not fit in uint16; vocabulary must be at most 65,536")
    return values.astype("<u2")


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and flat values of a list column without nulls."""
    offsets = np.asarray(column.offsets, dtype="i8")
    return offsets - offsets[0], np.asarray(column.values[int(offsets[0]) : int(offsets[-1])])


class TokenShardWriter(DataSourceArrowWriter):
    """Rows ``(shard, shard_pos, tokens)``: every shard's rows in one task, ordered by
    ``shard_pos`` (see ``write_token_shards``). Token buffers go to the file as they are."""

    def __init__(self, options, overwrite):
        self.dir = options["path"]
        self.prefix = options.get("prefix", "train")
        _no_append(overwrite, "token shards")
        os.makedirs(self.dir, exist_ok=True)

    def write(self, iterator):
        tmp_dir = os.path.join(self.dir, "_temporary")
        os.makedirs(tmp_dir, exist_ok=True)
        attempt = uuid.uuid4().hex
        files: list[tuple[int, str, int]] = []
        cur, fh, tmp, written = None, None, "", 0
        for batch in iterator:
            shards, at = (np.asarray(batch.column(c), dtype="i8") for c in ("shard", "shard_pos"))
            offsets, values = _lists(batch.column("tokens"))
            ids = _uint16(values)
            starts = np.flatnonzero(np.diff(shards, prepend=shards[:1] - 1))
            for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(shards)]):
                shard = int(shards[i])
                if shard != cur:
                    if fh is not None:
                        fh.close()
                        files.append((cur, tmp, written))
                    cur, written = shard, 0
                    tmp = os.path.join(tmp_dir, f"{shard_name(self.prefix, shard)}.{attempt}")
                    fh = open(tmp, "wb")  # noqa: SIM115
                wanted = written + offsets[i:j] - offsets[i]
                if (at[i:j] != wanted).any():
                    raise RuntimeError(f"shard {shard}: rows are not in the order of shard_pos, or some are missing")
                fh.write(ids[offsets[i] : offsets[j]].tobytes())
                written += int(offsets[j] - offsets[i])
        if fh is not None:
            fh.close()
            files.append((cur, tmp, written))
        return ShardFiles(files)

    def commit(self, messages):
        entries = []
        for m in messages:
            for shard, tmp, n in m.files:
                final = os.path.join(self.dir, shard_name(self.prefix, shard))
                os.replace(tmp, final)
                entries.append({"path": shard_name(self.prefix, shard), "num_tokens": int(n), "dtype": "uint16", "_i": shard})
        entries.sort(key=lambda e: e.pop("_i"))
        ours = {e["path"] for e in entries}
        for name in os.listdir(self.dir):  # shards of an earlier, longer write
            if re.fullmatch(re.escape(self.prefix) + r"_\d{5,}\.bin", name) and name not in ours:
                os.remove(os.path.join(self.dir, name))
        with open(os.path.join(self.dir, f"{self.prefix}_manifest.json"), "w", encoding="utf-8") as fh:
            json.dump(entries, fh, indent=2, ensure_ascii=False)

    def abort(self, messages):
        for m in messages or []:
            if m is None:
                continue
            for _shard, tmp, _n in m.files:
                if os.path.exists(tmp):
                    os.remove(tmp)


def _gather(batches, paths: dict, seq_len: int):
    """Executor side: read ``seq_len + 1`` tokens at each ``(shard, start)`` from the
    memory-mapped shard files."""
    L = seq_len
    maps: dict = {}
    for rb in batches:
        shard = rb.column("shard").to_numpy(zero_copy_only=False)
        start = rb.column("start").to_numpy(zero_copy_only=False)
        win = np.empty((len(shard), L + 1), dtype=np.int32)
        for i, (sh_i, st_i) in enumerate(zip(shard, start)):
            m = maps.get(int(sh_i))
            if m is None:
                m = maps[int(sh_i)] = np.memmap(paths[int(sh_i)], dtype="<u2", mode="r")
            win[i] = m[int(st_i) : int(st_i) + L + 1]
        offsets = pa.array(np.arange(len(shard) + 1, dtype=np.int32) * L)
        cols = [rb.column(i) for i in range(rb.num_columns)]
        names = list(rb.schema.names)
        yield pa.RecordBatch.from_arrays(
            cols + [pa.ListArray.from_arrays(offsets, pa.array(win[:, :-1].reshape(-1))),
                    pa.ListArray.from_arrays(offsets, pa.array(win[:, 1:].reshape(-1)))],
            names=names + ["input_ids", "labels"],
        )


def gather_windows(windows: DataFrame, data_dir: str, split: str, seq_len: int) -> DataFrame:
    """Windows ``(…, shard, start)`` — e.g. from ``operators.windows.random_windows`` —
    → ``input_ids`` / ``labels`` read from the shard files (inputs are the first
    ``seq_len`` tokens, labels the next-token shift). The shard path table is the
    manifest (one entry per shard); each task memory-maps only what it reads."""
    paths = {i: item["absolute_path"] for i, item in enumerate(load_manifest(data_dir, split))}
    schema = windows.schema.simpleString()[len("struct<"):-1] + ", input_ids array<int>, labels array<int>"
    return windows.mapInArrow(lambda it: _gather(it, paths, seq_len), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TokenShardSource)
    spark.dataSource.register(SFTShardSource)


def write_token_shards(pieces: DataFrame, out_dir: str, prefix: str, tokens_col: str = "tokens", shards: int | None = None, tokens: int | None = None) -> None:
    """``pieces(shard, shard_pos, tokens)`` → shard files + manifest, replacing what is
    there. One shuffle, one task per shard (``shards``: how many; counted when not
    given), or, where ``tokens`` tells how many tokens there are, per neighbouring shards of
    about ``TASK_TOKENS`` tokens; rows sorted by position inside each task; no row collected
    anywhere."""
    spark = pieces.sparkSession
    register(spark)
    if shards is None:
        shards = pieces.agg(F.max("shard")).first()[0]
        shards = 0 if shards is None else shards + 1
    shards = int(shards)
    each = max(1, TASK_TOKENS * shards // tokens) if tokens else 1
    (
        pieces.select(F.col("shard").cast("long"), F.col("shard_pos").cast("long"), F.col(tokens_col).alias("tokens"))
        .repartitionById(max(1, -(-shards // each)), F.floor(F.col("shard") / F.lit(each)).cast("int"))
        .sortWithinPartitions("shard", "shard_pos")
        .write.format("token_shards")
        .option("prefix", prefix)
        .mode("overwrite")
        .save(out_dir)
    )


def read_token_shards(spark: SparkSession, data_dir: str, split: str, **options) -> DataFrame:
    register(spark)
    reader = spark.read.format("token_shards").option("split", split)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load(data_dir)


# ---------------------------------------------------------------- fine-tuning shards


@dataclass
class RowRange(InputPartition):
    input_path: str
    labels_path: str
    first_row: int  # global row of the file's first row
    start: int  # first row within the file
    stop: int


class SFTShardSource(DataSource):
    """``spark.read.format("sft_shards").option("split", "train").load(dir)`` →
    ``row, input_ids, labels, attention_mask`` (mask = id != pad)."""

    @classmethod
    def name(cls):
        return "sft_shards"

    def schema(self):
        return "row long, input_ids array<int>, labels array<int>, attention_mask array<int>"

    def reader(self, schema):
        return SFTShardReader(self.options)

    def writer(self, schema, overwrite):
        return SFTShardWriter(self.options, overwrite)


def load_sft_metadata(data_dir: str, split: str) -> dict:
    path = os.path.join(data_dir, f"{split}_metadata.json")
    if not os.path.exists(path):
        raise FileNotFoundError(f"Metadata file not found: {path}")
    with open(path, encoding="utf-8") as fh:
        meta = json.load(fh)
    if "parts" not in meta:
        meta["parts"] = [{"input_ids_path": meta["input_ids_path"], "labels_path": meta["labels_path"],
                          "num_examples": meta["num_examples"], "first_row": 0}]
    return meta


class SFTShardReader(DataSourceReader):
    def __init__(self, options):
        self.dir = options.get("path")
        self.split = options.get("split", "train")
        self.rows_per_partition = int(options.get("rows_per_partition", 4096))
        self.pad_id = int(options.get("pad_id", 0))
        self.meta = load_sft_metadata(self.dir, self.split)

    def partitions(self):
        out = []
        for p in self.meta["parts"]:
            n = int(p["num_examples"])
            for s in range(0, n, self.rows_per_partition):
                out.append(RowRange(os.path.join(self.dir, p["input_ids_path"]), os.path.join(self.dir, p["labels_path"]),
                                    int(p["first_row"]), s, min(n, s + self.rows_per_partition)))
        return out

    def read(self, part: RowRange):
        L = int(self.meta["seq_len"])
        ids = np.memmap(part.input_path, dtype="<u2", mode="r").reshape(-1, L)[part.start : part.stop].astype(np.int32)
        labs = np.memmap(part.labels_path, dtype="<i4", mode="r").reshape(-1, L)[part.start : part.stop].astype(np.int32)
        n = ids.shape[0]
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * L)
        mask = (ids != self.pad_id).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.first_row + np.arange(part.start, part.stop, dtype=np.int64)),
             pa.ListArray.from_arrays(offsets, pa.array(ids.reshape(-1))),
             pa.ListArray.from_arrays(offsets, pa.array(labs.reshape(-1))),
             pa.ListArray.from_arrays(offsets, pa.array(mask.reshape(-1)))],
            names=["row", "input_ids", "labels", "attention_mask"],
        )


@dataclass
class SFTRows(WriterCommitMessage):
    num_examples: int
    last_row: int
    row_sum: int


class SFTShardWriter(DataSourceArrowWriter):
    """Rows ``(row, input_ids, labels)`` with rows numbered from 0 without gaps. Every task
    writes its rows to their places in the two files, so any distribution of the rows
    gives the same bytes, a retried task writes the same bytes again, and the files are
    plain ``(num_examples, seq_len)`` arrays. They get their names at the commit."""

    def __init__(self, options, overwrite):
        self.dir = options["path"]
        self.prefix = options.get("prefix", "train")
        self.seq_len = int(options["seq_len"])
        _no_append(overwrite, "fine-tuning shards")
        self.tag = uuid.uuid4().hex
        os.makedirs(os.path.join(self.dir, "_temporary"), exist_ok=True)

    def _paths(self) -> tuple[str, str]:
        return tuple(os.path.join(self.dir, "_temporary", f"{self.prefix}_{kind}.{self.tag}") for kind in ("input_ids", "labels"))

    def write(self, iterator):
        L, out, told = self.seq_len, [], [0, -1, 0]
        try:
            for batch in iterator:
                out = out or [os.open(p, os.O_CREAT | os.O_WRONLY) for p in self._paths()]
                rows = np.asarray(batch.column("row"), dtype="i8")
                for fd, name, dtype in zip(out, ("input_ids", "labels"), ("<u2", "<i4")):
                    offsets, values = _lists(batch.column(name))
                    if (np.diff(offsets) != L).any():
                        raise ValueError(f"every example needs {L} values in {name}")
                    block = (_uint16(values) if dtype == "<u2" else values.astype(dtype)).reshape(-1, L)
                    cuts = np.flatnonzero(np.diff(rows) != 1) + 1  # runs of neighbouring rows
                    for run, first in zip(np.split(block, cuts), rows[np.concatenate(([0], cuts))].tolist() if len(rows) else []):
                        os.pwrite(fd, run.tobytes(), first * L * block.itemsize)
                if len(rows):
                    told = [told[0] + len(rows), max(told[1], int(rows.max())), told[2] + int(rows.sum())]
        finally:
            for fd in out:
                os.close(fd)
        return SFTRows(*told)

    def commit(self, messages):
        told = [m for m in messages if m is not None]
        n, last, total = sum(m.num_examples for m in told), max([m.last_row for m in told], default=-1), sum(m.row_sum for m in told)
        if n == 0:
            raise RuntimeError("there are no examples to write")
        if n != last + 1 or total != n * (n - 1) // 2:
            raise RuntimeError("rows must be numbered from 0 without gaps or repeats")
        names = [f"{self.prefix}_input_ids.bin", f"{self.prefix}_labels.bin"]
        for path, name, size in zip(self._paths(), names, (2, 4)):
            os.truncate(path, n * self.seq_len * size)
            os.replace(path, os.path.join(self.dir, name))
        meta = {"num_examples": n, "seq_len": self.seq_len, "input_ids_path": names[0], "labels_path": names[1]}
        with open(os.path.join(self.dir, f"{self.prefix}_metadata.json"), "w", encoding="utf-8") as f:
            json.dump(meta, f, indent=2, ensure_ascii=False)

    def abort(self, messages):
        for p in self._paths():
            if os.path.exists(p):
                os.remove(p)


def write_sft_shards(examples: DataFrame, out_dir: str, prefix: str, seq_len: int, row_col: str = "row") -> None:
    """``examples(row, input_ids, labels)`` → the two array files and their metadata. Rows
    are written where they are: nothing is shuffled or sorted."""
    spark = examples.sparkSession
    register(spark)
    (
        examples.select(F.col(row_col).cast("long").alias("row"), "input_ids", "labels")
        .write.format("sft_shards")
        .option("prefix", prefix)
        .option("seq_len", str(seq_len))
        .mode("overwrite")
        .save(out_dir)
    )


def read_sft_shards(spark: SparkSession, data_dir: str, split: str, **options) -> DataFrame:
    register(spark)
    reader = spark.read.format("sft_shards").option("split", split)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load(data_dir)
