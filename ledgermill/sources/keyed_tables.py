"""Keyed tables on plain files: versions, and the key range and a Bloom filter of every file.

A version file names the data files of one state of the table with the least and the
greatest key in each (about 250 bytes a file), so a batch is compared with ranges before
anything is read. Files are sorted by key. The Bloom filters stand beside them as rows of
bitmaps and are probed in tasks, for the files whose range holds keys of the batch. The
files that still may hold one are read by their key columns only, and just those that do
hold one are rewritten.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left, bisect_right
from collections import defaultdict
from dataclasses import asdict, dataclass, field
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.operators.bronze import newest, upsert
from ledgermill.session import file_system, read_text

FILE_ROWS = 2_000_000  # most rows of a file
BATCH_IDS = 1000  # newest batch ids a table remembers
CHUNKS = 20_000  # stretches of a batch whose ranges are compared with those of files
PAIRS = 1_000_000  # ranges that meet beyond which filters are not probed: then the key columns of all these files are read
PROBED = 300  # keys a file beyond which its filter would answer yes by chance alone, and is not probed either
KEY_BITS, HASHES, SLOT_BITS = 12, 5, 32_768
FILE, SLOT, BITS = "_file", "_slot", "_bits"
DIGESTS = ("_digest", "_check")


@dataclass
class File:
    """A data file, relative to the table; ``low`` and ``high`` are None if no row has a whole key."""

    name: str
    rows: int
    low: list | None
    high: list | None
    slots: int


@dataclass
class Version:
    """One state of a table: its files, and the newest batches in it."""

    schema: str
    keys: list[str]
    hidden: list[str]
    files: list[File] = field(default_factory=list)
    loads: dict[str, int] = field(default_factory=dict)  # how many files a load wrote
    batches: list[str] = field(default_factory=list)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass
class Upserted:
    """What an upsert did: the version it made, if any, and how many files it looked at and replaced."""

    version: int
    files: int = 0  # of the table before
    in_range: int = 0  # whose key range holds a key of the batch
    read: int = 0  # whose filter does too: their key columns were read
    rewritten: int = 0  # that held one
    added: int = 0


@dataclass
class Changes:
    """Keys of a source that the table did not have, had otherwise, and had the same."""

    new: int
    changed: int
    equal: int
    upserted: Upserted | None = None


class Versions:
    """The numbered version files of a table.

    A version is written beside them and renamed into place, so readers see the old
    state or the new one. Rows of a load are written before its version, and files of a
    version are never changed, so a driver lost at any point leaves the table as it was.
    On a store without atomic renames two writers at once are not safe.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.folder = f"{path.rstrip('/')}/_versions"
        self.files, _ = file_system(spark, self.folder)

    def numbers(self) -> list[int]:
        try:
            names = [s.getPath().getName() for s in self.files.listStatus(file_system(self.spark, self.folder)[1])]
        except Py4JJavaError as e:
            if "FileNotFoundException" not in str(e.java_exception):
                raise
            return []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def place(self, number: int) -> str:
        return f"{self.folder}/{number:010d}.json"

    def get(self, number: int) -> Version:
        held = json.loads(read_text(self.spark, self.place(number)))
        return Version(**{**held, "files": [File(**f) for f in held["files"]]})

    def latest(self) -> tuple[int, Version | None]:
        numbers = self.numbers()
        return (numbers[-1], self.get(numbers[-1])) if numbers else (0, None)

    def add(self, number: int, version: Version) -> None:
        _, draft = file_system(self.spark, f"{self.folder}/{uuid.uuid4().hex}.draft")
        stream = self.files.create(draft)
        try:
            stream.write(bytearray(json.dumps(asdict(version)).encode()))
        finally:
            stream.close()
        _, target = file_system(self.spark, self.place(number))
        if self.files.exists(target) or not self.files.rename(draft, target):
            raise RuntimeError(f"{self.folder}: another writer added version {number}")


# -- keys -----------------------------------------------------------------------------


def _whole(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _plain(row: T.Row | None) -> list | None:
    """A key as JSON holds it."""
    return None if row is None else [v if isinstance(v, (str, int, float, bool)) else str(v) for v in row]


_READERS = {
    T.DateType: date.fromisoformat,
    T.TimestampType: datetime.fromisoformat,
    T.TimestampNTZType: datetime.fromisoformat,
    T.DecimalType: Decimal,
}
_AS_IS = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType)


def _typed(values: list, kinds: list[T.DataType]) -> tuple:
    return tuple(_READERS.get(type(k), lambda v: v)(v) for v, k in zip(values, kinds))


def _kinds(schema: T.StructType, keys: list[str]) -> list[T.DataType]:
    kinds = [schema[k].dataType for k in keys]
    for name, kind in zip(keys, kinds):
        if type(kind) not in _READERS and not isinstance(kind, _AS_IS):
            raise TypeError(f"key {name} of type {kind.simpleString()} has no order that files can be told apart by")
    return kinds


def _probes(slots: Column) -> Column:
    """The places of a key hash ``_hash`` in a filter of so many bitmaps."""
    places = [F.pmod(F.xxhash64(F.lit(i), "_hash"), slots.cast("long") * SLOT_BITS) for i in range(HASHES)]
    return F.explode(F.array(*places))


def digests(columns: list[str]) -> list[Column]:
    """Two 64-bit digests of a row, which tell NULL from every value and one column's value from another's."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(*parts).alias(DIGESTS[0]), F.xxhash64(F.lit(1), *reversed(parts)).alias(DIGESTS[1])]


# -- writing and reading ----------------------------------------------------------------


def _write(df: DataFrame, path: str, keys: list[str], file_rows: int) -> tuple[str, list[File]]:
    """Write a load sorted by key, with the filters of its files beside it; returns its name and its files."""
    spark, load = df.sparkSession, uuid.uuid4().hex
    folder, kinds = f"{path}/data/{load}", _kinds(df.schema, keys)
    placed = df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys]).sortWithinPartitions(*keys)
    placed.write.option("maxRecordsPerFile", file_rows).parquet(folder)
    held = spark.read.schema(T.StructType([T.StructField(k, t) for k, t in zip(keys, kinds)])).parquet(folder)
    held = held.select(F.col("_metadata.file_name").alias(FILE), *keys)
    key = F.when(_whole(keys), F.struct(*keys))
    stats = held.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows"), F.count_if(_whole(keys)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
    stats = stats.collect()  # one row a file
    slots = -(-max((r["n"] for r in stats), default=0) * KEY_BITS // SLOT_BITS)
    if slots:
        places = held.filter(_whole(keys)).select(FILE, F.xxhash64(*keys).alias("_hash")).select(FILE, _probes(F.lit(slots)).alias("_at"))
        bits = F.bitmap_construct_agg(F.col("_at") % SLOT_BITS).alias(BITS)
        filters = places.groupBy(FILE, F.expr(f"_at DIV {SLOT_BITS}").alias(SLOT)).agg(bits)
        filters.select(F.concat(F.lit(f"{load}/"), FILE).alias(FILE), SLOT, BITS).write.parquet(f"{path}/filters/{load}")
    return load, [File(f"{load}/{r[FILE]}", r["rows"], _plain(r["low"]), _plain(r["high"]), slots) for r in stats]


def _read(spark: SparkSession, path: str, version: Version, files: list[File] | None = None) -> DataFrame:
    """Rows of some files (all by default), hidden columns included."""
    wanted = version.files if files is None else files
    by_load = defaultdict(list)
    for f in wanted:
        by_load[f.name.split("/")[0]].append(f.name)
    # A load of which every file is wanted is read as a folder.
    places = [p for load, names in by_load.items() for p in ([load] if len(names) == version.loads[load] else names)]
    reader = spark.read.schema(version.struct())
    return reader.parquet(*[f"{path}/data/{p}" for p in places]) if places else spark.createDataFrame([], version.struct())


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(Versions(spark, path).numbers())


def _latest(spark: SparkSession, path: str) -> tuple[Versions, int, Version]:
    versions = Versions(spark, path)
    number, version = versions.latest()
    if version is None:
        raise FileNotFoundError(path)
    return versions, number, version


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of the table as it is, or as it was at an earlier version that has not been vacuumed."""
    path = path.rstrip("/")
    versions, number, held = _latest(spark, path)
    if version is not None and version != number:
        held = versions.get(version)
    return _read(spark, path, held).drop(*held.hidden)


def table_versions(spark: SparkSession, path: str) -> list[int]:
    return Versions(spark, path).numbers()


def create_table(batch: DataFrame, path: str, keys: list[str], digest: list[str] | None = None, file_rows: int = FILE_ROWS) -> int:
    """First load of a keyed table, or a new version that replaces all of it; returns the version.

    With ``digest`` every row also carries digests of those columns, which ``load_changes``
    compares; they are not part of what the table reads back.
    """
    path, hidden = path.rstrip("/"), list(DIGESTS) if digest is not None else []
    versions = Versions(batch.sparkSession, path)
    number, _ = versions.latest()
    held = batch.select("*", *digests(digest)) if digest is not None else batch
    load, files = _write(held, path, keys, file_rows)
    versions.add(number + 1, Version(held.schema.json(), keys, hidden, files, {load: len(files)}))
    return number + 1


# -- upsert -----------------------------------------------------------------------------


def _meeting(chunks: list[tuple[int, tuple, tuple]], files: list[tuple[File, tuple, tuple]]) -> list[tuple[int, File]] | None:
    """Pairs of a batch's ranges and files whose ranges share a key; None if there are more than PAIRS.

    The batch is sorted, so its ranges follow one another, and those that a file meets
    are found by two searches.
    """
    lows, highs, pairs = [c[1] for c in chunks], [c[2] for c in chunks], []
    for f, low, high in files:
        pairs += [(chunks[i][0], f) for i in range(bisect_left(highs, low), bisect_right(lows, high))]
        if len(pairs) > PAIRS:
            return None
    return pairs


def _candidates(spark: SparkSession, path: str, version: Version, staged: DataFrame, keys: list[str], n: int) -> tuple[list[File], list[File]]:
    """Files whose range holds a key of the batch, and of those the ones whose filter may."""
    kinds = _kinds(version.struct(), keys)
    ranged = [(f, _typed(f.low, kinds), _typed(f.high, kinds)) for f in version.files if f.low is not None]
    if not ranged:
        return [], []
    per_chunk = -(-n // CHUNKS)
    # Rows of a file are in key order, so a chunk is a stretch of them.
    chunk = F.concat_ws(":", "_metadata.file_name", F.expr(f"_metadata.row_index DIV {per_chunk}"))
    batch = staged.select(chunk.alias("_chunk"), *keys).filter(_whole(keys))
    key = F.struct(*keys)
    found = batch.groupBy("_chunk").agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    chunks = sorted(((r["_chunk"], tuple(r["low"]), tuple(r["high"])) for r in found), key=lambda c: c[1:])
    pairs = _meeting(chunks, ranged)
    if pairs is None:
        low, high = chunks[0][1], max(c[2] for c in chunks)
        near = [f for f, a, b in ranged if a <= high and b >= low]
        return near, near
    near = list({f.name: f for _, f in pairs}.values())
    if not near or n > PROBED * len(near):
        return near, near
    probe = spark.createDataFrame([(c, f.name, f.slots) for c, f in pairs], f"_chunk string, {FILE} string, _slots long")
    loads = sorted({f.name.split("/")[0] for f in near})
    held = spark.read.schema(f"{FILE} string, {SLOT} long, {BITS} binary").parquet(*[f"{path}/filters/{x}" for x in loads])
    asked = (
        batch.select("_chunk", F.xxhash64(*keys).alias("_hash"))
        .join(probe, "_chunk")
        .select(FILE, "_hash", _probes(F.col("_slots")).alias("_at"))
        .withColumn(SLOT, F.expr(f"_at DIV {SLOT_BITS}"))
    )
    byte = f"int(conv(hex(substring({BITS}, int(_at % {SLOT_BITS} DIV 8 + 1), 1)), 16, 10))"
    hit = F.expr(f"getbit({byte}, int(_at % 8)) = 1")
    may = asked.join(held, [FILE, SLOT]).groupBy(FILE, "_hash").agg(F.count_if(hit).alias("_n"))
    names = {r[FILE] for r in may.filter(F.col("_n") >= HASHES).select(FILE).distinct().collect()}
    return near, [f for f in near if f.name in names]


def upsert_table(
    spark: SparkSession, path: str, batch: DataFrame, keys: list[str], order: list[str] | None = None,
    batch_id: str | None = None, file_rows: int = FILE_ROWS,
) -> Upserted:
    """Upsert a batch into the table at ``path``, reading and rewriting only files that hold its keys.

    The batch is evaluated once, into sorted files of its own, and everything else reads
    those, so a source that changes between readings cannot mix two states. With
    ``order`` the newest row of a key wins, whether it is stored or in the batch; without
    it the batch does. Rows whose key has a NULL match nothing and are added, so repeating
    a batch leaves the table as it was only if it has none, or if it carries a
    ``batch_id``: one that the table has seen already is passed over.
    """
    path = path.rstrip("/")
    versions, number, version = _latest(spark, path)
    done = Upserted(number, len(version.files))
    if batch_id is not None and batch_id in version.batches:
        return done
    folder = f"{path}/staged/{uuid.uuid4().hex}"
    seen = Observation()
    ordered = batch.observe(seen, F.count(F.lit(1)).alias("n")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.write.parquet(folder)
    n = seen.get["n"]
    if n:
        staged = spark.read.schema(batch.schema).parquet(folder)
        near, possible = _candidates(spark, path, version, staged, keys, n)
        # Of the files that may hold a key of the batch, those that do.
        held = _read(spark, path, version, possible).select(F.col("_metadata.file_path").alias(FILE), *keys) if possible else None
        rows = held.join(staged.select(*keys).distinct(), keys, "left_semi").select(FILE).distinct().collect() if possible else []
        names = {"/".join(r[FILE].split("/")[-2:]) for r in rows}
        touched = [f for f in possible if f.name in names]
        current = _read(spark, path, version, touched)
        arrived = staged.select(*current.columns)
        merged = upsert(current, arrived, keys) if order is None else newest(current, arrived, keys, order)
        load, files = _write(merged, path, keys, file_rows)
        version.files = [f for f in version.files if f.name not in names] + files
        live = {f.name.split("/")[0] for f in version.files}
        version.loads = {k: v for k, v in {**version.loads, load: len(files)}.items() if k in live}
        done = Upserted(number, done.files, len(near), len(possible), len(touched), len(files))
    if n or batch_id is not None:
        version.batches = [*version.batches, *([batch_id] if batch_id is not None else [])][-BATCH_IDS:]
        versions.add(number + 1, version)
        done.version = number + 1
    files, at = file_system(spark, folder)
    files.delete(at, True)
    return done


# -- snapshot diff ------------------------------------------------------------------------


def load_changes(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], stamps: dict[str, Column] | None = None,
    file_rows: int = FILE_ROWS,
) -> Changes:
    """Bring the table up to a whole source, writing only keys whose rows are new or changed.

    Stored rows carry digests of their source columns. The source's digests are summed by
    key and compared with the stored ones, read from the key and digest columns alone; a
    source that brings nothing new writes no file and no version. ``stamps`` are columns
    that written rows get besides (a load time, say) and that are not compared, so rows
    that stay as they are keep their first stamp. Keys gone from the source survive, and
    rows that share a key are replaced together. A row without a whole key is known by
    its digests: it is added unless the table holds an equal one.
    """
    path, stamps = path.rstrip("/"), stamps or {}
    columns = source.columns
    stamped = [*columns, *[v.alias(k) for k, v in stamps.items()]]
    if not table_exists(spark, path):
        create_table(source.select(*stamped), path, keys, columns, file_rows)
        return Changes(read_table(spark, path).select(*keys).distinct().count(), 0, 0)
    _, _, version = _latest(spark, path)
    if list(DIGESTS) != version.hidden:
        raise ValueError(f"{path}: the rows of this table carry no digests")
    loose = F.when(~_whole(keys), F.concat_ws(":", *DIGESTS)).otherwise("").alias("_loose")

    def summed(df: DataFrame, prefix: str) -> DataFrame:
        sums = [F.sum(F.col(DIGESTS[0]).cast("decimal(38,0)")).alias(f"{prefix}_a"), F.bit_xor(DIGESTS[1]).alias(f"{prefix}_b")]
        return df.groupBy(*keys, loose).agg(F.count(F.lit(1)).alias(f"{prefix}_n"), *sums)

    came = summed(source.select(*keys, *digests(columns)), "_came")
    had = summed(_read(spark, path, version).select(*keys, *DIGESTS), "_had")
    had = had.select(*[F.col(c).alias(f"_had_{c}") if c in (*keys, "_loose") else F.col(c) for c in had.columns])
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_had_{k}")) for k in (*keys, "_loose")])
    differs = reduce(lambda a, b: a | b, [F.col(f"_came_{x}") != F.col(f"_had_{x}") for x in ("n", "a", "b")])
    is_new = F.col("_had_n").isNull()
    is_changed = ~is_new & (F.col("_loose") == "") & differs
    seen = Observation()
    compared = came.join(had, same_key, "left").observe(
        seen, F.count_if(is_new).alias("new"), F.count_if(is_changed).alias("changed"), F.count(F.lit(1)).alias("all")
    )
    folder = f"{path}/staged/{uuid.uuid4().hex}"
    wanted = compared.filter(is_new | is_changed).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate((*keys, "_loose"))])
    wanted.write.parquet(folder)
    n = seen.get
    found = Changes(n["new"], n["changed"], n["all"] - n["new"] - n["changed"])
    if found.new or found.changed:
        wanted = spark.read.schema(wanted.schema).parquet(folder)
        rows = source.select(*stamped, *digests(columns)).withColumn("_loose", loose)
        match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate((*keys, "_loose"))])
        found.upserted = upsert_table(spark, path, rows.join(wanted, match, "left_semi").drop("_loose"), keys, file_rows=file_rows)
    files, at = file_system(spark, folder)
    files.delete(at, True)
    return found


# -- upkeep -----------------------------------------------------------------------------


def compact_table(spark: SparkSession, path: str, least_rows: int = FILE_ROWS // 4, file_rows: int = FILE_ROWS) -> int:
    """Write files of fewer rows than ``least_rows`` together, sorted anew; returns how many went."""
    path = path.rstrip("/")
    versions, number, version = _latest(spark, path)
    small = [f for f in version.files if f.rows < least_rows]
    if len(small) < 2:
        return 0
    load, files = _write(_read(spark, path, version, small), path, version.keys, file_rows)
    names = {f.name for f in small}
    version.files = [f for f in version.files if f.name not in names] + files
    live = {f.name.split("/")[0] for f in version.files}
    version.loads = {k: v for k, v in {**version.loads, load: len(files)}.items() if k in live}
    versions.add(number + 1, version)
    return len(small)


def vacuum_table(spark: SparkSession, path: str, keep: int = 2, older_than_hours: float = 24.0) -> int:
    """Delete all but the newest ``keep`` versions and the files that none of those needs; returns how many files went.

    Loads and staged batches younger than ``older_than_hours`` stay, since a writer may
    not have added its version yet.
    """
    path = path.rstrip("/")
    versions = Versions(spark, path)
    numbers = versions.numbers()
    kept = [versions.get(n) for n in numbers[-max(1, keep) :]]
    live = {f.name for v in kept for f in v.files}
    files, _ = file_system(spark, path)
    latest = spark._jvm.java.lang.System.currentTimeMillis() - int(older_than_hours * 3_600_000)

    def listed(place: str) -> list:
        _, at = file_system(spark, place)
        return list(files.listStatus(at)) if files.exists(at) else []

    gone = 0
    for load in listed(f"{path}/data"):
        name = load.getPath().getName()
        if load.getModificationTime() > latest:
            continue
        held = [f for f in listed(f"{path}/data/{name}") if f.getPath().getName().endswith(".parquet")]
        dead = [f for f in held if f"{name}/{f.getPath().getName()}" not in live]
        gone += len(dead)
        if len(dead) == len(held):
            for part in ("data", "filters"):
                files.delete(file_system(spark, f"{path}/{part}/{name}")[1], True)
        else:
            for f in dead:
                files.delete(f.getPath(), False)
    for staged in listed(f"{path}/staged"):
        if staged.getModificationTime() <= latest:
            files.delete(staged.getPath(), True)
    for number in numbers[: -max(1, keep)]:
        files.delete(file_system(spark, versions.place(number))[1], False)
    return gone
