"""A hash-keyed table that only appends.

A batch writes its own rows and nothing else; what changes an earlier row (the
instant at which it was met again) stands in a side table and is merged on
read.  Under ``root``:

    rows/epoch=N/prefix=ab/     new rows, dealt by the first digits of row_hash
    touched/epoch=N/            row_hash of known rows that batch N holds, by prefix or not
    filters/epoch=N/            a Bloom filter of each prefix's new hashes
    commits/N/                  written last: batch id and as_of

A batch is dealt once, by the first digits of row_hash, with its columns as they
came; its rows are compared and written where they lie.  For a table of more
than ``OLD_A_NEW`` times the batch's rows ``insert`` first asks the Bloom filters
of the batch's own prefixes (about two bytes a key).  Rows that no filter knows
are new without a look at old data; the others are compared exactly with the
hash column of the partitions whose filter answered.  Up to that size the
digests of the table are dealt with the batch and met there.  An epoch without its commit does not exist for any reader,
so a run lost between write and commit leaves nothing behind but files, and a
batch id that is committed already is skipped: a replay inserts nothing and
touches nothing.  One writer at a time (a stream's driver).  ``compact`` folds
all epochs into one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.session import CODEC, cut_lineage, release_shuffles
from ledgerlens.sources.ingest import AUDIT_COLS, _hadoop_path, normalise_columns, row_hash

DIGITS = 2           # of row_hash: 256 prefixes
BITS_PER_KEY = 16
PROBES = 4           # a filter lets about one unknown key in 400 through
MOST_BROADCAST = 1_000_000
OLD_A_NEW = 4        # a filter of a prefix answers some key of a larger batch in any case


@dataclass
class Commit:
    epoch: int
    batch: str
    as_of: str


def _epochs(spark: SparkSession, path: str) -> list[int]:
    p, fs = _hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName().removeprefix("epoch=") for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(int(n) for n in names if n.isdigit())


def _committed(spark: SparkSession, root: str) -> list:
    """The rows of all finished commits: one a batch."""
    def finished(n: int) -> bool:
        p, fs = _hadoop_path(spark, f"{root}/commits/{n}/_SUCCESS")
        return fs.exists(p)

    paths = [f"{root}/commits/{n}" for n in _epochs(spark, f"{root}/commits") if finished(n)]
    return spark.read.schema("epoch long, batch string, as_of string, replaces array<long>").json(paths).collect() if paths else []


def commits(spark: SparkSession, root: str) -> list[Commit]:
    """The epochs that exist, oldest first."""
    rows = _committed(spark, root)
    gone = {n for r in rows for n in r.replaces or []}
    return sorted((Commit(r.epoch, r.batch, r.as_of) for r in rows if r.epoch not in gone), key=lambda c: c.epoch)


def _part(spark: SparkSession, root: str, part: str, epochs: list[int], merge: bool = False) -> DataFrame | None:
    there = [n for n in epochs if n in set(_epochs(spark, f"{root}/{part}"))]
    if not there:
        return None
    reader = spark.read.option("basePath", f"{root}/{part}").option("mergeSchema", merge)
    return reader.parquet(*[f"{root}/{part}/epoch={n}" for n in there])


def _places(words: Column) -> list[tuple[Column, Column]]:
    """(word, bit) of a hash's probes in a filter of ``words`` longs."""
    out = []
    for k in range(PROBES):
        h = F.conv(F.substring("row_hash", DIGITS + 1 + 12 * k, 12), 16, 10).cast("long")  # 48 bits of the digest each
        place = F.pmod(h, words * 64)
        out.append((F.floor(place / 64).cast("int"), F.pmod(place, F.lit(64)).cast("int")))
    return out


def bloom_filters(new: DataFrame) -> DataFrame:
    """prefix, words (array<long>): a filter for each prefix of ``new``
    (prefix, row_hash), sized by its number of keys."""
    sizes = new.groupBy("prefix").agg(F.greatest(F.lit(1), F.ceil(F.count("*") * BITS_PER_KEY / 64)).cast("long").alias("n"))
    probes = new.join(F.broadcast(sizes), "prefix").withColumn("_at", F.explode(F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in _places(F.col("n"))])))
    bits = probes.select("prefix", F.col("_at.w").alias("w"), F.expr("shiftleft(1L, _at.b)").alias("bits"))
    empty = sizes.select("prefix", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("w"), F.lit(0).cast("long").alias("bits"))
    words = bits.unionByName(empty).groupBy("prefix", "w").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("w", "bits")))
    return words.groupBy("prefix").agg(F.transform(ordered, lambda x: x["bits"]).alias("words"))


def _maybe(words: Column) -> Column:
    n = F.size(words).cast("long")
    return reduce(Column.__and__, [F.call_function("bit_get", F.element_at(words, w + 1), b) == 1 for w, b in _places(n)])


def _placed(digest: Column, tasks: int) -> Column:
    """The task of a hash: tasks follow its first digits."""
    return F.floor(F.conv(F.substring(digest, 1, 4), 16, 10).cast("long") * tasks / 65536).cast("int")


def _dealt(incoming: DataFrame, compat: bool, digests: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """_place, row_hash, the columns of ``incoming`` as text, and _old, dealt
    by _place: all rows of ``incoming`` and, with _old and without columns,
    those of ``digests`` (row_hash).  Columns travel as they came, and are
    made text again afterwards: shorter than their text and its hash."""
    inc = normalise_columns(incoming)
    cols = inc.columns
    tasks = int(inc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = [S.null_words_to_null(F.col(f"`{c}`").cast("string")).alias(c) for c in cols]
    own = [c for c in cols if c not in AUDIT_COLS]
    keyed = row_hash(inc.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), *texts), own, compat)
    rows = keyed.select("_row.*", _placed(F.col("row_hash"), tasks).alias("_place"))
    if digests is not None:
        rows = rows.unionByName(digests.select(F.unhex("row_hash").alias("_digest"), _placed(F.col("row_hash"), tasks).alias("_place")), allowMissingColumns=True)
    else:
        rows = rows.withColumn("_digest", F.lit(None).cast("binary"))
    dealt = rows.repartitionById(tasks, F.col("_place")).select("_place", "_digest", *texts)
    dealt = row_hash(dealt.withColumnRenamed("row_hash", "_row_hash") if "row_hash" in cols else dealt, own, compat)
    dealt = dealt.withColumn("_old", F.col("_digest").isNotNull()).withColumn("row_hash", F.coalesce(F.lower(F.hex("_digest")), F.col("row_hash")))
    return dealt.drop("_digest", "_row_hash"), [c for c in cols if c != "row_hash"]


def _hashed(incoming: DataFrame, compat: bool) -> DataFrame:
    """The batch as text with row_hash and prefix, one row a hash."""
    dealt, cols = _dealt(incoming, compat)
    inc = dealt.dropDuplicates(["_place", "row_hash"]).select(*[F.col(f"`{c}`") for c in cols], "row_hash")
    return inc.withColumn("prefix", F.substring("row_hash", 1, DIGITS))


def _write(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("errorifexists").option("compression", CODEC).partitionBy(*by).parquet(path)
    release_shuffles(df.sparkSession, path)


def _met(incoming: DataFrame, compat: bool, old: DataFrame, as_of: str, root: str, epoch: int) -> None:
    """Write the rows of ``incoming`` that ``old`` lacks, and the hashes of the
    others as touched: both are found in one pass over rows that were dealt
    once, written apart and moved to their places."""
    spark = old.sparkSession
    dealt, cols = _dealt(incoming, compat, old)
    kept = [c for c in cols if c not in ("execution_date", "prefix")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    met = dealt.groupBy("_place", "row_hash").agg(F.max("_old").alias("_known"), F.max(~F.col("_old")).alias("_new"),
                                                  F.first(F.when(~F.col("_old"), row), ignorenulls=True).alias("_row")).where("_new")
    out = met.select(*[F.when(~F.col("_known"), F.col("_row")[c]).alias(c) for c in kept], "row_hash", F.substring("row_hash", 1, DIGITS).alias("prefix"),
                     F.when(~F.col("_known"), F.lit(as_of).cast("date")).alias("execution_date"), "_known")
    staged = f"{root}/staged/{uuid.uuid4().hex}"
    _write(out, staged, "_known", "prefix")
    for side, part in (("false", "rows"), ("true", "touched")):
        source, fs = _hadoop_path(spark, f"{staged}/_known={side}")
        if fs.exists(source):
            target, _ = _hadoop_path(spark, f"{root}/{part}/epoch={epoch}")
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"{source} could not be moved to {target}")
    p, fs = _hadoop_path(spark, staged)
    fs.delete(p, True)


def insert(spark: SparkSession, root: str, incoming: DataFrame, as_of: str, batch: str, compat: bool = False,
           before_commit=None) -> int | None:
    """Append a batch; its epoch, or None if ``batch`` is committed already.
    ``before_commit`` is called between write and commit (tests)."""
    root = root.rstrip("/")
    if batch in {r.batch for r in _committed(spark, root)}:  # compacted ones as well
        return None
    old = [c.epoch for c in commits(spark, root)]
    taken = [n for part in ("rows", "touched", "filters", "commits") for n in _epochs(spark, f"{root}/{part}")]
    epoch = max(taken, default=0) + 1  # never a folder that a lost run has begun
    rows = _part(spark, root, "rows", old)
    if rows is not None and rows.count() <= OLD_A_NEW * _size(incoming):
        _met(incoming, compat, rows.select("row_hash"), as_of, root, epoch)
    else:
        new = _hashed(incoming, compat) if rows is None else _asked(spark, root, incoming, compat, old, epoch)
        _write(new.withColumn("execution_date", F.lit(as_of).cast("date")), f"{root}/rows/epoch={epoch}", "prefix")
    written = _part(spark, root, "rows", [epoch]) if _filled(spark, f"{root}/rows/epoch={epoch}") else None
    if written is not None:
        bloom_filters(written.select("prefix", "row_hash")).write.mode("errorifexists").parquet(f"{root}/filters/epoch={epoch}")
    if before_commit is not None:
        before_commit()
    _commit(spark, root, epoch, batch, as_of, [])
    return epoch


def _size(df: DataFrame) -> int:
    """Its number of rows, with all columns read: a text file whose faulty
    lines are told by their fields cannot be counted without them."""
    df = normalise_columns(df)
    return df.agg(F.count(F.lit(1)), F.max(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns]))).first()[0]


def _filled(spark: SparkSession, path: str) -> bool:
    """Rows stand in the folder ``path``."""
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p) and any(s.getPath().getName().startswith("prefix=") for s in fs.listStatus(p))


def _asked(spark: SparkSession, root: str, incoming: DataFrame, compat: bool, old: list[int], epoch: int) -> DataFrame:
    """The rows of ``incoming`` that are new, by the filters first; hashes of
    the others are written as touched."""
    inc = cut_lineage(_hashed(incoming, compat), "batch")
    new, keys = inc, inc.select("prefix", "row_hash")
    filters = _part(spark, root, "filters", old)
    prefixes = [r.prefix for r in keys.select("prefix").distinct().collect()]  # 256 at most
    held = filters.where(F.col("prefix").isin(prefixes))
    asked = cut_lineage(keys.join(held, "prefix").where(_maybe(F.col("words"))).select("prefix", "row_hash", "epoch"), "asked")
    parts = [(r.epoch, r.prefix) for r in asked.select("epoch", "prefix").distinct().collect()]  # partitions of the table
    if parts:
        rows = _part(spark, root, "rows", sorted({e for e, _ in parts}), merge=False).select("epoch", "prefix", "row_hash") \
            .where(F.col("prefix").isin(sorted({p for _, p in parts})))
        wanted = asked.select("row_hash").distinct()
        wanted = F.broadcast(wanted) if asked.count() <= MOST_BROADCAST else wanted
        known = cut_lineage(rows.join(wanted, "row_hash", "left_semi").select("row_hash").distinct(), "known")
        if not known.isEmpty():
            known.write.mode("errorifexists").parquet(f"{root}/touched/epoch={epoch}")
            new = inc.join(known, "row_hash", "left_anti")
    return new.repartition("prefix")  # a prefix's rows meet in one task: one file a prefix


def _commit(spark: SparkSession, root: str, epoch: int, batch: str, as_of: str, replaces: list[int]) -> None:
    row = spark.createDataFrame([(epoch, batch, as_of, replaces)], "epoch long, batch string, as_of string, replaces array<long>")
    row.coalesce(1).write.mode("errorifexists").json(f"{root}/commits/{epoch}")


def read(spark: SparkSession, root: str) -> DataFrame | None:
    """The table: all columns that any batch had (NULL where a batch lacks
    one), row_hash, execution_date, and verificacao_hash: the last as_of at
    which a known row came again."""
    root = root.rstrip("/")
    done = commits(spark, root)
    rows = _part(spark, root, "rows", [c.epoch for c in done], merge=True)
    if rows is None:
        return None
    there = [n for n in _epochs(spark, f"{root}/touched") if n in {c.epoch for c in done}]
    kept = [c for c in rows.columns if c not in ("verificacao_hash", "epoch", "prefix")]
    own = F.col("verificacao_hash") if "verificacao_hash" in rows.columns else F.lit(None).cast("timestamp_ntz")
    if not there:
        return rows.select(*kept, own.alias("verificacao_hash"))
    when = F.create_map(*[x for c in done for x in (F.lit(c.epoch), F.lit(c.as_of).cast("timestamp_ntz"))])
    digest = F.unhex("row_hash").alias("_digest")  # half as long as its text
    # with or without folders by prefix below an epoch's
    touched = spark.read.schema("row_hash string").option("recursiveFileLookup", True).parquet(*[f"{root}/touched/epoch={n}" for n in there])
    touched = touched.withColumn("epoch", F.regexp_extract("_metadata.file_path", r"/touched/epoch=(\d+)/", 1).cast("int"))
    last = touched.groupBy(digest).agg(F.max(F.element_at(when, F.col("epoch"))).alias("_last"))
    # a batch touches rows of earlier ones alone: those written since go by
    newest = max(there)
    met = rows.where(F.col("epoch") < newest).select(*[c for c in rows.columns if c != "row_hash"], digest).join(last, "_digest", "left") \
        .withColumn("row_hash", F.lower(F.hex("_digest"))).select(*kept, F.greatest(own, F.col("_last")).alias("verificacao_hash"))
    return met.unionByName(rows.where(F.col("epoch") >= newest).select(*kept, own.alias("verificacao_hash")))


def compact(spark: SparkSession, root: str) -> int | None:
    """Fold all epochs into a new one; readers see either state.  The files
    of the old epochs stay until they are deleted by hand."""
    root = root.rstrip("/")
    done = commits(spark, root)
    whole = read(spark, root)
    if whole is None or len(done) < 2:
        return None
    epoch = max(n for part in ("rows", "touched", "filters", "commits") for n in _epochs(spark, f"{root}/{part}")) + 1
    whole = whole.withColumn("prefix", F.substring("row_hash", 1, DIGITS))
    _write(whole.repartition("prefix"), f"{root}/rows/epoch={epoch}", "prefix")
    bloom_filters(_part(spark, root, "rows", [epoch]).select("prefix", "row_hash")).write.mode("errorifexists").parquet(f"{root}/filters/epoch={epoch}")
    _commit(spark, root, epoch, f"compact-{epoch}", done[-1].as_of, [c.epoch for c in done])
    return epoch
