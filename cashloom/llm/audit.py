"""What filters remove, together and in every order, counted by a stream that takes back what it said too early.

All files of a table go through a stream in micro-batches until none is left. Every document has a mask,
one bit for each filter that it fails. Whether it repeats a text of a smaller id only the documents yet to
come can settle, so the stream keeps for each text the smallest id seen so far and the documents that
have it. A document with a larger id counts with the repeat bit, one with the smallest without. When a
smaller id arrives, the earlier documents' masks are taken back from the counters of their parts, and
counted again with the bit. The counters are sums of such changes, one row for each part, mask and kind
of document, so that they are the same whatever the order of files and batches.

Texts are told apart by the first half of their SHA-256. A key of the stream's state is a share of these
hashes with an entry for each text. The tasks that read add up equal rows, and settle the repeats of a
text among what they read together: those go to any key, so that copies of one text meet at its key
as a few rows a task. Ids of very many rows are found in a sample, and their labels broadcast, for the
join with the labels goes by id. State lies in the session's state store and changes in a folder for each
batch, both below ``spark.checkpoint.dir``: a lost executor's tasks, or a batch, run again with the same
result. The default store holds its share of the state in an executor's memory, some 50 bytes a text;
a larger one is for the session to set.

Defined results: a null text counts as empty; a null part is the empty string; a document without an id
repeats none and is repeated by none; rows of one id and text are documents of their own, and neither
repeats the other; of several labels of one id, one that is 1 counts; an empty table gives no rows;
columns other than those named don't matter, whatever their names.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cashloom.llm.storage import SPACES, new_path, stored

#: The filters, a bit of the mask each; the last is the repeat of a smaller id's text.
FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")
#: A run has about this many micro-batches, unless they would be smaller than ``LEAST_BYTES``.
BATCHES, LEAST_BYTES = 4, 32 << 20
#: Texts of which one key of the state holds the entries, by an estimate of ``TEXT_BYTES`` of input a text.
KEY_TEXTS, TEXT_BYTES = 4096, 1024
#: Rows added up at once in a task that reads.
COMBINED_ROWS = 100_000
#: An id of more rows than this has its labels broadcast; of so many rows ``SAMPLED`` are looked at.
HOT_ROWS, SAMPLED = 1_000_000, 20
#: Bytes of a text's hash that tell it apart.
HASH_BYTES = 16


def failed(text: str, parts: str) -> str:
    """The mask of the filters that a text fails by itself: all but the last.

    ``parts`` are the text's pieces between white space, of which the first and last may be empty.
    """
    ends = f"if({parts}[0] = '', 1, 0) + if(size({parts}) > 1 AND {parts}[size({parts}) - 1] = '', 1, 0)"
    different = f"size(array_distinct({parts})) - if({parts}[0] = '' OR {parts}[size({parts}) - 1] = '', 1, 0)"
    tests = [
        f"size({parts}) - ({ends}) < 50",
        f"100L * ({different}) < 65L * (size({parts}) - ({ends}))",
        f"100L * regexp_count({text}, '[A-Z]') > 5L * length({text})",
        f"{text} RLIKE '[#$%&*|]'",
    ]
    return " + ".join(f"if({test}, {1 << bit}, 0)" for bit, test in enumerate(tests))


def _measured(spark: SparkSession, path: str) -> tuple[int, str]:
    """The bytes below ``path``, and the path that a stream takes: for a single file a pattern that it matches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    size = system.getContentSummary(target).getLength()
    return size, path if system.getFileStatus(target).isDirectory() else f"{path[:-1]}[{path[-1]}]"


def _added_up(rows: DataFrame, keys: int) -> DataFrame:
    """Equal rows as one with the sum of ``n``, and repeats settled, among what a task reads together.

    Of a text's rows met together, those above the smallest id are repeats for good: they get the bit
    and need their text no more.
    """

    def summed(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        coded = table.column("text").combine_chunks().dictionary_encode()
        texts, ids, alive = coded.indices.to_numpy(), table.column("id").to_numpy(), table.column("open").to_numpy()
        least = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(least, texts[alive], ids[alive])
        late = alive & (ids > least[texts])
        settled = {
            "key": pa.array(np.where(late, ids % keys, table.column("key").to_numpy()), pa.int32()),
            "text": pc.if_else(pa.array(late), pa.scalar(b""), table.column("text")),
            "mask": pa.array(np.where(late, table.column("mask").to_numpy() | REPEAT, table.column("mask").to_numpy()), pa.int32()),
            "open": pa.array(alive & ~late),
        }
        for name, column in settled.items():
            table = table.set_column(table.schema.get_field_index(name), name, column)
        columns = [c for c in table.column_names if c != "n"]
        out = table.group_by(columns, use_threads=False).aggregate([("n", "sum")]).rename_columns([*columns, "n"])
        return out.combine_chunks().to_batches()[0]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= COMBINED_ROWS:
                yield summed(pa.Table.from_batches(held))
                held = []
        if held:
            yield summed(pa.Table.from_batches(held))

    return rows.mapInArrow(added, f"{ROW}, n long")


def _labelled(rows: DataFrame, files: DataFrame, labels: DataFrame, doc_id: str, hot_rows: int) -> DataFrame:
    """``rows`` of the stream with ``quality`` and ``toxic``, by id; rows without an id or label have neither."""
    marks = [F.max(F.coalesce(F.col(n) == 1, F.lit(False))).alias(n) for n in ("quality", "toxic")]
    known = stored(labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(*marks), "labels")
    ids = files.select(F.col(doc_id).cast("long").alias("id")).where("id IS NOT NULL")
    each = max(1, min(SAMPLED, hot_rows))
    some = ids if each >= hot_rows else ids.where(F.rand(42) < each / hot_rows)
    hot = stored(some.groupBy("id").count().where(F.col("count") > each).select("id"), "hot-ids")
    of_hot = F.broadcast(hot.join(known, "id", "left").select("id", F.lit(True).alias("hot"), F.col("quality").alias("hot_quality"), F.col("toxic").alias("hot_toxic")))
    marked = rows.join(of_hot, "id", "left")
    # labels have apart = 0; what finds nothing there, or has found it, is dealt out by its text
    alone = F.when(F.col("hot").isNull() & F.col("named"), 0).otherwise(1 + F.pmod(F.xxhash64("text", "part", "mask"), F.lit(1 << 20)))
    found = marked.withColumn("apart", alone.cast("int")).join(known.withColumn("apart", F.lit(0)), ["id", "apart"], "left")
    quality, toxic = (F.coalesce(n, f"hot_{n}", F.lit(False)).alias(n) for n in ("quality", "toxic"))
    return found.select(*[c.split()[0] for c in ROW.split(", ") if c != "named boolean"], quality, toxic, "n")


ROW = "key int, text binary, id long, named boolean, open boolean, part string, mask int"
CHANGE = "part string, mask int, quality boolean, toxic boolean, n long"
KIND = ["part", "mask", "quality", "toxic"]


def _changes(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the counters by new rows of a range of texts; the state holds each text's smallest id."""
    new = pd.concat(list(frames), ignore_index=True)
    settled, new = new[~new["open"]], new[new["open"]]
    columns = ["text", "id", *KIND, "n"]
    new = new[columns].assign(earlier=False)
    if state.exists:
        earlier = pa.ipc.open_stream(state.get[0]).read_all().to_pandas()
        new = pd.concat([earlier[columns].assign(earlier=True), new], ignore_index=True)
    late = new["id"] > new.groupby("text")["id"].transform("min")
    repeat = new["mask"] | REPEAT
    fresh, retracted = new[~new["earlier"]], new[new["earlier"] & late]
    changes = [
        settled,
        fresh.assign(mask=fresh["mask"].where(~late, repeat)),
        retracted.assign(n=-retracted["n"]),
        retracted.assign(mask=repeat),
    ]
    if len(new):
        kept = new[~late].groupby(["text", "id", *KIND], as_index=False, sort=False)["n"].sum()
        table = pa.Table.from_pandas(kept, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
    total = pd.concat([c[[*KIND, "n"]] for c in changes], ignore_index=True).groupby(KIND, as_index=False, sort=False)["n"].sum()
    yield total[total["n"] != 0]


def counters(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
    batch_bytes: int | None = None,
    keys: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """part, mask, quality, toxic, n: how many documents of a part fail just the filters of the mask.

    ``path`` holds the documents' Parquet files, all of which are read in micro-batches of about
    ``batch_bytes``. ``labels`` has doc_id, quality and toxic.
    """
    size, watched = _measured(spark, path)
    batch_bytes = batch_bytes or max(LEAST_BYTES, -(-size // BATCHES))
    keys = keys or max(1, math.ceil(size / TEXT_BYTES / KEY_TEXTS))
    files = spark.read.parquet(path)
    stream = spark.readStream.schema(files.schema).option("maxBytesPerTrigger", batch_bytes).parquet(watched)
    value = F.coalesce(F.col(text), F.lit(""))
    read = stream.select(
        F.unhex(F.substring(F.sha2(value, 256), 1, 2 * HASH_BYTES)).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"),
        F.col(doc_id).isNotNull().alias("named"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        value.alias("value"),
        F.split(value, f"[{SPACES}]+").alias("parts"),
    )
    key = F.pmod(F.xxhash64("text"), F.lit(keys)).cast("int").alias("key")
    rows = read.select(key, "text", "id", "named", F.col("named").alias("open"), "part", F.expr(failed("value", "parts")).alias("mask"), F.lit(1).cast("long").alias("n"))
    changes = _labelled(_added_up(rows, keys), files, labels, doc_id, hot_rows).groupBy("key").applyInPandasWithState(
        _changes, CHANGE, "texts binary", "update", GroupStateTimeout.NoTimeout
    )
    said = new_path(spark, "changes")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{said}/batch={number}")

    out = changes.writeStream.outputMode("update").foreachBatch(write)
    query = out.option("checkpointLocation", new_path(spark, "stream")).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.lastProgress is None:
        return spark.createDataFrame([], CHANGE)
    return spark.read.schema(f"{CHANGE}, batch int").parquet(said).groupBy(*KIND).agg(F.sum("n").alias("n")).where("n <> 0")


def _count(test: str, only: str = "true") -> str:
    return f"aggregate(masks, 0L, (total, m) -> total + if({test} AND {only}, m.n, 0L))"


def orders(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from ``counters``, zeros included."""
    names = ["".join(p) for p in itertools.permutations(filters)]
    masks = F.collect_list(F.struct("mask", "quality", "toxic", "n")).alias("masks")
    steps = counted.groupBy("part").agg(masks).withColumn("filter_order", F.explode(F.array(*map(F.lit, names))))
    bit = f"shiftleft(1, locate(substring(filter_order, step, 1), '{filters}') - 1)"
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    earlier = f"aggregate(sequence(1, step), 0, (set, i) -> set + if(i < step, shiftleft(1, locate(substring(filter_order, i, 1), '{filters}') - 1), 0))"
    steps = steps.selectExpr("*", f"{bit} AS own", f"{earlier} AS earlier")
    fails, gone = "(m.mask & own) <> 0", "(m.mask & earlier) <> 0"
    counts = steps.selectExpr(
        "part",
        "filter_order",
        "step",
        "own",
        f"{_count(f'NOT ({gone}) AND NOT ({fails})')} AS kept",
        f"{_count(f'NOT ({gone}) AND {fails}')} AS removed",
        f"{_count(f'{gone} AND {fails}')} AS redundant",
        f"{_count('m.mask = own')} AS unique_fails",
        f"{_count(f'NOT ({gone}) AND {fails}', 'm.quality')} AS good_lost",
        f"{_count(f'NOT ({gone}) AND {fails}', 'm.toxic')} AS toxic_lost",
    )
    shares = counts.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))
    return counts.join(shares, ["part", "own"]).drop("own")


def audited(spark: SparkSession, path: str, labels: DataFrame, **options) -> DataFrame:
    """The audit of all documents below ``path``: see ``counters`` and ``orders``."""
    return orders(stored(counters(spark, path, labels, **options), "counters"))
